"""DuckDB SQL with the same result as the queries of this subpackage, where SQL
can express it. Written from what the queries return, by plainer means."""

from __future__ import annotations

#: CRC-32 of a list of bytes, from a table that is made by the polynomial's rule.
CRC_TABLE = """crc_table as (
  select list(c order by i) as t from (
    select i, list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
                          lambda c, x: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end) as c
    from range(256) r(i)))"""


def crc(octets: str) -> str:
    return (f"xor(list_reduce(list_prepend(4294967295::bigint, {octets}), "
            "lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295)")


#: Bytes of a text whose code points lie below 256.
OCTETS = ("flatten(list_transform(string_split({0}, ''), lambda c: case when unicode(c) < 128 then [unicode(c)::bigint] "
          "else [(192 + (unicode(c) >> 6))::bigint, (128 + (unicode(c) & 63))::bigint] end))")

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

SPELLING_VARIANTS = f"""
with recursive {CRC_TABLE},
runs as (
  select key, run, count(*) as n from (
    select coalesce(cast(doc_id as varchar), '') as key,
           translate(unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')), '{UPPER}', '{LOWER}') as run from documents)
  where length(run) >= 5 group by key, run),
hashed as (select run, n, {crc(OCTETS.format("key || ':' || run"))} as h from runs, crc_table),
planted as (
  select case when h % 97 = 0 then substr(run, 1, (h % length(run))::int) || substr(run, (h % length(run))::int + 2)
              else run end as word, n from hashed),
words as (select word, cast(sum(n) as bigint) as n from planted where length(word) >= 5 group by word having sum(n) >= 3),
less as (
  select word, n, i, substr(word, 1, i::int) || substr(word, i::int + 2) as rest
  from (select word, n, unnest(range(length(word))) as i from words)),
pairs as (
  select a.word, b.word as other, b.n as other_n from less a join less b on a.rest = b.rest and a.i = b.i and a.word <> b.word
  union
  select a.word, b.word, b.n from less a join words b on a.rest = b.word
  union
  select b.word, a.word, a.n from less a join words b on a.rest = b.word),
best as (
  select word, count(*) as n_near, max(other_n) as top_n,
         (list(other order by other_n desc, encode(other)))[1] as top from pairs group by word),
forms as (
  select w.word, w.n, coalesce(n_near, 0) as n_near, case when top_n >= 2 * w.n then top end as form,
         case when top_n >= 2 * w.n then top_n end as form_n from words w left join best b on w.word = b.word),
chain(word, last) as (
  select word, word from forms
  union all
  select c.word, f.form from chain c join forms f on c.last = f.word where f.form is not null)
select f.word, f.form, c.last as root, f.n, f.n_near, f.form_n
from forms f join chain c on f.word = c.word join forms e on c.last = e.word where e.form is null"""


#: What may follow each role before a place (0: none yet).
_AFTER = [("0", "s", "s"), ("0", "u", "u"), ("s", "u", "u"), ("u", "a", "a"), ("a", "u", "u")]
_NEXT = [("0", "u"), ("s", "u"), ("u", "a"), ("a", "u")]
_STEPS = f"""
steps(state, edits, role, target, cost) as (
  -- up to two turns inserted before a row is kept, changed or deleted; more never pay off
  with inserted(state, edits, rep, now, cost) as (
    select s, '', '', s, 0 from (values ('0'), ('s'), ('u'), ('a')) v(s)
    union all select s, 'I', n, n, 2 from (values {', '.join(f"('{s}', '{n}')" for s, n in _NEXT)}) v(s, n)
    union all select s, 'II', n || m, m, 4 from (values {', '.join(f"('{s}', '{n}', '{dict(_NEXT)[n]}')" for s, n in _NEXT)}) v(s, n, m))
  select i.state, i.edits || 'D', rep, i.now, i.cost + 3 from inserted i
  union all select i.state, i.edits || 'K' || f.a, rep, f.b, i.cost from inserted i
    join (values {', '.join(f"('{s}', '{a}', '{b}')" for s, a, b in _AFTER)}) f(s, a, b) on i.now = f.s
  union all select i.state, i.edits || 'R', rep, f.n, i.cost + 2 from inserted i
    join (values {', '.join(f"('{s}', '{n}')" for s, n in _NEXT)}) f(s, n) on i.now = f.s)"""

_CONV_KEY = "coalesce(cast(conv_id as varchar), ' ') || ':' || coalesce(cast(turn as varchar), ' ')"

CONVERSATION_REPAIR = f"""
with recursive {CRC_TABLE},{_STEPS},
hashed as (
  select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
         {crc(OCTETS.format(_CONV_KEY))} % 20 as h from conversations, crc_table),
damaged as (
  select conv_id, turn, case when h = 4 then 'user' else role end as role,
         case when h = 1 then '' when h = 2 then translate(text, '.!?', '') else text end as text
  from hashed, range(2) c(k) where h <> 0 and (k = 0 or h = 3)),
placed as (
  select *, row_number() over (partition by conv_id order by turn nulls first, role, sha256(text)) as i from damaged),
faults as (
  select *, substr(role, 1, 1) as initial,
    case when not regexp_matches(text, '[^ \\t\\n\\x0B\\f\\r]') then 'blank'
         when row_number() over (partition by conv_id, role, text order by i) > 1 then 'duplicate'
         when not regexp_matches(text, '[.!?][ \\t\\n\\x0B\\f\\r]*\\z') then 'truncated' else '' end as fault,
    lag(substr(role, 1, 1)) over (partition by conv_id order by i) as before
  from placed),
counted as (
  select conv_id, count(*) as n, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps,
    count_if(fault = 'blank') as blank, count_if(fault = 'duplicate') as duplicate, count_if(fault = 'truncated') as truncated,
    count_if(before is not null and before || initial not in ('su', 'ua', 'au')) as illegal
  from faults group by conv_id),
-- the cheapest, then ASCII-least edits up to each row, for each role they can end with
walk(conv_id, i, state, cost, audit, repaired) as (
  select conv_id, 0::bigint, '0', 0::bigint, '', []::varchar[] from counted
  union all
  select conv_id, i, state, cost, audit, repaired from (
    select *, row_number() over (partition by conv_id, state order by cost, audit) as best from (
      select w.conv_id, f.i, s.target as state,
        w.cost + s.cost + case when f.fault = 'truncated' and s.edits not like '%D' then 1 else 0 end as cost,
        w.audit || rtrim(s.edits, 'sua') as audit,
        list_concat(w.repaired, list_concat(
          list_transform(list_filter(string_split(s.role, ''), lambda c: c <> ''), lambda c: case c when 'u' then 'user:' else 'assistant:' end),
          case when s.edits like '%D' then []::varchar[]
               when s.edits like '%R' then [case s.target when 'u' then 'user:' else 'assistant:' end || f.text]
               else [f.role || ':' || f.text] end)) as repaired
      from walk w join faults f on f.conv_id is not distinct from w.conv_id and f.i = w.i + 1
      join steps s on s.state = w.state
      where case when f.fault in ('blank', 'duplicate') then s.edits like '%D'
                 when s.edits like '%K_' then right(s.edits, 1) = f.initial else true end))
  where best = 1),
ended as (
  select w.conv_id, w.cost + 2 * length(t.edits) as cost, w.audit || t.edits as audit,
    list_concat(w.repaired, t.more) as repaired
  from walk w join counted c on w.conv_id is not distinct from c.conv_id and w.i = c.n
  join (values ('0', '', []::varchar[]), ('a', '', []::varchar[]), ('u', 'I', ['assistant:']), ('s', 'II', ['user:', 'assistant:']))
    t(state, edits, more) on w.state = t.state),
chosen as (select * from (select *, row_number() over (partition by conv_id order by cost, audit) as best from ended) where best = 1)
select o.conv_id, coalesce(c.gaps, 0)::bigint as gaps, coalesce(c.blank, 0)::bigint as blank, coalesce(c.duplicate, 0)::bigint as duplicate,
  coalesce(c.truncated, 0)::bigint as truncated, coalesce(c.illegal, 0)::bigint as illegal,
  coalesce(e.cost, 0)::bigint as cost, coalesce(e.audit, '') as audit,
  sha256(coalesce(array_to_string(e.repaired, chr(10)), '')) as repaired_sha256
from (select distinct conv_id from conversations) o
left join counted c on o.conv_id is not distinct from c.conv_id
left join chosen e on o.conv_id is not distinct from e.conv_id"""


_WORD = "[^\\x20\\x09-\\x0D]+"

SUBSTRING_DEDUP = f"""
with words as (
  select doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') as w from documents),
windows as (
  select doc_id, k, array_to_string(w[k : k + 12], ' ') as gram
  from (select doc_id, w, unnest(range(1, len(w) - 11)) as k from words where len(w) >= 13)),
firsts as (select gram, min(doc_id) as first_doc from windows group by gram),
marked as (
  select doc_id, list(k) as begins from windows w join firsts f on w.gram = f.gram where f.first_doc < w.doc_id group by doc_id),
gone as (
  select doc_id, list_distinct(flatten(list_transform(begins, lambda k: range(k, k + 13)))) as places from marked),
kept as (
  select w.doc_id, len(w) as n_words, coalesce(len(g.places), 0) as n_removed,
    case when g.places is null then w
         else list_transform(list_filter(list_zip(w, range(1, len(w) + 1)), lambda x: not list_contains(g.places, x[2])), lambda x: x[1]) end as rest
  from words w left join gone g on w.doc_id = g.doc_id)
select doc_id, cast(n_words as bigint) as n_words, cast(n_removed as bigint) as n_removed,
  sha256(array_to_string(rest, ' ')) as kept_sha256 from kept"""

TOP_K = """
with vectors as (
  select vec_id, list_transform(embedding, lambda x: cast(floor(256 * cast(x as double)) as bigint)) as v from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(cast(x as double)))) = 0),
scored as (
  select q.vec_id as query_id, c.vec_id, cast(list_inner_product(cast(q.v as double[]), cast(c.v as double[])) as bigint) as score
  from vectors q join vectors c on q.vec_id % 50 = 0 and c.vec_id <> q.vec_id)
select query_id, cast(rank as int) as rank, vec_id, score from (
  select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from scored) where rank <= 5"""
