"""op11, op12 and op13 against brute force: odd rows, crowded groups, long texts."""

import collections
import hashlib
import heapq
import random
import re
import zlib

import duckdb
import numpy as np
import pytest
import xxhash

from stockroom.llm import conversation_repair as repair, oracles, simhash_golay as simhash, spelling_variants as spelling

DOCS = "doc_id long, text string, word string, node string, n long, key int, fp string"


def _lower(t):
    return "".join(chr(ord(x) + 32) if "A" <= x <= "Z" else x for x in t)


# ---------------------------------------------------------------- spelling variants

def _variants(docs):
    count = collections.Counter()
    for i, t in docs:
        for run in map(_lower, re.findall("[A-Za-zÀ-ÿ]+", t or "")):
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 97 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            count[run] += 1
    v = {w: n for w, n in count.items() if len(w) >= 5 and n >= 3}
    near = {w: [x for x in v if spelling.near(w, x)] for w in v}
    best = {w: min(near[w], key=lambda x: (-v[x], x), default=None) for w in v}
    form = {w: b if b is not None and v[b] >= 2 * v[w] else None for w, b in best.items()}
    out = set()
    for w in v:
        root = w
        while form[root]:
            root = form[root]
        out.add((w, form[w], root, v[w], len(near[w]), v[form[w]] if form[w] else None))
    return out


def _edit(rng, w):
    i = rng.randrange(len(w) + 1)
    c = rng.choice("aeßé")
    return rng.choice([w[:i] + c + w[i:], w[:i] + c + w[i + 1:], w[:i] + w[i + 1:]])


@pytest.fixture(scope="module")
def prose():
    rng = random.Random(11)
    base = ["".join(rng.choice("abcdeéÀ") for _ in range(rng.randint(4, 9))) for _ in range(40)]
    words = base * 6 + [_edit(rng, w) for w in base for _ in range(4)] + ["banana", "abnana", "bananna", "x" * 300, "x" * 301] * 5
    docs = [(i, " ".join(rng.choice(words) for _ in range(300)) + " THE Thé, a1b2") for i in range(12)]
    docs += [(12, None), (13, ""), (14, "1 2 3"), (None, "Banana " * 7), docs[0], docs[0], (15, "word×word " * 9)]
    return docs


def _got(spark, docs):
    rows = [(i, t, "w", "n", 1, 1, "f") for i, t in docs]
    out = spelling.spelling_variants(spark, spark.createDataFrame(rows, DOCS).repartition(3)).collect()
    assert len(out) == len({r.word for r in out})
    return {tuple(r) for r in out}


def test_spelling_variants(spark, prose):
    want = _variants(prose)
    assert _got(spark, prose) == want and any(r[1] for r in want)
    assert _got(spark, [(1, None), (2, "")]) == set() == _got(spark, [])


@pytest.mark.parametrize("limit, visits", [(4, 1 << 20), (2048, 60), (0, 0)])
def test_spelling_crowded_nodes_go_deeper_and_end_in_deletions(spark, prose, monkeypatch, limit, visits):
    monkeypatch.setattr(spelling, "LIMIT", limit)
    monkeypatch.setattr(spelling, "VISITS", visits)
    assert _got(spark, prose) == _variants(prose)


@pytest.mark.parametrize("lengths", [(3, 6), (45, 52), (300, 303)])
def test_spelling_trie_finds_each_pair_once(lengths):
    rng = random.Random(2)
    base = ["".join(rng.choice("abqr") for _ in range(rng.randint(*lengths))) for _ in range(60)]
    words = sorted({w for w in base} | {_edit(rng, w) for w in base for _ in range(4)})
    node = spelling.Node(0, [(spelling.vector(w), w, 1) for w in words])
    asks = [(spelling.vector(w), 1, 1, w) for w in words]
    got = [tuple(sorted((words[x], node.words[y]))) for a, b in node.pairs(asks) for x, y in zip(a, b)]
    assert len(got) == len(set(got))
    assert set(got) == {(x, y) for x in words for y in words if x < y and spelling.near(x, y)}


def test_spelling_text_in_steps(monkeypatch):
    text = "alpha " * 40 + "b" * 200 + " Gamma-delta"
    whole = spelling.text_words(5, text)
    monkeypatch.setattr(spelling, "STEP", 7)
    monkeypatch.setattr(spelling, "HELD", 2)
    assert spelling.text_words(5, text) == whole


def test_spelling_roots_follow_long_chains(spark):
    rows = [(f"w{i}", f"w{i + 1}" if i < 9 else None) for i in range(10)]
    got = spelling.roots(spark.createDataFrame(rows, "word string, form string")).collect()
    assert {r.word: r.root for r in got} == {f"w{i}": "w9" for i in range(10)}


def test_spelling_sql(spark, prose):
    con = duckdb.connect()
    con.execute("create table documents (doc_id bigint, text varchar)")
    con.executemany("insert into documents values (?, ?)", prose)
    assert set(con.execute(oracles.SPELLING_VARIANTS).fetchall()) == _variants(prose)


# ---------------------------------------------------------------- SimHash

def _fingerprint(t):
    w = re.findall("[^\x20\x09-\x0D]+", _lower(t or ""))
    grams = [" ".join(w[k:k + 3]) for k in range(len(w) - 2)] if len(w) > 2 else [" ".join(w)] if w else []
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def _components(fps):
    """Least position reachable, for each fingerprint."""
    out = []
    todo = dict(enumerate(fps))
    label = {}
    for i in list(todo):
        if i in label:
            continue
        heap, label[i] = [i], i
        while heap:
            a = heap.pop()
            for b in todo:
                if b not in label and (fps[a] ^ fps[b]).bit_count() <= 2:
                    label[b] = i
                    heap.append(b)
    for i in range(len(fps)):
        out.append(label[i])
    return out


def test_fingerprints(spark):
    rng = random.Random(4)
    say = lambda n: " ".join(rng.choice(["Ab", "c", "dé", "\U0001F642", "x y", "Q" * 50]) for _ in range(n))
    texts = [None, "", " \n", "one", "One  two", "a b c", "a b\tc d", say(500), " " + say(3) + "\n", say(70_000), "A", "a"]
    docs = spark.createDataFrame([(i, t, "w", "n", 1, 1, "f") for i, t in enumerate(texts)], DOCS)
    got = {r.doc_id: r.fp % (1 << 64) for r in simhash.document_fingerprints(docs).collect()}
    assert got == {i: _fingerprint(t) for i, t in enumerate(texts)}


def test_golay_keys_meet_at_one_error():
    g = simhash.golay()
    assert len(set(g.error.tolist())) == 2048 and max(x.bit_count() for x in g.error.tolist()) == 3
    rng = np.random.default_rng(3)
    words = rng.integers(0, 1 << 23, 3000).astype(np.uint32)
    near = g.near(words, 23)
    assert {len(set(r)) for r in near.tolist()} <= {1, 6}      # the two cases of the perfect code
    for bit in range(23):
        assert all(x in r for x, r in zip(g.index(words ^ np.uint32(1 << bit)).tolist(), near.tolist()))


def test_keys_of_linked_fingerprints_meet():
    rng = random.Random(8)
    a = [rng.getrandbits(64) for _ in range(400)]
    b = [x ^ 1 << rng.randrange(64) ^ 0 for x in a[:200]] + [x ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) for x in a[200:]]
    for x, y in zip(a, b):
        assert set(simhash.keys(np.array([x], np.uint64))[1].tolist()) & set(simhash.keys(np.array([y], np.uint64))[1].tolist())


@pytest.mark.parametrize("crowd", [1024, 3, 0])
def test_simhash_components(spark, monkeypatch, crowd):
    monkeypatch.setattr(simhash, "CROWD", crowd)
    rng = random.Random(6)
    fps = [0, 1, 7, rng.getrandbits(64)]
    for _ in range(60):
        x = rng.choice(fps)
        for _ in range(rng.choice([1, 2, 2, 3, 5])):
            x ^= 1 << rng.randrange(64)
        fps.append(x)
    fps += [rng.getrandbits(64) for _ in range(20)]
    signed = [x - (1 << 64) if x >> 63 else x for x in fps]
    distinct = spark.createDataFrame([(x,) for x in sorted(set(signed))], "fp long").repartition(3)
    from stockroom.llm.chosen_path import components
    root = {r.node: r.root for r in components(simhash.links(distinct)).collect()}
    classes = collections.defaultdict(set)
    for x, c in zip(signed, _components(fps)):
        classes[c].add(root.get(x, x))
    assert all(len(c) == 1 for c in classes.values()) and len({min(c) for c in classes.values()}) == len(classes)


def test_simhash_documents(spark):
    rng = random.Random(9)
    base = [rng.choice("abcdefgh") * rng.randint(1, 4) for _ in range(900)]
    texts = [(i, t) for i, t in enumerate([None, "", "  ", "x y", "X Y", " ".join(base), " ".join(base)])]
    for i in range(7, 30):
        w = list(base)
        w[rng.randrange(900)] = "other"
        texts.append((i, " ".join(w)))
    texts += [(None, "x y"), (None, "only nulls here today"), texts[5]]
    docs = spark.createDataFrame([(i, t, "w", "n", 1, 1, "f") for i, t in texts], DOCS).repartition(4)
    fps = [_fingerprint(t) for _, t in texts]
    label = _components(fps)
    least = {c: min((i for (i, _), x in zip(texts, label) if x == c and i is not None), default=None) for c in set(label)}
    got = sorted((tuple(r) for r in simhash.simhash_components(spark, docs).collect()), key=repr)
    signed = [x - (1 << 64) if x >> 63 else x for x in fps]
    assert got == sorted(((i, f, least[c]) for (i, _), f, c in zip(texts, signed, label)), key=repr)
    assert simhash.simhash_components(spark, docs.where("false")).count() == 0


# ---------------------------------------------------------------- conversation repair

def _dijkstra(rows, faults):
    """Cheapest, then ASCII-least edits and the repaired rows."""
    follows = {"0": "su", "s": "u", "u": "a", "a": "u"}
    heap, done = [(0, "", 0, "0", ())], set()
    while heap:
        cost, audit, i, s, out = heapq.heappop(heap)
        if i == len(rows) and s in "0a":
            return cost, audit, out
        if (i, s) in done:
            continue
        done.add((i, s))
        turn = {"u": "assistant"}.get(s, "user")
        heapq.heappush(heap, (cost + 2, audit + "I", i, turn[0], (*out, turn + ":")))
        if i < len(rows):
            role, text = rows[i]
            heapq.heappush(heap, (cost + 3, audit + "D", i + 1, s, out))
            if faults[i] in ("", "t"):
                extra = faults[i] == "t"
                heapq.heappush(heap, (cost + 2 + extra, audit + "R", i + 1, turn[0], (*out, f"{turn}:{text}")))
                if role and role[0] in follows[s]:
                    heapq.heappush(heap, (cost + extra, audit + "K", i + 1, role[0], (*out, f"{role}:{text}")))


def _repair_brute(table):
    by = collections.defaultdict(list)
    for c, t, role, text in table:
        by[c].append((t, role, text))
    out = set()
    for c, found in by.items():
        rows = []
        for t, role, text in found:
            role, text = (" " if x is None else x for x in (role, text))
            h = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
            text = "" if h == 1 else re.sub("[.!?]", "", text) if h == 2 else text
            rows += [(t, "user" if h == 4 else role, text)] * (0 if h == 0 else 2 if h == 3 else 1)
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).digest()))
        faults, seen = [], set()
        for _, role, text in rows:
            signs = re.findall("[^\x20\x09-\x0D]", text)
            faults.append("b" if not signs else "d" if (role, text) in seen else "t" if signs[-1] not in ".!?" else "")
            seen.add((role, text))
        at = [t for t, _, _ in rows if t is not None]
        gaps = max(at) - min(at) + 1 - len(set(at)) if at else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
        cost, audit, kept = _dijkstra([r[1:] for r in rows], faults)
        out.add((c, gaps, *(faults.count(x) for x in "bdt"), illegal, cost, audit,
                 hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return out


def _talk(rng, conv, n):
    say = lambda: rng.choice(["Yes.", "No", "Well ", "Go on!\n", "", " \t", "One. Two? ", "Hm", "é" * 9 + "."]) + str(rng.choice([".", 1, ""]))
    roles = ["user", "assistant"] * 5 + ["system", "tool", "", None, "User"]
    return [(conv, rng.choice([k, k, k, None if k % 5 == 0 else k, k + 3]), rng.choice(roles),
             rng.choice([f"{say()} {k}.", say(), None])) for k in range(n)]


@pytest.fixture(scope="module")
def talks():
    rng = random.Random(13)
    out = [r for c in range(60) for r in _talk(rng, c, rng.randint(1, 9))]
    out += _talk(rng, None, 30) + [out[3], out[3], out[10]]
    out += [(1000, k, ("user", "assistant")[k % 2 if k % 7 else 0], f"turn {k}" + "."[:k % 3]) for k in range(900)]    # many pieces
    out += [(1001, 1, "user", "same.")] * 600                                                   # one row, repeated
    out += [(c, t, "user", "x.") for c in range(2000, 2040) for t in (1,)]                       # some lose all rows
    return out


CONV = "conv_id long, turn long, role string, text string, kind int, audit string, piece long"


def test_conversation_repair(spark, talks):
    table = spark.createDataFrame([(*r, 1, "x", 2) for r in talks], CONV).repartition(5)
    want = _repair_brute(talks)
    got = [tuple(r) for r in repair.repair_digests(table).collect()]
    assert len(got) == len(want) and set(got) == want
    assert any(r[7] == "" for r in want)
    assert repair.repair_digests(table.where("false")).count() == 0


def test_repaired_turns_are_the_digested_ones(spark, talks):
    table = spark.createDataFrame([(*r, 1, "x", 2) for r in talks], CONV)
    by = collections.defaultdict(dict)
    for r in repair.repaired_turns(table).collect():
        by[r.conv_id][r.position] = f"{r.role}:{r.text}"
    for r in repair.repair_digests(table).collect():
        rows = by.get(r.conv_id, {})
        assert sorted(rows) == list(range(len(rows)))
        assert hashlib.sha256("\n".join(rows[k] for k in range(len(rows))).encode()).hexdigest() == r.repaired_sha256


def test_repair_of_very_long_texts(spark):
    rows = [(1, 1, "user", "w " * 2_000_000), (1, 2, "assistant", "y." * 1_000_000), (2, 1, "user", "a.")]
    got = {tuple(r) for r in repair.repair_digests(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()}
    assert got == _repair_brute(rows)


def test_search_equals_dijkstra_and_pieces_join():
    rng = random.Random(1)
    letters, names = "suatu", ["", "t", "b", "d"]
    for n in [0, 1, 2, 3, 8, 20, 60] * 12:
        roles = "".join(rng.choice(letters) for _ in range(n))
        kinds = [rng.choice([0, 0, 0, 1, 2, 3]) for _ in range(n)]
        cost, audit, _ = _dijkstra([(r, "") for r in roles], [names[k] for k in kinds])
        assert repair.cheapest(roles, kinds) == (cost, audit)
        fold, at = repair._Fold(), 0
        while at < n:
            till = min(n, at + rng.randint(1, 25))
            fold.add(None, None, 0, "u", "a", (0, 0, 0, 0), repair.piece_paths(roles[at:till], kinds[at:till], False))
            at = till
        assert fold.row()[-2:] == (cost, audit)


def test_repair_sql(talks):
    con = duckdb.connect()
    con.execute("create table conversations (conv_id bigint, turn bigint, role varchar, text varchar)")
    some = [r for r in talks if r[0] is None or r[0] != 1000]     # the list of one long conversation is slow in SQL
    con.executemany("insert into conversations values (?, ?, ?, ?)", some)
    assert set(con.execute(oracles.CONVERSATION_REPAIR).fetchall()) == _repair_brute(some)
