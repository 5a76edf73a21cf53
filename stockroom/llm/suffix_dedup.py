"""Repeated byte strings by suffix arrays, sorted in two stages.

Every 200-byte string is represented by the 32-byte gram of least hash in it,
so equal strings meet at equal grams and a run of neighbouring strings is one
row. Grams that occur once drop out. Runs equal as a whole are settled by
count. Where different runs share a gram, one run of each kind is cut out of
its text and the runs of a gram go to one suffix array (several grams share
one, up to a bounded size): only suffixes smaller than their successors are
sorted directly, the rest are induced by scanning the buckets of first bytes in
rising order, and adjacent suffixes with a common prefix of 200 bytes or more
are repeated.

A gram with very many different runs is split: its strings go by their gram's
place (16 places a part) and by the hash of the 185 bytes that those strings
share, so that no group grows with the corpus unless the strings themselves
are the same.

Defined results: null and empty texts have no bytes; texts under 200 bytes lose
nothing; a null doc_id's row loses nothing and takes no part; doc_id stands for
one text; a copy of a document loses all its bytes (200 or more); empty tables
give no rows; extra columns are ignored. Runs are equated by two 64-bit hashes,
strings inside suffix arrays byte by byte.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from stockroom.llm.textbytes import (BLOB, U64, bucket_count, by_bucket, column, from_blobs, group_edges, longs, mix64,
                                     slices, sliding_min, string_bytes, to_blobs)

LENGTH, GRAM = 200, 32
SPAN = LENGTH - GRAM + 1
HOT_RUNS, HOT_PLACES = 2048, 16
SLICE_BYTES, SEGMENT, ARRAY_BYTES = 1 << 20, 1 << 22, 1 << 22
FLUSH_ROWS = 1 << 19
COVER, LOOK, GIVE, HOT = 0, 1 << 16, 2 << 16, 4 << 16
MARK = 20
POSITION_BITS = U64(24)
_COEF = mix64(np.arange(901, 901 + LENGTH // 8, dtype=np.uint64)) | U64(1)


def eights(data: np.ndarray, big: bool = False) -> np.ndarray:
    """The eight bytes from each position on as one number (len - 7 of them)."""
    v = data.astype(np.uint64)
    for bits, by in ((8, 1), (16, 2), (32, 4)):
        a, b = v[:-by], v[by:]
        v = (a << U64(bits)) | b if big else a | (b << U64(bits))
    return v


def string_hash(v8: np.ndarray, at: np.ndarray, words: int) -> np.ndarray:
    """Hash of the ``8 * words`` bytes from each position ``at`` on."""
    h = np.zeros(len(at), np.uint64)
    for j in range(words):
        h += v8[at + 8 * j] * _COEF[j]
        if j % 4 == 3:
            h = mix64(h)
    return mix64(h)


def runs(data: np.ndarray, offsets: np.ndarray):
    """Runs of 200-byte strings that share their least gram: gram hash, hash of
    the run's bytes, document, first string, gram's place, strings."""
    n = len(data) - LENGTH + 1
    z = np.zeros(0, np.int64)
    if n <= 0:
        return z.view(np.uint64), z.view(np.uint64), z, z, z, z
    v8 = eights(data)
    m = len(data) - GRAM + 1
    h = v8[:m] * _COEF[0]
    for j in range(1, GRAM // 8):
        h += v8[8 * j:8 * j + m] * _COEF[j]
    h = mix64(h)
    doc_of = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))[:n]
    inside = offsets[1:][doc_of] - np.arange(n) >= LENGTH
    place = np.empty(n, np.int64)
    for s in range(0, n, SEGMENT):
        e = min(s + SEGMENT, n)
        part = h[s:e + SPAN - 1]
        least = sliding_min((part >> POSITION_BITS << POSITION_BITS) | np.arange(len(part), dtype=np.uint64), SPAN)
        place[s:e] = s + (least & U64((1 << 24) - 1)).astype(np.int64)[:e - s]
    change = np.r_[True, place[1:] != place[:-1]]
    opens = inside & (change | np.r_[True, ~inside[:-1]])
    shuts = inside & np.r_[change[1:] | ~inside[1:], True]
    st, en = np.flatnonzero(opens), np.flatnonzero(shuts)
    # First and last string together cover the run.
    whole = mix64(string_hash(v8, st, LENGTH // 8) * U64(3) + string_hash(v8, en, LENGTH // 8)
                  + (en - st).astype(np.uint64))
    doc = doc_of[st]
    return h[place[st]], whole, doc, st - offsets[doc], place[st] - st, en - st + 1


def _scan(n_buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for batch in batches:
            ids = longs(batch, "doc_id")
            data, offsets = string_bytes(column(batch, "text"))
            for i, j in slices(offsets, SLICE_BYTES):
                off = offsets[i:j + 1]
                g, w, d, s, r, n = runs(data[off[0]:off[-1]], off - off[0])
                held.append((g, w, ids[i:j][d], s, r, n))
                rows += len(g)
                if rows >= FLUSH_ROWS:
                    yield from _send(held, n_buckets)
                    held, rows = [], 0
        if rows:
            yield from _send(held, n_buckets)
    return run


def _send(held: list, n_buckets: int) -> Iterator[pa.RecordBatch]:
    g, w, d, s, r, n = (np.concatenate(c) for c in zip(*held))
    order = np.lexsort((w, g))
    e = group_edges(g[order], w[order])
    size = np.empty(len(g), np.int64)
    size[order] = np.repeat(np.diff(e), np.diff(e))
    settled = size > 1   # the same run twice in this batch
    if settled.any():
        yield to_blobs((d[settled] * 0x9E3779B1 % n_buckets).astype(np.int64), 0,
                       [(d[settled].astype(np.int64), 8), (s[settled].astype(np.int64), 5), (n[settled].astype(np.int64), 1)], 0)
    first = np.zeros(len(g), bool)
    first[order[e[:-1]]] = True
    twice = (size > 1).astype(np.int64)
    k = first
    yield to_blobs((g[k] % U64(n_buckets)).astype(np.int64), 1,
                   [(g[k] >> U64(8), 7), (w[k], 8), (d[k].astype(np.int64), 8), (s[k].astype(np.int64), 5),
                    (r[k].astype(np.int64), 1), (n[k].astype(np.int64), 1), (twice[k], 1)], 2)


def _rows(doc, start, code) -> pa.RecordBatch:
    mark = (start.astype(np.int64) << MARK) | code.astype(np.int64)
    return pa.RecordBatch.from_arrays([pa.array(doc.astype(np.int64)), pa.array(mark)], names=["doc_id", "mark"])


def _resolve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Marks: settled runs, and one run of each kind where kinds differ."""
    for _, kinds in by_bucket(batches):
        if 0 in kinds:
            d, s, n = from_blobs(kinds[0], [8, 5, 1], 0)
            yield _rows(d.view(np.int64), s, n)
        if 1 not in kinds:
            continue
        g, w, d, s, r, n, t = from_blobs(kinds[1], [7, 8, 8, 5, 1, 1, 1], 2)
        order = np.lexsort((w, g))
        g, w, d, s, r, n, t = (x[order].view(np.int64) for x in (g, w, d, s, r, n, t))
        e, f = group_edges(g), group_edges(g, w)
        times = np.add.reduceat(t + 1, f[:-1])
        again = np.repeat(times > 1, np.diff(f))
        yield _rows(d[again], s[again], n[again] + COVER)
        kinds_of = np.diff(np.searchsorted(f[:-1], e))          # different runs per gram
        many = np.repeat(kinds_of, np.diff(e))
        one = np.zeros(len(g), bool)
        one[f[:-1]] = True                                       # one run of each kind
        k = one & (many > 1)
        code = n + (r << 8) + np.where(again, GIVE, LOOK) + np.where(many > HOT_RUNS, HOT, 0)
        yield _rows(d[k], s[k], code[k])


PIECES = "key long, doc_id long, start long, n int, wanted boolean, body binary"


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Bytes of the runs to compare, keyed by what their strings share."""
    for batch in batches:
        marks = column(batch, "marks")
        out = []
        for k in np.flatnonzero(marks.is_valid().to_numpy(zero_copy_only=False)).tolist():
            v = marks[k].values.to_numpy(zero_copy_only=False).astype(np.int64)
            v = v[(v >> 16 & 3) != 0]
            if not len(v):
                continue
            body = column(batch, "text")[k].as_py().encode()
            d = column(batch, "doc_id")[k].as_py()
            data = np.frombuffer(body, np.uint8)
            start, n, rel = v >> MARK, v & 255, v >> 8 & 255
            wanted, hot = (v & LOOK) != 0, (v & HOT) != 0
            v8 = eights(data)
            q = start + rel
            cold = ~hot
            keys = string_hash(v8, q[cold], GRAM // 8)
            for a, c, w, key in zip(start[cold].tolist(), n[cold].tolist(), wanted[cold].tolist(), keys.view(np.int64).tolist()):
                out.append((key, d, a, c, w, body[a:a + c + LENGTH - 1]))
            for a, c, w, p in zip(start[hot].tolist(), n[hot].tolist(), wanted[hot].tolist(), q[hot].tolist()):
                for part in range((p - (a + c - 1)) // HOT_PLACES, (p - a) // HOT_PLACES + 1):
                    lo, hi = max(a, p - HOT_PLACES * part - HOT_PLACES + 1), min(a + c - 1, p - HOT_PLACES * part)
                    # Eight bytes fewer than shared, to count in eights.
                    shared = string_hash(v8, np.array([p - HOT_PLACES * part]), (LENGTH - HOT_PLACES) // 8)[0]
                    key = int(mix64(np.array([shared + U64(part + 1)]))[0].view(np.int64))
                    out.append((key, d, lo, hi - lo + 1, w, body[lo:hi + LENGTH]))
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.bool_(), pa.binary())
        for i in range(0, len(out), 20_000):
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out[i:i + 20_000]), kinds)],
                                             names=["key", "doc_id", "start", "n", "wanted", "body"])


def _refine(keys: np.ndarray, pos: np.ndarray, length: int) -> np.ndarray:
    """``pos`` sorted by the ``length`` bytes that follow: eight at a time,
    only among those still equal."""
    order = np.argsort(keys[pos], kind="stable")
    pos = pos[order]
    e = group_edges(keys[pos])
    group = np.repeat(np.arange(len(e) - 1), np.diff(e))
    tied = np.repeat(np.diff(e) > 1, np.diff(e))
    for at in range(8, length, 8):
        t = np.flatnonzero(tied)
        if not len(t):
            break
        k, g = keys[pos[t] + at], group[t]
        o = np.lexsort((k, g))
        pos[t] = pos[t][o]
        k = k[o]
        e = group_edges(g, k)
        size = np.diff(e)
        group[t] = np.repeat(t[e[:-1]], size)
        tied[t] = np.repeat(size > 1, size)
    return pos


def suffix_array(text: np.ndarray, wanted: np.ndarray, length: int = LENGTH) -> np.ndarray:
    """Positions of ``wanted`` (a mask) in order of their suffixes, exact up to
    ``length`` bytes.

    Stage one sorts the suffixes smaller than their successors; stage two takes
    the buckets of first bytes in rising order, each complete once all smaller
    ones are, and appends the predecessors of its suffixes, in order, to the
    buckets of their own first bytes."""
    n = len(text)
    padded = np.concatenate([text, np.zeros(length + 8, np.uint8)])
    differs = np.flatnonzero(np.r_[text[1:] != text[:-1], True])   # last place of each byte run
    run_end = differs[np.searchsorted(differs, np.arange(n))]
    after = padded[run_end + 1]
    smaller = text < after                       # than its successor; the text's end counts as least
    smaller[run_end == n - 1] = False
    # Larger suffixes are induced through all that follow up to a smaller one.
    edge = np.zeros(n + 1, np.int64)
    stop = np.where(smaller, np.arange(n), n - 1)
    stop = np.minimum.accumulate(stop[::-1])[::-1]
    begin = np.flatnonzero(wanted)
    np.add.at(edge, begin, 1)
    np.add.at(edge, stop[begin] + 1, -1)
    need = np.cumsum(edge[:-1]) > 0
    keys = eights(padded, big=True)
    direct = _refine(keys, np.flatnonzero(need & smaller), length)
    first = text[direct]
    cut = np.searchsorted(first, np.arange(257))
    induced: list[list[np.ndarray]] = [[] for _ in range(256)]
    if need[n - 1]:
        induced[int(text[n - 1])].append(np.array([n - 1]))   # smallest suffix of its bucket
    larger = need & ~smaller
    out = []
    for c in range(256):
        head = np.concatenate(induced[c]) if induced[c] else np.zeros(0, np.int64)
        chain, now = [head], head
        while len(now):                          # runs of the bucket's own byte
            now = now[now > 0] - 1
            now = now[larger[now] & (text[now] == c)]
            chain.append(now)
        bucket = np.concatenate([*chain, direct[cut[c]:cut[c + 1]]])
        if not len(bucket):
            continue
        out.append(bucket)
        before = bucket[bucket > 0] - 1
        before = before[larger[before] & (text[before] > c)]
        if len(before):
            own = text[before]
            o = np.argsort(own, kind="stable")
            before, own = before[o], own[o]
            e = group_edges(own)
            for i, j in zip(e[:-1].tolist(), e[1:].tolist()):
                induced[int(own[i])].append(before[i:j])
    order = np.concatenate(out) if out else np.zeros(0, np.int64)
    return order[wanted[order]]


def common_prefix(text: np.ndarray, order: np.ndarray, length: int = LENGTH) -> np.ndarray:
    """Common prefix of each suffix with the one before it in ``order``, in
    whole eights up to ``length``."""
    keys = eights(np.concatenate([text, np.zeros(length + 8, np.uint8)]))
    out = np.zeros(len(order), np.int64)
    live = np.arange(1, len(order))
    for at in range(0, length, 8):
        live = live[keys[order[live] + at] == keys[order[live - 1] + at]]
        if not len(live):
            break
        out[live] += 8
    return out


def repeated_starts(bodies: list[bytes], counts: np.ndarray, length: int = LENGTH) -> np.ndarray:
    """Mask over all starts (``counts`` of each body, one after another): does
    its string of ``length`` bytes start in another place as well?"""
    text = np.frombuffer(b"".join(bodies), np.uint8)
    begin = np.cumsum([0, *map(len, bodies)])[:-1]
    first = np.cumsum(counts) - counts
    start = np.repeat(begin - first, counts) + np.arange(int(counts.sum()))
    wanted = np.zeros(len(text), bool)
    wanted[start] = True
    order = suffix_array(text, wanted, length)
    same = common_prefix(text, order, length) >= length
    again = same | np.r_[same[1:], False]
    mask = np.zeros(len(text), bool)
    mask[order[again]] = True
    return mask[start]


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One suffix array for each stretch of keys of a bounded size."""
    def settle(rows):
        counts = np.array([r[2] for r in rows], np.int64)
        again = repeated_starts([r[4] for r in rows], counts)
        wanted = np.repeat(np.array([r[3] for r in rows]), counts)
        owner = np.repeat(np.arange(len(rows)), counts)
        step = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
        hit = again & wanted
        opens = hit & ~np.r_[False, hit[:-1] & (owner[1:] == owner[:-1])]
        shuts = hit & ~np.r_[hit[1:] & (owner[1:] == owner[:-1]), False]
        a, b = np.flatnonzero(opens), np.flatnonzero(shuts)
        docs, starts = np.array([r[0] for r in rows], np.int64), np.array([r[1] for r in rows], np.int64)
        return _rows(docs[owner[a]], starts[owner[a]] + step[a], b - a + 1)

    held, size, last = [], 0, None
    for batch in batches:
        cols = [column(batch, c).to_pylist() for c in ("key", "doc_id", "start", "n", "wanted", "body")]
        for key, *row in zip(*cols):
            if size >= ARRAY_BYTES and key != last:
                yield settle(held)
                held, size = [], 0
            held.append(row)
            size += len(row[4])
            last = key
    if held:
        yield settle(held)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        marks = [column(batch, c) for c in ("marks", "more")]
        for k, (d, t) in enumerate(zip(column(batch, "doc_id").to_pylist(), column(batch, "text").to_pylist())):
            body = (t or "").encode()
            gone, spans = removed_spans(len(body), [m[k].values.to_numpy(zero_copy_only=False)
                                                    for m in marks if m[k].is_valid])
            if gone is None:
                kept, n = body, 0
            else:
                kept, n = np.frombuffer(body, np.uint8)[~gone].tobytes(), int(gone.sum())
            rows.append((d, len(body), n, spans, hashlib.sha256(kept).hexdigest()))
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string())
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * 5, kinds)],
                                         names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])


def removed_spans(n_bytes: int, marks: list) -> tuple[np.ndarray | None, int]:
    """Mask of removed bytes (None: nothing) and number of maximal runs."""
    v = np.concatenate(marks).astype(np.int64) if marks else np.zeros(0, np.int64)
    v = v[(v >> 16 & 3) == 0]
    if not len(v):
        return None, 0
    edge = np.zeros(n_bytes + 1, np.int64)
    np.add.at(edge, v >> MARK, 1)
    np.add.at(edge, (v >> MARK) + (v & 255) - 1 + LENGTH, -1)
    gone = np.cumsum(edge[:-1]) > 0
    return gone, int((gone & ~np.r_[False, gone[:-1]]).sum())


def repeated_strings(docs: DataFrame) -> DataFrame:
    """doc_id, text and its marks (``marks``, ``more``; see removed_spans)."""
    nb = bucket_count(docs.sparkSession)
    docs = docs.select("doc_id", "text")
    held = docs.repartition("doc_id")   # the texts are shuffled once; both joins reuse it

    def gather(rows: DataFrame) -> DataFrame:
        return rows.groupBy("doc_id").agg(F.collect_list("mark").alias("marks"))

    seeds = docs.where("doc_id is not null").mapInArrow(_scan(nb), BLOB)
    first = gather(seeds.repartition("bucket").sortWithinPartitions("bucket")
                   .mapInArrow(_resolve, "doc_id long, mark long"))
    pieces = held.join(first, "doc_id", "left").mapInArrow(_cut, PIECES)
    more = gather(pieces.repartition("key").sortWithinPartitions("key")
                  .mapInArrow(_compare, "doc_id long, mark long"))
    return held.join(first, "doc_id", "left").join(more.withColumnRenamed("marks", "more"), "doc_id", "left")


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes left of every document."""
    return repeated_strings(spark.read.parquet(f"{sf_dir}/documents.parquet")).mapInArrow(
        _digests, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
