"""Repeated word windows across documents, found by level-wise doubling.

Only what is repeated at one length is looked at with twice that length:

1. Four words. Every 13-word window is represented by the four-word gram of
   least hash in it (neighbouring windows mostly share one, so a run of windows
   is one row). Grams of a single document drop out with all their windows.
   Runs whose whole text stands in a smaller document are settled here.
2. Eight words: the gram and the four words to its right, or to its left for
   windows that end before that. Those of a single document drop out.
3. Thirteen words (twice eight, cut at the wanted length): each window left is
   compared itself.

Rows travel as packed blobs dealt by hash into as many buckets as the session
has shuffle partitions (times eight). Equal runs inside one batch are settled
before the shuffle, so a passage in a third of all documents costs a row a
batch; what differs around it spreads over the later levels' longer hashes.

Defined results: null and empty texts have no words and an empty rest; a null
doc_id neither loses nor takes words; doc_id stands for one text, so repeated
rows lose the same words; empty tables give no rows; extra columns are ignored.
Windows are compared by 64 bits of one hash and the bucket of another.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from stockroom.llm.textbytes import (BLOB, U64, bucket_count, by_bucket, column, from_blobs, gram_hashes, group_edges,
                                     longs, mix64, slices, sliding_min, string_bytes, to_blobs, word_hashes, word_spans)

WINDOW, GRAM, MIDDLE = 13, 4, 8
SPAN = WINDOW - GRAM + 1          # grams in a window, and windows in a run at most
SLICE_BYTES, SEGMENT = 1 << 20, 1 << 22
POSITION_BITS = U64(24)
FLUSH_ROWS = 1 << 20
MARK = 10                         # low bits of a mark hold its code
ROWS = "doc_id long, mark long"


def _rows(doc: np.ndarray, start: np.ndarray, code: np.ndarray) -> pa.RecordBatch:
    mark = (start.astype(np.int64) << MARK) | code.astype(np.int64)
    return pa.RecordBatch.from_arrays([pa.array(doc.astype(np.int64)), pa.array(mark)], names=["doc_id", "mark"])


class Words:
    """Words of some documents, with hashes of their grams on demand."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        starts, ends, self.first = word_spans(data, offsets)
        self.hash = word_hashes(data, starts, ends)
        self.doc = np.repeat(np.arange(len(offsets) - 1), np.diff(self.first))

    def gram(self, k: int, second: bool = False) -> np.ndarray:
        return gram_hashes(mix64(self.hash ^ U64(0x5851F42D4C957F2D)) if second else self.hash, k)


def runs(words: Words):
    """Runs of windows that share their least gram: gram hash, hash of all the
    run's words, document, first window (in the document), gram's place, windows."""
    g4, g13 = words.gram(GRAM), words.gram(WINDOW)
    n = len(g13)
    if n <= 0:
        z = np.zeros(0, np.int64)
        return z.view(np.uint64), z.view(np.uint64), z, z, z, z
    inside = words.first[1:][words.doc[:n]] - np.arange(n) >= WINDOW
    place = np.empty(n, np.int64)
    for s in range(0, n, SEGMENT):
        e = min(s + SEGMENT, n)
        part = g4[s:e + SPAN - 1]
        least = sliding_min((part >> POSITION_BITS << POSITION_BITS) | np.arange(len(part), dtype=np.uint64), SPAN)
        place[s:e] = s + (least & U64((1 << 24) - 1)).astype(np.int64)[:e - s]
    change = np.r_[True, place[1:] != place[:-1]]
    opens = inside & (change | np.r_[True, ~inside[:-1]])
    shuts = inside & np.r_[change[1:] | ~inside[1:], True]
    st, en = np.flatnonzero(opens), np.flatnonzero(shuts)
    whole = mix64(g13[st] * U64(3) + mix64(g13[en] + (en - st).astype(np.uint64)))
    doc = words.doc[st]
    return g4[place[st]], whole, doc, st - words.first[doc], place[st] - st, en - st + 1


def _scan(n_buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for batch in batches:
            ids = longs(batch, "doc_id")
            data, offsets = string_bytes(column(batch, "text"))
            for i, j in slices(offsets, SLICE_BYTES):
                off = offsets[i:j + 1]
                a, w, d, s, r, n = runs(Words(data[off[0]:off[-1]], off - off[0]))
                held.append((a, w, ids[i:j][d], s, r, n))
                rows += len(a)
                if rows >= FLUSH_ROWS:
                    yield from _send(held, n_buckets)
                    held, rows = [], 0
        if rows:
            yield from _send(held, n_buckets)
    return run


def _send(held: list, n_buckets: int) -> Iterator[pa.RecordBatch]:
    a, w, d, s, r, n = (np.concatenate(c) for c in zip(*held))
    order = np.lexsort((w, a))
    e = group_edges(a[order], w[order])
    least = np.empty(len(a), np.int64)
    least[order] = np.repeat(np.minimum.reduceat(d[order], e[:-1]), np.diff(e))
    settled = d > least   # the same run stands in a smaller document of this batch
    if settled.any():
        yield to_blobs((d[settled] * 0x9E3779B1 % n_buckets).astype(np.int64), 0,
                       [(d[settled].astype(np.int64), 8), (s[settled].astype(np.int64), 5), (n[settled].astype(np.int64), 1)], 0)
    k = ~settled
    yield to_blobs((a[k] % U64(n_buckets)).astype(np.int64), 1,
                   [(a[k] >> U64(24), 5), (w[k] >> U64(8), 7), (d[k].astype(np.int64), 8), (s[k].astype(np.int64), 5),
                    ((r[k] * 16 + n[k]).astype(np.int64), 1)], 2)


def _first_level(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Settled runs (code: windows) and runs to look at (512 + place and windows)."""
    for _, kinds in by_bucket(batches):
        if 0 in kinds:
            d, s, n = from_blobs(kinds[0], [8, 5, 1], 0)
            yield _rows(d.view(np.int64), s, n)
        if 1 not in kinds:
            continue
        a, w, d, s, c = from_blobs(kinds[1], [5, 7, 8, 5, 1], 2)
        d = d.view(np.int64)
        order = np.lexsort((w, a))
        a, w, d, s, c = a[order], w[order], d[order], s[order], c[order]
        e = group_edges(a)
        size = np.diff(e)
        many = np.repeat(np.minimum.reduceat(d, e[:-1]) != np.maximum.reduceat(d, e[:-1]), size)
        differ = np.repeat(w[e[:-1]] != w[e[1:] - 1], size)
        f = group_edges(a, w)
        least = np.repeat(np.minimum.reduceat(d, f[:-1]), np.diff(f))
        settled = d > least
        yield _rows(d[settled], s[settled], c[settled] & U64(15))
        # Equal runs are represented by their smallest document.
        look = many & differ & ~settled
        yield _rows(d[look], s[look], c[look] + U64(512))


def _with_marks(run):
    """Mapper over documents with marks: calls ``run(ids, words, doc, start, code)``
    per slice (documents without marks are passed over)."""
    def mapper(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marks = column(batch, "marks__")
            touched = np.flatnonzero(marks.is_valid().to_numpy(zero_copy_only=False))
            if not len(touched):
                continue
            batch = batch.take(pa.array(touched))
            marks = column(batch, "marks__")
            ids = longs(batch, "doc_id")
            data, offsets = string_bytes(column(batch, "text"))
            counts = marks.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            values = marks.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            at = np.r_[0, np.cumsum(counts)]
            for i, j in slices(offsets, SLICE_BYTES):
                off = offsets[i:j + 1]
                v = values[at[i]:at[j]]
                doc = np.repeat(np.arange(j - i), counts[i:j])
                code = v & ((1 << MARK) - 1)
                yield from run(ids[i:j], lambda: Words(data[off[0]:off[-1]], off - off[0]), doc, v >> MARK, code)
    return mapper


def _middle_scan(n_buckets: int):
    def run(ids, words, doc, start, code):
        look = code >= 512
        if not look.any():
            return
        words = words()
        doc, start, c = doc[look], start[look], code[look] - 512
        rel, n = c >> 4, c & 15
        g8 = words.gram(MIDDLE)
        place = words.first[doc] + start + rel
        # Windows with the gram within their first six words hold the eight
        # words from it on, the others the four before it as well.
        for side, has, at in ((0, rel - (n - 1) <= 5, place), (1, rel >= 6, place - GRAM)):
            if not has.any():
                continue
            h = mix64(g8[at[has]] + U64(side))
            yield to_blobs((h % U64(n_buckets)).astype(np.int64), side,
                           [(h >> U64(24), 5), (ids[doc[has]].astype(np.int64), 8), (start[has].astype(np.int64), 5),
                            (c[has].astype(np.int64), 1)], 1)
    return _with_marks(run)


def _middle_level(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for _, kinds in by_bucket(batches):
        for side, blobs in kinds.items():
            h, d, s, c = from_blobs(blobs, [5, 8, 5, 1], 1)
            d = d.view(np.int64)
            order = np.argsort(h, kind="stable")
            h, d, s, c = h[order], d[order], s[order], c[order]
            e = group_edges(h)
            many = np.repeat(np.minimum.reduceat(d, e[:-1]) != np.maximum.reduceat(d, e[:-1]), np.diff(e))
            yield _rows(d[many], s[many], c[many] + U64(256 * side))


def _last_scan(n_buckets: int):
    def run(ids, words, doc, start, code):
        words = words()
        side, rel, n = code >> 8, code >> 4 & 15, code & 15
        # Windows of the run that this side speaks for.
        low = np.where(side == 0, np.maximum(0, rel - 5), 0)
        high = np.where(side == 0, n - 1, np.minimum(n - 1, rel - 6))
        count = np.maximum(0, high - low + 1)
        owner = np.repeat(np.arange(len(doc)), count)
        if not len(owner):
            return
        step = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
        at = start[owner] + low[owner] + step
        d = doc[owner]
        place = words.first[d] + at
        h, other = words.gram(WINDOW)[place], words.gram(WINDOW, second=True)[place]
        yield to_blobs((other % U64(n_buckets)).astype(np.int64), 0,
                       [(h, 8), (ids[d].astype(np.int64), 8), (at.astype(np.int64), 5)], 1)
    return _with_marks(run)


def _last_level(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for _, kinds in by_bucket(batches):
        h, d, s = from_blobs(kinds[0], [8, 8, 5], 1)
        d = d.view(np.int64)
        order = np.argsort(h, kind="stable")
        h, d, s = h[order], d[order], s[order]
        e = group_edges(h)
        again = d > np.repeat(np.minimum.reduceat(d, e[:-1]), np.diff(e))
        yield _rows(d[again], s[again], np.ones(int(again.sum()), np.int64))


def _removed(n_words: int, marks) -> np.ndarray:
    """Mask of removed words from marks of settled runs."""
    if marks is None:
        return np.zeros(n_words, bool)
    v = np.asarray(marks, np.int64)
    code = v & ((1 << MARK) - 1)
    v, code = v[code < 512] >> MARK, code[code < 512]
    edge = np.zeros(n_words + 1, np.int64)
    np.add.at(edge, v, 1)
    np.add.at(edge, np.minimum(v + code + WINDOW - 1, n_words), -1)
    return np.cumsum(edge[:-1]) > 0


def repeated_windows(docs: DataFrame, names: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """Documents dealt by doc_id (text and ``names``), and the same with
    ``marks__`` and ``more__``: runs of windows that also start in a smaller
    document."""
    spark = docs.sparkSession
    nb = bucket_count(spark)
    docs = docs.select(*(names or ["doc_id"]), "text")
    # The texts are shuffled once: the three joins by doc_id reuse it.
    held = docs.repartition("doc_id")

    def gather(rows: DataFrame) -> DataFrame:
        return rows.groupBy("doc_id").agg(F.collect_list("mark").alias("marks__"))

    def level(blobs: DataFrame, run) -> DataFrame:
        return blobs.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(run, ROWS)

    first = gather(level(docs.where("doc_id is not null").mapInArrow(_scan(nb), BLOB), _first_level))
    middle = gather(level(held.join(first, "doc_id", "left").mapInArrow(_middle_scan(nb), BLOB), _middle_level))
    last = gather(level(held.join(middle, "doc_id", "left").mapInArrow(_last_scan(nb), BLOB), _last_level))
    found = held.join(first, "doc_id", "left").join(last.withColumnRenamed("marks__", "more__"), "doc_id", "left")
    return held, found


def _apply(make):
    """Mapper that hands (doc_id, words, removed mask or None) to ``make``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            cols = [column(batch, c).to_pylist() for c in ("doc_id", "text")]
            marks = [column(batch, c) for c in ("marks__", "more__")]
            for k, (d, t) in enumerate(zip(*cols)):
                words = t.encode().split() if t else []
                both = [m[k].values.to_numpy(zero_copy_only=False) for m in marks if m[k].is_valid]
                rows.append(make(d, words, _removed(len(words), np.concatenate(both)) if both else None))
            yield pa.RecordBatch.from_pylist(rows, schema=make.schema) if rows else \
                pa.RecordBatch.from_pylist([], schema=make.schema)
    return run


def _digest(d, words, removed):
    kept = words if removed is None else list(compress(words, (~removed).tolist()))
    return {"doc_id": d, "n_words": len(words), "n_removed": len(words) - len(kept),
            "kept_sha256": hashlib.sha256(b" ".join(kept)).hexdigest()}


_digest.schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()),
                            ("kept_sha256", pa.string())])


def window_digests(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 of every document."""
    _, found = repeated_windows(docs)
    return found.mapInArrow(_apply(_digest), "doc_id long, n_words long, n_removed long, kept_sha256 string")


def kept_documents(docs: DataFrame) -> DataFrame:
    """``docs`` with the words left, joined by one space, as ``text`` where
    words were removed; all other texts and columns stay as they are."""
    names = [c for c in docs.columns if c != "text"]
    _, found = repeated_windows(docs, names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = column(batch, "text").to_pylist()
            marks = [column(batch, c) for c in ("marks__", "more__")]
            for k, t in enumerate(texts):
                both = [m[k].values.to_numpy(zero_copy_only=False) for m in marks if m[k].is_valid]
                if t and both:
                    words = t.encode().split()
                    gone = _removed(len(words), np.concatenate(both))
                    if gone.any():
                        texts[k] = b" ".join(compress(words, (~gone).tolist())).decode()
            yield pa.RecordBatch.from_arrays(
                [*(column(batch, c) for c in names), pa.array(texts, pa.string())], names=[*names, "text"])

    schema = ", ".join(f"`{c}` {t}" for c, t in dict(docs.dtypes).items() if c != "text") + ", text string"
    return found.mapInArrow(run, schema).select(docs.columns)


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words left of every document."""
    return window_digests(spark.read.parquet(f"{sf_dir}/documents.parquet"))
