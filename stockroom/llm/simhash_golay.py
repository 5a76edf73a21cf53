"""SimHash near duplicates by Golay-code fuzzy hashing.

A text's 64-bit fingerprint has a bit set where over half of the hashes of its
three-word shingles have it. Two fingerprints link at two or fewer differing
bits. To find these pairs without comparing all, a fingerprint is cut into three
segments of 22, 21 and 21 bits. Two errors leave one segment without an error
and another one with one error at most, so some segment i is equal and the next
one (or, if that has both errors, the one after it for another i) has at most
one error. The key of a family i is segment i as it is and a codeword of the
perfect binary Golay code (23, 12) near segment i + 1. Every 23-bit word lies
within three errors of one codeword; the keys of a word are all codewords that
it or a word one error away decodes to: one for most words close to a codeword,
six for the others. Two words one error apart always share a key, as either one's
own codeword is among the other's keys.

Fingerprints that share a key are verified by their differing bits, in buckets
of at most ``CROWD``. Fingerprints of larger buckets are linked in another exact
way, whose groups cannot grow: two fingerprints within two errors have a word
within one error of both, so each sends itself to the 65 words within one error
of it, and all that meet there (65 at most) are linked without any comparison.
Either way passes on one edge for each fingerprint, to the least of its group's
component, never all pairs; a star contraction joins these edges.

Defined results: equal texts have equal fingerprints; null texts, empty ones and
texts without words have fingerprint zero and are linked like any other; texts
of one or two words are one shingle; a null doc_id is left out when the least
doc_id is sought (null if a component has no other); repeated rows keep a row
each; other columns are ignored, whatever their names; an empty table gives no
rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F

from stockroom.llm.chosen_path import components
from stockroom.llm.textbytes import SPACE, U64, column, group_edges, longs, slices, string_bytes, word_spans
from stockroom.session import ensure_checkpoint_dir

SHINGLE, SEED = 3, 42
DISTANCE = 2
#: First bit and bits of each segment.
SEGMENTS = ((0, 22), (22, 21), (43, 21))
#: Generator polynomial of the (23, 12) Golay code: x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1.
GENERATOR, LENGTH, INDEX_BITS = 0b110001110101, 23, 12
#: Largest bucket whose fingerprints are compared in pairs.
CROWD = 1024
SLICE_BYTES = 1 << 20
STEP = 1 << 16


# ---------------------------------------------------------------- fingerprints

def _plain(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[bytes, np.ndarray]:
    """The words in lower case with one space behind each that has white space
    there, and where each begins. Shingles of a text are slices of it."""
    n = len(data)
    space = SPACE[data]
    body = np.where((data >= 65) & (data <= 90), data | 32, data).astype(np.uint8)
    body[space] = 32
    keep = ~space
    followed = ends < n
    followed[followed] = space[ends[followed]]
    keep[ends[followed]] = True
    size = ends - starts + followed
    return body[keep].tobytes(), np.r_[0, np.cumsum(size)][:-1]


def fingerprints(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Fingerprint of each text, in steps of ``STEP`` shingles."""
    starts, ends, first = word_spans(data, offsets)
    n, words = len(offsets) - 1, np.diff(first)
    body, at = _plain(data, starts, ends)
    till = at + (ends - starts)
    shingles = np.where(words > 0, np.maximum(words - SHINGLE + 1, 1), 0)
    before = np.r_[0, np.cumsum(shingles)]
    digest, ones = xxhash.xxh64_intdigest, np.zeros((n, 64), np.int64)
    for i in range(0, int(before[-1]), STEP):
        k = np.arange(i, min(i + STEP, int(before[-1])))
        owner = np.searchsorted(before, k, "right") - 1
        begin = first[owner] + k - before[owner]
        last = np.minimum(begin + SHINGLE, first[owner + 1]) - 1
        h = np.fromiter((digest(body[a:b], SEED) for a, b in zip(at[begin].tolist(), till[last].tolist())), "<u8", len(k))
        bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        e = group_edges(owner)[:-1]
        ones[owner[e]] += np.add.reduceat(bits, e, axis=0, dtype=np.int64)
    return np.packbits(2 * ones > shingles[:, None], axis=1, bitorder="little").view("<u8").reshape(n)


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = column(batch, "doc_id")
        data, offsets = string_bytes(column(batch, "text"))
        for i, j in slices(offsets, SLICE_BYTES):
            off = offsets[i:j + 1]
            fp = fingerprints(data[off[0]:off[-1]], off - off[0])
            yield pa.RecordBatch.from_arrays([ids.slice(i, j - i), pa.array(fp.view(np.int64))], names=["doc_id", "fp"])


# ---------------------------------------------------------------- Golay keys

class Golay:
    """Decoding by syndrome: 2,048 remainders, each with its one error pattern
    of three bits at most."""

    def __init__(self):
        bits = [1 << i for i in range(LENGTH)]
        patterns = [0, *bits, *(a | b for k, a in enumerate(bits) for b in bits[:k]),
                    *(a | b | c for k, a in enumerate(bits) for m, b in enumerate(bits[:k]) for c in bits[:m])]
        p = np.array(patterns, np.uint32)
        self.error = np.zeros(1 << (LENGTH - INDEX_BITS), np.uint32)
        self.error[self.remainder(p)] = p

    @staticmethod
    def remainder(words: np.ndarray) -> np.ndarray:
        r = words.astype(np.uint32)
        low = LENGTH - INDEX_BITS
        for bit in range(LENGTH - 1, low - 1, -1):
            r = np.where((r >> np.uint32(bit)) & 1, r ^ np.uint32(GENERATOR << (bit - low)), r)
        return r

    def index(self, words: np.ndarray) -> np.ndarray:
        """Index (12 bits) of the codeword within three errors."""
        code = words ^ self.error[self.remainder(words)]
        return code >> np.uint32(LENGTH - INDEX_BITS)

    def near(self, words: np.ndarray, bits: int) -> np.ndarray:
        """(words, bits + 1): indices that each word and the words one error
        away in its lowest ``bits`` bits decode to, repeats included."""
        flips = np.r_[0, 1 << np.arange(bits)].astype(np.uint32)
        return self.index((words[:, None] ^ flips[None, :]).ravel()).reshape(len(words), bits + 1)


_GOLAY: list[Golay] = []


def golay() -> Golay:
    if not _GOLAY:
        _GOLAY.append(Golay())
    return _GOLAY[0]


def keys(fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row and key of every fingerprint's keys, each once."""
    g = golay()
    parts = [((fp >> U64(a)) & U64((1 << n) - 1)).astype(np.uint32) for a, n in SEGMENTS]
    rows, out = [], []
    for i, exact in enumerate(parts):
        j = (i + 1) % len(SEGMENTS)
        near = np.sort(g.near(parts[j], SEGMENTS[j][1]), axis=1)
        new = np.ones(near.shape, bool)
        new[:, 1:] = near[:, 1:] != near[:, :-1]
        r, c = np.nonzero(new)
        rows.append(r)
        out.append((U64(i) << U64(40)) | (exact[r].astype(np.uint64) << U64(INDEX_BITS)) | near[r, c].astype(np.uint64))
    return np.concatenate(rows), np.concatenate(out)


def _keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        fp = longs(batch, "fp").view(np.uint64)
        for i in range(0, len(fp), 4096):
            part = fp[i:i + 4096]
            r, k = keys(part)
            yield pa.RecordBatch.from_arrays([pa.array(k.view(np.int64)), pa.array(part[r].view(np.int64))], names=["key", "fp"])


# ---------------------------------------------------------------- links

EDGES = "a long, b long"


def _edges(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])


def group_roots(fp: np.ndarray) -> np.ndarray:
    """Least member of each fingerprint's component among those given."""
    near = np.bitwise_count(fp[:, None] ^ fp[None, :]) <= DISTANCE
    ids = fp.view(np.int64)
    root = ids.copy()
    while True:
        least = np.where(near, root[None, :], np.iinfo(np.int64).max).min(axis=1)
        if (least == root).all():
            return root
        root = least


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges of the buckets of a partition sorted by key (CROWD rows each at most)."""
    tail_k, tail_f = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def compare(k, f):
        e = group_edges(k)
        size = np.diff(e)
        pairs = e[:-1][size == 2]       # most buckets
        a, b = f[pairs], f[pairs + 1]
        near = np.bitwise_count(a.view(np.uint64) ^ b.view(np.uint64)) <= DISTANCE
        out_a, out_b = [np.maximum(a, b)[near]], [np.minimum(a, b)[near]]
        for x in np.flatnonzero(size > 2).tolist():
            own = f[e[x]:e[x + 1]]
            root = group_roots(own.view(np.uint64))
            linked = root != own
            out_a.append(own[linked])
            out_b.append(root[linked])
        return _edges(np.concatenate(out_a), np.concatenate(out_b))

    for batch in batches:
        k, f = np.r_[tail_k, longs(batch, "key")], np.r_[tail_f, longs(batch, "fp")]
        cut = int(np.searchsorted(k, k[-1])) if len(k) else 0     # the last bucket may go on
        tail_k, tail_f = k[cut:], f[cut:]
        if cut:
            yield compare(k[:cut], f[:cut])
    if len(tail_k):
        yield compare(tail_k, tail_f)


def _middles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    flips = np.r_[U64(0), U64(1) << np.arange(64, dtype=np.uint64)]
    for batch in batches:
        fp = longs(batch, "fp").view(np.uint64)
        for i in range(0, len(fp), 4096):
            part = fp[i:i + 4096]
            yield pa.RecordBatch.from_arrays(
                [pa.array((part[:, None] ^ flips[None, :]).ravel().view(np.int64)),
                 pa.array(np.repeat(part.view(np.int64), len(flips)))], names=["middle", "fp"])


def links(distinct: DataFrame) -> DataFrame:
    """Edges (a, b) that join all of ``distinct`` (column fp) that link."""
    keyed = distinct.mapInArrow(_keyed, "key long, fp long")
    size = keyed.groupBy("key").agg(F.count("*").alias("size")).where("size > 1")
    shared = keyed.join(size, "key").checkpoint()
    plain = (shared.where(F.col("size") <= CROWD).select("key", "fp").repartition("key").sortWithinPartitions("key")
             .mapInArrow(_verified, EDGES))
    crowded = shared.where(F.col("size") > CROWD).select("fp").distinct().mapInArrow(_middles, "middle long, fp long")
    # A middle's group has 65 members at most, all within two errors of each other.
    least = crowded.groupBy("middle").agg(F.min("fp").alias("least"), F.collect_list("fp").alias("members"))
    met = least.select(F.explode("members").alias("a"), F.col("least").alias("b")).where("a <> b")
    return plain.unionByName(met).distinct()


def document_fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, fp (signed 64 bits) of every row."""
    return docs.select("doc_id", "text").mapInArrow(_features, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, fp long")


def simhash_components(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """doc_id, fp, component_id (least doc_id reachable): one row per row of ``docs``."""
    ensure_checkpoint_dir(spark)
    known = document_fingerprints(docs).checkpoint()
    classes = known.groupBy("fp").agg(F.min("doc_id").alias("least")).checkpoint()
    roots = components(links(classes.select("fp")))
    rooted = classes.join(roots, F.col("fp") == F.col("node"), "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root"))
    named = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    per_class = rooted.select("fp", "root").join(named, "root").select("fp", "component_id")
    return known.join(per_class, "fp").select("doc_id", "fp", "component_id")


def op12_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    out = simhash_components(spark, spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
