"""Near-duplicate join on word shingles (Jaccard >= 0.8) by chosen paths.

Each distinct text is a set of hashed five-word shingles. A run sends a set
down a path: at each node the set takes the token that the node's own hash puts
first, and sets that took the same token stay together. Splitting goes on only
while a bucket is larger than ``BRUTE`` and splitting it parts its sets; buckets
that are still larger then hold sets alike to one another and are compared in
pairs of blocks. Inside buckets every pair is compared exactly. Two sets of
similarity s share a bucket of depth k with probability s^k a run, and runs are
repeated until a pair of 0.8 is found with probability TARGET: eight runs for
depth one, 12 for texts that some run splits to depth two, 22 for those beyond.

A pair is compared in the first run that brings it together: texts without a
new partner in a bucket are not sent there. Pairs are counted where they are
compared and never listed; a bucket passes on, for each text, its number of
links and the least member of its component.

Defined results: equal texts are one class (copies are folded before the join);
a text of one to four words is one shingle of all its words; null and empty
texts are equal texts without links; a null doc_id has no class and no links;
extra columns are ignored; empty tables give no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F

from stockroom.llm.textbytes import (U64, column, gram_hashes, group_edges, longs, mix64, slices, string_bytes,
                                     word_hashes, word_spans)
from stockroom.session import ensure_checkpoint_dir

SHINGLE = 5
#: Probability of finding a pair of similarity 0.8.
TARGET = 0.99999
LEVELS = 4
#: A bucket with this share of the one above it is not split further.
ALIKE = 0.75
BRUTE, BLOCK = 256, 1024
SLICE_BYTES = 1 << 20
TOKEN_BYTES = 5
#: Similarity 0.8 in whole numbers: I / (a + b - I) >= 4 / 5.
NUM, DEN = 4, 5


def runs_for(depth: int) -> int:
    """Runs that find a pair of 0.8 in buckets of this depth."""
    return math.ceil(math.log(1 - TARGET) / math.log(1 - (NUM / DEN) ** depth))


def shingle_sets(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text, rising, and their offsets."""
    n = len(offsets) - 1
    starts, ends, first = word_spans(data, offsets)
    h = word_hashes(data, starts, ends)
    words = np.diff(first)
    g = gram_hashes(h, SHINGLE)
    doc = np.repeat(np.arange(n), words)
    whole = first[1:][doc[:len(g)]] - np.arange(len(g)) >= SHINGLE
    owner, value = doc[:len(g)][whole], g[whole]
    short = np.flatnonzero((words > 0) & (words < SHINGLE))
    if len(short):
        extra = np.array([xxhash.xxh3_64_intdigest(h[first[i]:first[i + 1]].tobytes()) for i in short], np.uint64)
        owner, value = np.concatenate([owner, short]), np.concatenate([value, extra])
    order = np.lexsort((value, owner))
    owner, value = owner[order], value[order]
    e = group_edges(owner, value)[:-1]
    return value[e], np.r_[0, np.cumsum(np.bincount(owner[e], minlength=n))]


def paths(tokens: np.ndarray, at: np.ndarray, runs: int, levels: int) -> np.ndarray:
    """Path of each set: (sets, runs, levels) node hashes. Sets are not empty."""
    n = len(at) - 1
    out = np.zeros((n, runs, levels), np.uint64)
    if n == 0:
        return out
    owner = np.repeat(np.arange(n), np.diff(at))
    for r in range(runs):
        node = np.full(n, mix64(np.array([r + 1], np.uint64))[0])
        for k in range(levels):
            chosen = np.minimum.reduceat(mix64(tokens ^ node[owner]), at[:-1])
            node = mix64(node * U64(3) + chosen)
            out[:, r, k] = node
    return out


def _features(batches: Iterator[pa.RecordBatch], runs: int, levels: int) -> Iterator[pa.RecordBatch]:
    """doc_id, text key, number of shingles, path nodes."""
    for batch in batches:
        ids = column(batch, "doc_id")
        data, offsets = string_bytes(column(batch, "text"))
        for i, j in slices(offsets, SLICE_BYTES):
            off = offsets[i:j + 1]
            part, off = data[off[0]:off[-1]], off - off[0]
            tokens, at = shingle_sets(part, off)
            size = np.diff(at)
            full = np.flatnonzero(size)
            nodes = paths(tokens, np.r_[at[:-1][full], len(tokens)], runs, levels).reshape(len(full), runs * levels).view(np.int64)
            listed = [None] * (j - i)
            for k, v in zip(full.tolist(), nodes):
                listed[k] = v
            body = part.tobytes()
            keys = [xxhash.xxh3_128_digest(body[a:b]) for a, b in zip(off[:-1].tolist(), off[1:].tolist())]
            yield pa.RecordBatch.from_arrays(
                [ids.slice(i, j - i), pa.array(keys, pa.binary()), pa.array(size, pa.int64()),
                 pa.array(listed, pa.list_(pa.int64()))], names=["doc_id", "tkey", "n", "nodes"])


def buckets(texts: DataFrame, deep_nodes) -> DataFrame:
    """uid, run, bucket, size: split while a bucket is larger than BRUTE and
    splitting it helps. ``texts`` has the first nodes of the runs that depth one
    takes; ``deep_nodes`` makes all nodes of the texts of a column uid.

    A text takes part in at least as many runs as the greatest depth it has come to takes.
    Two texts share as many runs as the lesser of their depths takes, and their
    buckets are never split further than that, so every pair is found with
    probability TARGET."""
    first = texts.where(F.col("nodes").isNotNull()).select(
        "uid", F.posexplode("nodes").alias("run", "bucket"))
    met = _with_sizes(first).checkpoint()
    done = met if LEVELS == 1 else met.where(F.col("size") <= BRUTE)
    out = done.select("uid", "run", "bucket", "size")
    rows = met.where(F.col("size") > BRUTE).select("uid", "run", F.col("size").alias("parent"))
    if LEVELS == 1 or rows.isEmpty():
        return out
    nodes = deep_nodes(rows.select("uid").distinct()).checkpoint()
    rows = rows.join(nodes, "uid").select("uid", "run", "parent", F.slice("nodes", F.col("run") * LEVELS + 1, LEVELS).alias("path"))
    found, reached = _split(rows, 1)
    reached = [(2, nodes.select("uid")), *reached]
    out = out.unionByName(found)
    # Two rungs: alike texts end at depth two; all others go up to the last level.
    for depth, till in ((2, 2), (3, LEVELS)):
        deep = [uids for d, uids in reached if d >= depth]
        if not deep:
            break
        active = deep[0]
        for uids in deep[1:]:
            active = active.unionByName(uids)
        every = F.sequence(F.lit(runs_for(depth - 1)), F.lit(runs_for(till) - 1))
        rows = nodes.join(active.distinct(), "uid").select("uid", F.explode(every).alias("run"), "nodes").select(
            "uid", "run", F.lit(None).cast("long").alias("parent"), F.slice("nodes", F.col("run") * LEVELS + 1, LEVELS).alias("path"))
        found, more = _split(rows, 0)
        out, reached = out.unionByName(found), reached + more
    return out


def _with_sizes(rows: DataFrame) -> DataFrame:
    """Rows whose bucket has a partner for them, with its size. The others end
    here; what is left is much smaller."""
    many = rows.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1")
    return rows.join(many, "bucket")


def _split(rows: DataFrame, level: int) -> tuple[DataFrame, list[tuple[int, DataFrame]]]:
    """Buckets of the paths from ``level`` on, and the texts that went on to each
    further depth. A bucket that holds most of the one above is not split again:
    its texts are alike, so their paths stay together."""
    out, reached = None, []
    for k in range(level, LEVELS):
        met = _with_sizes(rows.withColumn("bucket", F.get("path", F.lit(k)))).checkpoint()
        ends = F.lit(True) if k == LEVELS - 1 else (F.col("size") <= BRUTE) | F.coalesce(
            F.col("size") >= ALIKE * F.col("parent"), F.lit(False))
        done = met.where(ends).select("uid", "run", "bucket", "size")
        out = done if out is None else out.unionByName(done)
        if k == LEVELS - 1:
            break
        rows = met.where(~ends).select("uid", "run", F.col("size").alias("parent"), "path")
        if rows.isEmpty():
            break
        reached.append((k + 2, rows.select("uid").distinct()))
    return out, reached


MEMBER = "bucket long, run int, size long, uid long, met array<long>"


def _grouped(batches: Iterator[pa.RecordBatch], keys: list[str], cols: list[str]):
    """Rows of one key after another, from batches sorted by ``keys``."""
    held, now = [], None
    for batch in batches:
        key_rows = list(zip(*(column(batch, c).to_pylist() for c in keys)))
        rows = list(zip(*(column(batch, c).to_pylist() for c in cols)))
        for key, row in zip(key_rows, rows):
            if key != now and held:
                yield now, held
                held = []
            now = key
            held.append(row)
    if held:
        yield now, held


def unmet(met_a: np.ndarray, met_b: np.ndarray) -> np.ndarray:
    """Pairs that no earlier run has brought together (0: no bucket)."""
    out = np.ones((len(met_a), len(met_b)), bool)
    for r in range(met_a.shape[1]):
        a, b = met_a[:, r], met_b[:, r]
        out &= (a[:, None] != b[None, :]) | (a == 0)[:, None]
    return out


def _wanted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Members with a partner that no earlier run has brought to them, in
    buckets of BRUTE members at most."""
    for (bucket,), rows in _grouped(batches, ["bucket"], ["run", "size", "uid", "met"]):
        run = rows[0][0]
        if run:
            met = np.array([r[3] for r in rows], np.int64)[:, :run]
            new = unmet(met, met)
            np.fill_diagonal(new, False)
            rows = [r for r, x in zip(rows, new.any(axis=1)) if x]
        if rows:
            yield pa.RecordBatch.from_arrays(
                [pa.array([bucket] * len(rows), pa.int64()), *(pa.array(c, t) for c, t in zip(
                    zip(*rows), (pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64()))))],
                names=["bucket", "run", "size", "uid", "met"])


def _attach(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row with the text's set for each bucket (and pair of blocks)."""
    for batch in batches:
        data, offsets = string_bytes(column(batch, "text"))
        uids, copies = longs(batch, "uid"), longs(batch, "copies")
        places = column(batch, "places").to_pylist()
        for i, j in slices(offsets, SLICE_BYTES):
            off = offsets[i:j + 1]
            tokens, at = shingle_sets(data[off[0]:off[-1]], off - off[0])
            out = []
            for k in range(i, j):
                mine = (tokens[at[k - i]:at[k - i + 1]] >> U64(24)).view(np.uint8).reshape(-1, 8)
                blob = np.ascontiguousarray(mine[:, :TOKEN_BYTES]).tobytes()
                u = int(uids[k])
                for p in places[k]:
                    blocks = 1 if p["size"] <= BLOCK else -(-p["size"] // BLOCK)
                    own = int(mix64(np.array([u], np.int64).view(np.uint64))[0] % U64(blocks)) if blocks > 1 else 0
                    for other in range(blocks):
                        out.append((p["bucket"], min(own, other), max(own, other), own, p["run"], u, int(copies[k]),
                                    p["met"], blob))
                if len(out) > 2000:
                    yield _sets(out)
                    out = []
            if out:
                yield _sets(out)


SETS = "bucket long, i int, j int, own int, run int, uid long, copies long, met array<long>, tokens binary"


def _sets(rows: list) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)],
                                      names=["bucket", "i", "j", "own", "run", "uid", "copies", "met", "tokens"])


def tokens_of(blob: bytes) -> np.ndarray:
    out = np.zeros((len(blob) // TOKEN_BYTES, 8), np.uint8)
    out[:, :TOKEN_BYTES] = np.frombuffer(blob, np.uint8).reshape(-1, TOKEN_BYTES)
    return out.reshape(-1).view(np.uint64)


def intersections(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all pairwise intersections: incidence matrix times itself, in
    slices of tokens; tokens of a single set add to its own size only."""
    m = len(sets)
    sizes = np.array([len(s) for s in sets], np.int64)
    if m == 2:
        common = len(np.intersect1d(sets[0], sets[1], assume_unique=True))
        return np.array([[sizes[0], common], [common, sizes[1]]])
    owner = np.repeat(np.arange(m), sizes)
    _, token, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    keep = count[token] > 1
    rank = np.cumsum(count > 1) - 1
    owner, token = owner[keep], rank[token[keep]]
    total = np.zeros((m, m), np.float32)   # exact: sizes stay far below 2^24
    order = np.argsort(token, kind="stable")
    owner, token = owner[order], token[order]
    width = max(64, min(4096, 8_000_000 // m))
    n = int(token[-1]) + 1 if len(token) else 0
    for a in range(0, n, width):
        lo, hi = np.searchsorted(token, [a, a + width])
        x = np.zeros((m, min(width, n - a)), np.float32)
        x[owner[lo:hi], token[lo:hi] - a] = 1
        total += x @ x.T
    out = total.astype(np.int64)
    np.fill_diagonal(out, sizes)
    return out


def _components(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Least member of each node's component (edges a-b), by label passing."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """uid, links, doc_links, root of texts with a new link in a bucket."""
    out = []
    cols = ["own", "run", "uid", "copies", "met", "tokens"]
    for (_, i, j), rows in _grouped(batches, ["bucket", "i", "j"], cols):
        if len(rows) < 2:
            continue
        rows.sort(key=lambda r: r[2])
        own = np.array([r[0] for r in rows])
        run = rows[0][1]
        new = np.ones((len(rows), len(rows)), bool)
        if run:
            met = np.array([r[4] for r in rows], np.int64)[:, :run]
            new = unmet(met, met)
        np.fill_diagonal(new, False)
        if i != j:
            new &= own[:, None] != own[None, :]
        some = np.flatnonzero(new.any(axis=1))
        if not len(some):
            continue
        rows, new = [rows[k] for k in some.tolist()], new[np.ix_(some, some)]
        uid = np.array([r[2] for r in rows], np.int64)
        copies = np.array([r[3] for r in rows], np.int64)
        sets = [tokens_of(r[5]) for r in rows]
        sizes = np.array([len(s) for s in sets], np.int64)
        # I / (a + b - I) >= NUM / DEN, without division.
        near = intersections(sets) * (NUM + DEN) >= NUM * (sizes[:, None] + sizes[None, :])
        near &= new
        a, b = np.nonzero(near)
        if not len(a):
            continue
        root = uid[_components(len(uid), a, b)]
        links = near.sum(axis=1)
        docs = near @ copies
        for k in np.flatnonzero(links).tolist():
            out.append((int(uid[k]), int(links[k]), int(docs[k]), int(root[k])))
        if len(out) > 10_000:
            yield _links(out)
            out = []
    if out:
        yield _links(out)


def _links(rows: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)],
                                      names=["uid", "links", "doc_links", "root"])


def components(edges: DataFrame) -> DataFrame:
    """node, root from edges (a, b), by alternating large and small stars;
    every round is cut off by a checkpoint."""
    e = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct().checkpoint()
    before = None
    while True:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u")
        e = (small.select(F.col("v").alias("u"), F.col("m").alias("v"))
             .unionByName(low.select("u", F.col("m").alias("v"))).where("u <> v").distinct().checkpoint())
        now = e.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
        if now == before:
            return e.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = now


def near_duplicates(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """doc_id, class_id (least doc_id of the class), n_links (different texts
    within the similarity), n_copies (rows with the same text), n_near_docs
    (other rows linked, equal texts included): one row per row of ``docs``."""
    ensure_checkpoint_dir(spark)
    docs = docs.select("doc_id", "text")
    runs, levels, first = runs_for(LEVELS), LEVELS, runs_for(1)
    kinds = "doc_id long, tkey binary, n long, nodes array<long>"
    known = docs.where("doc_id is not null").mapInArrow(lambda batches: _features(batches, first, 1), kinds).checkpoint()
    texts = known.groupBy("tkey").agg(F.min("doc_id").alias("uid"), F.count("*").alias("copies"),
                                      F.first("nodes").alias("nodes")).checkpoint()

    def deep_nodes(uids: DataFrame) -> DataFrame:
        own = docs.join(uids, F.col("doc_id") == F.col("uid"), "left_semi").dropDuplicates(["doc_id"])
        return own.mapInArrow(lambda batches: _features(batches, runs, levels), kinds).select(F.col("doc_id").alias("uid"), "nodes")

    found = buckets(texts, deep_nodes)
    # Each text's buckets of earlier runs (0: none), sent along with every membership.
    by_run = found.groupBy("uid").agg(F.collect_list(F.struct("run", "bucket", "size")).alias("own"))
    met = by_run.select("uid", "own", F.transform(
        F.sequence(F.lit(0), F.lit(runs - 1)),
        lambda r: F.coalesce(F.get(F.filter("own", lambda x: x["run"] == r), F.lit(0))["bucket"], F.lit(0))).alias("met"))
    members = met.select("uid", "met", F.explode("own").alias("o")).select(
        "o.bucket", "o.run", "o.size", "uid", F.slice("met", F.lit(1), F.col("o.run")).alias("met"))
    wanted = (members.where(F.col("size") <= BRUTE).repartition("bucket").sortWithinPartitions("bucket")
              .mapInArrow(_wanted, MEMBER).unionByName(members.where(F.col("size") > BRUTE)))
    places = wanted.groupBy("uid").agg(F.collect_list(F.struct("bucket", "run", "size", "met")).alias("places"))
    sized = places.join(texts.select("uid", "copies"), "uid")
    first_rows = docs.join(sized, F.col("doc_id") == F.col("uid")).dropDuplicates(["doc_id"])
    pairs = (first_rows.select("uid", "copies", "places", "text").mapInArrow(_attach, SETS)
             .repartition("bucket", "i", "j").sortWithinPartitions("bucket", "i", "j")
             .mapInArrow(_compare, "uid long, links long, doc_links long, root long").checkpoint())
    links = pairs.groupBy("uid").agg(F.sum("links").alias("links"), F.sum("doc_links").alias("doc_links"))
    roots = components(pairs.select(F.col("uid").alias("a"), F.col("root").alias("b")))
    per_text = (texts.select("tkey", "uid", "copies").join(links, "uid", "left")
                .join(roots, F.col("uid") == F.col("node"), "left")
                .select("tkey", F.coalesce("root", "uid").alias("class_id"),
                        F.coalesce("links", F.lit(0)).alias("n_links"), F.col("copies").alias("n_copies"),
                        (F.coalesce("doc_links", F.lit(0)) + F.col("copies") - 1).alias("n_near_docs")))
    named = known.select("doc_id", "tkey").join(per_text, "tkey").drop("tkey")
    unnamed = docs.where("doc_id is null").select(
        F.col("doc_id").cast("long").alias("doc_id"), F.lit(None).cast("long").alias("class_id"),
        *(F.lit(x).cast("long").alias(c) for c, x in (("n_links", 0), ("n_copies", 1), ("n_near_docs", 0))))
    return named.unionByName(unnamed)


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class and number of links of every document."""
    return near_duplicates(spark, spark.read.parquet(f"{sf_dir}/documents.parquet"))
