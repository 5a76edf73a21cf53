"""Exact top-k search by norm-sorted inner products.

Components become integers floor(256 x). Candidates lie in slices of falling
length. A rotation from the eigenvectors of the summed outer products (an SVD
of the data) puts most of the length into the first coordinates, so a partial
product plus the product of the residual lengths (Cauchy-Schwarz) bounds the
rest. A first pass over the longest vectors gives each query a threshold; whole
slices, then runs of candidates, then single pairs below it are skipped. What
is left is scored in 64-bit integers, so results are exact.

Queries go to slices in blocks: each task holds one block of queries and one
slice of candidates, both of bounded size.

Defined results: vectors null or with null or non-finite components take no
part; shorter vectors count as filled up with zeros; a query never meets a row
with its own id; repeated ids are separate candidates, and a repeated query
id asks once, with its least vector; ties go to the smaller
id; fewer candidates than k give them all; empty tables give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.window import Window

from stockroom.llm.textbytes import column, longs

K, EVERY, SCALE = 5, 50, 256
SEEDS, SLICE, BLOCK, STEP = 1024, 8192, 2048, 512
NONE = np.iinfo(np.int64).min


def integer_vectors(table: DataFrame, scale: int = SCALE) -> DataFrame:
    """vec_id, v (little-endian 64-bit integers), dim, norm of valid vectors."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, vs, dims, norms = [], [], [], []
            for i, e in zip(column(batch, "vec_id").to_pylist(), column(batch, "embedding")):
                if i is None or not e.is_valid or e.values.null_count:
                    continue
                x = e.values.to_numpy(zero_copy_only=False).astype(np.float64)
                if not np.isfinite(x).all():
                    continue
                v = np.floor(scale * x).astype("<i8")
                ids.append(i)
                vs.append(v.tobytes())
                dims.append(len(v))
                norms.append(float(np.sqrt((v.astype(float) ** 2).sum())))
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(vs, pa.binary()), pa.array(dims, pa.int32()),
                 pa.array(norms, pa.float64())], names=["vec_id", "v", "dim", "norm"])
    return table.select("vec_id", "embedding").mapInArrow(run, "vec_id long, v binary, dim int, norm double")


def matrix(blobs, dim: int) -> np.ndarray:
    out = np.zeros((len(blobs), dim), np.int64)
    for i, b in enumerate(blobs):
        v = np.frombuffer(b, "<i8")
        out[i, :len(v)] = v
    return out


def rotation(vectors: DataFrame, dim: int) -> np.ndarray:
    """Eigenvectors of the sum of outer products, largest first. What reaches
    the driver is dim * dim numbers."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dim, dim))
        for batch in batches:
            m = matrix(column(batch, "v").to_pylist(), dim).astype(float)
            total += m.T @ m
        i, j = np.divmod(np.arange(dim * dim), dim)
        yield pa.RecordBatch.from_arrays([pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)),
                                          pa.array(total.reshape(-1))], names=["i", "j", "s"])
    cells = vectors.select("v").mapInArrow(run, "i int, j int, s double").groupBy("i", "j").agg(F.sum("s").alias("s"))
    gram = np.zeros((dim, dim))
    for r in cells.collect():
        gram[r.i, r.j] = r.s
    scale = np.abs(gram).max() or 1.0
    values, vectors_ = np.linalg.eigh((gram + gram.T) / (2 * scale))
    return vectors_[:, np.argsort(-values, kind="stable")]


class Best:
    """The k best candidates of each query of a block."""

    def __init__(self, n: int, k: int):
        self.score = np.full((n, k), NONE, np.int64)
        self.ident = np.full((n, k), np.iinfo(np.int64).max, np.int64)

    def threshold(self) -> np.ndarray:
        return self.score[:, -1]

    def add(self, q: np.ndarray, score: np.ndarray, ident: np.ndarray) -> None:
        """Pairs (query, candidate), ``q`` rising."""
        k = self.score.shape[1]
        uniq = np.unique(q)
        allq = np.concatenate([np.repeat(uniq, k), q])
        alls = np.concatenate([self.score[uniq].reshape(-1), score])
        alli = np.concatenate([self.ident[uniq].reshape(-1), ident])
        order = np.lexsort((alli, -alls.astype(np.float64), allq)) if np.abs(score).max(initial=0) < 1 << 52 \
            else np.array(sorted(range(len(allq)), key=lambda x: (allq[x], -int(alls[x]), alli[x])), np.int64)
        first = np.searchsorted(allq[order], uniq)
        take = order[first[:, None] + np.arange(k)]
        self.score[uniq], self.ident[uniq] = alls[take], alli[take]


def search(qv: np.ndarray, qid: np.ndarray, start: np.ndarray, cv: np.ndarray, cid: np.ndarray, turn: np.ndarray,
           k: int) -> Best:
    """Top k of each query among candidates, beyond the thresholds ``start``
    (scores that k candidates elsewhere reach)."""
    best = Best(len(qid), k)
    if len(qid) == 0 or len(cid) == 0:
        return best
    head = max(1, turn.shape[1] // 4)
    qr, cr = qv @ turn, cv @ turn
    qn, cn = np.sqrt((qr ** 2).sum(axis=1)), np.sqrt((cr ** 2).sum(axis=1))
    order = np.argsort(-cn, kind="stable")
    cv, cid, cr, cn = cv[order], cid[order], cr[order], cn[order]
    qrest, crest = np.sqrt((qr[:, head:] ** 2).sum(axis=1)), np.sqrt((cr[:, head:] ** 2).sum(axis=1))
    for at in range(0, len(cid), STEP):
        end = min(at + STEP, len(cid))
        limit = np.maximum(start, best.threshold()).astype(float)
        slack = 1e-6 + 1e-9 * qn * cn[at]
        live = np.flatnonzero(qn * cn[at] + slack >= limit)   # longest of the run
        if not len(live):
            break
        bound = qr[live, :head] @ cr[at:end, :head].T + np.outer(qrest[live], crest[at:end]) + slack[live, None]
        hit = (bound >= limit[live, None]) & (qid[live, None] != cid[None, at:end])
        a, b = np.nonzero(hit)
        if len(a):
            q = live[a]
            score = np.concatenate([np.einsum("ij,ij->i", qv[q[s:s + 65536]], cv[at + b[s:s + 65536]])
                                    for s in range(0, len(q), 65536)])
            good = score >= limit[q]
            if good.any():
                best.add(q[good], score[good], cid[at + b[good]])
    return best


def top_k(spark: SparkSession, table: DataFrame, k: int = K, every: int = EVERY) -> DataFrame:
    """query_id, rank, vec_id, score."""
    vectors = integer_vectors(table)
    about = vectors.agg(F.count("*").alias("n"), F.max("dim").alias("d")).first()
    n, dim = about.n, max(1, about.d or 1)
    turn = rotation(vectors, dim)
    longest = vectors.orderBy(F.desc("norm"), "vec_id").limit(SEEDS).collect()   # SEEDS rows at most
    seed_v, seed_id = matrix([r.v for r in longest], dim), np.array([r.vec_id for r in longest], np.int64)
    slices = max(1, -(-n // SLICE))
    cuts = vectors.approxQuantile("norm", [1 - i / slices for i in range(1, slices)], 0.1 / slices) if slices > 1 else []
    blocks = max(1, -(-n // (every * BLOCK)))
    block_of = lambda c: F.pmod(F.xxhash64(c), F.lit(blocks)).cast("int")
    edges = np.array(cuts, float)   # falling lengths; slice i holds norms in (edges[i], edges[i-1]]
    edges = edges[np.r_[True, edges[1:] < edges[:-1]]] if len(edges) else edges

    def slice_of(norm: np.ndarray) -> np.ndarray:
        return np.searchsorted(-edges, -norm, side="left")

    def seed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """First thresholds, and the slices that can still hold a better one."""
        for batch in batches:
            ids, blobs = longs(batch, "vec_id"), column(batch, "v").to_pylist()
            norms = column(batch, "norm").to_numpy()
            limit = search(matrix(blobs, dim), ids, np.full(len(ids), NONE), seed_v, seed_id, turn, k).threshold()
            tops = np.r_[np.inf, edges]   # no vector of slice i is longer than tops[i]
            out = [(i, b, int(t), s) for i, b, t, m in zip(ids.tolist(), blobs, limit, norms.tolist())
                   for s in range(len(tops)) if m * min(tops[s], 1e300) * (1 + 1e-9) + 1e-6 >= float(t)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*out) if out else [[]] * 4,
                                                (pa.int64(), pa.binary(), pa.int64(), pa.int32()))],
                names=["vec_id", "v", "start", "slice"])

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [column(batch, "vec_id"), column(batch, "v"),
                 pa.array(slice_of(column(batch, "norm").to_numpy()).astype(np.int32))], names=["vec_id", "v", "slice"])

    def block(queries: pa.Table, cands: pa.Table) -> pa.Table:
        out = {"query_id": [], "vec_id": [], "score": []}
        if queries.num_rows and cands.num_rows:
            qid = queries["vec_id"].to_numpy().astype(np.int64)
            best = search(matrix(queries["v"].to_pylist(), dim), qid, queries["start"].to_numpy(),
                          matrix(cands["v"].to_pylist(), dim), cands["vec_id"].to_numpy().astype(np.int64), turn, k)
            found = best.score > NONE
            out = {"query_id": np.repeat(qid, found.sum(axis=1)), "vec_id": best.ident[found], "score": best.score[found]}
        return pa.table({c: pa.array(v, pa.int64()) for c, v in out.items()})

    asked = (vectors.where(F.pmod("vec_id", F.lit(every)) == 0).groupBy("vec_id")
             .agg(F.min(F.struct("v", "dim", "norm")).alias("q")).select("vec_id", "q.*"))
    queries = asked.mapInArrow(seed, "vec_id long, v binary, start long, slice int").withColumn("block", block_of("vec_id"))
    cands = (vectors.mapInArrow(place, "vec_id long, v binary, slice int")
             .withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))))
    found = (queries.groupBy("slice", "block").cogroup(cands.groupBy("slice", "block"))
             .applyInArrow(block, "query_id long, vec_id long, score long"))
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).select(
        "query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def op9_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five best partners of every fiftieth vector among all vectors."""
    return top_k(spark, spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
