"""Quality classifier: a factorisation machine over hashed words, structure
statistics and metadata (lengths).

score = sigmoid(w0 + sum w_i x_i + sum over pairs <v_i, v_j> x_i x_j). The pair
sum is taken in linear time: half of (sum v x)^2 - sum (v x)^2 per factor.

Training uses at most ``sample_rows`` labelled rows (a documented bound; the
rows with the smallest hash of their id), never those held out. Scoring covers
whole texts; word features are counts of each text, so that cost follows length.

Defined results: null and empty texts are scored on their statistics (all zero
but the constant); several labels of one document count as the lowest; with no
labels, or labels of one kind only, every score is that constant's; repeated
rows get equal scores; a null doc_id is scored and is never held out; extra
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from stockroom.llm.textbytes import (SPACE, U64, column, gram_hashes, group_edges, slices, string_bytes,
                                     word_hashes, word_spans)

WORD_BITS, FACTORS, SAMPLE_ROWS = 15, 8, 8000
THRESHOLD = 0.3

_CLASSES = {
    "symbols": b"#*$%&|<>", "digits": b"0123456789", "upper": bytes(range(65, 91)),
    "stops": b".!?", "pauses": b",;:", "quotes": b"\"'()[]{}", "lines": b"\n",
}
_TABLE = np.zeros((256, len(_CLASSES)), np.float32)
for _i, _chars in enumerate(_CLASSES.values()):
    _TABLE[list(_chars), _i] = 1
STATS = [*_CLASSES, "spaces", "wide", "word_length", "distinct", "distinct_triples", "next_same",
         "log_bytes", "log_words", "log_lines"]


def _distinct(doc: np.ndarray, h: np.ndarray, n_docs: int):
    """Distinct values per document: owner, value, count, number per document."""
    if len(h) == 0:
        return doc, h, np.zeros(0, np.int64), np.zeros(n_docs, np.int64)
    order = np.lexsort((h, doc))
    d, v = doc[order], h[order]
    e = group_edges(d, v)
    return d[e[:-1]], v[e[:-1]], np.diff(e), np.bincount(d[e[:-1]], minlength=n_docs)


def features(data: np.ndarray, offsets: np.ndarray):
    """(owner, word index, value) of the word features, rising in owner, and the
    statistics of each text."""
    n = len(offsets) - 1
    starts, ends, first = word_spans(data, offsets)
    h = word_hashes(data, starts, ends)
    words = np.diff(first)
    doc = np.repeat(np.arange(n), words)
    owner, value, count, distinct = _distinct(doc, h, n)
    idx = (value >> U64(64 - WORD_BITS)).astype(np.int64)
    x = 1 + np.log(count.astype(np.float32)) if len(count) else np.zeros(0, np.float32)
    norm = np.sqrt(np.bincount(owner, weights=x * x, minlength=n))
    x = (x / np.maximum(norm, 1e-9)[owner]).astype(np.float32)
    g3 = gram_hashes(h, 3)
    same = first[1:][doc[:len(g3)]] - np.arange(len(g3)) >= 3 if len(g3) else np.zeros(0, bool)
    d3, _, _, triples = _distinct(doc[:len(g3)][same], g3[same], n)
    bytes_ = np.diff(offsets).astype(float)
    # 16-bit cumulative counts per class would overflow: one class at a time.
    per = np.zeros((n, len(_CLASSES)))
    for i in range(len(_CLASSES)):
        run = np.zeros(len(data) + 1)
        np.cumsum(_TABLE[data, i], out=run[1:])
        per[:, i] = run[offsets[1:]] - run[offsets[:-1]]
    def total(mask):
        run = np.zeros(len(data) + 1)
        np.cumsum(mask, out=run[1:])
        return run[offsets[1:]] - run[offsets[:-1]]
    again = np.zeros(len(h))
    if len(h) > 1:
        again[1:] = (h[1:] == h[:-1]) & (doc[1:] == doc[:-1])
    nw = np.maximum(words, 1)
    lines = per[:, list(_CLASSES).index("lines")]
    stats = np.column_stack([
        per / nw[:, None], total(SPACE[data]) / nw, total(data >= 128) / np.maximum(bytes_, 1),
        np.bincount(doc, weights=(ends - starts), minlength=n) / nw, distinct / nw,
        triples / np.maximum(words - 2, 1), np.bincount(doc, weights=again, minlength=n) / nw,
        np.log1p(bytes_), np.log1p(words), np.log1p(lines)])
    return owner, idx, x, stats.astype(np.float32)


class FactorMachine:
    """Parameters over the hashed words followed by the statistics."""

    def __init__(self, n_stats: int = len(STATS), factors: int = FACTORS, seed: int = 7):
        rng = np.random.default_rng(seed)
        size = (1 << WORD_BITS) + n_stats
        self.w0, self.w = 0.0, np.zeros(size, np.float32)
        self.v = rng.normal(0, 0.01, (size, factors)).astype(np.float32)
        self.mean, self.scale = np.zeros(n_stats, np.float32), np.ones(n_stats, np.float32)

    def _rows(self, owner, idx, x, stats):
        """Word and statistic features of all texts as one sparse list."""
        n, k = stats.shape
        z = np.clip((stats - self.mean) / self.scale, -5, 5)
        o = np.concatenate([owner, np.repeat(np.arange(n), k)])
        i = np.concatenate([idx, np.tile((1 << WORD_BITS) + np.arange(k), n)])
        v = np.concatenate([x, z.reshape(-1)])
        order = np.argsort(o, kind="stable")
        return o[order], i[order], v[order]

    def raw(self, o, i, x, n):
        starts = np.searchsorted(o, np.arange(n))
        vx = self.v[i] * x[:, None]
        s = np.add.reduceat(vx, starts, axis=0)     # each text has its statistics
        q = np.add.reduceat(vx * vx, starts, axis=0)
        lin = np.add.reduceat(self.w[i] * x, starts)
        return self.w0 + lin + 0.5 * (s * s - q).sum(axis=1), s, vx

    def score(self, owner, idx, x, stats) -> np.ndarray:
        n = len(stats)
        if n == 0:
            return np.zeros(0)
        z, _, _ = self.raw(*self._rows(owner, idx, x, stats), n)
        return 1 / (1 + np.exp(-np.clip(z.astype(float), -30, 30)))

    def fit(self, rows: list[tuple], epochs: int = 8, batch: int = 128, rate: float = 0.05, decay: float = 1e-5):
        """``rows``: (label, idx, x, stats) per text. Adaptive gradient steps on
        the logistic loss, both labels weighted alike."""
        y = np.array([r[0] for r in rows], np.float32)
        if len(y) == 0 or y.min() == y.max():
            return self
        stats = np.array([r[3] for r in rows], np.float32)
        self.mean, self.scale = stats.mean(axis=0), np.maximum(stats.std(axis=0), 1e-3)
        weight = np.where(y == 1, 0.5 / y.mean(), 0.5 / (1 - y.mean()))
        rng = np.random.default_rng(11)
        gw, gv, g0 = np.full_like(self.w, 1e-6), np.full_like(self.v, 1e-6), 1e-6
        for _ in range(epochs):
            order = rng.permutation(len(rows))
            for at in range(0, len(order), batch):
                part = order[at:at + batch]
                owner = np.repeat(np.arange(len(part)), [len(rows[p][1]) for p in part])
                o, i, x = self._rows(owner, np.concatenate([rows[p][1] for p in part]),
                                     np.concatenate([rows[p][2] for p in part]), stats[part])
                z, s, vx = self.raw(o, i, x, len(part))
                err = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y[part]) * weight[part] / len(part)
                dw = err[o] * x
                dv = (err[o] * x)[:, None] * (s[o] - vx)
                uniq, back = np.unique(i, return_inverse=True)
                tw = np.bincount(back, weights=dw, minlength=len(uniq)) + decay * self.w[uniq]
                tv = np.column_stack([np.bincount(back, weights=dv[:, f], minlength=len(uniq))
                                      for f in range(dv.shape[1])]) + decay * self.v[uniq]
                gw[uniq] += tw ** 2
                gv[uniq] += tv ** 2
                g0 += err.sum() ** 2
                self.w[uniq] -= (rate * tw / np.sqrt(gw[uniq])).astype(np.float32)
                self.v[uniq] -= (rate * 0.5 * tv / np.sqrt(gv[uniq])).astype(np.float32)
                self.w0 -= float(rate * err.sum() / np.sqrt(g0))
        return self


def held_out():
    return F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5)) == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> FactorMachine:
    """Fit on at most ``sample_rows`` labelled rows outside the held-out fold."""
    spark = docs.sparkSession
    chosen = (labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
              .groupBy("doc_id").agg(F.min("quality").alias("quality"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows)).toPandas()
    sample = spark.createDataFrame(chosen.astype("int64"), "doc_id long, quality long")   # sample_rows at most
    rows = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id").select("doc_id", "quality", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = string_bytes(column(batch, "text"))
            owner, idx, x, stats = features(data, offsets)
            cut = np.searchsorted(owner, np.arange(len(offsets)))
            pair = list(zip(cut[:-1].tolist(), cut[1:].tolist()))
            yield pa.RecordBatch.from_arrays(
                [column(batch, "doc_id"), column(batch, "quality"),
                 pa.array([idx[a:b].astype("<i4").tobytes() for a, b in pair], pa.binary()),
                 pa.array([x[a:b].tobytes() for a, b in pair], pa.binary()),
                 pa.array([s.tobytes() for s in stats], pa.binary())],
                names=["doc_id", "quality", "idx", "x", "stats"])

    got = rows.mapInArrow(run, "doc_id long, quality long, idx binary, x binary, stats binary").toPandas()
    # One row a document, in an order of its own: repeated rows change nothing.
    got = got.drop_duplicates(["doc_id", "idx", "x"]).sort_values(["doc_id", "idx", "x"])
    return FactorMachine().fit([
        (q, np.frombuffer(i, "<i4").astype(np.int64), np.frombuffer(x, np.float32), np.frombuffer(s, np.float32))
        for q, i, x, s in zip(got["quality"], got["idx"], got["x"], got["stats"])])


def score_documents(docs: DataFrame, model: FactorMachine, keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, ``keep`` columns, score of every whole text. The model's size is fixed."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fm = sent.value
        for batch in batches:
            ids = column(batch, "doc_id").cast(pa.int64())
            data, offsets = string_bytes(column(batch, "text"))
            for i, j in slices(offsets, 1 << 20):
                off = offsets[i:j + 1]
                score = fm.score(*features(data[off[0]:off[-1]], off - off[0]))
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(i, j - i), *(column(batch, c).slice(i, j - i) for c in keep), pa.array(score)],
                    names=["doc_id", *keep, "score"])

    rows = docs.select("doc_id", *keep, "text")
    kinds = "".join(f", `{c}` {t}" for c, t in rows.dtypes if c in keep)
    return rows.mapInArrow(run, f"doc_id long{kinds}, score double")


def classify(docs: DataFrame, labels: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    return score_documents(docs, train(docs, labels), keep).select(
        "doc_id", *keep, held_out().alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def op3_quality_fm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score of every document."""
    return classify(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
