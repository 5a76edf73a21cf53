"""Sharding by vector bin packing: bytes, tokens and rows balanced jointly.

Rows with equal text form a group. Groups are folded by hash into a bounded
number of bundles (groups are pre-aggregated before any shuffle; a text that
alone exceeds a bundle is cut by row into pieces of bundle size, so a hot
group never lands in one task). The bundles, whose number depends on the
shard count and never on the data, are placed in order of falling size on the
shard where the dot product of the bundle's size vector with the shard's
residual capacity is highest.

Defined results: a null text has size 8 and counts as its own group, apart
from the empty text; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.window import Window

from stockroom.session import ensure_checkpoint_dir

SHARDS = 24
BUNDLES_PER_SHARD = 256


def place(sizes: np.ndarray, shards: int) -> np.ndarray:
    """Shard of each bundle; ``sizes`` is (bundles, dimensions), not negative."""
    total = np.maximum(sizes.sum(axis=0), 1e-9)
    s = sizes / total * shards
    left = np.ones((shards, sizes.shape[1]))
    out = np.zeros(len(sizes), np.int64)
    for i in np.argsort(-s.max(axis=1), kind="stable"):
        # A full dimension counts against a shard, so that the dot product
        # keeps preferring shards with room in the bundle's large dimensions.
        out[i] = int(np.argmax(left @ s[i]))
        left[out[i]] -= s[i]
    return out


def level(sizes: np.ndarray, out: np.ndarray, shards: int, dim: int = 0, moves: int = 20_000) -> np.ndarray:
    """Even out one dimension after placing: move the bundle nearest to half
    the gap from the fullest to the emptiest shard while that helps."""
    s, out = sizes[:, dim], out.copy()
    load = np.bincount(out, weights=s, minlength=shards)
    for _ in range(moves):
        hi, lo = int(np.argmax(load)), int(np.argmin(load))
        gap = load[hi] - load[lo]
        mine = np.flatnonzero((out == hi) & (s > 0) & (s < gap))
        if not len(mine):
            break
        i = mine[np.argmin(np.abs(s[mine] - gap / 2))]
        out[i] = lo
        load[hi] -= s[i]
        load[lo] += s[i]
    return out


def shard_documents(spark: SparkSession, docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """Columns doc_id, size, text_crc32, tokens, bundle, shard, slot."""
    ensure_checkpoint_dir(spark)
    text = F.col("text")
    rows = docs.select(
        "doc_id",
        (F.coalesce(F.octet_length(text), F.lit(0)) + 8).cast("long").alias("size"),
        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"),
        F.coalesce(F.size(F.split(F.trim(text), r"[\x20\x09-\x0D]+")), F.lit(0)).cast("long").alias("tokens"),
        F.coalesce(F.md5(text.cast("binary")), F.lit("")).alias("g"))
    # The columns kept are a few dozen bytes a document; the texts are read once.
    rows = rows.checkpoint()
    n_bundles = shards * BUNDLES_PER_SHARD
    groups = rows.groupBy("g").agg(F.sum("size").alias("gb"), F.sum("tokens").alias("gt"), F.count("*").alias("gn"))
    totals = rows.agg(F.sum("size").alias("b"), F.sum("tokens").alias("t"), F.count("*").alias("n")).first()
    limits = [max(1.0, (x or 0) / n_bundles) for x in totals]
    # At most 3 * n_bundles groups exceed a bundle in some dimension.
    hot = (groups.where((F.col("gb") > limits[0]) | (F.col("gt") > limits[1]) | (F.col("gn") > limits[2]))
           .select(F.col("g").alias("hot_g"), F.ceil(F.greatest(F.col("gb") / limits[0], F.col("gt") / limits[1],
                                          F.col("gn") / limits[2])).cast("long").alias("pieces")))
    base = F.pmod(F.xxhash64("g"), F.lit(n_bundles))
    piece = F.when(F.col("pieces").isNotNull(),
                   F.pmod(F.xxhash64("doc_id", "size"), F.col("pieces"))).otherwise(F.lit(0))
    rows = (rows.join(F.broadcast(hot), F.col("g") == F.col("hot_g"), "left")
            .withColumn("bundle", F.pmod(base + piece, F.lit(n_bundles)).cast("int")))
    sized = rows.groupBy("bundle").agg(F.sum("size").alias("b"), F.sum("tokens").alias("t"),
                                       F.count("*").alias("n")).collect()   # n_bundles rows at most
    sizes = np.array([[r.b, r.t, r.n] for r in sized], float).reshape(-1, 3)
    shard_of = level(sizes, place(sizes, shards), shards)
    first: dict[int, int] = {}
    plan = []
    for r, s in zip(sized, shard_of.tolist()):
        plan.append((r.bundle, s, first.get(s, 0)))
        first[s] = first.get(s, 0) + r.n
    plan_df = spark.createDataFrame(plan, "bundle int, shard int, base long")
    in_bundle = Window.partitionBy("bundle").orderBy("doc_id", "text_crc32", "size")
    return (rows.withColumn("r", F.row_number().over(in_bundle) - 1)
            .join(F.broadcast(plan_df), "bundle")
            .select("doc_id", "size", "text_crc32", "tokens", "bundle", "shard",
                    (F.col("base") + F.col("r")).cast("long").alias("slot")))


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in shards 0 to 23 under the law ``bytes``."""
    out = shard_documents(spark, spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"), "tokens", "bundle")
