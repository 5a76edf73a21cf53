"""Table layouts that later reads profit from: buckets, digests, a curve over several columns.

* :func:`write_bucketed`: rows of a key in one bucket file, sorted, so that
  tables bucketed alike join without an exchange. For entity tables (a row or
  few per key); a key with very many rows would make one large file.
* :func:`write_digested`: parts by a hash of the key, and for each part an
  order-free digest of its rows, kept beside the table. :func:`table_diff_pruned`
  compares the digests and reads only parts that differ.
* :func:`curve_order`: a Z-order curve over the quantile ranks of several
  columns; rows sorted by it lie in files with narrow ranges of each of them.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockroom.operators.quality import table_diff
from stockroom.sinks.tables import PART, _by_part, _properties, _sql_str, _take_name, bucket_of, read_table, table_exists, write_full


# ---------------------------------------------------------------- buckets

def write_bucketed(df: DataFrame, table: str, keys: Sequence[str], buckets: int) -> None:
    """Replace ``table`` by ``df``, bucketed and sorted by ``keys``. Rows are
    dealt out by the keys first (the same hash), so each bucket is one file."""
    spark = df.sparkSession
    aside = f"{table}__next_{uuid.uuid4().hex[:12]}"
    try:
        (df.repartition(buckets, *keys).write.format("parquet").bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(aside))
    except Exception:
        spark.sql(f"DROP TABLE IF EXISTS {aside}")
        raise
    _take_name(spark, aside, table, False)


# ---------------------------------------------------------------- digests

_TOKEN = "stockroom.digest.token"


def row_digest(columns: Sequence[str], seed: int) -> Column:
    """64-bit hash of a row; nulls count by their place."""
    cols = sorted(columns)
    return F.xxhash64(F.lit(seed), *cols, *[F.col(c).isNull() for c in cols])


def part_digests(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """part, rows, total, parity: equal for equal bags of rows in any order."""
    return df.groupBy(F.col(PART).alias("part")).agg(
        F.count(F.lit(1)).alias("rows"), F.sum(row_digest(columns, 1).cast("decimal(38,0)")).alias("total"),
        F.bit_xor(row_digest(columns, 2)).alias("parity"))


def write_digested(df: DataFrame, table: str, keys: Sequence[str], parts: int = 64) -> None:
    """Replace ``table`` by ``df`` in parts by a hash of ``keys``, and store the
    digests of its parts as ``<table>__digests``. Both carry one token, set last:
    digests of other rows than the table's are never taken for its own."""
    spark, token = df.sparkSession, uuid.uuid4().hex
    write_full(_by_part(df.withColumn(PART, bucket_of(keys, parts))), table, partition_by=[PART])
    write_full(part_digests(spark.table(table), df.columns).coalesce(1), f"{table}__digests")
    listed = f"{_sql_str(_TOKEN)} = '{token}', 'stockroom.digest.parts' = '{parts}', 'stockroom.digest.keys' = {_sql_str(','.join(keys))}"
    for t in (f"{table}__digests", table):
        spark.sql(f"ALTER TABLE {t} SET TBLPROPERTIES ({listed})")


def _layout(spark: SparkSession, table: str) -> tuple[str | None, str | None]:
    p = _properties(spark, table)
    return p.get("stockroom.digest.parts"), p.get("stockroom.digest.keys")


def stored_digests(spark: SparkSession, table: str) -> DataFrame | None:
    """The table's digests, if they are of its present rows."""
    beside = f"{table}__digests"
    token = _properties(spark, table).get(_TOKEN)
    if token and table_exists(spark, beside) and _properties(spark, beside).get(_TOKEN) == token:
        return spark.table(beside)
    return None


def changed_parts(spark: SparkSession, left: str, right: str) -> list[int]:
    """Parts whose rows differ (at most as many as there are parts). Digests that
    are not stored are computed, in one pass over that table."""
    sides = []
    for t in (left, right):
        found = stored_digests(spark, t)
        sides.append(found if found is not None else part_digests(spark.table(t), [c for c in spark.table(t).columns if c != PART]))
    l, r = (x.select(F.col("part").alias(f"part_{n}"), F.struct("rows", "total", "parity").alias(n)) for n, x in zip("lr", sides))
    both = l.join(r, F.col("part_l") == F.col("part_r"), "full_outer").where(~F.col("l").eqNullSafe(F.col("r")))
    return sorted(x[0] for x in both.select(F.coalesce("part_l", "part_r")).collect())


def table_diff_pruned(spark: SparkSession, left: str, right: str, keys: Sequence[str]) -> DataFrame:
    """:func:`stockroom.operators.quality.table_diff` of two digested tables; only
    parts whose digests differ are read and joined."""
    if _layout(spark, left) != _layout(spark, right) or _layout(spark, left)[0] is None:
        raise ValueError(f"{left} and {right} are not digested in the same parts")
    if _layout(spark, left)[1] != ",".join(keys):
        raise ValueError(f"{left} is in parts by {_layout(spark, left)[1]}, not {list(keys)}")
    if set(read_table(spark, left).columns) != set(read_table(spark, right).columns):
        parts = list(range(int(_layout(spark, left)[0])))       # digests of other columns say nothing
    else:
        parts = changed_parts(spark, left, right)
    l, r = (spark.table(t).where(F.col(PART).isin(parts) if parts else F.lit(False)).drop(PART) for t in (left, right))
    return table_diff(l, r, keys)


# ---------------------------------------------------------------- curve

CURVE_BITS = 6


def _as_number(df: DataFrame, c: str) -> Column:
    """A number in the order of the column (of its first seven bytes for text)."""
    kind = df.schema[c].dataType
    if isinstance(kind, T.StringType):
        seven = F.rpad(F.substring(F.col(c).cast("binary"), 1, 7), 7, F.lit(b"\x00"))
        return F.conv(F.hex(seven), 16, 10).cast("double")
    if isinstance(kind, T.DateType):
        return F.unix_date(c).cast("double")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(F.col(c).cast("timestamp")).cast("double")
    return F.col(c).cast("double")


def curve_order(df: DataFrame, columns: Sequence[str], bits: int = CURVE_BITS) -> Column:
    """Position of each row on a Z-order curve. A column's value counts by its
    rank among 2^bits quantiles (one aggregate over the data, a few numbers a
    column on the driver), so the curve follows the data, however skewed."""
    steps = (1 << bits) - 1
    cuts = df.agg(*[F.percentile_approx(_as_number(df, c), [(i + 1) / (steps + 1) for i in range(steps)], 10_000).alias(c)
                    for c in columns]).first()
    out = F.lit(0).cast("bigint")
    for k, c in enumerate(columns):
        found = sorted(set(cuts[c] or []))
        value = _as_number(df, c)
        rank = F.coalesce(F.size(F.filter(F.array(*map(F.lit, found)), lambda x: x <= value)), F.lit(0)) if found else F.lit(0)
        for b in range(bits):
            out = out.bitwiseOR(F.shiftleft(F.shiftright(rank, b).bitwiseAND(F.lit(1)).cast("bigint"), b * len(columns) + k))
    return out


def write_on_curve(df: DataFrame, table: str, columns: Sequence[str], files: int | None = None) -> None:
    """Full refresh with the rows along the curve, cut into ranges of it."""
    spark = df.sparkSession
    code = "__curve"
    coded = df.withColumn(code, curve_order(df, columns))
    ranged = coded.repartitionByRange(files, code) if files else coded.repartitionByRange(code)
    write_full(ranged.sortWithinPartitions(code).drop(code), table)
    spark.catalog.refreshTable(table)
