"""Daily stock kept up to date by what changed.

The latest row of each vehicle is a versioned key table; the daily stock is a
versioned day table. Newly landed rows, however late their event time, are
merged into the first as a delta. For the vehicles of that delta the spans of the
version before are taken away from the daily stock and the new ones added, as
signed changes by day; only days that changed are rewritten. When the clock moves
on, open spans grow, so they are taken away as of the old time and added as of
the new one; all days but the new ones cancel out.

The daily table stores, in the same commit as its rows, the version of the
vehicle table and the time it stands for. A run that stops between the two
commits is caught up by the next one from the version that is still kept, so no
change is lost or made twice.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockroom.operators.latest import latest_per_key
from stockroom.operators.spans import daily_change
from stockroom.plans.preview import LATEST_ORDER, SNAPSHOT_COLUMNS, cdp_preview, parse_preview, snapshot_spans
from stockroom.session import ensure_checkpoint_dir
from stockroom.sinks import versions
from stockroom.sinks.tables import _properties, table_exists

_SOURCE, _AS_OF = "stockroom.source.version", "stockroom.source.as_of"
#: Order columns under which the vehicle table keeps the latest row (the hash of the raw text by a plain name).
STATE_ORDER = ("event_timestamp", "processed_at", "raw_hash")


def latest_rows(raw: DataFrame, json: str = "struct") -> DataFrame:
    """Latest row of each vehicle with all that later rows are compared by."""
    rows = latest_per_key(parse_preview(raw, json), ["inventory_id"], LATEST_ORDER)
    return rows.withColumnRenamed("__value", "raw_hash").select(*SNAPSHOT_COLUMNS, "processed_at", "raw_hash")


def merge_latest(spark: SparkSession, landed: DataFrame, table: str, json: str = "struct") -> None:
    """Merge landed rows into the vehicle table; the later row of each vehicle stays."""
    versions.merge(spark, table, latest_rows(landed, json), ["inventory_id"], order=STATE_ORDER, check=False,
                   max_deltas=1 << 30)       # compacted below, once the daily stock has followed


def apply_change(spark: SparkSession, table: str, change: DataFrame, day_col: str, dims: Sequence[str],
                 measures: Sequence[str], count: str, properties: Mapping[str, str]) -> list[_dt.date]:
    """Add signed changes to a stored daily table; returns the rewritten days
    (bounded by the calendar). Groups whose ``count`` becomes zero go."""
    ensure_checkpoint_dir(spark)
    change = change.select(day_col, *dims, *measures).checkpoint()
    days = [r[0] for r in change.select(day_col).distinct().orderBy(day_col).collect()]
    if not days:
        versions.note(spark, table, properties)
        return days
    stored = spark.table(table)
    both = stored.where(F.col(day_col).isin(days)).select(day_col, *dims, *measures).unionByName(change)
    new = (both.groupBy(day_col, *dims).agg(*[F.sum(m).cast("bigint").alias(m) for m in measures])
           .where(F.col(count) != 0).select(*stored.columns))
    versions.replace_days(spark, table, new, day_col, days, properties)
    return days


def _signed(rows: DataFrame, as_of, sign: int) -> DataFrame:
    return snapshot_spans(rows, as_of).withColumn("__sign", F.lit(sign))


def _change(spark: SparkSession, vehicles: str, moved: bool, old_as_of, as_of) -> DataFrame:
    """Signed spans between what the daily stock stands for and the present:
    vehicles of the last delta if ``moved``, open ones if the clock went on."""
    now = spark.table(vehicles)
    parts = []
    if moved:
        keys = versions.last_delta(spark, vehicles).select("inventory_id")
        before = versions.previous_version(spark, vehicles)
        parts += [_signed(before.join(keys, "inventory_id", "left_semi"), old_as_of, -1),
                  _signed(now.join(keys, "inventory_id", "left_semi"), as_of, 1)]
        now = now.join(keys, "inventory_id", "left_anti")
    if old_as_of != as_of:
        still_open = now.where(F.col("removal_date_time").isNull())
        parts += [_signed(still_open, old_as_of, -1), _signed(still_open, as_of, 1)]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def follow(spark: SparkSession, vehicles: str, daily: str, as_of) -> list[_dt.date]:
    """Bring the daily stock to the vehicle table's version and to ``as_of``;
    returns the days that were rewritten (all of a new table)."""
    version, as_of = versions.version_of(spark, vehicles), str(as_of)
    props = {_SOURCE: str(version), _AS_OF: as_of}
    if table_exists(spark, daily):
        stored = _properties(spark, daily)
        behind = version - int(stored[_SOURCE])
        if behind == 0 and stored[_AS_OF] == as_of:
            return []
        if behind in (0, 1):
            spans = _change(spark, vehicles, behind == 1, stored[_AS_OF], as_of)
            change = daily_change(spans, "span_start", "span_end", "__sign")
            return apply_change(spark, daily, change, "stock_date", [], ["net_stock_count", "stock_days"],
                                "net_stock_count", props)
    # New, or more than one version behind: computed from all vehicles.
    ensure_checkpoint_dir(spark)
    full = cdp_preview(spark.table(vehicles), as_of, sort=False).withColumn(
        "stock_days", F.col("stock_days").cast("bigint")).checkpoint()
    days = [r[0] for r in full.select("stock_date").distinct().collect()]
    if table_exists(spark, daily):
        days += [r[0] for r in spark.table(daily).select("stock_date").distinct().collect()]
    versions.replace_days(spark, daily, full, "stock_date", days, props)
    return sorted(set(days))


def cdp_incremental_delta(spark: SparkSession, landed: DataFrame, vehicles: str, daily: str, as_of,
                          json: str = "struct", max_deltas: int = versions.MAX_DELTAS) -> list[_dt.date]:
    """Merge newly landed rows, late ones included, into the vehicle table and
    bring the daily stock to the same state as a full recomputation. Returns the
    days that were rewritten."""
    if table_exists(spark, daily):
        follow(spark, vehicles, daily, _properties(spark, daily)[_AS_OF])    # a run that stopped between its commits
    merge_latest(spark, landed, vehicles, json)
    days = follow(spark, vehicles, daily, as_of)
    if len(versions.state_of(spark, vehicles)["deltas"]) > max_deltas:
        versions.compact(spark, vehicles)
    return days
