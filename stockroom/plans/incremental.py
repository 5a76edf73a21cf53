"""Incremental forms of the preview models.

Two families, kept with their own semantics:

* high-water mark + merge (``*_hwm``): read only source rows past the
  target's maximum, recompute, merge by key. A row arriving late (event time
  not after the mark) is never loaded; merge never deletes.
* interval (``*_range`` / ``*_key``): recompute the days ``start .. end``
  and either replace exactly that range or merge by key. The snapshot model
  deduplicates *per day* of the interval, so one run over many days equals
  the same days run one by one (see :func:`backfill`).

The mark and the interval are literals on the driver, so the time predicate
reaches the parquet scan of the raw table.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockroom.operators.filters import above_mark, high_water_mark, in_interval
from stockroom.operators.latest import latest_per_key
from stockroom.plans.preview import (
    LATEST_ORDER, SNAPSHOT_COLUMNS, cdp_preview, parse_preview, sdp_preview,
)
from stockroom.sinks.tables import (
    _bytes_of, _location, commit_mark, committed_mark, merge_by_key, missing_days, read_table, replace_time_range,
    table_exists,
)
from stockroom.sinks import versions


def _mark(spark: SparkSession, table: str, col: str, parse):
    """Mark of the last complete run. It is stored with every run; only a table
    that some other program has created is read for it."""
    stored = committed_mark(spark, table, col)
    return parse(stored) if stored else high_water_mark(read_table(spark, table), col)


def _merge(spark: SparkSession, table: str, batch: DataFrame, key: str, mark_col: str, mark, order, store: str) -> None:
    """Merge a batch that is unique on ``key`` and store the mark, the larger of
    the old one and the batch's maximum, which the write itself observes."""
    if store == "delta":
        versions.merge(spark, table, batch, [key], order=order or (), marks=[mark_col], check=False)
        return
    got = merge_by_key(spark, table, batch, [key], check=False, order=order, observe=mark_col)
    commit_mark(spark, table, mark_col, max((m for m in (mark, got) if m is not None), default=None))


def sdp_incremental_hwm(spark: SparkSession, raw: DataFrame, table: str,
                        json: str = "struct", day_col: str | None = None,
                        lookback: _dt.timedelta | None = None, store: str = "rewrite") -> None:
    """Snapshot per vehicle, loading only raw rows with
    ``timestamp > max(event_timestamp)`` of the target, merged on the id.
    An existing but empty target has no mark and loads everything.

    The mark is the one stored after the last complete run, so a run that
    stopped between partitions is repeated in full. ``day_col``: partition
    column of ``raw`` that is the day of ``timestamp``. ``lookback``: read that
    much before the mark again and keep the later row of each vehicle, so rows
    late by less than it are not lost. ``store``: ``"rewrite"`` rewrites the
    buckets that the batch touches, ``"delta"`` writes the batch's rows only and
    commits them with the mark (:mod:`stockroom.sinks.versions`)."""
    order = mark = None
    if table_exists(spark, table):
        mark = since = _mark(spark, table, "event_timestamp", _dt.datetime.fromisoformat)
        if lookback and mark is not None:
            since, order = mark - lookback, ["event_timestamp"]
        raw = above_mark(raw, "timestamp", since, day_col=day_col)
    # Latest-per-key output is unique and non-null on the key by construction.
    _merge(spark, table, sdp_preview(raw, json), "inventory_id", "event_timestamp", mark, order, store)


def range_snapshot(raw: DataFrame, start, end, json: str = "struct",
                   day_col: str | None = None) -> DataFrame:
    """Latest snapshot per ``(vehicle, day)`` for the days ``start .. end``."""
    parsed = parse_preview(in_interval(raw, "timestamp", start, end, day_col=day_col), json)
    parsed = parsed.withColumn("__day", F.to_date("event_timestamp"))
    return latest_per_key(parsed, ["inventory_id", "__day"], LATEST_ORDER).select(*SNAPSHOT_COLUMNS)


def sdp_incremental_range(spark: SparkSession, raw: DataFrame, table: str, start, end,
                          json: str = "struct", day_col: str | None = None) -> None:
    """Replace the days ``start .. end`` of the target with that interval's
    latest snapshot per vehicle and day."""
    replace_time_range(spark, table, range_snapshot(raw, start, end, json, day_col),
                       "event_timestamp", start, end)


def sdp_incremental_key(spark: SparkSession, raw: DataFrame, table: str, start, end,
                        json: str = "struct", day_col: str | None = None,
                        only_if_newer: bool = False) -> None:
    """Latest snapshot per vehicle over the interval, merged on the id. Without
    a guard, re-running an old interval overwrites newer rows; with
    ``only_if_newer`` the later of both rows stays."""
    batch = sdp_preview(in_interval(raw, "timestamp", start, end, day_col=day_col), json)
    merge_by_key(spark, table, batch, ["inventory_id"], check=False,   # unique by construction
                 order=["event_timestamp"] if only_if_newer else None)


def cdp_incremental_hwm(spark: SparkSession, snap: DataFrame, table: str, as_of,
                        method: str = "sweep", store: str = "rewrite") -> None:
    """Daily stock for days ``>= max(stock_date)`` of the target (clamped
    before expansion), merged on the day. Earlier days are never revisited."""
    lo = _mark(spark, table, "stock_date", _dt.date.fromisoformat) if table_exists(spark, table) else None
    daily = cdp_preview(snap, as_of, method=method, lo=lo, sort=False)
    _merge(spark, table, daily, "stock_date", "stock_date", lo, None, store)   # one row per day


def cdp_incremental_range(spark: SparkSession, snap: DataFrame, table: str, start, end,
                          as_of, method: str = "sweep") -> None:
    """Daily stock for the days ``start .. end`` (clamped before expansion),
    replacing exactly those days, including days that became empty."""
    daily = cdp_preview(snap, as_of, method=method, lo=start, hi=end, sort=False)
    replace_time_range(spark, table, daily, "stock_date", start, end, unit="date")


def days(start, end) -> list[_dt.date]:
    s, e = _dt.date.fromisoformat(str(start)[:10]), _dt.date.fromisoformat(str(end)[:10])
    return [s + _dt.timedelta(days=i) for i in range((e - s).days + 1)]


def backfill(run: Callable[[object, object], None], start, end, one_job: bool = True) -> None:
    """Run an interval model over ``start .. end`` at day grain.

    ``one_job=True`` runs the whole range as one Spark job (the day is part of
    the model's keys, so this equals day-by-day runs); ``False`` runs the days
    in ascending order, as a daily scheduler would.
    """
    if one_job:
        run(str(start)[:10], str(end)[:10])
        return
    for d in days(start, end):
        run(d.isoformat(), d.isoformat())


def day_bytes(spark: SparkSession, table: str, day_col: str, start, end) -> dict[_dt.date, int]:
    """Stored bytes of each day partition in ``start .. end``, from the catalog
    and the file system's metadata."""
    lo, hi = days(start, start)[0], days(end, end)[0]
    out = {}
    root = _location(spark, table)
    for (spec,) in spark.sql(f"SHOW PARTITIONS {table}").collect():
        text = spec.split("=", 1)[1]
        if text[:1].isdigit() and lo <= _dt.date.fromisoformat(text) <= hi:
            out[_dt.date.fromisoformat(text)] = _bytes_of(spark, f"{root}/{spec}")
    return out


def plan_chunks(todo: Sequence[_dt.date], sizes: Mapping[_dt.date, int], budget: int) -> list[tuple[_dt.date, _dt.date]]:
    """Runs of consecutive days to do, each of at most ``budget`` bytes (a larger
    day is a chunk of its own)."""
    out: list[list] = []
    for d in todo:
        size = sizes.get(d, 0)
        if out and out[-1][1] + _dt.timedelta(days=1) == d and out[-1][2] + size <= budget:
            out[-1][1:] = d, out[-1][2] + size
        else:
            out.append([d, d, size])
    return [(a, b) for a, b, _ in out]


def backfill_chunked(spark: SparkSession, run: Callable[[object, object], None], source: str, target: str, start, end,
                     budget: int, day_col: str = "event_date") -> list[tuple[_dt.date, _dt.date]]:
    """Run an interval model that replaces ranges of ``target`` over the days of
    ``start .. end`` that ``target`` has not recorded yet, in commits that read
    at most about ``budget`` stored bytes of ``source`` each. A run that stops
    goes on from the recorded days. Returns the chunks it ran."""
    chunks = plan_chunks(missing_days(spark, target, start, end), day_bytes(spark, source, day_col, start, end), budget)
    for lo, hi in chunks:
        run(lo.isoformat(), hi.isoformat())
    return chunks
