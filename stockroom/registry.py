"""Registered queries: one callable per operator/model of the workload.

Each callable takes ``(spark, sf_dir)``, reads the driver tables under
``sf_dir`` (directly or through the fixtures derived from them) and returns a
DataFrame over the whole input. Queries that materialize (merge, range
replace, streams) write into a fresh catalog database in the shared folder
and return the end state read back from the target. The DuckDB SQL with the
same result is in :mod:`stockroom.oracle`.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockroom.functions.casts import (
    default_if_null, flag_to_int, ntz_lit, pad_open_end, to_bool, to_date, to_ts,
)
from stockroom.functions.dates import day_array, days_between
from stockroom.functions.json import json_fields
from stockroom.operators import quality
from stockroom.operators.enrich import left_join_dimension, left_join_entity
from stockroom.operators.filters import (
    above_mark, drop_null_key, high_water_mark, in_interval, valid_spans,
)
from stockroom.operators.latest import (
    dedup_redelivery, first_over_full_frame, latest_attributes, latest_per_key,
)
from stockroom.operators.spans import daily_stock, expand_days, validity_span
from stockroom.plans import demo, incremental, live_stock, preview
from stockroom.session import scratch_database, scratch_path
from stockroom.sinks import layout, tables as sinks, versions
from stockroom.sources import fixtures
from stockroom.sources.tables import KAFKA, load, source, table_path
from stockroom.streaming.ingest import append_stream, ingest, land_raw, read_stream, with_event_date
from stockroom.streaming.stateful import dedup_stream, stream_latest
from stockroom.streaming.upsert import stream_upsert_latest

AS_OF = fixtures.AS_OF
# Incremental scenario (fixed test parameters): the first batch holds raw
# rows before CUT whose id does not end in 7; everything else arrives later.
CUT = "2024-01-20"
LATE_ID_SUFFIX = "%7"
RANGE = ("2024-01-18", "2024-01-25")
# Stock days that hold rows at every scale.
STOCK_DAYS = ("2024-01-29", "2024-02-05")

Query = Callable[[SparkSession, str], DataFrame]


# ------------------------------------------------------------------ inputs

def _fx(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return fixtures.frame(spark, sf, name)


def _early(raw: DataFrame):
    idc = F.get_json_object(F.col("value"), "$.vehicleSnapshot.id")
    return (F.col("timestamp") < ntz_lit(CUT + " 00:00:00")) & \
        ~F.coalesce(idc.like(LATE_ID_SUFFIX), F.lit(False))


def _batches(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    raw = _fx(spark, sf, "raw_preview")
    return raw.where(_early(raw)), raw.where(~_early(raw))


def _raw_table(spark: SparkSession, db: str, first: DataFrame) -> str:
    """A raw landing table in ``db`` holding ``first``, partitioned by event
    day (time filters prune whole days); later batches append."""
    t = f"{db}.raw_inventory_vehicles_preview"
    sinks.write_full(_by_day(with_event_date(first)), t, partition_by=["event_date"])
    return t


def _by_day(df: DataFrame) -> DataFrame:
    """Rows of a day together before a day-partitioned write: a rebalance, so a
    large day is split over writers by its size and small days share one."""
    return df.hint("rebalance", "event_date")


def _append(df: DataFrame, table: str) -> None:
    _by_day(with_event_date(df)).write.mode("append").insertInto(table)


def _p1(spark, sf):
    return demo.sdp_demo(_fx(spark, sf, "raw_demo"))


def _spans(spark, sf):
    return demo.vehicle_spans(_p1(spark, sf))


def _p2(spark, sf, method="max_by"):
    return demo.agg_demo(_p1(spark, sf), _fx(spark, sf, "markets"),
                         _fx(spark, sf, "vehicle_data"), method=method)


def _p4(spark, sf, method="window"):
    return preview.sdp_preview(_fx(spark, sf, "raw_preview"), method=method)


def _raw_spans(spark, sf):
    """Snapshot spans as stored (text dates, open ends left null)."""
    return _p4(spark, sf).select("inventory_id", to_ts("creation_date_time").alias("span_start"),
                                 to_ts("removal_date_time").alias("span_end"))


# ------------------------------------------------------------------ models

def q_sdp_demo(spark, sf):
    return _p1(spark, sf)


def q_sdp_demo_get_json(spark, sf):
    return demo.sdp_demo(_fx(spark, sf, "raw_demo"), json="path")


def q_agg_demo(spark, sf):
    return _p2(spark, sf)


def q_agg_demo_window(spark, sf):
    return _p2(spark, sf, method="window")


def q_cdp_demo(spark, sf):
    return demo.cdp_demo(_p2(spark, sf))


def q_cdp_demo_sweep(spark, sf):
    """The whole demo stock (every day, every measure, vehicles without span) by the sweep."""
    return demo.cdp_demo(_p2(spark, sf), method="sweep")


def q_cdp_demo_explode(spark, sf):
    return demo.cdp_demo(_p2(spark, sf), method="explode")


def q_sdp_preview(spark, sf):
    return _p4(spark, sf)


def q_sdp_preview_max_by(spark, sf):
    return _p4(spark, sf, method="max_by")


def q_cdp_preview(spark, sf):
    return preview.cdp_preview(_p4(spark, sf), AS_OF)


def q_daily_stock(spark, sf):
    """Daily stock by country with a conditional count (one row per span and day)."""
    return daily_stock(_p2(spark, sf), "valid_from", "valid_to", ["country"],
                       {"net_stock_count": F.lit(1), "online_orderable_count": flag_to_int("online_orderable")})


def q_cdp_preview_explode(spark, sf):
    return preview.cdp_preview(_p4(spark, sf), AS_OF, method="explode")


# ------------------------------------------------------------------ JSON, casts

def q_json_extract(spark, sf):
    raw = _fx(spark, sf, "raw_demo")
    return json_fields(raw, "value", {"vehicle_json": "$.vehicle",
                                      "country": "$.vehicle.country"}
                       ).select("key", "timestamp", "processed_at", "vehicle_json", "country")


def q_json_extract_nested(spark, sf):
    raw = _fx(spark, sf, "raw_preview")
    snap = F.get_json_object(F.col("value"), "$.vehicleSnapshot")
    return raw.select("key", "timestamp",
                      F.get_json_object(snap, "$.id").alias("inventory_id"),
                      F.get_json_object(snap, "$.removalDateTime").alias("removal_date_time"),
                      F.get_json_object(snap, "$.creationDateTime").alias("creation_date_time"))


def q_json_extract_path(spark, sf):
    raw = _fx(spark, sf, "raw_demo")
    return json_fields(raw, "value", {"dealer_name": "$.vehicle.dealership.displayName"}
                       ).select("key", "timestamp", "processed_at", "dealer_name")


def _demo_text(spark, sf, spec):
    return json_fields(_fx(spark, sf, "raw_demo"), "value", spec)


def q_cast_date(spark, sf):
    p = _demo_text(spark, sf, {"a": "$.vehicle.arrivalDate", "s": "$.vehicle.salesDate"})
    return p.select("key", "timestamp", "processed_at", to_date("a").alias("arrival_date"),
                    to_date("s").alias("sales_date"))


def q_cast_boolean(spark, sf):
    p = _demo_text(spark, sf, {"o": "$.vehicle.onlineOrderingEnabled",
                               "p": "$.vehicle.porscheApproved"})
    return p.select("key", "timestamp", "processed_at", to_bool("o").alias("online_ordering_enabled"),
                    to_bool("p").alias("porsche_approved"))


def q_coalesce_default(spark, sf):
    p = _demo_text(spark, sf, {"o": "$.vehicle.onlineOrderingEnabled"})
    return p.select("key", "timestamp", "processed_at",
                    default_if_null(to_bool("o"), False).alias("online_orderable"))


def q_pad_open_span(spark, sf):
    return _raw_spans(spark, sf).select("inventory_id", "span_start",
                                        pad_open_end("span_end", AS_OF).alias("span_end"))


# ------------------------------------------------------------------ filters

def q_filter_null_id(spark, sf):
    raw = _fx(spark, sf, "raw_preview")
    p = json_fields(raw, "value", {"inventory_id": "$.vehicleSnapshot.id"})
    return drop_null_key(p, "inventory_id").select(
        F.col("timestamp").alias("event_timestamp"), "inventory_id")


def q_filter_valid_span(spark, sf):
    s = _raw_spans(spark, sf)
    return valid_spans(s, "span_start", "span_end", AS_OF)


def q_interval_filter_ts(spark, sf):
    raw = _fx(spark, sf, "raw_preview")
    sel = in_interval(raw, "timestamp", *RANGE)
    return preview.parse_preview(sel).drop("__value", "processed_at")


def q_interval_filter_date(spark, sf):
    spans = preview.snapshot_spans(_p4(spark, sf), AS_OF)
    x = expand_days(spans, "span_start", "span_end", lo=STOCK_DAYS[0], hi=STOCK_DAYS[1])
    return x.select("inventory_id", "stock_date",
                    days_between("stock_date", F.to_date("span_start")).alias("stock_days"))


def q_hwm_strict_filter(spark, sf):
    b1, _ = _batches(spark, sf)
    target = preview.sdp_preview(b1)
    mark = high_water_mark(target, "event_timestamp")
    raw = _fx(spark, sf, "raw_preview")
    return preview.parse_preview(above_mark(raw, "timestamp", mark)).drop("__value", "processed_at")


def q_hwm_inclusive_filter(spark, sf):
    b1, _ = _batches(spark, sf)
    target = preview.cdp_preview(preview.sdp_preview(b1), AS_OF, sort=False)
    mark = high_water_mark(target, "stock_date")
    spans = preview.snapshot_spans(_p4(spark, sf), AS_OF)
    x = expand_days(spans, "span_start", "span_end", lo=mark)
    return x.select("inventory_id", "stock_date",
                    days_between("stock_date", F.to_date("span_start")).alias("stock_days"))


# ------------------------------------------------------------------ windows, latest

def q_latest_per_key(spark, sf):
    ev = load(spark, sf, "events")
    return latest_per_key(ev, ["user_id"], ["ts", "event_id"])


def q_dedup_redelivery(spark, sf):
    raw = _fx(spark, sf, "raw_demo")
    return dedup_redelivery(raw, keys=["key", "timestamp"], order=["processed_at", "value"])


def q_first_value_full_frame(spark, sf):
    w = first_over_full_frame(_p1(spark, sf), "inventory_id", ["event_timestamp"], demo.ATTRIBUTES)
    return w.select("inventory_id", "event_timestamp", *demo.ATTRIBUTES)


def q_any_value_constant(spark, sf):
    w = first_over_full_frame(_p1(spark, sf), "inventory_id", ["event_timestamp"], demo.ATTRIBUTES)
    return w.groupBy("inventory_id").agg(*[F.any_value(c).alias(c) for c in demo.ATTRIBUTES])


def q_latest_attributes(spark, sf):
    return latest_attributes(_p1(spark, sf), "inventory_id", "event_timestamp", demo.ATTRIBUTES)


# ------------------------------------------------------------------ aggregates

def q_validity_span(spark, sf):
    return validity_span(_p1(spark, sf), "inventory_id", "event_timestamp")


def q_group_by_one(spark, sf):
    ev = load(spark, sf, "events")
    return ev.groupBy("event_type").agg(F.count(F.lit(1)).alias("event_count"))


def q_group_by_many(spark, sf):
    p2 = _p2(spark, sf)
    return p2.groupBy(F.to_date("valid_from").alias("first_day"), *demo.DIMENSIONS).agg(
        F.count(F.lit(1)).alias("vehicle_count"))


def q_conditional_count(spark, sf):
    p2 = _p2(spark, sf)
    return p2.groupBy("country").agg(
        F.sum(flag_to_int("online_orderable")).alias("online_orderable_count"),
        F.sum(flag_to_int("porsche_approved")).alias("approved_count"))


# ------------------------------------------------------------------ joins

def q_left_join_dimension(spark, sf):
    j = left_join_dimension(_spans(spark, sf).select("inventory_id", "country"),
                            _fx(spark, sf, "markets").select("country", "region", "market"),
                            "country", unique=True)
    return j.select("inventory_id", "country", "region", "market")


def q_left_join_entity(spark, sf):
    j = left_join_entity(_spans(spark, sf).select("inventory_id"),
                         _fx(spark, sf, "vehicle_data").select("inventory_id", "model_series",
                                                               "engine_type"),
                         "inventory_id")
    return j


def q_left_join_entity_bucketed(spark, sf):
    """Vehicle spans joined with the vehicle data, both stored in buckets of the id."""
    db = scratch_database(spark)
    layout.write_bucketed(_spans(spark, sf).select("inventory_id"), f"{db}.spans", ["inventory_id"], 8)
    layout.write_bucketed(_fx(spark, sf, "vehicle_data").select("inventory_id", "model_series", "engine_type"),
                          f"{db}.vehicle_data", ["inventory_id"], 8)
    return left_join_entity(spark.table(f"{db}.spans"), spark.table(f"{db}.vehicle_data").hint("merge"), "inventory_id")


# ------------------------------------------------------------------ generators

def q_explode_days_inner(spark, sf):
    x = expand_days(_raw_spans(spark, sf), "span_start", "span_end")
    return x.select("inventory_id", "stock_date")


def q_explode_days_outer(spark, sf):
    x = expand_days(_raw_spans(spark, sf), "span_start", "span_end", outer=True)
    return x.select("inventory_id", "stock_date")


def q_expand_days(spark, sf):
    x = expand_days(_p2(spark, sf), "valid_from", "valid_to", outer=True)
    return x.select("inventory_id", "stock_date",
                    days_between("stock_date", F.to_date("valid_from"), long=True).alias("stock_days"))


def q_date_diff_days(spark, sf):
    spans = preview.snapshot_spans(_p4(spark, sf), AS_OF)
    x = spans.withColumn("stock_date", F.explode(day_array(F.to_date("span_start"),
                                                           F.to_date("span_end"))))
    return x.select("inventory_id", "stock_date",
                    days_between("stock_date", F.to_date("span_start")).alias("stock_days"))


def q_date_diff_unit(spark, sf):
    p2 = _p2(spark, sf)
    return p2.select("inventory_id", days_between(F.to_date("valid_to"), F.to_date("valid_from"),
                                                  long=True).alias("span_days"))


# ------------------------------------------------------------------ quality

def q_contract_projection(spark, sf):
    return quality.enforce_contract(_p1(spark, sf), demo.SDP_DEMO_CONTRACT)


def q_audit_not_null(spark, sf):
    return quality.audit_not_null(_p1(spark, sf), "vehicle_condition",
                                  ["inventory_id", "event_timestamp"])


def q_audit_accepted_values(spark, sf):
    return quality.audit_accepted_values(_p1(spark, sf), "vehicle_type",
                                         ["USED_CAR", "COMMISSION_CAR"],
                                         ["inventory_id", "event_timestamp"])


def q_audit_unique_grain(spark, sf):
    return quality.audit_unique(_fx(spark, sf, "raw_demo"), ["key", "timestamp"])


def q_audit_summary(spark, sf):
    return quality.run_audits(_p1(spark, sf), quality.VEHICLE_AUDITS)


def q_table_diff(spark, sf):
    b1, _ = _batches(spark, sf)
    return quality.table_diff(preview.sdp_preview(b1), _p4(spark, sf), ["inventory_id"])


def q_table_diff_pruned(spark, sf):
    """The diff of two stored snapshots; parts with equal digests are not read."""
    db = scratch_database(spark)
    b1, _ = _batches(spark, sf)
    layout.write_digested(preview.sdp_preview(b1), f"{db}.before", ["inventory_id"])
    layout.write_digested(_p4(spark, sf), f"{db}.after", ["inventory_id"])
    return layout.table_diff_pruned(spark, f"{db}.before", f"{db}.after", ["inventory_id"])


# ------------------------------------------------------------------ sources and sinks

def q_source_declared_schema(spark, sf):
    return source(spark, table_path(sf, "events"),
                  {"event_id": "bigint", "ts": "timestamp_ntz", "user_id": "bigint",
                   "event_type": "string"})


def _kafka_shaped(raw: DataFrame) -> DataFrame:
    return raw.select(F.col("key").cast("binary").alias("key"), "topic", "timestamp",
                      F.col("value").cast("binary").alias("value"))


def q_land_raw_projection(spark, sf):
    return land_raw(_kafka_shaped(_fx(spark, sf, "raw_preview")), processed_at=AS_OF)


def q_full_refresh(spark, sf):
    db = scratch_database(spark)
    t = f"{db}.agg_inventory_reporting_demo"
    sinks.write_full(_p2(spark, sf, method="window"), t, comment="vehicle spans")
    sinks.write_full(_p2(spark, sf), t, comment="vehicle spans")  # replaces, no duplicates
    return sinks.read_table(spark, t)


def q_view_materialization(spark, sf):
    db = scratch_database(spark)
    return sinks.as_view(_p4(spark, sf), f"{db}_sdp_inventory_vehicles_preview")


def q_passthrough_copy(spark, sf):
    db_a, db_b = scratch_database(spark, "proj_a"), scratch_database(spark, "proj_b")
    sinks.write_full(_p4(spark, sf), f"{db_a}.sdp_inventory_vehicles_preview")
    sinks.write_full(preview.passthrough(spark.table(f"{db_a}.sdp_inventory_vehicles_preview")),
                     f"{db_b}.sdp_inventory_vehicles_preview")
    return sinks.read_table(spark, f"{db_b}.sdp_inventory_vehicles_preview")


def q_merge_by_key(spark, sf):
    db = scratch_database(spark)
    t = f"{db}.latest_event"
    ev = load(spark, sf, "events")
    first = latest_per_key(ev.where(F.col("ts") < ntz_lit("2024-01-15 00:00:00")),
                           ["user_id"], ["ts", "event_id"])
    batch = latest_per_key(ev.where((F.col("event_type") == "purchase") |
                                    (F.col("ts") >= ntz_lit("2024-01-15 00:00:00"))), ["user_id"],
                           ["ts", "event_id"])
    sinks.merge_by_key(spark, t, first, ["user_id"])
    sinks.merge_by_key(spark, t, batch, ["user_id"])
    return sinks.read_table(spark, t)


def q_merge_delta_compact(spark, sf):
    """Two batches merged as deltas (one against the recency order), compacted,
    and a third delta on top."""
    db = scratch_database(spark)
    t = f"{db}.latest_event"
    ev = load(spark, sf, "events")
    newest = lambda rows: latest_per_key(rows, ["user_id"], ["ts", "event_id"])
    late = F.col("ts") >= ntz_lit("2024-01-15 00:00:00")
    for rows in (ev.where(late & (F.col("event_type") != "purchase")), ev.where(~late)):
        versions.merge(spark, t, newest(rows), ["user_id"], order=["ts", "event_id"])
    versions.compact(spark, t)
    versions.merge(spark, t, newest(ev.where(F.col("event_type") == "purchase")), ["user_id"], order=["ts", "event_id"])
    return sinks.read_table(spark, t)


def _daily_counts(ev: DataFrame) -> DataFrame:
    return ev.groupBy(F.to_date("ts").alias("event_date"), "event_type").agg(
        F.count(F.lit(1)).alias("event_count"))


def q_replace_time_range(spark, sf):
    db = scratch_database(spark)
    t = f"{db}.daily_events"
    ev = load(spark, sf, "events")
    sinks.replace_time_range(spark, t, _daily_counts(ev), "event_date",
                             "2000-01-01", "2099-12-31", unit="date")
    changed = ev.where((F.col("event_type") != "error") &
                       (F.to_date("ts") != F.lit(_dt.date(2024, 1, 12))))
    sinks.replace_time_range(spark, t, _daily_counts(changed), "event_date",
                             "2024-01-10", "2024-01-15", unit="date")
    return sinks.read_table(spark, t)


def q_incremental_first_run(spark, sf):
    db = scratch_database(spark)
    b1, b2 = _batches(spark, sf)
    raw = _raw_table(spark, db, b1)
    t = f"{db}.sdp_inventory_vehicles_preview_incremental"

    def build(target):
        src = spark.table(raw)
        if target is not None:
            src = above_mark(src, "timestamp", high_water_mark(target, "event_timestamp"), day_col="event_date")
        return preview.sdp_preview(src)

    sinks.merge_by_key(spark, t, sinks.incremental_or_full(spark, t, build), ["inventory_id"])   # no target yet
    _append(b2, raw)
    sinks.merge_by_key(spark, t, sinks.incremental_or_full(spark, t, build), ["inventory_id"])   # past its mark
    return sinks.read_table(spark, t)


def q_backfill_daily(spark, sf):
    db = scratch_database(spark)
    raw = _raw_table(spark, db, _fx(spark, sf, "raw_preview"))
    t = f"{db}.sdp_inventory_vehicles_preview_incremental"
    incremental.backfill(
        lambda s, e: incremental.sdp_incremental_range(spark, spark.table(raw), t, s, e, day_col="event_date"), *RANGE)
    return sinks.read_table(spark, t)


def q_backfill_chunked(spark, sf):
    """The same days in several commits: at most a third of the raw bytes each."""
    db = scratch_database(spark)
    raw = _raw_table(spark, db, _fx(spark, sf, "raw_preview"))
    t = f"{db}.sdp_inventory_vehicles_preview_incremental"
    sizes = incremental.day_bytes(spark, raw, "event_date", *RANGE)
    incremental.backfill_chunked(
        spark, lambda s, e: incremental.sdp_incremental_range(spark, spark.table(raw), t, s, e, day_col="event_date"),
        raw, t, *RANGE, budget=sum(sizes.values()) // 3)
    return sinks.read_table(spark, t)


def q_write_on_curve(spark, sf):
    """The typed events stored along a curve over event time and dealer."""
    t = f"{scratch_database(spark)}.sdp_inventory_vehicles_demo"
    layout.write_on_curve(_p1(spark, sf), t, ["event_timestamp", "dealer_name"])
    return sinks.read_table(spark, t)


def q_demo_chain_tables(spark, sf):
    """The demo chain materialized model by model; the daily stock table."""
    from stockroom.plans.project import run_demo_chain
    db = scratch_database(spark)
    run_demo_chain(spark, db, _fx(spark, sf, "raw_demo"), _fx(spark, sf, "markets"),
                   _fx(spark, sf, "vehicle_data"))
    return sinks.read_table(spark, f"{db}.cdp_inventory_reporting_demo")


def q_preview_chain_tables(spark, sf):
    """The preview chain materialized; the daily stock table."""
    from stockroom.plans.project import run_preview_chain
    db = scratch_database(spark)
    run_preview_chain(spark, db, _fx(spark, sf, "raw_preview"), AS_OF)
    return sinks.read_table(spark, f"{db}.cdp_inventory_reporting_preview")


# ------------------------------------------------------------------ incremental models

def q_sdp_incremental_hwm(spark, sf):
    db = scratch_database(spark)
    b1, b2 = _batches(spark, sf)
    raw = _raw_table(spark, db, b1)
    t = f"{db}.sdp_inventory_vehicles_preview_incremental"
    incremental.sdp_incremental_hwm(spark, spark.table(raw), t, day_col="event_date")
    _append(b2, raw)
    incremental.sdp_incremental_hwm(spark, spark.table(raw), t, day_col="event_date")
    return sinks.read_table(spark, t)


def _p7_runs(spark, sf, db, after_first=None):
    """P7 scenario: raw = first batch, run the whole range; then the late
    rows land and the days 19..22 are re-run."""
    b1, b2 = _batches(spark, sf)
    raw = _raw_table(spark, db, b1)
    t = f"{db}.sdp_inventory_vehicles_preview_incremental"
    incremental.sdp_incremental_range(spark, spark.table(raw), t, *RANGE, day_col="event_date")
    if after_first:
        after_first(t)
    _append(b2, raw)
    incremental.sdp_incremental_range(spark, spark.table(raw), t, "2024-01-19", "2024-01-22", day_col="event_date")
    return t


def q_sdp_incremental_range(spark, sf):
    db = scratch_database(spark)
    return sinks.read_table(spark, _p7_runs(spark, sf, db))


def q_sdp_incremental_key(spark, sf):
    db = scratch_database(spark)
    raw = _raw_table(spark, db, _fx(spark, sf, "raw_preview"))
    t = f"{db}.sdp_inventory_vehicles_preview_incremental_key"
    run = lambda s, e: incremental.sdp_incremental_key(spark, spark.table(raw), t, s, e, day_col="event_date")
    incremental.backfill(run, *RANGE)
    run(RANGE[0], RANGE[0])  # re-running an old day overwrites newer rows
    return sinks.read_table(spark, t)


def q_sdp_incremental_lookback(spark, sf):
    """As the mark form, but rows up to three days before the mark are read again."""
    db = scratch_database(spark)
    b1, b2 = _batches(spark, sf)
    raw = _raw_table(spark, db, b1)
    t = f"{db}.sdp_inventory_vehicles_preview_incremental"
    back = _dt.timedelta(days=3)
    incremental.sdp_incremental_hwm(spark, spark.table(raw), t, day_col="event_date", lookback=back)
    _append(b2, raw)
    incremental.sdp_incremental_hwm(spark, spark.table(raw), t, day_col="event_date", lookback=back)
    return sinks.read_table(spark, t)


def q_sdp_incremental_key_newer(spark, sf):
    """As the key form, but an old day that is run again moves no row back."""
    db = scratch_database(spark)
    raw = _raw_table(spark, db, _fx(spark, sf, "raw_preview"))
    t = f"{db}.sdp_inventory_vehicles_preview_incremental_key"
    for s, e in (RANGE, (RANGE[0], RANGE[0])):
        incremental.sdp_incremental_key(spark, spark.table(raw), t, s, e, day_col="event_date", only_if_newer=True)
    return sinks.read_table(spark, t)


def q_cdp_incremental_hwm(spark, sf):
    db = scratch_database(spark)
    b1, b2 = _batches(spark, sf)
    raw = _raw_table(spark, db, b1)
    snap = f"{db}.sdp_inventory_vehicles_preview_incremental"
    t = f"{db}.cdp_inventory_reporting_preview_incremental"
    incremental.sdp_incremental_hwm(spark, spark.table(raw), snap, day_col="event_date")
    incremental.cdp_incremental_hwm(spark, sinks.read_table(spark, snap), t, AS_OF)
    _append(b2, raw)
    incremental.sdp_incremental_hwm(spark, spark.table(raw), snap, day_col="event_date")
    incremental.cdp_incremental_hwm(spark, sinks.read_table(spark, snap), t, AS_OF)
    return sinks.read_table(spark, t)


CDP_RANGE_1 = ("2024-01-15", "2024-02-20")
CDP_RANGE_2 = ("2024-01-20", "2024-01-31")


def q_cdp_incremental_range(spark, sf):
    db = scratch_database(spark)
    t = f"{db}.cdp_inventory_reporting_preview_incremental"

    def first(snap_table):
        incremental.cdp_incremental_range(spark, sinks.read_table(spark, snap_table), t,
                                          *CDP_RANGE_1, AS_OF)

    snap = _p7_runs(spark, sf, db, after_first=first)
    incremental.cdp_incremental_range(spark, sinks.read_table(spark, snap), t, *CDP_RANGE_2, AS_OF)
    return sinks.read_table(spark, t)


def q_cdp_incremental_delta(spark, sf):
    """Early rows, then late and newer ones, then a replay of the early ones."""
    db = scratch_database(spark)
    vehicles, daily = f"{db}.vehicles", f"{db}.cdp_inventory_reporting_preview"
    b1, b2 = _batches(spark, sf)
    for landed in (b1, b2, b1):
        live_stock.cdp_incremental_delta(spark, landed, vehicles, daily, AS_OF)
    return sinks.read_table(spark, daily)


# ------------------------------------------------------------------ streaming

def _topic_files(spark, sf) -> tuple[str, DataFrame, DataFrame]:
    """A folder of Kafka-shaped parquet files standing in for the topic."""
    b1, b2 = _batches(spark, sf)
    return scratch_path(spark, "topic"), _kafka_shaped(b1), _kafka_shaped(b2)


def q_stream_land_raw(spark, sf):
    db = scratch_database(spark)
    topic, k1, k2 = _topic_files(spark, sf)
    t, ckpt = f"{db}.raw_inventory_vehicles_preview", scratch_path(spark, "ckpt")

    def run():
        ingest(spark, "parquet", t, ckpt, _kafka_schema(), topic, AS_OF, files=1, maxFilesPerTrigger="2").awaitTermination()

    k1.write.mode("append").parquet(topic)
    run()
    k2.write.mode("append").parquet(topic)
    run()
    run()  # restart with no new files adds nothing
    return sinks.read_table(spark, t).drop("event_date")


def q_stream_upsert_latest(spark, sf):
    db = scratch_database(spark)
    topic, k1, k2 = _topic_files(spark, sf)
    t, ckpt = f"{db}.sdp_inventory_vehicles_preview", scratch_path(spark, "ckpt")

    def to_rows(batch: DataFrame) -> DataFrame:
        landed = land_raw(batch, processed_at=F.col("timestamp") + F.expr("interval 1 hour"))
        return preview.parse_preview(landed).withColumnRenamed("__value", "raw_hash")

    def run():
        src = read_stream(spark, "parquet", _kafka_schema(), topic, maxFilesPerTrigger="2")
        stream_upsert_latest(src, t, ["inventory_id"],
                             ["event_timestamp", "processed_at", "raw_hash"], ckpt,
                             transform=to_rows, store="delta").awaitTermination()

    # Late rows first: the recency guard must keep the newer stored rows.
    k2.write.mode("append").parquet(topic)
    run()
    k1.write.mode("append").parquet(topic)
    run()
    return sinks.read_table(spark, t).select(*preview.SNAPSHOT_COLUMNS)


#: Columns of a typed event that a re-delivery repeats as they were.
REPEATED = ("inventory_id", "event_timestamp", "country", "vehicle_type", "dealer_name", "online_orderable",
            "porsche_approved", "arrival_date", "sales_date")


def q_stream_dedup_redelivery(spark, sf):
    """Typed events of a stream, re-deliveries removed within a watermark of two
    days; the topic fills in three steps with a restart after each."""
    db = scratch_database(spark)
    raw = _fx(spark, sf, "raw_demo")
    topic, ckpt, t = scratch_path(spark, "topic"), scratch_path(spark, "ckpt"), f"{db}.sdp_inventory_vehicles_demo"
    arrived = F.to_date("processed_at")      # rows come in the order in which they were processed
    steps = [arrived < F.lit(_dt.date(2024, 1, 10)), arrived.between(_dt.date(2024, 1, 10), _dt.date(2024, 1, 19)),
             arrived >= F.lit(_dt.date(2024, 1, 20))]
    for step in steps:
        _kafka_shaped(raw.where(step)).write.mode("append").parquet(topic)
        src = read_stream(spark, "parquet", _kafka_schema(), topic)
        events = demo.typed_events(land_raw(src, processed_at=AS_OF)).select(*REPEATED)
        first = dedup_stream(events, ["inventory_id", "event_timestamp"], "event_timestamp", "2 days")
        append_stream(first, t, ckpt).awaitTermination()
    return sinks.read_table(spark, t)


def q_stream_latest_stateful(spark, sf):
    """Latest snapshot per vehicle from stream state: late rows first, then the
    early ones, then all late files once more."""
    db = scratch_database(spark)
    topic, k1, k2 = _topic_files(spark, sf)
    t, ckpt = f"{db}.sdp_inventory_vehicles_preview", scratch_path(spark, "ckpt")

    def to_rows(rows: DataFrame) -> DataFrame:
        landed = land_raw(rows, processed_at=F.col("timestamp") + F.expr("interval 1 hour"))
        return preview.parse_preview(landed).withColumnRenamed("__value", "raw_hash")

    for part in (k2, k1, k2):
        part.write.mode("append").parquet(topic)
        src = read_stream(spark, "parquet", _kafka_schema(), topic)
        stream_latest(src, t, ["inventory_id"], live_stock.STATE_ORDER, ckpt, transform=to_rows).awaitTermination()
    return sinks.read_table(spark, t).select(*preview.SNAPSHOT_COLUMNS)


def _kafka_schema():
    return quality.contract_schema(KAFKA)


# ------------------------------------------------------------------ registry

QUERIES: dict[str, Query] = {
    # models
    "sdp_demo": q_sdp_demo,
    "agg_demo": q_agg_demo,
    "cdp_demo": q_cdp_demo,
    "sdp_preview": q_sdp_preview,
    "cdp_preview": q_cdp_preview,
    "passthrough_copy": q_passthrough_copy,
    "demo_chain_tables": q_demo_chain_tables,
    "preview_chain_tables": q_preview_chain_tables,
    "sdp_incremental_hwm": q_sdp_incremental_hwm,
    "sdp_incremental_range": q_sdp_incremental_range,
    "sdp_incremental_key": q_sdp_incremental_key,
    "sdp_incremental_lookback": q_sdp_incremental_lookback,
    "sdp_incremental_key_newer": q_sdp_incremental_key_newer,
    "cdp_incremental_hwm": q_cdp_incremental_hwm,
    "cdp_incremental_range": q_cdp_incremental_range,
    "cdp_incremental_delta": q_cdp_incremental_delta,
    # literal / Spark-first variants of the models
    "sdp_demo_get_json": q_sdp_demo_get_json,
    "agg_demo_window": q_agg_demo_window,
    "cdp_demo_sweep": q_cdp_demo_sweep,
    "cdp_demo_explode": q_cdp_demo_explode,
    "cdp_preview_explode": q_cdp_preview_explode,
    "sdp_preview_max_by": q_sdp_preview_max_by,
    "daily_stock": q_daily_stock,
    # sources, sinks, streams
    "source_declared_schema": q_source_declared_schema,
    "land_raw_projection": q_land_raw_projection,
    "stream_land_raw": q_stream_land_raw,
    "stream_upsert_latest": q_stream_upsert_latest,
    "stream_dedup_redelivery": q_stream_dedup_redelivery,
    "stream_latest_stateful": q_stream_latest_stateful,
    "full_refresh": q_full_refresh,
    "view_materialization": q_view_materialization,
    "merge_by_key": q_merge_by_key,
    "merge_delta_compact": q_merge_delta_compact,
    "replace_time_range": q_replace_time_range,
    "incremental_first_run": q_incremental_first_run,
    "backfill_daily": q_backfill_daily,
    "backfill_chunked": q_backfill_chunked,
    "write_on_curve": q_write_on_curve,
    # filters
    "filter_null_id": q_filter_null_id,
    "filter_valid_span": q_filter_valid_span,
    "hwm_strict_filter": q_hwm_strict_filter,
    "hwm_inclusive_filter": q_hwm_inclusive_filter,
    "interval_filter_ts": q_interval_filter_ts,
    "interval_filter_date": q_interval_filter_date,
    # windows / latest
    "latest_per_key": q_latest_per_key,
    "dedup_redelivery": q_dedup_redelivery,
    "first_value_full_frame": q_first_value_full_frame,
    "any_value_constant": q_any_value_constant,
    "latest_attributes": q_latest_attributes,
    # aggregates
    "validity_span": q_validity_span,
    "group_by_one": q_group_by_one,
    "group_by_many": q_group_by_many,
    "conditional_count": q_conditional_count,
    # joins
    "left_join_dimension": q_left_join_dimension,
    "left_join_entity": q_left_join_entity,
    "left_join_entity_bucketed": q_left_join_entity_bucketed,
    # generators and day arithmetic
    "explode_days_inner": q_explode_days_inner,
    "explode_days_outer": q_explode_days_outer,
    "expand_days": q_expand_days,
    "date_diff_days": q_date_diff_days,
    "date_diff_unit": q_date_diff_unit,
    # scalar functions
    "json_extract": q_json_extract,
    "json_extract_nested": q_json_extract_nested,
    "json_extract_path": q_json_extract_path,
    "cast_date": q_cast_date,
    "cast_boolean": q_cast_boolean,
    "coalesce_default": q_coalesce_default,
    "pad_open_span": q_pad_open_span,
    # quality
    "contract_projection": q_contract_projection,
    "audit_not_null": q_audit_not_null,
    "audit_accepted_values": q_audit_accepted_values,
    "audit_unique_grain": q_audit_unique_grain,
    "audit_summary": q_audit_summary,
    "table_diff": q_table_diff,
    "table_diff_pruned": q_table_diff_pruned,
}
