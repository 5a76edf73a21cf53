import datetime as dt

from pyspark.sql import functions as F

from stockroom.plans import incremental, preview
from stockroom.session import scratch_database
from stockroom.sinks import read_table, write_full
from stockroom.sources import fixtures
from tests.conftest import SF_SMALL, rows

T = dt.datetime


def _raw(spark, data):
    """Raw preview rows from (ts, id, creation, removal)."""
    out = []
    for ts, vid, c, r in data:
        body = f'"id":"{vid}","creationDateTime":"{c}T00:00:00"'
        if r:
            body += f',"removalDateTime":"{r}T00:00:00"'
        out.append(("k", "t", ts, '{"vehicleSnapshot":{' + body + '}}', ts + dt.timedelta(hours=1)))
    return spark.createDataFrame(out, "key string, topic string, timestamp timestamp_ntz, "
                                      "value string, processed_at timestamp_ntz")


def test_hwm_loses_late_events(spark):
    """T4: an event not newer than the mark never loads."""
    db = scratch_database(spark)
    raw, t = f"{db}.raw", f"{db}.snap"
    write_full(_raw(spark, [(T(2024, 1, 5), "A", "2024-01-01", None)]), raw)
    incremental.sdp_incremental_hwm(spark, spark.table(raw), t)
    _raw(spark, [(T(2024, 1, 3), "B", "2024-01-01", None),
                 (T(2024, 1, 6), "C", "2024-01-01", None)]).write.mode("append").insertInto(raw)
    incremental.sdp_incremental_hwm(spark, spark.table(raw), t)
    assert sorted(r["inventory_id"] for r in read_table(spark, t).collect()) == ["A", "C"]


def test_hwm_equals_full_without_late_events(spark):
    raw_all = fixtures.frame(spark, SF_SMALL, "raw_preview")
    cut = T(2024, 1, 15)
    db = scratch_database(spark)
    raw, t = f"{db}.raw", f"{db}.snap"
    write_full(raw_all.where(F.col("timestamp") < cut), raw)
    incremental.sdp_incremental_hwm(spark, spark.table(raw), t)
    raw_all.where(F.col("timestamp") >= cut).write.mode("append").insertInto(raw)
    incremental.sdp_incremental_hwm(spark, spark.table(raw), t)
    assert rows(read_table(spark, t)) == rows(preview.sdp_preview(raw_all))


def test_interval_backfill_one_job_equals_day_by_day(spark):
    """T6/IO12: the day is part of the key, so one run == daily runs."""
    raw_all = fixtures.frame(spark, SF_SMALL, "raw_preview")
    db = scratch_database(spark)
    raw = f"{db}.raw"
    write_full(raw_all, raw)
    for model in (incremental.sdp_incremental_range, incremental.sdp_incremental_key):
        a, b = f"{db}.{model.__name__}_a", f"{db}.{model.__name__}_b"
        incremental.backfill(lambda s, e: model(spark, spark.table(raw), a, s, e),
                             "2024-01-18", "2024-01-21", one_job=True)
        incremental.backfill(lambda s, e: model(spark, spark.table(raw), b, s, e),
                             "2024-01-18", "2024-01-21", one_job=False)
        assert rows(read_table(spark, a)) == rows(read_table(spark, b))


def test_range_model_keeps_one_row_per_vehicle_and_day(spark):
    db = scratch_database(spark)
    raw = _raw(spark, [(T(2024, 1, 1, 5), "A", "2024-01-01", None),
                       (T(2024, 1, 1, 9), "A", "2024-01-01", "2024-01-03"),
                       (T(2024, 1, 2, 9), "A", "2024-01-01", "2024-01-04")])
    t = f"{db}.r"
    incremental.sdp_incremental_range(spark, raw, t, "2024-01-01", "2024-01-02")
    got = rows(read_table(spark, t).select("event_timestamp", "removal_date_time"))
    assert got == [(T(2024, 1, 1, 9), "2024-01-03T00:00:00"), (T(2024, 1, 2, 9), "2024-01-04T00:00:00")]


def test_cdp_range_replaces_days_that_became_empty(spark):
    """T8: the range form rewrites every day of its range."""
    db = scratch_database(spark)
    t = f"{db}.cdp"
    snap1 = spark.createDataFrame([(T(2024, 1, 1), "A", "2024-01-04T00:00:00", "2024-01-01T00:00:00")],
                                  "event_timestamp timestamp_ntz, inventory_id string, "
                                  "removal_date_time string, creation_date_time string")
    incremental.cdp_incremental_range(spark, snap1, t, "2024-01-01", "2024-01-10", "2024-02-01 00:00:00")
    assert read_table(spark, t).count() == 4
    snap2 = snap1.withColumn("removal_date_time", F.lit("2024-01-02T00:00:00"))
    incremental.cdp_incremental_range(spark, snap2, t, "2024-01-01", "2024-01-10", "2024-02-01 00:00:00")
    assert sorted(str(r["stock_date"]) for r in read_table(spark, t).collect()) == ["2024-01-01", "2024-01-02"]


def test_hwm_empty_existing_target_loads_everything(spark):
    """T4 deviation: an existing but empty target has no mark -> full load
    (with a null mark the strict filter would never load anything)."""
    db = scratch_database(spark)
    raw, t = f"{db}.raw", f"{db}.snap"
    data = _raw(spark, [(T(2024, 1, 5), "A", "2024-01-01", None), (T(2024, 1, 6), "B", "2024-01-01", None)])
    write_full(data, raw)
    spark.sql(f"CREATE TABLE {t} (event_timestamp timestamp_ntz, inventory_id string, "
              f"removal_date_time string, creation_date_time string, _part int) "
              f"USING parquet PARTITIONED BY (_part) "
              f"TBLPROPERTIES ('stockroom.merge.buckets' = '16', 'stockroom.merge.keys' = 'inventory_id')")
    incremental.sdp_incremental_hwm(spark, spark.table(raw), t)
    assert sorted(r["inventory_id"] for r in read_table(spark, t).collect()) == ["A", "B"]


def test_demo_chain_audits_block_or_warn(spark):
    import pytest
    from stockroom.plans.project import AuditError, run_demo_chain
    raw = fixtures.frame(spark, SF_SMALL, "raw_demo")
    m, v = fixtures.frame(spark, SF_SMALL, "markets"), fixtures.frame(spark, SF_SMALL, "vehicle_data")
    db = scratch_database(spark)
    summary = {r["audit"]: r["violations"] for r in run_demo_chain(spark, db, raw, m, v).collect()}
    assert summary["assert_vehicle_condition_not_null"] > 0 and summary["assert_unique_grain"] == 0
    desc = {r[0]: r[1] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {db}.agg_inventory_reporting_demo").collect()}
    assert desc["Comment"].startswith("One row per vehicle")
    with pytest.raises(AuditError):
        run_demo_chain(spark, scratch_database(spark), raw, m, v, audits="error")
