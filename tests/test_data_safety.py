"""Filters on one column only, marks and refreshes that survive a failure."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from stockroom.operators.filters import above_mark, in_interval
from stockroom.operators.quality import schema_diff, table_diff
from stockroom.plans import incremental
from stockroom.plans.preview import sdp_preview
from stockroom.session import scratch_database
from stockroom.sinks import tables as sinks
from stockroom.streaming.upsert import stream_upsert_latest

T = dt.datetime


def _late(spark):
    """Processed on one day, one row with an older event day."""
    return spark.createDataFrame(
        [(1, T(2024, 1, 20, 8), dt.date(2024, 1, 20)), (2, T(2024, 1, 20, 9), dt.date(2024, 1, 10))],
        "id int, processed_at timestamp_ntz, event_date date")


def test_a_day_column_is_used_only_when_named(spark):
    df = _late(spark)
    assert in_interval(df, "processed_at", "2024-01-20", "2024-01-20").count() == 2
    assert above_mark(df, "processed_at", T(2024, 1, 20, 1)).count() == 2
    assert above_mark(df, "processed_at", T(2024, 1, 20, 1), day_col="event_date").count() == 1


@pytest.mark.parametrize("bound", ["2024-01-20 12:00:00", T(2024, 1, 20, 12), 20240120])
def test_bounds_finer_than_a_day_are_refused(spark, bound):
    with pytest.raises(ValueError):
        in_interval(_late(spark), "processed_at", bound, "2024-01-21")
    with pytest.raises(ValueError):
        sinks.replace_time_range(spark, "nowhere", _late(spark), "processed_at", "2024-01-20", bound)


def test_failed_refresh_keeps_the_old_table(spark):
    t = f"{scratch_database(spark)}.t"
    sinks.write_full(spark.range(5), t)
    with pytest.raises(Exception):
        sinks.write_full(spark.range(9).select(F.raise_error(F.lit("stop")).cast("long").alias("id")), t)
    assert spark.table(t).count() == 5
    sinks.write_full(spark.range(7), t)
    assert spark.table(t).count() == 7
    assert [r.tableName for r in spark.sql(f"SHOW TABLES IN {t.split('.')[0]}").collect() if not r.isTemporary] == ["t"]


def _raw(spark, first, last):
    return (spark.range(first, last).select(
        F.col("id").cast("string").alias("key"), F.lit("t").alias("topic"),
        (F.lit("2024-01-01").cast("timestamp_ntz") + F.make_dt_interval(hours=F.col("id").cast("int"))).alias("timestamp"),
        F.format_string('{"vehicleSnapshot":{"id":"V%s","creationDateTime":"2024-01-01T00:00:00"}}',
                        F.pmod("id", F.lit(40)).cast("string")).alias("value"),
        F.lit("2024-02-01").cast("timestamp_ntz").alias("processed_at")))


def test_interrupted_merge_is_repeated_in_full(spark, monkeypatch):
    t = f"{scratch_database(spark)}.snap"
    incremental.sdp_incremental_hwm(spark, _raw(spark, 0, 100), t)
    whole = sinks._insert_dynamic

    def half(session, path, schema, table, columns):
        """Commits half of the buckets, then stops."""
        half_path = path + "-half"
        session.read.schema(schema).parquet(path).where(F.col(sinks.PART) < 8).write.parquet(half_path)
        whole(session, half_path, schema, table, columns)
        raise RuntimeError("stopped")

    monkeypatch.setattr(sinks, "_insert_dynamic", half)
    with pytest.raises(RuntimeError):
        incremental.sdp_incremental_hwm(spark, _raw(spark, 0, 200), t)
    monkeypatch.setattr(sinks, "_insert_dynamic", whole)
    incremental.sdp_incremental_hwm(spark, _raw(spark, 0, 200), t)
    want = sorted(map(tuple, sdp_preview(_raw(spark, 0, 200)).collect()))
    assert sorted(map(tuple, sinks.read_table(spark, t).select(*sdp_preview(_raw(spark, 0, 1)).columns).collect())) == want


def test_lookback_and_newer_only(spark):
    db = scratch_database(spark)
    a, b = f"{db}.a", f"{db}.b"
    incremental.sdp_incremental_hwm(spark, _raw(spark, 10, 30), a)
    late = _raw(spark, 0, 30)
    incremental.sdp_incremental_hwm(spark, late, a, lookback=dt.timedelta(days=2))
    assert sinks.read_table(spark, a).count() == 30
    incremental.sdp_incremental_key(spark, _raw(spark, 0, 90), b, "2024-01-03", "2024-01-04")
    new = sinks.read_table(spark, b).agg(F.max("event_timestamp")).first()[0]
    incremental.sdp_incremental_key(spark, _raw(spark, 0, 90), b, "2024-01-01", "2024-01-02", only_if_newer=True)
    assert sinks.read_table(spark, b).agg(F.max("event_timestamp")).first()[0] == new


def test_table_diff_on_a_changed_copy(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "k int, v string")
    new = old.where("k < 3").withColumn("v", F.when(F.col("k") == 2, "x").otherwise(F.col("v"))).withColumn("w", F.lit(1))
    assert sorted(map(tuple, table_diff(old, new, ["k"]).collect())) == [(2, "changed"), (3, "removed")]
    assert schema_diff(old, new) == {"added": ["w"], "removed": [], "changed": []}
    with pytest.raises(Exception, match="repeated key"):
        table_diff(old.union(old), old, ["k"]).collect()


def test_stream_guard_must_be_stored(spark):
    with pytest.raises(ValueError, match="order columns"):
        stream_upsert_latest(spark.readStream.format("rate").load(), "t", ["value"], ["timestamp"], "/tmp/none",
                             columns=["value"])
