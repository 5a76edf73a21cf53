import datetime as dt

import pytest
from pyspark.sql import functions as F

from stockroom.session import scratch_database
from stockroom.sinks import (
    SchemaDriftError, incremental_or_full, merge_by_key, read_table, replace_time_range,
    table_exists, with_comments, write_full,
)
from tests.conftest import rows

D = dt.date


def _kv(spark, data):
    return spark.createDataFrame(data, "k string, v int, ts timestamp_ntz")


T = dt.datetime


def test_merge_insert_replace_never_delete(spark):
    t = f"{scratch_database(spark)}.m"
    merge_by_key(spark, t, _kv(spark, [("a", 1, T(2024, 1, 1)), ("b", 1, T(2024, 1, 1))]), ["k"], buckets=4)
    merge_by_key(spark, t, _kv(spark, [("b", 2, T(2024, 1, 2)), ("c", 2, T(2024, 1, 2))]), ["k"], buckets=4)
    assert rows(read_table(spark, t).select("k", "v")) == [("a", 1), ("b", 2), ("c", 2)]
    # Replaying the same batch changes nothing (idempotent).
    merge_by_key(spark, t, _kv(spark, [("b", 2, T(2024, 1, 2)), ("c", 2, T(2024, 1, 2))]), ["k"], buckets=4)
    assert read_table(spark, t).count() == 3


def test_merge_recency_guard(spark):
    t = f"{scratch_database(spark)}.m"
    merge_by_key(spark, t, _kv(spark, [("a", 2, T(2024, 1, 5))]), ["k"])
    merge_by_key(spark, t, _kv(spark, [("a", 1, T(2024, 1, 1))]), ["k"], order=["ts"])
    assert rows(read_table(spark, t).select("k", "v")) == [("a", 2)]
    merge_by_key(spark, t, _kv(spark, [("a", 1, T(2024, 1, 1))]), ["k"])   # no guard: batch wins
    assert rows(read_table(spark, t).select("k", "v")) == [("a", 1)]


def test_merge_rejects_null_and_duplicate_keys(spark):
    t = f"{scratch_database(spark)}.m"
    with pytest.raises(ValueError):
        merge_by_key(spark, t, _kv(spark, [(None, 1, T(2024, 1, 1))]), ["k"])
    with pytest.raises(ValueError):
        merge_by_key(spark, t, _kv(spark, [("a", 1, T(2024, 1, 1)), ("a", 2, T(2024, 1, 1))]), ["k"])


def test_merge_schema_drift_fails(spark):
    t = f"{scratch_database(spark)}.m"
    merge_by_key(spark, t, _kv(spark, [("a", 1, T(2024, 1, 1))]), ["k"])
    with pytest.raises(SchemaDriftError):
        merge_by_key(spark, t, _kv(spark, [("b", 1, T(2024, 1, 1))]).withColumn("extra", F.lit(1)), ["k"])


def _daily(spark, data):
    return spark.createDataFrame(data, "d date, n int")


def test_replace_range_drops_days_that_became_empty_keeps_null_time(spark):
    t = f"{scratch_database(spark)}.r"
    replace_time_range(spark, t, _daily(spark, [(D(2024, 1, i), i) for i in range(1, 6)] + [(None, 0)]),
                       "d", "2000-01-01", "2099-01-01", unit="date")
    # A null time lies in no interval, so that row is never written.
    assert read_table(spark, t).count() == 5
    replace_time_range(spark, t, _daily(spark, [(D(2024, 1, 2), 20)]), "d", "2024-01-02", "2024-01-03",
                       unit="date")
    assert rows(read_table(spark, t)) == [(D(2024, 1, 1), 1), (D(2024, 1, 2), 20), (D(2024, 1, 4), 4),
                                          (D(2024, 1, 5), 5)]


def test_replace_range_timestamp_is_half_open_by_day(spark):
    t = f"{scratch_database(spark)}.r"
    df = spark.createDataFrame([(T(2024, 1, 1, 23), 1), (T(2024, 1, 2, 0), 2), (T(2024, 1, 2, 23, 59), 3),
                                (T(2024, 1, 3, 0), 4)], "ts timestamp_ntz, n int")
    replace_time_range(spark, t, df, "ts", "2024-01-02", "2024-01-02")
    assert sorted(r["n"] for r in read_table(spark, t).collect()) == [2, 3]


def test_full_refresh_first_run_switch_and_comments(spark):
    db = scratch_database(spark)
    t = f"{db}.f"
    assert not table_exists(spark, t)
    seen = []
    build = lambda target: (seen.append(target is None), spark.range(3))[1]
    write_full(incremental_or_full(spark, t, build), t, comment="first")
    write_full(incremental_or_full(spark, t, build), t)
    assert seen == [True, False] and read_table(spark, t).count() == 3
    with_comments(spark, t, "it's a table", {"id": "row id"})
    desc = {r[0]: r[1] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {t}").collect()}
    assert desc["Comment"] == "it's a table"
    assert spark.table(t).schema["id"].metadata.get("comment") == "row id"


def test_merge_reads_only_touched_buckets(spark):
    from stockroom.sinks.tables import PART, bucket_of
    t = f"{scratch_database(spark)}.m"
    data = [(f"k{i}", i, T(2024, 1, 1)) for i in range(200)]
    merge_by_key(spark, t, _kv(spark, data), ["k"], buckets=8)
    batch = _kv(spark, [("k1", 99, T(2024, 1, 2))])
    b = batch.select(bucket_of(["k"], 8)).first()[0]
    merge_by_key(spark, t, batch, ["k"], buckets=8)
    got = read_table(spark, t)
    assert got.count() == 200 and got.where("k = 'k1'").first()["v"] == 99
    files = spark.table(t).select(PART, F.input_file_name().alias("f")).distinct()
    assert files.where(F.col(PART) == b).count() >= 1


def test_merge_uses_stored_bucket_count_and_keys(spark):
    t = f"{scratch_database(spark)}.m"
    data = [(f"k{i}", i, T(2024, 1, 1)) for i in range(50)]
    merge_by_key(spark, t, _kv(spark, data), ["k"], buckets=8)
    merge_by_key(spark, t, _kv(spark, [(f"k{i}", -i, T(2024, 1, 2)) for i in range(50)]), ["k"], buckets=3)
    got = read_table(spark, t)
    assert got.count() == 50 and got.where("v > 0").count() == 0
    with pytest.raises(ValueError):
        merge_by_key(spark, t, _kv(spark, data), ["v"])


def test_session_settings_untouched_by_dynamic_writes(spark):
    key = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(key)
    t = f"{scratch_database(spark)}.m"
    merge_by_key(spark, t, _kv(spark, [("a", 1, T(2024, 1, 1))]), ["k"])
    merge_by_key(spark, t, _kv(spark, [("a", 2, T(2024, 1, 1))]), ["k"])
    assert spark.conf.get(key) == before
    assert [r["v"] for r in read_table(spark, t).collect()] == [2]


def test_staging_space_is_bounded_per_target(spark):
    import os
    from stockroom.session import shared_dir
    t = f"{scratch_database(spark)}.m"
    for i in range(3):
        merge_by_key(spark, t, _kv(spark, [(f"k{j}", i, T(2024, 1, 1)) for j in range(5)]), ["k"])
    root = shared_dir(spark).replace("file:", "")
    stage = os.path.join(root, "stockroom", "stage", t)
    assert sorted(os.listdir(stage)) == []
    assert {r["v"] for r in read_table(spark, t).collect()} == {2}
