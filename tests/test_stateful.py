"""Stream state: bounded by the watermark, kept over restarts, only touched keys written."""

import datetime as dt

from pyspark.sql import functions as F

from stockroom.session import scratch_database, scratch_path
from stockroom.sinks import versions
from stockroom.streaming.ingest import append_stream, read_stream
from stockroom.streaming.stateful import dedup_stream, stream_latest
from tests.conftest import rows

T = dt.datetime
SCHEMA = "k string, t timestamp_ntz, v int"


def _files(spark, path, data):
    spark.createDataFrame(data, SCHEMA).coalesce(1).write.mode("append").parquet(path)


def _source(spark, path):
    return read_stream(spark, "parquet", spark.createDataFrame([], SCHEMA).schema, path, maxFilesPerTrigger="1")


def test_state_is_bounded_by_the_watermark_over_restarts(spark):
    path, ckpt, table = scratch_path(spark, "in"), scratch_path(spark, "ckpt"), f"{scratch_database(spark)}.t"
    held = []
    for day in range(1, 11):
        new = [(f"k{day}-{i}", T(2024, 1, day, i), i) for i in range(20)]
        again = [(k, t, v) for k, t, v in ([(f"k{day - 1}-{i}", T(2024, 1, day - 1, i), i) for i in range(20)] if day > 1 else [])]
        _files(spark, path, new + again)
        q = append_stream(dedup_stream(_source(spark, path), ["k"], "t", "1 day"), table, ckpt)
        q.awaitTermination()                      # each day is a restart
        held.append(q.lastProgress["stateOperators"][0]["numRowsTotal"])
    got = spark.table(table)
    assert got.count() == got.select("k").distinct().count() == 200
    assert max(held) <= 80                        # of 200 keys, those of two delays and the day in hand
    _files(spark, path, [("k1-0", T(2024, 1, 1, 0), 0)])     # later than the watermark: a late row, dropped
    append_stream(dedup_stream(_source(spark, path), ["k"], "t", "1 day"), table, ckpt).awaitTermination()
    assert spark.table(table).count() == 200


def test_latest_writes_only_the_keys_of_a_batch(spark):
    path, ckpt, table = scratch_path(spark, "in"), scratch_path(spark, "ckpt"), f"{scratch_database(spark)}.t"
    batches = [[(f"k{i}", T(2024, 1, 5), 0) for i in range(100)] + [(None, T(2024, 1, 5), 0)],
               [("k1", T(2024, 1, 6), 1), ("k2", T(2024, 1, 4), 1), ("new", T(2024, 1, 1), 1)],
               [("k1", T(2024, 1, 6), 1)]]
    written = []
    for data in batches:
        _files(spark, path, data)
        stream_latest(_source(spark, path), table, ["k"], ["t", "v"], ckpt).awaitTermination()
        state = versions.state_of(spark, table)
        written.append(state["rows"])
    assert written == [0, 3, 4]                   # deltas hold the touched keys, not the table
    want = [(f"k{i}", T(2024, 1, 5), 0) for i in range(100) if i != 1] + [("k1", T(2024, 1, 6), 1), ("new", T(2024, 1, 1), 1)]
    assert rows(spark.table(table)) == sorted(want, key=repr)
    # A new checkpoint over the same files moves nothing back.
    stream_latest(_source(spark, path), table, ["k"], ["t", "v"], scratch_path(spark, "ckpt")).awaitTermination()
    assert rows(spark.table(table)) == sorted(want, key=repr)


def test_null_times_and_keys(spark):
    path, ckpt, table = scratch_path(spark, "in"), scratch_path(spark, "ckpt"), f"{scratch_database(spark)}.t"
    _files(spark, path, [("a", None, 1), ("a", None, 2), ("b", T(2024, 1, 1), 1)])
    stream_latest(_source(spark, path), table, ["k"], ["t", "v"], ckpt).awaitTermination()
    assert rows(spark.table(table)) == sorted([("a", None, 2), ("b", T(2024, 1, 1), 1)], key=repr)
    empty = F.col("v") > 9
    stream_latest(_source(spark, path).where(empty), f"{table}2", ["k"], ["t"], scratch_path(spark, "ckpt")).awaitTermination()
    assert spark.table(f"{table}2").count() == 0


def test_micro_batch_upsert_by_delta(spark):
    from stockroom.streaming.upsert import stream_upsert_latest
    path, db = scratch_path(spark, "in"), scratch_database(spark)
    for data in ([(f"k{i}", T(2024, 1, 5), i) for i in range(30)], [("k1", T(2024, 1, 4), 9), ("k2", T(2024, 1, 6), 9)]):
        _files(spark, path, data)
        for store in ("rewrite", "delta"):
            stream_upsert_latest(_source(spark, path), f"{db}.{store}", ["k"], ["t"], scratch_path(spark, "ckpt"), store=store).awaitTermination()
    from stockroom.sinks import read_table
    got = [rows(read_table(spark, f"{db}.{store}")) for store in ("rewrite", "delta")]
    assert got[0] == got[1] and len(got[0]) == 30 and ("k2", T(2024, 1, 6), 9) in got[0]
