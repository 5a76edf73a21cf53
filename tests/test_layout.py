"""Layouts: joins without an exchange, diffs that read what differs, files skipped on either column, chunks by bytes."""

import datetime as dt

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from stockroom.operators.enrich import left_join_entity
from stockroom.operators.quality import table_diff
from stockroom.plans import incremental
from stockroom.session import scratch_database, scratch_path
from stockroom.sinks import layout, tables
from stockroom.streaming.ingest import append_stream, read_stream
from tests.conftest import rows

D = dt.date


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_bucketed_tables_join_without_an_exchange(spark):
    db = scratch_database(spark)
    a = spark.range(2000).select(F.concat(F.lit("V"), "id").alias("k"), F.col("id").alias("x"))
    b = spark.range(0, 3000, 3).select(F.concat(F.lit("V"), "id").alias("k"), F.col("id").alias("y"))
    for _ in range(2):          # replaced, not appended to
        layout.write_bucketed(a, f"{db}.a", ["k"], 4)
        layout.write_bucketed(b, f"{db}.b", ["k"], 4)
    j = left_join_entity(spark.table(f"{db}.a"), spark.table(f"{db}.b").hint("merge"), "k")
    assert "SortMergeJoin" in _plan(j) and "Exchange" not in _plan(j)
    assert rows(j) == rows(left_join_entity(a, b, "k"))
    assert len(spark.table(f"{db}.a").inputFiles()) == 4


def _versions(spark):
    old = spark.range(5000).select("id", (F.col("id") * 2).alias("v"), F.lit(None).cast("string").alias("s"))
    new = old.where("id <> 17").withColumn("v", F.when(F.col("id") == 40, -1).otherwise(F.col("v"))).unionByName(
        spark.createDataFrame([(9999, 1, "x")], old.schema))
    return old, new


def test_only_parts_that_differ_are_read(spark):
    db = scratch_database(spark)
    old, new = _versions(spark)
    layout.write_digested(old, f"{db}.a", ["id"], 32)
    layout.write_digested(new, f"{db}.b", ["id"], 32)
    assert 1 <= len(layout.changed_parts(spark, f"{db}.a", f"{db}.b")) <= 3
    got = layout.table_diff_pruned(spark, f"{db}.a", f"{db}.b", ["id"])
    assert sorted(map(tuple, got.collect())) == [(17, "removed"), (40, "changed"), (9999, "added")]
    assert rows(got) == rows(table_diff(old, new, ["id"]))
    assert len(set(got.inputFiles())) <= 6


def test_equal_tables_read_digests_only(spark, monkeypatch):
    db = scratch_database(spark)
    old, _ = _versions(spark)
    layout.write_digested(old, f"{db}.a", ["id"], 16)
    layout.write_digested(old.repartition(7).orderBy(F.desc("id")), f"{db}.b", ["id"], 16)
    monkeypatch.setattr(layout, "part_digests", lambda *_: 1 / 0)
    assert layout.changed_parts(spark, f"{db}.a", f"{db}.b") == []
    got = layout.table_diff_pruned(spark, f"{db}.a", f"{db}.b", ["id"])
    assert got.count() == 0 and "FileScan" not in got._jdf.queryExecution().optimizedPlan().toString()


def test_digests_of_older_rows_are_not_used(spark):
    db = scratch_database(spark)
    old, new = _versions(spark)
    layout.write_digested(old, f"{db}.a", ["id"], 8)
    layout.write_digested(old, f"{db}.b", ["id"], 8)
    tables.write_full(new.withColumn(tables.PART, tables.bucket_of(["id"], 8)), f"{db}.b", partition_by=[tables.PART])
    assert layout.stored_digests(spark, f"{db}.b") is None
    with pytest.raises(ValueError):
        layout.table_diff_pruned(spark, f"{db}.a", f"{db}.b", ["id"])
    layout.write_digested(new, f"{db}.b", ["id"], 8)
    assert layout.table_diff_pruned(spark, f"{db}.a", f"{db}.b", ["id"]).count() == 3
    with pytest.raises(ValueError):
        layout.table_diff_pruned(spark, f"{db}.a", f"{db}.b", ["v"])


def test_digests_see_nulls_types_and_repeats(spark):
    def digest(data):
        df = spark.createDataFrame(data, "a string, b string").withColumn(tables.PART, F.lit(0))
        return layout.part_digests(df, ["a", "b"]).first()
    assert digest([("x", None)]) != digest([(None, "x")]) != digest([("x", "")])
    assert digest([("x", "y")] * 2) != digest([]) and digest([("x", "y")] * 3)["parity"] == digest([("x", "y")])["parity"]
    assert digest([("x", "y")] * 3) != digest([("x", "y")])
    assert digest([("p", "q"), ("r", "s")]) == digest([("r", "s"), ("p", "q")])


def _touched(files, column, lo, hi):
    """Row groups that the statistics do not rule out."""
    n = total = 0
    for f in files:
        meta = pq.ParquetFile(f.replace("file://", "").replace("file:", "")).metadata
        at = [meta.schema.column(i).name for i in range(meta.num_columns)].index(column)
        for g in range(meta.num_row_groups):
            s = meta.row_group(g).column(at).statistics
            total += 1
            n += not (s.max < lo or s.min > hi)
    return n, total


def test_either_column_skips_row_groups_on_the_curve(spark):
    db = scratch_database(spark)
    df = spark.range(40_000).select(F.pmod(F.xxhash64("id"), F.lit(1000)).alias("a"),
                                    F.pow(F.pmod(F.xxhash64(F.col("id") + 7), F.lit(100)).cast("double"), 3).alias("b"),
                                    F.concat(F.lit("k"), F.pmod("id", F.lit(97))).alias("c"))
    layout.write_on_curve(df, f"{db}.z", ["a", "b"], files=16)
    tables.write_full(df.repartitionByRange(16, "a").sortWithinPartitions("a"), f"{db}.line")
    z, line = spark.table(f"{db}.z").inputFiles(), spark.table(f"{db}.line").inputFiles()
    assert rows(spark.table(f"{db}.z").groupBy("a").count()) == rows(df.groupBy("a").count())
    for column, lo, hi in (("a", 100, 120), ("b", 100.0, 150.0)):
        n, total = _touched(z, column, lo, hi)
        assert total >= 16 and n <= total / 2, column
    n, total = _touched(line, "b", 100.0, 150.0)
    assert n == total                                     # one column only: the other skips nothing
    layout.write_on_curve(df, f"{db}.text", ["c", "a"], files=8)
    assert spark.table(f"{db}.text").count() == 40_000
    layout.write_on_curve(df.where("a < 0"), f"{db}.none", ["a", "b"], files=4)
    assert spark.table(f"{db}.none").count() == 0


def test_chunks_by_bytes_resume(spark):
    db = scratch_database(spark)
    days = spark.range(0, 12_000).select(F.expr("date_add(date'2024-01-01', cast(id % 12 as int))").alias("d"), "id",
                                         F.md5(F.col("id").cast("string")).alias("x"))
    raw = days.withColumn("event_date", F.col("d"))
    tables.write_full(raw.repartition("event_date"), f"{db}.raw", partition_by=["event_date"])
    sizes = incremental.day_bytes(spark, f"{db}.raw", "event_date", "2024-01-02", "2024-01-11")
    assert sorted(sizes) == [D(2024, 1, i) for i in range(2, 12)] and all(sizes.values())
    ran, t = [], f"{db}.t"

    def run(s, e):
        if len(ran) == 2:
            raise RuntimeError("stopped")
        ran.append((s, e))
        tables.replace_time_range(spark, t, spark.table(f"{db}.raw").drop("event_date"), "d", s, e, unit="date")

    budget = 3 * max(sizes.values())
    with pytest.raises(RuntimeError):
        incremental.backfill_chunked(spark, run, f"{db}.raw", t, "2024-01-02", "2024-01-11", budget)
    stopped, ran[:] = list(ran), ["", ""][:0]
    rest = incremental.backfill_chunked(spark, run, f"{db}.raw", t, "2024-01-02", "2024-01-11", budget)
    assert len(stopped) == 2 and str(rest[0][0]) > stopped[-1][1]
    assert spark.table(t).count() == 10_000 and tables.missing_days(spark, t, "2024-01-02", "2024-01-11") == []
    assert incremental.backfill_chunked(spark, run, f"{db}.raw", t, "2024-01-02", "2024-01-11", budget) == []


def test_chunk_plan():
    days = [D(2024, 1, i) for i in (1, 2, 3, 5, 6, 7)]
    sizes = dict(zip(days, (10, 10, 10, 99, 1, 1)))
    assert incremental.plan_chunks(days, sizes, 20) == [(days[0], days[1]), (days[2], days[2]), (days[3], days[3]), (days[4], days[5])]
    assert incremental.plan_chunks([], {}, 1) == []


def test_a_landed_day_has_few_files(spark):
    path, t = scratch_path(spark, "in"), f"{scratch_database(spark)}.t"
    df = spark.range(0, 6000, 1, 12).select("id", F.expr("date_add(date'2024-01-01', cast(id % 5 as int))").alias("day"))
    df.write.parquet(path)
    src = read_stream(spark, "parquet", df.schema, path)
    append_stream(src, t, scratch_path(spark, "ckpt"), partition_by=("day",), files=2).awaitTermination()
    files = spark.table(t).inputFiles()
    assert len(files) <= 10 and spark.table(t).count() == 6000
