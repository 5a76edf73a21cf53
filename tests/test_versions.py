"""One-step commits: merges by delta, range replace, compaction, undo, stops at every step."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from stockroom.session import scratch_database
from stockroom.sinks import tables, versions
from stockroom.sinks.tables import SchemaDriftError
from tests.conftest import rows

D, T = dt.date, dt.datetime


def _kv(spark, data):
    return spark.createDataFrame(data, "k string, v int, ts timestamp_ntz")


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _name(spark):
    return f"{scratch_database(spark)}.t"


def test_merge_by_delta_equals_merge_by_rewrite(spark):
    a, b = _name(spark), _name(spark)
    batches = [[(f"k{i}", i, T(2024, 1, 1)) for i in range(40)],
               [(f"k{i}", -i, T(2024, 1, 2)) for i in range(0, 60, 3)],
               [("k3", 33, T(2024, 1, 1)), ("new", 1, T(2024, 1, 3))], []]
    for order in ([], ["ts"]):
        a, b = _name(spark), _name(spark)
        for x in batches:
            versions.merge(spark, a, _kv(spark, x), ["k"], order=order)
            tables.merge_by_key(spark, b, _kv(spark, x), ["k"], order=order or None)
            assert rows(spark.table(a)) == rows(tables.read_table(spark, b).select("k", "v", "ts"))
        versions.compact(spark, a)
        assert versions.state_of(spark, a)["deltas"] == []
        assert rows(spark.table(a)) == rows(tables.read_table(spark, b).select("k", "v", "ts"))


def test_delta_writes_the_batch_not_the_buckets(spark):
    t = _name(spark)
    versions.merge(spark, t, spark.range(100_000).select("id", F.lit(0).alias("v")), ["id"])
    before = set(spark.table(t).inputFiles())
    scattered = spark.range(0, 100_000, 1000).select("id", F.lit(1).alias("v"))
    versions.merge(spark, t, scattered, ["id"])
    data = spark.table(f"{t}__data")
    assert data.count() == 100_100 and before <= set(data.inputFiles())
    got = spark.table(t)
    assert got.agg(F.sum("v"), F.count("*"), F.count_distinct("id")).first() == (100, 100_000, 100_000)
    plan = _plan(got)
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    base = [x for x in plan.splitlines() if "LeftAnti" in x]
    assert base and "Exchange hashpartitioning" not in "\n".join(base)      # the base is not shuffled


def test_deltas_past_the_bound_are_not_broadcast(spark, monkeypatch):
    monkeypatch.setattr(versions, "MAX_BROADCAST_ROWS", 5)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        t = _name(spark)
        for v in (0, 1):
            versions.merge(spark, t, spark.range(100).select("id", F.lit(v).alias("v")), ["id"])
        assert "SortMergeJoin" in _plan(spark.table(t)) and spark.table(t).agg(F.sum("v")).first()[0] == 100
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_compaction_rewrites_touched_buckets_only(spark):
    t = _name(spark)
    versions.merge(spark, t, spark.range(2000).select("id", F.lit(0).alias("v")), ["id"])
    before = set(spark.table(t).inputFiles())
    versions.merge(spark, t, spark.range(1).select("id", F.lit(1).alias("v")), ["id"])
    versions.compact(spark, t)
    after = set(spark.table(t).inputFiles())
    assert len(before - after) == 1 and spark.table(t).agg(F.sum("v"), F.count("*")).first() == (1, 2000)
    versions.compact(spark, t, buckets=40)
    assert spark.table(t).agg(F.sum("v"), F.count("*")).first() == (1, 2000)
    versions.merge(spark, t, spark.range(1999, 2003).select("id", F.lit(1).alias("v")), ["id"])
    assert spark.table(t).agg(F.sum("v"), F.count("*")).first() == (5, 2003)
    parts = {int(p) for _, p in versions._parts(spark, f"{t}__data")}
    assert max(parts) > 16


def test_many_deltas_are_compacted_and_files_dropped(spark):
    t = _name(spark)
    for i in range(6):
        versions.merge(spark, t, spark.range(i, i + 3).select("id", F.lit(i).alias("v")), ["id"], max_deltas=3)
    state = versions.state_of(spark, t)
    assert len(state["deltas"]) <= 3
    assert rows(spark.table(t)) == [(0, 0), (1, 1), (2, 2), (3, 3), (4, 4), (5, 5), (6, 5), (7, 5)]
    versions.merge(spark, t, spark.range(1).select("id", F.lit(9).alias("v")), ["id"])
    shown = {f for f in spark.table(f"{t}__data").inputFiles()}
    assert shown == set(spark.table(t).inputFiles())          # nothing is kept that no reader sees


def test_merge_checks_keys_schema_and_order(spark):
    t = _name(spark)
    with pytest.raises(ValueError):
        versions.merge(spark, t, _kv(spark, [(None, 1, None)]), ["k"])
    assert not tables.table_exists(spark, t)
    versions.merge(spark, t, _kv(spark, [("a", 1, T(2024, 1, 5))]), ["k"])
    for bad in ([("b", 1, None), ("b", 2, None)], [(None, 1, None)]):
        with pytest.raises(ValueError):
            versions.merge(spark, t, _kv(spark, bad), ["k"])
    with pytest.raises(SchemaDriftError):
        versions.merge(spark, t, _kv(spark, []).withColumn("x", F.lit(1)), ["k"])
    with pytest.raises(ValueError):
        versions.merge(spark, t, _kv(spark, []), ["v"])
    with pytest.raises(versions.NotVersionedError):
        versions.replace_range(spark, t, _kv(spark, []), "ts", "2024-01-01", "2024-01-02")
    assert rows(spark.table(t)) == [("a", 1, T(2024, 1, 5))]
    # Deltas of another order are folded in first.
    versions.merge(spark, t, _kv(spark, [("a", 2, T(2024, 1, 3))]), ["k"])
    versions.merge(spark, t, _kv(spark, [("a", 3, T(2024, 1, 1))]), ["k"], order=["ts"])
    assert rows(spark.table(t)) == [("a", 2, T(2024, 1, 3))]


def test_marks_come_with_the_commit_and_never_fall(spark):
    t = _name(spark)
    for day, want in ((5, 5), (9, 9), (3, 9)):
        versions.merge(spark, t, _kv(spark, [(f"k{day}", 1, T(2024, 1, day, 1, 2, 3, 400))]), ["k"], marks=["ts"])
        assert T.fromisoformat(tables.committed_mark(spark, t, "ts")).day == want
    versions.merge(spark, t, _kv(spark, []), ["k"], marks=["ts"])
    assert T.fromisoformat(tables.committed_mark(spark, t, "ts")) == T(2024, 1, 9, 1, 2, 3, 400)


def _days(spark, data):
    return spark.createDataFrame(data, "d date, n int")


def test_replace_range_keeps_other_days_and_reads_new_files_only(spark):
    t = _name(spark)
    full = [(D(2024, 1, i), i) for i in range(1, 11)]
    versions.replace_range(spark, t, _days(spark, full), "d", "2024-01-01", "2024-01-31", unit="date")
    before = set(spark.table(t).inputFiles())
    versions.replace_range(spark, t, _days(spark, [(D(2024, 1, 3), 30), (D(2024, 1, 20), 9)]), "d", "2024-01-02", "2024-01-04",
                           unit="date", marks=["d"])
    assert rows(spark.table(t)) == sorted([full[0], (D(2024, 1, 3), 30), *full[4:]], key=repr)
    assert len(before & set(spark.table(t).inputFiles())) == 7
    assert tables.committed_mark(spark, t, "d") == "2024-01-03"
    versions.undo(spark, t)
    assert rows(spark.table(t)) == sorted(full, key=repr) and tables.committed_mark(spark, t, "d") is None
    with pytest.raises(ValueError):
        versions.undo(spark, t)
    versions.replace_range(spark, t, _days(spark, []), "d", "2024-01-01", "2024-01-09", unit="date")
    assert rows(spark.table(t)) == full[9:]
    assert spark.table(f"{t}__data").count() == 10           # hidden until the next commit
    versions.replace_range(spark, t, _days(spark, full[:1]), "d", "2024-01-01", "2024-01-01", unit="date")
    assert spark.table(f"{t}__data").count() == 2


def test_undo_a_merge_and_a_compaction(spark):
    t = _name(spark)
    versions.merge(spark, t, _kv(spark, [("a", 1, None), ("b", 1, None)]), ["k"])
    versions.merge(spark, t, _kv(spark, [("a", 2, None)]), ["k"])
    versions.undo(spark, t)
    assert rows(spark.table(t).select("k", "v")) == [("a", 1), ("b", 1)]
    versions.merge(spark, t, _kv(spark, [("a", 3, None)]), ["k"])
    versions.compact(spark, t)
    versions.undo(spark, t)
    assert versions.state_of(spark, t)["deltas"] and rows(spark.table(t).select("k", "v")) == [("a", 3), ("b", 1)]
    versions.merge(spark, t, _kv(spark, [("b", 4, None)]), ["k"])
    assert rows(spark.table(t).select("k", "v")) == [("a", 3), ("b", 4)]


STEPS = ["_clean", "_write_segment", "_publish"]


@pytest.mark.parametrize("step", STEPS)
@pytest.mark.parametrize("after", [False, True])
def test_a_stop_at_any_step_shows_old_rows_or_new_ones(spark, monkeypatch, step, after):
    key, day = _name(spark), _name(spark)
    versions.merge(spark, key, _kv(spark, [(f"k{i}", 0, None) for i in range(50)]), ["k"])
    versions.merge(spark, key, _kv(spark, [(f"k{i}", 1, None) for i in range(9)]), ["k"])
    versions.replace_range(spark, day, _days(spark, [(D(2024, 1, i), 0) for i in range(1, 9)]), "d", "2024-01-01", "2024-01-31", unit="date")
    versions.replace_range(spark, day, _days(spark, [(D(2024, 1, i), 1) for i in range(1, 5)]), "d", "2024-01-01", "2024-01-04", unit="date")
    runs = {
        key: [lambda: versions.merge(spark, key, _kv(spark, [(f"k{i}", 2, None) for i in range(5, 60)]), ["k"]),
              lambda: versions.compact(spark, key)],
        day: [lambda: versions.replace_range(spark, day, _days(spark, [(D(2024, 1, i), 2) for i in range(3, 7)]), "d",
                                             "2024-01-02", "2024-01-07", unit="date")],
    }
    real = getattr(versions, step)

    def stopping(*a, **b):
        if after:
            real(*a, **b)
        raise RuntimeError("stopped")

    for name, todo in runs.items():
        for run in todo:
            old = rows(spark.table(name))
            monkeypatch.setattr(versions, step, stopping)
            with pytest.raises(RuntimeError):
                run()
            monkeypatch.setattr(versions, step, real)
            found = rows(spark.table(name))
            run()
            new = rows(spark.table(name))
            assert found == (new if step == "_publish" and after else old)


def test_a_stopped_first_run_leaves_no_table(spark, monkeypatch):
    t = _name(spark)
    real = versions._publish
    monkeypatch.setattr(versions, "_publish", lambda *a, **b: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        versions.merge(spark, t, _kv(spark, [("a", 1, None), ("b", 1, None)]), ["k"])
    assert not tables.table_exists(spark, t)
    monkeypatch.setattr(versions, "_publish", real)
    versions.merge(spark, t, _kv(spark, [("a", 2, None)]), ["k"])
    assert rows(spark.table(t).select("k", "v")) == [("a", 2)]


def test_a_plain_table_is_refused(spark):
    t = _name(spark)
    spark.range(3).write.saveAsTable(t)
    with pytest.raises(versions.NotVersionedError):
        versions.merge(spark, t, spark.range(3), ["id"])


def test_another_session_reads_whole_versions(spark):
    t = _name(spark)
    other = spark.newSession()
    for v in range(3):
        versions.merge(spark, t, spark.range(30).select("id", F.lit(v).alias("v")), ["id"], max_deltas=1)
        assert other.table(t).agg(F.min("v"), F.max("v"), F.count("*")).first() == (v, v, 30)
    versions.drop(spark, t)
    assert not tables.table_exists(spark, t) and not tables.table_exists(spark, f"{t}__data")


def test_publish_changes_columns_and_partitions_in_one_step(spark, monkeypatch):
    from stockroom.operators.quality import Audit, AuditError
    t = _name(spark)
    versions.publish(spark, t, spark.range(5))
    files = spark.table(t).inputFiles()
    wide = spark.range(8).select("id", (F.col("id") % 2).alias("p"), F.lit("x").alias("s"))
    real = versions._publish
    monkeypatch.setattr(versions, "_publish", lambda *a: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        versions.publish(spark, t, wide, partition_by=["p"])
    assert rows(spark.table(t)) == [(i,) for i in range(5)]
    monkeypatch.setattr(versions, "_publish", real)
    assert versions.publish(spark, t, wide, partition_by=["p"], audits=[Audit("u", "unique", keys=("id",))]) == {"u": 0}
    assert rows(spark.table(t)) == rows(wide) and spark.table(t).columns == ["id", "p", "s"]
    assert spark.read.parquet(*files).count() == 5        # a reader of the version before can end
    with pytest.raises(AuditError):
        versions.publish(spark, t, wide, audits=[Audit("p", "unique", keys=("p",))])
    assert rows(spark.table(t)) == rows(wide)
    versions.undo(spark, t)
    assert rows(spark.table(t)) == [(i,) for i in range(5)]
    versions.publish(spark, t, spark.range(2))
    versions.publish(spark, t, spark.range(3))
    names = [r.tableName for r in spark.sql(f"SHOW TABLES IN {t.split('.')[0]}").collect() if not r.isTemporary]
    assert spark.table(t).count() == 3 and len(names) == 3         # the view, its table, and the one before
    with pytest.raises(versions.NotVersionedError):
        versions.merge(spark, t, spark.range(3), ["id"])
    versions.drop(spark, t)
    assert [r for r in spark.sql(f"SHOW TABLES IN {t.split('.')[0]}").collect() if not r.isTemporary] == []
