"""Refreshes that readers never see half done, and audits before the rows are shown."""

import pytest
from pyspark.sql import functions as F

from stockroom.operators.quality import VEHICLE_AUDITS, Audit, AuditError, observed_audits, run_audits
from stockroom.plans.project import run_demo_chain
from stockroom.registry import _p1
from stockroom.session import scratch_database
from stockroom.sinks import tables
from stockroom.sources import fixtures
from tests.conftest import SF_SMALL, rows


def _tables(spark, db):
    return [r.tableName for r in spark.sql(f"SHOW TABLES IN {db}").collect() if not r.isTemporary]


@pytest.mark.parametrize("step", ["_location", "_point_to", "_unstage"])
def test_a_refresh_that_stops_shows_old_rows_or_new_ones(spark, monkeypatch, step):
    t = f"{scratch_database(spark)}.t"
    for n in (3, 4):
        tables.write_full(spark.range(n), t)
    real = getattr(tables, step)
    monkeypatch.setattr(tables, step, lambda *a: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        tables.write_full(spark.range(9), t)
    monkeypatch.setattr(tables, step, real)
    assert spark.table(t).count() == (9 if step == "_unstage" else 4)
    tables.write_full(spark.range(7), t)
    assert spark.table(t).count() == 7 and _tables(spark, t.split(".")[0]) == ["t"]


def test_a_reader_that_began_before_the_refresh_ends_on_the_old_rows(spark):
    t = f"{scratch_database(spark)}.t"
    tables.write_full(spark.range(5), t)
    before = spark.table(t)
    files = before.inputFiles()
    tables.write_full(spark.range(8), t)
    assert spark.read.parquet(*files).count() == 5       # kept until the next refresh
    tables.write_full(spark.range(9), t)
    with pytest.raises(Exception):
        spark.read.parquet(*files).count()
    assert spark.table(t).count() == 9 and spark.newSession().table(t).count() == 9


def test_other_columns_and_partitions_are_replaced_too(spark):
    t = f"{scratch_database(spark)}.t"
    tables.write_full(spark.range(5), t, comment="first")
    tables.write_full(spark.range(6).withColumn("p", F.col("id") % 2), t)
    assert spark.table(t).columns == ["id", "p"] and spark.table(t).count() == 6
    tables.write_full(spark.range(7).withColumn("p", F.col("id") % 2), t, partition_by=["p"])
    assert spark.table(t).where("p = 1").count() == 3
    tables.write_full(spark.range(4).withColumn("p", F.col("id") % 2), t)
    assert spark.table(t).count() == 4


def test_comments_outlive_a_refresh(spark):
    t = f"{scratch_database(spark)}.t"
    tables.write_full(spark.range(5), t, comment="it", column_comments={"id": "the id"})
    tables.write_full(spark.range(6), t)
    assert {c.name: c.description for c in spark.catalog.listColumns(t)}["id"] == "the id"


AUDITS = [Audit("v", "not_null", "v"), Audit("w", "accepted_values", "v", ("a", "b")), Audit("k", "unique", keys=("k",))]


def test_violations_keep_the_old_table(spark):
    t = f"{scratch_database(spark)}.t"
    good = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    bad = spark.createDataFrame([(1, "a"), (1, None), (2, "x"), (2, "x"), (3, "b")], "k int, v string")
    with pytest.raises(AuditError):
        tables.write_full(bad, t, audits=AUDITS)
    assert not tables.table_exists(spark, t) and _tables(spark, t.split(".")[0]) == []
    assert tables.write_full(good, t, audits=AUDITS) == {"v": 0, "w": 0, "k": 0}
    with pytest.raises(AuditError, match="v: 1; w: 2; k: 4"):
        tables.write_full(bad, t, audits=AUDITS)
    assert rows(spark.table(t)) == rows(good)
    assert tables.write_full(bad, t, audits=AUDITS, on_violation="warn") == {r.audit: r.violations for r in run_audits(bad, AUDITS).collect()}
    assert spark.table(t).count() == 5
    assert tables.write_full(bad.where("k > 9"), t, audits=AUDITS) == {"v": 0, "w": 0, "k": 0}


def test_the_model_is_computed_once_and_not_dealt_out_again(spark):
    model = _p1(spark, SF_SMALL)
    watched, violations = observed_audits(model, VEHICLE_AUDITS)
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    assert plan(watched).count("from_json") == 1
    assert plan(watched).count("Exchange hashpartitioning") == plan(model).count("Exchange hashpartitioning")
    watched.write.format("noop").mode("overwrite").save()
    assert violations() == {r.audit: r.violations for r in run_audits(model, VEHICLE_AUDITS).collect()}


def test_an_audited_chain_leaves_the_old_events(spark):
    raw, m, v = (fixtures.frame(spark, SF_SMALL, n) for n in ("raw_demo", "markets", "vehicle_data"))
    db = scratch_database(spark)
    run_demo_chain(spark, db, raw, m, v)
    t = f"{db}.sdp_inventory_vehicles_demo"
    files = set(spark.table(t).inputFiles())
    with pytest.raises(AuditError):
        run_demo_chain(spark, db, raw, m, v, audits="error")
    assert set(spark.table(t).inputFiles()) == files
    assert run_demo_chain(spark, db, raw, m, v, audits="off").count() == 0
