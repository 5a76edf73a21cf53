"""One-pass plans, grouped writes, bucket growth, recorded days, instants, views."""

import datetime as dt

from pyspark.sql import functions as F

from stockroom.operators import quality
from stockroom.operators.latest import first_over_full_frame
from stockroom.plans import demo, preview
from stockroom.registry import _p1
from stockroom.session import scratch_database
from stockroom.sinks import tables as sinks
from stockroom.sources import fixtures
from tests.conftest import SF_SMALL, rows


def _executed(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_audits_read_the_model_once(spark):
    out = quality.run_audits(_p1(spark, SF_SMALL), quality.VEHICLE_AUDITS)
    assert _executed(out).count("from_json") == 1


def test_audits_of_two_grains_quotes_and_no_rows(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, None), (2, None)], "k int, v string")
    audits = [quality.Audit("it's null", "not_null", "v"), quality.Audit("k", "unique", keys=("k",)),
              quality.Audit("kv", "unique", keys=("k", "v"))]
    assert rows(quality.run_audits(df, audits)) == [("it's null", 2), ("k", 4), ("kv", 2)]
    assert rows(quality.run_audits(df.limit(0), audits)) == [("it's null", 0), ("k", 0), ("kv", 0)]
    assert rows(quality.run_audits(df, audits[:1])) == [("it's null", 2)]


def test_full_frame_reads_its_input_once(spark):
    w = first_over_full_frame(_p1(spark, SF_SMALL), "inventory_id", ["event_timestamp"], demo.ATTRIBUTES)
    assert "from_json" not in _executed(w)


def test_writes_are_grouped_by_partition(spark):
    db = scratch_database(spark)
    keys = spark.range(0, 5000, 1, 16).select(F.col("id").cast("string").alias("k"), F.lit(1).alias("v"))
    sinks.merge_by_key(spark, f"{db}.m", keys, ["k"])
    assert len(spark.table(f"{db}.m").inputFiles()) <= 32
    days = spark.range(0, 9000, 1, 16).select(F.col("id"), F.expr("date_add(date'2024-01-01', cast(id % 30 as int))").alias("d"))
    sinks.replace_time_range(spark, f"{db}.d", days, "d", "2024-01-01", "2024-01-30", unit="date")
    assert len(spark.table(f"{db}.d").inputFiles()) <= 60


def test_merge_leaves_untouched_buckets_alone(spark):
    t = f"{scratch_database(spark)}.m"
    sinks.merge_by_key(spark, t, spark.range(200).select("id", F.lit(0).alias("v")), ["id"])
    before = set(spark.table(t).inputFiles())
    sinks.merge_by_key(spark, t, spark.range(1).select("id", F.lit(1).alias("v")), ["id"])
    after = set(spark.table(t).inputFiles())
    touched = {f.split("_part=")[1].split("/")[0] for f in before ^ after}
    assert len(touched) == 1 and before & after
    assert sinks.read_table(spark, t).agg(F.sum("v"), F.count("*")).first() == (1, 200)


def test_rebucket_keeps_rows_marks_and_merges(spark):
    t = f"{scratch_database(spark)}.m"
    sinks.merge_by_key(spark, t, spark.range(300).select("id", F.lit(0).alias("v")), ["id"])
    sinks.commit_mark(spark, t, "id", dt.date(2024, 1, 2))
    sinks.rebucket(spark, t, 40)
    assert sinks.committed_mark(spark, t, "id") == "2024-01-02"
    assert spark.table(t).select(sinks.PART).distinct().count() > 16
    sinks.merge_by_key(spark, t, spark.range(299, 302).select("id", F.lit(1).alias("v")), ["id"])
    assert sinks.read_table(spark, t).agg(F.sum("v"), F.count("*"), F.count_distinct("id")).first() == (3, 302, 302)


def test_processed_days_are_recorded_even_when_empty(spark):
    t = f"{scratch_database(spark)}.d"
    rows_ = spark.createDataFrame([(dt.date(2024, 1, 2),)], "d date")
    assert len(sinks.missing_days(spark, t, "2024-01-01", "2024-01-04")) == 4
    sinks.replace_time_range(spark, t, rows_, "d", "2024-01-01", "2024-01-02", unit="date")
    sinks.replace_time_range(spark, t, rows_, "d", "2024-01-04", "2024-01-04", unit="date")
    assert sinks.missing_days(spark, t, "2024-01-01", "2024-01-05") == [dt.date(2024, 1, 3), dt.date(2024, 1, 5)]
    sinks.replace_time_range(spark, t, rows_, "d", "2024-01-03", "2024-01-03", unit="date")
    assert sinks.processed_days(spark, t) == [(dt.date(2024, 1, 1), dt.date(2024, 1, 4))]
    assert sinks.read_table(spark, t).count() == 1


def test_models_run_on_timestamp_tables_in_another_session_zone(spark):
    want1, want4 = (rows(m(fixtures.frame(spark, SF_SMALL, r)))
                    for m, r in ((demo.sdp_demo, "raw_demo"), (preview.sdp_preview, "raw_preview")))
    other = spark.newSession()
    other.conf.set("spark.sql.session.timeZone", "America/New_York")
    for model, raw, want in ((demo.sdp_demo, "raw_demo", want1), (preview.sdp_preview, "raw_preview", want4)):
        instants = quality.with_instants(fixtures.frame(other, SF_SMALL, raw))
        assert dict(instants.dtypes)["timestamp"] == "timestamp"
        assert rows(model(instants)) == want
    typed = quality.with_instants(demo.sdp_demo(fixtures.frame(other, SF_SMALL, "raw_demo")))
    contract = {f.name: "timestamp" if f.dataType.simpleString() == "timestamp_ntz" else f.dataType
                for f in demo.SDP_DEMO_CONTRACT}
    assert quality.enforce_contract(typed, contract).count() == len(want1)


def test_instants_before_the_epoch_and_in_a_zone(spark):
    from stockroom.functions.casts import instant_to_wall, wall_to_instant
    df = spark.sql("select timestamp'1969-12-31 23:59:59.5 UTC' as t union all select timestamp'2024-07-01 12:00:00.25 UTC' "
                   "union all select cast(null as timestamp)")
    got = df.select(instant_to_wall("t", "Europe/Berlin").alias("w"), "t").select(
        F.col("w").cast("string"), F.col("t").eqNullSafe(wall_to_instant("w", "Europe/Berlin")).alias("same"))
    assert rows(got) == sorted([("1970-01-01 00:59:59.5", True), ("2024-07-01 14:00:00.25", True), (None, True)], key=repr)


def test_view_outlives_the_session_and_columns_have_comments(spark):
    db = scratch_database(spark)
    sinks.write_full(spark.range(3).withColumn("b", F.lit(1)), f"{db}.t", column_comments={"id": "the id"})
    sinks.create_view(spark, f"{db}.v", f"{db}.t", ["id"])
    sinks.create_view(spark, f"{db}.v", f"{db}.t", ["id"])
    assert spark.newSession().table(f"{db}.v").columns == ["id"]
    assert {c.name: c.description for c in spark.catalog.listColumns(f"{db}.t")}["id"] == "the id"


def test_daily_stock_is_ordered(spark):
    raw = fixtures.frame(spark, SF_SMALL, "raw_preview")
    days = [r.stock_date for r in preview.cdp_preview(preview.sdp_preview(raw), fixtures.AS_OF).collect()]
    assert days and days == sorted(days)


def test_partitioned_refresh_keeps_every_row(spark):
    t = f"{scratch_database(spark)}.p"
    for n in (6, 9):
        sinks.write_full(spark.range(n).withColumn("p", F.pmod("id", F.lit(3))), t, partition_by=["p"])
        assert spark.table(t).agg(F.count("*"), F.count_distinct("p")).first() == (n, 3)
