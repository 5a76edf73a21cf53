"""A third of all rows on one key: every form gives the same, exact result."""

from pyspark.sql import functions as F

from stockroom.plans import demo, preview
from stockroom.sources import fixtures, load
from tests.conftest import SF_MID, rows


def _hot_raw(spark):
    """Preview snapshots where every third event belongs to vehicle HOT."""
    ev = load(spark, SF_MID, "events")
    vid = F.when(F.col("event_id") % 3 == 0, F.lit("HOT")).otherwise(
        F.concat(F.lit("V"), (F.col("event_id") % 500).cast("string")))
    value = F.concat(F.lit('{"vehicleSnapshot":{"id":"'), vid, F.lit('","creationDateTime":"'),
                     F.to_date("ts").cast("string"), F.lit('T00:00:00","removalDateTime":"'),
                     F.date_add(F.to_date("ts"), (F.col("event_id") % 9).cast("int")).cast("string"),
                     F.lit('T00:00:00"}}'))
    return ev.select(F.col("user_id").cast("string").alias("key"), F.lit("t").alias("topic"),
                     F.col("ts").alias("timestamp"), value.alias("value"),
                     (F.col("ts") + F.expr("interval 1 hour")).alias("processed_at"))


def test_hot_key_latest_snapshot_all_forms(spark):
    raw = _hot_raw(spark)
    w = preview.sdp_preview(raw, method="window")
    m = preview.sdp_preview(raw, method="max_by")
    assert rows(w) == rows(m)
    hot = raw.where(F.col("value").contains('"HOT"')).agg(F.max("timestamp")).first()[0]
    assert w.where("inventory_id = 'HOT'").first()["event_timestamp"] == hot


def test_hot_key_daily_stock_forms_agree(spark):
    snap = preview.sdp_preview(_hot_raw(spark))
    a = preview.cdp_preview(snap, fixtures.AS_OF, method="explode")
    b = preview.cdp_preview(snap, fixtures.AS_OF, method="sweep")
    assert rows(a) == rows(b)


def test_hot_vehicle_spans_forms_agree(spark):
    raw = fixtures.frame(spark, SF_MID, "raw_demo")
    # Re-key a third of the demo events onto one vehicle.
    hot = raw.withColumn("value", F.when(F.col("key").cast("long") % 3 == 0,
                                         F.regexp_replace("value", '"id":"V[0-9]+"', '"id":"HOT"'))
                         .otherwise(F.col("value")))
    p1 = demo.sdp_demo(hot)
    a = demo.vehicle_spans(p1, method="max_by")
    b = demo.vehicle_spans(p1, method="window", frame="join")
    c = demo.vehicle_spans(p1, method="window", frame="window")
    assert rows(a) == rows(b) == rows(c)
    n_hot = p1.where("inventory_id = 'HOT'").count()
    assert a.where("inventory_id = 'HOT'").first()["event_count"] == n_hot > p1.count() / 4
