"""Physical-plan properties that the scale design relies on."""

import datetime as dt


from stockroom.operators.filters import above_mark
from stockroom.plans import demo, preview
from stockroom.session import scratch_database
from stockroom.sinks import write_full
from stockroom.sources import fixtures, load
from tests.conftest import SF_SMALL


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_latest_snapshot_reduces_before_shuffle(spark):
    p = _plan(preview.sdp_preview(fixtures.frame(spark, SF_SMALL, "raw_preview")))
    assert "WindowGroupLimit" in p and "Partial" in p


def test_vehicle_spans_partial_aggregation(spark):
    p1 = demo.sdp_demo(fixtures.frame(spark, SF_SMALL, "raw_demo"))
    p = _plan(demo.vehicle_spans(p1))
    assert "partial_max_by" in p


def test_scan_reads_only_used_columns(spark):
    p = _plan(fixtures.frame(spark, SF_SMALL, "raw_preview"))
    read = [line for line in p.splitlines() if "events.parquet" in line][0]
    assert "props" not in read and "value" not in read.split("ReadSchema")[1]


def test_mark_is_pushed_to_the_raw_scan(spark):
    db = scratch_database(spark)
    t = f"{db}.raw"
    write_full(fixtures.frame(spark, SF_SMALL, "raw_preview"), t)
    q = preview.parse_preview(above_mark(spark.table(t), "timestamp", dt.datetime(2024, 1, 20)))
    assert "GreaterThan(timestamp" in _plan(q)


def test_dimension_join_is_broadcast(spark):
    spans = demo.vehicle_spans(demo.sdp_demo(fixtures.frame(spark, SF_SMALL, "raw_demo")))
    out = demo.agg_demo(demo.sdp_demo(fixtures.frame(spark, SF_SMALL, "raw_demo")),
                        fixtures.frame(spark, SF_SMALL, "markets"),
                        fixtures.frame(spark, SF_SMALL, "vehicle_data"))
    assert "BroadcastHashJoin" in _plan(out)
    assert spans is not None


def test_json_parsed_once_in_models(spark):
    p1 = demo.sdp_demo(fixtures.frame(spark, SF_SMALL, "raw_demo"))
    assert p1._jdf.queryExecution().optimizedPlan().toString().count("from_json") == 1


def test_interval_predicate_on_events_pushed(spark):
    ev = load(spark, SF_SMALL, "events")
    from stockroom.operators.filters import in_interval
    p = _plan(in_interval(ev, "ts", "2024-01-18", "2024-01-25"))
    assert "GreaterThanOrEqual(ts" in p and "LessThan(ts" in p


def test_day_partitions_pruned_by_mark_and_interval(spark):
    from stockroom.operators.filters import in_interval
    from stockroom.streaming.ingest import with_event_date
    db = scratch_database(spark)
    t = f"{db}.raw"
    write_full(with_event_date(fixtures.frame(spark, SF_SMALL, "raw_preview")), t,
               partition_by=["event_date"])
    marked = above_mark(spark.table(t), "timestamp", dt.datetime(2024, 1, 20, 5), day_col="event_date")
    p = _plan(marked)
    assert "PartitionFilters: [isnotnull(event_date" in p and "2024-01-20" in p
    ranged = _plan(in_interval(spark.table(t), "timestamp", "2024-01-18", "2024-01-19", day_col="event_date"))
    assert "PartitionFilters: [isnotnull(event_date" in ranged
    # Same rows as on the unpartitioned data.
    raw = fixtures.frame(spark, SF_SMALL, "raw_preview")
    a = above_mark(raw, "timestamp", dt.datetime(2024, 1, 20, 5)).count()
    assert marked.count() == a
