"""Daily stock by signed changes equals a full recomputation, whatever arrives."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from stockroom.operators.spans import daily_change, daily_stock
from stockroom.plans import live_stock
from stockroom.plans.preview import cdp_preview, sdp_preview
from stockroom.session import scratch_database
from stockroom.sinks import versions
from tests.conftest import rows

T = dt.datetime
AS_OF = "2024-02-15 12:00:00"


def _raw(spark, data):
    """Raw rows from (event time, id, creation, removal)."""
    out = []
    for ts, vid, c, r in data:
        body = f'"id":"{vid}","creationDateTime":"{c}T00:00:00"' + (f',"removalDateTime":"{r}T00:00:00"' if r else "")
        out.append(("k", "t", ts, '{"vehicleSnapshot":{' + body + '}}', ts + dt.timedelta(hours=1)))
    return spark.createDataFrame(out, "key string, topic string, timestamp timestamp_ntz, value string, processed_at timestamp_ntz")


def _random(rng, n):
    day = lambda a, b: (dt.date(2024, 1, 1) + dt.timedelta(days=rng.randint(a, b)))
    out = []
    for _ in range(n):
        c = day(0, 40)
        out.append((T(2024, 1, rng.randint(1, 31), rng.randint(0, 23), rng.randint(0, 59), rng.randint(0, 59)), f"V{rng.randint(0, 25)}", c,
                    None if rng.random() < .4 else c + dt.timedelta(days=rng.randint(-2, 20))))
    return out


def _full(spark, data, as_of):
    return rows(cdp_preview(sdp_preview(_raw(spark, data)), as_of))


def test_late_replayed_and_open_rows(spark):
    rng, db = random.Random(3), scratch_database(spark)
    v, d, seen = f"{db}.vehicles", f"{db}.daily", []
    clock = ["2024-01-20 00:00:00", "2024-01-20 00:00:00", "2024-01-23 06:00:00", "2024-02-10 00:00:00", "2024-02-10 00:00:00",
             "2024-02-09 12:00:00"]
    for i, as_of in enumerate(clock):
        batch = _random(rng, 30) if i != 4 else seen[:20]          # a replay changes nothing
        seen += batch if i != 4 else []
        days = live_stock.cdp_incremental_delta(spark, _raw(spark, batch), v, d, as_of, max_deltas=2)
        assert rows(spark.table(d)) == _full(spark, seen, as_of)
        if i == 4:
            assert days == []


def test_only_changed_days_are_rewritten(spark):
    db = scratch_database(spark)
    v, d = f"{db}.vehicles", f"{db}.daily"
    data = [(T(2024, 1, 5), f"V{i}", dt.date(2024, 1, 1 + i), dt.date(2024, 1, 11 + i)) for i in range(10)]
    live_stock.cdp_incremental_delta(spark, _raw(spark, data), v, d, AS_OF)
    before = set(spark.table(d).inputFiles())
    late = [(T(2024, 1, 6), "V3", dt.date(2024, 1, 4), dt.date(2024, 1, 12))]      # ended two days sooner
    days = live_stock.cdp_incremental_delta(spark, _raw(spark, late), v, d, AS_OF)
    assert days == [dt.date(2024, 1, 13), dt.date(2024, 1, 14)]
    assert len(before - set(spark.table(d).inputFiles())) == 2
    assert rows(spark.table(d)) == _full(spark, data + late, AS_OF)


def test_the_clock_alone_adds_days(spark):
    db = scratch_database(spark)
    v, d = f"{db}.vehicles", f"{db}.daily"
    data = [(T(2024, 1, 5), "A", dt.date(2024, 1, 1), None), (T(2024, 1, 5), "B", dt.date(2024, 1, 1), dt.date(2024, 1, 3)),
            (T(2024, 1, 5), "C", dt.date(2024, 1, 12), None)]
    for as_of, want in (("2024-01-10 00:00:00", None), ("2024-01-13 00:00:00", [11, 12, 13])):
        days = live_stock.cdp_incremental_delta(spark, _raw(spark, data), v, d, as_of)
        assert rows(spark.table(d)) == _full(spark, data, as_of)
        if want:
            assert [x.day for x in days] == want


@pytest.mark.parametrize("stop", ["replace_days", "compact"])
def test_a_run_that_stops_between_its_commits_is_caught_up(spark, monkeypatch, stop):
    rng, db = random.Random(5), scratch_database(spark)
    v, d = f"{db}.vehicles", f"{db}.daily"
    a, b, c = (_random(rng, 30) for _ in range(3))
    live_stock.cdp_incremental_delta(spark, _raw(spark, a), v, d, AS_OF)
    real = getattr(versions, stop)
    monkeypatch.setattr(versions, stop, lambda *x, **y: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        live_stock.cdp_incremental_delta(spark, _raw(spark, b), v, d, AS_OF, max_deltas=0)
    monkeypatch.setattr(versions, stop, real)
    for batch in (b, c):
        live_stock.cdp_incremental_delta(spark, _raw(spark, batch), v, d, AS_OF, max_deltas=0)
    assert rows(spark.table(d)) == _full(spark, a + b + c, AS_OF)


def test_a_daily_table_far_behind_is_computed_anew(spark):
    rng, db = random.Random(6), scratch_database(spark)
    v, d = f"{db}.vehicles", f"{db}.daily"
    a, b, c = (_random(rng, 20) for _ in range(3))
    live_stock.cdp_incremental_delta(spark, _raw(spark, a), v, d, AS_OF)
    for batch in (b, c):
        live_stock.merge_latest(spark, _raw(spark, batch), v)
    live_stock.follow(spark, v, d, AS_OF)
    assert rows(spark.table(d)) == _full(spark, a + b + c, AS_OF)


def test_signed_changes_with_dimensions(spark):
    rng = random.Random(7)
    span = lambda: (rng.choice("xy"), dt.date(2024, 1, rng.randint(1, 20)), dt.date(2024, 1, rng.randint(1, 28)), rng.randint(0, 1))
    old, new = [span() for _ in range(40)], [span() for _ in range(30)]
    schema = "dim string, s date, e date, flag int"
    measures = {"n": F.lit(1), "flags": F.col("flag")}
    both = spark.createDataFrame(old[10:], schema).withColumn("sign", F.lit(-1)).unionByName(
        spark.createDataFrame(new, schema).withColumn("sign", F.lit(1)))
    change = daily_change(both, "s", "e", "sign", ["dim"], measures)
    stock = lambda data: daily_stock(spark.createDataFrame(data, schema), "s", "e", ["dim"], measures)
    summed = (stock(old).unionByName(change.select(*stock(old).columns)).groupBy("stock_date", "dim")
              .agg(*[F.sum(c).alias(c) for c in ("n", "flags", "stock_days")]).where("n <> 0"))
    assert rows(summed) == rows(stock(old[:10] + new))
    same = spark.createDataFrame(old, schema)
    none = daily_change(same.withColumn("sign", F.lit(1)).unionByName(same.withColumn("sign", F.lit(-1))), "s", "e", "sign", ["dim"], measures)
    assert none.count() == 0
