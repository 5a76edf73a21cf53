"""Marks come from the write itself: no increment reads its target for them."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from stockroom.plans import incremental
from stockroom.session import scratch_database
from stockroom.sinks import committed_mark, read_table
from tests.test_data_safety import _raw

T = dt.datetime


@pytest.mark.parametrize("store", ["rewrite", "delta"])
def test_increments_never_read_the_target_for_the_mark(spark, monkeypatch, store):
    db = scratch_database(spark)
    snap, daily = f"{db}.snap", f"{db}.daily"

    def refuse(*_):
        raise AssertionError("the target was read for its mark")

    monkeypatch.setattr(incremental, "high_water_mark", refuse)
    hours = 0
    for last in (30, 90, 90, 60):          # more rows, none new, a source that lost rows
        incremental.sdp_incremental_hwm(spark, _raw(spark, 0, last), snap, store=store)
        hours = max(hours, last - 1)
        assert T.fromisoformat(committed_mark(spark, snap, "event_timestamp")) == T(2024, 1, 1) + dt.timedelta(hours=hours)
        incremental.cdp_incremental_hwm(spark, read_table(spark, snap), daily, "2024-02-01 00:00:00", store=store)
        assert committed_mark(spark, daily, "stock_date") == "2024-02-01"
    assert read_table(spark, snap).count() == 40
    assert read_table(spark, snap).agg(F.max("event_timestamp")).first()[0] == T(2024, 1, 1) + dt.timedelta(hours=89)


def test_both_stores_hold_the_same_rows(spark):
    db = scratch_database(spark)
    for store in ("rewrite", "delta"):
        for first, last in ((10, 50), (0, 80)):
            incremental.sdp_incremental_hwm(spark, _raw(spark, first, last), f"{db}.{store}", store=store,
                                            lookback=dt.timedelta(hours=20))
    a, b = (sorted(map(tuple, read_table(spark, f"{db}.{s}").collect())) for s in ("rewrite", "delta"))
    assert a == b and a
