import datetime as dt

from pyspark.sql import functions as F

from stockroom.operators import first_over_full_frame, latest_attributes, latest_per_key
from tests.conftest import rows

T = dt.datetime


def _events(spark):
    return spark.createDataFrame([
        ("a", T(2024, 1, 1), "x", 1), ("a", T(2024, 1, 3), None, 2), ("a", T(2024, 1, 2), "y", 3),
        ("b", T(2024, 1, 5), "z", 4), ("b", T(2024, 1, 5), "w", 5),   # tie on time
        (None, T(2024, 1, 9), "n", 6),
    ], "k string, ts timestamp_ntz, attr string, seq int")


def test_latest_null_value_stays_null(spark):
    """T1: the latest event's null wins (no 'last non-null')."""
    ev = _events(spark)
    got = {r["k"]: r["attr"] for r in latest_attributes(ev, "k", "ts", ["attr"], tie=["seq"]).collect()}
    assert got["a"] is None


def test_window_and_max_by_forms_agree_with_tie_break(spark):
    """T2: ties resolve by the extra order keys, identically in both forms."""
    ev = _events(spark)
    w = latest_per_key(ev, ["k"], ["ts", "seq"], method="window")
    m = latest_per_key(ev, ["k"], ["ts", "seq"], method="max_by")
    assert rows(w) == rows(m)
    assert {r["k"]: r["seq"] for r in w.collect()}["b"] == 5


def test_window_form_plans_group_limit(spark):
    ev = _events(spark)
    plan = latest_per_key(ev, ["k"], ["ts"])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_first_value_full_frame_equals_latest(spark):
    ev = _events(spark).where(F.col("k") == "a")
    w = first_over_full_frame(ev, "k", ["ts"], ["attr"])
    assert {r["attr"] for r in w.collect()} == {None}
    assert w.count() == 3


def test_first_value_join_form_equals_window_form(spark):
    ev = _events(spark).where(F.col("k") != "b")   # "b" has a tie on ts
    a = first_over_full_frame(ev, "k", ["ts"], ["attr"], method="window")
    b = first_over_full_frame(ev, "k", ["ts"], ["attr"], method="join")
    assert rows(a) == rows(b)
    assert "Window" not in b._jdf.queryExecution().executedPlan().toString()
