import datetime as dt

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from stockroom.operators import daily_stock, expand_days
from tests.conftest import rows

D = dt.date


def _spans(spark, data):
    return spark.createDataFrame(data, "id int, g string, s date, e date, f boolean")


SAMPLE = [(1, "a", D(2024, 1, 1), D(2024, 1, 3), True), (2, "a", D(2024, 1, 2), D(2024, 1, 2), None),
          (3, "b", D(2024, 1, 5), D(2024, 1, 1), True), (4, None, None, D(2024, 1, 2), False),
          (5, "a", D(2024, 1, 3), D(2024, 1, 6), False)]


def _measures():
    return {"n": F.lit(1), "flagged": F.when(F.col("f"), 1).otherwise(0)}


def test_sweep_equals_explode_outer(spark):
    df = _spans(spark, SAMPLE)
    a = daily_stock(df, "s", "e", ["g"], _measures(), method="explode", outer=True)
    b = daily_stock(df, "s", "e", ["g"], _measures(), method="sweep", outer=True)
    assert rows(a) == rows(b)
    nulls = [r for r in a.collect() if r["stock_date"] is None]
    assert len(nulls) == 2 and all(r["stock_days"] is None for r in nulls)  # backward + null span


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 40), st.integers(-3, 15), st.sampled_from(["a", "b", None]),
                          st.booleans()), min_size=1, max_size=25))
def test_sweep_equals_explode_property(spark, spans):
    base = D(2024, 1, 1)
    data = [(i, g, base + dt.timedelta(days=s), base + dt.timedelta(days=s + L), f)
            for i, (s, L, g, f) in enumerate(spans)]
    df = _spans(spark, data)
    for outer in (False, True):
        a = daily_stock(df, "s", "e", ["g"], _measures(), method="explode", outer=outer)
        b = daily_stock(df, "s", "e", ["g"], _measures(), method="sweep", outer=outer)
        assert rows(a) == rows(b)
    lo, hi = base + dt.timedelta(days=10), base + dt.timedelta(days=20)
    a = daily_stock(df, "s", "e", [], method="explode", lo=lo, hi=hi)
    b = daily_stock(df, "s", "e", [], method="sweep", lo=lo, hi=hi)
    assert rows(a) == rows(b)


def test_clamp_equals_filter_after_explode(spark):
    """R7: clamping before expansion gives the rows of explode-then-filter."""
    df = _spans(spark, SAMPLE)
    lo, hi = D(2024, 1, 2), D(2024, 1, 4)
    a = expand_days(df, "s", "e").where(F.col("stock_date").between(lo, hi))
    b = expand_days(df, "s", "e", lo=lo, hi=hi)
    assert rows(a) == rows(b)


def test_outer_keeps_null_span_inner_drops(spark):
    df = _spans(spark, SAMPLE)
    assert expand_days(df, "s", "e").where("id = 4").count() == 0
    assert [r["stock_date"] for r in expand_days(df, "s", "e", outer=True).where("id = 4").collect()] == [None]
