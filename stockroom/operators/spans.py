"""Validity spans and their expansion into daily stock.

A *span* is one entity's ``[start, end]`` (timestamps or dates, end inclusive
at day grain). Daily stock for day ``d`` counts the spans covering ``d`` and
sums their age ``d - start_day`` (stock days).

Two plans with identical results:

* ``method="explode"`` -- one row per (span, day), then group by day. Rows
  grow with entities x span length.
* ``method="sweep"`` -- +1 at the start day and -1 the day after the end,
  aggregated per (dims, day) *before* the shuffle, then running sums over the
  change points of each dims group and one row generated per covered day.
  Shuffled rows grow with the number of distinct change days, not with
  entities x days; per-group window input is bounded by the calendar.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stockroom.functions.casts import day_of
from stockroom.functions.dates import day_array, days_between


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def _lit_day(v) -> Column:
    if isinstance(v, Column):
        return v
    if isinstance(v, str):
        v = _dt.date.fromisoformat(v[:10])
    return F.lit(v)


def _clamped(start, end, lo, hi) -> tuple[Column, Column]:
    s, e = day_of(_c(start)), day_of(_c(end))
    if lo is not None:
        s = F.when(s.isNotNull(), F.greatest(s, _lit_day(lo)))
    if hi is not None:
        e = F.when(e.isNotNull(), F.least(e, _lit_day(hi)))
    return s, e


def validity_span(df: DataFrame, key: str, ts_col: str,
                  start: str = "valid_from", end: str = "valid_to") -> DataFrame:
    """``min(ts), max(ts), count(*)`` per key (partial aggregate before shuffle)."""
    return df.groupBy(key).agg(F.min(ts_col).alias(start), F.max(ts_col).alias(end),
                               F.count(F.lit(1)).alias("event_count"))


def expand_days(df: DataFrame, start, end, outer: bool = False, lo=None, hi=None,
                day_col: str = "stock_date") -> DataFrame:
    """One row per day of ``[day(start), day(end)]``.

    ``outer=True`` keeps a row with a null day for a null/backward span.
    ``lo``/``hi`` clamp the range *before* expanding (the same rows as
    expanding and then filtering the day range, without generating the rows
    outside it); only for the inner form.
    """
    if outer and (lo is not None or hi is not None):
        raise ValueError("clamping is defined for the inner expansion only")
    s, e = _clamped(start, end, lo, hi)
    gen = F.explode_outer if outer else F.explode
    return df.withColumn(day_col, gen(day_array(s, e)))


def daily_stock(spans: DataFrame, start, end, dims: Sequence[str] = (),
                measures: Mapping[str, Column] | None = None,
                method: str = "explode", outer: bool = False, lo=None, hi=None,
                day_col: str = "stock_date", age_col: str = "stock_days",
                age_long: bool = True) -> DataFrame:
    """Daily stock per ``(day, *dims)``.

    ``measures`` maps an output name to a per-span additive value (``F.lit(1)``
    for a count, an int flag for a conditional count); default
    ``{"net_stock_count": 1}``. ``age_col`` is ``sum(day - start_day)``.
    """
    dims = list(dims)
    measures = dict(measures or {"net_stock_count": F.lit(1)})
    if method == "explode":
        x = expand_days(spans, start, end, outer=outer, lo=lo, hi=hi, day_col=day_col)
        x = x.withColumn("__age", days_between(F.col(day_col), day_of(_c(start)), long=age_long))
        return x.groupBy(day_col, *dims).agg(
            *[F.sum(m).cast("bigint").alias(n) for n, m in measures.items()],
            F.sum("__age").alias(age_col))
    if method == "sweep":
        return _sweep(spans, start, end, dims, measures, outer, lo, hi, day_col, age_col, age_long)
    raise ValueError(f"unknown method {method!r}")


def daily_change(spans: DataFrame, start, end, sign, dims: Sequence[str] = (),
                 measures: Mapping[str, Column] | None = None, day_col: str = "stock_date",
                 age_col: str = "stock_days") -> DataFrame:
    """What spans that are added (``sign`` 1) and taken away (-1) change in the
    daily stock per ``(day, *dims)``: signed measures and stock days. Spans that
    cancel out leave no rows. A sweep, so it costs two rows a span."""
    measures = dict(measures or {"net_stock_count": F.lit(1)})
    out = _sweep(spans, start, end, list(dims), measures, False, None, None, day_col, age_col, True, weight=_c(sign))
    same = F.lit(True)
    for c in (*measures, age_col):
        same = same & (F.col(c) == 0)
    return out.where(~same)


def _epoch() -> Column:
    return F.lit(_dt.date(1970, 1, 1))


def _sweep(spans, start, end, dims, measures, outer, lo, hi, day_col, age_col, age_long, weight=None):
    if outer and (lo is not None or hi is not None):
        raise ValueError("clamping is defined for the inner expansion only")
    s, e = _clamped(start, end, lo, hi)
    s0 = F.datediff(day_of(_c(start)), _epoch()).cast("bigint")
    names = ["__n", "__s0", *measures]

    def change(day: Column, sign: int) -> Column:
        w = F.lit(sign).cast("bigint") if weight is None else weight.cast("bigint") * sign
        return F.struct(day.alias(day_col), w.alias("__n"), (s0 * w).alias("__s0"),
                        *[(m.cast("bigint") * w).alias(n) for n, m in measures.items()])

    # One pass over the spans: a valid span emits +1 on its first day and -1
    # on the day after its last; with ``outer`` an invalid span emits one row
    # with a null day that only carries its measures.
    valid = s <= e
    events = F.when(valid, F.array(change(s, 1), change(F.date_add(e, 1), -1)))
    if outer:
        events = events.otherwise(F.array(change(F.lit(None).cast("date"), 1)))
    deltas = (spans.select(*[F.col(d) for d in dims], F.explode(events).alias("__c"))
              .select(*dims, "__c.*")
              .groupBy(*dims, day_col)
              .agg(*[F.sum(n).alias(n) for n in names]))

    w = Window.partitionBy(*dims).orderBy(day_col)
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    day = F.col(day_col)
    # Running sums over the change days (null-day rows excluded); a null-day
    # row (outer form) keeps its own measures.
    run = deltas.select(
        *dims, day.alias("__from"), F.lead(day).over(w).alias("__to"),
        *[F.when(day.isNull(), F.col(n))
           .otherwise(F.sum(F.when(day.isNotNull(), F.col(n))).over(upto)).alias(n)
          for n in names])
    # Between two change days the covering set is constant: one row per day.
    some = F.col("__n") > 0
    if weight is not None:      # signed: spans of equal number can differ in all else
        for n in names:
            some = some | (F.col(n) != 0)
    days_ = F.when(some, F.sequence(F.col("__from"), F.date_sub(F.col("__to"), 1),
                                                  F.expr("interval 1 day")))
    if outer:
        days_ = F.when(F.col("__from").isNull(), F.array(F.lit(None).cast("date"))).otherwise(days_)
    covered = run.withColumn(day_col, F.explode(days_))
    age = F.col("__n") * F.datediff(day, _epoch()) - F.col("__s0")
    return covered.select(day, *dims, *[F.col(n) for n in measures],
                          age.cast("bigint").alias(age_col))
