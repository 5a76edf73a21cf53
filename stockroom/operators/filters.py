"""Row filters: null keys, valid spans, intervals, high-water marks, audits' predicates."""

from __future__ import annotations

import datetime as _dt
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockroom.functions.casts import ntz_lit, pad_open_end, typed_lit


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def drop_null_key(df: DataFrame, col) -> DataFrame:
    """Drop rows whose key is null (``where key is not null``)."""
    return df.where(_c(col).isNotNull())


def valid_spans(df: DataFrame, start, end, as_of) -> DataFrame:
    """Keep spans with ``coalesce(end, as_of) > start`` (strict: zero-length
    and null-start spans are dropped)."""
    return df.where(pad_open_end(end, as_of) > _c(start))


def _day(v) -> _dt.date:
    """A bound that is a day: a date or a 10-character text. Anything finer
    (a time of day) is refused, since intervals are whole days."""
    if isinstance(v, _dt.date) and not isinstance(v, _dt.datetime):
        return v
    if isinstance(v, str) and len(v) == 10:
        return _dt.date.fromisoformat(v)
    raise ValueError(f"interval bounds are days (a date or 'YYYY-MM-DD'), not {v!r}")


def interval_predicate(col, start, end, unit: str = "timestamp") -> Column:
    """Predicate for an interval given as two days ``start .. end``.

    ``unit="timestamp"``: half-open ``[start 00:00, end+1 day 00:00)`` so a
    one-day interval holds the whole day. ``unit="date"``: inclusive
    ``between`` on a DATE column.
    """
    c, lo, hi = _c(col), _day(start), _day(end)
    if unit == "date":
        return c.between(F.lit(lo), F.lit(hi))
    return (c >= ntz_lit(lo)) & (c < ntz_lit(hi + _dt.timedelta(days=1)))


#: Day partition column of a raw landing table (``to_date(timestamp)``).
DAY_COLUMN = "event_date"


def in_interval(df: DataFrame, col, start, end, unit: str = "timestamp",
                day_col: str | None = None) -> DataFrame:
    """Filter to an interval (see :func:`interval_predicate`); literal bounds
    let the predicate reach the parquet scan. ``day_col`` names a partition
    column that is the day of ``col``: the implied day range is added too, so
    whole partitions are pruned (Catalyst does not derive it from the
    timestamp predicate). Only the caller can know that, so it has no default."""
    out = df.where(interval_predicate(col, start, end, unit))
    if day_col and unit == "timestamp":
        out = out.where(F.col(day_col).between(F.lit(_day(start)), F.lit(_day(end))))
    return out


def high_water_mark(target: DataFrame, col: str):
    """``select max(col) from target`` as a Python value (one tiny aggregate
    job); ``None`` when the target is empty."""
    return target.agg(F.max(col).alias("m")).first()["m"]


def above_mark(df: DataFrame, col: str, mark, inclusive: bool = False,
               day_col: str | None = None) -> DataFrame:
    """``col > mark`` (or ``>=``). The mark is a literal so the comparison is
    pushed to the scan. ``day_col`` names a partition column that is the day of
    ``col``: ``day_col >= day(mark)`` is added so older partitions are never
    listed or read. A null mark (empty target) keeps every row."""
    if mark is None:
        return df
    c = F.col(col)
    out = df.where(c >= typed_lit(mark) if inclusive else c > typed_lit(mark))
    if day_col and isinstance(mark, _dt.datetime):
        out = out.where(F.col(day_col) >= F.lit(mark.date()))
    return out


def not_accepted(col, values: Iterable) -> Column:
    """``col NOT IN (values) AND col IS NOT NULL``."""
    c = _c(col)
    return ~c.isin(list(values)) & c.isNotNull()


def is_null(col) -> Column:
    return _c(col).isNull()
