"""Casts and null defaults.

Spark 4 runs with ANSI on: a strict cast of ``'junk'`` raises. ``lenient=True``
switches to ``try_cast`` (null on bad input) instead of turning ANSI off.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def _cast(col, type_name: str, lenient: bool) -> Column:
    c = _c(col)
    return c.try_cast(type_name) if lenient else c.cast(type_name)


def to_date(col, lenient: bool = False) -> Column:
    """``cast(x as date)``."""
    return _cast(col, "date", lenient)


def to_bool(col, lenient: bool = False) -> Column:
    """``cast(x as boolean)``: true/1/yes/t/y -> true, false/0/no/f/n -> false."""
    return _cast(col, "boolean", lenient)


def to_ts(col, lenient: bool = False) -> Column:
    """String/date -> ``timestamp_ntz`` (no session time zone involved)."""
    return _cast(col, "timestamp_ntz", lenient)


def ntz_lit(value) -> Column:
    """A zone-free ``timestamp_ntz`` literal from a datetime/date/ISO text.

    Built from text: a naive Python datetime passed to ``F.lit`` is read in
    the Python process's local zone and then cast in the session zone, which
    shifts it whenever the two differ.
    """
    if isinstance(value, Column):
        return value
    if isinstance(value, _dt.datetime):
        text = value.isoformat(sep=" ")
    elif isinstance(value, _dt.date):
        text = value.isoformat() + " 00:00:00"
    else:
        text = str(value)
    return F.lit(text).cast("timestamp_ntz")


def typed_lit(value) -> Column:
    """Literal for a comparison: datetimes become ``timestamp_ntz`` (zone
    free), everything else (dates, numbers, text) a plain literal."""
    if isinstance(value, _dt.datetime):
        return ntz_lit(value)
    return F.lit(value)


def instant_to_wall(col, zone: str = "UTC") -> Column:
    """TIMESTAMP (an instant) -> its wall time in ``zone`` as ``timestamp_ntz``,
    whatever the session zone is."""
    micros = F.unix_micros(_c(col))
    secs = F.pmod(micros, F.lit(86_400_000_000)).cast("decimal(18,6)") / F.lit(1_000_000)
    utc = (F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
           + F.make_dt_interval(F.floor(micros / F.lit(86_400_000_000)).cast("int"), F.lit(0), F.lit(0),
                                secs.cast("decimal(18,6)")))
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), utc)


def wall_to_instant(col, zone: str = "UTC") -> Column:
    """``timestamp_ntz`` wall time of ``zone`` -> TIMESTAMP."""
    c = _c(col)
    return F.make_timestamp_ltz(F.year(c), F.month(c), F.dayofmonth(c), F.hour(c), F.minute(c),
                                F.extract(F.lit("SECOND"), c), F.lit(zone))


def decode(col) -> Column:
    """Bytes -> UTF-8 string (Kafka key/value)."""
    return _c(col).cast("string")


def day_of(col) -> Column:
    """Timestamp/string -> date."""
    return F.to_date(_c(col))


def default_if_null(col, value) -> Column:
    """``coalesce(x, value)``."""
    return F.coalesce(_c(col), F.lit(value))


def pad_open_end(col, as_of) -> Column:
    """An open span (null end) runs to ``as_of`` (ISO text, a datetime or a
    Column)."""
    return F.coalesce(_c(col), ntz_lit(as_of))


def flag_to_int(col) -> Column:
    """``case when b then 1 else 0 end`` (null -> 0)."""
    return F.when(_c(col), F.lit(1)).otherwise(F.lit(0))
