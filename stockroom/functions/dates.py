"""Day arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def day_array(start, end) -> Column:
    """Inclusive array of days ``start .. end``.

    ``sequence`` raises on a backward range; here a backward or null range
    gives a null array (an inner explode then drops the row, an outer one
    keeps it with a null day).
    """
    s, e = _c(start), _c(end)
    return F.when(s <= e, F.sequence(s, e, F.expr("interval 1 day")))


def days_between(end, start, long: bool = False) -> Column:
    """``datediff(end, start)`` in days; INT, or BIGINT with ``long=True``
    (the ``datediff(day, start, end)`` form)."""
    d = F.datediff(_c(end), _c(start))
    return d.cast("bigint") if long else d
