"""Latest row / latest attributes per key.

Two physical forms with equal results (ties broken by the full ordering):

* ``method="window"``  ``row_number() over (partition by keys order by ...) = 1``;
  Catalyst plans a partial ``WindowGroupLimit`` before the shuffle, so a hot
  key sends at most one row per map task.
* ``method="max_by"``  ``max_by(struct(row), struct(order))``: a plain
  partial/final aggregate, also one row per key and map task.

Neither ever collects a whole group: both reduce before the exchange.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stockroom.session import ensure_checkpoint_dir

_RN = "__rn"


def _order_cols(order: Sequence) -> list[Column]:
    out = []
    for o in order:
        out.append(F.col(o).desc() if isinstance(o, str) else o)
    return out


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence,
                   method: str = "window") -> DataFrame:
    """Keep the first row per ``keys`` under ``order`` (strings mean
    *descending*; pass Columns for other directions).

    ``method="max_by"`` accepts only descending column names (the order is
    turned into a struct compared by ``max``).
    """
    keys = list(keys)
    if method == "window":
        w = Window.partitionBy(*keys).orderBy(*_order_cols(order))
        return (df.withColumn(_RN, F.row_number().over(w))
                  .where(F.col(_RN) == 1).drop(_RN))
    if method == "max_by":
        if not all(isinstance(o, str) for o in order):
            raise ValueError("max_by form takes descending column names only")
        cols = df.columns
        picked = F.max_by(F.struct(*[F.col(c) for c in cols]),
                          F.struct(*[F.col(o) for o in order]))
        return df.groupBy(*keys).agg(picked.alias("__row")).select("__row.*")
    raise ValueError(f"unknown method {method!r}")


def dedup_redelivery(df: DataFrame, keys: Sequence[str] = ("inventory_id", "event_timestamp"),
                     order: Sequence = ("processed_at",), method: str = "window") -> DataFrame:
    """Remove re-deliveries: one row per ``(id, event time)``, the most
    recently processed one wins."""
    return latest_per_key(df, keys, order, method)


def latest_attributes(df: DataFrame, key: str, ts_col: str, cols: Sequence[str],
                      extra_aggs: Sequence[Column] = (), tie: Sequence[str] = ()) -> DataFrame:
    """One row per ``key`` with the values of ``cols`` taken from the row with
    the greatest ``ts_col`` (a null value in that row stays null), plus any
    ``extra_aggs`` computed in the same aggregation (one shuffle)."""
    order = F.struct(*[F.col(c) for c in (ts_col, *tie)]) if tie else F.col(ts_col)
    latest = F.max_by(F.struct(*[F.col(c) for c in cols]), order).alias("__latest")
    agg = df.groupBy(key).agg(latest, *extra_aggs)
    rest = [c for c in agg.columns if c not in (key, "__latest")]
    return agg.select(key, *[F.col("__latest")[c].alias(c) for c in cols], *rest)


def first_over_full_frame(df: DataFrame, key: str, order: Sequence, cols: Sequence[str],
                          method: str = "join") -> DataFrame:
    """``first_value(c) over (partition by key order by ... rows between
    unbounded preceding and unbounded following)`` for each c; every input
    row kept, each carrying its key's first values.

    ``method="join"`` (default): the first values per key come from one
    partial+final aggregate (:func:`latest_per_key`, ``max_by`` form) and are
    joined back on the key (null-safe, so a null key gets its group's
    values). No task ever holds a whole group: a hot key meets one row on the
    build side (broadcast when small, otherwise AQE splits the skewed side).
    The input is used twice, so it is checkpointed in the shared folder first.
    ``method="window"``: the literal window, which buffers each key's whole
    group in one task.
    """
    if method == "window":
        w = (Window.partitionBy(key).orderBy(*_order_cols(order))
             .rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
        return df.withColumns({c: F.first_value(F.col(c)).over(w) for c in cols})
    if method != "join":
        raise ValueError(f"unknown method {method!r}")
    ensure_checkpoint_dir(df.sparkSession)
    df = df.checkpoint()
    firsts = latest_per_key(df.select(key, *[o for o in order if o not in cols and o != key], *cols),
                            [key], order, method="max_by")
    firsts = firsts.select(F.col(key).alias("__k"), *[F.col(c).alias(f"__f_{c}") for c in cols])
    joined = df.join(firsts, df[key].eqNullSafe(firsts["__k"]), "left")
    return joined.withColumns({c: F.col(f"__f_{c}") for c in cols}).select(*df.columns)
