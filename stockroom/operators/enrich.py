"""Left joins that enrich a fact/entity frame.

``left_join_dimension`` broadcasts the dimension only after proving its size
(a bounded row count); a larger dimension falls back to a shuffle join (and
AQE may still turn it into a broadcast at runtime from real sizes).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A dimension is broadcast explicitly only below both bounds.
MAX_BROADCAST_ROWS = 1_000_000
MAX_BROADCAST_BYTES = 64 * 1024 * 1024


class DuplicateKeyError(ValueError):
    pass


def bounded_count(df: DataFrame, limit: int) -> int:
    """``min(count(df), limit + 1)``; stops reading once past the bound."""
    return df.limit(limit + 1).count()


def bounded_size(df: DataFrame, limit: int) -> tuple[int, int]:
    """Rows and approximate bytes (serialized row length) of at most
    ``limit + 1`` rows of ``df``: one bounded aggregate job."""
    r = (df.limit(limit + 1)
           .agg(F.count(F.lit(1)).alias("n"),
                F.coalesce(F.sum(F.length(F.to_json(F.struct(*df.columns)))), F.lit(0)).alias("b"))
           .first())
    return int(r["n"]), int(r["b"])


def assert_unique(df: DataFrame, keys: Sequence[str], what: str = "frame") -> None:
    """Raise when some key value occurs twice (one aggregate job, no collect
    of the data: at most one offending key comes back)."""
    dup = df.groupBy(*keys).count().where(F.col("count") > 1).limit(1).collect()
    if dup:
        raise DuplicateKeyError(f"{what} is not unique on {list(keys)}: {dup[0].asDict()}")


def left_join_dimension(df: DataFrame, dim: DataFrame, on: str | Sequence[str],
                        unique: bool = False,
                        max_broadcast_rows: int = MAX_BROADCAST_ROWS,
                        max_broadcast_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """``df LEFT JOIN dim USING (on)``; unmatched or null keys give nulls,
    duplicate dimension keys fan out unless ``unique=True`` (then raise).

    The dimension is broadcast only when it is proven small (rows and bytes
    measured on at most ``max_broadcast_rows + 1`` rows); otherwise the join
    is left to Catalyst/AQE (shuffle join, or a runtime broadcast from the
    measured stage size)."""
    on = [on] if isinstance(on, str) else list(on)
    if unique:
        assert_unique(dim, on, "dimension")
    rows, size = bounded_size(dim, max_broadcast_rows)
    small = rows <= max_broadcast_rows and size <= max_broadcast_bytes
    return df.join(F.broadcast(dim) if small else dim, on, "left")


def left_join_entity(df: DataFrame, other: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """``df LEFT JOIN other USING (on)`` between two entity-grain frames;
    planned by Catalyst/AQE (sort-merge when both sides are large)."""
    on = [on] if isinstance(on, str) else list(on)
    return df.join(other, on, "left")
