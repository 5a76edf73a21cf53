"""Micro-batch upsert of the latest row per key.

``row_number`` is not available on a streaming frame, but inside
``foreachBatch`` each micro-batch is a static DataFrame: it is reduced to the
latest row per key and merged into the target by key, keeping whichever of
the stored and the new row is later (so a replayed or late micro-batch can
not move a key back in time). Replaying a batch after a failure gives the
same end state.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from stockroom.operators.latest import latest_per_key
from stockroom.sinks import versions
from stockroom.sinks.tables import merge_by_key


def any_null_keys_possible(df: DataFrame, keys: Sequence[str]) -> bool:
    """Latest-per-key output is unique on the keys; only nullable keys still
    need the merge's null check."""
    return any(df.schema[k].nullable for k in keys)


def stream_upsert_latest(sdf: DataFrame, table: str, keys: Sequence[str], order: Sequence,
                         checkpoint: str,
                         transform: Callable[[DataFrame], DataFrame] | None = None,
                         available_now: bool = True, columns: Sequence[str] | None = None,
                         store: str = "rewrite") -> StreamingQuery:
    """Start a stream that keeps ``table`` at the latest row per ``keys``.

    ``store``: ``"rewrite"`` rewrites the buckets that a micro-batch touches,
    ``"delta"`` writes its rows only (:mod:`stockroom.sinks.versions`).

    ``transform`` maps a raw micro-batch to rows with ``keys`` and the
    ``order`` columns; ``columns`` are the stored columns (default: all).
    """
    lost = [o for o in order if isinstance(o, str) and columns is not None and o not in columns]
    if lost:
        raise ValueError(f"order columns {lost} are not stored: later batches could not be compared with the table")

    def upsert(batch: DataFrame, _batch_id: int) -> None:
        rows = transform(batch) if transform else batch
        latest = latest_per_key(rows, keys, order)
        if columns is not None:
            latest = latest.select(*columns)
        check = any_null_keys_possible(rows, keys)
        if store == "delta":
            versions.merge(batch.sparkSession, table, latest, list(keys), order=list(order), check=check)
        else:
            merge_by_key(batch.sparkSession, table, latest, keys, order=list(order), check=check)

    w = sdf.writeStream.foreachBatch(upsert).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w
    return w.start()
