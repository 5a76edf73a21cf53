"""Stream operators with state: re-delivery removal within a watermark, latest row per key.

Both keep their state in the stream's checkpoint, so a restart goes on where the
last micro-batch ended.

* :func:`dedup_stream` keeps the first row that arrives for a key; a key's state
  is dropped once the watermark has passed its event time plus the delay, so the
  state holds the keys of about two delays, not of all time. A re-delivery that
  comes later than that is not recognised (it is a late row and dropped if its
  event time lies before the watermark).
* :func:`stream_latest` keeps the latest row of each key as an aggregate and
  hands the keys that a micro-batch touched, one row each, to a versioned table.
  The state is one row per key, however many rows arrive; the table is written
  only with what changed.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from stockroom.sinks import versions

_EVENT = "__event_time"


def dedup_stream(sdf: DataFrame, keys: Sequence[str], time_col: str, delay: str) -> DataFrame:
    """Rows of a stream with the first of each ``keys`` only; ``delay``: how much
    later than the newest event a re-delivery may come. A zone-free time is
    read as wall time of the session's zone for the watermark."""
    keyed = sdf.withColumn(_EVENT, F.col(time_col).cast("timestamp")).withWatermark(_EVENT, delay)
    return keyed.dropDuplicatesWithinWatermark(list(keys)).drop(_EVENT)


def latest_state(sdf: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Latest row per ``keys`` of a stream (or a batch) under ``order``, as an
    aggregate: its state is one row per key. Null keys are dropped."""
    rows = sdf.dropna(subset=list(keys))
    newest = F.max_by(F.struct(*rows.columns), F.struct(*order)).alias("__row")
    return rows.groupBy(*[F.col(k).alias(f"__k_{k}") for k in keys]).agg(newest).select("__row.*")


def stream_latest(sdf: DataFrame, table: str, keys: Sequence[str], order: Sequence[str], checkpoint: str,
                  transform: Callable[[DataFrame], DataFrame] | None = None, available_now: bool = True,
                  max_deltas: int = versions.MAX_DELTAS) -> StreamingQuery:
    """Keep the versioned table ``table`` at the latest row per ``keys``.

    In update mode a micro-batch yields the keys that it touched. A batch that
    runs again after a failure writes the same rows, and the table's own order
    guard keeps a stream that starts from an empty checkpoint from moving a key
    back."""
    rows = latest_state(transform(sdf) if transform else sdf, keys, order)

    def upsert(batch: DataFrame, _batch_id: int) -> None:
        versions.merge(batch.sparkSession, table, batch, list(keys), order=list(order), check=False, max_deltas=max_deltas)

    w = rows.writeStream.outputMode("update").foreachBatch(upsert).option("checkpointLocation", checkpoint)
    return (w.trigger(availableNow=True) if available_now else w).start()
