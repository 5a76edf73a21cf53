"""Preview chain: current snapshot per vehicle -> daily stock.

``sdp_preview``  latest snapshot per vehicle (dates kept as text)
``cdp_preview``  open spans padded to ``as_of``, spans expanded to days,
                 stock count and stock days per day, ordered by day
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockroom.functions.casts import pad_open_end, to_ts
from stockroom.operators.filters import drop_null_key, valid_spans
from stockroom.operators.latest import latest_per_key
from stockroom.operators.spans import daily_stock
from stockroom.plans.demo import extract
from stockroom.sources.tables import RAW_EVENTS, declare

# Fixed values of the model specification: output column -> JSON path.
PREVIEW_PATHS = {
    "inventory_id": "$.vehicleSnapshot.id",
    "removal_date_time": "$.vehicleSnapshot.removalDateTime",
    "creation_date_time": "$.vehicleSnapshot.creationDateTime",
}

SNAPSHOT_COLUMNS = ["event_timestamp", "inventory_id", "removal_date_time", "creation_date_time"]

# Ordering of "latest": event time, then processing time, then a 64-bit hash
# of the raw text (ties resolve the same way on every run; the hash keeps the
# raw document out of the shuffle).
LATEST_ORDER = ("event_timestamp", "processed_at", "__value")


def parse_preview(raw: DataFrame, json: str = "struct") -> DataFrame:
    """Typed snapshot rows with a non-null id (plus ordering helpers)."""
    p = extract(declare(raw, RAW_EVENTS, "raw events"), PREVIEW_PATHS, json)
    p = p.select(F.col("timestamp").alias("event_timestamp"), "inventory_id",
                 "removal_date_time", "creation_date_time", "processed_at",
                 F.xxhash64("value").alias("__value"))
    return drop_null_key(p, "inventory_id")


def latest_snapshot(parsed: DataFrame, keys=("inventory_id",), method: str = "window") -> DataFrame:
    return latest_per_key(parsed, list(keys), LATEST_ORDER, method).select(*SNAPSHOT_COLUMNS)


def sdp_preview(raw: DataFrame, json: str = "struct", method: str = "window") -> DataFrame:
    """Latest snapshot per vehicle."""
    return latest_snapshot(parse_preview(raw, json), method=method)


def snapshot_spans(snap: DataFrame, as_of, lenient: bool = False) -> DataFrame:
    """Spans ``creation .. coalesce(removal, as_of)``, only those with
    ``end > start`` (text dates cast explicitly to timestamps)."""
    s = snap.select("inventory_id",
                    to_ts("creation_date_time", lenient).alias("span_start"),
                    pad_open_end(to_ts("removal_date_time", lenient), as_of).alias("span_end"))
    return valid_spans(s, "span_start", "span_end", as_of)


def cdp_preview(snap: DataFrame, as_of, method: str = "sweep", lo=None, hi=None,
                sort: bool = True) -> DataFrame:
    """Daily ``net_stock_count`` and ``stock_days`` (INT day differences
    summed to BIGINT); ``lo``/``hi`` restrict the days (clamped before
    expansion)."""
    out = daily_stock(snapshot_spans(snap, as_of), "span_start", "span_end",
                      method=method, lo=lo, hi=hi, age_long=False)
    return out.orderBy("stock_date") if sort else out


def passthrough(df: DataFrame) -> DataFrame:
    """``select *`` of another project's model."""
    return df.select("*")
