"""Demo chain: typed vehicle events -> one row per vehicle -> daily stock.

``sdp_demo``   raw JSON events -> typed rows, re-deliveries removed
``agg_demo``   one row per vehicle: validity span, latest attributes,
               event count, enriched with market and vehicle dimensions
``cdp_demo``   daily stock per day and eight dimensions
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockroom.functions.casts import default_if_null, flag_to_int, to_bool, to_date
from stockroom.functions.json import json_fields, json_struct_fields
from stockroom.operators.enrich import left_join_dimension, left_join_entity
from stockroom.operators.filters import drop_null_key
from stockroom.operators.latest import (
    dedup_redelivery, first_over_full_frame, latest_attributes,
)
from stockroom.operators.quality import contract_schema, enforce_contract
from stockroom.operators.spans import daily_stock
from stockroom.sources.tables import MARKETS, RAW_EVENTS, VEHICLE_DATA, declare

# Fixed values of the model specification: output column -> JSON path of the
# demo event envelope.
DEMO_PATHS = {
    "arrival_date": "$.vehicle.arrivalDate",
    "sales_date": "$.vehicle.salesDate",
    "inventory_id": "$.vehicle.id",
    "country": "$.vehicle.country",
    "vehicle_condition": "$.vehicle.conditionType",
    "vehicle_type": "$.vehicle.vehicleType",
    "dealer_name": "$.vehicle.dealership.displayName",
    "online_orderable": "$.vehicle.onlineOrderingEnabled",
    "porsche_approved": "$.vehicle.porscheApproved",
}

# Enforced contract of the typed events (timestamps are zone-less here).
SDP_DEMO_CONTRACT = contract_schema({
    "event_timestamp": "timestamp_ntz", "arrival_date": "date", "sales_date": "date",
    "inventory_id": "string", "country": "string", "vehicle_condition": "string",
    "vehicle_type": "string", "dealer_name": "string", "online_orderable": "boolean",
    "porsche_approved": "boolean", "processed_at": "timestamp_ntz",
})

ATTRIBUTES = ["country", "vehicle_condition", "vehicle_type", "dealer_name",
              "online_orderable", "porsche_approved", "arrival_date", "sales_date"]

AGG_COLUMNS = ["inventory_id", "valid_from", "valid_to", "country", "region", "market",
               "vehicle_condition", "model_series", "vehicle_type", "engine_type",
               "dealer_name", "online_orderable", "porsche_approved", "arrival_date",
               "sales_date", "event_count", "processed_at"]

DIMENSIONS = ["region", "market", "country", "vehicle_condition", "model_series",
              "vehicle_type", "engine_type", "dealer_name"]


def extract(raw: DataFrame, paths: dict, json: str = "struct") -> DataFrame:
    """``json="struct"``: one ``from_json`` per row; ``"path"``: one
    ``get_json_object`` per field (same values)."""
    f = json_struct_fields if json == "struct" else json_fields
    return f(raw, "value", paths)


def sdp_demo(raw: DataFrame, json: str = "struct", method: str = "window",
             lenient: bool = False) -> DataFrame:
    """Typed demo events, one row per ``(inventory_id, event_timestamp)``:
    the most recently processed delivery wins. Remaining ties break on a
    64-bit hash of the raw text: deterministic, and 8 bytes through the
    shuffle instead of the whole document."""
    typed = typed_events(raw, json, lenient)
    out = dedup_redelivery(typed, order=("processed_at", "__value"), method=method).drop("__value")
    return enforce_contract(out.select(*SDP_DEMO_CONTRACT.fieldNames()), SDP_DEMO_CONTRACT)


def typed_events(raw: DataFrame, json: str = "struct", lenient: bool = False) -> DataFrame:
    """Typed demo events with a vehicle id, every delivery (batch or stream)."""
    p = extract(declare(raw, RAW_EVENTS, "raw events"), DEMO_PATHS, json)
    typed = p.select(
        F.col("timestamp").alias("event_timestamp"),
        to_date("arrival_date", lenient).alias("arrival_date"),
        to_date("sales_date", lenient).alias("sales_date"),
        "inventory_id", "country", "vehicle_condition", "vehicle_type", "dealer_name",
        default_if_null(to_bool("online_orderable", lenient), False).alias("online_orderable"),
        to_bool("porsche_approved", lenient).alias("porsche_approved"),
        "processed_at", F.xxhash64("value").alias("__value"))
    return drop_null_key(typed, "inventory_id")


def vehicle_spans(events: DataFrame, method: str = "max_by", frame: str = "join") -> DataFrame:
    """One row per vehicle: span ``min..max(event_timestamp)``, the latest
    event's attributes, event count, last processing time.

    ``max_by``: a single partial+final aggregation (one shuffle, one row per
    vehicle and map task). ``window``: the model's own formulation, eight
    ``first_value`` columns over a full frame, then ``any_value``; ``frame``
    picks how the full-frame values are computed (see
    :func:`first_over_full_frame`; ``"window"`` is the literal plan that
    buffers each vehicle's history in one task, kept for comparison).
    """
    extra = [F.min("event_timestamp").alias("valid_from"),
             F.max("event_timestamp").alias("valid_to"),
             F.count(F.lit(1)).alias("event_count"),
             F.max("processed_at").alias("processed_at")]
    if method == "max_by":
        return latest_attributes(events, "inventory_id", "event_timestamp", ATTRIBUTES, extra)
    if method == "window":
        w = first_over_full_frame(events, "inventory_id", ["event_timestamp"], ATTRIBUTES,
                                  method=frame)
        return w.groupBy("inventory_id").agg(
            *[F.any_value(c).alias(c) for c in ATTRIBUTES], *extra)
    raise ValueError(method)


def agg_demo(events: DataFrame, markets: DataFrame, vehicles: DataFrame,
             method: str = "max_by", frame: str = "join") -> DataFrame:
    """Vehicle spans left-joined to markets (by country, broadcast after a
    size check) and vehicle data (by inventory_id)."""
    spans = vehicle_spans(events, method, frame)
    markets = declare(markets, MARKETS, "markets")
    vehicles = declare(vehicles, VEHICLE_DATA, "vehicle data")
    j = left_join_dimension(spans, markets.select("country", "region", "market"), "country")
    j = left_join_entity(j, vehicles.select("inventory_id", "model_series", "engine_type"),
                         "inventory_id")
    return j.select(*AGG_COLUMNS)


def cdp_demo(spans: DataFrame, method: str = "sweep") -> DataFrame:
    """Daily stock per ``(stock_date, *DIMENSIONS)`` with stock counts,
    conditional counts and stock days; a vehicle without span keeps one row
    with a null day. ``method="sweep"`` (default) shuffles two change rows
    per vehicle; ``"explode"`` generates one row per vehicle and day."""
    measures = {
        "published_net_stock_count": F.lit(1),
        "net_stock_count": F.lit(1),
        "online_orderable_count": flag_to_int("online_orderable"),
        "approved_count": flag_to_int("porsche_approved"),
    }
    return daily_stock(spans, "valid_from", "valid_to", DIMENSIONS, measures,
                       method=method, outer=True, age_long=True)
