"""Sources: driver tables, declared sources, fixtures, Kafka-shaped input."""

from stockroom.sources.tables import (
    TABLES, declare, load, source, table_path, RAW_EVENTS, MARKETS, VEHICLE_DATA, KAFKA,
)
from stockroom.sources import fixtures

__all__ = ["TABLES", "declare", "load", "source", "table_path", "fixtures",
           "RAW_EVENTS", "MARKETS", "VEHICLE_DATA", "KAFKA"]
