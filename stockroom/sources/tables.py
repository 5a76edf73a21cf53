"""Table sources: driver parquet tables and declared sources.

``source`` reads a table (catalog name or path) and checks the columns it
declares by name and type, then projects to exactly those columns, so the
scan reads only them (parquet ``ReadSchema``).
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from stockroom.functions.casts import instant_to_wall
from stockroom.operators.quality import ContractError, contract_schema, contract_violations

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table by name."""
    return spark.read.parquet(table_path(sf_dir, name))


def source(spark: SparkSession, name_or_path: str,
           declared: T.StructType | Mapping | None = None) -> DataFrame:
    """Read a declared source. A name containing ``/`` is a parquet path,
    anything else a catalog table. With ``declared`` columns the frame is
    checked (by name; extra columns allowed) and projected to them."""
    df = (spark.read.parquet(name_or_path) if "/" in name_or_path
          else spark.table(name_or_path))
    return df if declared is None else declare(df, declared, name_or_path)


def declare(df: DataFrame, declared: T.StructType | Mapping, name: str = "input", zone: str = "UTC") -> DataFrame:
    """Check that ``df`` has the declared columns (by name, exact type; extra
    columns allowed) and project to them. No Spark job runs.

    One conversion: a TIMESTAMP column declared as ``timestamp_ntz`` becomes its
    wall time in ``zone``. Text and numbers are never cast."""
    if not isinstance(declared, T.StructType):
        declared = contract_schema(declared)
    have = dict(df.dtypes)
    instants = [f.name for f in declared if isinstance(f.dataType, T.TimestampNTZType)
                and have.get(f.name) == "timestamp"]
    if instants:
        df = df.withColumns({c: instant_to_wall(c, zone) for c in instants})
    errs = [e for e in contract_violations(df.schema, declared)
            if not e.startswith("unexpected column")]
    if errs:
        raise ContractError(f"source {name}: " + "; ".join(errs))
    return df.select(*declared.fieldNames())


# Declared input schemas of the inventory workload (fixed values from the
# model specification: names and types of the external tables).
RAW_EVENTS = {"key": "string", "topic": "string", "timestamp": "timestamp_ntz",
              "value": "string", "processed_at": "timestamp_ntz"}
MARKETS = {"ID": "bigint", "region": "string", "market": "string", "country": "string"}
VEHICLE_DATA = {"inventory_id": "string", "model_series": "string",
                "engine_type": "string", "processed_at": "timestamp_ntz"}
KAFKA = {"key": "binary", "topic": "string", "timestamp": "timestamp_ntz", "value": "binary"}
