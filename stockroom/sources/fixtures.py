"""Input fixtures derived from the driver tables.

The inventory workload reads a raw JSON event log, a markets dimension and a
vehicle dimension. These are derived here from ``events``, ``customer``,
``nation`` and ``region`` by SQL that runs unchanged on Spark and on DuckDB
(the test oracle) apart from a few tokens, so both engines see identical
inputs. Row counts grow with the driver tables.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession

from stockroom.sources.tables import table_path

# Engine-specific tokens. {t_<name>} is a base-table reference.
_SPARK = {
    "ntz": "timestamp_ntz",
    "plus_days": "date_add(cast(ts as date), cast(event_id % 20 as int))",
}
_DUCK = {
    "ntz": "timestamp",
    "plus_days": "(cast(ts as date) + cast(event_id % 20 as int))",
}

MARKETS_SQL = """
select cast(n_nationkey as bigint) as ID, r_name as region,
       'Market ' || cast(n_regionkey as string) as market,
       case when n_nationkey = 7 then 'Other ' || n_name else n_name end as country
from {t_nation} join {t_region} on n_regionkey = r_regionkey
"""

VEHICLE_DATA_SQL = """
select case when c_custkey % 5 = 0 then 'W' else 'V' end || cast(c_custkey as string) as inventory_id, c_mktsegment as model_series,
       case c_custkey % 3 when 0 then 'EV' when 1 then 'ICE' else 'PHEV' end as engine_type,
       {ntz}'2024-01-01 00:00:00' as processed_at
from {t_customer}
"""

RAW_DEMO_SQL = """
with d as (
  select e.*, n.n_name, 0 as redelivery
  from {t_events} e join {t_customer} on user_id = c_custkey join {t_nation} n on c_nationkey = n_nationkey
  union all
  select e.*, n.n_name, 1 as redelivery
  from {t_events} e join {t_customer} on user_id = c_custkey join {t_nation} n on c_nationkey = n_nationkey
  where event_id % 7 = 0)
select cast(user_id as string) as key, 'inventory_demo' as topic, ts as timestamp,
  case when event_id % 101 = 0 then 'not json'
       when event_id % 97 = 0 then '{{"vehicle":{{"country":"X"}}}}'
       else '{{"vehicle":{{"id":"V' || cast(user_id as string) || '","country":"' || n_name || '","conditionType":'
    || case when event_id % 11 = 0 then 'null' when redelivery = 1 then '"redelivered"' else '"' || event_type || '"' end
    || ',"vehicleType":"' || case when event_id % 13 = 0 then 'DEMO_CAR' when event_id % 2 = 0 then 'USED_CAR' else 'COMMISSION_CAR' end
    || '","dealership":{{"displayName":"Dealer ' || cast(event_id % 10 as string) || '"}}'
    || case when event_id % 3 = 0 then '' else ',"onlineOrderingEnabled":' || case when event_id % 3 = 1 then 'true' else 'false' end end
    || ',"porscheApproved":' || case when event_id % 4 = 0 then 'null' when event_id % 4 = 1 then 'false' else 'true' end
    || ',"arrivalDate":"' || cast(cast(ts as date) as string) || '"'
    || case when event_type = 'purchase' then ',"salesDate":"' || cast(cast(ts as date) as string) || '"' else '' end
    || '}}}}' end as value,
  ts + interval '1' hour * (1 + redelivery) as processed_at
from d
"""

RAW_PREVIEW_SQL = """
select cast(user_id as string) as key, 'inventory_preview' as topic, ts as timestamp,
  case when event_id % 97 = 0 then '{{"vehicleSnapshot":{{}}}}'
       else '{{"vehicleSnapshot":{{"id":"V' || cast(event_id % 400 as string)
    || '","creationDateTime":"' || cast(cast(ts as date) as string) || 'T00:00:00"'
    || case when event_id % 3 = 0 then ''
            else ',"removalDateTime":"' || cast({plus_days} as string) || 'T00:00:00"' end
    || '}}}}' end as value,
  ts + interval '1' hour as processed_at
from {t_events}
"""

FIXTURES = {
    "markets": MARKETS_SQL,
    "vehicle_data": VEHICLE_DATA_SQL,
    "raw_demo": RAW_DEMO_SQL,
    "raw_preview": RAW_PREVIEW_SQL,
}

_BASE = ("events", "customer", "nation", "region", "orders")


def base_view(spark: SparkSession, sf_dir: str, table: str) -> str:
    """A session temp view over a driver table, created once per session and
    folder: the file listing and footer are resolved once, not at every
    reference in every fixture."""
    view = f"sr_{table}_{hashlib.sha1(sf_dir.encode()).hexdigest()[:10]}"
    if not spark.catalog.tableExists(view):
        spark.read.parquet(table_path(sf_dir, table)).createOrReplaceTempView(view)
    return view


def spark_sql(name: str, sf_dir: str, spark: SparkSession | None = None) -> str:
    """The fixture's Spark SQL; table references are temp views when a
    session is given, parquet paths otherwise."""
    if spark is None:
        refs = {f"t_{t}": f"parquet.`{table_path(sf_dir, t)}`" for t in _BASE}
    else:
        refs = {f"t_{t}": base_view(spark, sf_dir, t) for t in _BASE if f"{{t_{t}}}" in FIXTURES[name]}
    return FIXTURES[name].format(**_SPARK, **refs)


def duckdb_sql(name: str) -> str:
    refs = {f"t_{t}": t for t in _BASE}
    return FIXTURES[name].format(**_DUCK, **refs)


def duckdb_with(*names: str) -> str:
    """``WITH`` clause defining the named fixtures for a DuckDB oracle query
    (trailing comma included, so further CTEs can follow)."""
    return "with " + ",\n".join(f"{n} as ({duckdb_sql(n)})" for n in names) + ",\n"


def frame(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The named fixture as a Spark DataFrame over the driver tables."""
    return spark.sql(spark_sql(name, sf_dir, spark))


#: Pinned clock for the span models (``current_timestamp()`` in the models).
AS_OF = "2024-02-15 12:00:00"
