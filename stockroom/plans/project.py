"""Full-refresh runs of the model chains.

Each model is written as a table (with a description) and the next model
reads that table, as when the models are materialized one by one: lineage is
cut at every layer and a failed step can be re-run from the previous table.
The chains are fixed; this is not a general DAG runner.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from stockroom.operators.quality import VEHICLE_AUDITS, AuditError  # noqa: F401 - raised by run_demo_chain
from stockroom.plans import demo, preview
from stockroom.sinks.tables import read_table, write_full

# Table descriptions (our wording).
DESCRIPTIONS = {
    "sdp_inventory_vehicles_demo": "Typed vehicle events, one row per vehicle and event time.",
    "agg_inventory_reporting_demo": "One row per vehicle: validity span, latest attributes, "
                                    "market and vehicle data.",
    "cdp_inventory_reporting_demo": "Daily stock counts and stock days per day and dimensions.",
    "sdp_inventory_vehicles_preview": "Latest snapshot per vehicle.",
    "cdp_inventory_reporting_preview": "Daily stock count and stock days.",
}


# Column descriptions (our wording), written with every model that has the column.
COLUMN_DESCRIPTIONS = {
    "inventory_id": "Vehicle id.",
    "event_timestamp": "Time of the event.",
    "processed_at": "Time the raw row was landed.",
    "valid_from": "First event of the vehicle.",
    "valid_to": "Last event of the vehicle.",
    "stock_date": "Calendar day of the stock.",
    "net_stock_count": "Vehicles in stock on the day.",
    "stock_days": "Days the vehicles have been in stock, summed.",
}


def _write(df: DataFrame, table: str, **options) -> dict[str, int]:
    name = table.rsplit(".", 1)[-1]
    return write_full(df, table, comment=DESCRIPTIONS[name],
               column_comments={c: COLUMN_DESCRIPTIONS[c] for c in df.columns if c in COLUMN_DESCRIPTIONS}, **options)


def run_demo_chain(spark: SparkSession, db: str, raw: DataFrame, markets: DataFrame,
                   vehicles: DataFrame, audits: str = "warn") -> DataFrame:
    """Typed events -> vehicle spans -> daily stock, each written to ``db``.

    ``audits``: ``"error"`` stops the run when an audit of the typed events
    finds violations, before they are shown in their table, ``"warn"`` records
    them, ``"off"`` skips them. They are counted while the events are written.
    Returns the audit summary ``(audit, violations)`` (empty when off).
    """
    t1, t2, t3 = (f"{db}.{n}" for n in ("sdp_inventory_vehicles_demo",
                                        "agg_inventory_reporting_demo",
                                        "cdp_inventory_reporting_demo"))
    found = _write(demo.sdp_demo(raw), t1, audits=() if audits == "off" else VEHICLE_AUDITS, on_violation=audits)
    summary = spark.createDataFrame(list(found.items()), "audit string, violations bigint")
    _write(demo.agg_demo(read_table(spark, t1), markets, vehicles), t2)
    _write(demo.cdp_demo(read_table(spark, t2)), t3)
    return summary


def run_preview_chain(spark: SparkSession, db: str, raw: DataFrame, as_of,
                      copy_db: str | None = None) -> None:
    """Snapshot -> daily stock, written to ``db`` (the daily table clustered
    by day); optionally the snapshot is copied to ``copy_db`` as another
    project's table."""
    t4, t5 = f"{db}.sdp_inventory_vehicles_preview", f"{db}.cdp_inventory_reporting_preview"
    _write(preview.sdp_preview(raw), t4)
    _write(preview.cdp_preview(read_table(spark, t4), as_of, sort=False), t5, cluster_by=["stock_date"])
    if copy_db:
        write_full(preview.passthrough(read_table(spark, t4)), f"{copy_db}.sdp_inventory_vehicles_preview")
