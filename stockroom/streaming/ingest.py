"""Raw landing stream: a message stream -> typed raw rows -> append-only table.

The production source is a Kafka topic (binary key/value). The Kafka
connector is not bundled with plain PySpark, so the source format is a
parameter: tests and the registered query use Spark's file source over
Kafka-shaped parquet files, with the same downstream plan.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from stockroom.functions.casts import ntz_lit

RAW_COLUMNS = ["key", "topic", "timestamp", "value", "processed_at"]


def kafka_options(bootstrap_servers: str, topic: str, username: str | None = None,
                  password: str | None = None) -> dict[str, str]:
    """Options for a SASL_SSL/PLAIN Kafka subscription from the earliest
    offset, with headers. Credentials are passed in by the caller (from the
    cluster's secret store), never stored in code."""
    opts = {
        "kafka.bootstrap.servers": bootstrap_servers,
        "subscribe": topic,
        "startingOffsets": "earliest",
        "includeHeaders": "true",
    }
    if username is not None:
        opts.update({
            "kafka.security.protocol": "SASL_SSL",
            "kafka.sasl.mechanism": "PLAIN",
            "kafka.sasl.jaas.config": (
                "org.apache.kafka.common.security.plain.PlainLoginModule required "
                f"username='{username}' password='{password}';"),
        })
    return opts


def read_stream(spark: SparkSession, fmt: str, schema: T.StructType | None = None,
                path: str | None = None, **options) -> DataFrame:
    """``spark.readStream`` for any source format (``kafka``, ``parquet``...)."""
    r = spark.readStream.format(fmt).options(**options)
    if schema is not None:
        r = r.schema(schema)
    return r.load(path) if path else r.load()


def with_event_date(df: DataFrame) -> DataFrame:
    """Add the raw table's day partition column ``event_date = day(timestamp)``."""
    from stockroom.operators.filters import DAY_COLUMN
    return df.withColumn(DAY_COLUMN, F.to_date("timestamp"))


def land_raw(df: DataFrame, processed_at: Column | str | _dt.datetime | None = None) -> DataFrame:
    """Keep key/topic/timestamp/value, decode bytes to text, stamp
    ``processed_at`` (the processing time by default). Works on batch and
    streaming frames.

    Both times are landed as ``timestamp_ntz`` (the declared raw schema): a
    zone-aware source time is converted to its wall time in the session time
    zone, which :func:`stockroom.session.get_spark` pins to UTC.
    """
    if processed_at is None:
        stamp = F.current_timestamp().cast("timestamp_ntz")
    elif isinstance(processed_at, Column):
        stamp = processed_at
    else:
        stamp = ntz_lit(processed_at)
    return df.select(F.col("key").cast("string").alias("key"),
                     F.col("topic").cast("string").alias("topic"),
                     F.col("timestamp").cast("timestamp_ntz").alias("timestamp"),
                     F.col("value").cast("string").alias("value"),
                     stamp.alias("processed_at"))


def append_stream(df: DataFrame, table: str, checkpoint: str, fmt: str = "parquet",
                  available_now: bool = True, options: Mapping[str, str] | None = None,
                  partition_by: tuple[str, ...] = (), files: int | None = None) -> StreamingQuery:
    """Append a stream into a catalog table with a checkpoint (exactly-once
    file sink). ``available_now``: process what is there, then stop.
    ``partition_by``: e.g. ``("event_date",)`` after :func:`with_event_date`,
    so later time filters prune whole days. ``files``: rows of a partition are
    brought together in at most so many tasks, so a micro-batch leaves at most
    that many files a partition instead of one a task; a day with very many rows
    is still shared by that many tasks."""
    if partition_by and files:
        df = df.repartition(*partition_by, F.pmod(F.xxhash64(*df.columns), F.lit(files)))
    w = (df.writeStream.format(fmt).outputMode("append")
         .option("checkpointLocation", checkpoint).options(**(options or {})))
    if partition_by:
        w = w.partitionBy(*partition_by)
    w = w.trigger(availableNow=True) if available_now else w
    return w.toTable(table)


def ingest(spark: SparkSession, source_fmt: str, table: str, checkpoint: str,
           schema: T.StructType | None = None, path: str | None = None,
           processed_at=None, files: int | None = 4, **options) -> StreamingQuery:
    """Source stream -> raw projection -> append sink (``files``: see :func:`append_stream`)."""
    src = read_stream(spark, source_fmt, schema, path, **options)
    return append_stream(with_event_date(land_raw(src, processed_at)), table, checkpoint,
                         partition_by=("event_date",), files=files)
