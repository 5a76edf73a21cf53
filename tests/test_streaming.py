from pyspark.sql import functions as F

from stockroom.plans import preview
from stockroom.session import scratch_database, scratch_path
from stockroom.sinks import read_table
from stockroom.sources import fixtures
from stockroom.operators.quality import contract_schema
from stockroom.sources.tables import KAFKA
from stockroom.streaming.ingest import append_stream, land_raw, read_stream
from stockroom.streaming.upsert import stream_upsert_latest
from tests.conftest import SF_SMALL, rows


def _kafka_files(spark):
    raw = fixtures.frame(spark, SF_SMALL, "raw_preview")
    return raw, raw.select(F.col("key").cast("binary").alias("key"), "topic", "timestamp",
                           F.col("value").cast("binary").alias("value"))


def test_landing_stream_equals_batch_and_restart_adds_nothing(spark):
    raw, kafka = _kafka_files(spark)
    topic, ckpt = scratch_path(spark, "topic"), scratch_path(spark, "ckpt")
    t = f"{scratch_database(spark)}.raw"
    cut = F.col("timestamp") < F.lit("2024-01-15").cast("timestamp_ntz")

    def run():
        src = read_stream(spark, "parquet", contract_schema(KAFKA), topic)
        append_stream(land_raw(src, processed_at="2024-02-01 00:00:00"), t, ckpt).awaitTermination()

    kafka.where(cut).write.mode("append").parquet(topic)
    run()
    n1 = read_table(spark, t).count()
    kafka.where(~cut).write.mode("append").parquet(topic)
    run()
    run()
    assert n1 == raw.where(cut).count()
    expected = land_raw(kafka, processed_at="2024-02-01 00:00:00")
    assert rows(read_table(spark, t)) == rows(expected)


def test_stream_upsert_equals_batch_latest(spark):
    raw, kafka = _kafka_files(spark)
    topic, ckpt = scratch_path(spark, "topic"), scratch_path(spark, "ckpt")
    t = f"{scratch_database(spark)}.snap"

    def to_rows(batch):
        landed = land_raw(batch, processed_at=F.col("timestamp") + F.expr("interval 1 hour"))
        return preview.parse_preview(landed).withColumnRenamed("__value", "raw_hash")

    late_first = F.col("timestamp") >= F.lit("2024-01-15").cast("timestamp_ntz")
    for part in (late_first, ~late_first):
        kafka.where(part).write.mode("append").parquet(topic)
        src = read_stream(spark, "parquet", contract_schema(KAFKA), topic, maxFilesPerTrigger="1")
        stream_upsert_latest(src, t, ["inventory_id"], ["event_timestamp", "processed_at", "raw_hash"],
                             ckpt, transform=to_rows).awaitTermination()
    got = read_table(spark, t).select(*preview.SNAPSHOT_COLUMNS)
    assert rows(got) == rows(preview.sdp_preview(raw))


def test_land_raw_types_match_declared_raw_schema(spark):
    import datetime as dt
    from stockroom.sources.tables import RAW_EVENTS, declare
    from stockroom.streaming.ingest import kafka_options
    src = spark.createDataFrame([(b"k", "t", dt.datetime(2024, 1, 1), b'{"a":1}')],
                                "key binary, topic string, timestamp timestamp, value binary")
    landed = land_raw(src)
    declare(landed, RAW_EVENTS)   # zone-aware source time and default stamp become NTZ
    assert landed.first()["value"] == '{"a":1}'
    opts = kafka_options("broker:9092", "topic", "user", "secret")
    assert opts["startingOffsets"] == "earliest" and opts["kafka.security.protocol"] == "SASL_SSL"
    assert "includeHeaders" in opts and "subscribe" in opts


def test_ingest_lands_day_partitioned_table(spark):
    from stockroom.streaming.ingest import ingest
    raw, kafka = _kafka_files(spark)
    topic, ckpt = scratch_path(spark, "topic"), scratch_path(spark, "ckpt")
    t = f"{scratch_database(spark)}.raw"
    kafka.write.mode("append").parquet(topic)
    ingest(spark, "parquet", t, ckpt, schema=contract_schema(KAFKA), path=topic,
           processed_at="2024-02-01 00:00:00").awaitTermination()
    landed = spark.table(t)
    assert "event_date" in landed.columns
    assert landed.where(F.col("event_date") != F.to_date("timestamp")).count() == 0
    assert rows(landed.drop("event_date")) == rows(land_raw(kafka, processed_at="2024-02-01 00:00:00"))
    # The stream sink tracks files in its own log (not catalog partitions):
    # check the physical layout instead.
    files = landed.inputFiles()
    assert files and all("/event_date=" in f for f in files)
