"""Streaming sources and sinks. Kafka is configured here; tests drive the same jobs from files."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter

# Flush limits of the bronze consumer, expressed as trigger settings.
FLUSH_SECONDS, FLUSH_EVENTS, FLUSH_BYTES = 300, 100, 128 * 1024 * 1024


def kafka_source(spark: SparkSession, servers: str, topics: list[str], starting: str = "earliest",
                 max_offsets: int | None = None, **options: str) -> DataFrame:
    """Kafka topics as an unbounded table of ``key, value, topic, partition, offset, timestamp``."""
    reader = (
        spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
        .option("subscribe", ",".join(topics)).option("startingOffsets", starting).options(**options)
    )
    if max_offsets:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets)
    return reader.load()


def file_source(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet",
                max_files: int | None = None, max_bytes: int | None = None) -> DataFrame:
    """Files arriving in a folder as a stream."""
    reader = spark.readStream.format(fmt).schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    elif max_bytes:
        reader = reader.option("maxBytesPerTrigger", max_bytes)
    return reader.load(path)


def read_events_stream(spark: SparkSession, source: dict[str, str], schema: T.StructType) -> DataFrame:
    """Parsed JSON events from Kafka (``{"servers", "topics"}``) or from JSON text files (``{"path"}``).

    Malformed messages are dropped here; the bronze ingest keeps them in its quarantine.
    """
    if "servers" in source:
        text = kafka_source(spark, source["servers"], source["topics"].split(",")).select(F.col("value").cast("string"))
    else:
        text = spark.readStream.text(source["path"])
    return parse_json_lines(text, schema)


def parse_json_lines(text: DataFrame, schema: T.StructType, column: str = "value") -> DataFrame:
    readable = F.try_parse_json(F.col(column)).isNotNull() & F.col(column).rlike(r"^\s*\{")
    return text.where(readable).select(F.from_json(column, schema).alias("e")).select("e.*")


def as_messages(df: DataFrame, key: str) -> DataFrame:
    """Rows as key and JSON value, the form a broker sink takes."""
    return df.select(F.col(key).cast("string").alias("key"), F.to_json(F.struct("*")).alias("value"))


def write_alerts_stream(alerts: DataFrame, servers: str, topic: str, checkpoint: str) -> DataStreamWriter:
    """Alerts to a Kafka topic, at least once."""
    return (
        as_messages(alerts, "user_id").writeStream.format("kafka").option("kafka.bootstrap.servers", servers)
        .option("topic", topic).option("checkpointLocation", checkpoint)
    )


def file_sink(df: DataFrame, path: str, checkpoint: str, fmt: str = "parquet",
              partition_by: list[str] | None = None) -> DataStreamWriter:
    """Append-mode file sink: JSON for bronze, Parquet for silver."""
    writer = df.writeStream.format(fmt).outputMode("append").option("path", path).option("checkpointLocation", checkpoint)
    return writer.partitionBy(*partition_by) if partition_by else writer


def batch_sink(df: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append") -> DataStreamWriter:
    """A writer called per micro-batch; its offsets commit only after it returns."""
    return df.writeStream.outputMode(mode).foreachBatch(write).option("checkpointLocation", checkpoint)


def run_available(writer: DataStreamWriter, timeout: int | None = None, single_batch: bool = False) -> None:
    """Process everything that is there, then stop; however long it takes, unless ``timeout`` seconds are given.

    A job with processing-time state always has a next batch; run it with ``single_batch``.
    """
    query = (writer.trigger(once=True) if single_batch else writer.trigger(availableNow=True)).start()
    try:
        if timeout is None:
            query.awaitTermination()
        elif not query.awaitTermination(timeout):
            raise TimeoutError(f"stream still running after {timeout} s")
    finally:
        query.stop()


def run_continuously(writer: DataStreamWriter, seconds: int = FLUSH_SECONDS):
    """Start with a fixed flush interval."""
    return writer.trigger(processingTime=f"{seconds} seconds").start()
