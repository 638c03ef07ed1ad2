"""Streaming bronze, silver and gold jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import DataStreamWriter

from ..operators.aggregates import revenue_by
from ..schemas import STREAM_ORDER
from ..session import discard, materialize
from ..sources.bronze import classified, routed
from ..sources.files import JSON_TIME
from ..sources.serving import MERGE_EVERY, ServingTable, appended
from ..sources.streams import batch_sink, file_sink, parse_json_lines
from ..sources.tables import append_idempotent
from .windows import dedup_stream


def parse_orders(messages: DataFrame) -> DataFrame:
    """Broker messages to order rows with a parsed event time."""
    text = messages.select(F.col("value").cast("string").alias("value"))
    return parse_json_lines(text, STREAM_ORDER).withColumn("event_ts", F.try_to_timestamp("event_time"))


def stream_to_bronze(orders: DataFrame, path: str, checkpoint: str) -> DataStreamWriter:
    return file_sink(orders, path, checkpoint, "json").options(**JSON_TIME)


def stream_to_silver(orders: DataFrame, path: str, checkpoint: str, delay: str = "10 minutes") -> DataStreamWriter:
    return file_sink(dedup_stream(orders, ["event_id"], "event_ts", delay), path, checkpoint, "parquet")


def stream_gold(orders: DataFrame, path: str, checkpoint: str, key: str = "restaurant") -> DataStreamWriter:
    """Revenue per restaurant in complete mode; every batch replaces the whole small result."""
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(path)

    return batch_sink(revenue_by(orders, key), write, checkpoint, "complete")


TARGETS = ["orders", "clicks", "quarantine"]
_COUNTS = "target string, received bigint, stored bigint, repeated bigint"


def ingest_counts(spark: SparkSession, base: str, every: int = MERGE_EVERY) -> ServingTable:
    """What each micro-batch of :func:`ingest_stream` received, stored and recognised as repeated, by target table."""
    return ServingTable(spark, f"{base}/_counts", _COUNTS, appended, every)


def ingest_stream(messages: DataFrame, base: str, checkpoint: str, every: int = MERGE_EVERY) -> DataStreamWriter:
    """Messages to the bronze tables under ``base``, and the counts of each batch.

    Offsets commit after all writes, so a crash replays the batch; rows already stored are recognised by
    ingestion id and skipped, and a replayed batch replaces its counts.
    """
    counts = ingest_counts(messages.sparkSession, base, every)

    def write(batch: DataFrame, batch_id: int) -> None:
        read, rows = materialize(classified(batch), "messages"), []
        targets = routed(read)
        for name in TARGETS:
            # Staged once: parsing is not repeated, and the files' footers know the count.
            staged = materialize(targets[name], "ingest")
            received = staged.count()
            stored = append_idempotent(staged, f"{base}/{name}", "ingestion_id", ["partition_date"])
            discard(staged)
            rows.append((name, received, stored, received - stored))
        discard(read)
        counts.write(batch.sparkSession.createDataFrame(rows, _COUNTS), batch_id)

    return batch_sink(messages, write, checkpoint)


_ALERT_RECORD = """alert_type string, user_id string, device_id string, order_id string, event_id string, amount double, severity string,
  message string, detected_at bigint, alert_data string"""


def alert_log(spark: SparkSession, path: str, every: int = MERGE_EVERY) -> ServingTable:
    """The alert store: typed columns plus the alert as JSON."""
    return ServingTable(spark, path, _ALERT_RECORD, appended, every)


def store_alerts(alerts: DataFrame, path: str, checkpoint: str, every: int = MERGE_EVERY) -> DataStreamWriter:
    """Alerts into the alert store; replayed batches replace themselves, small batches are merged into larger files."""
    from ..operators.fraud import alert_records

    log = alert_log(alerts.sparkSession, path, every)
    return batch_sink(alerts, lambda batch, batch_id: log.write(alert_records(batch), batch_id), checkpoint)
