"""Continuous jobs: fraud alerts and click attribution. Start them with a trigger of choice."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import DataStreamWriter

from ..operators.ads import ATTRIBUTION_WINDOW
from ..operators.cooldown import cooldown
from ..operators.fraud import COOLDOWN
from ..sources.bronze import CLICKS_TOPIC, ORDERS_TOPIC
from ..sources.streams import FLUSH_BYTES, FLUSH_EVENTS, FLUSH_SECONDS, file_sink, file_source, kafka_source
from ..streaming.attribution import attribute_stream
from ..streaming.ingest import ingest_stream, store_alerts
from ..streaming.processors import cooldown_stream, fraud_stream

# Checkpoint intervals of the two jobs.
FRAUD_TRIGGER, ATTRIBUTION_TRIGGER = "10 seconds", "60 seconds"
# Flush interval of the bronze consumer.
BRONZE_TRIGGER = f"{FLUSH_SECONDS} seconds"


def cooldown_key(alerts: DataFrame) -> DataFrame:
    """Alerts with the cooldown key: alert type and user."""
    return alerts.withColumn("key", F.concat_ws(":", "alert_type", F.coalesce("user_id", F.lit(""))))


def rules_job(transactions: DataFrame, path: str, checkpoint: str, **limits) -> DataStreamWriter:
    """All four rules over the transaction stream, to an append-only alert table."""
    return file_sink(fraud_stream(transactions, **limits), path, checkpoint)


def cooldown_job(alerts: DataFrame, path: str, checkpoint: str, period: str = COOLDOWN) -> DataStreamWriter:
    """The alert table as a stream through the cooldown into the alert store.

    A second job keeps the rules' state and the cooldown's state in separate checkpoints, so each
    may be restarted or re-tuned alone.
    """
    passed = cooldown_stream(cooldown_key(alerts), ["key"], period=period).drop("key")
    return store_alerts(passed, path, checkpoint)


def attribution_job(orders: DataFrame, clicks: DataFrame, path: str, checkpoint: str,
                    window: str = ATTRIBUTION_WINDOW, delay: str = "10 seconds") -> DataStreamWriter:
    """Attributed orders as an append-only feed."""
    return file_sink(attribute_stream(orders, clicks, window, delay), path, checkpoint)


def bronze_job(spark: SparkSession, base: str, checkpoint: str, servers: str | None = None, topics: list[str] | None = None,
               folder: str | None = None, schema: T.StructType | None = None) -> DataStreamWriter:
    """Messages from a broker, or from a folder of files, to bronze; one micro-batch takes no more than a flush of the consumer."""
    if servers:
        messages = kafka_source(spark, servers, topics or [ORDERS_TOPIC, CLICKS_TOPIC], max_offsets=FLUSH_EVENTS)
    else:
        messages = file_source(spark, folder, schema, max_bytes=FLUSH_BYTES)
    return ingest_stream(messages, base, checkpoint)


def start(writer: DataStreamWriter, trigger: str):
    """Run a job for good, a micro-batch every so often (``FRAUD_TRIGGER``, ``ATTRIBUTION_TRIGGER``, ``BRONZE_TRIGGER``)."""
    return writer.trigger(processingTime=trigger).start()


def replay_cooldown(alerts: DataFrame, period: str = COOLDOWN) -> DataFrame:
    """Batch equivalent of :func:`cooldown_job`, for backfills."""
    return cooldown(cooldown_key(alerts), ["key"], period=period, tiebreak=["event_id"]).drop("key")
