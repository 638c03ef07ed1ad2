"""Bronze ingest: raw broker messages to typed order and click rows, with a quarantine."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

from ..functions import item_of_click, parse_iso_ts, parsed_once, text_fields, typed_fields, unconvertible
from ..schemas import CLICK_EVENT, ORDER_EVENT

# Topics, metadata and defaults of the bronze tables.
ORDERS_TOPIC, CLICKS_TOPIC = "raw.orders.v1", "raw.clicks.v1"
BEHAVIOR_TOPIC, ALERTS_TOPIC = "behavior.events.v1", "fraud.alerts.v1"
ATTRIBUTED_TOPIC, BILLING_TOPIC, RECON_TOPIC = "attributed.events.v1", "incremental.billing.v1", "recon.overwrite.v1"
SCHEMA_VERSION, PRODUCER = "v1", "events-gateway"
DEFAULT_STATUS, DEFAULT_ORDER_TYPE = "confirmed", "order"


def ingestion_id() -> Column:
    return F.concat_ws("-", "topic", F.col("partition").cast("string"), F.col("offset").cast("string"))


def _metadata() -> list[Column]:
    return [
        F.col("raw").alias("raw_event"),
        F.lit(SCHEMA_VERSION).alias("schema_version"),
        F.col("topic").alias("source_topic"),
        F.lit(PRODUCER).alias("producer_service"),
        ingestion_id().alias("ingestion_id"),
        F.col("partition").cast("int").alias("kafka_partition"),
        F.col("offset").cast("bigint").alias("kafka_offset"),
        F.col("timestamp").alias("ingestion_timestamp"),
        F.to_date(parse_iso_ts("e.timestamp")).alias("partition_date"),
    ]


def _event(schema: T.StructType, build: Callable[[Column], Column]) -> Column:
    return parsed_once("raw", text_fields(schema), build)


def _stored(schema: T.StructType) -> Column:
    """The event's typed fields but its metadata, which stays in the raw text."""
    flat = T.StructType([f for f in schema if not isinstance(f.dataType, T.MapType)])
    return _event(flat, lambda e: F.struct(*typed_fields(e, flat)))


def classified(messages: DataFrame) -> DataFrame:
    """Messages with their raw text and the reason why they cannot be read, if there is one."""
    text = F.col("value").cast("string")
    is_object = F.coalesce(text.rlike(r"^\s*\{") & F.try_parse_json(text).isNotNull(), F.lit(False))
    lost = F.when(F.col("topic") == ORDERS_TOPIC, _event(ORDER_EVENT, lambda e: unconvertible(e, ORDER_EVENT))).otherwise(
        _event(CLICK_EVENT, lambda e: unconvertible(e, CLICK_EVENT)))
    return messages.withColumn("raw", text).withColumn(
        "reason",
        F.when(F.coalesce(~F.col("topic").isin(ORDERS_TOPIC, CLICKS_TOPIC), F.lit(True)), "unknown_topic")
        .when(~is_object, "invalid_json")
        .when(lost, "invalid_type"),
    )


def ingest_bronze(messages: DataFrame) -> dict[str, DataFrame]:
    """Route messages (``value, topic, partition, offset, timestamp``) by topic.

    Works on batch and streaming frames alike. Numbers may be sent as text. Unreadable JSON, unknown
    topics and events with a value that does not convert to its type go to ``quarantine`` with a
    reason and the raw text. A timestamp that cannot be read is null, as are fields not sent.
    """
    return routed(classified(messages))


def routed(read: DataFrame) -> dict[str, DataFrame]:
    """The three tables' rows out of :func:`classified` messages."""
    orders = (
        read.where(F.col("reason").isNull() & (F.col("topic") == ORDERS_TOPIC))
        .withColumn("e", _stored(ORDER_EVENT))
        .select(
            "e.event_id", "e.order_id", "e.user_id", "e.item_id", "e.item_name", "e.price",
            F.coalesce("e.status", F.lit(DEFAULT_STATUS)).alias("status"),
            parse_iso_ts("e.timestamp").alias("event_timestamp"),
            F.coalesce("e.event_type", F.lit(DEFAULT_ORDER_TYPE)).alias("event_type"),
            *_metadata(),
        )
    )
    clicks = (
        read.where(F.col("reason").isNull() & (F.col("topic") == CLICKS_TOPIC))
        .withColumn("e", _stored(CLICK_EVENT))
        .select(
            "e.event_id", "e.user_id", "e.event_type", item_of_click("e.item_id", "e.ad_id").alias("item_id"),
            "e.session_id", parse_iso_ts("e.timestamp").alias("event_timestamp"), *_metadata(),
        )
    )
    quarantine = read.where(F.col("reason").isNotNull()).select(
        "topic", "partition", "offset", "timestamp", "raw", "reason", ingestion_id().alias("ingestion_id"),
        F.to_date("timestamp").alias("partition_date"))  # of arrival: an unreadable event has no time of its own
    return {"orders": orders, "clicks": clicks, "quarantine": quarantine}
