"""Streaming click-to-order attribution and counters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import DataStreamWriter

from ..operators.ads import ATTRIBUTION_WINDOW, COUNTERS
from ..session import discard, materialize
from ..sources.serving import BATCH, MERGE_EVERY, ServingTable, appended, summed
from ..sources.streams import batch_sink
from .windows import with_watermark


def attribute_stream(orders: DataFrame, clicks: DataFrame, window: str = ATTRIBUTION_WINDOW,
                     delay: str = "10 seconds", include_impressions: bool = False) -> DataFrame:
    """Attributed orders as a stream: a left-semi interval join, so each order appears once.

    Watermarks on both sides and the interval bound let Spark drop clicks that can match no
    future order. Clicks that arrive after their order but within ``delay`` still count.
    """
    source = clicks if include_impressions else clicks.where("event_type = 'click'")
    o = with_watermark(orders, "event_timestamp", delay).alias("o")
    c = with_watermark(
        source.select("user_id", "item_id", "event_timestamp"), "event_timestamp", delay).alias("c")
    return o.join(
        c,
        F.expr(f"""o.user_id = c.user_id and o.item_id = c.item_id
                   and o.event_timestamp >= c.event_timestamp
                   and o.event_timestamp <= c.event_timestamp + interval {window}"""),
        "left_semi",
    )


def counter_increments(df: DataFrame) -> DataFrame:
    """Counter steps of one micro-batch of engagement rows: ``event_type, item_id, event_timestamp, price``."""
    kind, order = F.col("event_type"), F.col("event_type") == "order"
    return (
        df.where("item_id is not null")
        .groupBy("item_id", F.to_date("event_timestamp").alias("date")).agg(
            F.count_if(kind == "impression").alias("impressions"),
            F.count_if(~kind.isin("impression", "order", "attributed_order")).alias("clicks"),
            F.count_if(order).alias("orders"),
            F.count_if(kind == "attributed_order").alias("attributed_orders"),
            F.coalesce(F.sum(F.when(order, F.col("price"))), F.lit(0)).cast("decimal(38,2)").alias("revenue"))
    )


_COUNTER_ROW = "item_id bigint, date date, impressions bigint, clicks bigint, orders bigint, attributed_orders bigint, revenue decimal(38,2)"


def counter_table(spark: SparkSession, path: str, every: int = MERGE_EVERY) -> ServingTable:
    return ServingTable(spark, path, _COUNTER_ROW, summed(["item_id", "date"], COUNTERS), every)


def counter_log(events: DataFrame, path: str, checkpoint: str, every: int = MERGE_EVERY) -> DataStreamWriter:
    """Each micro-batch's increments into a serving table; a replayed batch counts once."""
    table = counter_table(events.sparkSession, path, every)
    return batch_sink(events, lambda batch, batch_id: table.write(counter_increments(batch), batch_id), checkpoint)


def read_counters(spark: SparkSession, path: str) -> DataFrame:
    """Current counters."""
    return counter_table(spark, path).read().drop(BATCH)


_CHANGE = "item_id bigint, date date, metric string, before double, after double, amount double"


def change_feed(spark: SparkSession, path: str, every: int = MERGE_EVERY) -> ServingTable:
    """What every micro-batch changed in the counters, one row for each (item, date, metric) it touched."""
    return ServingTable(spark, f"{path}/changes", _CHANGE, appended, every)


def counter_changes(increments: DataFrame, before: DataFrame) -> DataFrame:
    """Each non-zero increment with the counter's value before and after it."""
    def long(df: DataFrame, value: str) -> DataFrame:
        plain = df.select("item_id", "date", *[F.col(m).cast("double").alias(m) for m in COUNTERS])
        return plain.unpivot(["item_id", "date"], COUNTERS, "metric", value)

    old = long(before.join(increments.select("item_id", "date"), ["item_id", "date"], "left_semi"), "before")
    start = F.coalesce("before", F.lit(0.0))
    return long(increments, "amount").where("amount <> 0").join(old, ["item_id", "date", "metric"], "left").select(
        "item_id", "date", "metric", start.alias("before"), (start + F.col("amount")).alias("after"), "amount")


def apply_with_changes(batch: DataFrame, batch_id: int, path: str, every: int = MERGE_EVERY) -> None:
    """One micro-batch of engagement rows into the counters at ``path``, and what it changes into the change feed.

    The feed is written first and the counters are its ledger: a batch that failed between the two, or is
    replayed, gives the same changes against the totals of the other batches and replaces its own; one
    that is merged into the counters was emitted before and is skipped.
    """
    spark = batch.sparkSession
    counters, feed = counter_table(spark, f"{path}/counters", every), change_feed(spark, path, every)
    if counters.is_merged(batch_id):
        return
    increments = materialize(counter_increments(batch), "increments")
    feed.write(counter_changes(increments, counters.without(batch_id)), batch_id)
    counters.write(increments, batch_id)
    discard(increments)


def billing_increments(events: DataFrame, path: str, checkpoint: str, every: int = MERGE_EVERY) -> DataStreamWriter:
    """Engagement rows into counters, with the increments to be billed as a feed (see :func:`change_feed`)."""
    return batch_sink(events, lambda batch, batch_id: apply_with_changes(batch, batch_id, path, every), checkpoint)
