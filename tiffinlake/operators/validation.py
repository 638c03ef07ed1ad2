"""Row validation by ordered rule lists: a flag, and the name of the first rule that failed."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F


@dataclass(frozen=True)
class Rule:
    """``check`` must hold; null counts as failing."""

    message: str
    check: Callable[[], Column]


def present(name: str) -> Callable[[], Column]:
    return lambda: F.col(name).isNotNull()


def positive(name: str) -> Callable[[], Column]:
    return lambda: F.col(name) > 0


# Messages, event types and rule order per profile.
ORDER_RULES: dict[str, list[Rule]] = {
    "full": [
        Rule("Missing ORDER_ID", present("order_id")),
        Rule("Missing USER_ID", present("user_id")),
        Rule("Missing ITEM_ID", present("item_id")),
        Rule("Invalid PRICE", positive("price")),
        Rule("Missing TIMESTAMP", present("event_timestamp")),
    ],
    "lake": [
        Rule("Missing ORDER_ID", present("order_id")),
        Rule("Missing USER_ID", present("user_id")),
        Rule("Invalid PRICE", positive("price")),
        Rule("Missing TIMESTAMP", present("event_timestamp")),
    ],
    "warehouse": [
        Rule("price_invalid", positive("price")),
        Rule("user_id_null", present("user_id")),
        Rule("item_id_null", present("item_id")),
    ],
}

CLICK_EVENT_TYPES = ["click", "impression"]

CLICK_RULES: dict[str, list[Rule]] = {
    "lake": [
        Rule("Missing EVENT_ID", present("event_id")),
        Rule("Missing USER_ID", present("user_id")),
        Rule("Missing TIMESTAMP", present("event_timestamp")),
        Rule("hover_impression_noise", present("item_id")),
    ],
    "warehouse": [
        Rule("user_id_null", present("user_id")),
        Rule("unknown_event_type", lambda: F.col("event_type").isin(CLICK_EVENT_TYPES)),
    ],
}

BEHAVIOR_EVENT_TYPES = ["view", "impression", "click", "order"]

# Bounds and enumerations of the event contracts.
CONTRACTS: dict[str, list[Rule]] = {
    "order": [
        Rule("user_id must be > 0", lambda: F.col("user_id").isNull() | (F.col("user_id") > 0)),
        Rule("item_id must be > 0", positive("item_id")),
        Rule("quantity must be > 0", lambda: F.col("quantity").isNull() | (F.col("quantity") > 0)),
        Rule("price must be >= 0", lambda: F.col("price").isNull() | (F.col("price") >= 0)),
        Rule("unknown order_type", lambda: F.col("order_type").isNull()
             | F.col("order_type").isin("placed", "confirmed", "cancelled", "delivered")),
    ],
    "click": [
        Rule("user_id must be > 0", lambda: F.col("user_id").isNull() | (F.col("user_id") > 0)),
        Rule("ad_id is required", present("ad_id")),
    ],
    "behavior": [
        Rule("unknown event_type", lambda: F.col("event_type").isin(BEHAVIOR_EVENT_TYPES)),
        Rule("user_id must be > 0", lambda: F.col("user_id").isNull() | (F.col("user_id") > 0)),
        Rule("item_id must be > 0", positive("item_id")),
    ],
}


def _holds(rule: Rule) -> Column:
    return F.coalesce(rule.check(), F.lit(False))


def validate(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """Add ``is_valid`` and ``validation_errors`` (message of the first failing rule, else null)."""
    errors = F.coalesce(*[F.when(~_holds(r), F.lit(r.message)) for r in rules])
    return df.withColumn("validation_errors", errors).withColumn("is_valid", F.col("validation_errors").isNull())


def validate_orders(df: DataFrame, profile: str = "full") -> DataFrame:
    return validate(df, ORDER_RULES[profile])


def validate_clicks(df: DataFrame, profile: str = "lake") -> DataFrame:
    return validate(df, CLICK_RULES[profile])


def check_contract(df: DataFrame, contract: str) -> tuple[DataFrame, DataFrame]:
    """Rows that meet the contract, and a quarantine with every violated bound listed."""
    rules = CONTRACTS[contract]
    checked = df.withColumn(
        "violations", F.array_compact(F.array(*[F.when(~_holds(r), F.lit(r.message)) for r in rules])))
    return (
        checked.where(F.size("violations") == 0).drop("violations"),
        checked.where(F.size("violations") > 0),
    )


def with_lineage(df: DataFrame, source: str, run_ts: dt.datetime, version: str = "v1.0") -> DataFrame:
    return df.select(
        "*",
        F.lit(source).alias("source_table"),
        F.lit(run_ts).alias("load_timestamp"),
        F.lit(version).alias("processing_version"),
    )


def with_partition_date(df: DataFrame, ts: str = "event_timestamp", out: str = "partition_date") -> DataFrame:
    """UTC calendar date of the event time."""
    return df.withColumn(out, F.to_date(ts))


def drop_incomplete(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.dropna(subset=cols)
