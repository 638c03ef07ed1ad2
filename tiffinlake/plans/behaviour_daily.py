"""Daily behaviour ETL: bronze orders and clicks to silver, then GMV and ads attribution."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from ..operators.ads import ads_attribution
from ..operators.aggregates import partition_dates
from ..operators.dedup import dedup_latest, flag_duplicates
from ..operators.marts import daily_gmv, hourly_patterns, user_funnel
from ..operators.validation import validate_clicks, validate_orders, with_lineage
from ..sources.tables import read_table, replace_partition

_LIVE = "is_valid and not is_duplicate"


def _silver(rows: DataFrame, validate, profile: str, key: str, source: str, run_ts: dt.datetime, duplicates: str) -> DataFrame:
    from pyspark.sql import functions as F

    if duplicates == "drop":
        unique = dedup_latest(rows, ["ingestion_id"], ["event_timestamp"]).withColumn("is_duplicate", F.lit(False))
    elif duplicates == "flag":
        unique = flag_duplicates(
            rows.where(F.col(key).isNotNull() & F.col("event_timestamp").isNotNull()), [key], ["event_timestamp"])
    else:
        raise ValueError(f"unknown duplicate policy {duplicates!r}")
    return with_lineage(validate(unique, profile), source, run_ts)


def silver_orders(bronze: DataFrame, run_ts: dt.datetime, profile: str = "full", duplicates: str = "drop") -> DataFrame:
    return _silver(bronze, validate_orders, profile, "order_id", "bronze_orders", run_ts, duplicates)


def silver_clicks(bronze: DataFrame, run_ts: dt.datetime, profile: str = "lake", duplicates: str = "drop") -> DataFrame:
    return _silver(bronze, validate_clicks, profile, "event_id", "bronze_clicks", run_ts, duplicates)


def run(spark: SparkSession, base: str, date: dt.date, run_ts: dt.datetime, window: str = "30 minutes",
        duplicates: str = "drop") -> None:
    """One day, idempotently: every table's partition of that day is replaced, by nothing if there is nothing left."""
    day = ["partition_date"]
    here, gold = [{"partition_date": date}], [{"date": date}]
    replace_partition(
        silver_orders(read_table(spark, f"{base}/bronze/orders", date), run_ts, duplicates=duplicates), f"{base}/silver/orders", day, here)
    replace_partition(
        silver_clicks(read_table(spark, f"{base}/bronze/clicks", date), run_ts, duplicates=duplicates), f"{base}/silver/clicks", day, here)
    orders = read_table(spark, f"{base}/silver/orders", date).where(_LIVE)
    clicks = read_table(spark, f"{base}/silver/clicks", date).where(_LIVE)
    replace_partition(daily_gmv(orders, date), f"{base}/gold/daily_gmv", ["date"], gold)
    replace_partition(ads_attribution(clicks, orders, window, date), f"{base}/gold/ads_attribution", ["date"], gold)
    replace_partition(hourly_patterns(orders), f"{base}/gold/hourly_patterns", ["date"], gold)
    replace_partition(user_funnel(clicks, orders), f"{base}/gold/user_funnel", ["date"], gold)


def bronze_dates(spark: SparkSession, base: str) -> DataFrame:
    """The days a backfill has to run."""
    return partition_dates(read_table(spark, f"{base}/bronze/orders"), read_table(spark, f"{base}/bronze/clicks"))
