"""Hourly delivery ETL: JSONL bronze to silver to KPI gold, in one pass over the hour."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from ..operators.dedup import dedup_latest
from ..operators.delivery import delivery_kpis, flatten_delivery, hourly_summary, quality_flags
from ..sources.files import HOUR_KEYS, read_bronze
from ..sources.tables import empty_partitions, replace_partition


def to_silver(bronze: DataFrame, run_ts: dt.datetime) -> DataFrame:
    keys = [k for k in HOUR_KEYS if k in bronze.columns]
    latest = dedup_latest(bronze.drop(*keys), ["event_id"], ["ingestion_time"])
    return quality_flags(flatten_delivery(latest)).withColumn("processed_at", F.lit(run_ts))


def run(spark: SparkSession, base: str, hour: dt.datetime, run_ts: dt.datetime) -> dict[str, int]:
    """Process one hour. A repeated run replaces its own output; if the hour's bronze is missing or empty, with nothing.

    Row counts come from observations of the write itself, not from extra jobs. Gold reads the
    silver files just written, so bronze is parsed once.
    """
    bronze = read_bronze(spark, base, hour, missing="empty")
    seen, kept = Observation(), Observation()
    bronze = bronze.observe(seen, F.count(F.lit(1)).alias("rows"))
    silver = to_silver(bronze, run_ts).observe(
        kept, F.count(F.lit(1)).alias("rows"), F.count_if("is_valid_delivery_time").alias("valid"))
    stamp = {"year": hour.year, "month": f"{hour.month:02d}", "day": f"{hour.day:02d}", "hour": f"{hour.hour:02d}"}
    stamped = silver.select("*", *[F.lit(v).alias(k) for k, v in stamp.items()])
    metrics, summary, here = f"{base}/gold/delivery_metrics", f"{base}/gold/hourly_summary", [stamp]
    replace_partition(stamped, f"{base}/silver", HOUR_KEYS, here, folders=1)
    counts = {"bronze_rows": seen.get["rows"], "silver_rows": kept.get["rows"], "valid_rows": kept.get["valid"]}
    counts["duplicates"] = counts["bronze_rows"] - counts["silver_rows"]
    if counts["silver_rows"] == 0:
        empty_partitions(spark, metrics, HOUR_KEYS, here)
        empty_partitions(spark, summary, HOUR_KEYS, here)
        return counts
    path = f"{base}/silver/" + "/".join(f"{k}={v}" for k, v in stamp.items())
    hour_rows = spark.read.schema(silver.schema).parquet(path)
    at = [F.lit(v).alias(k) for k, v in stamp.items()]
    # The hour is named, so that a kind of metric that no longer occurs goes too.
    replace_partition(delivery_kpis(hour_rows).select("*", *at), metrics, [*HOUR_KEYS, "metric_type"], here)
    replace_partition(hourly_summary(hour_rows).select("*", *at), summary, HOUR_KEYS, here)
    return counts
