"""Reconciliation: recompute closed hours from bronze, store them, and raise counters that lag."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import closed_hours, micros
from ..operators.ads import ATTRIBUTION_WINDOW, COUNTERS, daily_truth, recon_hourly, reconcile
from ..session import materialize
from ..sources.files import path_exists
from ..sources.tables import merge_upsert, read_table


def run(spark: SparkSession, base: str, as_of: dt.datetime, hours: int = 24, window: str = ATTRIBUTION_WINDOW,
        mode: str = "exact") -> DataFrame:
    """Upsert the hourly totals and the item-day counters; returns the counters that changed.

    Only bronze days that the closed hours touch are read, for clicks also one attribution window before.
    """
    start, end = closed_hours(as_of, hours)
    days = F.col("partition_date").between(F.lit(start.date()), F.lit(end.date()))
    since = start - dt.timedelta(microseconds=micros(window))
    clicks = read_table(spark, f"{base}/bronze/clicks").where(F.col("partition_date").between(F.lit(since.date()), F.lit(end.date())))
    orders = read_table(spark, f"{base}/bronze/orders").where(days)
    hourly = materialize(
        recon_hourly(clicks, orders, start, end, window, mode).withColumn("date", F.to_date("date_hour")), "recon")
    hourly_path = f"{base}/recon/hourly_totals"
    merge_upsert(hourly, hourly_path, ["date", "date_hour", "item_id"], ["date"])
    # A day's truth is all its stored hours, not only those recomputed now.
    touched = F.col("date").between(F.lit(start.date()), F.lit(end.date()))
    truth = daily_truth(read_table(spark, hourly_path).where(touched), compat=mode == "compat")
    counters_path = f"{base}/serving/counters"
    if path_exists(spark, counters_path):
        counters = read_table(spark, counters_path).select("item_id", "date", *COUNTERS)
    else:
        counters = spark.createDataFrame([], truth.schema)
    changed = materialize(reconcile(counters, truth).where("updated_keys > 0"), "reconciled")
    merge_upsert(changed.drop("updated_keys"), counters_path, ["date", "item_id"], ["date"])
    return changed
