"""Queries over stored alerts."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window, functions as F

from ..functions import epoch_us, micros, time_bucket
from ..session import materialize
from .fraud import SEVERITY_ORDER


def recent(alerts: DataFrame, limit: int = 20, ts: str = "detected_at") -> DataFrame:
    return alerts.orderBy(F.desc(ts), "alert_type", "event_id").limit(limit)


def by_user(alerts: DataFrame, user_id: str) -> DataFrame:
    return alerts.where(F.col("user_id") == user_id).orderBy(F.desc("detected_at"))


def by_type(alerts: DataFrame, alert_type: str, limit: int = 20) -> DataFrame:
    return recent(alerts.where(F.col("alert_type") == alert_type), limit)


def high_severity(alerts: DataFrame, limit: int = 20) -> DataFrame:
    return recent(alerts.where(F.col("severity").isin("CRITICAL", "HIGH")), limit)


def recent_with_total(alerts: DataFrame, limit: int = 200) -> DataFrame:
    """The newest alerts, each with the number of alerts ever emitted."""
    total = alerts.agg(F.count(F.lit(1)).alias("n")).scalar()
    return recent(alerts, limit).withColumn("total_emitted", total)


def alert_stats(alerts: DataFrame, as_of: dt.datetime, top_users: int = 5, ts: str = "detected_at") -> DataFrame:
    """One long table ``(section, position, label, n)``: total, by type, by severity, top users, last hour, last day.

    Alerts are counted once by user, type and severity, and all sections come from these counts, so
    the rules that produced the alerts run once. Of the users each task keeps its top few.
    """
    age = epoch_us(F.lit(as_of)) - epoch_us(ts)
    counted = materialize(alerts.groupBy("user_id", "alert_type", "severity").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(age < micros("1 hour")).alias("n_hour"), F.count_if(age < micros("1 day")).alias("n_day")), "alert-counts")
    # A total of no alerts is 0, not null.
    counts = [F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("n", "n_hour", "n_day")]
    # Fixed value: severities are listed from most to least severe, unknown ones last.
    severity_rank = F.coalesce(F.nullif(F.array_position(F.lit(SEVERITY_ORDER), F.col("severity")), F.lit(0)),
                               F.lit(len(SEVERITY_ORDER) + 1))
    grouped = counted.groupingSets([[], [F.col("alert_type")], [F.col("severity")]], "alert_type", "severity").agg(
        F.grouping("alert_type").alias("no_type"), F.grouping("severity").alias("no_severity"), *counts)
    line = lambda section, label, n, order: F.struct(
        F.lit(section).alias("section"), label.alias("label"), F.col(n).alias("n"), order.cast("bigint").alias("sort"))
    everything = F.lit("all")
    sections = grouped.select(F.explode(
        F.when(F.col("no_type") == 0, F.array(line("by_type", F.col("alert_type"), "n", -F.col("n"))))
        .when(F.col("no_severity") == 0, F.array(line("by_severity", F.col("severity"), "n", severity_rank)))
        .otherwise(F.array(
            line("total", everything, "n", F.lit(1)), line("last_hour", everything, "n_hour", F.lit(1)),
            line("last_day", everything, "n_day", F.lit(1))))).alias("x")).select("x.*")
    top = (
        counted.where("user_id is not null").groupBy(F.col("user_id").alias("label")).agg(F.sum("n").alias("n"))
        .orderBy(F.desc("n"), "label").limit(top_users)
        .select(F.lit("top_users").alias("section"), "label", "n", (-F.col("n")).alias("sort"))
    )
    # A section has one row per type, severity or top user.
    place = F.row_number().over(Window.partitionBy("section").orderBy("sort", "label"))
    return sections.unionByName(top).select("section", place.alias("position"), "label", "n")


def alert_spikes(alerts: DataFrame, limit: int = 20, window: str = "10 minutes", sustain: str = "5 minutes",
                 ts: str = "detected_at") -> DataFrame:
    """Minutes at which more than ``limit`` alerts fell into the trailing ``window`` and had done so
    at every minute of the ``sustain`` before.

    Alerts are counted per minute first; the trailing counts and the sustained test then spread
    each minute over the few minutes it affects, so no ordering over all time is needed.
    """
    minute = micros("1 minute")
    reach, hold = micros(window) // minute, micros(sustain) // minute
    # The evaluation at minute m sees alerts in (m - window, m].
    per_minute = alerts.groupBy((-time_bucket(-epoch_us(ts), minute)).alias("m")).agg(F.count(F.lit(1)).alias("n"))
    trailing = (
        per_minute.select(F.explode(F.sequence(F.col("m"), F.col("m") + reach - 1)).alias("m"), "n")
        .groupBy("m").agg(F.sum("n").alias("alerts_in_window"))
        .where(F.col("alerts_in_window") > limit)
    )
    held = (
        trailing.select(F.explode(F.sequence(F.col("m"), F.col("m") + hold)).alias("m"))
        .groupBy("m").agg(F.count(F.lit(1)).alias("_held")).where(F.col("_held") == hold + 1)
    )
    return (
        trailing.join(held, "m")
        .select(F.timestamp_micros(F.col("m") * minute).cast("timestamp_ntz").alias("minute"), "alerts_in_window")
    )
