"""Gold marts over orders and clicks: GMV, item performance, funnel, hourly patterns, cohorts."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window, functions as F

from ..functions import ratio
from .ads import ATTRIBUTION_WINDOW, ads_attribution
from .ranking import add_ranks


def daily_gmv(orders: DataFrame, date: dt.date | str | None = None, extended: bool = False) -> DataFrame:
    """Revenue, orders, distinct users and average order value per date.

    Orders are first reduced to (date, user), which makes the user count a plain count. With a
    ``date`` the result is one row even if that day is empty. ``extended`` adds items sold, new
    and returning users and growth over the previous calendar day.
    """
    if date is not None and not extended:
        orders = orders.where(F.col("partition_date") == F.lit(date).cast("date"))
    per_user = orders.groupBy("partition_date", "user_id").agg(
        F.sum("price").alias("value"), F.count("order_id").alias("n"), F.count("price").alias("n_priced"))
    keys = [] if date is not None and not extended else ["partition_date"]
    daily = per_user.groupBy(*keys).agg(
        F.coalesce(F.sum("value"), F.lit(0)).alias("total_revenue"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("order_count"),
        F.count("user_id").alias("unique_users"),
        F.coalesce(F.try_divide(F.sum("value").cast("double"), F.sum("n_priced").cast("double")), F.lit(0.0))
        .alias("avg_order_value"),
    )
    if not extended:
        if keys:
            return daily.withColumnRenamed("partition_date", "date")
        return daily.select(F.lit(date).cast("date").alias("date"), "*")
    arrivals = (
        per_user.where("user_id is not null").groupBy("user_id").agg(F.min("partition_date").alias("partition_date"))
        .groupBy("partition_date").agg(F.count(F.lit(1)).alias("new_users"))
    )
    # One row per calendar day, so this window is bounded by the calendar.
    days = Window.orderBy("date")
    yesterday = F.lag("date").over(days) == F.date_sub("date", 1)
    growth = lambda c: F.when(
        yesterday, F.try_divide((F.col(c) - F.lag(c).over(days)).cast("double") * 100, F.lag(c).over(days).cast("double")))
    out = (
        daily.join(arrivals, "partition_date", "left").withColumnRenamed("partition_date", "date")
        .withColumn("new_users", F.coalesce("new_users", F.lit(0)))
        .withColumn("returning_users", F.col("unique_users") - F.col("new_users"))
        .withColumn("total_items_sold", F.col("order_count"))
        .withColumn("revenue_growth_pct", growth("total_revenue"))
        .withColumn("order_growth_pct", growth("order_count"))
    )
    return out if date is None else out.where(F.col("date") == F.lit(date).cast("date"))


def item_performance(clicks: DataFrame, orders: DataFrame, foods: DataFrame | None = None,
                     window: str = ATTRIBUTION_WINDOW, top_share: float = 0.1,
                     low_conversion: float = 0.5, high_clicks: float = 0.25) -> DataFrame:
    """Item metrics per date with ranks by revenue, orders and conversion.

    A top seller ranks in the first ``top_share`` of the date's items by revenue. An item
    underperforms when it ranks in the first ``high_clicks`` share by clicks but below the first
    ``low_conversion`` share by conversion.
    """
    by = ["date", "item_id"]
    base = ads_attribution(clicks, orders, window, include_unordered=True)
    buyers = (
        orders.groupBy(F.col("partition_date").alias("date"), "item_id", "user_id")
        .agg(F.sum("price").alias("value"), F.count("price").alias("n"))
        .groupBy(*by).agg(F.count("user_id").alias("unique_buyers"),
                          F.try_divide(F.sum("value").cast("double"), F.sum("n").cast("double")).alias("avg_price"))
    )
    items = base.join(buyers, by, "left").withColumn("unique_buyers", F.coalesce("unique_buyers", F.lit(0)))
    ranked = add_ranks(items.where("date is not null and item_id is not null"), ["date"], {
        "total_revenue": "rank_by_revenue", "order_count": "rank_by_orders",
        "conversion_rate": "rank_by_conversion", "click_count": "rank_by_clicks"})
    ranked = (
        ranked.withColumn("is_top_seller", F.col("rank_by_revenue_pct") <= top_share)
        .withColumn("is_underperforming",
                    (F.col("rank_by_clicks_pct") <= high_clicks) & (F.col("rank_by_conversion_pct") > low_conversion))
        .drop("rank_by_revenue_pct", "rank_by_orders_pct", "rank_by_conversion_pct", "rank_by_clicks_pct", "rank_by_clicks")
    )
    if foods is None:
        return ranked
    return ranked.join(foods.select(F.col("food_id").alias("item_id"), "category"), "item_id", "left")


def user_funnel(clicks: DataFrame, orders: DataFrame) -> DataFrame:
    """Sessions, impressions, clicks, orders and the rates between them, per date."""
    seen = clicks.select(
        "partition_date", "user_id", "session_id",
        (F.col("event_type") == "impression").cast("int").alias("i"),
        (F.col("event_type") == "click").cast("int").alias("c"), F.lit(0).alias("o"),
        F.lit(0).cast(orders.schema["price"].dataType).alias("value"))
    bought = orders.select(
        "partition_date", "user_id", "session_id", F.lit(0).alias("i"), F.lit(0).alias("c"), F.lit(1).alias("o"),
        F.coalesce(F.col("price"), F.lit(0)).alias("value"))
    steps = seen.unionByName(bought)
    by_user = (
        steps.groupBy("partition_date", "user_id")
        .agg(F.sum("i").alias("i"), F.sum("c").alias("c"), F.sum("o").alias("o"), F.sum("value").alias("value"))
        .groupBy("partition_date").agg(
            F.sum("i").alias("total_impressions"), F.sum("c").alias("total_clicks"), F.sum("o").alias("total_orders"),
            F.sum("value").alias("revenue"),
            F.count("user_id").alias("active_users"),
            F.count_if((F.col("c") > 0) & F.col("user_id").isNotNull()).alias("users_with_clicks"),
            F.count_if((F.col("o") > 0) & F.col("user_id").isNotNull()).alias("users_with_orders"))
    )
    by_session = (
        steps.where("session_id is not null").groupBy("partition_date", "session_id").agg(F.lit(1).alias("_"))
        .groupBy("partition_date").agg(F.count(F.lit(1)).alias("total_sessions"))
    )
    return (
        by_user.join(by_session, "partition_date", "left")
        .withColumn("total_sessions", F.coalesce("total_sessions", F.lit(0)))
        .withColumn("impression_to_click_rate", ratio("total_clicks", "total_impressions"))
        .withColumn("click_to_order_rate", ratio("total_orders", "total_clicks"))
        .withColumn("session_to_order_rate", ratio("total_orders", "total_sessions"))
        .withColumn("avg_clicks_per_session", ratio("total_clicks", "total_sessions"))
        .withColumn("avg_orders_per_session", ratio("total_orders", "total_sessions"))
        .withColumn("avg_revenue_per_session", ratio("revenue", "total_sessions"))
        .drop("revenue")
        .withColumnRenamed("partition_date", "date")
    )


def hourly_patterns(orders: DataFrame, peak_n: int = 3, ts: str = "event_timestamp") -> DataFrame:
    """Orders per (date, hour) with the hour's rank and share of its day."""
    hourly = (
        orders.groupBy("partition_date", F.hour(ts).alias("hour_of_day"), "user_id")
        .agg(F.count("order_id").alias("n"), F.sum("price").alias("value"))
        .groupBy("partition_date", "hour_of_day").agg(
            F.sum("n").alias("order_count"), F.coalesce(F.sum("value"), F.lit(0)).alias("total_revenue"),
            F.count("user_id").alias("unique_users"))
    )
    day = Window.partitionBy("partition_date")
    return (
        hourly.withColumn("avg_order_value", ratio("total_revenue", "order_count"))
        .withColumn("peak_rank", F.rank().over(day.orderBy(F.desc("order_count"))))
        .withColumn("is_peak_hour", F.col("peak_rank") <= peak_n)
        .withColumn("pct_of_daily_orders", ratio("order_count", F.sum("order_count").over(day)) * 100)
        .withColumn("pct_of_daily_revenue", ratio("total_revenue", F.sum("total_revenue").over(day)) * 100)
        .withColumnRenamed("partition_date", "date")
    )


def user_cohorts(orders: DataFrame, as_of: dt.date, vip_share: float = 0.1, new_days: int = 7,
                 active_days: int = 30, at_risk_days: int = 60) -> DataFrame:
    """Lifetime metrics, recency and segment of every user as of a date.

    The mean gap between consecutive orders telescopes to (last - first) / (orders - 1), so no
    per-user ordering is needed. VIPs are the first ``vip_share`` by lifetime revenue.
    """
    today = F.lit(as_of).cast("date")
    this_period = F.date_trunc("month", F.col("partition_date")) == F.date_trunc("month", today)
    users = (
        orders.where((F.col("partition_date") <= today) & F.col("user_id").isNotNull())
        .groupBy("user_id").agg(
            F.min("partition_date").alias("first_order_date"), F.max("partition_date").alias("_last"),
            F.count("order_id").alias("lifetime_orders"),
            F.coalesce(F.sum("price"), F.lit(0)).alias("lifetime_revenue"),
            F.count_if(this_period).alias("orders_this_period"),
            F.coalesce(F.sum(F.when(this_period, F.col("price"))), F.lit(0)).alias("revenue_this_period"))
        .withColumn("lifetime_items", F.col("lifetime_orders"))
        .withColumn("cohort_month", F.date_format("first_order_date", "yyyy-MM"))
        .withColumn("days_since_first_order", F.datediff(today, "first_order_date"))
        .withColumn("days_since_last_order", F.datediff(today, "_last"))
        .withColumn("avg_days_between_orders", F.when(
            F.col("lifetime_orders") > 1,
            F.datediff("_last", "first_order_date") / (F.col("lifetime_orders") - 1)))
    )
    ranked = add_ranks(users, [], {"lifetime_revenue": "_rank"})
    segment = (
        F.when(F.col("is_vip"), "vip")
        .when(F.col("days_since_first_order") <= new_days, "new")
        .when(F.col("days_since_last_order") <= active_days, "active")
        .when(F.col("days_since_last_order") <= at_risk_days, "at_risk")
        .otherwise("churned")
    )
    return (
        ranked.withColumn("is_vip", F.col("_rank_pct") <= vip_share)
        .withColumn("user_segment", segment)
        .withColumn("date", today)
        .drop("_last", "_rank", "_rank_pct")
    )
