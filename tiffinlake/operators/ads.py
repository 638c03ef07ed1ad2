"""Ad engagement, click-to-order attribution, reconciliation and serving metrics.

Clicks carry ``event_id, user_id, item_id, event_type, event_timestamp, partition_date``; orders
carry ``order_id, user_id, item_id, item_name, price, event_timestamp, partition_date``.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import epoch_us, micros, ratio, time_bucket
from .intervals import has_prior, interval_totals

ATTRIBUTION_WINDOW = "30 minutes"
COUNTER_TTL = "25 hours"

COUNTERS = ["impressions", "clicks", "orders", "attributed_orders", "revenue"]

_TS = "event_timestamp"


def _is(kind: str) -> Column:
    return F.col("event_type") == kind


def _credited(clicks: DataFrame, include_impressions: bool) -> DataFrame:
    return clicks if include_impressions else clicks.where(_is("click"))


def attributed_orders(
    orders: DataFrame, clicks: DataFrame, window: str = ATTRIBUTION_WINDOW,
    include_impressions: bool = False, same_day: bool = False, flag: str = "attributed",
) -> DataFrame:
    """Orders plus a flag: did the user click the item in the ``window`` up to the order?

    ``same_day`` also requires click and order to lie in one partition date, as daily jobs that
    read a single date see it.
    """
    keys = ["user_id", "item_id"] + (["partition_date"] if same_day else [])
    return has_prior(orders, _credited(clicks, include_impressions), keys, _TS, _TS, window, flag=flag)


def item_engagement(clicks: DataFrame, by: list[str]) -> DataFrame:
    """Impressions and clicks per group, in one aggregate."""
    return clicks.groupBy(*by).agg(
        F.count_if(_is("impression")).alias("impression_count"),
        F.count_if(_is("click")).alias("click_count"),
    )


def item_orders(orders: DataFrame, by: list[str]) -> DataFrame:
    """Orders, revenue and the latest item name per group."""
    return orders.groupBy(*by).agg(
        F.max_by("item_name", F.struct(_TS, "order_id")).alias("item_name"),
        F.count("order_id").alias("order_count"),
        F.coalesce(F.sum("price"), F.lit(0)).alias("total_revenue"),
    )


def attribution_by_item(orders: DataFrame, clicks: DataFrame, by: list[str], window: str = ATTRIBUTION_WINDOW,
                        include_impressions: bool = False, same_day: bool = True) -> DataFrame:
    """Distinct attributed orders and their revenue per group; an order counts once however many clicks match."""
    hits = attributed_orders(orders, clicks, window, include_impressions, same_day).where("attributed")
    return (
        hits.groupBy(*by, "order_id").agg(F.max("price").alias("price"))
        .groupBy(*by).agg(
            F.count("order_id").alias("attributed_order_count"),
            F.coalesce(F.sum("price"), F.lit(0)).alias("attributed_revenue"),
        )
    )


def ads_attribution(
    clicks: DataFrame, orders: DataFrame, window: str = ATTRIBUTION_WINDOW, date: dt.date | str | None = None,
    include_impressions: bool = False, include_unordered: bool = False, same_day: bool = True,
) -> DataFrame:
    """Per (date, item): impressions, clicks, orders, attribution, CTR, conversion and revenue.

    Items with orders only by default; ``include_unordered`` also keeps items that were only shown
    or clicked. The three sides are each reduced to (date, item) before they meet.
    """
    if date is not None:
        clicks = clicks.where(F.col("partition_date") == F.lit(date).cast("date"))
        orders = orders.where(F.col("partition_date") == F.lit(date).cast("date"))
    by = ["partition_date", "item_id"]
    sold = item_orders(orders, by)
    shown = item_engagement(clicks, by)
    credited = attribution_by_item(orders, clicks, by, window, include_impressions, same_day)
    joined = sold.join(shown, by, "full" if include_unordered else "left").join(credited, by, "left")
    counts = ["impression_count", "click_count", "order_count", "attributed_order_count",
              "total_revenue", "attributed_revenue"]
    return (
        joined.select(*by, "item_name", *[F.coalesce(F.col(c), F.lit(0)).alias(c) for c in counts])
        .withColumn("ctr", ratio("click_count", "impression_count"))
        .withColumn("conversion_rate", ratio("attributed_order_count", "click_count"))
        .withColumnRenamed("partition_date", "date")
    )


def _scoped(df: DataFrame, start: dt.datetime | None, end: dt.datetime | None) -> DataFrame:
    if start is not None:
        df = df.where(F.col(_TS) >= F.lit(start))
    if end is not None:
        df = df.where(F.col(_TS) < F.lit(end))
    return df


def _hour(ts: str = _TS) -> Column:
    return F.date_trunc("hour", F.col(ts)).alias("date_hour")


def recon_hourly(
    clicks: DataFrame, orders: DataFrame, start: dt.datetime | None = None, end: dt.datetime | None = None,
    window: str = ATTRIBUTION_WINDOW, mode: str = "exact",
) -> DataFrame:
    """Recomputed totals per (hour, item) from the raw tables.

    ``exact`` counts every click and order once, each in its own hour. ``compat`` reproduces the
    totals of a full outer click-order join: a row counts once per match, matched orders fall into
    the hour of the click, and only hours the join produces are kept. Both come from per-click
    match totals; the join itself is never formed.
    """
    orders = _scoped(orders, start, end)
    if mode == "exact":
        # An order in the first minutes may owe its credit to a click before the start.
        since = start - dt.timedelta(microseconds=micros(window)) if start is not None else None
        return _recon_exact(_scoped(clicks, start, end), _scoped(clicks, since, end), orders, window)
    clicks = _scoped(clicks, start, end)
    if mode == "compat":
        return _recon_compat(clicks, orders, window)
    raise ValueError(f"unknown mode {mode!r}")


def _recon_exact(clicks: DataFrame, earlier_too: DataFrame, orders: DataFrame, window: str) -> DataFrame:
    zero = F.lit(0).cast("bigint")
    money = F.lit(0).cast(orders.schema["price"].dataType)
    shown = clicks.where("item_id is not null").groupBy(_hour(), "item_id").agg(
        F.count_if(_is("impression")).alias("impressions"), F.count_if(_is("click")).alias("clicks"))
    sold = (
        attributed_orders(orders.where("item_id is not null"), earlier_too, window)
        .groupBy(_hour(), "item_id", "order_id")
        .agg(F.max("price").alias("price"), F.max(F.col("attributed").cast("int")).alias("attributed"))
        .groupBy("date_hour", "item_id")
        .agg(F.count("order_id").alias("orders"), F.sum("attributed").alias("attributed_orders"),
             F.coalesce(F.sum("price"), F.lit(0)).alias("revenue"))
    )
    return (
        shown.select("date_hour", "item_id", "impressions", "clicks", zero.alias("orders"),
                     zero.alias("attributed_orders"), money.alias("revenue"))
        .unionByName(sold.select("date_hour", "item_id", zero.alias("impressions"), zero.alias("clicks"),
                                 "orders", "attributed_orders", "revenue"))
        .groupBy("date_hour", "item_id").agg(*[F.sum(c).alias(c) for c in COUNTERS])
    )


def _recon_compat(clicks: DataFrame, orders: DataFrame, window: str) -> DataFrame:
    w = micros(window)
    pair = ["user_id", "item_id"]
    keyed = clicks.withColumn("at_us", epoch_us(_TS))
    matches = interval_totals(
        clicks, orders, pair, _TS, _TS, window,
        {"n": F.lit(1), "value": F.coalesce(F.col("price"), F.lit(0))}, lag_us=w)
    at_click = (
        keyed.where("item_id is not null")
        .groupBy(*pair, _TS, "at_us").agg(
            F.count_if(_is("impression")).alias("i"), F.count_if(_is("click")).alias("c"),
            F.count(F.lit(1)).alias("rows"))
    )
    # Null users match nothing, hence the outer join.
    weighted = at_click.join(matches, [*pair, "at_us"], "left")
    fan = F.greatest(F.coalesce(F.col("n"), F.lit(0)), F.lit(1))
    money = F.coalesce(F.col("value"), F.lit(0))
    from_clicks = weighted.groupBy(_hour(), "item_id").agg(
        F.sum(F.col("i") * fan).alias("impressions"),
        F.sum(F.col("c") * fan).alias("clicks"),
        F.sum(F.col("rows") * money).alias("revenue"),
    )
    # Which hours hold a click that matches an order: the order's own hour and those the window reaches back to.
    hour_us = micros("1 hour")
    reach = -(-w // hour_us)
    by_hour = clicks.withColumn("_h", time_bucket(epoch_us(_TS), hour_us))
    spread = orders.withColumn("_h", F.explode(F.array(*[
        time_bucket(epoch_us(_TS), hour_us) - i for i in range(reach + 1)])))
    in_click_hour = (
        has_prior(spread, by_hour, [*pair, "_h"], _TS, _TS, window).where("matched")
        .select(F.timestamp_micros(F.col("_h") * hour_us).cast(orders.schema[_TS].dataType).alias("date_hour"),
                "item_id", "order_id")
    )
    alone = has_prior(orders, clicks, pair, _TS, _TS, window).where("not matched and item_id is not null")
    order_hours = in_click_hour.unionByName(alone.select(_hour(), "item_id", "order_id"))
    from_orders = (
        order_hours.groupBy("date_hour", "item_id", "order_id").agg(F.lit(1).alias("_"))
        .groupBy("date_hour", "item_id").agg(F.count("order_id").alias("orders"))
    )
    alone_value = alone.groupBy(_hour(), "item_id").agg(F.sum(F.coalesce(F.col("price"), F.lit(0))).alias("revenue"))
    credited = (
        attributed_orders(orders, clicks, window).where("attributed")
        .groupBy(_hour(), "item_id", "order_id").agg(F.lit(1).alias("_"))
        .groupBy("date_hour", "item_id").agg(F.count("order_id").alias("attributed_orders"))
    )
    present = F.lit(1).alias("_seen")
    merged = (
        from_clicks.select("*", present)
        .unionByName(from_orders.select("*", present), allowMissingColumns=True)
        .unionByName(alone_value.select("*", present), allowMissingColumns=True)
        .unionByName(credited, allowMissingColumns=True)
    )
    return (
        merged.groupBy("date_hour", "item_id")
        .agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in COUNTERS], F.max("_seen").alias("_seen"))
        .where("_seen = 1").drop("_seen")
    )


def daily_truth(hourly: DataFrame, compat: bool = False) -> DataFrame:
    """Hourly totals to (item, date): summed, or the day's largest hour with ``compat``."""
    fold = F.max if compat else F.sum
    return hourly.groupBy("item_id", F.to_date("date_hour").alias("date")).agg(*[fold(c).alias(c) for c in COUNTERS])


def reconcile(counters: DataFrame, truth: DataFrame, metrics: list[str] | None = None) -> DataFrame:
    """Overwrite-if-greater per (item, date) and metric, with the number of metrics that changed."""
    metrics = metrics or COUNTERS
    c, t = counters.alias("c"), truth.alias("t")
    old = {m: F.coalesce(F.col(f"c.{m}"), F.lit(0)) for m in metrics}
    new = {m: F.coalesce(F.col(f"t.{m}"), F.lit(0)) for m in metrics}
    changed = [(new[m] > old[m]).cast("int") for m in metrics]
    total = changed[0]
    for x in changed[1:]:
        total = total + x
    return c.join(t, ["item_id", "date"], "full").select(
        "item_id", "date", *[F.greatest(old[m], new[m]).alias(m) for m in metrics], total.alias("updated_keys"))


def item_day_counters(clicks: DataFrame, orders: DataFrame, window: str = ATTRIBUTION_WINDOW,
                      include_impressions: bool = False) -> DataFrame:
    """Counters per (item, UTC day of the event): impressions, clicks, orders, attributed orders, revenue.

    Every click-stream row that is not an impression counts as a click.
    """
    zero = F.lit(0).cast("bigint")
    day = F.to_date(_TS).alias("date")
    money = F.lit(0).cast(orders.schema["price"].dataType)
    shown = clicks.where("item_id is not null").groupBy("item_id", day).agg(
        F.count_if(_is("impression")).alias("impressions"),
        F.count_if(~_is("impression")).alias("clicks"))
    sold = (
        attributed_orders(orders.where("item_id is not null"), clicks, window, include_impressions)
        .groupBy("item_id", day).agg(
            F.count(F.lit(1)).alias("orders"), F.count_if("attributed").alias("attributed_orders"),
            F.coalesce(F.sum("price"), F.lit(0)).alias("revenue"))
    )
    return (
        shown.select("item_id", "date", "impressions", "clicks", zero.alias("orders"),
                     zero.alias("attributed_orders"), money.alias("revenue"))
        .unionByName(sold.select("item_id", "date", zero.alias("impressions"), zero.alias("clicks"),
                                 "orders", "attributed_orders", "revenue"))
        .groupBy("item_id", "date").agg(*[F.sum(c).alias(c) for c in COUNTERS])
    )


def ad_metrics(counters: DataFrame) -> DataFrame:
    """Counters plus click-through and conversion rates to 4 digits."""
    return (
        counters.withColumn("ctr", F.round(ratio("clicks", "impressions"), 4))
        .withColumn("cvr", F.round(ratio("attributed_orders", "clicks"), 4))
    )


def attributed_feed(orders: DataFrame, clicks: DataFrame, window: str = ATTRIBUTION_WINDOW) -> DataFrame:
    """Attributed orders as feed records keyed by user."""
    hits = attributed_orders(orders, clicks, window).where("attributed")
    return hits.select(
        F.col("user_id").cast("string").alias("key"), "order_id", "user_id", "item_id", "price", _TS)


def billing_feed(counters: DataFrame) -> DataFrame:
    """Counter values as one record per (item, date, metric) with a non-zero amount."""
    return (
        counters.select("item_id", "date", *[F.col(m).cast("double").alias(m) for m in COUNTERS])
        .unpivot(["item_id", "date"], COUNTERS, "metric", "amount").where("amount <> 0")
    )


def recon_feed(counters: DataFrame, truth: DataFrame) -> DataFrame:
    """Records for the counters that reconciliation raised, with old and new value."""
    def long(df: DataFrame, value: str) -> DataFrame:
        return df.select("item_id", "date", *[F.col(m).cast("double").alias(m) for m in COUNTERS]).unpivot(
            ["item_id", "date"], COUNTERS, "metric", value)

    return (
        long(truth, "new_value").join(long(counters, "old_value"), ["item_id", "date", "metric"], "left")
        .withColumn("old_value", F.coalesce("old_value", F.lit(0.0)))
        .where(F.col("new_value") > F.col("old_value"))
    )


def expire(df: DataFrame, last_update: str, as_of: dt.datetime, ttl: str) -> DataFrame:
    """Rows still alive at ``as_of``: updated less than ``ttl`` ago."""
    return df.where(epoch_us(last_update) + micros(ttl) > epoch_us(F.lit(as_of)))
