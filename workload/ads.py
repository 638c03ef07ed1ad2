"""GMV, attribution, reconciliation, counters and gold marts."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tiffinlake.operators import ads, intervals, marts
from tiffinlake.functions import closed_hours, from_epoch_us

from .registry import query
from .views import (
    FOODS_SQL, SHOP_SQL, bronze_clicks, bronze_orders, events_sql, foods, good_clicks, good_orders, shop_orders,
)

# Wide enough for matches at every scale of the given tables.
DAY = "1 day"

_GMV = """coalesce(sum(price), 0)::DOUBLE AS total_revenue, count(order_id) AS order_count, count(DISTINCT user_id) AS unique_users,
  round(coalesce(sum(price)::DOUBLE / count(price), 0), 6) AS avg_order_value"""


def _gmv(df):
    return df.withColumn("avg_order_value", F.round("avg_order_value", 6))


@query("daily_gmv", events_sql(f"SELECT partition_date::VARCHAR AS date, {_GMV} FROM good_orders GROUP BY 1"))
def daily_gmv(spark, sf):
    return _gmv(marts.daily_gmv(good_orders(spark, sf)))


@query("daily_gmv_one_day", events_sql(
    f"SELECT '2024-01-15' AS date, {_GMV} FROM good_orders WHERE partition_date = DATE '2024-01-15'"))
def daily_gmv_one_day(spark, sf):
    return _gmv(marts.daily_gmv(good_orders(spark, sf), "2024-01-15"))


@query("daily_gmv_empty_day", events_sql(
    f"SELECT '2031-01-01' AS date, {_GMV} FROM good_orders WHERE partition_date = DATE '2031-01-01'"))
def daily_gmv_empty_day(spark, sf):
    return _gmv(marts.daily_gmv(good_orders(spark, sf), "2031-01-01"))


@query("daily_gmv_extended", f"""
WITH {SHOP_SQL.strip()},
daily AS (SELECT partition_date, {_GMV} FROM shop GROUP BY 1),
arrivals AS (SELECT first_date, count(*) AS new_users FROM (SELECT user_id, min(partition_date) AS first_date FROM shop GROUP BY 1) GROUP BY 1)
SELECT partition_date::VARCHAR AS date, total_revenue, order_count, unique_users, avg_order_value, coalesce(new_users, 0) AS new_users,
  unique_users - coalesce(new_users, 0) AS returning_users, order_count AS total_items_sold,
  round(CASE WHEN p = partition_date - 1 THEN (total_revenue - pr) * 100 / pr END, 4) AS revenue_growth_pct,
  round(CASE WHEN p = partition_date - 1 THEN (order_count - po) * 100.0::DOUBLE / po END, 4) AS order_growth_pct
FROM (SELECT *, lag(partition_date) OVER w AS p, lag(total_revenue) OVER w AS pr, lag(order_count) OVER w AS po
      FROM daily WINDOW w AS (ORDER BY partition_date)) d
LEFT JOIN arrivals ON first_date = partition_date""")
def daily_gmv_extended(spark, sf):
    out = _gmv(marts.daily_gmv(shop_orders(spark, sf), extended=True))
    return out.withColumns({c: F.round(c, 4) for c in ("revenue_growth_pct", "order_growth_pct")})


def _attributed_sql(kind: str, same_day: bool, window: str = "1 day") -> str:
    kinds = "c.event_type = 'click'" if kind == "click" else "TRUE"
    day = "AND c.partition_date = o.partition_date" if same_day else ""
    return f"""EXISTS (SELECT 1 FROM good_clicks c WHERE c.user_id = o.user_id AND c.item_id = o.item_id AND {kinds} {day}
      AND c.event_timestamp <= o.event_timestamp AND c.event_timestamp >= o.event_timestamp - INTERVAL '{window}')"""


@query("attributed_orders", events_sql(
    f"SELECT order_id, user_id, item_id, {_attributed_sql('click', False)} AS attributed FROM good_orders o"))
def attributed_orders(spark, sf):
    return ads.attributed_orders(good_orders(spark, sf), good_clicks(spark, sf), DAY).select(
        "order_id", "user_id", "item_id", "attributed")


@query("attributed_orders_impressions", events_sql(
    f"SELECT order_id, {_attributed_sql('any', False)} AS attributed FROM good_orders o"))
def attributed_orders_impressions(spark, sf):
    return ads.attributed_orders(
        good_orders(spark, sf), good_clicks(spark, sf), DAY, include_impressions=True).select("order_id", "attributed")


@query("attributed_orders_30min", events_sql(
    f"SELECT order_id, {_attributed_sql('any', False, '30 minutes')} AS attributed FROM good_orders o"))
def attributed_orders_30min(spark, sf):
    return ads.attributed_orders(
        good_orders(spark, sf), good_clicks(spark, sf), include_impressions=True).select("order_id", "attributed")


_PAIR = """c.user_id = o.user_id AND c.item_id = o.item_id AND o.event_timestamp >= c.event_timestamp
  AND o.event_timestamp <= c.event_timestamp + INTERVAL 1 DAY"""


def _sides(spark, sf):
    clicks = good_clicks(spark, sf).where("event_type = 'click'").select(
        "user_id", "item_id", F.col("event_id").alias("click_id"), F.col("event_timestamp").alias("clicked_at"))
    orders = good_orders(spark, sf).select("user_id", "item_id", "order_id", "price", F.col("event_timestamp").alias("ordered_at"))
    return clicks, orders


@query("interval_join_inner", events_sql(f"""
SELECT c.user_id, c.item_id, c.event_id AS click_id, o.order_id FROM good_clicks c JOIN good_orders o ON {_PAIR} WHERE c.event_type = 'click'"""))
def interval_join_inner(spark, sf):
    clicks, orders = _sides(spark, sf)
    return intervals.interval_join(clicks, orders, ["user_id", "item_id"], "clicked_at", "ordered_at", DAY).select(
        "user_id", "item_id", "click_id", "order_id")


@query("interval_join_full", events_sql(f"""
SELECT coalesce(c.user_id, o.user_id) AS user_id, coalesce(c.item_id, o.item_id) AS item_id, c.event_id AS click_id, o.order_id
FROM (SELECT * FROM good_clicks WHERE event_type = 'click') c FULL JOIN good_orders o ON {_PAIR}"""))
def interval_join_full(spark, sf):
    clicks, orders = _sides(spark, sf)
    return intervals.interval_join(clicks, orders, ["user_id", "item_id"], "clicked_at", "ordered_at", DAY, "full").select(
        "user_id", "item_id", "click_id", "order_id")


@query("interval_totals", events_sql(f"""
SELECT c.user_id, c.item_id, c.event_timestamp AS clicked_at, count(o.order_id) AS orders_after, coalesce(sum(o.price), 0)::DOUBLE AS revenue_after
FROM (SELECT DISTINCT user_id, item_id, event_timestamp FROM good_clicks WHERE event_type = 'click') c
LEFT JOIN good_orders o ON {_PAIR} GROUP BY 1, 2, 3"""))
def interval_totals(spark, sf):
    clicks, orders = _sides(spark, sf)
    day_us = 86_400_000_000
    out = intervals.interval_totals(
        clicks, orders, ["user_id", "item_id"], "clicked_at", "ordered_at", DAY,
        {"orders_after": F.lit(1), "revenue_after": F.col("price")}, lag_us=day_us)
    return out.select("user_id", "item_id", from_epoch_us("at_us").alias("clicked_at"),
                      F.coalesce("orders_after", F.lit(0)).alias("orders_after"),
                      F.coalesce("revenue_after", F.lit(0)).alias("revenue_after"))


@query("item_engagement", events_sql("""
SELECT partition_date::VARCHAR AS partition_date, item_id, count(*) FILTER (WHERE event_type = 'impression') AS impression_count,
  count(*) FILTER (WHERE event_type = 'click') AS click_count FROM good_clicks GROUP BY ALL"""))
def item_engagement(spark, sf):
    return ads.item_engagement(good_clicks(spark, sf), ["partition_date", "item_id"])


@query("item_orders", events_sql("""
SELECT item_id, arg_max(item_name, event_timestamp) AS item_name, count(order_id) AS order_count, sum(price)::DOUBLE AS total_revenue
FROM good_orders GROUP BY 1"""))
def item_orders(spark, sf):
    return ads.item_orders(good_orders(spark, sf), ["item_id"])


@query("attribution_by_item", events_sql(f"""
SELECT item_id, count(DISTINCT order_id) AS attributed_order_count, sum(price)::DOUBLE AS attributed_revenue
FROM good_orders o WHERE {_attributed_sql('click', False)} GROUP BY 1"""))
def attribution_by_item(spark, sf):
    return ads.attribution_by_item(good_orders(spark, sf), good_clicks(spark, sf), ["item_id"], DAY, same_day=False)


_ADS_CTES = f"""
shown AS (SELECT partition_date, item_id, count(*) FILTER (WHERE event_type = 'impression') AS impression_count,
  count(*) FILTER (WHERE event_type = 'click') AS click_count FROM good_clicks GROUP BY ALL),
sold AS (SELECT partition_date, item_id, arg_max(item_name, event_timestamp) AS item_name, count(order_id) AS order_count,
  sum(price) AS total_revenue, count(DISTINCT user_id) AS unique_buyers, sum(price)::DOUBLE / count(price) AS avg_price
  FROM good_orders GROUP BY ALL),
hits AS (SELECT partition_date, item_id, count(DISTINCT order_id) AS attributed_order_count, sum(price) AS attributed_revenue
  FROM good_orders o WHERE {_attributed_sql('click', True)} GROUP BY ALL),
gold AS (
  SELECT coalesce(sold.partition_date, shown.partition_date) AS date, coalesce(sold.item_id, shown.item_id) AS item_id, item_name,
    coalesce(impression_count, 0) AS impression_count, coalesce(click_count, 0) AS click_count, coalesce(order_count, 0) AS order_count,
    coalesce(attributed_order_count, 0) AS attributed_order_count, coalesce(total_revenue, 0)::DOUBLE AS total_revenue,
    coalesce(attributed_revenue, 0)::DOUBLE AS attributed_revenue,
    CASE WHEN impression_count > 0 THEN coalesce(click_count, 0) / impression_count::DOUBLE ELSE 0 END AS ctr,
    CASE WHEN click_count > 0 THEN coalesce(attributed_order_count, 0) / click_count::DOUBLE ELSE 0 END AS conversion_rate,
    coalesce(unique_buyers, 0) AS unique_buyers, avg_price, sold.item_id IS NOT NULL AS ordered
  FROM sold FULL JOIN shown ON sold.partition_date = shown.partition_date AND sold.item_id = shown.item_id
  LEFT JOIN hits ON hits.partition_date = sold.partition_date AND hits.item_id = sold.item_id)
"""
_ADS_COLS = """date::VARCHAR AS date, item_id, item_name, impression_count, click_count, order_count, attributed_order_count,
  total_revenue, attributed_revenue, round(ctr, 6) AS ctr, round(conversion_rate, 6) AS conversion_rate"""


def _rates(df):
    return df.withColumns({"ctr": F.round("ctr", 6), "conversion_rate": F.round("conversion_rate", 6)})


@query("ads_attribution", events_sql(f"SELECT {_ADS_COLS} FROM gold WHERE ordered", _ADS_CTES.strip()))
def ads_attribution(spark, sf):
    return _rates(ads.ads_attribution(good_clicks(spark, sf), good_orders(spark, sf), DAY))


@query("ads_attribution_all_items", events_sql(f"SELECT {_ADS_COLS} FROM gold", _ADS_CTES.strip()))
def ads_attribution_all_items(spark, sf):
    return _rates(ads.ads_attribution(good_clicks(spark, sf), good_orders(spark, sf), DAY, include_unordered=True))


@query("ads_attribution_one_day", events_sql(
    f"SELECT {_ADS_COLS} FROM gold WHERE ordered AND date = DATE '2024-01-15'", _ADS_CTES.strip()))
def ads_attribution_one_day(spark, sf):
    return _rates(ads.ads_attribution(good_clicks(spark, sf), good_orders(spark, sf), DAY, date="2024-01-15"))


_RECON_EXACT = """
SELECT date_hour, item_id, sum(i)::BIGINT AS impressions, sum(c)::BIGINT AS clicks, sum(o)::BIGINT AS orders,
  sum(a)::BIGINT AS attributed_orders, sum(r)::DOUBLE AS revenue FROM (
  SELECT date_trunc('hour', event_timestamp) AS date_hour, item_id, (event_type = 'impression')::INT AS i, (event_type = 'click')::INT AS c,
    0 AS o, 0 AS a, 0::DECIMAL(12,2) AS r FROM bronze_clicks
  UNION ALL
  SELECT date_hour, item_id, 0, 0, 1, max(a), max(price) FROM (
    SELECT date_trunc('hour', event_timestamp) AS date_hour, item_id, order_id, price, EXISTS (
      SELECT 1 FROM bronze_clicks c WHERE c.user_id = o.user_id AND c.item_id = o.item_id AND c.event_type = 'click'
        AND c.event_timestamp <= o.event_timestamp AND c.event_timestamp >= o.event_timestamp - INTERVAL 1 DAY)::INT AS a
    FROM bronze_orders o) GROUP BY date_hour, item_id, order_id) GROUP BY 1, 2
"""


@query("recon_hourly_exact", events_sql(_RECON_EXACT))
def recon_hourly_exact(spark, sf):
    return ads.recon_hourly(bronze_clicks(spark, sf), bronze_orders(spark, sf), window=DAY)


# One ledger line for every click-order match, every click or order without one, and every credited order; an hour
# stands if it has a line other than a credit.
_RECON_COMPAT = """
near AS (SELECT c.ingestion_id AS click_row, o.ingestion_id AS order_row, c.event_type AS kind, c.event_type = 'click' AS clicked, c.event_timestamp AS seen_at, c.item_id AS item,
    o.order_id, o.price, o.event_timestamp AS ordered_at
  FROM scoped_clicks c, scoped_orders o
  WHERE c.user_id = o.user_id AND c.item_id = o.item_id AND o.event_timestamp BETWEEN c.event_timestamp AND c.event_timestamp + INTERVAL '{window}'),
ledger AS (
  SELECT seen_at, item, kind = 'impression' AS shown, clicked, order_id AS bought, price AS paid, NULL AS credit FROM near
  UNION ALL
  SELECT event_timestamp, item_id, event_type = 'impression', event_type = 'click', NULL, NULL, NULL FROM scoped_clicks s
  WHERE NOT EXISTS (FROM near WHERE click_row = s.ingestion_id AND seen_at = s.event_timestamp)
  UNION ALL
  SELECT event_timestamp, item_id, FALSE, FALSE, order_id, price, NULL FROM scoped_orders s
  WHERE NOT EXISTS (FROM near WHERE order_row = s.ingestion_id AND ordered_at = s.event_timestamp)
  UNION ALL
  SELECT ordered_at, item, NULL, NULL, NULL, NULL, order_id FROM near WHERE clicked),
recon AS (
  SELECT date_trunc('hour', seen_at) AS date_hour, item AS item_id, count_if(shown) AS impressions, count_if(clicked) AS clicks, count(DISTINCT bought) AS orders,
    count(DISTINCT credit) AS attributed_orders, coalesce(sum(paid), 0)::DOUBLE AS revenue
  FROM ledger WHERE item IS NOT NULL GROUP BY ALL HAVING count(shown) > 0)
"""


def _scoped_sql(start=None, end=None):
    bounds = f"WHERE event_timestamp >= TIMESTAMP '{start}' AND event_timestamp < TIMESTAMP '{end}'" if start else ""
    return f"scoped_clicks AS (SELECT * FROM bronze_clicks {bounds}), scoped_orders AS (SELECT * FROM bronze_orders {bounds})"


@query("recon_hourly_compat", events_sql("SELECT * FROM recon", _scoped_sql(), _RECON_COMPAT.format(window="1 day").strip()))
def recon_hourly_compat(spark, sf):
    return ads.recon_hourly(bronze_clicks(spark, sf), bronze_orders(spark, sf), window=DAY, mode="compat")


RECON_AS_OF = dt.datetime(2024, 1, 20, 13, 45, 10)


@query("recon_closed_hours", events_sql(
    "SELECT * FROM recon", _scoped_sql("2024-01-19 13:00:00", "2024-01-20 13:00:00"),
    _RECON_COMPAT.format(window="30 minutes").strip()))
def recon_closed_hours(spark, sf):
    start, end = closed_hours(RECON_AS_OF)
    return ads.recon_hourly(bronze_clicks(spark, sf), bronze_orders(spark, sf), start, end, mode="compat").orderBy("date_hour", "item_id")


_COUNTERS = f"""
counters AS (
  SELECT item_id, date, sum(i)::BIGINT AS impressions, sum(c)::BIGINT AS clicks, sum(o)::BIGINT AS orders, sum(a)::BIGINT AS attributed_orders,
    sum(r) AS revenue FROM (
    SELECT item_id, partition_date AS date, (event_type = 'impression')::INT AS i, (event_type <> 'impression')::INT AS c, 0 AS o, 0 AS a,
      0::DECIMAL(12,2) AS r FROM good_clicks
    UNION ALL
    SELECT item_id, partition_date, 0, 0, 1, ({_attributed_sql('click', False)})::INT, price FROM good_orders o) GROUP BY 1, 2)
"""


@query("item_day_counters", events_sql(
    "SELECT * REPLACE (date::VARCHAR AS date, revenue::DOUBLE AS revenue) FROM counters", _COUNTERS.strip()))
def item_day_counters(spark, sf):
    return ads.item_day_counters(good_clicks(spark, sf), good_orders(spark, sf), DAY)


@query("ad_metrics", events_sql("""
SELECT * REPLACE (date::VARCHAR AS date, revenue::DOUBLE AS revenue),
  CASE WHEN impressions > 0 THEN round(clicks / impressions::DOUBLE, 4) ELSE 0 END AS ctr,
  CASE WHEN clicks > 0 THEN round(attributed_orders / clicks::DOUBLE, 4) ELSE 0 END AS cvr FROM counters""", _COUNTERS.strip()))
def ad_metrics(spark, sf):
    return ads.ad_metrics(ads.item_day_counters(good_clicks(spark, sf), good_orders(spark, sf), DAY))


_TRUTH = f"""
truth AS (SELECT item_id, date_hour::DATE AS date, sum(impressions)::BIGINT AS impressions, sum(clicks)::BIGINT AS clicks,
  sum(orders)::BIGINT AS orders, sum(attributed_orders)::BIGINT AS attributed_orders, sum(revenue) AS revenue FROM ({_RECON_EXACT}) GROUP BY 1, 2)
"""


@query("daily_truth", events_sql("SELECT * REPLACE (date::VARCHAR AS date, round(revenue, 2) AS revenue) FROM truth", _TRUTH.strip()))
def daily_truth(spark, sf):
    return ads.daily_truth(ads.recon_hourly(bronze_clicks(spark, sf), bronze_orders(spark, sf), window=DAY))


_METRICS = ["impressions", "clicks", "orders", "attributed_orders", "revenue"]


def _reconcile_inputs(spark, sf):
    counters = ads.item_day_counters(good_clicks(spark, sf), good_orders(spark, sf), DAY)
    truth = ads.daily_truth(ads.recon_hourly(bronze_clicks(spark, sf), bronze_orders(spark, sf), window=DAY))
    return counters, truth


@query("reconcile", events_sql(
    "SELECT coalesce(c.item_id, t.item_id) AS item_id, coalesce(c.date, t.date)::VARCHAR AS date, "
    + ", ".join(f"round(greatest(coalesce(c.{m}, 0)::DOUBLE, coalesce(t.{m}, 0)::DOUBLE), 2)"
                + ("" if m == "revenue" else "::BIGINT") + f" AS {m}" for m in _METRICS) + ", "
    + " + ".join(f"(round(coalesce(t.{m}, 0), 2) > round(coalesce(c.{m}, 0)::DOUBLE, 2))::INT" for m in _METRICS)
    + " AS updated_keys FROM counters c FULL JOIN truth t ON c.item_id = t.item_id AND c.date = t.date",
    _COUNTERS.strip(), _TRUTH.strip()))
def reconcile(spark, sf):
    return ads.reconcile(*_reconcile_inputs(spark, sf))


@query("recon_feed", events_sql(
    " UNION ALL ".join(f"""SELECT t.item_id, t.date::VARCHAR AS date, '{m}' AS metric, round(t.{m}::DOUBLE, 2) AS new_value,
      round(coalesce(c.{m}, 0)::DOUBLE, 2) AS old_value FROM truth t LEFT JOIN counters c ON c.item_id = t.item_id AND c.date = t.date
      WHERE round(t.{m}::DOUBLE, 2) > round(coalesce(c.{m}, 0)::DOUBLE, 2)""" for m in _METRICS), _COUNTERS.strip(), _TRUTH.strip()))
def recon_feed(spark, sf):
    return ads.recon_feed(*_reconcile_inputs(spark, sf))


@query("billing_feed", events_sql(
    " UNION ALL ".join(f"SELECT item_id, date::VARCHAR AS date, '{m}' AS metric, {m}::DOUBLE AS amount FROM counters WHERE {m} <> 0"
                       for m in _METRICS), _COUNTERS.strip()))
def billing_feed(spark, sf):
    return ads.billing_feed(ads.item_day_counters(good_clicks(spark, sf), good_orders(spark, sf), DAY))


@query("attributed_feed", events_sql(f"""
SELECT user_id::VARCHAR AS key, order_id, user_id, item_id, price::DOUBLE AS price, event_timestamp FROM good_orders o
WHERE {_attributed_sql('click', False)}"""))
def attributed_feed(spark, sf):
    return ads.attributed_feed(good_orders(spark, sf), good_clicks(spark, sf), DAY)


@query("expire_profiles", events_sql("""
SELECT user_id, max(event_timestamp) AS last_update FROM good_clicks GROUP BY 1
HAVING max(event_timestamp) + INTERVAL 25 HOUR > TIMESTAMP '2024-01-30 12:00:00'"""))
def expire_profiles(spark, sf):
    last = good_clicks(spark, sf).groupBy("user_id").agg(F.max("event_timestamp").alias("last_update"))
    return ads.expire(last, "last_update", dt.datetime(2024, 1, 30, 12), ads.COUNTER_TTL)


_PCT = lambda col: f"(rank() OVER (PARTITION BY date ORDER BY {col} DESC) - 1) / greatest(count(*) OVER (PARTITION BY date) - 1, 1)::DOUBLE"


@query("item_performance", events_sql(f"""
SELECT {_ADS_COLS}, unique_buyers, round(avg_price, 6) AS avg_price,
  rank() OVER (PARTITION BY date ORDER BY total_revenue DESC) AS rank_by_revenue,
  rank() OVER (PARTITION BY date ORDER BY order_count DESC) AS rank_by_orders,
  rank() OVER (PARTITION BY date ORDER BY conversion_rate DESC) AS rank_by_conversion,
  {_PCT('total_revenue')} <= 0.1 AS is_top_seller,
  {_PCT('click_count')} <= 0.25 AND {_PCT('conversion_rate')} > 0.5 AS is_underperforming, f.category
FROM gold LEFT JOIN (SELECT food_id, category FROM foods) f ON f.food_id = gold.item_id""", _ADS_CTES.strip(), FOODS_SQL.strip()))
def item_performance(spark, sf):
    out = marts.item_performance(good_clicks(spark, sf), good_orders(spark, sf), foods(spark, sf), DAY)
    return _rates(out).withColumn("avg_price", F.round("avg_price", 6))


@query("user_funnel", events_sql("""
SELECT partition_date::VARCHAR AS date, count(DISTINCT session_id) AS total_sessions, sum(i)::BIGINT AS total_impressions, sum(c)::BIGINT AS total_clicks,
  sum(o)::BIGINT AS total_orders, round(CASE WHEN sum(i) > 0 THEN sum(c) / sum(i)::DOUBLE ELSE 0 END, 6) AS impression_to_click_rate,
  round(CASE WHEN sum(c) > 0 THEN sum(o) / sum(c)::DOUBLE ELSE 0 END, 6) AS click_to_order_rate,
  round(sum(o) / count(DISTINCT session_id)::DOUBLE, 6) AS session_to_order_rate,
  round(sum(c) / count(DISTINCT session_id)::DOUBLE, 6) AS avg_clicks_per_session,
  round(sum(o) / count(DISTINCT session_id)::DOUBLE, 6) AS avg_orders_per_session,
  round(sum(v)::DOUBLE / count(DISTINCT session_id), 6) AS avg_revenue_per_session, count(DISTINCT user_id) AS active_users,
  count(DISTINCT CASE WHEN c > 0 THEN user_id END) AS users_with_clicks, count(DISTINCT CASE WHEN o > 0 THEN user_id END) AS users_with_orders
FROM (SELECT partition_date, user_id, session_id, (event_type = 'impression')::INT AS i, (event_type = 'click')::INT AS c, 0 AS o, 0::DECIMAL(12,2) AS v
      FROM good_clicks UNION ALL SELECT partition_date, user_id, session_id, 0, 0, 1, price FROM good_orders) GROUP BY 1"""))
def user_funnel(spark, sf):
    out = marts.user_funnel(good_clicks(spark, sf), good_orders(spark, sf))
    return out.withColumns({c: F.round(c, 6) for c in out.columns if c.endswith("_rate") or c.startswith("avg_")})


@query("hourly_patterns", events_sql("""
SELECT date::VARCHAR AS date, hour_of_day, order_count, total_revenue::DOUBLE AS total_revenue, unique_users,
  round(total_revenue::DOUBLE / order_count, 6) AS avg_order_value, rank() OVER (PARTITION BY date ORDER BY order_count DESC) AS peak_rank,
  rank() OVER (PARTITION BY date ORDER BY order_count DESC) <= 3 AS is_peak_hour,
  round(order_count / sum(order_count) OVER (PARTITION BY date)::DOUBLE * 100, 6) AS pct_of_daily_orders,
  round(total_revenue::DOUBLE / (sum(total_revenue) OVER (PARTITION BY date))::DOUBLE * 100, 6) AS pct_of_daily_revenue
FROM (SELECT partition_date AS date, hour(event_timestamp) AS hour_of_day, count(order_id) AS order_count, sum(price) AS total_revenue,
        count(DISTINCT user_id) AS unique_users FROM good_orders GROUP BY 1, 2)"""))
def hourly_patterns(spark, sf):
    out = marts.hourly_patterns(good_orders(spark, sf))
    return out.withColumns({c: F.round(c, 6) for c in ("avg_order_value", "pct_of_daily_orders", "pct_of_daily_revenue")})


COHORT_DATE = dt.date(1998, 6, 30)


@query("user_cohorts", f"""
WITH {SHOP_SQL.strip()},
users AS (SELECT user_id, min(partition_date) AS f, max(partition_date) AS l, count(*) AS n, sum(price) AS value,
    count(*) FILTER (WHERE date_trunc('month', partition_date) = DATE '1998-06-01') AS pn,
    coalesce(sum(price) FILTER (WHERE date_trunc('month', partition_date) = DATE '1998-06-01'), 0) AS pv
  FROM shop WHERE partition_date <= DATE '1998-06-30' GROUP BY 1),
ranked AS (SELECT *, percent_rank() OVER (ORDER BY value DESC) <= 0.1 AS is_vip, date_diff('day', f, DATE '1998-06-30') AS d0,
    date_diff('day', l, DATE '1998-06-30') AS d1 FROM users)
SELECT user_id, f::VARCHAR AS first_order_date, n AS lifetime_orders, value::DOUBLE AS lifetime_revenue, pn AS orders_this_period,
  pv::DOUBLE AS revenue_this_period, n AS lifetime_items, strftime(f, '%Y-%m') AS cohort_month, d0 AS days_since_first_order,
  d1 AS days_since_last_order, round(CASE WHEN n > 1 THEN date_diff('day', f, l) / (n - 1)::DOUBLE END, 6) AS avg_days_between_orders, is_vip,
  CASE WHEN is_vip THEN 'vip' WHEN d0 <= 7 THEN 'new' WHEN d1 <= 30 THEN 'active' WHEN d1 <= 60 THEN 'at_risk' ELSE 'churned' END AS user_segment,
  '1998-06-30' AS date
FROM ranked""")
def user_cohorts(spark, sf):
    return marts.user_cohorts(shop_orders(spark, sf), COHORT_DATE).withColumn(
        "avg_days_between_orders", F.round("avg_days_between_orders", 6))


