"""Fraud rules, alert queries, sessions, profiles and recommendations."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tiffinlake.operators import aggregates, alerts, cooldown, fraud, intervals, profiles, ranking
from tiffinlake.functions import from_epoch_us
from tiffinlake.session import materialize

from .registry import query
from .views import FOODS_SQL, TX_SQL, delivered, events, events_sql, foods, table, transactions

VELOCITY_WINDOW, DEVICE_WINDOW, GEO_WINDOW, HIGH_VALUE = "1 day", "6 hours", "1 day", 150

_ALERT = """user_id::VARCHAR AS user_id, device_id::VARCHAR AS device_id, order_id, event_id::VARCHAR AS event_id,
  amount::DOUBLE AS amount"""


def _count(lower: str, window: str = "1 day") -> str:
    return f"""(SELECT count(*) FROM tx b WHERE b.user_id = a.user_id AND b.event_time <= a.event_time
      AND b.event_time {lower} a.event_time - INTERVAL '{window}')"""


def _velocity_sql(lower: str) -> str:
    return f"""SELECT 'VELOCITY_FRAUD' AS alert_type, {_ALERT}, 'HIGH' AS severity,
      'User ' || user_id || ' placed ' || order_count || ' orders in 1440 minutes' AS message, event_time AS detected_at, order_count
    FROM (SELECT *, {_count(lower)} AS order_count FROM tx a) WHERE order_count > 3"""


_DEVICE_SQL = f"""SELECT 'DEVICE_SHARING_FRAUD' AS alert_type, {_ALERT}, 'CRITICAL' AS severity,
      'Device ' || device_id || ' used by ' || unique_users || ' different users' AS message, event_time AS detected_at, unique_users
    FROM (SELECT *, (SELECT count(DISTINCT b.user_id) FROM tx b WHERE b.device_id = a.device_id AND b.event_time <= a.event_time
      AND b.event_time >= a.event_time - INTERVAL '6 hours') AS unique_users FROM tx a WHERE user_id IS NOT NULL) WHERE unique_users > 3"""

_HIGH_SQL = f"""SELECT 'HIGH_VALUE_FRAUD' AS alert_type, {_ALERT}, 'MEDIUM' AS severity,
      'High-value transaction of ₹' || amount || ' from user ' || coalesce(user_id::VARCHAR, 'null') AS message, event_time AS detected_at,
      150.0::DOUBLE AS threshold FROM tx WHERE amount > 150"""

_GEO_SQL = f"""SELECT 'GEO_ANOMALY_FRAUD' AS alert_type, {_ALERT}, 'HIGH' AS severity,
      'User ' || user_id || ' ordered from ' || city || ' after ordering from [' || previous || '] recently' AS message, event_time AS detected_at,
      city AS current_city, '["' || replace(previous, ', ', '","') || '"]' AS previous_cities
    FROM (SELECT *, (SELECT string_agg(DISTINCT b.city, ', ' ORDER BY b.city) FROM tx b WHERE b.user_id = a.user_id AND b.city <> a.city
        AND b.event_time <= a.event_time AND b.event_time >= a.event_time - INTERVAL 1 DAY) AS previous,
      EXISTS (SELECT 1 FROM tx b WHERE b.user_id = a.user_id AND b.city = a.city AND b.event_time < a.event_time
        AND b.event_time >= a.event_time - INTERVAL 1 DAY) AS own
      FROM tx a WHERE user_id IS NOT NULL) WHERE previous IS NOT NULL AND NOT own"""

_COMMON = "alert_type, user_id, device_id, order_id, event_id, amount, severity, message, detected_at"
_ALL = "alerts AS (" + " UNION ALL ".join(
    f"SELECT {_COMMON} FROM ({q})" for q in (_velocity_sql(">="), _DEVICE_SQL, _HIGH_SQL, _GEO_SQL)) + ")"


def tx_sql(body: str, *ctes: str) -> str:
    return events_sql(body, TX_SQL.strip(), *ctes)


def stored_transactions(spark, sf):
    """The rules read their transactions several times each; the events' JSON is parsed once."""
    return materialize(transactions(spark, sf), "transactions")


def all_alerts(spark, sf):
    tx = stored_transactions(spark, sf)
    return fraud.union_alerts(
        fraud.velocity_alerts(tx, window=VELOCITY_WINDOW), fraud.device_sharing_alerts(tx, window=DEVICE_WINDOW),
        fraud.high_value_alerts(tx, HIGH_VALUE), fraud.geo_anomaly_alerts(tx, GEO_WINDOW)).select(*fraud.ALERT_COLUMNS)


@query("velocity_alerts", tx_sql(_velocity_sql(">=")))
def velocity_alerts(spark, sf):
    return fraud.velocity_alerts(transactions(spark, sf), window=VELOCITY_WINDOW)


@query("velocity_alerts_open", events_sql(
    _velocity_sql(">"), TX_SQL.strip().replace("FROM ev", """FROM delivered
  QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY event_timestamp DESC) = 1""")))
def velocity_alerts_open(spark, sf):
    """The service variant: open lower bound, over distinct events of a feed with repeats."""
    tx = delivered(spark, sf).select(
        "event_id", "user_id", "device_id", "order_id", F.col("price").alias("amount"), "city",
        F.col("event_timestamp").alias("event_time"))
    return fraud.velocity_alerts(tx, window=VELOCITY_WINDOW, lower="open", distinct="event_id")


@query("device_sharing_alerts", tx_sql(_DEVICE_SQL))
def device_sharing_alerts(spark, sf):
    return fraud.device_sharing_alerts(transactions(spark, sf), window=DEVICE_WINDOW)


@query("device_sharing_users", tx_sql(f"""
SELECT d.event_id, d.device_id, b.user_id::VARCHAR AS member FROM ({_DEVICE_SQL}) d JOIN tx b ON b.device_id::VARCHAR = d.device_id
  AND b.event_time <= d.detected_at AND b.event_time >= d.detected_at - INTERVAL '6 hours' WHERE b.user_id IS NOT NULL GROUP BY ALL"""))
def device_sharing_users(spark, sf):
    tx = stored_transactions(spark, sf)
    return fraud.device_users(fraud.device_sharing_alerts(tx, window=DEVICE_WINDOW), tx, DEVICE_WINDOW)


@query("high_value_alerts", tx_sql(_HIGH_SQL))
def high_value_alerts(spark, sf):
    return fraud.high_value_alerts(transactions(spark, sf), HIGH_VALUE)


@query("high_value_alerts_inclusive", tx_sql("SELECT event_id::VARCHAR AS event_id, amount::DOUBLE AS amount FROM tx WHERE amount >= 150"))
def high_value_alerts_inclusive(spark, sf):
    return fraud.high_value_alerts(transactions(spark, sf), HIGH_VALUE, inclusive=True).select("event_id", "amount")


@query("geo_anomaly_alerts", tx_sql(_GEO_SQL))
def geo_anomaly_alerts(spark, sf):
    return fraud.geo_anomaly_alerts(transactions(spark, sf), GEO_WINDOW)


@query("alert_union", tx_sql("SELECT * FROM alerts", _ALL))
def alert_union(spark, sf):
    return all_alerts(spark, sf)


_COOL = """
keyed AS (SELECT *, alert_type || ':' || coalesce(user_id, '') AS key FROM alerts),
chain AS (
  SELECT key, min(detected_at) AS t FROM keyed GROUP BY key
  UNION ALL
  SELECT c.key, (SELECT min(k.detected_at) FROM keyed k WHERE k.key = c.key AND k.detected_at > c.t + INTERVAL '{period}') AS t
  FROM chain c WHERE c.t IS NOT NULL),
passed AS (SELECT a.* EXCLUDE (key) FROM keyed a JOIN chain c ON a.key = c.key AND a.detected_at = c.t
  QUALIFY row_number() OVER (PARTITION BY a.key, a.detected_at ORDER BY event_id) = 1)
"""


def cool_sql(body: str, period: str) -> str:
    return tx_sql(body, _ALL, _COOL.format(period=period).strip()).replace("WITH ", "WITH RECURSIVE ", 1)


def _keyed(df):
    return df.withColumn("key", F.concat_ws(":", "alert_type", F.coalesce("user_id", F.lit(""))))


def _cooled(spark, sf, period, **options):
    return cooldown.cooldown(_keyed(all_alerts(spark, sf)), ["key"], period=period, tiebreak=["event_id"], **options).drop("key")


@query("alert_cooldown", cool_sql("SELECT * FROM passed", "1 day"))
def alert_cooldown(spark, sf):
    return _cooled(spark, sf, "1 day")


@query("alert_cooldown_long_runs", cool_sql("SELECT * FROM passed", "12 hours"))
def alert_cooldown_long_runs(spark, sf):
    """The same rule by rounds alone: no list of a key is walked, and rows list four alerts at most."""
    return _cooled(spark, sf, "12 hours", listed=4, walked=1)


@query("alert_cooldown_5_minutes", cool_sql("SELECT * FROM passed", "5 minutes"))
def alert_cooldown_5_minutes(spark, sf):
    return _cooled(spark, sf, fraud.COOLDOWN)


@query("alert_records", tx_sql("SELECT * REPLACE (epoch_us(detected_at) // 1000 AS detected_at) FROM alerts", _ALL))
def alert_records(spark, sf):
    return fraud.alert_records(all_alerts(spark, sf)).drop("alert_data")


AS_OF = dt.datetime(2024, 1, 30, 12)
_AS_OF = "TIMESTAMP '2024-01-30 12:00:00'"


@query("alert_stats", tx_sql(f"""
SELECT 'total' AS section, 1 AS position, 'all' AS label, count(*) AS n FROM alerts
UNION ALL SELECT 'last_hour', 1, 'all', count(*) FILTER (WHERE detected_at > {_AS_OF} - INTERVAL 1 HOUR) FROM alerts
UNION ALL SELECT 'last_day', 1, 'all', count(*) FILTER (WHERE detected_at > {_AS_OF} - INTERVAL 1 DAY) FROM alerts
UNION ALL SELECT 'by_type', row_number() OVER (ORDER BY count(*) DESC, alert_type), alert_type, count(*) FROM alerts GROUP BY alert_type
UNION ALL SELECT 'by_severity', row_number() OVER (ORDER BY CASE severity WHEN 'CRITICAL' THEN 1 WHEN 'HIGH' THEN 2 ELSE 3 END), severity, count(*)
  FROM alerts GROUP BY severity
UNION ALL SELECT * FROM (SELECT 'top_users', row_number() OVER (ORDER BY count(*) DESC, user_id), user_id, count(*) FROM alerts
  WHERE user_id IS NOT NULL GROUP BY user_id QUALIFY row_number() OVER (ORDER BY count(*) DESC, user_id) <= 5)""", _ALL))
def alert_stats(spark, sf):
    return alerts.alert_stats(all_alerts(spark, sf), AS_OF)


@query("alerts_recent", tx_sql("SELECT * FROM alerts ORDER BY detected_at DESC, alert_type, event_id LIMIT 20", _ALL))
def alerts_recent(spark, sf):
    return alerts.recent(all_alerts(spark, sf))


@query("alerts_recent_with_total", tx_sql(
    "SELECT *, (SELECT count(*) FROM alerts) AS total_emitted FROM alerts ORDER BY detected_at DESC, alert_type, event_id LIMIT 200", _ALL))
def alerts_recent_with_total(spark, sf):
    return alerts.recent_with_total(all_alerts(spark, sf))


@query("alerts_by_user", tx_sql("SELECT * FROM alerts WHERE user_id = '8'", _ALL))
def alerts_by_user(spark, sf):
    return alerts.by_user(all_alerts(spark, sf), "8")


@query("alerts_by_type", tx_sql(
    "SELECT * FROM alerts WHERE alert_type = 'GEO_ANOMALY_FRAUD' ORDER BY detected_at DESC, event_id LIMIT 20", _ALL))
def alerts_by_type(spark, sf):
    return alerts.by_type(all_alerts(spark, sf), fraud.GEO_ANOMALY)


@query("alerts_high_severity", tx_sql(
    "SELECT * FROM alerts WHERE severity IN ('CRITICAL', 'HIGH') ORDER BY detected_at DESC, alert_type, event_id LIMIT 20", _ALL))
def alerts_high_severity(spark, sf):
    return alerts.high_severity(all_alerts(spark, sf))


@query("alerts_retained", tx_sql("SELECT * FROM alerts ORDER BY detected_at DESC, alert_type DESC, event_id DESC LIMIT 200", _ALL))
def alerts_retained(spark, sf):
    return ranking.retain_latest(all_alerts(spark, sf), "detected_at", 200, ["alert_type", "event_id"])


@query("alert_spikes", tx_sql("""
SELECT minute, alerts_in_window FROM (
  SELECT minute, alerts_in_window, min(alerts_in_window) OVER (ORDER BY minute ROWS 5 PRECEDING) AS least,
    count(*) OVER (ORDER BY minute ROWS 5 PRECEDING) AS held FROM (
    SELECT minute, (SELECT count(*) FROM alerts WHERE detected_at > minute - INTERVAL 240 MINUTE AND detected_at <= minute) AS alerts_in_window
    FROM (SELECT unnest(generate_series((SELECT date_trunc('minute', min(detected_at)) FROM alerts),
      (SELECT max(detected_at) FROM alerts) + INTERVAL 250 MINUTE, INTERVAL 1 MINUTE)) AS minute)))
WHERE least > 60 AND held = 6""", _ALL))
def alert_spikes(spark, sf):
    return alerts.alert_spikes(all_alerts(spark, sf), limit=60, window="240 minutes")


@query("running_count", "SELECT event_id, user_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS running_count FROM events")
def running_count(spark, sf):
    rows = table(spark, sf, "events").select("event_id", "user_id", "ts")
    return intervals.running_count(rows, ["user_id"], "ts", ["event_id"]).select("event_id", "user_id", "running_count")


_SESSIONS = """
marked AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) < INTERVAL 3 HOUR THEN 0 ELSE 1 END AS opens FROM events),
numbered AS (SELECT *, sum(opens) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS session_no FROM marked),
sessions AS (SELECT user_id, session_no::BIGINT AS session_no, min(ts) AS started, max(ts) AS ended, count(*) AS n_events FROM numbered GROUP BY ALL)
"""


@query("user_sessions", "WITH " + _SESSIONS.strip() + " SELECT * FROM sessions")
def user_sessions(spark, sf):
    out = intervals.sessions(table(spark, sf, "events"), ["user_id"], "ts", "3 hours")
    return out.select("user_id", "session_no", from_epoch_us("start_us").alias("started"),
                      from_epoch_us("last_us").alias("ended"), "n_events")


@query("inactive_users", "WITH " + _SESSIONS.strip() + " SELECT user_id, ended, ended + INTERVAL 3 HOUR AS fired, n_events FROM sessions")
def inactive_users(spark, sf):
    out = intervals.inactive_keys(table(spark, sf, "events"), ["user_id"], "ts", "3 hours")
    return out.select("user_id", from_epoch_us("last_us").alias("ended"), from_epoch_us("fired_us").alias("fired"), "n_events")


# --- profiles ---------------------------------------------------------------------------------

PROFILE_AS_OF = dt.datetime(2024, 1, 31)


def _signals(spark, sf):
    """Events on catalog foods: the device number picks the food, its type is the category."""
    menu = foods(spark, sf).select(F.col("food_id").alias("item_id"), F.col("category"))
    return (
        events(spark, sf).select("user_id", "event_type", (F.col("device_id") + 1).alias("item_id"),
                                 F.col("event_timestamp").alias("event_time"))
        .join(menu, "item_id", "left")
    )


_SIGNALS = """
signals AS (SELECT e.user_id, e.event_type, e.device_id + 1 AS item_id, e.event_timestamp AS event_time, f.category
            FROM ev e LEFT JOIN foods f ON f.food_id = e.device_id + 1),
scored AS (SELECT *, CASE event_type WHEN 'order' THEN 5.0 WHEN 'click' THEN 3.0 WHEN 'view' THEN 1.5 ELSE 1.0 END::DOUBLE
  * exp(-greatest(0, epoch_us(TIMESTAMP '2024-01-31') - epoch_us(event_time)) / 60e6 / 240.0) AS s FROM signals WHERE user_id > 0),
item_scores AS (SELECT user_id, item_id, sum(s) AS score, max(event_time) AS last_update FROM scored WHERE item_id > 0 GROUP BY 1, 2
  QUALIFY max(max(event_time)) OVER (PARTITION BY user_id) + INTERVAL 7 DAY > TIMESTAMP '2024-01-31'),
category_scores AS (SELECT user_id, category, sum(s) AS score, max(event_time) AS last_update FROM scored WHERE trim(category) <> '' GROUP BY 1, 2
  QUALIFY max(max(event_time)) OVER (PARTITION BY user_id) + INTERVAL 7 DAY > TIMESTAMP '2024-01-31')
"""


def profile_sql(body: str, *ctes: str) -> str:
    return events_sql(body, FOODS_SQL.strip(), _SIGNALS.strip(), *ctes)


@query("interest_items", profile_sql("SELECT user_id, item_id, round(score, 8) AS score, last_update FROM item_scores"))
def interest_items(spark, sf):
    return profiles.interest_profiles(_signals(spark, sf), PROFILE_AS_OF).withColumn("score", F.round("score", 8))


@query("interest_categories", profile_sql("SELECT user_id, category, round(score, 8) AS score, last_update FROM category_scores"))
def interest_categories(spark, sf):
    return profiles.interest_profiles(_signals(spark, sf), PROFILE_AS_OF, "category").withColumn("score", F.round("score", 8))


@query("interest_at_ingestion", events_sql("""
SELECT user_id, item_id, round(sum(CASE event_type WHEN 'order' THEN 5.0 WHEN 'click' THEN 3.0 WHEN 'view' THEN 1.5 ELSE 1.0 END::DOUBLE
  * exp(-(device_id + 1) / 240.0::DOUBLE)), 8) AS score, max(event_timestamp) AS last_update
FROM ev WHERE user_id > 0 AND item_id > 0 GROUP BY 1, 2"""))
def interest_at_ingestion(spark, sf):
    rows = events(spark, sf).select(
        "user_id", "item_id", "category", "event_type", F.col("event_timestamp").alias("event_time"),
        (F.col("event_timestamp") + F.expr("make_dt_interval(0, 0, device_id + 1, 0)")).alias("ingested_at"))
    return profiles.interest_profiles(rows, kind="item", ingested="ingested_at").withColumn("score", F.round("score", 8))


@query("recommend", profile_sql("""
SELECT user_id, position, food_id, name, category, price::DOUBLE AS price, round(score, 4) AS score, reason FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY tier, grp, score DESC, food_id DESC) AS position FROM (
    SELECT * FROM candidates QUALIFY row_number() OVER (PARTITION BY user_id, food_id ORDER BY tier, grp, score DESC) = 1))
JOIN foods USING (food_id) WHERE position <= 10""", """
people AS (SELECT DISTINCT user_id FROM events),
top_items AS (SELECT * FROM item_scores QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY score DESC, item_id DESC) <= 50),
top_categories AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY score DESC, category DESC) AS grp FROM category_scores
  QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY score DESC, category DESC) <= 10),
candidates AS (
  SELECT user_id, item_id AS food_id, 0 AS tier, 0 AS grp, score, 'user_item_preference' AS reason FROM top_items
    JOIN foods ON food_id = item_id WHERE is_available AND user_id IN (SELECT user_id FROM people)
  UNION ALL SELECT user_id, food_id, 1, grp, score, 'user_category_preference' FROM top_categories t JOIN foods f ON f.category = t.category
    WHERE is_available AND user_id IN (SELECT user_id FROM people)
  UNION ALL SELECT user_id, food_id, 2, 0, 0.0, 'cold_start_popular' FROM people, foods WHERE is_available)"""))
def recommend(spark, sf):
    signals = _signals(spark, sf)
    return profiles.recommend(
        table(spark, sf, "events").select("user_id"), profiles.interest_profiles(signals, PROFILE_AS_OF),
        profiles.interest_profiles(signals, PROFILE_AS_OF, "category"), foods(spark, sf))


@query("revenue_by_segment", """
SELECT c_mktsegment AS restaurant, sum(CAST(c_acctbal AS DECIMAL(12,2)))::DOUBLE AS total_revenue FROM customer GROUP BY 1""")
def revenue_by_segment(spark, sf):
    rows = table(spark, sf, "customer").select(
        F.col("c_mktsegment").alias("restaurant"), F.col("c_acctbal").cast("decimal(12,2)").alias("amount"))
    return aggregates.revenue_by(rows, "restaurant")
