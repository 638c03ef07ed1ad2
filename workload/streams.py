"""Structured Streaming jobs over the given tables, driven to completion; each must equal its batch result."""

from __future__ import annotations

from pyspark.sql import functions as F

from tiffinlake.functions import epoch_us, from_epoch_us
from tiffinlake.operators import fraud
from tiffinlake.operators.ads import COUNTERS
from tiffinlake.schemas import STREAM_ORDER
from tiffinlake.session import materialize, scratch
from tiffinlake.sources import sinks
from tiffinlake.sources.streams import batch_sink, file_sink, file_source, read_events_stream, run_available
from tiffinlake.streaming import attribution, ingest, processors, profiles, state, windows

from .ads import _COUNTERS, _attributed_sql
from .fraudwatch import (
    DEVICE_WINDOW, GEO_WINDOW, HIGH_VALUE, PROFILE_AS_OF, VELOCITY_WINDOW, _ALL, _COMMON, _DEVICE_SQL, _GEO_SQL, _SESSIONS, _velocity_sql,
    _signals, all_alerts, cool_sql, _keyed, profile_sql, tx_sql,
)
from .registry import query
from .storage import messages
from .views import delivered, events_sql, good_clicks, good_orders, table, transactions

# The given files are replayed in no particular order, so the watermark must not pass their 30 days.
REPLAY = "40 days"


def replay(spark, df, label):
    """A table as a stream: written to files, read as they arrive."""
    path = scratch(spark, label)
    df.write.parquet(path)
    return file_source(spark, path, df.schema)


# Files of a micro-batch, written and read by so many tasks.
FILES = 4


def time_part(ts, first, last, batches):
    """Which of so many equal parts of the time range a row lies in."""
    return F.least(F.floor((epoch_us(ts) - first) * batches / (last - first + 1)), F.lit(batches - 1)).cast("int")


def arriving(spark, df, ts, label, batches=4):
    """A table as a stream in time order, a part of the time range in each micro-batch."""
    df = materialize(df, label)
    first, last = df.select(F.min(epoch_us(ts)), F.max(epoch_us(ts))).first()
    return in_parts(spark, df.withColumn("_part", time_part(ts, first, last, batches)), label, batches)


def in_parts(spark, df, label, batches):
    """A table as a stream, one value of ``_part`` a micro-batch; each is written as several files by parallel tasks."""
    path = scratch(spark, label)
    for i in range(batches):
        part = df.where(F.col("_part") == i).drop("_part")
        part.repartition(FILES).write.mode("append").parquet(path)
    return file_source(spark, path, df.drop("_part").schema, max_files=FILES)


def collected(spark, stream, label):
    """Everything an append-mode stream emits."""
    path = scratch(spark, f"{label}-out")
    run_available(file_sink(stream, path, scratch(spark, f"{label}-checkpoint")))
    return spark.read.schema(stream.schema).parquet(path)


def drained(spark, stream, label):
    """The checkpoint of an append-mode stream that has processed everything; its rows are not kept."""
    checkpoint = scratch(spark, f"{label}-checkpoint")
    run_available(stream.writeStream.format("noop").option("checkpointLocation", checkpoint))
    return checkpoint


def completed(spark, stream, label):
    """Final state of a complete-mode aggregate."""
    path = scratch(spark, f"{label}-out")
    run_available(batch_sink(
        stream, lambda batch, _: batch.write.mode("overwrite").parquet(path), scratch(spark, f"{label}-checkpoint"), "complete"))
    return spark.read.schema(stream.schema).parquet(path)


@query("stream_dedup", events_sql("SELECT ingestion_id, event_id, event_type FROM ev"))
def stream_dedup(spark, sf):
    rows = delivered(spark, sf).select("ingestion_id", "event_id", "event_type", F.col("event_timestamp").cast("timestamp").alias("t"))
    out = windows.dedup_stream(arriving(spark, rows, "t", "dedup"), ["ingestion_id"], "t", REPLAY)
    return collected(spark, out.drop("t"), "dedup")


@query("stream_tumbling", """
SELECT date_trunc('minute', ts) AS window_start, date_trunc('minute', ts) + INTERVAL 1 MINUTE AS window_end, event_type, count(*) AS n
FROM events GROUP BY ALL""")
def stream_tumbling(spark, sf):
    rows = table(spark, sf, "events").select("event_type", F.col("ts").cast("timestamp").alias("ts"))
    stream = windows.with_watermark(replay(spark, rows, "tumbling"), "ts", "5 seconds")
    return completed(spark, windows.windowed(stream, ["event_type"], "ts", "1 minute"), "tumbling")


@query("stream_sliding", """
SELECT s AS window_start, s + INTERVAL 1 HOUR AS window_end, event_type, count(*) AS n FROM (
  SELECT event_type, time_bucket(INTERVAL 30 MINUTE, ts, TIMESTAMP '2000-01-01') - unnest([INTERVAL 0 MINUTE, INTERVAL 30 MINUTE]) AS s FROM events)
GROUP BY ALL""")
def stream_sliding(spark, sf):
    rows = table(spark, sf, "events").select("event_type", F.col("ts").cast("timestamp").alias("ts"))
    stream = windows.with_watermark(replay(spark, rows, "sliding"), "ts", "5 seconds")
    return completed(spark, windows.windowed(stream, ["event_type"], "ts", "1 hour", "30 minutes"), "sliding")


@query("stream_sessions", "WITH " + _SESSIONS.strip() + """
SELECT user_id, started AS session_start, ended + INTERVAL 3 HOUR AS session_end, n_events AS n FROM sessions""")
def stream_sessions(spark, sf):
    rows = table(spark, sf, "events").select("user_id", F.col("ts").cast("timestamp").alias("ts"))
    stream = windows.with_watermark(replay(spark, rows, "sessions"), "ts", REPLAY)
    return completed(spark, windows.session_windows(stream, ["user_id"], "ts", "3 hours"), "sessions")


@query("stream_running_count", "SELECT event_id, user_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS running_count FROM events")
def stream_running_count(spark, sf):
    rows = table(spark, sf, "events").select("event_id", "user_id", "ts")
    out = processors.running_count_stream(arriving(spark, rows, "ts", "count"), ["user_id"], "ts")
    return collected(spark, out, "count").select("event_id", "user_id", "running_count")


@query("stream_inactive_users", "WITH " + _SESSIONS.strip() + """
SELECT user_id, ended, ended + INTERVAL 3 HOUR AS fired FROM sessions
QUALIFY ended < max(ended) OVER (PARTITION BY user_id)
  OR epoch_ms(ended) + 10800000 < (SELECT epoch_ms(max(ts)) FROM events)""")
def stream_inactive_users(spark, sf):
    """Timers that the watermark, which follows the newest event, has passed."""
    rows = table(spark, sf, "events").select("user_id", F.col("ts").cast("timestamp").alias("ts"))
    out = processors.inactive_keys_stream(replay(spark, rows, "inactive"), "user_id", "ts", "3 hours")
    return collected(spark, out, "inactive").select(
        "user_id", from_epoch_us("last_us").alias("ended"), from_epoch_us("fired_us").alias("fired"))


@query("stream_state_left", "WITH " + _SESSIONS.strip() + """
SELECT user_id, max(ended) AS ended FROM sessions GROUP BY user_id HAVING epoch_ms(max(ended)) + 10800000 >= (SELECT epoch_ms(max(ts)) FROM events)""")
def stream_state_left(spark, sf):
    """The users whose inactivity timer the watermark has not passed: they alone are still in the state."""
    rows = table(spark, sf, "events").select("user_id", F.col("ts").cast("timestamp").alias("ts"))
    out = processors.inactive_keys_stream(arriving(spark, rows, "ts", "left"), "user_id", "ts", "3 hours")
    return state.state_left(spark, drained(spark, out, "left"), "last").select(
        F.col("key.key").alias("user_id"), from_epoch_us("value.v").alias("ended"))


@query("stream_attribution", events_sql(f"SELECT order_id, user_id, item_id FROM good_orders o WHERE {_attributed_sql('click', False)}"))
def stream_attribution(spark, sf):
    orders = good_orders(spark, sf).select("order_id", "user_id", "item_id", F.col("event_timestamp").cast("timestamp").alias("event_timestamp"))
    clicks = good_clicks(spark, sf).select("event_type", "user_id", "item_id", F.col("event_timestamp").cast("timestamp").alias("event_timestamp"))
    out = attribution.attribute_stream(replay(spark, orders, "orders"), replay(spark, clicks, "clicks"), "1 day", REPLAY)
    return collected(spark, out, "attribution").select("order_id", "user_id", "item_id")


def _engagement(spark, sf):
    """Clicks, orders and attributed orders as one engagement stream."""
    from tiffinlake.operators.ads import attributed_orders

    clicks, orders = good_clicks(spark, sf), good_orders(spark, sf)
    part = lambda df, kind: df.select(
        kind.alias("event_type"), "item_id", F.col("event_timestamp").cast("timestamp").alias("event_timestamp"), F.col("price"))
    hits = attributed_orders(orders, clicks, "1 day").where("attributed")
    return part(clicks, F.col("event_type")).unionByName(part(orders, F.lit("order"))).unionByName(part(hits, F.lit("attributed_order")))


@query("stream_counters", events_sql(
    "SELECT item_id, date::VARCHAR AS date, impressions, clicks, orders, attributed_orders, revenue::DOUBLE AS revenue FROM counters", _COUNTERS.strip()))
def stream_counters(spark, sf):
    """Counters of the engagement stream, of whose four folders three were merged on the way."""
    path, feed = scratch(spark, "counters"), arriving(spark, _engagement(spark, sf), "event_timestamp", "engagement")
    run_available(attribution.counter_log(feed, path, scratch(spark, "counters-checkpoint"), every=3))
    return attribution.read_counters(spark, path)


@query("stream_billing_increments", events_sql(
    " UNION ALL ".join(f"SELECT item_id, date::VARCHAR AS date, '{m}' AS metric, round({m}::DOUBLE, 2) AS amount, round({m}::DOUBLE, 2) AS latest FROM counters WHERE {m} <> 0"
                       for m in COUNTERS), _COUNTERS.strip()))
def stream_billing_increments(spark, sf):
    """The increments of every counter, each batch applied twice; they sum to the counters, and the last one ends at them."""
    path, feed = scratch(spark, "billing"), arriving(spark, _engagement(spark, sf), "event_timestamp", "engagement")

    def twice(batch, batch_id):
        for _ in range(2):
            attribution.apply_with_changes(batch, batch_id, path, every=3)

    run_available(batch_sink(feed, twice, scratch(spark, "billing-checkpoint")))
    return attribution.change_feed(spark, path).read().groupBy("item_id", "date", "metric").agg(
        F.round(F.sum("amount"), 2).alias("amount"), F.round(F.max_by("after", "batch_id"), 2).alias("latest"))


_ARRIVALS = """
span AS (SELECT min(epoch_us(t)) AS lo, max(epoch_us(t)) AS hi FROM
  (SELECT event_timestamp AS t FROM good_orders UNION ALL SELECT event_timestamp FROM good_clicks WHERE event_type = 'click')),
came_clicks AS (SELECT c.*, least(floor((epoch_us(event_timestamp) - lo) * 4 / (hi - lo + 1)), 3) + (event_id % 5 = 0)::INT AS came
  FROM good_clicks c, span WHERE event_type = 'click'),
came_orders AS (SELECT o.*, least(floor((epoch_us(event_timestamp) - lo) * 4 / (hi - lo + 1)), 3) AS came FROM good_orders o, span)
"""


@query("stream_attribution_arrival", events_sql("""
SELECT order_id, user_id, item_id, EXISTS (SELECT 1 FROM came_clicks c WHERE c.user_id = o.user_id AND c.item_id = o.item_id AND c.came <= o.came
    AND c.event_timestamp <= o.event_timestamp AND c.event_timestamp >= o.event_timestamp - INTERVAL 1 DAY) AS attributed
FROM came_orders o""", _ARRIVALS.strip()))
def stream_attribution_arrival(spark, sf):
    """Every fifth click comes a quarter of the time range late: an order that came before it is not credited."""
    clicks = good_clicks(spark, sf).where("event_type = 'click'").select(
        F.lit(False).alias("is_order"), "event_id", "user_id", "item_id", F.lit(None).cast("string").alias("order_id"), "event_timestamp")
    orders = good_orders(spark, sf).select(
        F.lit(True).alias("is_order"), "event_id", "user_id", "item_id", "order_id", "event_timestamp")
    rows = materialize(clicks.unionByName(orders), "arrivals")
    first, last = rows.select(F.min(epoch_us("event_timestamp")), F.max(epoch_us("event_timestamp"))).first()
    late = (~F.col("is_order") & (F.col("event_id") % 5 == 0)).cast("int")
    stream = in_parts(spark, rows.withColumn("_part", time_part("event_timestamp", first, last, 4) + late), "arrivals", 5)
    came = stream.where("is_order").select("order_id", "user_id", "item_id", "event_timestamp")
    clicked = stream.where("not is_order").select("user_id", "item_id", "event_timestamp", F.lit("click").alias("event_type"))
    out = processors.attribution_by_arrival(came, clicked, "1 day", delay="9 days")
    return collected(spark, out, "arrivals").select("order_id", "user_id", "item_id", "attributed")


def _stream_profiles(spark, sf, kind):
    updates = profiles.profile_updates(arriving(spark, _signals(spark, sf), "event_time", "signals"))
    path = scratch(spark, "profiles")
    run_available(profiles.keep_profiles(updates, path, scratch(spark, "profiles-checkpoint"), every=3))
    return profiles.current_profiles(spark, path, PROFILE_AS_OF, kind).withColumn("score", F.round("score", 6))


@query("stream_interest_items", profile_sql("SELECT user_id, item_id, round(score, 6) AS score, last_update FROM item_scores"))
def stream_interest_items(spark, sf):
    return _stream_profiles(spark, sf, "item")


@query("stream_interest_categories", profile_sql("SELECT user_id, category, round(score, 6) AS score, last_update FROM category_scores"))
def stream_interest_categories(spark, sf):
    return _stream_profiles(spark, sf, "category")


def _tx(spark, sf):
    return arriving(spark, transactions(spark, sf), "event_time", "transactions")


@query("stream_velocity", tx_sql(_velocity_sql(">=")))
def stream_velocity(spark, sf):
    return collected(spark, processors.velocity_stream(_tx(spark, sf).where("user_id is not null"), window=VELOCITY_WINDOW), "velocity")


@query("stream_device_sharing", tx_sql(f"SELECT {_COMMON}, unique_users FROM ({_DEVICE_SQL})"))
def stream_device_sharing(spark, sf):
    """Alerts are stored with their users, each of them once for a run of alerts; lists are made on reading."""
    alerts = collected(spark, processors.device_sharing_stream(_tx(spark, sf), window=DEVICE_WINDOW, users="stretches"), "device")
    return processors.with_user_lists(alerts).drop("user_ids")


@query("stream_geo_anomaly", tx_sql(_GEO_SQL))
def stream_geo_anomaly(spark, sf):
    return collected(spark, processors.geo_anomaly_stream(_tx(spark, sf), GEO_WINDOW), "geo")


@query("stream_high_value", tx_sql("SELECT event_id::VARCHAR AS event_id, amount::DOUBLE AS amount FROM tx WHERE amount > 150"))
def stream_high_value(spark, sf):
    return collected(spark, fraud.high_value_alerts(_tx(spark, sf), HIGH_VALUE), "value").select("event_id", "amount")


@query("stream_cooldown", cool_sql("SELECT * FROM passed", "1 day"))
def stream_cooldown(spark, sf):
    alerts = _keyed(all_alerts(spark, sf))
    out = processors.cooldown_stream(arriving(spark, alerts, "detected_at", "alerts"), ["key"], period="1 day", shards=processors.SHARDS)
    return collected(spark, out.drop("key"), "cooldown")


@query("stream_alert_sink", tx_sql("SELECT * FROM alerts", _ALL))
def stream_alert_sink(spark, sf):
    """Alerts through a sink whose batches are committed, read back from the files the commits name."""
    path, alerts = scratch(spark, "sink"), all_alerts(spark, sf)
    stream = arriving(spark, alerts, "detected_at", "sink")
    run_available(sinks.committed_sink(stream, path, scratch(spark, "sink-checkpoint")))
    return sinks.read_committed(spark, path, alerts.schema).drop("batch")


@query("stream_cooldown_processing", cool_sql("SELECT a.* EXCLUDE (key) FROM keyed a QUALIFY row_number() OVER (PARTITION BY key ORDER BY detected_at, event_id) = 1", "1 day"))
def stream_cooldown_processing(spark, sf):
    """All alerts come within one period of the clock, so each key's first one passes, whatever the alerts' own times."""
    alerts = _keyed(all_alerts(spark, sf))
    out = processors.cooldown_stream(replay(spark, alerts, "alerts"), ["key"], period="30 days", clock="processing").drop("key")
    path = scratch(spark, "processing-out")
    run_available(file_sink(out, path, scratch(spark, "processing-checkpoint")), single_batch=True)
    return spark.read.schema(out.schema).parquet(path)


@query("stream_alert_store", tx_sql("SELECT * REPLACE (epoch_us(detected_at) // 1000 AS detected_at) FROM alerts", _ALL))
def stream_alert_store(spark, sf):
    """Every alert once, from folders of which three were merged on the way."""
    path = scratch(spark, "alert-store")
    alerts = arriving(spark, all_alerts(spark, sf), "detected_at", "store")
    run_available(ingest.store_alerts(alerts, path, scratch(spark, "store-checkpoint"), every=3))
    return ingest.alert_log(spark, path).read().drop("alert_data", "batch_id")


_INGESTED = """
sent AS (SELECT event_id, event_timestamp, CASE WHEN event_id % 53 = 0 OR event_type = 'signup' THEN 'quarantine' WHEN event_type = 'order' THEN 'orders' ELSE 'clicks' END AS target,
  least(floor((epoch_us(event_timestamp) - min(epoch_us(event_timestamp)) OVER ()) * 3
    / (max(epoch_us(event_timestamp)) OVER () - min(epoch_us(event_timestamp)) OVER () + 1)), 2) AS part FROM ev)
"""


def _ingested(spark, sf):
    """Messages in three parts of the time range; every other one is delivered again in the part after its own."""
    feed = materialize(messages(spark, sf), "messages")
    first, last = feed.select(F.min(epoch_us("timestamp")), F.max(epoch_us("timestamp"))).first()
    once = feed.withColumn("_part", time_part("timestamp", first, last, 3))
    again = once.where("offset % 2 = 0").withColumn("_part", F.col("_part") + 1)
    base = scratch(spark, "bronze-tables")
    run_available(ingest.ingest_stream(in_parts(spark, once.unionByName(again), "messages", 4), base, scratch(spark, "bronze-checkpoint")))
    return base


@query("stream_ingest_bronze", events_sql(
    "SELECT target, CASE WHEN target = 'quarantine' THEN 'q' ELSE 'e' END || event_id AS id, event_timestamp::DATE::VARCHAR AS partition_date FROM sent", _INGESTED.strip()))
def stream_ingest_bronze(spark, sf):
    """Each message is stored once, in the table and the day it belongs to."""
    base = _ingested(spark, sf)
    part = lambda name, id: spark.read.parquet(f"{base}/{name}").select(F.lit(name).alias("target"), id.alias("id"), "partition_date")
    return part("orders", F.concat(F.lit("e"), "event_id")).unionByName(part("clicks", F.concat(F.lit("e"), "event_id"))).unionByName(
        part("quarantine", F.concat(F.lit("q"), F.col("offset").cast("string"))))


@query("stream_ingest_counts", events_sql("""
SELECT part::BIGINT AS batch_id, target, count(*) AS received, count(*) FILTER (WHERE NOT again) AS stored, count(*) FILTER (WHERE again) AS repeated
FROM (SELECT part, target, FALSE AS again FROM sent UNION ALL SELECT part + 1, target, TRUE FROM sent WHERE event_id % 2 = 0) GROUP BY 1, 2
UNION ALL SELECT 3, target, 0, 0, 0 FROM (SELECT DISTINCT target FROM sent) WHERE target NOT IN (SELECT target FROM sent WHERE part = 2 AND event_id % 2 = 0)""",
    _INGESTED.strip()))
def stream_ingest_counts(spark, sf):
    """What every batch received, stored and knew already, by target."""
    return ingest.ingest_counts(spark, _ingested(spark, sf)).read()


_SIMPLE = """concat('{"event_id":"e', event_id, '","order_id":', event_id, ',"user_id":', user_id, ',"amount":', cast(value * 100 as int),
  ',"restaurant":"', event_type, '","event_time":"', date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"), 'Z"}')"""


def _order_text(spark, sf):
    path = scratch(spark, "order-text")
    line = F.expr(f"case when event_id % 50 = 0 then '{{oops' else {_SIMPLE} end")
    table(spark, sf, "events").select(line.alias("value")).write.text(path)
    return path


@query("stream_parse_orders", """
SELECT 'e' || event_id AS event_id, user_id::INT AS user_id, event_type AS restaurant, date_trunc('second', ts) AS event_ts FROM events WHERE event_id % 50 <> 0""")
def stream_parse_orders(spark, sf):
    stream = read_events_stream(spark, {"path": _order_text(spark, sf)}, STREAM_ORDER)
    out = stream.withColumn("event_ts", F.try_to_timestamp("event_time"))
    return collected(spark, out, "orders").select("event_id", "user_id", "restaurant", "event_ts")


@query("stream_bronze_json", "SELECT event_type AS restaurant, count(*) AS n FROM events WHERE event_id % 50 <> 0 GROUP BY 1")
def stream_bronze_json(spark, sf):
    path = scratch(spark, "stream-bronze")
    parsed = ingest.parse_orders(spark.readStream.text(_order_text(spark, sf)))
    run_available(ingest.stream_to_bronze(parsed, path, scratch(spark, "stream-bronze-checkpoint")))
    return spark.read.schema(parsed.schema).json(path).groupBy("restaurant").agg(F.count(F.lit(1)).alias("n"))


@query("stream_silver_parquet", "SELECT event_type AS restaurant, count(*) AS n FROM events WHERE event_id % 50 <> 0 GROUP BY 1")
def stream_silver_parquet(spark, sf):
    path = scratch(spark, "stream-silver")
    parsed = ingest.parse_orders(spark.readStream.text(_order_text(spark, sf)))
    run_available(ingest.stream_to_silver(parsed, path, scratch(spark, "stream-silver-checkpoint"), REPLAY))
    return spark.read.parquet(path).groupBy("restaurant").agg(F.count(F.lit(1)).alias("n"))


@query("stream_gold_revenue", """
SELECT event_type AS restaurant, sum(trunc(value * 100))::BIGINT AS total_revenue FROM events WHERE event_id % 50 <> 0 GROUP BY 1""")
def stream_gold_revenue(spark, sf):
    path = scratch(spark, "stream-gold")
    parsed = ingest.parse_orders(spark.readStream.text(_order_text(spark, sf)))
    run_available(ingest.stream_gold(parsed, path, scratch(spark, "stream-gold-checkpoint")))
    return spark.read.parquet(path)
