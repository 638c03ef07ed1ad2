"""Parsing, cleaning, validation and deduplication."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tiffinlake.functions import item_from_ad, item_of_click, parse_iso_ts, raw_field, safe_double, safe_int
from tiffinlake.operators import catalog, dedup, delivery, joins, validation
from tiffinlake.operators.aggregates import partition_dates

from .registry import query
from .views import (
    FOODS_SQL, bronze_clicks, bronze_orders, delivered, delivery_bronze, delivery_rows, delivery_silver, delivery_sql,
    events, events_sql, foods, silver_clicks, silver_orders, table,
)


@query("drop_incomplete", events_sql("SELECT event_id, user_id, item_id FROM delivered WHERE user_id IS NOT NULL AND item_id IS NOT NULL"))
def drop_incomplete(spark, sf):
    return validation.drop_incomplete(delivered(spark, sf), ["user_id", "item_id"]).select("event_id", "user_id", "item_id")


@query("filter_project", "SELECT c_custkey, c_name, c_acctbal FROM customer WHERE c_acctbal > 5000")
def filter_project(spark, sf):
    return joins.reduce_early(table(spark, sf, "customer"), F.col("c_acctbal") > 5000, ["c_custkey", "c_name", "c_acctbal"])


SAFE_TEXT = """concat(case k % 8 when 0 then 'NaN' when 1 then ' ' when 2 then 'null' when 3 then cast(k as string)
  when 4 then concat(' ', k, ' ') when 5 then concat(k, '.0') when 6 then concat('conditions ', k) else concat(k, '.7') end)"""


@query("safe_casts", events_sql("""
SELECT event_id,
  CASE WHEN k % 8 IN (3, 4, 5, 7) THEN CAST(k AS INT) END AS as_int,
  CASE WHEN k % 8 IN (3, 4, 5) THEN CAST(k AS DOUBLE) WHEN k % 8 = 7 THEN k + 0.7::DOUBLE END AS as_double
FROM ev0"""))
def safe_casts(spark, sf):
    k = F.get_json_object("props", "$.k").cast("bigint")
    raw = table(spark, sf, "events").select("event_id", k.alias("k")).select("event_id", F.expr(SAFE_TEXT).alias("x"))
    return raw.select("event_id", safe_int("x").alias("as_int"), safe_double("x").alias("as_double"))


@query("iso_timestamps", """
SELECT event_id, CASE event_id % 4 WHEN 0 THEN date_trunc('second', ts) WHEN 1 THEN ts
  WHEN 2 THEN date_trunc('second', ts) - INTERVAL '5 hours 30 minutes' END AS parsed
FROM events""")
def iso_timestamps(spark, sf):
    seconds = "date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss\")"
    raw = table(spark, sf, "events").select("event_id", F.expr(f"""
        case event_id % 4 when 0 then concat({seconds}, 'Z')
          when 1 then date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
          when 2 then concat({seconds}, '+05:30') else 'bad' end""").alias("x"))
    return raw.select("event_id", parse_iso_ts("x").alias("parsed"))


@query("event_envelope", delivery_sql("""
SELECT event_id || '_20260204103000123456' AS event_id, strftime(event_time, '%Y-%m-%dT%H:%M:%S') AS event_time,
  '2026-02-04T10:30:00.123456' AS ingestion_time, "ID" AS order_id, "City" AS city FROM rows1"""))
def event_envelope(spark, sf):
    ingest = dt.datetime(2026, 2, 4, 10, 30, 0, 123456)
    return delivery.build_events(delivery_rows(spark, sf), ingest).select(
        "event_id", "event_time", "ingestion_time", F.col("payload.ID").alias("order_id"), F.col("payload.City").alias("city"))


@query("delivery_silver", delivery_sql("SELECT * EXCLUDE (located, timed) FROM silver"))
def delivery_silver_rows(spark, sf):
    return delivery_silver(spark, sf)


@query("quality_summary", delivery_sql("SELECT data_quality_score, count(*) AS n FROM silver GROUP BY 1"))
def quality_summary(spark, sf):
    return delivery.quality_summary(delivery_silver(spark, sf))


_KPI = """count(*) AS total_deliveries, round(sum(delivery_time_minutes) / count(delivery_time_minutes)::DOUBLE, 2) AS avg_delivery_time,
  min(delivery_time_minutes) AS min_delivery_time, max(delivery_time_minutes) AS max_delivery_time,
  round(sum(CAST(delivery_person_rating AS DECIMAL(6,2)))::DOUBLE / count(delivery_person_rating), 2) AS avg_rating,
  round(count(*) FILTER (WHERE is_valid_delivery_time) / count(*)::DOUBLE * 100, 2) AS success_rate_pct"""


@query("delivery_kpis", delivery_sql(" UNION ALL ".join(
    f"SELECT '{name}' AS metric_type, {c} AS dim_value, {_KPI} FROM silver WHERE data_quality_score >= 0.5 GROUP BY {c}"
    for name, c in delivery.KPI_DIMENSIONS.items())))
def delivery_kpis(spark, sf):
    return delivery.delivery_kpis(delivery_silver(spark, sf))


@query("delivery_kpis_valid_only", delivery_sql(" UNION ALL ".join(
    f"""SELECT '{name}' AS metric_type, {c} AS dim_value, count(*) AS total_deliveries,
    round(avg(delivery_time_minutes), 6) AS avg_delivery_time, min(delivery_time_minutes) AS min_delivery_time,
    max(delivery_time_minutes) AS max_delivery_time, round(avg(delivery_person_rating), 6) AS avg_rating
    FROM silver WHERE is_valid_delivery_time GROUP BY {c}"""
    for name, c in [("by_city", "city"), ("by_vehicle", "vehicle_type")])))
def delivery_kpis_valid_only(spark, sf):
    out = delivery.delivery_kpis(delivery_silver(spark, sf), {"by_city": "city", "by_vehicle": "vehicle_type"}, "valid_only")
    return out.drop("success_rate_pct").withColumns({
        "avg_delivery_time": F.round("avg_delivery_time", 6), "avg_rating": F.round("avg_rating", 6)})


@query("hourly_summary", delivery_sql("""
SELECT CAST(date_trunc('hour', ingestion_time) AS TIMESTAMP) AS ingestion_hour, count(*) AS total_deliveries,
  round(sum(delivery_time_minutes) / count(delivery_time_minutes)::DOUBLE, 2) AS avg_delivery_time,
  ((2 * sum(CAST(round(delivery_person_rating * 100) AS BIGINT)) + count(delivery_person_rating))
    // (2 * count(delivery_person_rating))) / 100.0::DOUBLE AS avg_rating,
  count(*) FILTER (WHERE is_festival = 'Yes') AS festival_deliveries,
  count(*) FILTER (WHERE multiple_deliveries > 1) AS multi_delivery_count
FROM silver WHERE data_quality_score >= 0.5 GROUP BY 1"""))
def hourly_summary(spark, sf):
    silver = delivery_silver(spark, sf).withColumn("ingestion_hour", F.date_trunc("hour", "ingestion_time"))
    # Ratings have two digits; decimals keep their sum exact.
    return delivery.hourly_summary(
        silver.withColumn("delivery_person_rating", F.col("delivery_person_rating").cast("decimal(6,2)")), ["ingestion_hour"]
    ).withColumn("avg_rating", F.col("avg_rating").cast("double"))


@query("dedup_delivery_events", delivery_sql('SELECT event_id, ingestion_time, "City" AS city, "Time_taken (min)" AS minutes FROM latest'))
def dedup_delivery_events(spark, sf):
    out = dedup.dedup_latest(delivery_bronze(spark, sf), ["event_id"], ["ingestion_time"], task_rows=dedup.TASK_ROWS)
    return out.select("event_id", F.to_timestamp("ingestion_time").alias("ingestion_time"),
                      F.col("payload.City").alias("city"), F.col("payload")["Time_taken (min)"].alias("minutes"))


@query("dedup_report", delivery_sql("""
SELECT count(*) AS rows_before, count(DISTINCT event_id) AS rows_after, count(*) - count(DISTINCT event_id) AS duplicates FROM rows1"""))
def dedup_report(spark, sf):
    return dedup.dedup_report(delivery_bronze(spark, sf), ["event_id"])


@query("dedup_orders", events_sql("SELECT ingestion_id, event_id, user_id, price, event_timestamp FROM silver_orders"))
def dedup_orders(spark, sf):
    out = dedup.dedup_latest(bronze_orders(spark, sf), ["ingestion_id"], ["event_timestamp"])
    return out.select("ingestion_id", "event_id", "user_id", "price", "event_timestamp")


@query("flag_duplicates", events_sql("""
SELECT event_id, order_id, event_timestamp, row_number() OVER (PARTITION BY order_id ORDER BY event_timestamp) > 1 AS is_duplicate
FROM bronze_orders"""))
def flag_duplicates(spark, sf):
    rows = bronze_orders(spark, sf).select("event_id", "order_id", "event_timestamp")
    return dedup.flag_duplicates(rows, ["order_id"], ["event_timestamp"])


@query("flag_duplicate_copies", """
SELECT l_orderkey, l_returnflag, is_duplicate FROM (
  SELECT l_orderkey, l_returnflag, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_returnflag) > 1 AS is_duplicate FROM lineitem)""")
def flag_duplicate_copies(spark, sf):
    rows = table(spark, sf, "lineitem").select("l_orderkey", "l_returnflag")
    return dedup.flag_duplicates(rows, ["l_orderkey"], ["l_returnflag"])


@query("dimension_couriers", delivery_sql("""
SELECT "Delivery_person_ID" AS courier, "Delivery_person_Age" AS age, "Delivery_person_Ratings" AS rating FROM rows1
QUALIFY row_number() OVER (PARTITION BY "Delivery_person_ID" ORDER BY "Delivery_person_Age" DESC, "Delivery_person_Ratings" DESC) = 1"""))
def dimension_couriers(spark, sf):
    rows = delivery_rows(spark, sf).select(
        F.col("Delivery_person_ID").alias("courier"), F.col("Delivery_person_Age").alias("age"),
        F.col("Delivery_person_Ratings").alias("rating"))
    return dedup.dimension(rows, "courier", ["age", "rating"])


_ORDER_ERRORS = {
    "full": """CASE WHEN user_id IS NULL THEN 'Missing USER_ID' WHEN item_id IS NULL THEN 'Missing ITEM_ID'
               WHEN NOT coalesce(price > 0, FALSE) THEN 'Invalid PRICE' END""",
    "lake": """CASE WHEN user_id IS NULL THEN 'Missing USER_ID' WHEN NOT coalesce(price > 0, FALSE) THEN 'Invalid PRICE' END""",
    "warehouse": """CASE WHEN NOT coalesce(price > 0, FALSE) THEN 'price_invalid' WHEN user_id IS NULL THEN 'user_id_null'
               WHEN item_id IS NULL THEN 'item_id_null' END""",
}
_CLICK_ERRORS = {
    "lake": "CASE WHEN user_id IS NULL THEN 'Missing USER_ID' WHEN item_id IS NULL THEN 'hover_impression_noise' END",
    "warehouse": """CASE WHEN user_id IS NULL THEN 'user_id_null'
               WHEN event_type NOT IN ('click', 'impression') THEN 'unknown_event_type' END""",
}

for _profile, _sql in _ORDER_ERRORS.items():
    def _orders(spark, sf, profile=_profile):
        rows = bronze_orders(spark, sf)
        return validation.validate_orders(rows, profile).select("event_id", "event_timestamp", "is_valid", "validation_errors")

    query(f"validate_orders_{_profile}", events_sql(
        f"SELECT event_id, event_timestamp, ({_sql}) IS NULL AS is_valid, {_sql} AS validation_errors FROM bronze_orders"))(_orders)

_NULL_ITEM = "CASE WHEN event_id % 9 <> 0 THEN item_id END"

for _profile, _sql in _CLICK_ERRORS.items():
    def _clicks(spark, sf, profile=_profile):
        rows = bronze_clicks(spark, sf).withColumn("item_id", F.expr(_NULL_ITEM))
        return validation.validate_clicks(rows, profile).select("event_id", "event_timestamp", "is_valid", "validation_errors")

    query(f"validate_clicks_{_profile}", events_sql(
        f"SELECT event_id, event_timestamp, ({_sql}) IS NULL AS is_valid, {_sql} AS validation_errors "
        f"FROM (SELECT * REPLACE ({_NULL_ITEM} AS item_id) FROM bronze_clicks)"))(_clicks)


@query("validity_report", events_sql("""
SELECT count(*) AS total, count(*) FILTER (WHERE user_id IS NOT NULL AND price > 0) AS valid,
  count(*) FILTER (WHERE NOT (user_id IS NOT NULL AND price > 0)) AS invalid FROM silver_orders"""))
def validity_report(spark, sf):
    return dedup.validity_report(silver_orders(spark, sf))


_BEHAVIOR = """event_type, CASE WHEN user_id IS NULL THEN NULL WHEN event_id % 31 = 0 THEN -user_id ELSE user_id END AS user_id,
  item_id, event_id"""


@query("contract_quarantine", events_sql(f"""
SELECT event_id, concat_ws(';', CASE WHEN event_type NOT IN ('view', 'impression', 'click', 'order') THEN 'unknown event_type' END,
  CASE WHEN user_id <= 0 THEN 'user_id must be > 0' END, CASE WHEN item_id <= 0 THEN 'item_id must be > 0' END) AS violations
FROM (SELECT {_BEHAVIOR} FROM ev)
WHERE event_type NOT IN ('view', 'impression', 'click', 'order') OR user_id <= 0 OR item_id <= 0"""))
def contract_quarantine(spark, sf):
    rows = events(spark, sf).selectExpr(*[c.strip() for c in _BEHAVIOR.replace("\n", " ").split(", ")])
    _, bad = validation.check_contract(rows, "behavior")
    return bad.select("event_id", F.concat_ws(";", "violations").alias("violations"))


@query("contract_accepted", events_sql(f"""
SELECT event_id, user_id, item_id FROM (SELECT {_BEHAVIOR} FROM ev)
WHERE event_type IN ('view', 'impression', 'click', 'order') AND (user_id IS NULL OR user_id > 0) AND item_id > 0"""))
def contract_accepted(spark, sf):
    rows = events(spark, sf).selectExpr(*[c.strip() for c in _BEHAVIOR.replace("\n", " ").split(", ")])
    good, _ = validation.check_contract(rows, "behavior")
    return good.select("event_id", "user_id", "item_id")


@query("silver_lineage", events_sql("""
SELECT event_id, partition_date::VARCHAR AS partition_date, 'bronze_orders' AS source_table,
  TIMESTAMP '2024-02-01 00:00:00' AS load_timestamp, 'v1.0' AS processing_version FROM silver_orders"""))
def silver_lineage(spark, sf):
    rows = validation.with_partition_date(silver_orders(spark, sf))
    out = validation.with_lineage(rows, "bronze_orders", dt.datetime(2024, 2, 1))
    return out.select("event_id", "partition_date", "source_table", "load_timestamp", "processing_version")


@query("partition_dates", events_sql("""
SELECT DISTINCT partition_date::VARCHAR AS partition_date FROM
(SELECT partition_date FROM bronze_orders UNION SELECT partition_date FROM bronze_clicks)"""))
def all_partition_dates(spark, sf):
    return partition_dates(bronze_orders(spark, sf), bronze_clicks(spark, sf))


@query("raw_event_fields", "SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, CAST(NULL AS VARCHAR) AS absent FROM events")
def raw_event_fields(spark, sf):
    return table(spark, sf, "events").select(
        "event_id", raw_field("props", "$.k", "bigint").alias("k"), raw_field("props", "$.nothing").alias("absent"))


@query("item_of_ad", events_sql("""
SELECT event_id, CASE WHEN event_id % 3 < 2 THEN k END AS from_ad, CASE WHEN event_id % 4 = 0 THEN item_id WHEN event_id % 3 < 2 THEN k END AS item
FROM (SELECT ev.event_id, ev0.k, ev.item_id FROM ev JOIN ev0 USING (event_id))"""))
def item_of_ad(spark, sf):
    ad = F.expr("case event_id % 3 when 0 then concat('food_', device_id) when 1 then cast(device_id as string) else concat('ad_', device_id) end")
    rows = events(spark, sf).select("event_id", ad.alias("ad_id"), F.expr("case when event_id % 4 = 0 then item_id end").alias("item_id"))
    return rows.select("event_id", item_from_ad("ad_id").alias("from_ad"), item_of_click("item_id", "ad_id").alias("item"))


@query("orders_to_behavior", events_sql("""
SELECT event_id::VARCHAR AS event_id, 'order' AS event_type, user_id, item_id, category, session_id, 'order' AS source_page, order_id,
  price::DOUBLE AS price FROM ev WHERE event_type = 'order'"""))
def orders_to_behavior(spark, sf):
    rows = events(spark, sf).where("event_type = 'order'").select(
        F.col("event_id").cast("string").alias("event_id"), F.col("event_timestamp").cast("string").alias("timestamp"), "user_id", "item_id", "order_id", "price",
        F.create_map(F.lit("category"), "category", F.lit("session_id"), "session_id").alias("metadata"))
    return catalog.order_to_behavior(rows).select(
        "event_id", "event_type", "user_id", "item_id", "category", "session_id", "source_page",
        F.col("metadata")["order_id"].alias("order_id"), F.col("metadata")["price"].cast("double").alias("price"))


@query("clicks_to_behavior", events_sql("""
SELECT event_id, event_type, user_id, device_id AS item_id, category, session_id FROM ev
WHERE event_type IN ('click', 'impression') AND event_id % 3 < 2 AND device_id > 0"""))
def clicks_to_behavior(spark, sf):
    ad = F.expr("case event_id % 3 when 0 then concat('food_', device_id) when 1 then cast(device_id as string) else concat('ad_', device_id) end")
    rows = events(spark, sf).where("event_type in ('click', 'impression')").select(
        "event_id", (F.col("event_type") == "click").alias("is_click"), F.col("event_timestamp").alias("timestamp"), "user_id",
        F.lit(None).cast("bigint").alias("item_id"), ad.alias("ad_id"), F.lit("camp").alias("ad_campaign_id"), "session_id",
        F.create_map(F.lit("category"), "category").alias("metadata"))
    return catalog.click_to_behavior(rows).select("event_id", "event_type", "user_id", "item_id", "category", "session_id")


@query("catalog_category", "WITH " + FOODS_SQL.strip() + """
SELECT food_id, name, category, price::DOUBLE AS price FROM foods WHERE is_available AND category = (SELECT min(p_type) FROM part)""")
def catalog_category(spark, sf):
    menu = foods(spark, sf)
    first = menu.agg(F.min("category")).scalar()
    return catalog.catalog(menu).where(F.col("category") == first).orderBy("food_id").select("food_id", "name", "category", "price")


@query("catalog_available", "WITH " + FOODS_SQL.strip() + " SELECT food_id, name, category, price::DOUBLE AS price FROM foods WHERE is_available")
def catalog_available(spark, sf):
    return catalog.catalog(foods(spark, sf)).select("food_id", "name", "category", "price")


@query("catalog_item", "WITH " + FOODS_SQL.strip() + " SELECT food_id, name, category, price::DOUBLE AS price, is_available FROM foods WHERE food_id = 42")
def catalog_item(spark, sf):
    return catalog.catalog_item(foods(spark, sf), 42).select("food_id", "name", "category", "price", "is_available")


@query("catalog_categories", "SELECT DISTINCT p_type AS category FROM part")
def catalog_categories(spark, sf):
    return catalog.categories(foods(spark, sf))


@query("enrich_silver_orders", events_sql("""
SELECT s.event_id, s.item_id, f.category AS enriched_category, f.description AS enriched_description, f.minutes AS enriched_preparation_time
FROM silver_orders s LEFT JOIN (SELECT *, p_size AS minutes FROM foods JOIN part ON p_partkey = food_id) f ON s.item_id = f.food_id""", FOODS_SQL.strip()))
def enrich_silver_orders(spark, sf):
    minutes = table(spark, sf, "part").select(F.col("p_partkey").alias("food_id"), F.col("p_size").alias("preparation_time"))
    return catalog.enrich_orders(silver_orders(spark, sf), foods(spark, sf).join(minutes, "food_id")).select(
        "event_id", "item_id", "enriched_category", "enriched_description", "enriched_preparation_time")
