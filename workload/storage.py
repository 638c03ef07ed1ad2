"""Sources and sinks: every query writes whole tables to the shared folder and reads them back."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tiffinlake.functions import text_fields, typed_fields
from tiffinlake.operators import catalog, delivery, fraud, health
from tiffinlake.plans import delivery_hourly
from tiffinlake.schemas import DELIVERY_CSV_COLUMNS, ORDER_EVENT
from tiffinlake.session import materialize, scratch
from tiffinlake.sources import bronze, files, tables

from .fraudwatch import _ALL, all_alerts, tx_sql
from .registry import query
from .views import (
    FOODS_SQL, bronze_orders, delivery_bronze, delivery_rows, delivery_silver, delivery_sql, events, events_sql, foods,
    good_orders, shop_orders, SHOP_SQL, table,
)


@query("csv_scan", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def csv_scan(spark, sf):
    customer = table(spark, sf, "customer")
    path = scratch(spark, "csv")
    customer.write.option("header", True).csv(path)
    return files.read_csv(spark, path, customer.schema)


@query("delivery_csv_scan", delivery_sql('SELECT "ID" AS id, nullif("Time_Orderd", \'\') AS ordered, "City" AS city, "Time_taken (min)" AS minutes FROM rows0'))
def delivery_csv_scan(spark, sf):
    path = scratch(spark, "delivery-csv")
    delivery_rows(spark, sf).select(*[f"`{c}`" for c in DELIVERY_CSV_COLUMNS]).write.option("header", True).option(
        "ignoreTrailingWhiteSpace", False).option("ignoreLeadingWhiteSpace", False).csv(path)
    return files.read_delivery_csv(spark, path).select(
        F.col("ID").alias("id"), F.col("Time_Orderd").alias("ordered"), F.col("City").alias("city"), F.col("`Time_taken (min)`").alias("minutes"))


@query("bronze_jsonl", delivery_sql("""
SELECT year(ingestion_time)::INT AS year, month(ingestion_time)::INT AS month, count(*) AS n, count(DISTINCT event_id) AS n_ids,
  count(*) FILTER (WHERE "City" = 'BUILDING') AS n_building FROM rows1 GROUP BY 1, 2"""))
def bronze_jsonl(spark, sf):
    """JSONL bronze by ingestion time. The folders here are days, not hours: the data spans seven years."""
    base = scratch(spark, "bronze")
    rows = files.with_hour(delivery_bronze(spark, sf).withColumn("t", F.to_timestamp("ingestion_time")), "t").drop("t")
    files.rebalanced(rows, ["year", "month"]).write.partitionBy("year", "month").options(**files.BRONZE_FILES).json(f"{base}/bronze")
    back = files.read_bronze(spark, base)
    return back.groupBy("year", "month").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("event_id").alias("n_ids"),
        F.count_if(F.col("payload.City") == "BUILDING").alias("n_building"))


@query("bronze_missing_hour", """
SELECT hour, count(e.event_id) AS n, count(e.event_id) = 0 AS is_gap
FROM (SELECT unnest(generate_series((SELECT date_trunc('day', min(ts)) FROM events), (SELECT date_trunc('day', max(ts)) FROM events) + INTERVAL 23 HOUR, INTERVAL 1 HOUR)) AS hour)
LEFT JOIN events e ON date_trunc('day', e.ts) + to_hours(hour(e.ts)::INT // 8 * 8) = hour GROUP BY 1""")
def bronze_missing_hour(spark, sf):
    """A layer whose hours are written every eighth only: one read of the whole range, and the hours without a folder."""
    base = scratch(spark, "hours")
    rows = table(spark, sf, "events").select(
        "event_id", (F.date_trunc("day", "ts") + F.make_dt_interval(F.lit(0), F.floor(F.hour("ts") / 8).cast("int") * 8)).cast("timestamp_ntz").alias("at"))
    files.write_bronze_jsonl(rows, base, "at")
    first, last = rows.select(F.date_trunc("day", F.min("at")), F.date_trunc("day", F.max("at"))).first()
    schema = T.StructType.fromDDL("event_id bigint, at timestamp_ntz")
    found, gaps = files.read_hours(spark, base, "bronze", first, last + dt.timedelta(hours=23), schema, "json")
    counted = found.groupBy(F.col("at").alias("hour")).agg(F.count("event_id").alias("n")).withColumn("is_gap", F.lit(False))
    return counted.unionByName(gaps.select("hour", F.lit(0).cast("bigint").alias("n"), F.lit(True).alias("is_gap")))


@query("bronze_one_hour", "SELECT event_id, ts FROM events WHERE date_trunc('hour', ts) = TIMESTAMP '2024-01-10 00:00:00'")
def bronze_one_hour(spark, sf):
    """Hour folders from the whole table, of which one is read."""
    base = scratch(spark, "hours")
    rows = table(spark, sf, "events").select("event_id", "ts")
    files.write_bronze_jsonl(rows, base, "ts")
    schema = T.StructType.fromDDL("event_id bigint, ts timestamp_ntz")
    return files.read_bronze(spark, base, dt.datetime(2024, 1, 10), schema=schema).select("event_id", "ts")


@query("silver_overwrite", delivery_sql("""
SELECT year(ingestion_time)::INT AS year, count(*) AS n, count(DISTINCT event_id) AS n_ids FROM latest GROUP BY 1"""))
def silver_overwrite(spark, sf):
    """Computed once and written twice; dynamic overwrite leaves one copy."""
    path = scratch(spark, "silver")
    silver = materialize(files.with_hour(delivery_silver(spark, sf), "ingestion_time").drop("month", "day", "hour"), "silver-rows")
    for _ in range(2):
        files.write_gold(silver, path, ["year"])
    back = spark.read.parquet(path)
    return back.groupBy("year").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("event_id").alias("n_ids"))


@query("silver_hours", "SELECT day(ts)::INT AS day, 0 AS hour, count(*) AS n FROM events GROUP BY 1")
def silver_hours(spark, sf):
    """Hour folders, written twice. Times are cut to the day, which keeps the number of folders small."""
    base = scratch(spark, "silver-hours")
    rows = table(spark, sf, "events").select("event_id", F.date_trunc("day", "ts").cast("timestamp_ntz").alias("ingestion_time"))
    for _ in range(2):
        files.write_silver(rows, base)
    back = files.read_silver(spark, base, rows.schema)
    return back.groupBy("day", "hour").agg(F.count(F.lit(1)).alias("n"))


@query("gold_partitions", delivery_sql("SELECT metric_type, count(*) AS n FROM (" + " UNION ALL ".join(
    f"SELECT DISTINCT '{name}' AS metric_type, {c}::VARCHAR AS v FROM silver WHERE data_quality_score >= 0.5"
    for name, c in delivery.KPI_DIMENSIONS.items()) + ") GROUP BY 1"))
def gold_partitions(spark, sf):
    path = scratch(spark, "gold")
    kpis = materialize(delivery.delivery_kpis(delivery_silver(spark, sf)), "kpis")
    for _ in range(2):
        files.write_gold(kpis, path, ["metric_type"])
    return spark.read.parquet(path).groupBy("metric_type").agg(F.count(F.lit(1)).alias("n"))


@query("gold_append", "SELECT event_type, 2 * count(*) AS n FROM events GROUP BY 1")
def gold_append(spark, sf):
    path = scratch(spark, "gold-append")
    rows = table(spark, sf, "events").select("event_id", "event_type")
    for _ in range(2):
        files.write_gold(rows, path, ["event_type"], mode="append")
    return spark.read.parquet(path).groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


@query("table_read_by_date", events_sql(
    "SELECT order_id, user_id, price::DOUBLE AS price FROM good_orders WHERE partition_date = DATE '2024-01-15'"))
def table_read_by_date(spark, sf):
    path = scratch(spark, "table")
    tables.write_table(good_orders(spark, sf), path, ["partition_date"])
    return tables.read_table(spark, path, "2024-01-15", ["order_id", "user_id", "price"])


@query("table_replace_partition", f"""
WITH {SHOP_SQL.strip()} SELECT status, count(*) AS n, sum(CASE WHEN status = 'F' THEN 0 ELSE price END)::DOUBLE AS value FROM shop GROUP BY 1""")
def table_replace_partition(spark, sf):
    """One status is deleted and inserted again with a zero price; the others stay."""
    path = scratch(spark, "replace")
    shop = shop_orders(spark, sf)
    tables.write_table(shop, path, ["status"])
    tables.replace_partition(shop.where("status = 'F'").withColumn("price", F.lit(0).cast("decimal(12,2)")), path, ["status"])
    return spark.read.parquet(path).groupBy("status").agg(F.count(F.lit(1)).alias("n"), F.sum("price").alias("value"))


@query("replace_empty_day", f"""
WITH {SHOP_SQL.strip()} SELECT status, count(*) AS n FROM shop WHERE status <> 'F' GROUP BY 1""")
def replace_empty_day(spark, sf):
    """One status is replaced by no rows at all; the others stay."""
    path = scratch(spark, "replace")
    shop = shop_orders(spark, sf)
    tables.write_table(shop, path, ["status"])
    tables.replace_partition(shop.where("status = 'F' and price < 0"), path, ["status"], [{"status": "F"}])
    return spark.read.parquet(path).groupBy("status").agg(F.count(F.lit(1)).alias("n"))


@query("replace_null_partition", f"""
WITH {SHOP_SQL.strip()} SELECT status AS kind, count(*) AS n FROM shop WHERE status = 'P' GROUP BY 1
UNION ALL SELECT 'new', count(*) FILTER (WHERE status = 'O') FROM shop""")
def replace_null_partition(spark, sf):
    """A null partition and one whose name must be escaped are replaced by nothing, in one write that brings a new partition."""
    path = scratch(spark, "replace")
    kind = F.when(F.col("status") == "O", "O: 1/2").when(F.col("status") == "P", "P").alias("kind")
    shop = shop_orders(spark, sf).select("order_id", "status", kind)
    tables.write_table(shop.drop("status"), path, ["kind"])
    moved = shop.where("status = 'O'").select("order_id", F.lit("new").alias("kind"))
    tables.replace_partition(moved, path, ["kind"], [{"kind": None}, {"kind": "O: 1/2"}])
    return spark.read.schema("order_id bigint, kind string").parquet(path).groupBy("kind").agg(F.count(F.lit(1)).alias("n"))


@query("hourly_job_empty_hour", delivery_sql("""
SELECT '00' AS hour, 'silver' AS layer, count(DISTINCT event_id) AS n FROM rows1 WHERE part_no % 2 = 0
UNION ALL SELECT '00', 'gold', 1"""))
def hourly_job_empty_hour(spark, sf):
    """Two hours are processed, then the bronze of one is withdrawn and its hour run again: nothing of it is left."""
    base = scratch(spark, "hourly")
    first, second = dt.datetime(2024, 1, 1, 0), dt.datetime(2024, 1, 1, 1)
    odd = F.col("payload.Vehicle_condition").cast("int") % 2 == 1  # the part's number, modulo four
    at = F.when(odd, F.lit(second)).otherwise(F.lit(first)).cast("timestamp_ntz")
    files.write_bronze_jsonl(delivery_bronze(spark, sf).withColumn("ingestion_time", at), base, hours=2)
    for hour in (first, second):
        delivery_hourly.run(spark, base, hour, second)
    files.delete_path(spark, files.partition_path(base, "bronze", 2024, 1, 1, 1))
    delivery_hourly.run(spark, base, second, second)
    silver = spark.read.parquet(f"{base}/silver").select(F.lit("silver").alias("layer"), F.lpad(F.col("hour").cast("string"), 2, "0").alias("hour"), F.lit(1).alias("n"))
    gold = spark.read.parquet(f"{base}/gold/hourly_summary").select(
        F.lit("gold").alias("layer"), F.lpad(F.col("hour").cast("string"), 2, "0").alias("hour"), F.lit(1).alias("n"))
    return silver.unionByName(gold).groupBy("hour", "layer").agg(F.sum("n").alias("n"))


@query("merge_upsert_text_partition", f"""
WITH {SHOP_SQL.strip()}
SELECT CASE status WHEN 'F' THEN '01' WHEN 'O' THEN '02' ELSE '10' END AS month, count(*) AS n, count(DISTINCT order_id) AS orders,
  sum(CASE WHEN status IN ('O', 'P') THEN 1 ELSE price END)::DOUBLE AS value FROM shop GROUP BY 1""")
def merge_upsert_text_partition(spark, sf):
    """Partitions named like 01 are text: an upsert finds their rows and keeps their names."""
    path = scratch(spark, "merge")
    month = F.when(F.col("status") == "F", "01").when(F.col("status") == "O", "02").otherwise("10").alias("month")
    old, new = (df.select("order_id", "price", month) for df in _merge_sides(spark, sf))
    tables.write_table(old, path, ["month"])
    tables.merge_upsert(new, path, ["order_id", "month"], ["month"])
    stored = spark.read.schema(old.schema).parquet(path)
    return stored.groupBy("month").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("order_id").alias("orders"), F.sum("price").alias("value"))


def _merge_sides(spark, sf):
    """An old and a new version of the orders that overlap in order status O."""
    shop = shop_orders(spark, sf).select("order_id", "user_id", "price", "status")
    old = shop.where("status in ('F', 'O')")
    new = shop.where("status in ('O', 'P')").withColumn("price", F.lit(1).cast("decimal(12,2)"))
    return old, new


@query("merge_insert", f"""
WITH {SHOP_SQL.strip()} SELECT order_id, user_id, status, (CASE WHEN status IN ('F', 'O') THEN price ELSE 1 END)::DOUBLE AS price FROM shop""")
def merge_insert(spark, sf):
    path = scratch(spark, "insert")
    old, new = _merge_sides(spark, sf)
    tables.write_table(old, path, ["status"])
    tables.merge_insert(new, path, ["order_id", "status"], ["status"])
    return spark.read.parquet(path).select("order_id", "user_id", "status", "price")


@query("merge_upsert", f"""
WITH {SHOP_SQL.strip()} SELECT order_id, user_id, status, (CASE WHEN status = 'F' THEN price ELSE 1 END)::DOUBLE AS price FROM shop""")
def merge_upsert(spark, sf):
    path = scratch(spark, "upsert")
    old, new = _merge_sides(spark, sf)
    tables.write_table(old, path, ["status"])
    tables.merge_upsert(new, path, ["order_id", "status"], ["status"])
    return spark.read.parquet(path).select("order_id", "user_id", "status", "price")


@query("append_idempotent", events_sql("SELECT partition_date::VARCHAR AS partition_date, count(*) AS n FROM ev WHERE event_type = 'order' GROUP BY 1"))
def append_idempotent(spark, sf):
    """A feed with repeats, delivered twice; each ingestion id is stored once."""
    path = scratch(spark, "idempotent")
    feed = bronze_orders(spark, sf).select("ingestion_id", "order_id", "price", "partition_date")
    for _ in range(2):
        tables.append_idempotent(feed, path, "ingestion_id", ["partition_date"])
    return spark.read.parquet(path).groupBy("partition_date").agg(F.count(F.lit(1)).alias("n"))


# --- bronze ingest ----------------------------------------------------------------------------

def messages(spark, sf):
    """Events as broker messages: orders, clicks, an unknown topic, and some broken JSON."""
    kind = F.col("event_type")
    topic = F.when(kind == "order", bronze.ORDERS_TOPIC).when(kind == "signup", "raw.other.v1").otherwise(bronze.CLICKS_TOPIC)
    stamp = F.date_format("event_timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    body = F.to_json(F.struct(
        F.col("event_id").cast("string").alias("event_id"), F.concat(stamp, F.lit("Z")).alias("timestamp"), "user_id", "item_name", "session_id",
        F.when(kind == "order", F.col("order_id")).alias("order_id"), F.when(kind == "order", F.col("price")).alias("price"),
        F.when(kind == "order", F.col("item_id")).alias("item_id"),
        F.when(kind != "order", kind).alias("event_type"), F.when(kind != "order", F.concat(F.lit("food_"), "item_id")).alias("ad_id")))
    return events(spark, sf).select(
        F.when(F.col("event_id") % 53 == 0, F.lit("{broken")).otherwise(body).alias("value"), topic.alias("topic"),
        (F.col("event_id") % 6).cast("int").alias("partition"), F.col("event_id").alias("offset"),
        F.col("event_timestamp").cast("timestamp").alias("timestamp"))


@query("ingest_bronze_orders", events_sql("""
SELECT event_id::VARCHAR AS event_id, order_id, user_id, item_id, item_name, price::DOUBLE AS price, 'confirmed' AS status, event_timestamp,
  'order' AS event_type, 'raw.orders.v1-' || (event_id % 6) || '-' || event_id AS ingestion_id, partition_date::VARCHAR AS partition_date
FROM ev WHERE event_type = 'order' AND event_id % 53 <> 0"""))
def ingest_bronze_orders(spark, sf):
    return bronze.ingest_bronze(messages(spark, sf))["orders"].select(
        "event_id", "order_id", "user_id", "item_id", "item_name", "price", "status", "event_timestamp", "event_type",
        "ingestion_id", "partition_date")


@query("ingest_bronze_clicks", events_sql("""
SELECT event_id::VARCHAR AS event_id, user_id, event_type, item_id, session_id, event_timestamp,
  'raw.clicks.v1-' || (event_id % 6) || '-' || event_id AS ingestion_id, (event_id % 6)::INT AS kafka_partition, event_id AS kafka_offset
FROM ev WHERE event_type NOT IN ('order', 'signup') AND event_id % 53 <> 0"""))
def ingest_bronze_clicks(spark, sf):
    return bronze.ingest_bronze(messages(spark, sf))["clicks"].select(
        "event_id", "user_id", "event_type", "item_id", "session_id", "event_timestamp", "ingestion_id",
        "kafka_partition", "kafka_offset")


@query("ingest_bronze_quarantine", events_sql("""
SELECT event_id AS "offset", CASE WHEN event_type = 'signup' THEN 'unknown_topic' ELSE 'invalid_json' END AS reason
FROM ev WHERE event_type = 'signup' OR event_id % 53 = 0"""))
def ingest_bronze_quarantine(spark, sf):
    return bronze.ingest_bronze(messages(spark, sf))["quarantine"].select("offset", "reason")


def mixed_messages(spark, sf):
    """Order messages whose producers disagree on types: ids and prices as numbers or text, metadata as object or text, some garbage."""
    n = F.col("event_id")
    meta = F.to_json(F.struct(F.col("item_name").alias("category")))
    quoted = F.concat(F.lit('"'), F.replace(meta, F.lit('"'), F.lit('\\"')), F.lit('"'))
    order = F.expr("""concat('{"event_id":"', event_id, '","timestamp":"2024-02-01T00:00:00Z","order_id":"', coalesce(order_id, ''), '","user_id":',
      coalesce(case event_id % 4 when 0 then cast(user_id as string) when 1 then concat('"', user_id, '"') when 2 then concat(user_id, '.0') end, 'null'),
      ',"quantity":', if(event_id % 7 = 0, '"x"', '2'), ',"price":',
      case event_id % 5 when 0 then '"12.50"' when 1 then '12.5' when 2 then '"cheap"' else '1e1' end, ',"metadata":')""")
    return events(spark, sf).where("event_type = 'order'").select(
        F.concat(order, F.when(n % 3 == 0, meta).when(n % 3 == 1, quoted).otherwise(F.lit('"none"')), F.lit("}")).alias("value"),
        F.lit(bronze.ORDERS_TOPIC).alias("topic"), F.lit(0).alias("partition"), n.alias("offset"), F.col("event_timestamp").cast("timestamp").alias("timestamp"))


@query("ingest_bronze_mixed_types", events_sql("""
SELECT event_id AS "offset", CASE WHEN event_id % 7 = 0 OR event_id % 5 = 2 THEN 'invalid_type' ELSE 'orders' END AS target,
  CASE WHEN event_id % 7 <> 0 AND event_id % 5 <> 2 AND event_id % 4 <> 3 THEN user_id END AS user_id,
  CASE WHEN event_id % 7 = 0 OR event_id % 5 = 2 THEN NULL WHEN event_id % 5 < 2 THEN 12.5 ELSE 10.0 END::DOUBLE AS price
FROM ev WHERE event_type = 'order'"""))
def ingest_bronze_mixed_types(spark, sf):
    """Every order is stored with its values or kept in quarantine; none becomes null on the way."""
    out = bronze.ingest_bronze(mixed_messages(spark, sf))
    stored = out["orders"].select(F.col("kafka_offset").alias("offset"), F.lit("orders").alias("target"), "user_id", F.col("price").cast("double").alias("price"))
    held = out["quarantine"].select("offset", F.col("reason").alias("target"))
    return stored.unionByName(held, allowMissingColumns=True)


@query("metadata_text_or_object", events_sql("""
SELECT event_id::VARCHAR AS event_id, CASE WHEN event_id % 3 < 2 THEN item_name END AS category FROM ev WHERE event_type = 'order'"""))
def metadata_text_or_object(spark, sf):
    """Metadata arrives as an object or as a string that holds one; other strings hold nothing."""
    sent = mixed_messages(spark, sf).select(F.from_json("value", text_fields(ORDER_EVENT)).alias("sent"))
    return catalog.order_to_behavior(sent.select(*typed_fields("sent", ORDER_EVENT))).select("event_id", "category")


@query("dimension_reload", "WITH " + FOODS_SQL.strip() + " SELECT food_id, name, category, price::DOUBLE AS price, is_available FROM foods")
def dimension_reload(spark, sf):
    source, target = scratch(spark, "foods-json"), scratch(spark, "foods")
    menu = foods(spark, sf)
    menu.write.json(source)
    for _ in range(2):
        out = files.load_dimension(spark, source, menu.drop("description").schema, target, multi_line=False)
    return out


@query("alert_store", tx_sql("SELECT * REPLACE (epoch_us(detected_at) // 1000 AS detected_at) FROM alerts", _ALL))
def alert_store(spark, sf):
    path = scratch(spark, "alerts")
    tables.write_table(fraud.alert_records(all_alerts(spark, sf)), path)
    back = spark.read.parquet(path)
    stored = F.from_json("alert_data", "alert_type string, event_id string")
    return back.where((stored["event_id"] == F.col("event_id")) & (stored["alert_type"] == F.col("alert_type"))).drop("alert_data")


@query("raw_user_documents", """
SELECT c_name || ' ' || c_mktsegment AS name, c_name || '@example.com' AS email, n_name AS country, TIMESTAMP '2024-02-01 00:00:00' AS ingested_at,
  '2024-02-01' AS dt, 'run-2' AS run_id FROM customer JOIN nation ON c_nationkey = n_nationkey""")
def raw_user_documents(spark, sf):
    """Customers as API documents, landed twice under one run id, then flattened."""
    customer = table(spark, sf, "customer").join(table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    user = F.struct(
        F.struct(F.col("c_name").alias("first"), F.col("c_mktsegment").alias("last")).alias("name"),
        F.concat("c_name", F.lit("@example.com")).alias("email"), F.struct(F.col("n_name").alias("country")).alias("location"))
    documents = customer.select(F.to_json(F.struct(F.array(user).alias("results"))).alias("value"))
    base, day, run = scratch(spark, "users"), dt.date(2024, 2, 1), "run-2"
    for _ in range(2):
        files.land_raw(documents, base, day, run)
    landed = spark.read.parquet(base)
    parsed = landed.select(F.from_json("value", "results array<struct<name: struct<first: string, last: string>, email: string, location: struct<country: string>>>").alias("d"), "dt", "run_id")
    flat = files.flatten_users(parsed.select("d.*"), dt.datetime(2024, 2, 1))
    return flat.select("*", F.lit(str(day)).alias("dt"), F.lit(run).alias("run_id"))


@query("partition_values_of_paths", "SELECT o_orderstatus AS status, count(*) AS n FROM orders GROUP BY 1")
def partition_values_of_paths(spark, sf):
    """Partition values recovered from file paths instead of partition discovery."""
    from tiffinlake.functions import split_key_values

    path = scratch(spark, "paths")
    table(spark, sf, "orders").select("o_orderkey", F.col("o_orderstatus").alias("status")).write.partitionBy("status").parquet(path)
    back = spark.read.option("recursiveFileLookup", True).parquet(path)
    return back.select(split_key_values(F.col("_metadata.file_path"), ["status"])["status"].alias("status")).groupBy("status").agg(
        F.count(F.lit(1)).alias("n"))


@query("tables_present", "SELECT 'shop_' || n_nationkey AS table_name, n_nationkey % 3 = 0 AS is_present FROM nation")
def tables_present(spark, sf):
    """A view for every third nation, holding its customers; asked for all nations."""
    names = table(spark, sf, "nation").select(F.concat(F.lit("shop_"), F.col("n_nationkey").cast("string")).alias("table_name"), "n_nationkey")
    for row in names.where("n_nationkey % 3 = 0").collect():  # one view each
        table(spark, sf, "customer").where(F.col("c_nationkey") == row["n_nationkey"]).createOrReplaceTempView(row["table_name"])
    return health.tables_present(spark, names.select("table_name"))
