"""The library's inputs, derived from the given tables; and the same derivations as SQL text.

The given ``events`` hold no nulls, duplicates or invalid values. The derivation adds them at fixed
places of the whole table (a missing user, a zero price, a second delivery one second later), so
that cleaning rules have something to clean. No row is left out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tiffinlake.schemas import DELIVERY_CSV_COLUMNS


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --- behaviour events -------------------------------------------------------------------------

def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per event, canonical names, with missing users and zero prices."""
    k = F.get_json_object("props", "$.k").cast("bigint")
    kinds = {"view": "impression", "purchase": "order"}
    kind = F.coalesce(*[F.when(F.col("event_type") == a, b) for a, b in kinds.items()], F.col("event_type"))
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.concat(F.lit("o"), F.col("event_id")).alias("order_id"),
        F.concat_ws("-", F.lit("events"), (F.col("event_id") % 6).cast("string"), F.col("event_id").cast("string")).alias("ingestion_id"),
        F.when(F.col("event_id") % 97 != 0, F.col("user_id")).alias("user_id"),
        kind.alias("event_type"),
        (k % 10).alias("item_id"),
        F.concat(F.lit("item "), (k % 10).cast("string"), F.when(F.col("event_id") % 2 == 0, "").otherwise("*")).alias("item_name"),
        F.concat(F.lit("c"), (k % 5).cast("string")).alias("category"),
        F.element_at(F.array(F.lit("Bangalore"), F.lit("Mumbai"), F.lit("Delhi")), (k % 3 + 1).cast("int")).alias("city"),
        k.alias("device_id"),
        F.when(F.col("event_id") % 101 == 0, F.lit(0)).otherwise(F.col("value")).cast("decimal(12,2)").alias("price"),
        F.concat(F.lit("s"), F.col("user_id").cast("string"), F.lit("-"),
                 F.floor(F.hour("ts") / 6).cast("string")).alias("session_id"),
        F.col("ts").alias("event_timestamp"),
        F.to_date("ts").alias("partition_date"),
    )


def delivered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as a broker delivers them: every tenth arrives again a second later."""
    once = events(spark, sf_dir)
    again = once.where("event_id % 10 = 0").withColumn(
        "event_timestamp", F.col("event_timestamp") + F.expr("interval 1 second"))
    return once.unionByName(again)


def bronze_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return delivered(spark, sf_dir).where("event_type = 'order'")


def bronze_clicks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Everything that is not an order; sign-ups and errors are the feed's unknown types."""
    return delivered(spark, sf_dir).where("event_type <> 'order'")


def silver_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tiffinlake.operators.dedup import dedup_latest
    from tiffinlake.operators.validation import validate_orders

    return validate_orders(dedup_latest(bronze_orders(spark, sf_dir), ["ingestion_id"], ["event_timestamp"]))


def silver_clicks(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tiffinlake.operators.dedup import dedup_latest
    from tiffinlake.operators.validation import validate_clicks

    return validate_clicks(
        dedup_latest(bronze_clicks(spark, sf_dir), ["ingestion_id"], ["event_timestamp"]), "warehouse")


def good_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver_orders(spark, sf_dir).where("is_valid")


def good_clicks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver_clicks(spark, sf_dir).where("is_valid")


EVENTS_SQL = """
ev0 AS (SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events),
ev AS (
  SELECT event_id, 'o' || event_id AS order_id, 'events-' || (event_id % 6) || '-' || event_id AS ingestion_id,
         CASE WHEN event_id % 97 <> 0 THEN user_id END AS user_id,
         CASE event_type WHEN 'view' THEN 'impression' WHEN 'purchase' THEN 'order' ELSE event_type END AS event_type,
         k % 10 AS item_id,
         'item ' || (k % 10) || CASE WHEN event_id % 2 = 0 THEN '' ELSE '*' END AS item_name,
         'c' || (k % 5) AS category,
         CASE k % 3 WHEN 0 THEN 'Bangalore' WHEN 1 THEN 'Mumbai' ELSE 'Delhi' END AS city,
         k AS device_id,
         CAST(CASE WHEN event_id % 101 = 0 THEN 0 ELSE value END AS DECIMAL(12,2)) AS price,
         's' || user_id || '-' || (hour(ts) // 6) AS session_id,
         ts AS event_timestamp, CAST(ts AS DATE) AS partition_date
  FROM ev0
),
delivered AS (
  SELECT * FROM ev
  UNION ALL
  SELECT * REPLACE (event_timestamp + INTERVAL 1 SECOND AS event_timestamp) FROM ev WHERE event_id % 10 = 0
),
bronze_orders AS (SELECT * FROM delivered WHERE event_type = 'order'),
bronze_clicks AS (SELECT * FROM delivered WHERE event_type <> 'order'),
silver_orders AS (
  SELECT * FROM bronze_orders QUALIFY row_number() OVER (PARTITION BY ingestion_id ORDER BY event_timestamp DESC) = 1
),
silver_clicks AS (
  SELECT * FROM bronze_clicks QUALIFY row_number() OVER (PARTITION BY ingestion_id ORDER BY event_timestamp DESC) = 1
),
good_orders AS (SELECT * FROM silver_orders WHERE user_id IS NOT NULL AND price > 0),
good_clicks AS (SELECT * FROM silver_clicks WHERE user_id IS NOT NULL AND event_type IN ('click', 'impression'))
"""


def events_sql(body: str, *ctes: str) -> str:
    return "WITH " + ",\n".join([EVENTS_SQL.strip(), *ctes]) + "\n" + body


# --- fraud transactions -----------------------------------------------------------------------

def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events(spark, sf_dir).select(
        "event_id", "user_id", "device_id", "order_id", F.col("price").alias("amount"), "city", "event_type",
        F.col("event_timestamp").alias("event_time"))


TX_SQL = """
tx AS (SELECT event_id, user_id, device_id, order_id, price AS amount, city, event_type,
              event_timestamp AS event_time FROM ev)
"""


# --- orders table -----------------------------------------------------------------------------

def shop_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("user_id"),
        F.col("o_totalprice").cast("decimal(12,2)").alias("price"),
        F.col("o_orderstatus").alias("status"), F.col("o_orderdate").alias("event_timestamp"),
        F.to_date("o_orderdate").alias("partition_date"))


SHOP_SQL = """
shop AS (SELECT o_orderkey AS order_id, o_custkey AS user_id, CAST(o_totalprice AS DECIMAL(12,2)) AS price,
                o_orderstatus AS status, o_orderdate AS event_timestamp, CAST(o_orderdate AS DATE) AS partition_date
         FROM orders)
"""


# --- catalog ----------------------------------------------------------------------------------

def foods(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("food_id"), F.col("p_name").alias("name"), F.col("p_type").alias("category"),
        F.col("p_retailprice").cast("decimal(10,2)").alias("price"), F.col("p_brand").alias("description"),
        (F.col("p_size") > 5).alias("is_available"))


FOODS_SQL = """
foods AS (SELECT p_partkey AS food_id, p_name AS name, p_type AS category,
                 CAST(p_retailprice AS DECIMAL(10,2)) AS price, p_brand AS description, p_size > 5 AS is_available
          FROM part)
"""


# --- deliveries -------------------------------------------------------------------------------

def delivery_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as rows of the delivery feed: all text, with the feed's kinds of dirt."""
    line = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority", "o_orderstatus")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    # Orders meet their customers first: otherwise each line would be moved by its customer too.
    joined = line.join(orders.join(customer, F.col("o_custkey") == F.col("c_custkey")), F.col("l_orderkey") == F.col("o_orderkey"))
    s = lambda expr: F.expr(expr)
    return joined.select(
        s("concat('D', l_orderkey, '-', l_linenumber)").alias("ID"),
        s("concat('P', l_suppkey)").alias("Delivery_person_ID"),
        s("case when l_partkey % 7 = 0 then 'NaN ' else cast(20 + l_suppkey % 30 as string) end").alias("Delivery_person_Age"),
        s("case when l_partkey % 11 = 0 then 'NaN' else cast(cast(l_tax as decimal(4,2)) as string) end").alias("Delivery_person_Ratings"),
        s("case when l_partkey % 13 = 0 then '' else concat(l_suppkey % 90, '.5') end").alias("Restaurant_latitude"),
        s("concat(l_suppkey % 70, '.25')").alias("Restaurant_longitude"),
        s("concat(' ', l_partkey % 90, '.125 ')").alias("Delivery_location_latitude"),
        s("case when l_partkey % 19 = 0 then 'null' else concat(l_partkey % 70, '.75') end").alias("Delivery_location_longitude"),
        F.date_format("l_shipdate", "dd-MM-yyyy").alias("Order_Date"),
        s("""case l_linenumber when 1 then '14:05' when 2 then '24:00' when 3 then '0.458333333' when 4 then 'NaN '
             when 5 then concat(lpad(l_partkey % 24, 2, '0'), ':', lpad(l_suppkey % 60, 2, '0'))
             when 6 then '' else '25:99' end""").alias("Time_Orderd"),
        F.lit(None).cast("string").alias("Time_Order_picked"),
        s("concat('conditions ', o_orderpriority)").alias("Weather_conditions"),
        s("l_linestatus").alias("Road_traffic_density"),
        s("cast(l_partkey % 4 as string)").alias("Vehicle_condition"),
        s("o_orderstatus").alias("Type_of_order"),
        s("l_returnflag").alias("Type_of_vehicle"),
        s("case when l_partkey % 5 = 0 then 'NaN' else concat(l_partkey % 4, '.0') end").alias("multiple_deliveries"),
        s("case when l_suppkey % 10 = 0 then 'Yes' else 'No' end").alias("Festival"),
        s("c_mktsegment").alias("City"),
        s("case when l_partkey % 17 = 0 then 'x' else cast(cast(l_quantity * 7 as int) as string) end").alias("Time_taken (min)"),
        s("l_shipdate").alias("_shipped"),
        s("l_partkey").alias("_part"),
    )


def delivery_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event envelopes with repeated event ids, as at-least-once delivery leaves them."""
    from tiffinlake.functions import parse_order_time

    fmt = "yyyy-MM-dd'T'HH:mm:ss"
    return delivery_rows(spark, sf_dir).select(
        F.col("ID").alias("event_id"),
        F.date_format(parse_order_time("Order_Date", "Time_Orderd"), fmt).alias("event_time"),
        F.date_format(F.col("_shipped") + F.expr("make_dt_interval(0, 0, 0, _part)"), fmt).alias("ingestion_time"),
        F.struct(*[F.col(f"`{c}`") for c in DELIVERY_CSV_COLUMNS]).alias("payload"),
    )


def delivery_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tiffinlake.operators.dedup import TASK_ROWS, dedup_latest
    from tiffinlake.operators.delivery import flatten_delivery, quality_flags

    bronze = delivery_bronze(spark, sf_dir)
    return quality_flags(flatten_delivery(dedup_latest(bronze, ["event_id"], ["ingestion_time"], task_rows=TASK_ROWS)))


_PAYLOAD_ORDER = ", ".join(f'"{c}" DESC NULLS LAST' for c in DELIVERY_CSV_COLUMNS)

DELIVERY_SQL = f"""
rows0 AS (
  SELECT 'D' || l_orderkey || '-' || l_linenumber AS "ID", 'P' || l_suppkey AS "Delivery_person_ID",
    CASE WHEN l_partkey % 7 = 0 THEN 'NaN ' ELSE CAST(20 + l_suppkey % 30 AS VARCHAR) END AS "Delivery_person_Age",
    CASE WHEN l_partkey % 11 = 0 THEN 'NaN' ELSE CAST(CAST(l_tax AS DECIMAL(4,2)) AS VARCHAR) END AS "Delivery_person_Ratings",
    CASE WHEN l_partkey % 13 = 0 THEN '' ELSE (l_suppkey % 90) || '.5' END AS "Restaurant_latitude",
    (l_suppkey % 70) || '.25' AS "Restaurant_longitude",
    ' ' || (l_partkey % 90) || '.125 ' AS "Delivery_location_latitude",
    CASE WHEN l_partkey % 19 = 0 THEN 'null' ELSE (l_partkey % 70) || '.75' END AS "Delivery_location_longitude",
    strftime(l_shipdate, '%d-%m-%Y') AS "Order_Date",
    CASE l_linenumber WHEN 1 THEN '14:05' WHEN 2 THEN '24:00' WHEN 3 THEN '0.458333333' WHEN 4 THEN 'NaN '
      WHEN 5 THEN lpad(CAST(l_partkey % 24 AS VARCHAR), 2, '0') || ':' || lpad(CAST(l_suppkey % 60 AS VARCHAR), 2, '0')
      WHEN 6 THEN '' ELSE '25:99' END AS "Time_Orderd",
    CAST(NULL AS VARCHAR) AS "Time_Order_picked", 'conditions ' || o_orderpriority AS "Weather_conditions",
    l_linestatus AS "Road_traffic_density", CAST(l_partkey % 4 AS VARCHAR) AS "Vehicle_condition",
    o_orderstatus AS "Type_of_order", l_returnflag AS "Type_of_vehicle",
    CASE WHEN l_partkey % 5 = 0 THEN 'NaN' ELSE (l_partkey % 4) || '.0' END AS "multiple_deliveries",
    CASE WHEN l_suppkey % 10 = 0 THEN 'Yes' ELSE 'No' END AS "Festival", c_mktsegment AS "City",
    CASE WHEN l_partkey % 17 = 0 THEN 'x' ELSE CAST(CAST(l_quantity * 7 AS INT) AS VARCHAR) END AS "Time_taken (min)",
    l_shipdate AS shipped, l_partkey AS part_no, l_suppkey AS supp_no, l_linenumber AS line_no
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
),
rows1 AS (
  SELECT *, "ID" AS event_id, CAST(shipped + to_seconds(part_no) AS TIMESTAMP) AS ingestion_time,
    CAST(date_trunc('day', shipped) + to_minutes(CASE line_no WHEN 1 THEN 845 WHEN 2 THEN 1440 WHEN 3 THEN 660
      WHEN 5 THEN (part_no % 24) * 60 + supp_no % 60 ELSE 0 END) AS TIMESTAMP) AS event_time
  FROM rows0
),
latest AS (
  SELECT * FROM rows1 QUALIFY row_number() OVER (PARTITION BY event_id
    ORDER BY ingestion_time DESC, event_time DESC, {_PAYLOAD_ORDER}) = 1
),
flat AS (
  SELECT event_id, event_time, ingestion_time, "ID" AS order_id, "Delivery_person_ID" AS delivery_person_id,
    TRY_CAST(trim("Delivery_person_Age") AS INT) AS delivery_person_age,
    CASE WHEN "Delivery_person_Ratings" <> 'NaN' THEN TRY_CAST("Delivery_person_Ratings" AS DOUBLE) END AS delivery_person_rating,
    TRY_CAST("Restaurant_latitude" AS DOUBLE) AS restaurant_lat, TRY_CAST("Restaurant_longitude" AS DOUBLE) AS restaurant_lon,
    TRY_CAST(trim("Delivery_location_latitude") AS DOUBLE) AS delivery_lat,
    TRY_CAST("Delivery_location_longitude" AS DOUBLE) AS delivery_lon,
    "Order_Date" AS order_date_raw, "Time_Orderd" AS time_ordered_raw, "Time_Order_picked" AS time_picked_raw,
    "Weather_conditions" AS weather_conditions, "Road_traffic_density" AS road_traffic_density,
    TRY_CAST("Vehicle_condition" AS INT) AS vehicle_condition, "Type_of_order" AS order_type,
    "Type_of_vehicle" AS vehicle_type,
    CASE WHEN "multiple_deliveries" <> 'NaN' THEN CAST(TRY_CAST("multiple_deliveries" AS DOUBLE) AS INT) END AS multiple_deliveries,
    "Festival" AS is_festival, "City" AS city, TRY_CAST("Time_taken (min)" AS INT) AS delivery_time_minutes
  FROM latest
),
silver AS (
  SELECT *, (located::INT + timed::INT) / 2.0::DOUBLE AS data_quality_score,
         located AS is_valid_coordinates, timed AS is_valid_delivery_time
  FROM (SELECT *,
    restaurant_lat IS NOT NULL AND restaurant_lon IS NOT NULL AND delivery_lat IS NOT NULL AND delivery_lon IS NOT NULL AS located,
    coalesce(delivery_time_minutes > 0 AND delivery_time_minutes < 300, FALSE) AS timed
    FROM flat)
)
"""


def delivery_sql(body: str) -> str:
    return "WITH " + DELIVERY_SQL.strip() + "\n" + body
