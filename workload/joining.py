"""Join strategies, reduce-early, skew idioms, means and counts over the order tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tiffinlake.operators import aggregates, delivery, health, joins, ranking

from .registry import query
from .views import bronze_clicks, bronze_orders, events_sql, table

_ENRICHED = """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, s_name, s_nationkey FROM lineitem JOIN supplier ON l_suppkey = s_suppkey"""


def _fact(spark, sf):
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", F.col("l_suppkey").alias("s_suppkey"), "l_extendedprice")


def _suppliers(spark, sf):
    return table(spark, sf, "supplier").select("s_suppkey", "s_name", "s_nationkey")


def _parts(spark, sf):
    return table(spark, sf, "part").select(F.col("p_partkey").alias("l_partkey"), "p_brand", "p_size")


for _strategy in ("auto", "merge", "broadcast", "shuffle_hash", "copartition"):
    def _enrich(spark, sf, strategy=_strategy):
        return joins.enrich(_fact(spark, sf), _suppliers(spark, sf), "s_suppkey", strategy).withColumnRenamed("s_suppkey", "l_suppkey")

    query(f"join_{_strategy}", _ENRICHED.strip())(_enrich)

_TWO_DIMS = """
SELECT p_brand, s_nationkey, count(*) AS n, sum(CAST(l_extendedprice AS DECIMAL(12,2)))::DOUBLE AS revenue
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN part ON l_partkey = p_partkey GROUP BY 1, 2"""


def _two_dims(spark, sf, **options):
    joined = joins.enrich_many(
        _fact(spark, sf), [(_suppliers(spark, sf), "s_suppkey"), (_parts(spark, sf), "l_partkey")], **options)
    return joined.groupBy("p_brand", "s_nationkey").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("l_extendedprice").cast("decimal(12,2)")).alias("revenue"))


for _policy in ("auto", "all", "smallest"):
    def _many(spark, sf, policy=_policy):
        return _two_dims(spark, sf, broadcast=policy)

    query(f"join_two_dimensions_{_policy}", _TWO_DIMS.strip())(_many)


@query("join_dimensions_first", """
SELECT c_mktsegment, count(*) AS n, sum(CAST(o_totalprice AS DECIMAL(14,2)))::DOUBLE AS value FROM orders JOIN customer ON o_custkey = c_custkey
JOIN (SELECT c_custkey AS k, c_acctbal > 0 AS solvent FROM customer) ON o_custkey = k WHERE solvent GROUP BY 1""")
def join_dimensions_first(spark, sf):
    customer = table(spark, sf, "customer")
    segments = customer.select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment")
    balances = customer.select(F.col("c_custkey").alias("o_custkey"), (F.col("c_acctbal") > 0).alias("solvent")).where("solvent")
    fact = table(spark, sf, "orders").select("o_custkey", "o_totalprice")
    return joins.enrich_many(fact, [(segments, "o_custkey"), (balances, "o_custkey")], order="dims_first").groupBy(
        "c_mktsegment").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("o_totalprice").cast("decimal(14,2)")).alias("value"))


@query("reduce_early", """
SELECT c_mktsegment, count(*) AS n, round(avg(o_totalprice), 4) AS mean FROM orders JOIN customer ON o_custkey = c_custkey
WHERE o_orderstatus = 'F' GROUP BY 1""")
def reduce_early(spark, sf):
    slim = joins.reduce_early(table(spark, sf, "orders"), F.col("o_orderstatus") == "F", ["o_custkey", "o_totalprice"])
    customers = table(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment")
    return joins.enrich(slim, customers, "o_custkey").groupBy("c_mktsegment").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.avg("o_totalprice"), 4).alias("mean"))


@query("delivery_mart", """
SELECT l_returnflag AS city, p_brand AS vehicle, round(avg(l_quantity), 6) AS avg_time, count(*) AS total_deliveries,
  round(sum(CAST(s_acctbal AS DECIMAL(12,2)))::DOUBLE / count(*), 6) AS avg_rating
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN (SELECT p_partkey, p_brand FROM part) ON l_suppkey = p_partkey
WHERE l_returnflag IS NOT NULL GROUP BY 1, 2""")
def delivery_mart(spark, sf):
    fact = table(spark, sf, "lineitem").select(
        F.col("l_suppkey").alias("courier"), F.col("l_returnflag").alias("city"), F.col("l_quantity").alias("minutes"))
    couriers = table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("courier"), F.col("s_acctbal").cast("decimal(12,2)").alias("rating"))
    vehicles = table(spark, sf, "part").select(F.col("p_partkey").alias("courier"), F.col("p_brand").alias("vehicle"))
    out = delivery.delivery_mart(fact, couriers, vehicles, "courier", "city", "minutes", "rating", "vehicle")
    return out.withColumns({"avg_time": F.round("avg_time", 6), "avg_rating": F.round(F.col("avg_rating").cast("double"), 6)})


@query("mean_by_key", "SELECT l_suppkey, round(avg(l_quantity), 6) AS mean FROM lineitem GROUP BY 1")
def mean_by_key(spark, sf):
    return aggregates.mean_by(table(spark, sf, "lineitem"), "l_suppkey", "l_quantity").withColumn("mean", F.round("mean", 6))


@query("mean_by_two_keys", "SELECT l_returnflag, l_linestatus, round(avg(l_quantity), 6) AS mean FROM lineitem GROUP BY 1, 2")
def mean_by_two_keys(spark, sf):
    out = aggregates.mean_by(table(spark, sf, "lineitem"), ["l_returnflag", "l_linestatus"], "l_quantity")
    return out.withColumn("mean", F.round("mean", 6))


@query("count_by_key", "SELECT event_type, count(*) AS n FROM events GROUP BY 1")
def count_by_key(spark, sf):
    return aggregates.count_by(table(spark, sf, "events"), "event_type")


@query("salted_mean", "SELECT l_returnflag, round(avg(l_quantity), 6) AS mean FROM lineitem GROUP BY 1")
def salted_mean(spark, sf):
    return aggregates.salted_mean(table(spark, sf, "lineitem"), "l_returnflag", "l_quantity").withColumn("mean", F.round("mean", 6))


@query("partition_profile", "SELECT (l_orderkey % 7)::INT AS pid, count(*) AS n FROM lineitem GROUP BY 1")
def partition_profile(spark, sf):
    """Rows dealt to seven partitions by a known rule, counted where they are."""
    lines = table(spark, sf, "lineitem")
    return aggregates.partition_profile(lines.repartitionById(7, (F.col("l_orderkey") % 7).cast("int"))).where("n > 0")


@query("latest_events", "SELECT event_id, ts FROM events ORDER BY ts DESC, event_id LIMIT 25")
def latest_events(spark, sf):
    return aggregates.latest(table(spark, sf, "events").select("event_id", "ts"), "ts", 25, ["event_id"])


@query("rank_customers", """
SELECT o_custkey, value::DOUBLE AS value, rank() OVER (ORDER BY value DESC) AS place, round(percent_rank() OVER (ORDER BY value DESC), 9) AS place_pct
FROM (SELECT o_custkey, sum(CAST(o_totalprice AS DECIMAL(12,2))) AS value FROM orders GROUP BY 1)""")
def rank_customers(spark, sf):
    totals = table(spark, sf, "orders").groupBy("o_custkey").agg(F.sum(F.col("o_totalprice").cast("decimal(12,2)")).alias("value"))
    return ranking.add_rank(totals, [], "value", "place").withColumn("place_pct", F.round("place_pct", 9))


@query("rank_parts_by_quantity", """
SELECT l_returnflag, l_partkey, qty, rank() OVER (PARTITION BY l_returnflag ORDER BY qty DESC) AS place
FROM (SELECT l_returnflag, l_partkey, sum(l_quantity) AS qty FROM lineitem GROUP BY 1, 2)""")
def rank_parts_by_quantity(spark, sf):
    totals = table(spark, sf, "lineitem").groupBy("l_returnflag", "l_partkey").agg(F.sum("l_quantity").alias("qty"))
    return ranking.add_rank(totals, ["l_returnflag"], "qty", "place").drop("place_pct")


@query("top_parts_per_supplier", """
SELECT l_suppkey, l_partkey, n, row_number() OVER (PARTITION BY l_suppkey ORDER BY n DESC, l_partkey) AS rank
FROM (SELECT l_suppkey, l_partkey, count(*) AS n FROM lineitem GROUP BY 1, 2) QUALIFY rank <= 5""")
def top_parts_per_supplier(spark, sf):
    counts = table(spark, sf, "lineitem").groupBy("l_suppkey", "l_partkey").agg(F.count(F.lit(1)).alias("n"))
    return ranking.top_per_key(counts, ["l_suppkey"], [F.desc("n"), F.asc("l_partkey")], 5)


# --- health -----------------------------------------------------------------------------------

@query("layer_health", """
SELECT 'orders' AS table_name, count(*) AS row_count, max(o_orderdate) AS latest FROM orders
UNION ALL SELECT 'lineitem', count(*), max(l_shipdate) FROM lineitem
UNION ALL SELECT 'events', count(*), max(ts) FROM events
UNION ALL SELECT 'part', count(*), NULL FROM part""")
def layer_health(spark, sf):
    return health.layer_health({
        "orders": (table(spark, sf, "orders"), "o_orderdate"), "lineitem": (table(spark, sf, "lineitem"), "l_shipdate"),
        "events": (table(spark, sf, "events"), "ts"), "part": (table(spark, sf, "part"), None)})


@query("latest_null_check", events_sql("""
SELECT count(*) AS latest_rows, count(*) FILTER (WHERE order_id IS NULL OR user_id IS NULL) AS null_issues
FROM (SELECT * FROM bronze_orders ORDER BY event_timestamp DESC, event_id DESC LIMIT 500)"""))
def latest_null_check(spark, sf):
    return health.latest_null_check(bronze_orders(spark, sf), ["order_id", "user_id"], 500, "event_timestamp", ["event_id"])


@query("bronze_profile", events_sql(
    "SELECT count(*) AS row_count, min(event_timestamp) AS first_ts, max(event_timestamp) AS last_ts FROM bronze_clicks"))
def bronze_profile(spark, sf):
    return health.bronze_profile(bronze_clicks(spark, sf), "event_timestamp")


@query("latest_dates", events_sql(
    "SELECT DISTINCT partition_date::VARCHAR AS partition_date FROM bronze_clicks ORDER BY 1 DESC LIMIT 10"))
def latest_dates(spark, sf):
    return health.latest_dates(bronze_clicks(spark, sf))
