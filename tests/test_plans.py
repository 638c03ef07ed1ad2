"""What the physical plans must and must not contain."""

import pytest

from tiffinlake.session import prepare
from workload import all_queries
from workload.views import table

SF = "/root/testdata/sf0.001"

# Lazy queries only: those that store intermediate tables have run most of their plan already.
NO_PAIRS = ["attributed_orders", "ads_attribution", "recon_hourly_exact", "recon_hourly_compat", "velocity_alerts", "device_sharing_alerts",
            "geo_anomaly_alerts", "user_sessions", "running_count", "dedup_orders", "daily_gmv", "user_funnel", "recommend"]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", NO_PAIRS)
def test_no_cross_or_nested_loop_joins_and_no_python(spark, name):
    text = plan(all_queries()[name](spark, SF))
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "InPandas"):
        assert node not in text


def test_kpis_scan_once(spark):
    text = plan(all_queries()["delivery_kpis"](spark, SF))
    assert text.count("lineitem.parquet") == 1 and "Expand" in text


def test_filters_and_columns_reach_the_scan(spark):
    text = plan(all_queries()["filter_project"](spark, SF))
    assert "PushedFilters: [IsNotNull(c_acctbal), GreaterThan(c_acctbal,5000.0)]" in text
    assert "c_mktsegment" not in text and "c_nationkey" not in text


def test_dated_reads_prune_partitions(spark, base):
    from pyspark.sql import functions as F

    from tiffinlake.sources import tables
    prepare(spark)
    rows = table(spark, SF, "events").select("event_id", F.to_date("ts").alias("partition_date"))
    tables.write_table(rows, base, ["partition_date"])
    text = plan(tables.read_table(spark, base, "2024-01-15", ["event_id"]))
    assert "PartitionFilters: [isnotnull(partition_date" in text


def test_dedup_combines_before_the_shuffle(spark):
    text = plan(all_queries()["dedup_orders"](spark, SF))
    assert "partial_max" in text and "Window" not in text


def test_broadcast_is_refused_beyond_the_limit(spark):
    from tiffinlake.operators.joins import enrich, fits_broadcast
    from pyspark.sql import functions as F
    big = spark.range(20000).select("id", F.repeat(F.lit("x"), 200).alias("pad"))
    fact = spark.range(100)
    assert not fits_broadcast(big, 1)
    assert "SortMergeJoin" in plan(enrich(fact, big, "id", "broadcast", max_broadcast_mb=1))
    assert "BroadcastHashJoin" in plan(enrich(big, fact, "id", "broadcast"))
