"""Pipeline health: row counts, freshness, table presence and bronze profiles."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F


def layer_health(tables: dict[str, tuple[DataFrame, str | None]]) -> DataFrame:
    """Rows and latest time per table; the time column may be ``None``."""
    parts = []
    for name, (df, ts) in tables.items():
        newest = F.max(F.col(ts).cast("timestamp_ntz")) if ts else F.lit(None).cast("timestamp_ntz")
        parts.append(df.agg(F.count(F.lit(1)).alias("row_count"), newest.alias("latest")).select(
            F.lit(name).alias("table_name"), "row_count", "latest"))
    return reduce(DataFrame.unionByName, parts)


def tables_present(spark: SparkSession, names: DataFrame | list[str], column: str = "table_name") -> DataFrame:
    """Which of the named tables and views the session's catalog knows; names compare without case, as the catalog does."""
    if isinstance(names, list):
        names = spark.createDataFrame([(n,) for n in names], f"{column} string")
    known = spark.createDataFrame([(t.name.lower(), True) for t in spark.catalog.listTables()], "_known string, _there boolean")
    held = F.broadcast(known.distinct())  # the catalog's own list, which the driver holds anyway
    return names.join(held, F.lower(names[column]) == held["_known"], "left").select(
        names[column], F.coalesce("_there", F.lit(False)).alias("is_present"))


def latest_null_check(df: DataFrame, cols: list[str], n: int, ts: str, tiebreak: list[str] | None = None) -> DataFrame:
    """Among the ``n`` newest rows: how many there are, and how many miss a required column."""
    newest = df.orderBy(F.desc(ts), *[F.desc(c) for c in tiebreak or []]).limit(n)
    missing = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in cols])
    return newest.agg(F.count(F.lit(1)).alias("latest_rows"), F.count_if(missing).alias("null_issues"))


def bronze_profile(df: DataFrame, ts: str) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("row_count"), F.min(ts).alias("first_ts"), F.max(ts).alias("last_ts"))


def latest_dates(df: DataFrame, column: str = "partition_date", n: int = 10) -> DataFrame:
    return df.select(column).distinct().orderBy(F.desc(column)).limit(n)
