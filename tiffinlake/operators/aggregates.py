"""General aggregates over facts: means, counts, and skew-proof variants."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def mean_by(df: DataFrame, keys: str | list[str], value: str, out: str = "mean") -> DataFrame:
    keys = [keys] if isinstance(keys, str) else keys
    return df.groupBy(*keys).agg(F.avg(value).alias(out))


def count_by(df: DataFrame, key: str, out: str = "n") -> DataFrame:
    """Rows per key, most frequent first; equal counts in key order."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias(out)).orderBy(F.desc(out), F.asc(key))


def salted_mean(df: DataFrame, key: str, value: str, buckets: int = 16, out: str = "mean") -> DataFrame:
    """Mean per key in two phases: partial sums and counts per (key, salt), then merged.

    Merging sums and counts is exact for unequal salts. The salt is a hash of the row, so a
    recomputed task salts the same way.
    """
    salt = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]), F.lit(buckets))
    partial = (
        df.groupBy(key, salt.alias("_salt"))
        .agg(F.sum(value).alias("_sum"), F.count(value).alias("_n"))
    )
    return partial.groupBy(key).agg(F.try_divide(F.sum("_sum").cast("double"), F.sum("_n").cast("double")).alias(out))


def partition_profile(df: DataFrame) -> DataFrame:
    """Rows per physical partition, to show skew."""
    return df.groupBy(F.spark_partition_id().alias("pid")).agg(F.count(F.lit(1)).alias("n"))


def revenue_by(df: DataFrame, key: str, amount: str = "amount", out: str = "total_revenue") -> DataFrame:
    """Sum of amounts per key; works on a stream in complete or update mode too."""
    return df.groupBy(key).agg(F.sum(amount).alias(out))


def latest(df: DataFrame, ts: str, n: int, tiebreak: list[str] | None = None) -> DataFrame:
    """The ``n`` most recent rows (``TakeOrderedAndProject``: each task keeps ``n``)."""
    return df.orderBy(F.desc(ts), *[F.asc(c) for c in tiebreak or []]).limit(n)


def partition_dates(*tables: DataFrame, column: str = "partition_date") -> DataFrame:
    """Distinct dates present in any of the tables, in order."""
    out = tables[0].select(column).distinct()
    for t in tables[1:]:
        out = out.union(t.select(column).distinct())
    return out.where(F.col(column).isNotNull()).distinct().orderBy(column)
