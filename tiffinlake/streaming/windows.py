"""Watermarks, event-time windows and watermarked deduplication; usable on batch frames too."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def with_watermark(df: DataFrame, ts: str, delay: str = "10 seconds") -> DataFrame:
    """Bounded out-of-orderness; ``0 seconds`` for monotonous time. Watermarks need TIMESTAMP, so NTZ is cast."""
    if dict(df.dtypes)[ts] != "timestamp":
        df = df.withColumn(ts, F.col(ts).cast("timestamp"))
    return df.withWatermark(ts, delay)


def windowed(df: DataFrame, keys: list[str], ts: str, size: str, slide: str | None = None) -> DataFrame:
    """Row counts per key and tumbling (or, with ``slide``, sliding) event-time window."""
    span = F.window(ts, size, slide) if slide else F.window(ts, size)
    return (
        df.groupBy(span.alias("w"), *keys).agg(F.count(F.lit(1)).alias("n"))
        .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *keys, "n")
    )


def session_windows(df: DataFrame, keys: list[str], ts: str, gap: str) -> DataFrame:
    """Row counts per key and gap-based session window."""
    return (
        df.groupBy(F.session_window(ts, gap).alias("w"), *keys).agg(F.count(F.lit(1)).alias("n"))
        .select(F.col("w.start").alias("session_start"), F.col("w.end").alias("session_end"), *keys, "n")
    )


def dedup_stream(df: DataFrame, keys: list[str], ts: str, delay: str = "10 minutes") -> DataFrame:
    """First arrival per key; state is dropped once the watermark passes, unlike an unbounded dropDuplicates."""
    return with_watermark(df, ts, delay).dropDuplicatesWithinWatermark(keys)
