"""What several operators share: reading tables, bounded chunks of texts, bounded samples, integer hashes."""

from __future__ import annotations

import ctypes
import gc
import sys
from collections.abc import Callable, Iterator
from functools import wraps

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

# Characters a Python task works on at once; longer texts make a chunk of their own.
CHUNK_CHARS = 1_000_000
# Bytes of texts sent to a Python task at once; a longer text makes a batch of its own.
BATCH_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def chunks(texts, limit: int = CHUNK_CHARS) -> Iterator[list[str]]:
    """Consecutive texts with about ``limit`` characters together; null texts become empty."""
    part, size = [], 0
    for text in texts:
        text = text if isinstance(text, str) else ""
        if part and size + len(text) > limit:
            yield part
            part, size = [], 0
        part.append(text)
        size += len(text)
    if part:
        yield part


def small_batches(spark: SparkSession) -> None:
    """Bound what the session's Python tasks receive at once by bytes, as rows may hold very long texts."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def lean(work: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``work``, which after its last batch gives freed memory back to the system: Spark keeps workers for later tasks."""

    @wraps(work)
    def run(batches):
        yield from work(batches)
        gc.collect()
        pa.default_memory_pool().release_unused()
        if hasattr(libc := ctypes.CDLL(None), "malloc_trim"):
            libc.malloc_trim(0)

    return run


def kept_by_worker(name: str, make: Callable[[], object]) -> object:
    """An object that the Python worker process keeps for later tasks, such as a bounded memory of words."""
    held = sys.__dict__.setdefault("_kept_by_worker", {})
    if name not in held:
        held[name] = make()
    return held[name]


def bounded_sample(df: DataFrame, by: str, key: str, per_value: int, seed: int) -> DataFrame:
    """At most ``per_value`` rows of each value of ``by``, in the order of a seeded hash of ``key``.

    A count per value turns the bound into a hash threshold of twice the share wanted, so that only
    a bounded number of rows is ranked whatever the size of the table. ``by`` must have few values.
    """
    df = df.where(F.col(by).isNotNull() & F.col(key).isNotNull())
    counts = {row[0]: row[1] for row in df.groupBy(by).count().collect()}
    place = F.pmod(F.xxhash64(F.lit(seed), F.col(key)), F.lit(1 << 30)).cast("double") / float(1 << 30)
    wanted = F.lit(False)
    for value, n in counts.items():
        share = min(1.0, (2.0 * per_value + 100) / max(n, 1))
        wanted = wanted | ((F.col(by) == F.lit(value)) & (place < share))
    order = Window.partitionBy(by).orderBy(F.xxhash64(F.lit(seed), F.col(key)), F.col(key))
    return (df.where(wanted).withColumn("__rank", F.row_number().over(order))
            .where(F.col("__rank") <= per_value).drop("__rank"))


def mix64(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit integers (the finalizer of SplitMix64)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def parts_of(df: DataFrame, bytes_each: int) -> int:
    """Number of parts that each stand for so many bytes of what ``df`` reads, one for each core at least.

    Where Spark has no size (rows that a program made), the session's number of shuffle partitions.
    """
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    if size >= 1 << 62:
        return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(df.sparkSession.sparkContext.defaultParallelism, -(-size // bytes_each))
