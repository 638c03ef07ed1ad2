"""Warehouse-style tables kept as partitioned Parquet: dated reads, idempotent replaces and merges.

Parquet has no row-level ``MERGE``; merges append what is new, or rewrite only the partitions the
source touches. Merge keys must contain the partition columns, so a row cannot change partition.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..operators.dedup import dedup_latest
from ..session import discard, materialize
from .files import delete_path, files_by_folder, in_folders, partition_folder, path_exists, rebalanced


def read_table(spark: SparkSession, path: str, date: dt.date | str | None = None, columns: list[str] | None = None,
               date_column: str = "partition_date") -> DataFrame:
    """A stored table; the date predicate prunes partitions and the column list prunes the scan."""
    df = spark.read.parquet(path)
    if date is not None:
        df = df.where(F.col(date_column) == F.lit(date).cast("date"))
    return df.select(*columns) if columns else df


def write_table(df: DataFrame, path: str, partition_by: list[str] | None = None, mode: str = "append") -> None:
    out = rebalanced(df, partition_by) if partition_by else df
    writer = out.write.mode(mode)
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def replace_partition(df: DataFrame, path: str, partition_by: list[str], replaced: list[dict[str, object]] | None = None,
                      folders: int | None = None) -> None:
    """Delete-then-insert of the partitions in ``df``, as one dynamic overwrite.

    ``replaced`` names partitions, by all their columns or the leading ones, that belong to the
    replacement even if ``df`` has no row for them: those are emptied, so that a correction to nothing
    leaves nothing behind. ``df`` is computed once: a folder that still holds the files it held before the write got no rows.
    Rows known to be of few ``folders`` are not moved before they are written.
    """
    spark = df.sparkSession
    before = [files_by_folder(spark, partition_folder(spark, path, partition_by, named)) for named in replaced or []]
    in_folders(df, partition_by, lambda rows: rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
               .partitionBy(*partition_by).parquet(path), folders)
    for named, held in zip(replaced or [], before):
        now = files_by_folder(spark, partition_folder(spark, path, partition_by, named)) if held else {}
        for folder, names in held.items():
            if now.get(folder) == names:
                delete_path(spark, folder)


def empty_partitions(spark: SparkSession, path: str, partition_by: list[str], named: list[dict[str, object]]) -> None:
    """Remove the rows of the named partitions, given by all columns or the leading ones."""
    for one in named:
        delete_path(spark, partition_folder(spark, path, partition_by, one))


def _touched(source: DataFrame, path: str, partition_by: list[str], delivered: DataFrame | None = None) -> DataFrame:
    """The stored rows of the partitions that ``source`` has rows for; others are not scanned.

    ``delivered`` has rows in the same partitions as ``source`` and is cheaper to ask.

    Partition values have the source's types, so that a text like ``01`` is not read as a number.
    The values of the batch are collected first: one short row for each partition it touches.
    """
    spark = source.sparkSession
    stored = spark.read.parquet(path).schema
    typed = T.StructType([source.schema[f.name] if f.name in partition_by else f for f in stored.fields])
    target = spark.read.schema(typed).parquet(path)
    if not partition_by:
        return target
    values = (source if delivered is None else delivered).select(*partition_by).distinct().collect()
    for i, column in enumerate(partition_by):
        known = sorted({r[i] for r in values if r[i] is not None})
        missing = F.col(column).isNull() if any(r[i] is None for r in values) else F.lit(False)
        target = target.where(F.col(column).isin(known) | missing)
    return target


def _check(keys: list[str], partition_by: list[str]) -> None:
    if not set(partition_by) <= set(keys):
        raise ValueError("merge keys must contain the partition columns")


def _without(df: DataFrame, other: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``df`` whose key does not occur in ``other``; null key parts equal each other."""
    seen = other.select(*[F.col(k).alias(f"_{k}") for k in keys])
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys])
    return df.join(seen, same, "left_anti")


def not_matched(source: DataFrame, target: DataFrame, keys: list[str]) -> DataFrame:
    """Source rows whose key the target lacks."""
    return _without(source, target, keys)


def upserted(source: DataFrame, target: DataFrame, keys: list[str]) -> DataFrame:
    """Target rows replaced by source rows of the same key, plus the source rows that are new."""
    return _without(target, source, keys).unionByName(source)


def merge_insert(source: DataFrame, path: str, keys: list[str], partition_by: list[str], delivered: DataFrame | None = None) -> int:
    """Insert the rows whose key is new, and say how many. Only the partitions the source touches are compared.

    ``delivered``, if given, has rows in the same partitions and names them without computing ``source``.
    """
    _check(keys, partition_by)
    spark = source.sparkSession
    fresh = not_matched(source, _touched(source, path, partition_by, delivered), keys) if path_exists(spark, path) else source
    staged = materialize(fresh, "merge")
    write_table(staged, path, partition_by)
    stored = staged.count()  # from the files' footers
    discard(staged)
    return stored


def merge_upsert(source: DataFrame, path: str, keys: list[str], partition_by: list[str]) -> None:
    """Update matching rows, insert the others, rewriting only the touched partitions.

    The new content is staged in the shared folder first: the table is never overwritten while
    being read, and a lost executor finds the staged files.
    """
    _check(keys, partition_by)
    spark = source.sparkSession
    if not path_exists(spark, path):
        write_table(source, path, partition_by)
        return
    touched = _touched(source, path, partition_by)
    if len(partition_by) > 1:  # columns are pruned one by one; together they may name more than was touched
        parts = source.select(*[F.col(p).alias(f"_{p}") for p in partition_by]).distinct()
        same = reduce(lambda a, b: a & b, [F.col(p).eqNullSafe(F.col(f"_{p}")) for p in partition_by])
        touched = touched.join(parts, same, "left_semi")
    staged = materialize(upserted(source, touched, keys), "merge")
    if partition_by:
        replace_partition(staged, path, partition_by)
    else:
        staged.write.mode("overwrite").parquet(path)
    discard(staged)


def append_idempotent(df: DataFrame, path: str, key: str, partition_by: list[str]) -> int:
    """Insert-ignore on a unique id: repeated deliveries, within the batch or before it, are dropped. The number of rows stored."""
    keys = [key, *[p for p in partition_by if p != key]]
    return merge_insert(dedup_latest(df, keys, []), path, keys, partition_by, df)


def read_jdbc(spark: SparkSession, url: str, table: str, columns: list[str] | None = None, predicate: str | None = None,
              partition_column: str | None = None, bounds: tuple[int, int] | None = None, partitions: int = 1,
              **options: str) -> DataFrame:
    """A database table. Column list and predicate are pushed down; a numeric column splits the read."""
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table).options(**options)
    if partition_column and bounds:
        reader = (
            reader.option("partitionColumn", partition_column).option("lowerBound", bounds[0])
            .option("upperBound", bounds[1]).option("numPartitions", partitions)
        )
    df = reader.load()
    if predicate:
        df = df.where(predicate)
    return df.select(*columns) if columns else df


def write_jdbc(df: DataFrame, url: str, table: str, mode: str = "append", batch_size: int = 500, **options: str) -> None:
    (
        df.write.format("jdbc").mode(mode).option("url", url).option("dbtable", table)
        .option("batchsize", batch_size).options(**options).save()
    )
