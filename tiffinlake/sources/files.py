"""Layered file storage: CSV and JSONL in, Parquet silver and gold out."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from ..schemas import DELIVERY_CSV, DELIVERY_EVENT, USER_DOCUMENT
from ..session import settings, tidied

HOUR_KEYS = ["year", "month", "day", "hour"]

# About 128 MB of JSON at the 0.7 KB an event takes.
BRONZE_RECORDS_PER_FILE = 180_000

# Bronze lines repeat their field names; gzip leaves about a twelfth. It does not split, so files must be bounded in records.
BRONZE_FILES = {"compression": "gzip", "maxRecordsPerFile": str(BRONZE_RECORDS_PER_FILE)}

# Folders that a task may write side by side, and rows that make a file of decent size.
FEW_FOLDERS, FILE_ROWS = 32, 20_000

# The JSON writer's default cuts timestamps to milliseconds.
JSON_TIME = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


def path_exists(spark: SparkSession, path: str) -> bool:
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop_path)


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """Names of what a folder holds; none if it is not there."""
    if not path_exists(spark, path):
        return []
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return [s.getPath().getName() for s in hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(hadoop_path)]


def delete_path(spark: SparkSession, path: str) -> None:
    """Remove a folder of a table, if it is there."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop_path, True)


def _partition_text(value: object) -> str | None:
    """A partition value as Spark writes it into a folder's name, before escaping."""
    if isinstance(value, bool):
        return str(value).lower()
    return None if value is None else str(value)


def partition_folder(spark: SparkSession, path: str, partition_by: list[str], named: dict[str, object]) -> str:
    """The folder of a partition, or of all partitions under its leading columns, with the names escaped as Spark does."""
    if not named or list(partition_by[:len(named)]) != [c for c in partition_by if c in named] or len(named) > len(partition_by):
        raise ValueError(f"a partition is named by its leading columns, not by {sorted(named)}")
    utils = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
    return "/".join([path.rstrip("/"), *[utils.getPartitionPathString(c, _partition_text(named[c])) for c in partition_by[:len(named)]]])


def files_by_folder(spark: SparkSession, path: str) -> dict[str, set[str]]:
    """Names of the data files under a folder, by the folder that holds them; nothing if there is none."""
    found: dict[str, set[str]] = {}
    if path_exists(spark, path):
        hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
        listed = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).listFiles(hadoop_path, True)
        while listed.hasNext():
            file = listed.next().getPath()
            if not file.getName().startswith(("_", ".")):
                found.setdefault(file.getParent().toString(), set()).add(file.getName())
    return found


def partition_path(base: str, layer: str, year: int, month: int, day: int, hour: int) -> str:
    """``base/layer/year=YYYY/month=MM/day=DD/hour=HH``."""
    return f"{base}/{layer}/year={year}/month={month:02d}/day={day:02d}/hour={hour:02d}"


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).option("header", True).csv(path)


def read_delivery_csv(spark: SparkSession, path: str) -> DataFrame:
    """Delivery rows, every field as text."""
    return read_csv(spark, path, DELIVERY_CSV)


def _read_hour(spark: SparkSession, base: str, layer: str, hour: dt.datetime | None, schema: T.StructType,
               fmt: str, missing: str) -> DataFrame:
    """One hour's folder, or the whole layer. Reading a single hour lists only its folder."""
    root = f"{base}/{layer}"
    path = root if hour is None else partition_path(base, layer, hour.year, hour.month, hour.day, hour.hour)
    if not path_exists(spark, path):
        if missing != "empty":
            raise FileNotFoundError(path)
        with_keys = T.StructType([*schema.fields, *[T.StructField(k, T.IntegerType()) for k in HOUR_KEYS]])
        return spark.createDataFrame([], with_keys)
    return spark.read.schema(schema).option("basePath", root).format(fmt).load(path)


def read_hours(spark: SparkSession, base: str, layer: str, first: dt.datetime, last: dt.datetime, schema: T.StructType,
               fmt: str = "parquet") -> tuple[DataFrame, DataFrame]:
    """The rows of a layer from hour ``first`` to hour ``last``, and the hours between that have no folder.

    Only the days of the range are listed; the folders found are one scan. The gaps are ``hour`` rows.
    """
    start, end = (t.replace(minute=0, second=0, microsecond=0, tzinfo=None) for t in (first, last))
    days = [start.date() + dt.timedelta(days=i) for i in range((end.date() - start.date()).days + 1)]
    present: dict[dt.datetime, str] = {}
    for day in days:
        root = f"{base}/{layer}/year={day.year}/month={day.month:02d}/day={day.day:02d}"
        for name in folder_names(spark, root):
            at = dt.datetime(day.year, day.month, day.day, int(name.removeprefix("hour="))) if name.startswith("hour=") else None
            if at is not None and start <= at <= end:
                present[at] = f"{root}/{name}"
    spine = spark.sql("select explode(sequence(:first, :last, interval 1 hour)) as hour", {"first": start, "last": end})
    spine = spine.select(F.col("hour").cast("timestamp_ntz").alias("hour"))
    there = spark.createDataFrame([(at,) for at in sorted(present)], "hour timestamp_ntz")
    gaps = spine.join(there, "hour", "left_anti")
    if not present:
        with_keys = T.StructType([*schema.fields, *[T.StructField(k, T.IntegerType()) for k in HOUR_KEYS]])
        return spark.createDataFrame([], with_keys), gaps
    paths = [present[at] for at in sorted(present)]
    return spark.read.schema(schema).option("basePath", f"{base}/{layer}").format(fmt).load(paths), gaps


def read_bronze(spark: SparkSession, base: str, hour: dt.datetime | None = None, missing: str = "fail",
                schema: T.StructType = DELIVERY_EVENT) -> DataFrame:
    """JSONL events of an hour (or all), with partition columns; a missing hour fails or is empty."""
    return _read_hour(spark, base, "bronze", hour, schema, "json", missing)


def read_silver(spark: SparkSession, base: str, schema: T.StructType, hour: dt.datetime | None = None,
                missing: str = "fail") -> DataFrame:
    return _read_hour(spark, base, "silver", hour, schema, "parquet", missing)


def with_hour(df: DataFrame, ts: str) -> DataFrame:
    """Partition columns of a timestamp."""
    t = F.col(ts).cast("timestamp")
    return (
        df.withColumn("year", F.year(t)).withColumn("month", F.date_format(t, "MM"))
        .withColumn("day", F.date_format(t, "dd")).withColumn("hour", F.date_format(t, "HH"))
    )


def rebalanced(df: DataFrame, keys: list[str]) -> DataFrame:
    """Bring rows of one output partition together; AQE splits oversized partitions and merges small ones."""
    return df.hint("rebalance", *keys)


def _folders(df: DataFrame, keys: list[str]) -> int | None:
    """How many folders the rows of a stored frame go to; nothing if they would be too many, or files too small, to be written as they are read.

    Asked of frames from :func:`tiffinlake.session.materialize` only: there it takes a scan of the keys.
    """
    if not getattr(df, "_stored_at", None):
        return None
    n, folders = df.groupBy(*keys).count().agg(F.sum("count"), F.count(F.lit(1))).first()
    return folders if n and n >= FILE_ROWS * folders * df.rdd.getNumPartitions() else None


def in_folders(df: DataFrame, keys: list[str], write: Callable[[DataFrame], None], folders: int | None = None) -> None:
    """Write by partition. Rows are brought together by their folder, which moves all of them, unless they are of few folders.

    ``folders`` says of how many, if the caller knows; stored frames are asked. Then each task writes files of its own, side by side, unsorted.
    """
    spark, folders = df.sparkSession, folders or _folders(df, keys)
    with tidied(spark):
        if folders is None or folders > FEW_FOLDERS:
            write(rebalanced(df, keys))
        else:
            with settings(spark, spark__sql__maxConcurrentOutputFileWriters=str(FEW_FOLDERS)):
                write(df.select("*"))


def write_bronze_jsonl(events: DataFrame, base: str, ts: str = "ingestion_time", hours: int | None = None) -> None:
    """JSONL files of about 128 MB, compressed, under the ingestion hour. Events of few ``hours``, if that is known, are not moved."""
    out = with_hour(events.withColumn("_ts", F.col(ts).cast("timestamp")), "_ts").drop("_ts")
    in_folders(out, HOUR_KEYS, lambda df: df.write.mode("append").partitionBy(*HOUR_KEYS)
               .options(**BRONZE_FILES).options(**JSON_TIME).json(f"{base}/bronze"), hours)


def write_silver(df: DataFrame, base: str, ts: str = "ingestion_time") -> None:
    """Replace the hours present in ``df``; other hours stay. Running it again gives the same table."""
    _overwrite_present(with_hour(df, ts), f"{base}/silver", HOUR_KEYS)


def write_gold(df: DataFrame, path: str, partition_by: list[str] | None = None, mode: str = "overwrite") -> None:
    """Write a gold table. ``overwrite`` replaces only the partitions in ``df``; ``append`` accumulates."""
    if mode == "append":
        writer = df.write.mode("append")
        (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    else:
        _overwrite_present(df, path, partition_by or [])


def _overwrite_present(df: DataFrame, path: str, keys: list[str]) -> None:
    if not keys:
        df.write.mode("overwrite").parquet(path)
        return
    in_folders(df, keys, lambda rows: rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*keys).parquet(path))


def load_dimension(spark: SparkSession, path: str, schema: T.StructType, target: str | None = None,
                   multi_line: bool = True) -> DataFrame:
    """A JSON-array file (or, without ``multi_line``, JSON lines) as a dimension; with ``target`` it replaces the table there.

    A JSON array is read by one task; larger dimensions should arrive as JSON lines, which split.
    """
    df = spark.read.schema(schema).option("multiLine", multi_line).json(path)
    if target:
        df.write.mode("overwrite").parquet(target)
        return spark.read.schema(schema).parquet(target)
    return df


def land_raw(documents: DataFrame, base: str, logical_date: dt.date, run_id: str) -> None:
    """Raw documents under ``dt=/run_id=``; a repeated run replaces its own files only."""
    _overwrite_present(
        documents.withColumn("dt", F.lit(logical_date)).withColumn("run_id", F.lit(run_id)), base, ["dt", "run_id"])


def flatten_users(documents: DataFrame, run_ts: dt.datetime) -> DataFrame:
    """Full name, email and country of the first user in each API document."""
    user = F.try_element_at("results", F.lit(1))
    return documents.select(
        F.concat_ws(" ", user["name"]["first"], user["name"]["last"]).alias("name"),
        user["email"].alias("email"),
        user["location"]["country"].alias("country"),
        F.lit(run_ts).alias("ingested_at"),
    )


def parse_user_documents(raw: DataFrame, column: str = "value") -> DataFrame:
    return raw.select(F.from_json(column, USER_DOCUMENT).alias("d")).select("d.*")
