"""Session settings the library relies on, and the shared folder jobs may write to."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

REQUIRED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}

# transformWithState keeps its state in RocksDB, off the executor heap.
STREAMING = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}

ADAPTIVE = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def build_session(app: str = "tiffinlake", master: str | None = None, **conf: str) -> SparkSession:
    """A session with UTC time, dynamic partition overwrite, AQE and RocksDB state.

    Shuffle parallelism is left to the cluster's own configuration and to AQE; pass
    ``**{"spark.sql.shuffle.partitions": ...}`` to fix it.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {"spark.ui.enabled": "false", **REQUIRED, **STREAMING, **ADAPTIVE, **conf}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session somebody else created."""
    for key, value in {**REQUIRED, **STREAMING}.items():
        spark.conf.set(key, value)
    return spark


def shared_root(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it in ``spark.checkpoint.dir``.

    Only a local session that names none, where driver and executors are one process, gets a
    temporary folder, which its Spark context then remembers.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tiffinlake-"))
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def scratch(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder."""
    return f"{shared_root(spark)}/{label}-{uuid.uuid4().hex}"


@contextmanager
def settings(spark: SparkSession, **conf: str) -> Iterator[None]:
    """Session settings (``__`` for a dot) that hold within the block."""
    named = {key.replace("__", "."): value for key, value in conf.items()}
    before = {key: spark.conf.get(key, None) for key in named}
    for key, value in named.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def tidied(spark: SparkSession):
    """Within the block, frames that are made and written leave no shuffle files behind, which else stay until the driver collects garbage."""
    return settings(spark, spark__sql__classic__shuffleDependency__fileCleanup__enabled="true")


def materialize(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts lineage and survives lost executors."""
    path = scratch(df.sparkSession, label)
    with tidied(df.sparkSession):
        df.select("*").write.parquet(path)
    stored = df.sparkSession.read.schema(df.schema).parquet(path)
    stored._stored_at = path
    return stored


def discard(stored: DataFrame) -> None:
    """Remove the files of a frame from :func:`materialize` that nothing reads any more."""
    spark = stored.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(stored._stored_at)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
