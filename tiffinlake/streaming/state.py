"""What a stateful stream still remembers, read from its checkpoint."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def state_left(spark: SparkSession, checkpoint: str, variable: str, batch_id: int | None = None) -> DataFrame:
    """Keys and values of a state variable after the last batch (or ``batch_id``): what no timer and no clearing has removed.

    A map variable has ``key, user_map_key, user_map_value``, others ``key, value`` or ``key, list_element``.
    """
    reader = spark.read.format("statestore").option("path", checkpoint).option("stateVarName", variable)
    if batch_id is not None:
        reader = reader.option("batchId", batch_id)
    return reader.load().drop("partition_id")
