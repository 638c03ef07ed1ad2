"""Serving tables kept up by streams: one folder for each micro-batch, merged into larger ones now and then.

A folder covers a run of batch ids. When enough folders of one level have come they are merged into one of
the next level, so their number grows with the logarithm of the batches and every row is rewritten as
often. A folder counts once its write is complete and no larger one covers it; what is covered is removed
by a later batch, so a reader that has just listed the folders still finds them. A replayed batch
overwrites its own folder, or is known to be merged already and skipped.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from .files import delete_path, folder_names, path_exists

Merge = Callable[[DataFrame], DataFrame]
BATCH = "batch_id"
MERGE_EVERY = 8
_NAME = re.compile(r"level(\d+)-(\d+)-(\d+)")


def summed(keys: list[str], measures: list[str]) -> Merge:
    """Rows of one key add up."""
    return lambda df: df.groupBy(*keys).agg(*[F.sum(m).cast(df.schema[m].dataType).alias(m) for m in measures], F.max(BATCH).alias(BATCH))


def appended(df: DataFrame) -> DataFrame:
    """Every row stays."""
    return df


class ServingTable:
    """Rows of micro-batches under ``path``; ``merge`` combines rows with their ``batch_id`` and may be applied in any grouping of runs.

    ``schema`` has the columns of a batch without ``batch_id``.
    """

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType | str, merge: Merge, every: int = MERGE_EVERY):
        if every < 2:
            raise ValueError("merge at least two folders at a time")
        self._spark, self._path, self._merge, self._every = spark, path, merge, every
        fields = (T.StructType.fromDDL(schema) if isinstance(schema, str) else schema).fields
        self._schema = T.StructType([*fields, T.StructField(BATCH, T.LongType())])

    def _complete(self) -> list[tuple[int, int, int]]:
        """Level, first and last batch of every folder whose write was committed."""
        found = [tuple(map(int, m.groups())) for m in map(_NAME.fullmatch, folder_names(self._spark, self._path)) if m]
        return sorted(f for f in found if path_exists(self._spark, f"{self._folder(f)}/_SUCCESS"))

    def _folder(self, run: tuple[int, int, int]) -> str:
        return f"{self._path}/level{run[0]}-{run[1]}-{run[2]}"

    @staticmethod
    def _covered(run, others) -> bool:
        return any(o[0] > run[0] and o[1] <= run[1] and run[2] <= o[2] for o in others)

    def _visible(self) -> list[tuple[int, int, int]]:
        every = self._complete()
        return [r for r in every if not self._covered(r, every)]

    def _rows(self, runs) -> DataFrame:
        if not runs:
            return self._spark.createDataFrame([], self._schema)
        return self._spark.read.schema(self._schema).parquet(*[self._folder(r) for r in runs])

    def write(self, batch: DataFrame, batch_id: int) -> None:
        every = self._complete()
        for run in every:
            if self._covered(run, every):
                delete_path(self._spark, self._folder(run))
        if any(r[0] > 0 and r[1] <= batch_id <= r[2] for r in every):
            return
        stamped = batch.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in self._schema.fields[:-1]], F.lit(batch_id).cast("bigint").alias(BATCH))
        stamped.write.mode("overwrite").parquet(self._folder((0, batch_id, batch_id)))
        level = 0
        while len(same := [r for r in self._visible() if r[0] == level]) >= self._every:
            merged = self._merge(self._rows(same)).select(self._schema.names)
            merged.write.mode("overwrite").parquet(self._folder((level + 1, min(r[1] for r in same), max(r[2] for r in same))))
            level += 1

    def is_merged(self, batch_id: int) -> bool:
        """Whether a batch was written long enough ago to be part of a merged folder; writing it again has no effect."""
        return any(r[0] > 0 and r[1] <= batch_id <= r[2] for r in self._complete())

    def without(self, batch_id: int) -> DataFrame:
        """The rows of all batches but one that is not merged yet."""
        return self._merge(self._rows([r for r in self._visible() if r != (0, batch_id, batch_id)])).select(self._schema.names)

    def read(self) -> DataFrame:
        """The current rows, with the last batch that changed them."""
        return self._merge(self._rows(self._visible())).select(self._schema.names)

    def folders(self) -> list[str]:
        return folder_names(self._spark, self._path)
