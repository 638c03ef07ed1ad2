from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from tiffinlake.session import prepare

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def presentable(df: DataFrame) -> DataFrame:
    """Types both engines print alike: decimals as doubles, dates as text, timestamps without zone."""
    out = []
    for field in df.schema.fields:
        c, kind = F.col(f"`{field.name}`"), field.dataType
        if isinstance(kind, T.DecimalType):
            c = c.cast("double")
        elif isinstance(kind, T.DateType):
            c = c.cast("string")
        elif isinstance(kind, T.TimestampType):
            c = c.cast("timestamp_ntz")
        elif isinstance(kind, (T.ArrayType, T.MapType, T.StructType)):
            c = F.to_json(c)
        out.append(c.alias(field.name))
    return df.select(*out)


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return presentable(fn(prepare(spark), sf_dir))

        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            SQL[name] = sql
        return fn

    return register
