"""Queries with, side by side, the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.session import use_utc

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def plain(df: DataFrame) -> DataFrame:
    """Types that both engines write alike: 64-bit integers, doubles, zone-less timestamps, text for arrays."""
    def cast(field: T.StructField):
        c, dtype = F.col(f"`{field.name}`"), field.dataType
        if isinstance(dtype, (T.ByteType, T.ShortType, T.IntegerType)):
            return c.cast("bigint").alias(field.name)
        if isinstance(dtype, (T.DecimalType, T.FloatType)):
            return c.cast("double").alias(field.name)
        if isinstance(dtype, T.TimestampType):
            return c.cast("timestamp_ntz").alias(field.name)
        if isinstance(dtype, T.ArrayType):
            return F.array_join(c, ",").alias(field.name)
        return c

    return df.select([cast(field) for field in df.schema.fields])


def query(key: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(function: Query) -> Query:
        if key in QUERIES:
            raise ValueError(f"query registered twice: {key}")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return plain(function(use_utc(spark), sf_dir))

        QUERIES[key] = run
        if sql is not None:
            ORACLES[key] = sql
        return function

    return add


def value_query(key: str, source, columns: dict, sql_with: str, sql_from: str, sql_columns: dict) -> None:
    """Register expressions over whole rows: ``event_id`` and named results in both dialects."""
    listed = ", ".join(f"{text} AS {name}" for name, text in sql_columns.items())
    sql = f"WITH {sql_with} SELECT event_id, {listed} FROM {sql_from}"

    @query(key, sql)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return source(spark, sf_dir).select("event_id", *[make().alias(name) for name, make in columns.items()])
