"""A stream that ticks: every trigger is a micro-batch, whether or not anything arrived.

Spark's file stream runs a micro-batch only when a new file lands, so nothing it skipped or that failed comes up again on a
quiet feed. This source has one growing number as its offset and no rows but that; what a poll finds to do is
decided by whoever handles the micro-batch. With the trigger that works off what is there, it ticks once and ends.
"""

from __future__ import annotations

import time
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

TICKS = T.StructType([T.StructField("poll", T.LongType())])


class _Tick(InputPartition):
    def __init__(self, poll: int):
        self.poll = poll


class _Ticks(DataSourceStreamReader):
    def __init__(self):
        self.last = 0

    def initialOffset(self) -> dict:
        return {"poll": 0}

    def latestOffset(self) -> dict:
        self.last = max(self.last + 1, time.time_ns() // 1_000_000)  # grows over restarts too
        return {"poll": self.last}

    def partitions(self, start: dict, end: dict) -> list[_Tick]:
        self.last = max(self.last, end["poll"])
        return [_Tick(end["poll"])]

    def read(self, partition: _Tick) -> Iterator[tuple]:
        yield (partition.poll,)

    def commit(self, end: dict) -> None:
        self.last = max(self.last, end["poll"])


class Polls(DataSource):
    @classmethod
    def name(cls) -> str:
        return "polls"

    def schema(self) -> T.StructType:
        return TICKS

    def streamReader(self, schema: T.StructType) -> _Ticks:
        return _Ticks()


def polls(spark: SparkSession) -> DataFrame:
    spark.dataSource.register(Polls)
    return spark.readStream.format(Polls.name()).load()
