"""Hourly counts as a stream: emitted under a watermark, or kept in a stored table that late rows correct.

:func:`stream_hourly_counts` emits an hour once the watermark has passed it and holds the open hours as state; rows later than
that are dropped by Spark, which is the price of a bounded state. :func:`maintain_hourly_counts` has no such price: each
micro-batch is counted by itself and its counts are merged into the stored hours that it touches, however old they are.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidewatch.functions.times import is_future_outlier
from tidewatch.session import remove_shared_folder, shared_folder
from tidewatch.sources.versioned import Version, VersionedTable, day, partitions_of

#: What a stored table may count by, and the column of an event that it is.
GROUPS = {"category": "primary_category", "country_name": "country_name"}
_MOMENT = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def guard_future(events: DataFrame, as_of: datetime | str, time: str = "event_time_utc") -> DataFrame:
    """Drop events from the future. Placed before a watermark, so that one bad time cannot advance it."""
    return events.filter(~is_future_outlier(time, as_of))


def stream_hourly_counts(
    events: DataFrame, lateness: str = "1 day", as_of: datetime | str | None = None, time: str = "event_time_utc"
) -> DataFrame:
    """Counts per hour and category, final once the watermark has passed the hour. State holds the open hours only."""
    guarded = events if as_of is None else guard_future(events, as_of, time)
    hour = F.window(time, "1 hour")
    counts = (
        guarded.withWatermark(time, lateness)
        .groupBy(hour, F.col("primary_category").alias("category"))
        .agg(F.count("*").alias("event_count"))
    )
    return counts.select(F.col("window.start").alias("hour_bucket"), "category", "event_count")


def hourly_table(spark: SparkSession, root: str, by: tuple[str, ...] = ("category",)) -> VersionedTable:
    """The stored hours, in partitions by day.

    ``late_count`` says how many of the ``event_count`` rows came after the hour was closed.
    """
    fields = [("hour_bucket", T.TimestampType()), *[(name, T.StringType()) for name in by], ("event_count", T.LongType()), ("late_count", T.LongType())]
    return VersionedTable(spark, root, T.StructType([T.StructField(*f) for f in fields]), day("hour_bucket"))


def merge_hourly(
    table: VersionedTable, events: DataFrame, stream: str, batch_id: int, lateness: str = "1 day", time: str = "event_time_utc"
) -> Version:
    """Count ``events`` and add the counts to the days they fall in, once for each ``batch_id`` of ``stream``.

    An hour is closed once an earlier micro-batch had an event ``lateness`` after its end; a row of a closed hour counts as
    late. The batch's number and the newest time seen are notes of the same version as the counts: a repeated batch
    changes nothing, and which rows are late does not depend on when a batch ran. Rows without a time are counted under a
    null hour. Only the touched days are read and written; the batch is read once.
    """
    spark = table.spark
    before = table.version()
    done, newest = before.notes.get("batches", {}), before.notes.get("newest")
    if done.get(stream, -1) >= batch_id:
        return before
    by = [name for name in table.schema.names if name in GROUPS]
    hour = F.date_trunc("hour", time)
    closed = F.lit(False) if newest is None else hour + F.expr("INTERVAL 1 HOUR") + F.expr(f"INTERVAL {lateness}") < F.lit(newest).cast("timestamp")
    counted = (
        events.groupBy(hour.cast("timestamp").alias("hour_bucket"), *[F.col(GROUPS[name]).alias(name) for name in by])
        .agg(F.count("*").alias("event_count"), F.count_if(F.coalesce(closed, F.lit(False))).alias("late_count"), F.max(time).alias("newest"))
    )
    folder = shared_folder(spark, "hours")
    counted.write.parquet(folder)
    partial = spark.read.parquet(folder)
    touched = partitions_of(partial, table.partition)
    latest = partial.agg(F.date_format(F.max("newest"), _MOMENT)).first()[0]
    merged = (
        table.read(touched, before).unionByName(partial.drop("newest")).groupBy("hour_bucket", *by)
        .agg(F.sum("event_count").alias("event_count"), F.sum("late_count").alias("late_count"))
    )
    notes = before.notes | {"batches": done | {stream: batch_id}, "newest": max(filter(None, [newest, latest]), default=None)}
    after = table.replace(merged, touched, notes, before)
    remove_shared_folder(spark, folder)
    return after


def maintain_hourly_counts(
    events: DataFrame, table: VersionedTable, checkpoint: str, stream: str = "events", lateness: str = "1 day",
    as_of: datetime | str | None = None, time: str = "event_time_utc", every: str | None = None,
) -> StreamingQuery:
    """Keep ``table`` up to date with a stream of events. Without ``every`` the query works off what is there and ends.

    No state is held and no row is refused. The table remembers the last micro-batch of each ``stream``, so one that is
    repeated after a stop is not counted twice; a new checkpoint needs a new ``stream`` name or a new table.
    """
    guarded = events if as_of is None else guard_future(events, as_of, time)

    def merge(batch: DataFrame, batch_id: int) -> None:
        merge_hourly(table, batch, stream, batch_id, lateness, time)

    writer = guarded.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)
    return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()
