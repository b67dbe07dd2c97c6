"""First occurrence per key, and what is new against stored history."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

EVENT_KEY = ["source", "dedupe_key"]
ARRIVAL = ["export_time_utc", "row_number"]

#: Most keys a task may hold as a broadcast hash table: some 300 bytes each with the table's own pages, which grow by
#: doubling, so at most some 150 MB; more keys meet their rows by a shuffle.
BROADCAST_KEY_LIMIT = 250_000


def first_per_key(df: DataFrame, keys: list[str], order: list[Column | str]) -> DataFrame:
    """The first row of each key in the given total order.

    Spark limits each key to one row per task before the shuffle, so a key that holds a large share of all rows
    sends one row per task, not its whole group, to the task that decides.
    """
    return rank_per_key(df, keys, order).filter("_rank = 1").drop("_rank")


def rank_per_key(df: DataFrame, keys: list[str], order: list[Column | str], name: str = "_rank") -> DataFrame:
    return df.withColumn(name, F.row_number().over(W.partitionBy(*keys).orderBy(*order)))


def not_stored(
    batch: DataFrame,
    history: DataFrame,
    keys: list[str],
    batch_rows: int | None = None,
    batch_keys: DataFrame | None = None,
) -> DataFrame:
    """Rows of ``batch`` whose key is not in ``history``.

    A batch counted to be small is turned around: its keys are broadcast to the history scan, which then keeps only
    the few keys that collide, and history is not shuffled at all. Without a known small size both sides are
    hash-partitioned on the key. ``batch_keys`` may give a cheaper frame with the same keys.
    """
    stored = history.select(*keys)
    if batch_rows is not None and batch_rows <= BROADCAST_KEY_LIMIT:
        sought = (batch if batch_keys is None else batch_keys).select(*keys)
        colliding = stored.join(F.broadcast(sought), keys, "left_semi").distinct()
        return batch.join(colliding, keys, "left_anti")
    return batch.join(stored, keys, "left_anti")


def same_id_range(history: DataFrame, lowest: int | None, highest: int | None) -> DataFrame:
    """History rows that can share a key with events whose ids lie in the given range, or with events without an id.

    A key made from an id can only equal a key of that same id. Ids grow with time, so the range skips nearly all row
    groups of the stored table by their statistics.
    """
    without_id = F.col("global_event_id").isNull()
    if lowest is None or highest is None:
        return history.filter(without_id)
    return history.filter(without_id | F.col("global_event_id").between(lowest, highest))


def repeated_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that ``df`` has twice or more. Only keys are shuffled, counted in each task first."""
    return df.groupBy(*keys).agg(F.count("*").alias("_n")).filter("_n > 1").drop("_n")


def first_of_new(
    batch: DataFrame, taken: DataFrame | None = None, keys: list[str] | None = None, order: list[Column | str] | None = None,
    stage: Callable[[str, DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Rows to append: of each key the first, unless it is among ``taken`` (distinct keys that are stored).

    Nearly all keys of a batch are new and unique, so whole rows are not shuffled to find that out: keys alone are
    counted, and only rows of repeated keys go through the window that picks the first. The keys that matter (repeated or
    taken) are counted and broadcast up to :data:`BROADCAST_KEY_LIMIT`, joined by a shuffle beyond. ``batch`` is read
    three times, twice for its keys: give a stored frame. ``stage`` may write a named frame and read it back, so that
    those keys are found once.
    """
    keys = keys or EVENT_KEY
    marked = repeated_keys(batch, keys).withColumn("_repeated", F.lit(True)).withColumn("_taken", F.lit(False))
    if taken is not None:
        stored = taken.select(*keys).withColumn("_repeated", F.lit(False)).withColumn("_taken", F.lit(True))
        marked = marked.unionByName(stored).groupBy(*keys).agg(F.bool_or("_repeated").alias("_repeated"), F.bool_or("_taken").alias("_taken"))
    if stage is not None:
        marked = stage("keys-in-question", marked)
    side = F.broadcast(marked) if marked.count() <= BROADCAST_KEY_LIMIT else marked
    rows = batch.join(side, keys, "left").filter(~F.coalesce("_taken", F.lit(False))).drop("_taken")
    single = rows.filter(~F.coalesce("_repeated", F.lit(False))).drop("_repeated")
    several = rows.filter("_repeated").drop("_repeated")
    return single.unionByName(first_per_key(several, keys, order or ARRIVAL))


def new_events(
    batch: DataFrame,
    history: DataFrame | None = None,
    keys: list[str] | None = None,
    order: list[Column | str] | None = None,
    batch_rows: int | None = None,
) -> DataFrame:
    """Events to append: first occurrence within the batch, and not loaded before."""
    keys = keys or EVENT_KEY
    first = first_per_key(batch, keys, order or ARRIVAL)
    return first if history is None else not_stored(first, history, keys, batch_rows, batch)


def inserted_only(rows: DataFrame, inserted: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Rows whose key was just inserted."""
    keys = keys or EVENT_KEY
    return rows.join(inserted.select(*keys), keys, "left_semi")
