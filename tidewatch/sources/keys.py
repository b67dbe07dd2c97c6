"""The stored event keys: what a load asks instead of the raw events.

One narrow row for every stored event (its key, id and export), in partitions of a range of ids; events without an id have
partitions by hash of the key. A key made from an id equals only keys of that id, so a batch of events can only collide in
the partitions that its own ids and hashes fall in. The manifest gives their folders; nothing else is listed or read.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.operators.dedupe import BROADCAST_KEY_LIMIT, EVENT_KEY
from tidewatch.sources.tables import export_key
from tidewatch.sources.versioned import Version, VersionedTable, partitions_of

#: Ids of one partition, and partitions of events without an id.
ID_RANGE = 1_000_000
HASHED = 64
EVENT_KEYS = T.StructType([
    T.StructField("source", T.StringType()), T.StructField("dedupe_key", T.StringType()),
    T.StructField("global_event_id", T.LongType()), T.StructField("export_key", T.StringType()),
])


def key_partition(ids: int = ID_RANGE, hashed: int = HASHED) -> Column:
    """``id-<number of range>`` or ``key-<hash>``."""
    in_range = F.concat(F.lit("id-"), F.floor(F.col("global_event_id") / F.lit(ids)).cast("string"))
    by_hash = F.concat(F.lit("key-"), F.pmod(F.xxhash64("source", "dedupe_key"), F.lit(hashed)).cast("string"))
    return F.when(F.col("global_event_id").isNotNull(), in_range).otherwise(by_hash)


class EventKeys:
    """The key table under ``root``. Partition sizes belong to the table: give a stored one always the same."""

    def __init__(self, spark: SparkSession, root: str, ids: int = ID_RANGE, hashed: int = HASHED):
        self.table = VersionedTable(spark, root, EVENT_KEYS, key_partition(ids, hashed))

    def started(self) -> bool:
        return self.table.version().number > 0

    @staticmethod
    def of(events: DataFrame) -> DataFrame:
        """Key rows of stored or accepted events (``source``, ``dedupe_key``, ``global_event_id``, ``export_time_utc``)."""
        return events.select("source", "dedupe_key", F.col("global_event_id").cast("bigint").alias("global_event_id"), export_key().alias("export_key"))

    def rebuild(self, raw_events: DataFrame) -> Version:
        """All keys anew from the stored raw events: for tables that are older than their key table."""
        before = self.table.version()
        return self.table.replace(self.of(raw_events), [None, *before.partitions, *partitions_of(self.of(raw_events), self.table.partition)], before=before)

    def colliding(
        self, batch: DataFrame, own: list[str], recorded_next: DataFrame | None = None, withdrawn: Iterable[str] = (), rows: int | None = None
    ) -> DataFrame:
        """Distinct keys of ``batch`` that are stored for other exports than ``own``.

        ``recorded_next`` are accepted events whose keys count as stored already, ``withdrawn`` exports whose stored keys go then.
        ``batch`` needs the key and id columns only; the partitions that it falls in are the one thing collected, as many
        as a batch has ranges of ids. A batch of few ``rows`` (that or less) is broadcast to the stored keys; otherwise both sides are
        shuffled, since a partition's keys take some twenty times the room that their files let Spark expect.
        """
        sought = batch.select("source", "dedupe_key", F.col("global_event_id").cast("bigint").alias("global_event_id"))
        stored = self.table.read(partitions_of(sought, self.table.partition)).filter(~F.col("export_key").isin([*own, *withdrawn]))
        if recorded_next is not None:
            stored = stored.unionByName(self.of(recorded_next).filter(~F.col("export_key").isin(own)))
        sought, stored = (side.select(*EVENT_KEY) for side in (sought, stored))
        if rows is not None and rows <= BROADCAST_KEY_LIMIT:
            return stored.join(F.broadcast(sought.distinct()), EVENT_KEY, "left_semi").distinct()
        return sought.distinct().join(stored.hint("merge"), EVENT_KEY, "left_semi")

    def write(self, accepted: DataFrame) -> dict[str, str]:
        """Folders of the keys of accepted events, which are not in the table before they are recorded."""
        return self.table.write(self.of(accepted))

    def record(self, accepted: DataFrame, again: list[str], most_folders: int = 16, written: dict[str, str] | None = None) -> Version:
        """Add the keys of accepted events. Exports in ``again`` were recorded before: what they had is withdrawn with the
        same switch. Partitions in many small folders are compacted after."""
        rows = self.of(accepted)
        before = self.table.version()
        stale = self.table.read(at=before).filter(F.col("export_key").isin(again)) if again else None
        touched = partitions_of(stale, self.table.partition) if again else []
        if touched:
            new = partitions_of(rows, self.table.partition)
            kept = self.table.read({*touched, *new}, before).filter(~F.col("export_key").isin(again))
            return self.table.replace(kept.unionByName(rows), {*touched, *new}, before=before)
        after = self.table.append(rows, before=before, written=written)
        return self.table.compact(most_folders) or after
