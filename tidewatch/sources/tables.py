"""The stored tables: Parquet folders under one root.

Event tables are partitioned so that (1) readers prune by date, and (2) an export owns its partitions: publishing an
export again replaces exactly its own rows. So it is in the tables with a few rows an export (quarantine, audit, warnings,
histograms), whose files hold a day's exports, since a file for each would cost more than all its rows. Ledgers are logs with a manifest: each append is one more folder, and many are
made one, so that a ledger has a bounded number of files however many loads it has seen. Repairs are finished when the tables
are opened.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import or_

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch import schemas
from tidewatch.operators.ledger import VERSION
from tidewatch.session import with_setting
from tidewatch.sources import files, repairs
from tidewatch.sources.versioned import Version, VersionedTable, partitions_of

EXPORT_KEY = "export_key"
_VERSION = T.StructField(VERSION, T.LongType())
_TABLES: dict[str, tuple[T.StructType, list[str]]] = {
    "raw_events": (schemas.RAW_EVENTS, ["export_date", EXPORT_KEY]),
    "normalized_events": (schemas.NORMALIZED_EVENTS, ["event_date", EXPORT_KEY]),
    "dropped_events": (schemas.DROPPED_EVENTS, ["export_date", EXPORT_KEY]),
    "data_quality_audit": (schemas.QUALITY_AUDIT, ["export_date", EXPORT_KEY]),
    "quality_warnings": (schemas.QUALITY_WARNINGS, ["export_date", EXPORT_KEY]),
    "load_histograms": (schemas.LOAD_HISTOGRAMS, ["export_date", EXPORT_KEY]),
    "ingestion_runs": (T.StructType([*schemas.INGESTION_RUNS.fields, _VERSION]), []),
    "export_checkpoints": (T.StructType([*schemas.EXPORT_CHECKPOINTS.fields, _VERSION]), []),
}
#: Spark's folder name for a null.
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"
#: Logs: one partition, rewritten as one folder once it has more than so many.
LEDGERS = ("ingestion_runs", "export_checkpoints")
MOST_LEDGER_FOLDERS = 16
#: A few rows an export: many exports share the files of a day, which a manifest names.
DAILY = ("dropped_events", "data_quality_audit", "quality_warnings", "load_histograms")
MOST_DAILY_FOLDERS = 16
_LISTING_TASKS = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
#: Tasks move their files when they end, not the driver one by one: into the staging folder of a dynamic overwrite, which
#: the driver switches at the end as before.
_TASKS_MOVE = {"mapreduce.fileoutputcommitter.algorithm.version": "2"}
_PARTITION_TYPES = {"export_date": T.DateType(), "event_date": T.DateType(), EXPORT_KEY: T.StringType()}


def export_key(time_column: str = "export_time_utc", source_column: str = "source"):
    """An export's own key, as in the ledger: two sources may have exports of one time."""
    return F.concat_ws("-", source_column, F.date_format(time_column, "yyyyMMddHHmmss"))


class EventTables:
    """Readers and writers of the tables under ``root``, a folder all executors can reach."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        repairs.finish(spark, self.root)

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def schema(self, name: str) -> T.StructType:
        fields, partitions = _TABLES[name]
        return T.StructType([*fields.fields, *[T.StructField(p, _PARTITION_TYPES[p]) for p in partitions]])

    def read(self, name: str) -> DataFrame:
        """The table with its partition columns; an empty frame before the first write."""
        if name in (*LEDGERS, *DAILY):
            stored = self._ledger(name) if name in LEDGERS else self._daily(name)
            if (version := stored.version()).number:
                return stored.read(at=version)
        if name in DAILY:
            return self._per_export(name)
        try:
            return self._folders(name, [self.path(name)])
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], self.schema(name))

    def _folders(self, name: str, folders: list[str]) -> DataFrame:
        """The rows under folders of a table. Spark lists many folders by a job with a task for each; here a few tasks a core
        share them, since listing one takes much less time than starting a task."""
        tasks = 2 * self.spark.sparkContext.defaultParallelism
        with with_setting(self.spark, _LISTING_TASKS, str(tasks)):
            return self.spark.read.schema(self.schema(name)).option("basePath", self.path(name)).parquet(*folders)

    def _per_export(self, name: str) -> DataFrame:
        """A daily table without a manifest: partitions by date and export, as older versions of this library wrote it."""
        days = [f"{self.path(name)}/{n}" for n in files.children(self.spark, self.path(name)) if n.startswith("export_date=")]
        if not days:
            return self.spark.createDataFrame([], self.schema(name))
        return self._folders(name, days)

    def keys(self):
        """The stored event keys; made from the raw events where these are older than their key table."""
        from tidewatch.sources.keys import EventKeys

        keys = EventKeys(self.spark, self.path("event_keys"))
        if not keys.started():
            raw = self.read("raw_events")
            if not raw.isEmpty():
                keys.rebuild(raw)
        return keys

    def spike_snapshots(self) -> VersionedTable:
        """Spikes as they were at each moment they were computed for, a partition a moment and window."""
        partition = F.concat_ws(" ", F.date_format("computed_at", "yyyy-MM-dd HH:mm:ss"), F.col("window_hours").cast("string"))
        return VersionedTable(self.spark, self.path("spike_snapshot"), schemas.SPIKE_SNAPSHOT, partition)

    def keep_spikes(self, snapshot: DataFrame, computed_at: str, window_hours: int) -> Version:
        """Store a snapshot in place of an earlier one of that moment and window, so that a repeat adds nothing."""
        return self.spike_snapshots().replace(snapshot, [f"{computed_at} {window_hours}"])

    def events(self, since_date: str | None = None) -> DataFrame:
        """The query table, from a date on if given: a bound on whole partitions, which are listed but not read beyond."""
        events = self.read("normalized_events")
        return events if since_date is None else events.filter(F.col("event_date") >= F.lit(since_date).cast("date"))

    def _ledger(self, name: str) -> VersionedTable:
        return VersionedTable(self.spark, self.path(name), self.schema(name), F.lit("log"))

    def _daily(self, name: str) -> VersionedTable:
        return VersionedTable(self.spark, self.path(name), self.schema(name), F.col("export_date").cast("string"))

    def append(self, name: str, df: DataFrame) -> None:
        """Add rows to a ledger, a few per export or run, as one file. Rows of a ledger without a manifest, as older
        versions of this library wrote it, come along with the first."""
        log, rows = self._ledger(name), df.select(*self.schema(name).names)
        if not log.version().number:
            rows = rows.unionByName(self.read(name))
        log.append(rows.coalesce(1))
        if log.compact(MOST_LEDGER_FOLDERS):
            log.sweep()

    def rewrite_ledger(self, name: str, change: Callable[[DataFrame], DataFrame]) -> None:
        """A ledger's rows after ``change``, by one switch."""
        log = self._ledger(name)
        log.replace(change(self.read(name)).coalesce(1), ["log"])

    def repair(self, name: str, repaired: DataFrame) -> bool:
        """Write back a table's repaired rows (all columns; ``_changed`` where a row differs, ``_deleted``, if there is such
        a column, where one goes); whether any did.

        Only partitions with such a row are written, and they are switched together.
        """
        gone = F.col("_deleted") if "_deleted" in repaired.columns else F.lit(False)
        marked = repaired.select(*self.schema(name).names, "_changed", gone.alias("_deleted"))
        if name in DAILY and (before := (daily := self._daily(name)).version()).number:
            touched = partitions_of(marked.filter("_changed OR _deleted"), daily.partition)
            if touched:
                same_day = reduce(or_, [daily.partition.eqNullSafe(F.lit(day)) for day in touched])
                daily.replace(marked.filter(same_day & F.expr("NOT _deleted")), touched, before=before)
            return bool(touched)
        folder = repairs.prepare(self.spark, self.root, name, marked, _TABLES[name][1])
        repairs.finish(self.spark, self.root)
        return folder is not None

    def withdraw(self, name: str, exports: list[tuple[str, str]]) -> None:
        """Delete the partitions of exports (key, date) that are loaded again, so that none stays that gets no rows this
        time. Tables by export date name them outright; in the others the folders of dates are looked through."""
        if not exports:
            return
        if name in DAILY and (before := (daily := self._daily(name)).version()).number:
            days = {date for _, date in exports} & before.partitions.keys()
            stored = daily.read(days, before)
            own = F.col(EXPORT_KEY).isin([key for key, _ in exports])
            if days and not stored.filter(own).isEmpty():
                daily.replace(stored.filter(~own), days, before=before)
            return
        first = _TABLES[name][1][0]
        by_date = first == "export_date"
        dates = [] if by_date else [n for n in files.children(self.spark, self.path(name)) if n.startswith(f"{first}=")]
        for key, date in exports:
            for folder in [f"export_date={date}"] if by_date else dates:
                files.delete(self.spark, f"{self.path(name)}/{folder}/{EXPORT_KEY}={key}")

    def newest_dates(self, name: str = "normalized_events") -> list[str | None]:
        """Dates of the partitions, newest first, the unknown date last."""
        first = _TABLES[name][1][0]
        dates = [n.split("=", 1)[1] for n in files.children(self.spark, self.path(name)) if n.startswith(f"{first}=")]
        known = sorted((d for d in dates if not d.startswith("__")), reverse=True)
        return [*known, *([None] if len(known) < len(dates) else [])]

    def newest_events(self, rows: int) -> DataFrame:
        """The newest date partitions of the query table that together hold ``rows`` rows: all that a top-k by time needs.

        Dates are listed and read one after another, for their counts alone, until there are enough; older ones are not even
        listed. Rows of unknown time come last.
        """
        name, wanted, held = "normalized_events", [], 0
        for date in self.newest_dates(name):
            wanted.append(f"{self.path(name)}/{_TABLES[name][1][0]}={NO_VALUE if date is None else date}")
            held += self._folders(name, wanted[-1:]).limit(rows - held).count()
            if held >= rows:
                break
        return self._folders(name, wanted) if wanted else self.read(name)

    def publish(self, name: str, df: DataFrame) -> None:
        """Write whole exports: each replaces the partitions it owns and no others.

        Rows are spread over writers by partition value; Spark splits large exports over several tasks and packs small
        ones together, so that neither one task nor a flood of tiny files results.
        """
        fields, partitions = _TABLES[name]
        values = {
            "export_date": F.to_date("export_time_utc"),
            "event_date": F.to_date("event_time_utc"),
            EXPORT_KEY: export_key(),
        }
        keyed = df.withColumns({p: values[p] for p in partitions}).select(*fields.names, *partitions)
        if name in DAILY:
            self._publish_daily(name, keyed)
            return
        keyed = keyed.hint("rebalance", *partitions)
        if "location_key" in fields.names:  # near places side by side, so that row groups have small boxes
            keyed = keyed.sortWithinPartitions(*partitions, "location_key")
        (
            keyed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").options(**_TASKS_MOVE)
            .partitionBy(*partitions).parquet(self.path(name))
        )

    def _publish_daily(self, name: str, rows: DataFrame) -> None:
        """Add the rows of whole exports to the files of their days, in place of what those exports had. Rows of a table
        without a manifest, as older versions of this library wrote it, come along with the first."""
        daily = self._daily(name)
        before = daily.version()
        if not before.number:
            older = self._per_export(name)
            if older.inputFiles():
                rows = rows.unionByName(older.join(rows.select(EXPORT_KEY).distinct(), EXPORT_KEY, "left_anti"))
            daily.append(rows, before=before)
            return
        after = daily.append(rows, before=before, replaces=EXPORT_KEY)
        if any(len(folders) > MOST_DAILY_FOLDERS for folders in after.partitions.values()):
            daily.compact(MOST_DAILY_FOLDERS)
            daily.sweep()
