"""Loading exports: parse, type, classify, validate, split, de-duplicate against all history, publish, record.

One load takes any number of exports. Each file counts once however often it is offered: completed exports are skipped,
events already stored are not stored again, and a load that broke off is repeated by simply running it again.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import Future, ThreadPoolExecutor
from datetime import datetime
from functools import partial
from itertools import groupby, islice

import pyarrow as pa
from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch import fixed_values as fv
from tidewatch.operators import ledger as lg
from tidewatch.operators.dedupe import first_of_new
from tidewatch.operators.normalize import normalize_events
from tidewatch.operators.project import dropped_rows, normalized_rows, raw_rows
from tidewatch.operators.quality import audit_rows, load_histograms, quality_counters, quality_warnings
from tidewatch.operators.validate import parse_error_drops, surviving, validate_and_clean, validation_drops
from tidewatch.session import remove_shared_folder, shared_folder, use_utc
from tidewatch.sources.exports import discover_new, latest_export, list_exports, scan_export_tsv, with_export_metadata
from tidewatch.sources.tables import EventTables, export_key
from tidewatch.sources.zips import read_zips

Moment = datetime | str


def label_rows(rows: DataFrame, as_of: Moment, run_id: str, source: str = fv.SOURCE) -> DataFrame:
    """File rows as validated events with an ``outcome``: candidate, dropped, parse_error or file_error.

    One pass without a shuffle. Malformed rows keep their columns for the quarantine.
    """
    with_origin = with_export_metadata(rows.withColumnRenamed("path", "export_url"))
    events = normalize_events(with_origin.drop("export_filename"), source, run_id, country_names=False)
    validated = validate_and_clean(events, as_of)
    outcome = (
        F.when(F.col("file_error").isNotNull(), "file_error")
        .when(F.col("cols").isNotNull(), "parse_error")
        .when(F.col("drop"), "dropped")
        .otherwise("candidate")
    )
    return validated.withColumn("outcome", outcome)


def _summary(labelled: DataFrame) -> DataFrame:
    """Per export: rows by outcome, quality counters of the surviving rows and, if a file was unreadable, why."""
    def rows(*labels: str) -> Column:
        return F.count_if(F.col("outcome").isin(*labels))

    return labelled.groupBy(*lg.CHECKPOINT_KEY).agg(
        rows("candidate", "dropped").alias("rows_seen"),
        rows("dropped").alias("rows_dropped"),
        rows("parse_error").alias("parse_errors"),
        *quality_counters(F.col("outcome") == "candidate"),
        F.min("file_error").alias("error_message"),
    )


def _counts(exports: DataFrame, summary: DataFrame, accepted: DataFrame) -> DataFrame:
    """Per readable export, empty ones included: the counters that the ledger and the audit record."""
    inserted = accepted.groupBy(*lg.CHECKPOINT_KEY).agg(F.count("*").alias("rows_inserted"))
    joined = (
        exports.select(*lg.CHECKPOINT_KEY).distinct().join(summary, lg.CHECKPOINT_KEY, "left")
        .filter("error_message is null").drop("error_message").join(inserted, lg.CHECKPOINT_KEY, "left").fillna(0)
    )
    duplicated = F.col("rows_seen") - F.col("rows_inserted") - F.col("rows_dropped")
    return joined.withColumn("rows_duplicated", F.greatest(duplicated, F.lit(0).cast("bigint")))


def _together(spark: SparkSession, *actions: Callable[[], None]) -> None:
    """Run independent writes side by side, so that small ones do not wait for each other."""
    with ThreadPoolExecutor(len(actions)) as pool:
        for done in [pool.submit(inheritable_thread_target(spark)(action)) for action in actions]:
            done.result()


class _Batch:
    """What a load works out before it writes to the tables: its rows validated, those that it accepts, the counters.

    Validated rows, the accepted ones among them and the counters are each written once to the shared folder and read from
    there, so that no later step repeats the parsing and a lost executor costs a re-read. No table is changed here, so a
    batch may be worked out while the load before it is being written. ``retried`` are those exports of the batch that were
    tried before, their key and date; if it is not given, the ledger is asked once they are claimed.
    """

    def __init__(
        self, tables: EventTables, rows: Callable[[], DataFrame], exports: DataFrame, as_of: Moment, run_id: str, source: str,
        retried: list[tuple[str, str]] | None = None,
    ):
        self.tables, self.rows, self.exports, self.as_of, self.run_id, self.source = tables, rows, exports, as_of, run_id, source
        self.retried, self.folders = retried, []

    def stage(self, name: str, df: DataFrame) -> DataFrame:
        spark = self.tables.spark
        self.folders.append(shared_folder(spark, name))
        df.write.parquet(self.folders[-1])
        return spark.read.parquet(self.folders[-1])

    def parse(self) -> None:
        labelled = self.stage("staged-rows", label_rows(self.rows(), self.as_of, self.run_id, self.source))
        self.summary = self.stage("staged-counts", _summary(labelled))
        self.broken = self.summary.filter("error_message is not null").select(*lg.CHECKPOINT_KEY, "error_message")
        self.usable = labelled
        found = self.summary.agg(F.count("error_message").alias("broken"), F.coalesce(F.sum("rows_seen"), F.lit(0)).alias("rows")).first()
        self.rows_at_most = found["rows"]
        if found["broken"]:
            self.usable = labelled.join(self.broken.select(*lg.CHECKPOINT_KEY), lg.CHECKPOINT_KEY, "left_anti")

    def decide(self, before: _Batch | None = None) -> None:
        """``before``: the batch whose load comes between the stored keys and this one. What it accepts counts as stored, and
        what its exports had from an earlier try as withdrawn."""
        # As constants, the keys of this load's own exports (a bounded number) are told from those of others without a join.
        own = [row[0] for row in self.exports.select(export_key()).distinct().collect()]
        self.keys = before.keys if before else self.tables.keys()
        candidates = surviving(self.usable.filter("outcome = 'candidate'"))
        between = (before.accepted, [key for key, _ in before.retried]) if before else (None, [])
        taken = self.keys.colliding(candidates, own, *between, self.rows_at_most)
        self.accepted = self.stage("accepted-rows", first_of_new(candidates, taken, stage=self.stage))
        self.counts = self.stage("load-counts", _counts(self.exports, self.summary, self.accepted))

    def clear(self) -> None:
        while self.folders:
            remove_shared_folder(self.tables.spark, self.folders.pop())


def load_rows(
    tables: EventTables,
    rows: DataFrame | None,
    exports: DataFrame,
    as_of: Moment,
    run_id: str | None = None,
    trigger_mode: str = "manual",
    source: str = fv.SOURCE,
    ready: Callable[[], _Batch] | None = None,
) -> DataFrame:
    """Load the rows of ``exports`` (``source``, ``export_time_utc``, ``export_url``, ``export_filename``).

    Order of writes: quarantine, raw, normalized and audit partitions first, the ledger's ``completed`` rows last, so a
    completed export is always whole; an unreadable file fails its own export only. ``ready``, if given, waits for the batch that
    is worked out elsewhere, and ``rows`` are not read. Returns the counters per export.
    """
    spark = use_utc(tables.spark)
    run_id = run_id or str(uuid.uuid4())
    known = _of(tables, exports)
    before = spark.createDataFrame(known.collect(), known.schema)  # at most a row for each of the names that the driver has
    opened = lg.open_runs(spark.createDataFrame([(run_id,)], "id string"), as_of, trigger_mode)
    fresh = lg.new_checkpoints(before, exports, as_of)
    mine = before.unionByName(fresh)
    _together(
        spark,
        lambda: tables.append("ingestion_runs", opened),
        lambda: tables.append("export_checkpoints", fresh.unionByName(lg.claimed(mine, as_of))),
    )
    batch = _Batch(tables, lambda: rows, exports, as_of, run_id, source)
    try:
        if ready is None:
            batch.parse()
            batch.decide()
        return _publish(batch if ready is None else ready())
    except Exception as error:
        _record_failure(tables, exports, as_of, run_id, str(error) or "load failed")
        raise
    finally:
        batch.clear()


def _record_failure(tables: EventTables, exports: DataFrame, as_of: Moment, run_id: str, message: str) -> None:
    """Mark the run and its exports failed, so that the next load takes them up again."""
    errors = exports.select(*lg.CHECKPOINT_KEY, F.lit(message).alias("error_message"))
    tables.append("export_checkpoints", lg.failed(_of(tables, exports), errors))
    fields = "id string, status string, error_summary string, finished boolean"
    patch = tables.spark.createDataFrame([(run_id, "failed", message, True)], fields)
    tables.append("ingestion_runs", lg.run_patches(patch, as_of))


def _publish(batch: _Batch) -> DataFrame:
    tables, as_of, usable, accepted, counts, broken = batch.tables, batch.as_of, batch.usable, batch.accepted, batch.counts, batch.broken
    spark = tables.spark
    rejected = parse_error_drops(usable.filter("outcome = 'parse_error'"), batch.source).unionByName(
        validation_drops(usable.filter("outcome = 'dropped'"))
    )
    claimed = _of(tables, batch.exports)
    date = F.date_format("export_time_utc", "yyyy-MM-dd")
    again = batch.retried
    if again is None:
        again = [tuple(row) for row in claimed.filter("attempt_count > 1").select(export_key(), date).distinct().collect()]
    audit = audit_rows(counts.withColumnRenamed("rows_seen", "total_events"), as_of, [*lg.CHECKPOINT_KEY, "parse_errors"])

    def replace(name: str, rows: DataFrame) -> None:
        tables.withdraw(name, again)
        tables.publish(name, rows)

    written: list[dict] = []  # the folders of the new keys, which no manifest names before the events are in place
    _together(
        spark,
        *([] if again else [lambda: written.append(batch.keys.write(accepted))]),
        lambda: replace("dropped_events", dropped_rows(rejected, as_of)),
        lambda: replace("raw_events", raw_rows(accepted, as_of)),
        lambda: replace("normalized_events", normalized_rows(accepted, as_of)),
        lambda: replace("data_quality_audit", audit),
        lambda: replace("quality_warnings", quality_warnings(audit, F.col("parse_errors"), [*lg.CHECKPOINT_KEY, "run_timestamp"])),
        lambda: replace("load_histograms", load_histograms(usable.filter(F.col("outcome").isin("candidate", "dropped")), as_of)),
    )
    batch.keys.record(accepted, [key for key, _ in again], written=written[0] if written else None)  # after the events, before their exports are completed
    changes = lg.completed(claimed, counts, as_of).unionByName(lg.failed(claimed, broken))
    tables.append("export_checkpoints", changes)
    zero = F.lit(0).cast("bigint")
    outcomes = counts.select("rows_inserted", "rows_duplicated", F.lit(None).cast("string").alias("error_message"))
    failures = broken.select(zero.alias("rows_inserted"), zero.alias("rows_duplicated"), "error_message")
    totals = outcomes.unionByName(failures).agg(
        F.count_if(F.col("error_message").isNull()).cast("int").alias("exports_completed"),
        F.count("error_message").cast("int").alias("_broken"),
        F.coalesce(F.sum("rows_inserted"), zero).alias("events_inserted"),
        F.coalesce(F.sum("rows_duplicated"), zero).alias("events_duplicated"),
        F.max("error_message").alias("error_summary"),
    )
    patch = totals.select(
        F.lit(batch.run_id).alias("id"),
        F.when(F.col("_broken") > 0, "failed").otherwise("completed").alias("status"),
        (F.col("exports_completed") + F.col("_broken")).alias("exports_seen"),
        "exports_completed", "events_inserted", "events_duplicated", "error_summary",
        F.lit(True).alias("finished"),
    )
    tables.append("ingestion_runs", lg.run_patches(patch, as_of))
    return spark.createDataFrame(counts.collect(), counts.schema)  # a row an export, as many as there are names


def _of(tables: EventTables, exports: DataFrame) -> DataFrame:
    """Current ledger rows of the given exports."""
    return lg.current(tables.read("export_checkpoints").join(exports.select(*lg.CHECKPOINT_KEY), lg.CHECKPOINT_KEY, "left_semi"))


def recover_stale(tables: EventTables, as_of: Moment, source: str = fv.SOURCE) -> None:
    """Release exports that a broken-off load left in processing."""
    stale = lg.stale_reset(lg.current(tables.read("export_checkpoints")), as_of, source)
    if not stale.isEmpty():
        tables.append("export_checkpoints", stale)


def pending_exports(tables: EventTables, listing: DataFrame) -> DataFrame:
    return discover_new(listing, lg.current(tables.read("export_checkpoints")))


def release_processing(tables: EventTables, source: str = fv.SOURCE) -> None:
    """Release all exports of a source that are in processing, for a loader that knows itself to be the only one."""
    stuck = lg.current(tables.read("export_checkpoints")).filter((F.col("status") == "processing") & (F.col("source") == source))
    if not stuck.isEmpty():
        tables.append("export_checkpoints", lg.released(stuck))


def record_misnamed(tables: EventTables, listing: DataFrame, as_of: Moment, run_id: str, trigger_mode: str = "manual") -> int:
    """A failed ledger row, and one failed run, for files whose names tell no export time and that are new; how many."""
    new = lg.misnamed(lg.current(tables.read("export_checkpoints")), listing, as_of)
    names = [row.last_error for row in new.select("last_error").collect()]
    if names:
        tables.append("export_checkpoints", new)
        _record_run(tables, as_of, run_id, trigger_mode, "failed", len(names), min(names))
    return len(names)


def _record_run(tables: EventTables, as_of: Moment, run_id: str, trigger_mode: str, status: str, seen: int, error: str | None) -> None:
    opened = lg.open_runs(tables.spark.createDataFrame([(run_id,)], "id string"), as_of, trigger_mode)
    fields = "id string, status string, exports_seen int, error_summary string, finished boolean"
    patch = tables.spark.createDataFrame([(run_id, status, seen, error, True)], fields)
    tables.append("ingestion_runs", opened.unionByName(lg.run_patches(patch, as_of)))


def _slices(exports: list[tuple], size: int) -> Iterator[list[tuple]]:
    """Exports (time first) by time, about ``size`` at once; files of one export time own the same partitions and stay
    together."""
    held: list[tuple] = []
    for _, same in groupby(exports, key=lambda x: x[0]):
        if len(held) >= size:
            yield held
            held = []
        held += same
    if held:
        yield held


def _named_exports(spark: SparkSession, part: list[tuple], source: str) -> DataFrame:
    """The exports of one load from their names, which the driver has: no step of it scans the landing folder again."""
    micros, urls, filenames, *_ = zip(*part, strict=True)
    named = spark.createDataFrame(pa.table({"micros": micros, "export_url": urls, "export_filename": filenames})).coalesce(1)
    time = F.timestamp_micros("micros").alias("export_time_utc")
    return named.select(F.lit(source).alias("source"), time, "export_url", "export_filename")


def load_landing(
    spark: SparkSession,
    tables: EventTables,
    landing: str,
    as_of: Moment,
    run_id: str | None = None,
    exports_per_load: int = 2_000,
    latest_only: bool = False,
    plain: bool = False,
    source: str = fv.SOURCE,
    trigger_mode: str = "manual",
) -> int:
    """Load every export in the landing folder that the ledger does not know as done; returns how many there were.

    The listing reads names only. The names of new files are the one thing that passes the driver, as they do in Spark's
    own file index; a long backlog is worked off in loads of about ``exports_per_load`` files. The first has the given
    ``run_id``, further ones the same with a number. Files tried before come after the others, least tried first. A file
    whose name tells no time gets a failed ledger row and a failed run of its own, once. Where nothing is new, a run is
    recorded all the same: the feed was looked at.
    """
    use_utc(spark)
    recover_stale(tables, as_of, source)
    suffix = ".zip" if plain else ""
    pattern = "*.export.CSV" if plain else "*.export.CSV.zip"
    listing = list_exports(spark, landing, source, pattern, suffix)
    if latest_only:
        listing = latest_export(listing)
    run = run_id or str(uuid.uuid4())
    strange = record_misnamed(tables, listing, as_of, f"{run}-misnamed", trigger_mode)
    tried = lg.current(tables.read("export_checkpoints")).select(*lg.CHECKPOINT_KEY, F.col("attempt_count").alias("tries"))
    pending = pending_exports(tables, listing).join(tried, lg.CHECKPOINT_KEY, "left")
    order = [F.coalesce("tries", F.lit(0)), "export_time_utc", "export_url"]
    date, again = F.date_format("export_time_utc", "yyyy-MM-dd"), F.coalesce("tries", F.lit(0)) > 0
    columns = [F.unix_micros("export_time_utc"), "export_url", "export_filename", "length", export_key(), date, again]
    names = [tuple(row) for row in pending.orderBy(*order).select(*columns).collect()]
    if not names and not strange:
        _record_run(tables, as_of, run, trigger_mode, "completed", listing.count(), None)

    def read(part: list[tuple]) -> DataFrame:
        paths = [(url.removesuffix(suffix), length) for _, url, _, length, *_ in part]
        if plain:
            return scan_export_tsv(spark, [path for path, _ in paths], "*").withColumn("path", F.concat("path", F.lit(suffix)))
        return read_zips(spark, paths)

    def batch(number: int, part: list[tuple]) -> _Batch:
        exports, id_ = _named_exports(spark, part, source), run if number == 0 else f"{run}-{number + 1}"
        return _Batch(tables, lambda: read(part), exports, as_of, id_, source, sorted({(key, date) for *_, key, date, again in part if again}))

    _load_in_turn(tables, (batch(*numbered) for numbered in enumerate(_slices(names, exports_per_load))), trigger_mode)
    return len(names)


def _load_in_turn(tables: EventTables, batches: Iterator[_Batch], trigger_mode: str) -> None:
    """Load batches one after another, each worked out while those before it are written.

    The tables see the same writes in the same order as without that: a batch is parsed up to two loads ahead, and decided on one
    load ahead, once all loads but the one before it are recorded. So at most four batches are staged at a time. Where
    a load fails, the later ones leave nothing but their staged folders, which go.
    """
    target = inheritable_thread_target(tables.spark)
    held: list[_Batch] = []
    parsed: list[Future] = []
    decided: list[Future] = []

    def parse() -> None:
        for batch in islice(batches, 1):
            held.append(batch)
            parsed.append(parser.submit(target(batch.parse)))

    def decide(number: int) -> None:
        parsed[number].result()
        held[number].decide(held[number - 1] if number else None)

    def submit_decision() -> None:
        if len(decided) < len(held):
            decided.append(decider.submit(target(decide), len(decided)))

    def ready(number: int) -> _Batch:
        decided[number].result()
        return held[number]

    parser, decider = ThreadPoolExecutor(1), ThreadPoolExecutor(1)
    try:
        parse()
        submit_decision()
        parse()
        number = 0
        while number < len(held):
            submit_decision()
            parse()
            now = held[number]
            load_rows(tables, None, now.exports, now.as_of, now.run_id, trigger_mode, now.source, partial(ready, number))
            if number:
                held[number - 1].clear()
            number += 1
    finally:
        for pool in (parser, decider):
            pool.shutdown(cancel_futures=True)
        for batch in held:
            batch.clear()
