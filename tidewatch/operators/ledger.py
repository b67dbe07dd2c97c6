"""Run and checkpoint ledgers as pure transitions from frame to frame.

A ledger is an append-only log. Each transition returns the rows it changes, with ``version`` raised by one;
``current`` reads the newest version per key.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch import fixed_values as fv
from tidewatch import schemas
from tidewatch.functions.times import age_seconds, at_least_one, format_utc, moment_for, moment_literal, utc
from tidewatch.operators.dedupe import first_per_key

Moment = datetime | str
CHECKPOINT_KEY = ["source", "export_time_utc"]
VERSION = "version"


# ---------------------------------------------------------------- checkpoints

def checkpoint_order() -> list[Column]:
    """Best first: completed, processing, failed, others; then latest completed, latest discovered, highest id."""
    rank = F.array_position(F.array(*[F.lit(s) for s in fv.CHECKPOINT_STATUS_RANK]), F.col("status"))
    last = F.lit(len(fv.CHECKPOINT_STATUS_RANK) + 1)
    return [
        F.coalesce(F.nullif(rank, F.lit(0).cast("bigint")), last),
        F.desc_nulls_last("completed_at"),
        F.desc_nulls_first("discovered_at"),
        F.desc_nulls_first("id"),
    ]


def best_checkpoints(rows: DataFrame) -> DataFrame:
    """One row per source and export time."""
    return first_per_key(rows, CHECKPOINT_KEY, checkpoint_order())


def current(log: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Newest version of each key. Files whose names tell no time have none: each is a row by its address."""
    if keys is None:
        named = log.withColumn("_address", F.when(F.col("export_time_utc").isNull(), F.col("export_url")))
        return first_per_key(named, [*CHECKPOINT_KEY, "_address"], [F.desc(VERSION)]).drop("_address")
    return first_per_key(log, keys, [F.desc(VERSION)])


def misnamed(ledger: DataFrame, listing: DataFrame, as_of: Moment) -> DataFrame:
    """Failed first rows of listed files without an export time that the ledger does not know."""
    known = ledger.filter("export_time_utc IS NULL").select("source", "export_url")
    new = listing.filter("export_time_utc IS NULL").join(known, ["source", "export_url"], "left_anti").dropDuplicates(["source", "export_url"])
    defaults = {
        "status": F.lit("failed"), "discovered_at": moment_literal(as_of), "attempt_count": F.lit(1),
        "last_error": F.concat(F.lit(fv.MISNAMED_TEXT), F.col("export_filename")),
    }
    return schemas.apply_defaults(new, schemas.EXPORT_CHECKPOINTS, defaults).withColumn(VERSION, F.lit(1).cast("bigint"))


def new_checkpoints(
    ledger: DataFrame, exports: DataFrame, as_of: Moment, status: str = "pending"
) -> DataFrame:
    """First ledger rows of exports that have none (``source``, ``export_time_utc``, ``export_url``, ``export_filename``).

    One aggregation decides, each task first by itself: what is shuffled is a row a key and task, however often a key is
    offered or stored. Rows without a key equal none in the ledger.
    """
    offered = F.struct(*exports.columns)
    keyed = ledger.select(*CHECKPOINT_KEY).dropna()
    known = keyed.select(*CHECKPOINT_KEY, F.lit(None).cast(exports.schema).alias("_offered"), F.lit(True).alias("_known"))
    both = exports.select(*CHECKPOINT_KEY, offered.alias("_offered"), F.lit(False).alias("_known")).unionByName(known)
    found = both.groupBy(*CHECKPOINT_KEY).agg(F.first("_offered", ignorenulls=True).alias("_offered"), F.bool_or("_known").alias("_known"))
    fresh = found.filter(~F.col("_known")).select("_offered.*")
    defaults = {
        "source": F.lit(fv.SOURCE),
        "status": F.lit(status),
        "discovered_at": moment_literal(as_of),
        "attempt_count": F.lit(0),
    }
    return schemas.apply_defaults(fresh, schemas.EXPORT_CHECKPOINTS, defaults).withColumn(VERSION, F.lit(1).cast("bigint"))


def insert_checkpoints(ledger: DataFrame, exports: DataFrame, as_of: Moment, status: str = "pending") -> DataFrame:
    """The ledger with missing exports added."""
    return ledger.unionByName(new_checkpoints(ledger, exports, as_of, status), allowMissingColumns=True)


def _next(rows: DataFrame, **changes: Column) -> DataFrame:
    typed = {name: value.cast(rows.schema[name].dataType) for name, value in changes.items()}
    if VERSION in rows.columns:
        typed[VERSION] = F.col(VERSION) + 1
    return rows.withColumns(typed)


def claimed(ledger: DataFrame, as_of: Moment) -> DataFrame:
    """Pending and failed rows, as processing."""
    free = ledger.filter(F.col("status").isin("pending", "failed"))
    return _next(
        free,
        status=F.lit("processing"),
        processing_started_at=moment_literal(as_of),
        attempt_count=F.col("attempt_count") + 1,
    )


def stale_reset(
    ledger: DataFrame, as_of: Moment, source: str = fv.SOURCE, stale_minutes: int = fv.STALE_AFTER_MINUTES
) -> DataFrame:
    """Rows stuck in processing for longer than the limit, back to pending."""
    started = "processing_started_at"
    limit = moment_for(ledger, started, utc(as_of) - timedelta(minutes=stale_minutes))
    stuck = (F.col("source") == source) & (F.col("status") == "processing") & (F.col(started) < limit)
    return released(ledger.filter(stuck))


def released(rows: DataFrame) -> DataFrame:
    """Rows in processing, back to pending."""
    return _next(
        rows,
        status=F.lit("pending"),
        processing_started_at=F.lit(None),
        last_error=F.coalesce("last_error", F.lit(fv.STALE_RESET_TEXT)),
    )


def unfinished(ledger: DataFrame, source: str = fv.SOURCE) -> DataFrame:
    """Failed and released rows of a source, those tried least first."""
    waiting = ledger.filter((F.col("source") == source) & F.col("status").isin("pending", "failed"))
    return waiting.filter("export_time_utc IS NOT NULL").orderBy("attempt_count", "export_time_utc", "export_url")


def completed(ledger: DataFrame, counts: DataFrame, as_of: Moment) -> DataFrame:
    """Rows of the exports in ``counts`` (``rows_seen``, ``rows_inserted``, ``rows_duplicated``), as completed."""
    counted = counts.select(*CHECKPOINT_KEY, "rows_seen", "rows_inserted", "rows_duplicated")
    joined = ledger.join(counted, CHECKPOINT_KEY)
    return _next(
        joined,
        status=F.lit("completed"),
        completed_at=moment_literal(as_of),
        last_error=F.lit(None),
        row_count_raw=F.col("rows_seen"),
        row_count_inserted=F.col("rows_inserted"),
        row_count_duplicates=F.col("rows_duplicated"),
    ).drop("rows_seen", "rows_inserted", "rows_duplicated")


def failed(ledger: DataFrame, errors: DataFrame) -> DataFrame:
    """Rows of the exports in ``errors`` (``error_message``), as failed. The completion time is left as it was."""
    joined = ledger.join(errors.select(*CHECKPOINT_KEY, "error_message"), CHECKPOINT_KEY)
    return _next(joined, status=F.lit("failed"), last_error=F.col("error_message")).drop("error_message")


def apply_changes(ledger: DataFrame, changes: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """The ledger with the changed rows in place of their earlier state."""
    return ledger.join(changes.select(*(keys or CHECKPOINT_KEY)), keys or CHECKPOINT_KEY, "left_anti").unionByName(changes)


# ---------------------------------------------------------------- runs

RUN_COUNTERS = ["exports_seen", "exports_completed", "events_inserted", "events_duplicated"]
RUN_LOG_COLUMNS = ["id", "started_at", "finished_at", "status", "trigger_mode", *RUN_COUNTERS, "error_summary"]


def open_runs(ids: DataFrame, as_of: Moment, trigger_mode: str = "manual", status: str = "started") -> DataFrame:
    """First log rows of runs (``id``)."""
    zero = {name: F.lit(0) for name in RUN_COUNTERS}
    defaults = {"started_at": moment_literal(as_of), "status": F.lit(status), "trigger_mode": F.lit(trigger_mode), **zero}
    return schemas.apply_defaults(ids, schemas.INGESTION_RUNS, defaults).withColumn(VERSION, F.lit(1).cast("bigint"))


def run_patches(patches: DataFrame, as_of: Moment, version: int = 2) -> DataFrame:
    """Log rows that change runs: NULL keeps a value; ``finished`` sets the finish time."""
    finished = F.col("finished") if "finished" in patches.columns else F.lit(False)
    stamped = patches.withColumn("finished_at", F.when(finished, moment_literal(as_of)))
    shaped = schemas.apply_defaults(stamped, schemas.INGESTION_RUNS, {})
    return shaped.withColumn(VERSION, F.lit(version).cast("bigint"))


def current_runs(log: DataFrame, order: str = VERSION) -> DataFrame:
    """State of each run: per column the last non-NULL value in log order.

    ``max_by`` over non-NULL values is combined per task before the shuffle, so a run with very many log rows is
    never gathered in one place.
    """
    def latest(name: str) -> Column:
        known = F.col(name).isNotNull()
        return F.max_by(F.when(known, F.col(name)), F.when(known, F.col(order))).alias(name)

    return log.groupBy("id").agg(*[latest(name) for name in RUN_LOG_COLUMNS if name != "id" and name in log.columns])


def recent_runs(runs: DataFrame, limit: int = 10) -> DataFrame:
    return runs.orderBy(F.desc_nulls_first("started_at"), F.desc("id")).limit(at_least_one(limit)).select(*RUN_LOG_COLUMNS)


def latest_success(runs: DataFrame) -> DataFrame:
    done = runs.filter((F.col("status") == "completed") & F.col("finished_at").isNotNull())
    columns = ["id", "started_at", "finished_at", "events_inserted", "events_duplicated"]
    return done.orderBy(F.desc("finished_at"), F.desc("id")).limit(1).select(*columns)


def runs_report(runs: DataFrame, limit: int = 10) -> DataFrame:
    """Newest runs with display columns."""
    return recent_runs(runs, limit).select(
        "id", "status", "trigger_mode",
        format_utc("started_at").alias("started"),
        format_utc("finished_at").alias("finished"),
        F.concat_ws("/", F.col("exports_completed").cast("string"), F.col("exports_seen").cast("string")).alias("exports"),
        F.col("events_inserted").alias("inserted"),
        F.col("events_duplicated").alias("duplicated"),
        "error_summary",
    )


def readiness(runs: DataFrame, as_of: Moment, max_age_minutes: int | None = None) -> DataFrame:
    """Always one row: is the latest successful run young enough?"""
    limit = at_least_one(max_age_minutes or fv.READINESS_MAX_AGE_MINUTES)
    done = runs.filter((F.col("status") == "completed") & F.col("finished_at").isNotNull())
    newest = done.agg(F.max(F.struct(F.col("finished_at").alias("finished_at"), F.col("id").alias("id"))).alias("run"))
    age = age_seconds("run.finished_at", as_of)
    ready = age <= limit * 60
    return newest.select(
        F.coalesce(ready & F.col("run").isNotNull(), F.lit(False)).alias("ready"),
        F.when(F.col("run").isNull(), "no_successful_ingest")
        .when(F.col("run.finished_at").isNull(), "invalid_finished_at")
        .when(ready, "ok")
        .otherwise("stale_ingest").alias("reason"),
        F.lit(limit).alias("max_age_minutes"),
        F.col("run.finished_at").alias("latest_successful_finished_at"),
        F.col("run.id").alias("latest_successful_run_id"),
        F.when(F.col("run").isNotNull(), age).alias("ingest_age_seconds"),
    )


