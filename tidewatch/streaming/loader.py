"""The load as a stream: a landing folder polled, files loaded a bounded number at a time."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tidewatch import fixed_values as fv
from tidewatch.plans.load import load_landing, release_processing
from tidewatch.session import use_utc
from tidewatch.sources.tables import EventTables
from tidewatch.streaming.poll import polls


def _utc_now() -> datetime:
    return datetime.now(timezone.utc)


def stream_load(
    spark: SparkSession,
    landing: str,
    tables: EventTables,
    checkpoint: str,
    as_of: Callable[[], datetime | str] = _utc_now,
    files_per_batch: int = 200,
    every: str | None = None,
    source: str = fv.SOURCE,
) -> StreamingQuery:
    """Load files as they land. Without ``every`` the query works off what is there and ends.

    Every poll lists the landing folder and takes what the ledger does not know as done, about ``files_per_batch`` files at a
    time: what is new, then what failed or broke off, least tried first, each once a poll. So a quiet feed is retried and
    recorded too, and a file counts once however often the stream is restarted, with or without its checkpoint. The
    stream is the one loader of its ``source``: what it finds in processing broke off and is taken up at once. Events are
    checked against all stored keys, without a time bound and without stream state. There is no watermark: late events
    are always accepted, and events from the future are quarantined.
    """
    use_utc(spark)

    def load_batch(batch: DataFrame, batch_id: int) -> None:
        release_processing(tables, source)
        load_landing(spark, tables, landing, as_of(), exports_per_load=files_per_batch, source=source, trigger_mode="stream")

    writer = polls(spark).writeStream.foreachBatch(load_batch).option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return writer.start()
