from __future__ import annotations

from datetime import datetime, timedelta

import pytest

from tests.helpers import one
from tidewatch import schemas
from tidewatch.operators import constraints, ledger

NOW = datetime(2026, 3, 26, 12)
T1 = datetime(2026, 3, 26, 0, 15)


def checkpoints(spark, *rows):
    names = schemas.EXPORT_CHECKPOINTS.names
    full = [{"id": i, "source": "gdelt_events_v2", "export_time_utc": T1, "attempt_count": 0, **r} for i, r in enumerate(rows)]
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in full], schemas.EXPORT_CHECKPOINTS)


def test_best_checkpoint(spark):
    rows = checkpoints(
        spark, {"status": "pending"}, {"status": "failed"}, {"status": "processing"},
        {"status": "completed", "completed_at": NOW}, {"status": "completed", "completed_at": NOW + timedelta(hours=1)},
        {"status": "completed"})
    assert one(ledger.best_checkpoints(rows)).id == 4


def test_claim_takes_pending_and_failed_only(spark):
    rows = checkpoints(spark, *[{"status": s} for s in ("pending", "failed", "processing", "completed")])
    got = ledger.claimed(rows, NOW).collect()
    assert sorted(r.id for r in got) == [0, 1]
    assert all((r.status, r.attempt_count, r.processing_started_at) == ("processing", 1, NOW) for r in got)


def test_stale_limit_is_strict(spark):
    started = [29, 30, 31, None, 45]
    rows = checkpoints(spark, *[
        {"status": "processing", "processing_started_at": NOW - timedelta(minutes=m) if m else None,
         "last_error": "old" if m == 45 else None} for m in started])
    got = {r.id: r for r in ledger.stale_reset(rows, NOW).collect()}
    assert sorted(got) == [2, 4]
    assert got[2].last_error.startswith("Reset from processing") and got[4].last_error == "old"
    assert all(r.status == "pending" and r.processing_started_at is None for r in got.values())


def test_insert_is_idempotent(spark):
    rows = checkpoints(spark, {"status": "completed"})
    offered = rows.select("source", "export_time_utc", "export_url", "export_filename")
    assert ledger.new_checkpoints(rows, offered, NOW).isEmpty()
    assert one(ledger.new_checkpoints(rows.limit(0), offered.union(offered), NOW)).status == "pending"


def test_run_patches_keep_what_is_null(spark):
    opened = ledger.open_runs(spark.createDataFrame([("r",)], "id string"), NOW)
    patch = spark.createDataFrame([("r", "completed", 3, True)], "id string, status string, exports_seen int, finished boolean")
    later = spark.createDataFrame([("r", "failed", "oops")], "id string, status string, error_summary string")
    log = opened.unionByName(ledger.run_patches(patch, NOW + timedelta(hours=1))).unionByName(
        ledger.run_patches(later, NOW + timedelta(hours=2), version=3))
    run = one(ledger.current_runs(log))
    assert (run.status, run.exports_seen, run.events_inserted, run.error_summary) == ("failed", 3, 0, "oops")
    assert (run.started_at, run.finished_at) == (NOW, NOW + timedelta(hours=1))


@pytest.mark.parametrize(("age", "limit", "expected"), [
    (None, 60, (False, "no_successful_ingest")),
    (timedelta(minutes=60), 60, (True, "ok")),
    (timedelta(minutes=60, seconds=1), 60, (False, "stale_ingest")),
    (timedelta(hours=4), 30, (False, "stale_ingest")),
    (timedelta(minutes=5), None, (True, "ok")),
])
def test_readiness(spark, age, limit, expected):
    rows = [] if age is None else [("r", NOW, NOW - age, "completed")]
    rows.append(("open", NOW, None, "completed"))
    runs = spark.createDataFrame(rows, "id string, started_at timestamp, finished_at timestamp, status string")
    row = one(ledger.readiness(runs, NOW, limit))
    assert (row.ready, row.reason) == expected
    assert row.latest_successful_run_id == (None if age is None else "r")


def test_constraints(spark):
    columns = "primary_category string, secondary_category string, category_confidence double, latitude double, longitude double"
    rows = spark.createDataFrame([("conflict", None, 1.0, 90.0, -180.0), ("weather", "flood", 1.5, 91.0, None)], columns)
    assert {r.rule: r.violations for r in constraints.check_constraints(rows).collect()} == dict.fromkeys(
        constraints.normalized_rules(), 1) | {"longitude_range": 0}
    assert constraints.enforce_constraints(rows.limit(1)).count() == 1
    with pytest.raises(Exception, match="constraint violated"):
        constraints.enforce_constraints(rows).collect()


def test_keys_references_and_cascade(spark):
    runs = spark.createDataFrame([("a",), ("b",)], "id string")
    drops = spark.createDataFrame([("a", 1), ("c", 2), ("c", 3), (None, 4)], "ingestion_run_id string, n int")
    assert one(constraints.check_references(drops, runs, [("ingestion_run_id", "id")])).orphans == 2
    assert sorted(r.n for r in constraints.cascade_delete(drops, runs).collect()) == [2, 3, 4]
    assert one(constraints.duplicate_keys(drops, ["ingestion_run_id"])).copies == 2
