"""The stored event keys, and what a load reads of them."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tidewatch.operators import dedupe
from tidewatch.sources.keys import EventKeys

SCHEMA = "source string, dedupe_key string, global_event_id long, export_time_utc timestamp, row_number long, payload string"
T1, T2 = "2026-03-26 00:15:00", "2026-03-26 00:30:00"


def events(spark, *made):
    rows = [("s", f"k{i}" if i is not None else f"text-{n}", i, t, n, "p") for n, (i, t) in enumerate(made)]
    return spark.createDataFrame(rows, SCHEMA.replace("timestamp", "string")).withColumn("export_time_utc", F.col("export_time_utc").cast("timestamp"))


@pytest.fixture
def keys(spark, tmp_path):
    return EventKeys(spark, str(tmp_path / "keys"), ids=10, hashed=4)


def stored(keys):
    return sorted((r["dedupe_key"], r["export_key"][-6:]) for r in keys.table.read().collect())


def test_collisions_with_other_exports_only(spark, keys):
    assert not keys.started() and keys.colliding(events(spark, (1, T1)), []).count() == 0
    first = events(spark, (1, T1), (25, T1), (None, T1))
    keys.record(first, [])
    assert stored(keys) == [("k1", "001500"), ("k25", "001500"), ("text-2", "001500")]
    batch = events(spark, (1, T2), (2, T2), (None, T2), (25, T2))
    assert sorted(r["dedupe_key"] for r in keys.colliding(batch, []).collect()) == ["k1", "k25", "text-2"]
    assert keys.colliding(batch, ["s-20260326001500"]).count() == 0


def test_a_load_lists_only_the_partitions_its_ids_fall_in(spark, keys):
    keys.record(events(spark, *[(i, T1) for i in range(0, 100, 5)]), [])
    assert len(keys.table.version().partitions) == 10
    plan = keys.colliding(events(spark, (31, T2), (35, T2), (72, T2)), [])
    opened = {name.split("_partition=")[1].split("/")[0] for name in plan.inputFiles() if "_partition=" in name}
    assert opened == {"id-3", "id-7"}
    assert [r["dedupe_key"] for r in plan.collect()] == ["k35"]


def test_a_repeat_replaces_its_own_keys(spark, keys):
    keys.record(events(spark, (1, T1), (25, T1)), [])
    keys.record(events(spark, (31, T2), (2, T2)), [])
    keys.record(events(spark, (1, T1)), ["s-20260326001500"])  # the export again, without 25
    assert stored(keys) == [("k1", "001500"), ("k2", "003000"), ("k31", "003000")]


def test_rebuilt_from_raw_events(spark, keys):
    keys.record(events(spark, (77, T1)), [])
    keys.rebuild(events(spark, (1, T1), (2, T2)))
    assert stored(keys) == [("k1", "001500"), ("k2", "003000")]


def test_small_folders_are_compacted(spark, keys):
    for n in range(5):
        keys.record(events(spark, (n, T1)), [], most_folders=3)
    assert len(keys.table.version().partitions["id-0"]) < 4 and len(stored(keys)) == 5


def test_first_of_new_equals_the_window_over_whole_rows(spark):
    made = spark.range(400).selectExpr(
        "'s' source", "concat('k', if(id % 3 = 0, 1, id % 97)) dedupe_key", "timestamp'2026-03-26' export_time_utc", "(id * 7) % 401 row_number", "id")
    taken = made.filter("id % 10 = 3").select("source", "dedupe_key").distinct()
    want = sorted(r["id"] for r in dedupe.first_per_key(made.join(taken, ["source", "dedupe_key"], "left_anti"), dedupe.EVENT_KEY, dedupe.ARRIVAL).collect())
    for limit in (2_000_000, 1):
        dedupe_limit, dedupe.BROADCAST_KEY_LIMIT = dedupe.BROADCAST_KEY_LIMIT, limit
        try:
            assert sorted(r["id"] for r in dedupe.first_of_new(made, taken).collect()) == want
        finally:
            dedupe.BROADCAST_KEY_LIMIT = dedupe_limit


def test_only_keys_are_shuffled_where_keys_are_unique(spark, tmp_path):
    """No exchange carries the payload of rows whose key is unique and new."""
    spark.range(1000).selectExpr("'s' source", "concat('k', id) dedupe_key", "timestamp'2026-03-26' export_time_utc", "id row_number", "repeat('x', 100) payload").write.parquet(str(tmp_path / "b"))
    batch = spark.read.parquet(str(tmp_path / "b"))
    plan = dedupe.first_of_new(batch, batch.select("source", "dedupe_key").limit(0))._jdf.queryExecution().executedPlan().toString()
    union = plan[plan.index("Union"):]
    first_branch = union.split("Window")[0]
    assert "BroadcastHashJoin" in plan and "payload" in first_branch
    exchanges = [line for line in first_branch.split("\n") if "Exchange hashpartitioning" in line]
    assert all("payload" not in line for line in exchanges)
