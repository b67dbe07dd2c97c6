"""Tables with manifests: what a stop leaves, what a commit touches, what a reader opens."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.sources import files
from tidewatch.sources.tables import EventTables
from tidewatch.sources.versioned import VersionedTable, partitions_of

SCHEMA = T.StructType([T.StructField("day", T.StringType()), T.StructField("n", T.LongType())])


@pytest.fixture
def table(spark, tmp_path):
    return VersionedTable(spark, str(tmp_path / "t"), SCHEMA, F.col("day"))


def rows(spark, *pairs):
    return spark.createDataFrame(list(pairs), SCHEMA)


def content(table, wanted=None):
    return sorted((r["day"] or "", r["n"]) for r in table.read(wanted).collect())


def test_append_replace_and_old_versions(spark, table):
    assert content(table) == [] and table.version().number == 0
    table.append(rows(spark, ("a", 1), ("b/c =%", 2), (None, 3)), {"seen": 1})
    table.append(rows(spark, ("a", 4)))
    assert content(table) == [("", 3), ("a", 1), ("a", 4), ("b/c =%", 2)] and table.version().notes == {"seen": 1}
    before = table.version()
    table.replace(rows(spark, ("a", 9)), ["a", None], {"seen": 2})
    after = table.version()
    assert content(table) == [("a", 9), ("b/c =%", 2)] and after.notes == {"seen": 2}
    assert after.partitions["b/c =%"] == before.partitions["b/c =%"]
    assert sorted(r["n"] for r in table.read(at=before).collect()) == [1, 2, 3, 4]
    assert content(table, ["b/c =%"]) == [("b/c =%", 2)] and content(table, lambda d: d == "a") == [("a", 9)]
    assert content(table, []) == [] and sorted(partitions_of(table.read(), table.partition)) == ["a", "b/c =%"]


def test_rows_outside_the_touched_partitions_change_nothing(spark, table):
    table.append(rows(spark, ("a", 1)))
    with pytest.raises(ValueError, match="outside"):
        table.replace(rows(spark, ("b", 1)), ["a"])
    assert content(table) == [("a", 1)] and table.version().number == 1


def test_a_stop_before_the_switch_leaves_the_old_table(spark, table, monkeypatch):
    table.append(rows(spark, ("a", 1), ("b", 2)))

    def stop(*args):
        raise RuntimeError("stopped")

    with monkeypatch.context() as patch:
        patch.setattr(files, "write_once", stop)
        with pytest.raises(RuntimeError, match="stopped"):
            table.replace(rows(spark, ("a", 5)), ["a"])
    assert content(table) == [("a", 1), ("b", 2)]
    assert table.sweep() == 1  # what the stopped commit wrote
    assert content(table) == [("a", 1), ("b", 2)]


def test_a_second_writer_gets_an_error_and_changes_nothing(spark, table):
    before = table.version()
    table.append(rows(spark, ("a", 1)), before=before)
    with pytest.raises(FileExistsError):
        table.append(rows(spark, ("a", 2)), before=before)
    assert content(table) == [("a", 1)]


def test_compaction_and_sweep_bound_the_files(spark, table):
    for n in range(6):
        table.append(rows(spark, ("a", n)))
    assert len(table.version().partitions["a"]) == 6
    assert table.compact(most=4) and len(table.version().partitions["a"]) == 1
    assert table.compact(most=4) is None
    table.sweep(keep=1)
    assert content(table) == [("a", n) for n in range(6)]
    assert len(os.listdir(f"{table.root}/data")) == 1 and len([n for n in os.listdir(f"{table.root}/manifests") if n.endswith(".json")]) == 1


def test_a_read_opens_only_the_wanted_partitions(spark, table):
    table.append(rows(spark, ("a", 1), ("b", 2)))
    opened = table.read(["b"]).inputFiles()
    assert opened and all("_partition=b" in name for name in opened)


def test_ledgers_keep_few_files_and_take_old_ones_over(spark, tmp_path):
    tables = EventTables(spark, str(tmp_path / "t"))
    schema = tables.schema("ingestion_runs")
    run = lambda n: spark.createDataFrame([(f"r{n}", *[None] * (len(schema) - 2), 1)], schema)
    run(0).write.parquet(tables.path("ingestion_runs"))  # as older versions wrote it
    for n in range(1, 20):
        tables.append("ingestion_runs", run(n))
    assert sorted(r["id"] for r in tables.read("ingestion_runs").collect()) == sorted(f"r{n}" for n in range(20))
    assert len(tables.read("ingestion_runs").inputFiles()) <= 17


def test_newest_dates_first(spark, tmp_path):
    tables = EventTables(spark, str(tmp_path / "t"))
    schema = tables.schema("normalized_events")
    events = spark.createDataFrame([], schema).select("dedupe_key", "event_time_utc", "event_date", "export_key")
    assert tables.newest_events(3).count() == 0
    made = spark.sql("""SELECT concat('k', id) dedupe_key, if(id < 2, NULL, timestamp'2026-03-01 00:00:00' + make_dt_interval(id)) event_time_utc FROM range(10)""")
    made = made.withColumn("event_date", F.to_date("event_time_utc")).withColumn("export_key", F.lit("x")).withColumn("n", F.lit(1))
    made.select(*events.columns).write.partitionBy("event_date", "export_key").parquet(tables.path("normalized_events"))
    newest = tables.newest_events(3)
    assert sorted(r["dedupe_key"] for r in newest.collect()) == ["k7", "k8", "k9"]
    plan = newest._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and len({r["event_date"] for r in newest.collect()}) == 3
    assert tables.newest_events(10).count() == 10 and tables.newest_events(9).filter("event_time_utc IS NULL").count() == 2
