"""Tables with a folder an export and date: what lists, reads and moves the folders."""

from __future__ import annotations

import uuid

import pytest
from pyspark.sql import functions as F

from tidewatch.sources import files, repairs
from tidewatch.sources.tables import EventTables


@pytest.fixture
def tables(spark, tmp_path):
    """60 exports of one date each, five dates."""
    tables = EventTables(spark, str(tmp_path / "t"))
    empty = spark.createDataFrame([], tables.schema("normalized_events")).select("dedupe_key", "source", "event_time_utc", "event_date", "export_key")
    made = spark.range(60).selectExpr(
        "concat('k', id) dedupe_key", "'s' source", "timestamp'2026-03-01 00:00:00' + make_dt_interval(int(id / 12)) event_time_utc", "concat('x', id) export_key")
    made = made.withColumn("event_date", F.to_date("event_time_utc")).coalesce(1)
    made.select(*empty.columns).write.partitionBy("event_date", "export_key").parquet(tables.path("normalized_events"))
    return tables


def _tasks(spark, action) -> int:
    """Tasks of the jobs that ``action`` starts."""
    group = uuid.uuid4().hex
    spark.sparkContext.setJobGroup(group, group)
    try:
        action()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    status = spark.sparkContext.statusTracker()
    stages = [s for job in status.getJobIdsForGroup(group) for s in status.getJobInfo(job).stageIds]
    return sum(info.numTasks for info in map(status.getStageInfo, stages) if info)


def test_folders_are_listed_by_a_few_tasks(spark, tables):
    spark.conf.set("spark.sql.sources.parallelPartitionDiscovery.threshold", "3")
    try:
        key = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
        before = spark.conf.get(key)
        wide = spark.read.schema(tables.schema("normalized_events"))
        folders = [f"{tables.path('normalized_events')}/{d}/{e}" for d in files.children(spark, tables.path("normalized_events")) if "=" in d
                   for e in files.children(spark, f"{tables.path('normalized_events')}/{d}")]
        assert len(folders) == 60 and _tasks(spark, lambda: wide.option("basePath", tables.path("normalized_events")).parquet(*folders)) == 60
        assert _tasks(spark, lambda: tables._folders("normalized_events", folders)) == 2 * spark.sparkContext.defaultParallelism
        assert spark.conf.get(key) == before
        assert tables.read("normalized_events").count() == 60
    finally:
        spark.conf.unset("spark.sql.sources.parallelPartitionDiscovery.threshold")


def test_the_newest_events_leave_older_dates_unlisted(spark, tables):
    index = tables.newest_events(15)
    assert len(index.inputFiles()) == 24 and {r.event_date.day for r in index.collect()} == {4, 5}
    roots = index._jdf.queryExecution().analyzed().collectLeaves().head().relation().location().rootPaths()
    assert roots.size() == 2


def test_many_folders_are_moved_by_few_calls_and_a_repeat_goes_on(spark, tables, monkeypatch):
    rows = tables.read("normalized_events")
    marked = rows.withColumns({"country_code": F.lit("NO"), "_changed": F.lit(True), "_deleted": F.col("export_key").isin("x1", "x59")})
    folder = repairs.prepare(spark, tables.root, "normalized_events", marked, ["event_date", "export_key"])
    stopped = [n for n in files.children(spark, f"{folder}/new/event_date=2026-03-02") if "=" in n][:5]
    target = f"{tables.path('normalized_events')}/event_date=2026-03-02"
    files.replace_folders(spark, [(f"{folder}/new/event_date=2026-03-02/{n}", f"{target}/{n}") for n in stopped])  # as a stop leaves it
    opened = []
    monkeypatch.setattr(files, "_open", lambda s, p, real=files._open: (opened.append(p), real(s, p))[1])
    assert repairs.finish(spark, tables.root) == 1 and len(opened) < 12
    stored = EventTables(spark, tables.root).read("normalized_events")
    assert stored.count() == 58 and stored.filter("country_code = 'NO'").count() == 58
    assert len(set(stored.inputFiles())) == 58 and files.children(spark, f"{tables.root}/_repairs") == []


def test_a_repair_computes_its_rows_twice_only(spark, tmp_path):
    """Once for the names of touched partitions, once for their rows."""
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    made = spark.sql("SELECT id, id = 3 AS _changed, id = 5 AS _deleted, IF(id = 9, NULL, id % 4) AS part FROM range(12)")
    folder = repairs.prepare(spark, str(tmp_path), "t", made.mapInArrow(counted, made.schema), ["part"])
    assert seen.value == 24
    assert sorted(r.id for r in spark.read.parquet(f"{folder}/new").collect()) == [1, 3, 7, 11]
    assert repairs.prepare(spark, str(tmp_path), "t", made.withColumns({"_changed": F.lit(False), "_deleted": F.lit(False)}), ["part"]) is None
