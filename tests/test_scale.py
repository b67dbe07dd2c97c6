"""What must not grow with the input: rows of a task, files of a table, scans of a load."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from contract import adapters
from tests.helpers import line, write_export
from tidewatch.operators import dedupe, ledger
from tidewatch.plans.load import load_landing
from tidewatch.sources import exports
from tidewatch.sources.tables import DAILY, EventTables

A, B, C, D = "20260326001500", "20260326003000", "20260326004500", "20260327000000"
AS_OF = "2026-03-27 00:00:00"
dedupe_limit = dedupe.BROADCAST_KEY_LIMIT


def test_a_task_takes_no_more_rows_of_a_larger_table(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(adapters, "TASK_ROWS", 100)
    for rows in (1_000, 4_000):
        path = str(tmp_path / f"events-{rows}")
        spark.range(rows).withColumnRenamed("id", "event_id").coalesce(1).write.parquet(path)
        table = adapters.spread(spark.read.option("maxPartitionBytes", 100).parquet(path))
        held = table.groupBy(F.spark_partition_id().alias("p")).count().agg(F.max("count")).first()[0]
        assert held < 200 and table.count() == rows
    plan = table.filter(F.sha2(F.col("event_id").cast("string"), 256) > "8")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("sha2") < plan.index("Repartition")  # a costly filter stays above the exchange


def test_many_keys_in_question_are_not_broadcast(spark, monkeypatch):
    monkeypatch.setattr(dedupe, "BROADCAST_KEY_LIMIT", 10)
    batch = spark.range(100).selectExpr("'s' source", "concat('k', id % 40) dedupe_key", "id export_time_utc", "id row_number")
    taken = spark.range(15).selectExpr("'s' source", "concat('k', id) dedupe_key")
    first = dedupe.first_of_new(batch, taken)
    assert sorted(r.row_number for r in first.collect()) == list(range(15, 40))
    assert "ResolvedHint (strategy=broadcast)" not in first._jdf.queryExecution().optimizedPlan().toString()
    assert dedupe_limit <= 250_000


def test_exports_meet_the_ledger_as_keys(spark):
    rows = spark.range(1_000).selectExpr("'s' source", "timestamp'2026-03-01' + make_dt_interval(0, int(id % 10)) export_time_utc", "concat('u', id) export_url", "concat('f', id) export_filename")
    stored = rows.filter("hour(export_time_utc) < 4")
    fresh = ledger.new_checkpoints(stored, rows, AS_OF)
    assert sorted(r.export_time_utc.hour for r in fresh.collect()) == [4, 5, 6, 7, 8, 9]
    plan = fresh._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and "Aggregate" in plan
    unnamed = rows.limit(3).withColumn("export_time_utc", F.lit(None).cast("timestamp"))
    assert ledger.new_checkpoints(unnamed, unnamed, AS_OF).count() == 1  # a null equals no stored key


def test_few_rows_an_export_share_the_files_of_a_day(spark, tmp_path):
    tables = EventTables(spark, str(tmp_path / "t"))
    for i, stamp in enumerate((A, B, C, D)):
        write_export(tmp_path / "z", stamp, [line(GLOBALEVENTID=str(i), Actor1Name="", Actor2Name=""), "bad"])
    load_landing(spark, tables, str(tmp_path / "z"), AS_OF)
    for name in DAILY:
        stored = tables.read(name)
        assert len(stored.inputFiles()) == 2 and stored.select("export_key").distinct().count() == 4, name


def test_an_export_published_again_replaces_its_rows_among_others_of_its_day(spark, tmp_path):
    tables = EventTables(spark, str(tmp_path / "t"))
    def some(n, *stamps):
        made = spark.createDataFrame([(stamp,) for stamp in stamps for _ in range(n)], "stamp string")
        time = F.to_timestamp("stamp", "yyyyMMddHHmmss")
        return made.select(F.lit("s").alias("source"), time.alias("export_time_utc"), F.lit("r").alias("reason"), F.lit(float(n)).alias("value"),
                           F.lit(0.0).alias("threshold"), F.lit(None).cast("timestamp").alias("run_timestamp"))

    def stored():
        return sorted((r.export_key[2:], r.value) for r in tables.read("quality_warnings").collect())

    tables.publish("quality_warnings", some(1, A, B, D))
    tables.publish("quality_warnings", some(2, B))
    assert stored() == [(A, 1.0), (B, 2.0), (B, 2.0), (D, 1.0)]
    tables.withdraw("quality_warnings", [(f"s-{B}", "2026-03-26"), (f"s-{C}", "2026-03-28")])
    assert stored() == [(A, 1.0), (D, 1.0)]


def test_tables_with_a_partition_an_export_come_along(spark, tmp_path):
    tables = EventTables(spark, str(tmp_path / "t"))
    schema = tables.schema("quality_warnings")
    old = spark.createDataFrame([(None, "old", 1.0, 0.0, None, f"s-{stamp}") for stamp in (A, B)], schema).withColumn("export_date", F.lit("2026-03-26").cast("date"))
    old.write.partitionBy("export_date", "export_key").parquet(tables.path("quality_warnings"))
    assert tables.read("quality_warnings").count() == 2
    new = old.filter(F.col("export_key").endswith(B)).withColumns({"reason": F.lit("new"), "source": F.lit("s"), "export_time_utc": F.to_timestamp(F.lit(B), "yyyyMMddHHmmss")})
    tables.publish("quality_warnings", new.drop("export_date", "export_key"))
    assert sorted((r.export_key[2:], r.reason) for r in tables.read("quality_warnings").collect()) == [(A, "old"), (B, "new")]


def test_a_load_lists_the_landing_folder_once(spark, tmp_path, monkeypatch):
    write_export(tmp_path / "z", A, [line(GLOBALEVENTID="1")])
    write_export(tmp_path / "z", B, [line(GLOBALEVENTID="2")])
    seen = []
    from tidewatch.plans import load

    load_rows = load.load_rows
    monkeypatch.setattr(load, "load_rows", lambda tables, rows, named, *rest: (seen.append(named), load_rows(tables, rows, named, *rest)))
    tables = EventTables(spark, str(tmp_path / "t"))
    assert load_landing(spark, tables, str(tmp_path / "z"), AS_OF, exports_per_load=1) == 2
    for named in seen:
        assert "binaryFile" not in named._jdf.queryExecution().executedPlan().toString()
    listed = exports.list_exports(spark, str(tmp_path / "z")).drop("length").collect()
    assert sorted(row for named in seen for row in named.collect()) == sorted(listed)


def test_a_small_batch_of_files_is_read_by_all_cores(spark, tmp_path):
    for i in range(8):
        write_export(tmp_path / "z", f"202603260{i}0000", [line(GLOBALEVENTID=str(i))])
    rows = exports.scan_export_zip(spark, str(tmp_path / "z"))
    held = rows.groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert len(held) == min(8, spark.sparkContext.defaultParallelism) and sum(r["count"] for r in held) == 8


def test_the_next_batch_is_worked_out_while_one_is_written(spark, tmp_path, monkeypatch):
    """Also where it meets keys that the load before it records, or withdraws since its export is tried again."""
    from tidewatch.plans import load

    landing, tables = tmp_path / "z", EventTables(spark, str(tmp_path / "t"))
    write_export(landing, A, [line(GLOBALEVENTID="5")])
    write_export(landing, B, [line(GLOBALEVENTID="7")])
    with monkeypatch.context() as patch:
        patch.setattr(load.lg, "completed", lambda *_: 1 / 0)  # the keys are recorded, the exports are not completed
        with pytest.raises(ZeroDivisionError):
            load_landing(spark, tables, str(landing), AS_OF)
    write_export(landing, A, [line(GLOBALEVENTID="6")])
    write_export(landing, B, [line(GLOBALEVENTID="7"), line(GLOBALEVENTID="5"), line(GLOBALEVENTID="6")])
    steps, parse, publish = [], load._Batch.parse, load._publish
    monkeypatch.setattr(load._Batch, "parse", lambda batch: (steps.append("parsed"), parse(batch)))
    monkeypatch.setattr(load, "_publish", lambda batch: (publish(batch), steps.append("written"))[0])
    assert load_landing(spark, tables, str(landing), AS_OF, exports_per_load=1) == 2
    assert steps[:2] == ["parsed", "parsed"] and steps.count("written") == 2
    stored = {(r.global_event_id, r.export_key[-14:]) for r in tables.read("raw_events").collect()}
    assert stored == {(6, A), (7, B), (5, B)}
    assert sorted(r.global_event_id for r in tables.keys().table.read().collect()) == [5, 6, 7]
