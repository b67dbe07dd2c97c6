from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tests.helpers import line, one, write_export, write_plain
from tidewatch.operators import dedupe, ledger
from tidewatch.plans.load import load_landing
from tidewatch.sources import exports
from tidewatch.sources.tables import EventTables
from tidewatch.streaming.loader import stream_load

AS_OF = "2026-03-27 00:00:00"
A, B, C = "20260326001500", "20260326003000", "20260326004500"


@pytest.fixture
def tables(spark, tmp_path):
    return EventTables(spark, str(tmp_path / "tables"))


def keys(tables, name="normalized_events"):
    return sorted(r.dedupe_key.rsplit(":")[-1] for r in tables.read(name).select("dedupe_key").collect())


def status(tables):
    rows = ledger.current(tables.read("export_checkpoints")).collect()
    return {r.export_time_utc.strftime("%Y%m%d%H%M%S"): (r.status, r.attempt_count) for r in rows}


def test_zip_rows_short_rows_and_quotes(spark, tmp_path):
    write_export(tmp_path, A, [line(), "too\tshort", "", line(Actor1Name='"Say ""hi"""') + "\textra"])
    rows = exports.scan_export_zip(spark, str(tmp_path))
    good = exports.well_formed(rows).orderBy("row_number").collect()
    assert [(r.row_number, r.Actor1Name) for r in good] == [(1, "HARBOUR UNION"), (4, 'Say "hi"')]
    assert [(r.row_number, r.cols) for r in exports.malformed(rows).orderBy("row_number").collect()] == [
        (2, ["too", "short"]), (3, [])]


def test_plain_rows_equal_zipped_rows(spark, tmp_path):
    lines = [line(GLOBALEVENTID=str(i), Actor1Name=f'"n ""{i}"""') for i in range(300)]
    lines[5], lines[70], lines[71] = "too\tshort", "", "\t".join([""] * 61)
    write_export(tmp_path / "z", A, lines)
    write_plain(tmp_path / "p", A, lines)
    default = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "7000")  # many blocks per file
    try:
        plain = exports.scan_export_tsv(spark, str(tmp_path / "p")).drop("path")
        assert plain.rdd.getNumPartitions() >= 1
        got = sorted(plain.collect(), key=lambda r: r.row_number)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", default)
    want = sorted(exports.scan_export_zip(spark, str(tmp_path / "z")).drop("path").collect(), key=lambda r: r.row_number)
    assert got == want and len(got) == 300


def test_unreadable_files_are_reported(spark, tmp_path):
    write_export(tmp_path, A, [line()], member="readme.txt")
    (tmp_path / f"{B}.export.CSV.zip").write_bytes(b"no zip at all")
    rows = exports.scan_export_zip(spark, str(tmp_path)).collect()
    assert len(rows) == 2 and all(r.file_error and r.cols is None for r in rows)


def test_metadata_and_manifest(spark, tmp_path):
    df = spark.createDataFrame([("http://host/v2/20260313001500.export.CSV.zip?x=1",), ("http://host/other.zip",)], "export_url string")
    rows = exports.with_export_metadata(df).collect()
    assert [(r.export_filename, r.export_time_utc) for r in rows] == [
        ("20260313001500.export.CSV.zip", datetime(2026, 3, 13, 0, 15)), ("other.zip", None)]
    with pytest.raises(Exception, match="no export time"):
        exports.with_export_metadata(df, strict=True).collect()
    (tmp_path / "last.txt").write_text("1 a http://data.gdeltproject.org/v2/1.export.CSV.zip\n2 b http://h/1.gkg.csv.zip\n")
    assert one(exports.read_manifest(spark, str(tmp_path / "last.txt"))).export_url == (
        "https://storage.googleapis.com/data.gdeltproject.org/v2/1.export.CSV.zip")


def test_load_twice_inserts_once(spark, tables, tmp_path):
    landing = tmp_path / "landing"
    write_export(landing, A, [line(GLOBALEVENTID="1"), line(GLOBALEVENTID="2", Actor1Name="first"),
                              line(GLOBALEVENTID="2", Actor1Name="second"), line(GLOBALEVENTID="9", DATEADDED="20991231000000"), "bad"])
    write_export(landing, B, [line(GLOBALEVENTID="2"), line(GLOBALEVENTID="3")])
    assert load_landing(spark, tables, str(landing), AS_OF) == 2
    assert keys(tables) == keys(tables, "raw_events") == ["1", "2", "3"]
    assert tables.read("normalized_events").filter(F.col("dedupe_key").endswith(":2")).first().actor1_name == "first"
    counts = {r.export_time_utc.strftime("%Y%m%d%H%M%S"): (r.row_count_raw, r.row_count_inserted, r.row_count_duplicates)
              for r in ledger.current(tables.read("export_checkpoints")).collect()}
    assert counts == {A: (4, 2, 1), B: (2, 1, 1)}
    dropped = sorted((r.drop_reason, r.error_detail) for r in tables.read("dropped_events").collect())
    assert dropped == [("parse_error", "reason=parse_error row_number=5 row_length=1"), ("validation_drop", "time_future_outlier")]

    assert load_landing(spark, tables, str(landing), AS_OF) == 0
    write_export(landing, C, [line(GLOBALEVENTID="3"), line(GLOBALEVENTID="4")])
    assert load_landing(spark, tables, str(landing), AS_OF) == 1
    assert keys(tables) == ["1", "2", "3", "4"]
    assert status(tables) == {A: ("completed", 1), B: ("completed", 1), C: ("completed", 1)}
    assert tables.read("data_quality_audit").count() == 3
    runs = ledger.current_runs(tables.read("ingestion_runs")).collect()
    assert sorted((r.status, r.exports_seen, r.events_inserted, r.events_duplicated) for r in runs) == [
        ("completed", 1, 1, 1), ("completed", 2, 0, 0), ("completed", 2, 3, 2)]


def test_batch_size_does_not_change_the_result(spark, tmp_path):
    landing = tmp_path / "landing"
    for stamp, ids in ((A, "12"), (B, "23"), (C, "314")):
        write_export(landing, stamp, [line(GLOBALEVENTID=i, Actor1Name=f"{stamp}-{i}") for i in ids])
    results = []
    for size in (1, 10):
        tables = EventTables(spark, str(tmp_path / f"t{size}"))
        load_landing(spark, tables, str(landing), AS_OF, exports_per_load=size)
        results.append(sorted((r.dedupe_key, r.actor1_name) for r in tables.read("normalized_events").collect()))
    assert results[0] == results[1] and len(results[0]) == 4


def test_broken_file_fails_alone_and_is_retried(spark, tables, tmp_path):
    landing = tmp_path / "landing"
    write_export(landing, A, [line(GLOBALEVENTID="1")])
    bad = landing / f"{B}.export.CSV.zip"
    bad.write_bytes(b"broken")
    load_landing(spark, tables, str(landing), AS_OF)
    assert status(tables) == {A: ("completed", 1), B: ("failed", 1)}
    write_export(landing, B, [line(GLOBALEVENTID="2")])
    load_landing(spark, tables, str(landing), AS_OF)
    assert status(tables)[B] == ("completed", 2) and keys(tables) == ["1", "2"]


def test_interrupted_load_is_repeated_whole(spark, tables, tmp_path, monkeypatch):
    landing = tmp_path / "landing"
    write_export(landing, A, [line(GLOBALEVENTID="1"), line(GLOBALEVENTID="2")])
    publish = EventTables.publish

    def fail(self, name, df):
        if name == "normalized_events":
            raise RuntimeError("disk full")
        publish(self, name, df)

    monkeypatch.setattr(EventTables, "publish", fail)
    with pytest.raises(RuntimeError, match="disk full"):
        load_landing(spark, tables, str(landing), AS_OF)
    assert status(tables) == {A: ("failed", 1)} and keys(tables, "raw_events") == ["1", "2"]
    monkeypatch.setattr(EventTables, "publish", publish)
    load_landing(spark, tables, str(landing), AS_OF)
    assert status(tables) == {A: ("completed", 2)}
    assert keys(tables) == keys(tables, "raw_events") == ["1", "2"]


def test_plain_landing_loads_the_same(spark, tables, tmp_path):
    write_plain(tmp_path / "p", A, [line(GLOBALEVENTID="1"), "bad", line(GLOBALEVENTID="2")])
    load_landing(spark, tables, str(tmp_path / "p"), AS_OF, plain=True)
    assert keys(tables) == ["1", "2"] and status(tables) == {A: ("completed", 1)}
    assert one(tables.read("dropped_events")).error_detail == "reason=parse_error row_number=2 row_length=1"


def test_latest_only(spark, tables, tmp_path):
    for stamp, i in ((A, "1"), (B, "2")):
        write_export(tmp_path / "z", stamp, [line(GLOBALEVENTID=i)])
    load_landing(spark, tables, str(tmp_path / "z"), AS_OF, latest_only=True)
    assert keys(tables) == ["2"]


def test_stream_equals_batch_and_repeats_nothing(spark, tmp_path):
    landing = tmp_path / "landing"
    for stamp, ids in ((A, "12"), (B, "23"), (C, "34")):
        write_export(landing, stamp, [line(GLOBALEVENTID=i) for i in ids] + ["bad"])
    batch = EventTables(spark, str(tmp_path / "batch"))
    load_landing(spark, batch, str(landing), AS_OF)
    stream = EventTables(spark, str(tmp_path / "stream"))

    def run(checkpoint):
        stream_load(spark, str(landing), stream, str(tmp_path / checkpoint), lambda: AS_OF, files_per_batch=1).awaitTermination()

    run("c1")
    assert keys(stream) == keys(batch) == ["1", "2", "3", "4"]
    run("c1")  # restarted from its checkpoint
    run("c2")  # checkpoint lost: the ledger still knows the files
    assert keys(stream) == keys(batch) and status(stream) == status(batch)
    assert stream.read("dropped_events").count() == 3


def test_both_ways_to_compare_with_history(spark):
    batch = spark.createDataFrame([("s", f"k{i % 7}", i) for i in range(50)], "source string, dedupe_key string, n int")
    history = spark.createDataFrame([("s", "k1"), ("s", "k5"), ("t", "k2")], "source string, dedupe_key string")
    for known_rows in (None, 50):
        rows = dedupe.new_events(batch, history, order=["n"], batch_rows=known_rows).collect()
        assert sorted((r.dedupe_key, r.n) for r in rows) == [("k0", 0), ("k2", 2), ("k3", 3), ("k4", 4), ("k6", 6)]


def test_hot_key_is_cut_before_the_shuffle(spark):
    rows = spark.range(1000).selectExpr(
        "concat('s', id % 1) source", "concat('hot', id % 1) dedupe_key", "id n", "id export_time_utc", "id row_number")
    plan = dedupe.new_events(rows)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan
    assert one(dedupe.new_events(rows)).n == 0


def test_id_range_keeps_every_possible_duplicate(spark, tables, tmp_path):
    landing = tmp_path / "landing"
    same = {"GLOBALEVENTID": "", "Actor1Name": "No id"}
    write_export(landing, A, [line(GLOBALEVENTID=i) for i in ("5", "007", "900")] + [line(**same)])
    load_landing(spark, tables, str(landing), AS_OF)
    write_export(landing, B, [line(GLOBALEVENTID="7"), line(GLOBALEVENTID="8"), line(**same)])
    write_export(landing, C, [line(**same)])
    load_landing(spark, tables, str(landing), AS_OF)
    ids = sorted(r.global_event_id or 0 for r in tables.read("raw_events").collect())
    assert ids == [0, 5, 7, 8, 900]


def test_history_scan_prunes_own_exports_and_ids(spark, tables, tmp_path):
    write_export(tmp_path / "z", A, [line(GLOBALEVENTID="1")])
    load_landing(spark, tables, str(tmp_path / "z"), AS_OF)
    history = dedupe.same_id_range(tables.read("raw_events").filter(~F.col("export_key").isin([B])), 5, 9)
    plan = history.select("source", "dedupe_key")._jdf.queryExecution().executedPlan().toString()
    pushed = plan[plan.index("PushedFilters"):]
    assert "GreaterThanOrEqual(global_event_id,5)" in pushed and "IsNull(global_event_id)" in pushed
    assert "export_key" in plan[plan.index("PartitionFilters"):plan.index("PushedFilters")]


def test_hard_stop_of_the_stream_loses_nothing(spark, tables, tmp_path):
    landing = tmp_path / "landing"
    write_export(landing, A, [line(GLOBALEVENTID="1")])
    listing = exports.list_exports(spark, str(landing))
    fresh = ledger.new_checkpoints(tables.read("export_checkpoints"), listing, AS_OF)
    tables.append("export_checkpoints", fresh.unionByName(ledger.claimed(fresh, AS_OF)))  # what a load writes first
    assert status(tables) == {A: ("processing", 1)}

    def run():
        stream_load(spark, str(landing), tables, str(tmp_path / "c"), lambda: AS_OF).awaitTermination()

    run()
    assert status(tables) == {A: ("completed", 2)} and keys(tables) == ["1"]
    run()
    assert keys(tables, "raw_events") == ["1"]


def test_stream_takes_up_failed_exports(spark, tables, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    (landing / f"{A}.export.CSV.zip").write_bytes(b"broken")

    def run():
        stream_load(spark, str(landing), tables, str(tmp_path / "c"), lambda: AS_OF, files_per_batch=1).awaitTermination()

    run()
    assert status(tables) == {A: ("failed", 1)}
    write_export(tmp_path / "mended", A, [line(GLOBALEVENTID="1")])
    (landing / f"{A}.export.CSV.zip").write_bytes((tmp_path / "mended" / f"{A}.export.CSV.zip").read_bytes())
    write_export(landing, B, [line(GLOBALEVENTID="2")])
    run()
    assert {k: v[0] for k, v in status(tables).items()} == {A: "completed", B: "completed"}
    assert keys(tables) == keys(tables, "raw_events") == ["1", "2"]


def test_sources_of_one_export_time_keep_their_rows(spark, tables, tmp_path):
    for source, i in (("feed_a", "1"), ("feed_b", "2")):
        write_export(tmp_path / source, A, [line(GLOBALEVENTID=i)])
        stream_load(spark, str(tmp_path / source), tables, str(tmp_path / f"c-{source}"), lambda: AS_OF, source=source).awaitTermination()
    assert keys(tables) == keys(tables, "raw_events") == ["1", "2"]
    assert tables.read("data_quality_audit").count() == 2


def test_repeat_replaces_its_own_rows(spark, tables, tmp_path):
    write_export(tmp_path / "z", A, [line(GLOBALEVENTID="1", DATEADDED="20260401000000")])
    load_landing(spark, tables, str(tmp_path / "z"), AS_OF)
    assert tables.read("dropped_events").count() == 1 and keys(tables) == []
    done = ledger.current(tables.read("export_checkpoints"))
    tables.append("export_checkpoints", ledger.released(done))  # offered again
    load_landing(spark, tables, str(tmp_path / "z"), "2026-04-02 00:00:00")
    assert tables.read("dropped_events").count() == 0 and keys(tables) == keys(tables, "raw_events") == ["1"]


def test_files_of_one_export_time_share_a_load_and_runs_keep_their_id(spark, tables, tmp_path):
    write_export(tmp_path / "z" / "x", A, [line(GLOBALEVENTID="1")])
    write_export(tmp_path / "z" / "y", A, [line(GLOBALEVENTID="2")])
    write_export(tmp_path / "z" / "x", B, [line(GLOBALEVENTID="3")])
    load_landing(spark, tables, str(tmp_path / "z" / "*"), AS_OF, run_id="night", exports_per_load=1)
    assert keys(tables) == keys(tables, "raw_events") == ["1", "2", "3"]
    assert {r.id for r in tables.read("ingestion_runs").collect()} == {"night", "night-2"}


def test_export_names_with_and_without_a_query(spark):
    urls = ["file:/z/20260326001500.export.CSV.zip", "http://h/a/b.zip?x=/1", "http://h/c.zip#/d", "plain", "http://h/folder/", "", None]
    df = spark.createDataFrame([(u,) for u in urls], "url string").coalesce(1)
    names = [r[0] for r in df.select(exports.export_filename("url")).collect()]
    assert names == ["20260326001500.export.CSV.zip", "b.zip", "c.zip", "plain", "", "", None]
    path = exports.export_filename("url")
    assert "split(" not in df.select(path)._jdf.queryExecution().analyzed().toString()
