"""Hours kept by a stream, repairs written back, and feeds that are quiet or strange."""

from __future__ import annotations

import zipfile

import pytest
from pyspark.sql import functions as F

from tests.helpers import line, write_export
from tests.test_load import A, AS_OF, B, C, keys, status
from tidewatch.operators import ledger
from tidewatch.plans import analytics, country_codes
from tidewatch.plans.load import load_landing
from tidewatch.sources import files, repairs, zips
from tidewatch.sources.tables import EventTables
from tidewatch.streaming import loader
from tidewatch.streaming.hourly import hourly_table, maintain_hourly_counts, merge_hourly


@pytest.fixture
def tables(spark, tmp_path):
    return EventTables(spark, str(tmp_path / "tables"))


def events(spark, *times):
    return spark.createDataFrame([(t, c) for t, c in times], "t string, primary_category string").select(
        F.col("t").cast("timestamp").alias("event_time_utc"), "primary_category")


def hours(table):
    return {(str(r["hour_bucket"])[:13], r["category"]): (r["event_count"], r["late_count"]) for r in table.read().collect()}


def test_late_rows_correct_stored_hours(spark, tmp_path):
    table = hourly_table(spark, str(tmp_path / "h"))
    merge_hourly(table, events(spark, ("2026-03-01 10:30:00", "x"), ("2026-03-04 00:00:00", "x")), "s", 0)
    untouched = table.version().partitions["2026-03-04"]
    late = events(spark, ("2026-03-01 10:59:59", "x"), ("2026-03-03 01:00:00", "y"), ("2026-03-02 23:00:00", "x"), (None, "x"))
    merge_hourly(table, late, "s", 1)
    want = {("2026-03-01 10", "x"): (2, 1), ("2026-03-04 00", "x"): (1, 0), ("2026-03-03 01", "y"): (1, 0), ("2026-03-02 23", "x"): (1, 0), ("None", "x"): (1, 0)}
    assert hours(table) == want and table.version().partitions["2026-03-04"] == untouched
    merge_hourly(table, late, "s", 1)  # the same micro-batch again
    assert hours(table) == want
    merge_hourly(table, events(spark, ("2026-03-01 10:00:00", "x")), "other", 0)
    assert hours(table)["2026-03-01 10", "x"] == (3, 2)
    merge_hourly(table, events(spark), "s", 2)
    assert hours(table)["2026-03-01 10", "x"] == (3, 2) and table.version().notes["batches"] == {"s": 2, "other": 0}


def test_stream_stopped_inside_a_batch_counts_once(spark, tmp_path, monkeypatch):
    folder, table = str(tmp_path / "e"), hourly_table(spark, str(tmp_path / "h"))
    for n in range(3):
        events(spark, (f"2026-03-0{3 - n} 10:00:00", "x"), ("2026-03-01 10:00:00", "x")).coalesce(1).write.mode("append").parquet(folder)
    schema = spark.read.parquet(folder).schema

    def run():
        source = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder)
        maintain_hourly_counts(source, table, str(tmp_path / "c")).awaitTermination()

    write, calls = files.write_once, []

    def stop(session, path, text):
        calls.append(path)
        if len(calls) == 2:
            write(session, path, text)
            raise RuntimeError("stopped after the switch")
        write(session, path, text)

    with monkeypatch.context() as patch:
        patch.setattr(files, "write_once", stop)
        with pytest.raises(Exception, match="stopped"):
            run()
    run()
    assert hours(table) == {("2026-03-01 10", "x"): (4, hours(table)["2026-03-01 10", "x"][1]), ("2026-03-02 10", "x"): (1, 0), ("2026-03-03 10", "x"): (1, 0)}


def test_spikes_from_hours_want_a_full_hour(spark):
    with pytest.raises(ValueError, match="on the hour"):
        analytics.spikes_from_hours(None, "2026-03-01 10:30:00")


def test_quiet_feed_is_retried_and_recorded(spark, tables, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    (landing / f"{A}.export.CSV.zip").write_bytes(b"broken")

    def run():
        loader.stream_load(spark, str(landing), tables, str(tmp_path / "c"), lambda: AS_OF).awaitTermination()

    run()
    run()  # nothing new: the broken file is tried again
    assert status(tables) == {A: ("failed", 2)}
    write_export(landing, A, [line(GLOBALEVENTID="1")])
    run()  # mended in place, no other file
    assert status(tables) == {A: ("completed", 3)} and keys(tables) == ["1"]
    run()
    runs = ledger.current_runs(tables.read("ingestion_runs")).collect()
    assert sorted((r.status, r.exports_seen, r.exports_completed, r.trigger_mode) for r in runs) == [
        ("completed", 1, 0, "stream"), ("completed", 1, 1, "stream"), ("failed", 1, 0, "stream"), ("failed", 1, 0, "stream")]
    assert ledger.readiness(ledger.current_runs(tables.read("ingestion_runs")), AS_OF).first()["ready"]


def test_many_failed_files_are_all_tried(spark, tables, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    for stamp in (A, B, C):
        (landing / f"{stamp}.export.CSV.zip").write_bytes(b"broken")
    for _ in range(2):
        loader.stream_load(spark, str(landing), tables, str(tmp_path / "c"), lambda: AS_OF, files_per_batch=1).awaitTermination()
    assert status(tables) == {A: ("failed", 2), B: ("failed", 2), C: ("failed", 2)}


def test_misnamed_files_leave_a_failed_row(spark, tables, tmp_path):
    landing = tmp_path / "landing"
    write_export(landing, A, [line(GLOBALEVENTID="1")])
    for name in ("badname", "also-bad"):
        write_export(landing, name, [line(GLOBALEVENTID="2")])
    assert load_landing(spark, tables, str(landing), AS_OF) == 1
    assert load_landing(spark, tables, str(landing), AS_OF) == 0
    rows = ledger.current(tables.read("export_checkpoints")).collect()
    assert sorted((r.status, r.export_filename, r.last_error) for r in rows) == [
        ("completed", f"{A}.export.CSV.zip", None),
        ("failed", "also-bad.export.CSV.zip", "no export time in file name: also-bad.export.CSV.zip"),
        ("failed", "badname.export.CSV.zip", "no export time in file name: badname.export.CSV.zip")]
    runs = ledger.current_runs(tables.read("ingestion_runs")).collect()
    assert sorted((r.status, r.exports_seen) for r in runs) == [("completed", 1), ("completed", 3), ("failed", 2)]
    assert keys(tables) == ["1"]


def test_warnings_and_histograms_are_stored(spark, tables, tmp_path):
    write_export(tmp_path / "z", A, [line(GLOBALEVENTID="1", Actor1Name="", Actor2Name=""), line(GLOBALEVENTID="2"), "bad"])
    load_landing(spark, tables, str(tmp_path / "z"), AS_OF)
    found = sorted((r.reason, r.value, r.threshold) for r in tables.read("quality_warnings").collect())
    assert found == [("high_missing_actor_percent", 50.0, 35.0), ("parse_errors", 1.0, 0.0)]
    histogram = {(r.kind, r.value): r.n for r in tables.read("load_histograms").collect()}
    assert sum(n for (kind, _), n in histogram.items() if kind == "category") == 2


def test_no_staged_folder_is_left(spark, tables, tmp_path):
    base = spark.conf.get("spark.checkpoint.dir")
    write_export(tmp_path / "z", A, [line(GLOBALEVENTID="1")])
    before = set(files.children(spark, base))
    load_landing(spark, tables, str(tmp_path / "z"), AS_OF)
    assert set(files.children(spark, base)) == before


def test_archives_are_read_as_streams(spark, tmp_path):
    """A member larger than what is read at once, a missing file, a file that breaks off, and names with odd characters."""
    odd = tmp_path / "odd name%20#"
    write_export(odd, A, [line(GLOBALEVENTID=str(i)) for i in range(12_000)])
    (odd / f"{B}.export.CSV.zip").write_bytes((odd / f"{A}.export.CSV.zip").read_bytes()[:-400])
    with zipfile.ZipFile(odd / f"{C}.export.CSV.zip", "w", zipfile.ZIP_DEFLATED) as archive:
        archive.writestr("x.CSV", line() + "\n")
    listed = {r["path"]: r["length"] for r in zips.list_zips(spark, str(odd)).collect()}
    assert len(listed) == 3
    got = zips.read_zips(spark, [*listed.items(), (f"file:{tmp_path}/none.export.CSV.zip", 5)])
    counts = {r["name"]: (r["n"], r["errors"]) for r in got.groupBy(F.substring_index("path", "/", -1).alias("name")).agg(
        F.count_if(F.col("file_error").isNull()).alias("n"), F.count("file_error").alias("errors")).collect()}
    assert counts == {f"{A}.export.CSV.zip": (12_000, 0), f"{B}.export.CSV.zip": (0, 1), f"{C}.export.CSV.zip": (1, 0), "none.export.CSV.zip": (0, 1)}
    assert "binaryFile" not in got._jdf.queryExecution().executedPlan().toString()


def test_small_files_share_a_partition():
    reader = zips._Reader([(f"f{i}", 1_000) for i in range(100)] + [("large", 50_000_000)])
    assert [len(p.paths) for p in reader.partitions()] == [63, 37, 1]


def repaired(spark, tmp_path):
    """Two exports; the code of one event is spoilt in its stored file."""
    tables = EventTables(spark, str(tmp_path / "tables"))
    for stamp, i in ((A, "1"), (B, "2")):
        write_export(tmp_path / "z", stamp, [line(GLOBALEVENTID=i, DATEADDED=stamp)])
    load_landing(spark, tables, str(tmp_path / "z"), AS_OF)
    rows = tables.read("normalized_events").filter(F.col("export_key").endswith(A)).withColumns({"country_code": F.lit("??"), "country_name": F.lit(" ")})
    spoilt = rows.collect()
    tables.publish("normalized_events", spark.createDataFrame(spoilt, rows.schema).drop("event_date", "export_key"))
    return tables


def codes(tables):
    return sorted((r.dedupe_key.rsplit(":")[-1], r.country_code, r.country_name) for r in tables.read("normalized_events").collect())


def test_repairs_are_written_back_to_touched_partitions(spark, tmp_path):
    tables = repaired(spark, tmp_path)
    good = codes(tables)[1][1:]
    assert codes(tables)[0] == ("1", "??", " ")
    before = set(tables.read("normalized_events").inputFiles())
    assert country_codes.repair_stored_countries(tables)
    after = set(tables.read("normalized_events").inputFiles())
    assert codes(tables) == [("1", *good), ("2", *good)]
    assert {f for f in before & after if B in f} and not {f for f in before & after if f"{A}/" in f}
    assert not country_codes.repair_stored_countries(tables)


@pytest.mark.parametrize("journalled", [False, True])
def test_a_stopped_repair_leaves_one_whole_table(spark, tmp_path, monkeypatch, journalled):
    tables = repaired(spark, tmp_path)
    good, bad = codes(tables)[1][1:], codes(tables)[0][1:]
    broken = tables.read("normalized_events")
    fixed = country_codes.backfill_country_names(country_codes.backfill_country_codes(broken, tables.read("raw_events")).drop("_changed")).withColumn("_changed", F.lit(True))

    def stop(*args):
        raise RuntimeError("stopped")

    with monkeypatch.context() as patch:
        patch.setattr(*((repairs, "finish") if journalled else (files, "write_once")), stop)
        with pytest.raises(RuntimeError, match="stopped"):
            tables.repair("normalized_events", fixed)
    assert codes(tables)[0][1:] == bad
    again = EventTables(spark, tables.root)
    assert codes(again)[0][1:] == (good if journalled else bad) and len(codes(again)) == 2
    assert files.children(spark, f"{tables.root}/_repairs") == []


def test_near_events_skip_row_groups(spark, tables, tmp_path):
    """Stored in curve order: a box of a few degrees reaches the scan, and equals a search without it."""
    places = [(lat, lon) for lat in range(-80, 81, 20) for lon in range(-170, 171, 20)]
    write_export(tmp_path / "z", A, [line(GLOBALEVENTID=str(i), ActionGeo_Lat=f"{lat}.5", ActionGeo_Long=f"{lon}.25") for i, (lat, lon) in enumerate(places)] + [line(GLOBALEVENTID="999", ActionGeo_Lat="")])
    load_landing(spark, tables, str(tmp_path / "z"), AS_OF)
    stored = tables.read("normalized_events")
    assert stored.filter("location_wkt IS NULL").count() == 1
    for lat, lon, km in ((0.0, 0.0, 2_500.0), (85.0, 10.0, 1_500.0), (-60.5, 179.0, 3_000.0), (0.5, 10.25, 0.5)):
        near = analytics.events_near(stored, lat, lon, km)
        every = stored.withColumn("d", analytics.kilometres("latitude", "longitude", lat, lon)).filter(F.col("d") <= km)
        assert sorted(r.dedupe_key for r in near.collect()) == sorted(r.dedupe_key for r in every.collect()) and near.count() > 0
    plan = analytics.events_near(stored, 0.0, 0.0, 500.0)._jdf.queryExecution().executedPlan().toString()
    pushed = plan[plan.index("PushedFilters"):]
    assert "IsNotNull(longitude), GreaterThanOrEqual(latitude,-4.49" in pushed


def test_near_points_are_near_on_the_curve(spark):
    from tidewatch.functions.numeric import location_key

    rows = spark.sql("SELECT CAST(lat AS DECIMAL(9,6)) lat, CAST(lon AS DECIMAL(9,6)) lon FROM (SELECT explode(sequence(-90, 90, 10)) lat) CROSS JOIN (SELECT explode(sequence(-180, 180, 10)) lon)")
    keyed = rows.withColumn("k", location_key("lat", "lon")).orderBy("k").collect()
    assert all(0 <= r.k < 2**32 for r in keyed) and len({r.k for r in keyed}) == len(keyed)
    quadrant = [(r.lat >= 0, r.lon >= 0) for r in keyed]
    assert sum(a != b for a, b in zip(quadrant, quadrant[1:], strict=False)) == 3


def test_deleted_runs_take_their_rows_along(spark, tables, tmp_path):
    from tidewatch.plans import stored_repairs

    write_export(tmp_path / "z", A, [line(GLOBALEVENTID="1", DATEADDED=A), "bad"])
    load_landing(spark, tables, str(tmp_path / "z"), AS_OF, run_id="first")
    write_export(tmp_path / "z", B, [line(GLOBALEVENTID="2", DATEADDED=B), "bad"])
    load_landing(spark, tables, str(tmp_path / "z"), AS_OF, run_id="second")
    assert stored_repairs.delete_stored_runs(tables, ["first"])
    assert keys(tables) == keys(tables, "raw_events") == ["2"] and tables.read("dropped_events").count() == 1
    assert {r.id for r in tables.read("ingestion_runs").collect()} == {"second"}
    assert [r.dedupe_key[-1] for r in tables.keys().table.read().collect()] == ["2"]
    assert not stored_repairs.delete_stored_runs(tables, ["first"]) and not stored_repairs.collapse_stored_duplicates(tables)
