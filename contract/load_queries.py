"""Sources, writes, ledgers, end-to-end loads and streams."""

from __future__ import annotations

from pyspark.sql import functions as F

from contract import sql_text as q
from contract.adapters import (
    AS_OF, CHECKPOINTS_SQL, RAW_SQL, RUNS_SQL, URL_PREFIX, checkpoint_rows, raw_like, run_log, table,
)
from contract.landing import FX_SQL, export_rows, landing, loaded, loaded_over_history, streamed
from contract.registry import query
from contract.report_queries import _COUNTERS, TABLE_SQL, _pct
from contract.row_queries import normalized_events, validated_events
from tidewatch import fixed_values as fv
from tidewatch.operators import constraints, dedupe, ledger, project, quality, validate
from tidewatch.plans import analytics, country_codes, stored_repairs
from tidewatch.session import shared_folder
from tidewatch.sources import exports
from tidewatch.sources.keys import EventKeys
from tidewatch.sources.tables import EventTables
from tidewatch.streaming.hourly import hourly_table, maintain_hourly_counts, merge_hourly, stream_hourly_counts

NOW = f"TIMESTAMP '{AS_OF}'"
FIELDS = ", ".join(f'"{n}"' for n in fv.FIELD_POSITIONS)

# ---------------------------------------------------------------- files


def _named(rows):
    return rows.withColumn("export_filename", exports.export_filename("path"))


@query("scan_export_zip", f"WITH {FX_SQL} SELECT export_filename, row_number, {FIELDS} FROM raw")
def _scan_zip(spark, sf):
    rows = exports.scan_export_zip(spark, f"{landing(spark, sf)}/zip")
    return _named(exports.well_formed(rows)).drop("path")


@query("scan_export_tsv", f"WITH {FX_SQL} SELECT export_filename || '' AS export_filename, row_number, {FIELDS} FROM raw")
def _scan_tsv(spark, sf):
    rows = exports.scan_export_tsv(spark, f"{landing(spark, sf)}/tsv")
    named = _named(exports.well_formed(rows)).drop("path")
    return named.withColumn("export_filename", F.concat("export_filename", F.lit(".zip")))


@query("split_malformed", f"WITH {FX_SQL} SELECT export_filename, row_number, CAST(3 AS BIGINT) AS row_length FROM fx WHERE short")
def _malformed(spark, sf):
    rows = exports.malformed(exports.scan_export_zip(spark, f"{landing(spark, sf)}/zip"))
    return _named(rows).select("export_filename", "row_number", F.size("cols").alias("row_length"))


@query("project_fields", f"WITH {RAW_SQL} SELECT event_id, " + ", ".join(
    f'trim("{n}") AS "{n}"' for n in fv.FIELD_POSITIONS) + " FROM raw")
def _project(spark, sf):
    at = {position: name for name, position in fv.FIELD_POSITIONS.items()}
    cols = F.array(*[F.col(at[i]) if i in at else F.lit("") for i in range(fv.EXPORT_COLUMNS)])
    return raw_like(spark, sf).select("event_id", cols.alias("cols")).select("event_id", *exports.project_fields("cols"))


_URL = f"'{URL_PREFIX}' || CASE WHEN event_id % 5 = 0 THEN 'notes' ELSE {{stamp}} END || '.export.CSV.zip' || " \
       "CASE WHEN event_id % 3 = 0 THEN '?v=1' ELSE '' END"


@query("parse_export_metadata", f"""WITH u AS (SELECT event_id, ts, {_URL.format(stamp="strftime(ts, '%Y%m%d%H%M%S')")} AS export_url FROM events)
SELECT event_id, export_url, CASE WHEN event_id % 5 = 0 THEN 'notes' ELSE strftime(ts, '%Y%m%d%H%M%S') END || '.export.CSV.zip' AS export_filename,
 CASE WHEN event_id % 5 > 0 THEN date_trunc('second', ts) END AS export_time_utc FROM u""")
def _metadata(spark, sf):
    url = F.expr(_URL.format(stamp="date_format(ts, 'yyyyMMddHHmmss')")).alias("export_url")
    return exports.with_export_metadata(table(spark, sf, "events").select("event_id", url))


_MANIFEST = f"""CASE WHEN event_id % 6 = 0 THEN 'nothing here' ELSE '150383 297a16b493de7cf6ca809a7cc31d0b93 {URL_PREFIX}' || event_id || '.export.CSV.zip
318084 bb27f78ba45f69a17ea6ed7755e9f8ff {URL_PREFIX}' || event_id || '.mentions.CSV.zip' END"""


@query("parse_manifest", f"""SELECT event_id, CASE WHEN event_id % 6 > 0 THEN '{URL_PREFIX}' || event_id || '.export.CSV.zip' END AS export_url
FROM events""")
def _manifest(spark, sf):
    rows = table(spark, sf, "events").withColumn("manifest", F.expr(_MANIFEST))
    return rows.select("event_id", exports.manifest_url("manifest").alias("export_url"))


_HOSTS = f"CASE event_id % 3 WHEN 0 THEN 'http://{fv.FEED_HOST}' WHEN 1 THEN 'http://{fv.FEED_HOST.upper()}' ELSE 'https://example.com' END"


@query("normalize_export_url", f"""SELECT event_id, CASE WHEN event_id % 3 < 2 THEN '{fv.STORE_PREFIX}/v2/' || event_id || '.zip'
 ELSE 'https://example.com/v2/' || event_id || '.zip?x=1' END AS url FROM events""")
def _store_url(spark, sf):
    url = F.expr(f"{_HOSTS} || '/v2/' || event_id || '.zip?x=1'")
    return table(spark, sf, "events").select("event_id", exports.normalize_export_url(url).alias("url"))


@query("latest_export", f"WITH {FX_SQL} SELECT export_filename, export_time_utc FROM fx ORDER BY export_time_utc DESC LIMIT 1")
def _latest_export(spark, sf):
    listing = exports.list_exports(spark, f"{landing(spark, sf)}/zip")
    return exports.latest_export(listing).select("export_filename", "export_time_utc")


@query("discover_new_exports", f"""WITH {FX_SQL} SELECT DISTINCT export_filename, export_time_utc FROM fx
WHERE minute(export_time_utc) NOT IN (15, 30)""")
def _discover(spark, sf):
    listing = exports.list_exports(spark, f"{landing(spark, sf)}/zip")
    known = export_rows(spark, sf).select(
        F.lit(fv.SOURCE).alias("source"), "export_time_utc",
        F.expr("CASE minute(export_time_utc) WHEN 15 THEN 'completed' WHEN 30 THEN 'processing' WHEN 45 THEN 'failed' "
               "ELSE 'pending' END").alias("status")).distinct()
    return exports.discover_new(listing, known).select("export_filename", "export_time_utc")


# ---------------------------------------------------------------- appends

_SPLIT = "2024-01-11"


@query("append_raw_dedup", f"""WITH {q.VALID_SQL}, live AS (SELECT * FROM valid WHERE NOT "drop"),
r AS (SELECT *, row_number() OVER (PARTITION BY source, dedupe_key ORDER BY export_time_utc, row_number) AS rn FROM live)
SELECT event_id, source, dedupe_key FROM r WHERE rn = 1
 AND (source, dedupe_key) NOT IN (SELECT (source, dedupe_key) FROM live WHERE export_time_utc < TIMESTAMP '{_SPLIT}')""")
def _append_raw(spark, sf):
    live = validate.surviving(validated_events(spark, sf))
    history = live.filter(F.col("export_time_utc") < F.lit(_SPLIT).cast("timestamp"))
    return dedupe.new_events(live, history).select("event_id", "source", "dedupe_key")


@query("dedupe_stored_history", f"""WITH {q.VALID_SQL}, live AS (SELECT * FROM valid WHERE NOT "drop"),
r AS (SELECT *, row_number() OVER (PARTITION BY source, dedupe_key ORDER BY export_time_utc, row_number) AS rn FROM live)
SELECT event_id, source, dedupe_key FROM r WHERE rn = 1
 AND (source, dedupe_key) NOT IN (SELECT (source, dedupe_key) FROM live WHERE export_time_utc < TIMESTAMP '{_SPLIT}')""")
def _stored_history(spark, sf):
    """What a load appends, with the history in the stored key table."""
    folder = shared_folder(spark, "live-events")
    validate.surviving(validated_events(spark, sf)).write.parquet(folder)
    live = spark.read.parquet(folder)
    keys = EventKeys(spark, shared_folder(spark, "event-keys"), ids=1_000)
    earlier = live.filter(F.col("export_time_utc") < F.lit(_SPLIT).cast("timestamp"))
    keys.record(dedupe.first_of_new(earlier, keys.colliding(earlier, [])), [])
    return dedupe.first_of_new(live, keys.colliding(live, [])).select("event_id", "source", "dedupe_key")


@query("anti_join_existing", f"""WITH {q.NORM_SQL}
SELECT event_id, dedupe_key FROM norm WHERE dedupe_key NOT IN (SELECT dedupe_key FROM norm WHERE export_time_utc < TIMESTAMP '{_SPLIT}')""")
def _anti(spark, sf):
    rows = normalized_events(spark, sf)
    history = rows.filter(F.col("export_time_utc") < F.lit(_SPLIT).cast("timestamp"))
    return dedupe.not_stored(rows, history, dedupe.EVENT_KEY).select("event_id", "dedupe_key")


@query("match_inserted_keys", f"""WITH {q.NORM_SQL}
SELECT event_id, dedupe_key FROM norm WHERE dedupe_key IN (SELECT dedupe_key FROM norm WHERE export_time_utc < TIMESTAMP '{_SPLIT}')""")
def _semi(spark, sf):
    rows = normalized_events(spark, sf)
    inserted = rows.filter(F.col("export_time_utc") < F.lit(_SPLIT).cast("timestamp"))
    return dedupe.inserted_only(rows, inserted).select("event_id", "dedupe_key")


_NORMALIZED = ["dedupe_key", "event_time_utc", "actor1_name", "actor2_name", "event_code", "country_code", "country_name",
               "latitude", "longitude", "goldstein_score", "primary_category", "secondary_category",
               "category_confidence", "category_reason", "source"]
_NORMALIZED_DOUBLES = {"latitude", "longitude", "goldstein_score", "category_confidence"}
_NORMALIZED_SELECT = "SELECT " + ", ".join(
    f"CAST({c} AS DOUBLE) AS {c}" if c in _NORMALIZED_DOUBLES else c for c in _NORMALIZED) + " FROM nt"


@query("append_normalized", f"WITH {TABLE_SQL} {_NORMALIZED_SELECT}")
def _append_normalized(spark, sf):
    accepted = dedupe.new_events(validate.surviving(validated_events(spark, sf)))
    return project.normalized_rows(accepted, AS_OF).select(*_NORMALIZED)


@query("apply_defaults", f"""WITH {RAW_SQL} SELECT event_id AS row_number, '{fv.SOURCE}' AS source, {NOW} AS inserted_at,
coalesce(nullif(trim("Actor2Name"), ''), 'Unknown') AS country_name FROM raw""")
def _defaults(spark, sf):
    rows = raw_like(spark, sf).select("row_number", F.nullif(F.trim("Actor2Name"), F.lit("")).alias("country_name"))
    return project.normalized_rows(rows, AS_OF).select("row_number", "source", "inserted_at", "country_name")


# ---------------------------------------------------------------- end-to-end loads

_FILE_TABLE_SQL = TABLE_SQL.replace(RAW_SQL, FX_SQL)
_FILE_VALID_SQL = q.VALID_SQL.replace(RAW_SQL, FX_SQL)


@query("load_export", f"WITH {_FILE_TABLE_SQL} {_NORMALIZED_SELECT}")
def _load(spark, sf):
    return loaded(spark, sf).read("normalized_events").select(*_NORMALIZED)


@query("load_over_history", f"WITH {_FILE_TABLE_SQL} {_NORMALIZED_SELECT}")
def _load_history(spark, sf):
    return loaded_over_history(spark, sf).read("normalized_events").select(*_NORMALIZED)


@query("stored_event_keys", f"WITH {_FILE_TABLE_SQL} SELECT source, dedupe_key, strftime(export_time_utc, '%Y%m%d%H%M%S') AS export FROM nt")
def _stored_keys(spark, sf):
    return loaded_over_history(spark, sf).keys().table.read().select(
        "source", "dedupe_key", F.substring_index("export_key", "-", -1).alias("export"))


@query("stored_quality_audit", f"""WITH {_FILE_VALID_SQL}, audit AS (SELECT export_time_utc, total_events, {_pct('missing_actor')},
 {_pct('missing_geo')}, {_pct('unknown_country')} FROM (SELECT export_time_utc, count(*) AS total_events, {_COUNTERS} FROM valid GROUP BY export_time_utc))
SELECT strftime(export_time_utc, '%Y%m%d%H%M%S') AS export, {NOW} AS run_timestamp, * EXCLUDE (export_time_utc) FROM audit""")
def _stored_audit(spark, sf):
    audit = loaded(spark, sf).read("data_quality_audit").drop("export_date").withColumn("export", F.substring_index("export_key", "-", -1)).drop("export_key")
    return audit.withColumns({c: F.round(c, 6) for c in ("missing_actor_pct", "missing_geo_pct", "unknown_country_pct")})


@query("stored_quality_warnings", f"""WITH {_FILE_VALID_SQL}, audit AS (SELECT export_time_utc, total_events, {_pct('missing_actor')},
 {_pct('missing_geo')}, {_pct('unknown_country')} FROM (SELECT export_time_utc, count(*) AS total_events, {_COUNTERS} FROM valid GROUP BY export_time_utc)),
w AS (SELECT export_time_utc, 'high_missing_actor_percent' AS reason, missing_actor_pct AS value, CAST(35 AS DOUBLE) AS threshold FROM audit WHERE missing_actor_pct > 35
UNION ALL SELECT export_time_utc, 'high_missing_geo_percent', missing_geo_pct, 45 FROM audit WHERE missing_geo_pct > 45
UNION ALL SELECT export_time_utc, 'high_unknown_country_percent', unknown_country_pct, 30 FROM audit WHERE unknown_country_pct > 30
UNION ALL SELECT export_time_utc, 'parse_errors', CAST(count(*) AS DOUBLE), 0 FROM fx WHERE short GROUP BY export_time_utc)
SELECT strftime(export_time_utc, '%Y%m%d%H%M%S') AS export, {NOW} AS run_timestamp, reason, value, threshold FROM w""")
def _stored_warnings(spark, sf):
    return loaded(spark, sf).read("quality_warnings").select(
        F.substring_index("export_key", "-", -1).alias("export"), "run_timestamp", "reason", F.round("value", 6).alias("value"), "threshold")


@query("stored_histograms", f"""WITH {_FILE_VALID_SQL}, f AS (SELECT export_time_utc, 'validation_flag' AS kind,
 unnest(string_split(quality_flags, ',')) AS value FROM valid WHERE quality_flags <> ''
UNION ALL SELECT export_time_utc, 'category', primary_category FROM valid WHERE NOT "drop")
SELECT strftime(export_time_utc, '%Y%m%d%H%M%S') AS export, kind, value, count(*) AS n FROM f GROUP BY ALL""")
def _stored_histograms(spark, sf):
    return loaded(spark, sf).read("load_histograms").select(F.substring_index("export_key", "-", -1).alias("export"), "kind", "value", "n")


@query("latest_stored", f"""WITH {_FILE_TABLE_SQL} SELECT event_time_utc, dedupe_key, primary_category FROM nt
 ORDER BY event_time_utc DESC NULLS LAST, export_time_utc DESC, row_number DESC LIMIT 20""")
def _latest_stored(spark, sf):
    """The newest events of the stored table, of which only the newest dates are read."""
    newest = loaded(spark, sf).newest_events(20)
    order = [F.desc_nulls_last("event_time_utc"), F.desc("export_time_utc"), F.desc("row_number")]
    return newest.orderBy(*order).limit(20).select("event_time_utc", "dedupe_key", "primary_category")


@query("stored_location_point", f"""WITH {_FILE_TABLE_SQL} SELECT dedupe_key, CASE WHEN latitude IS NOT NULL AND longitude IS NOT NULL
 THEN 'POINT(' || CAST(longitude AS DECIMAL(9,6)) || ' ' || CAST(latitude AS DECIMAL(9,6)) || ')' END AS location_wkt FROM nt""")
def _stored_location(spark, sf):
    return loaded(spark, sf).read("normalized_events").select("dedupe_key", "location_wkt")


@query("events_near_point", f"""WITH {_FILE_TABLE_SQL}, h AS (SELECT dedupe_key, pow(sin((radians(CAST(latitude AS DOUBLE)) - radians(10.0)) / 2), 2)
 + cos(radians(CAST(latitude AS DOUBLE))) * cos(radians(10.0)) * pow(sin((radians(CAST(longitude AS DOUBLE)) - radians(30.0)) / 2), 2) AS half FROM nt)
SELECT dedupe_key, round(2 * 6371.0088 * asin(sqrt(least(half, 1.0))), 3) AS distance_km FROM h WHERE 2 * 6371.0088 * asin(sqrt(least(half, 1.0))) <= 1500""")
def _near(spark, sf):
    """Stored events within 1,500 km of a point."""
    near = analytics.events_near(loaded(spark, sf).read("normalized_events"), 10.0, 30.0, 1_500.0)
    return near.select("dedupe_key", F.round("distance_km", 3).alias("distance_km"))


@query("repair_stored_countries",
       f"WITH {_FILE_TABLE_SQL} SELECT dedupe_key, country_code, country_name FROM nt")
def _repair_stored(spark, sf):
    """Codes and names blanked in a third of the stored events, written back, then repaired from the raw events."""
    root = shared_folder(spark, "repaired-tables")
    source = loaded(spark, sf)
    tables = EventTables(spark, root)
    for name in ("normalized_events", "raw_events"):
        partitions = ["event_date" if name == "normalized_events" else "export_date", "export_key"]
        rows = source.read(name)
        if name == "normalized_events":
            broken = F.pmod(F.xxhash64("dedupe_key"), F.lit(3)) == 0
            rows = rows.withColumns({"country_code": F.when(broken, F.lit("??")).otherwise(F.col("country_code")),
                                     "country_name": F.when(broken, F.lit(" ")).otherwise(F.col("country_name"))})
        rows.write.partitionBy(*partitions).parquet(tables.path(name))
    country_codes.repair_stored_countries(tables)
    return EventTables(spark, root).read("normalized_events").select("dedupe_key", "country_code", "country_name")


@query("collapse_stored_duplicates", f"""WITH {_FILE_TABLE_SQL} SELECT 'normalized_events' AS table_name, dedupe_key FROM nt
UNION ALL SELECT 'raw_events', dedupe_key FROM nt UNION ALL SELECT 'event_keys', dedupe_key FROM nt""")
def _collapse_stored(spark, sf):
    """A third of the stored events, stored again under a later export, then collapsed in place."""
    tables, source = EventTables(spark, shared_folder(spark, "doubled-tables")), loaded(spark, sf)
    for name, date in (("normalized_events", "event_date"), ("raw_events", "export_date")):
        rows = source.read(name)
        again = rows.filter(F.pmod(F.xxhash64("dedupe_key"), F.lit(3)) == 0).withColumns({
            "export_time_utc": F.col("export_time_utc") + F.expr("INTERVAL 400 DAY"), "export_key": F.concat("export_key", F.lit("-again"))})
        if date == "export_date":
            again = again.withColumn(date, F.to_date("export_time_utc"))
        rows.unionByName(again).write.partitionBy(date, "export_key").parquet(tables.path(name))
    stored_repairs.collapse_stored_duplicates(tables)
    parts = [df.select(F.lit(name).alias("table_name"), "dedupe_key") for name, df in (
        ("normalized_events", tables.read("normalized_events")), ("raw_events", tables.read("raw_events")), ("event_keys", tables.keys().table.read()))]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("append_dropped", f"""WITH {_FILE_VALID_SQL}
SELECT source, export_time_utc, dedupe_key, 'validation_drop' AS drop_reason, replace(quality_flags, ',', ', ') AS error_detail,
 quality_flags FROM valid WHERE "drop"
UNION ALL SELECT '{fv.SOURCE}', export_time_utc, NULL, 'parse_error', 'reason=parse_error row_number=' || row_number || ' row_length=3',
 'parse_error' FROM fx WHERE short""")
def _dropped(spark, sf):
    return loaded(spark, sf).read("dropped_events").select(
        "source", "export_time_utc", "dedupe_key", "drop_reason", "error_detail", "quality_flags")


_COUNTS = """c AS (SELECT export_time_utc, count(*) AS rows_seen, count_if("drop") AS rows_dropped FROM valid GROUP BY ALL),
i AS (SELECT export_time_utc, count(*) AS rows_inserted FROM stored GROUP BY ALL)"""


@query("load_metrics", f"""WITH {_FILE_TABLE_SQL}, {_COUNTS}
SELECT export_time_utc, 'completed' AS status, CAST(1 AS BIGINT) AS attempt_count, rows_seen AS row_count_raw,
 coalesce(rows_inserted, 0) AS row_count_inserted,
 CAST(rows_seen - coalesce(rows_inserted, 0) - rows_dropped AS BIGINT) AS row_count_duplicates
FROM c LEFT JOIN i USING (export_time_utc)""")
def _load_metrics(spark, sf):
    log = loaded(spark, sf).read("export_checkpoints")
    return ledger.current(log).select("export_time_utc", "status", "attempt_count", "row_count_raw", "row_count_inserted",
                                      "row_count_duplicates")


@query("load_outcomes", f"""WITH {q.STORED_SQL}, o AS (SELECT v.export_time_utc, CASE WHEN v."drop" THEN 'dropped'
 WHEN s.event_id IS NULL THEN 'duplicate' ELSE 'inserted' END AS outcome FROM valid v LEFT JOIN stored s USING (event_id))
SELECT export_time_utc::TIMESTAMP AS export_time_utc, count(*) AS rows_seen, CAST(count_if(outcome = 'inserted') AS BIGINT) AS rows_inserted,
 CAST(count_if(outcome = 'duplicate') AS BIGINT) AS rows_duplicated, CAST(count_if(outcome = 'dropped') AS BIGINT) AS rows_dropped,
 CAST(0 AS BIGINT) AS parse_errors, CAST(count_if(outcome = 'inserted') AS BIGINT) AS normalized_inserted,
 CAST(epoch({NOW}) - epoch(export_time_utc) AS BIGINT) AS export_lag_seconds FROM o GROUP BY ALL""")
def _outcomes(spark, sf):
    rows = validated_events(spark, sf)
    kept = dedupe.rank_per_key(rows, [*dedupe.EVENT_KEY, "drop"], dedupe.ARRIVAL)
    outcome = F.when(F.col("drop"), "dropped").when(F.col("_rank") == 1, "inserted").otherwise("duplicate")
    return quality.load_metrics(kept.withColumn("outcome", outcome), AS_OF, by=["export_time_utc"])


@query("stream_load", f"WITH {_FILE_TABLE_SQL} {_NORMALIZED_SELECT}")
def _stream(spark, sf):
    return streamed(spark, sf).read("normalized_events").select(*_NORMALIZED)


@query("exactly_once_files", f"""WITH {_FILE_TABLE_SQL} SELECT export_time_utc, CAST(1 AS BIGINT) AS attempt_count, count(*) AS rows_seen
 FROM valid GROUP BY ALL""")
def _exactly_once(spark, sf):
    tables = streamed(spark, sf, runs=2)
    return ledger.current(tables.read("export_checkpoints")).select(
        "export_time_utc", "attempt_count", F.col("row_count_raw").alias("rows_seen"))


@query("stream_dedupe", f"WITH {_FILE_TABLE_SQL} SELECT source, dedupe_key, CAST(1 AS BIGINT) AS copies FROM nt")
def _stream_dedupe(spark, sf):
    raw = streamed(spark, sf, runs=2).read("raw_events")
    return raw.groupBy("source", "dedupe_key").agg(F.count("*").alias("copies"))


@query("late_rows", f"""WITH {_FILE_TABLE_SQL} SELECT CAST(event_time_utc AS DATE) AS event_date, count(*) AS events FROM nt GROUP BY ALL""")
def _late(spark, sf):
    """Events stored per day of their own time: all are older than their export, and none is refused."""
    return streamed(spark, sf).read("normalized_events").groupBy("event_date").agg(F.count("*").alias("events"))


@query("stream_hourly_counts", """SELECT date_trunc('hour', ts) AS hour_bucket, event_type AS category, count(*) AS event_count
FROM events GROUP BY ALL""")
def _stream_hourly(spark, sf):
    schema = table(spark, sf, "events").schema
    events = (
        spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf)
        .select(F.col("ts").cast("timestamp").alias("event_time_utc"), F.col("event_type").alias("primary_category"))
    )
    out = shared_folder(spark, "stream-hours")

    def keep(batch, batch_id: int) -> None:
        batch.withColumn("_batch", F.lit(batch_id)).write.mode("overwrite").parquet(f"{out}/_batch_id={batch_id}")

    counts = stream_hourly_counts(events, as_of=AS_OF)
    counts.writeStream.outputMode("update").foreachBatch(keep).trigger(availableNow=True).option(
        "checkpointLocation", shared_folder(spark, "stream-checkpoint")).start().awaitTermination()
    updates = spark.read.parquet(f"{out}/_batch_id=*")
    newest = dedupe.first_per_key(updates, ["hour_bucket", "category"], [F.desc("_batch")])
    return newest.select("hour_bucket", "category", "event_count")


def _event_files(spark, sf, folder: str, numbers: range, of: int):
    """The events as files of a growing folder: every ``of``-th in one, so that each holds early and late ones."""
    events = table(spark, sf, "events").select(
        "event_id", F.col("ts").cast("timestamp").alias("event_time_utc"), F.col("event_type").alias("primary_category"))
    for number in numbers:
        events.filter(F.col("event_id") % of == number).drop("event_id").write.mode("append").parquet(folder)
    return spark.readStream.schema(events.drop("event_id").schema).option("maxFilesPerTrigger", 1).parquet(folder)


@query("maintained_hourly_counts", """SELECT date_trunc('hour', ts) AS hour_bucket, event_type AS category, count(*) AS event_count
FROM events GROUP BY ALL""")
def _maintained_hourly(spark, sf):
    """Several micro-batches, each with rows of hours that earlier ones have closed."""
    folder, hours = shared_folder(spark, "event-files"), hourly_table(spark, shared_folder(spark, "hours"))
    events = _event_files(spark, sf, folder, range(4), 4)
    maintain_hourly_counts(events, hours, shared_folder(spark, "stream-checkpoint")).awaitTermination()
    return hours.read().drop("late_count")


@query("stream_restart", """SELECT date_trunc('hour', ts) AS hour_bucket, event_type AS category, count(*) AS event_count
FROM events GROUP BY ALL""")
def _stream_restart(spark, sf):
    """A stream of hours that ends, goes on from its checkpoint when files have come, and repeats its last micro-batch."""
    folder, hours, checkpoint = shared_folder(spark, "event-files"), hourly_table(spark, shared_folder(spark, "hours")), shared_folder(spark, "stream-checkpoint")
    for numbers in (range(2), range(2, 4)):
        maintain_hourly_counts(_event_files(spark, sf, folder, numbers, 4), hours, checkpoint).awaitTermination()
    last = hours.version().notes["batches"]["events"]
    merge_hourly(hours, spark.read.parquet(folder), "events", last)
    return hours.read().drop("late_count")


@query("late_row_counts", """WITH e AS (SELECT *, event_id % 4 AS batch FROM events), newest AS (SELECT batch, max(ts) AS newest FROM e GROUP BY batch),
known AS (SELECT batch, max(newest) OVER (ORDER BY batch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS newest FROM newest)
SELECT date_trunc('hour', ts) AS hour_bucket, event_type AS category, count(*) AS event_count,
 CAST(count_if(coalesce(date_trunc('hour', ts) + INTERVAL 1 HOUR + INTERVAL 1 DAY < known.newest, false)) AS BIGINT) AS late_count
FROM e JOIN known USING (batch) GROUP BY ALL""")
def _late_counts(spark, sf):
    hours = hourly_table(spark, shared_folder(spark, "hours"))
    events = table(spark, sf, "events").select(
        "event_id", F.col("ts").cast("timestamp").alias("event_time_utc"), F.col("event_type").alias("primary_category"))
    for number in range(4):
        merge_hourly(hours, events.filter(F.col("event_id") % 4 == number), "events", number)
    return hours.read()


# ---------------------------------------------------------------- checkpoints

_ORDER = """CASE status WHEN 'completed' THEN 0 WHEN 'processing' THEN 1 WHEN 'failed' THEN 2 ELSE 3 END,
 completed_at DESC NULLS LAST, discovered_at DESC, id DESC"""
_BEST = f"best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY source, export_time_utc ORDER BY {_ORDER}) AS rn FROM cp) WHERE rn = 1)"
_CP = ["id", "source", "export_time_utc", "status", "discovered_at", "processing_started_at", "completed_at",
       "attempt_count", "last_error"]
_CP_SELECT = ("SELECT id, source, export_time_utc, {status} AS status, discovered_at, {started} AS processing_started_at, "
              "{completed} AS completed_at, CAST({attempts} AS BIGINT) AS attempt_count, {error} AS last_error FROM {source} {where}")


def _cp_sql(source: str, where: str = "", **changes: str) -> str:
    values = {"status": "status", "started": "processing_started_at", "completed": "completed_at",
              "attempts": "attempt_count", "error": "last_error", **changes}
    return f"WITH {CHECKPOINTS_SQL}, {_BEST} " + _CP_SELECT.format(source=source, where=where, **values)


@query("rank_checkpoints", _cp_sql("best"))
def _rank(spark, sf):
    return ledger.best_checkpoints(checkpoint_rows(spark, sf)).select(*_CP)


@query("checkpoint_insert", f"""WITH {CHECKPOINTS_SQL}, {_BEST},
hours AS (SELECT DISTINCT date_trunc('hour', ts) AS export_time_utc FROM events),
old AS (SELECT export_time_utc, status FROM best WHERE export_time_utc < TIMESTAMP '2024-01-16')
SELECT 'feed' AS source, export_time_utc, coalesce(status, 'pending') AS status FROM hours LEFT JOIN old USING (export_time_utc)""")
def _insert(spark, sf):
    rows = checkpoint_rows(spark, sf)
    old = rows.filter(F.col("export_time_utc") < F.lit("2024-01-16").cast("timestamp"))
    offered = rows.select("source", "export_time_utc", "export_url", "export_filename")
    return ledger.best_checkpoints(ledger.insert_checkpoints(old, offered, AS_OF)).select("source", "export_time_utc", "status")


@query("checkpoint_claim", _cp_sql("cp", "WHERE status IN ('pending', 'failed')", status="'processing'", started=NOW,
                                   attempts="attempt_count + 1"))
def _claim(spark, sf):
    return ledger.claimed(checkpoint_rows(spark, sf), AS_OF).select(*_CP)


_STALE = "WHERE status = 'processing' AND processing_started_at < TIMESTAMP '2024-01-15 00:00:00' - INTERVAL 30 MINUTE"


@query("checkpoint_reset_stale", _cp_sql("cp", _STALE, status="'pending'", started="CAST(NULL AS TIMESTAMP)",
                                         error=f"coalesce(last_error, '{fv.STALE_RESET_TEXT}')"))
def _reset(spark, sf):
    return ledger.stale_reset(checkpoint_rows(spark, sf), "2024-01-15 00:00:00", source="feed").select(*_CP)


@query("stale_retry", _cp_sql("cp", _STALE, status="'processing'", started=NOW, attempts="attempt_count + 1",
                              error=f"coalesce(last_error, '{fv.STALE_RESET_TEXT}')"))
def _retry(spark, sf):
    stale = ledger.stale_reset(checkpoint_rows(spark, sf), "2024-01-15 00:00:00", source="feed")
    return ledger.claimed(stale, AS_OF).select(*_CP)


@query("checkpoint_complete", f"""WITH {CHECKPOINTS_SQL}, {_BEST},
n AS (SELECT date_trunc('hour', ts) AS export_time_utc, count(*) AS seen, CAST(count_if(event_id % 3 > 0) AS BIGINT) AS kept FROM events GROUP BY ALL)
SELECT id, export_time_utc, 'completed' AS status, {NOW} AS completed_at, CAST(NULL AS VARCHAR) AS last_error,
 seen AS row_count_raw, kept AS row_count_inserted, seen - kept AS row_count_duplicates FROM best JOIN n USING (export_time_utc)""")
def _complete(spark, sf):
    counts = table(spark, sf, "events").groupBy(F.date_trunc("hour", "ts").alias("export_time_utc")).agg(
        F.count("*").alias("rows_seen"), F.count_if(F.col("event_id") % 3 > 0).alias("rows_inserted"))
    counts = counts.select(F.lit("feed").alias("source"), "*", (F.col("rows_seen") - F.col("rows_inserted")).alias("rows_duplicated"))
    done = ledger.completed(ledger.best_checkpoints(checkpoint_rows(spark, sf)), counts, AS_OF)
    return done.select("id", "export_time_utc", "status", "completed_at", "last_error", "row_count_raw",
                       "row_count_inserted", "row_count_duplicates")


@query("checkpoint_fail", f"""WITH {CHECKPOINTS_SQL}, {_BEST},
e AS (SELECT date_trunc('hour', ts) AS export_time_utc, 'broken ' || count(*) AS message FROM events WHERE event_type = 'error' GROUP BY ALL)
SELECT id, export_time_utc, 'failed' AS status, completed_at, message AS last_error FROM best JOIN e USING (export_time_utc)""")
def _fail(spark, sf):
    errors = table(spark, sf, "events").filter("event_type = 'error'").groupBy(
        F.date_trunc("hour", "ts").alias("export_time_utc")).agg(
            F.concat(F.lit("broken "), F.count("*").cast("string")).alias("error_message"))
    errors = errors.withColumn("source", F.lit("feed"))
    failed = ledger.failed(ledger.best_checkpoints(checkpoint_rows(spark, sf)), errors)
    return failed.select("id", "export_time_utc", "status", "completed_at", "last_error")


# ---------------------------------------------------------------- runs

_PATCHED = ["finished_at", "status", "exports_seen", "exports_completed", "events_inserted", "events_duplicated", "error_summary"]
_RUNS = f"""{RUNS_SQL}, cr AS (SELECT id, {", ".join(
    f"arg_max({c}, version) FILTER (WHERE {c} IS NOT NULL) AS {c}" for c in ["started_at", "trigger_mode", *_PATCHED])} FROM rl GROUP BY id)"""
_RUN_SELECT = ("SELECT id, started_at, finished_at, status, trigger_mode, CAST(exports_seen AS BIGINT) AS exports_seen, "
               "CAST(exports_completed AS BIGINT) AS exports_completed, events_inserted, events_duplicated, error_summary FROM cr")


@query("run_ledger_open", f"""SELECT DISTINCT 'run-' || user_id AS id, {NOW} AS started_at, 'started' AS status, 'manual' AS trigger_mode,
 CAST(0 AS BIGINT) AS exports_seen, CAST(0 AS BIGINT) AS events_inserted FROM events""")
def _open_run(spark, sf):
    ids = table(spark, sf, "events").select(F.concat(F.lit("run-"), F.col("user_id").cast("string")).alias("id")).distinct()
    return ledger.open_runs(ids, AS_OF).select("id", "started_at", "status", "trigger_mode", "exports_seen", "events_inserted")


@query("run_ledger_update", f"WITH {_RUNS} {_RUN_SELECT}")
def _runs(spark, sf):
    return ledger.current_runs(run_log(spark, sf)).select(*ledger.RUN_LOG_COLUMNS)


@query("recent_runs", f"WITH {_RUNS} {_RUN_SELECT} ORDER BY started_at DESC, id DESC LIMIT 10")
def _recent_runs(spark, sf):
    return ledger.recent_runs(ledger.current_runs(run_log(spark, sf)))


_SUCCESS = "FROM cr WHERE status = 'completed' AND finished_at IS NOT NULL ORDER BY finished_at DESC, id DESC LIMIT 1"


@query("latest_success", f"WITH {_RUNS} SELECT id, started_at, finished_at, events_inserted, events_duplicated {_SUCCESS}")
def _latest_success(spark, sf):
    return ledger.latest_success(ledger.current_runs(run_log(spark, sf)))


@query("runs_report", f"""WITH {_RUNS} SELECT id, status, trigger_mode, strftime(started_at, '%Y-%m-%d %H:%M UTC') AS started,
 coalesce(strftime(finished_at, '%Y-%m-%d %H:%M UTC'), 'Unknown') AS finished, concat_ws('/', exports_completed, exports_seen) AS exports,
 events_inserted AS inserted, events_duplicated AS duplicated, error_summary FROM cr ORDER BY started_at DESC, id DESC LIMIT 10""")
def _runs_report(spark, sf):
    return ledger.runs_report(ledger.current_runs(run_log(spark, sf)))


@query("readiness", f"""WITH {_RUNS}, s AS (SELECT id, finished_at {_SUCCESS}), a AS (SELECT *, CAST(floor(epoch({NOW}) - epoch(finished_at)) AS BIGINT) AS age FROM s)
SELECT age <= 172800 AS ready, CASE WHEN age <= 172800 THEN 'ok' ELSE 'stale_ingest' END AS reason, CAST(2880 AS BIGINT) AS max_age_minutes,
 finished_at AS latest_successful_finished_at, id AS latest_successful_run_id, age AS ingest_age_seconds FROM a""")
def _readiness(spark, sf):
    return ledger.readiness(ledger.current_runs(run_log(spark, sf)), AS_OF, max_age_minutes=2880)


# ---------------------------------------------------------------- rules and repairs

@query("check_constraints", f"""WITH {q.NORM_SQL}, c AS (SELECT primary_category AS p, secondary_category AS s, category_confidence AS f, lat, lon FROM norm)
SELECT 'primary_category' AS rule, CAST(count_if(p NOT IN ({q.quoted(fv.PRIMARY_CATEGORIES)})) AS BIGINT) AS violations FROM c
UNION ALL SELECT 'secondary_category', CAST(count_if(s NOT IN ({q.quoted(fv.SECONDARY_CATEGORIES)})) AS BIGINT) FROM c
UNION ALL SELECT 'confidence_range', CAST(count_if(f NOT BETWEEN 0 AND 1) AS BIGINT) FROM c
UNION ALL SELECT 'latitude_range', CAST(count_if(lat NOT BETWEEN -90 AND 90) AS BIGINT) FROM c
UNION ALL SELECT 'longitude_range', CAST(count_if(lon NOT BETWEEN -180 AND 180) AS BIGINT) FROM c""")
def _constraints(spark, sf):
    """Events before validation, which break the geographic rules."""
    rows = normalized_events(spark, sf).withColumnsRenamed({"action_geo_lat": "latitude", "action_geo_long": "longitude"})
    return constraints.check_constraints(rows)


@query("check_keys", f"WITH {q.NORM_SQL} SELECT source, dedupe_key, count(*) AS copies FROM norm GROUP BY ALL HAVING count(*) > 1")
def _check_keys(spark, sf):
    return constraints.duplicate_keys(normalized_events(spark, sf), dedupe.EVENT_KEY)


@query("check_references", f"""SELECT count(*) AS orphans FROM events WHERE user_id NOT IN
 (SELECT c_custkey FROM customer WHERE c_mktsegment <> 'BUILDING')""")
def _references(spark, sf):
    parents = table(spark, sf, "customer").filter("c_mktsegment <> 'BUILDING'")
    return constraints.check_references(table(spark, sf, "events"), parents, [("user_id", "c_custkey")])


@query("cascade_delete", """SELECT event_id, user_id FROM events WHERE user_id NOT IN
 (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')""")
def _cascade(spark, sf):
    gone = table(spark, sf, "customer").filter("c_mktsegment = 'BUILDING'")
    return constraints.cascade_delete(table(spark, sf, "events"), gone, ("user_id", "c_custkey")).select("event_id", "user_id")


_KEPT = """kept AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY source, dedupe_key ORDER BY export_time_utc, event_id) AS rn
 FROM norm) WHERE rn = 1)"""


@query("dedupe_raw_keep_first", f"WITH {q.NORM_SQL}, {_KEPT} SELECT event_id, dedupe_key FROM kept")
def _keep_first(spark, sf):
    rows = constraints.keep_first_raw(normalized_events(spark, sf), ["export_time_utc", "event_id"])
    return rows.select("event_id", "dedupe_key")


@query("delete_using_join", f"WITH {q.NORM_SQL}, {_KEPT} SELECT event_id, primary_category FROM norm WHERE event_id IN (SELECT event_id FROM kept)")
def _delete_using(spark, sf):
    rows = normalized_events(spark, sf)
    repaired = constraints.collapse_duplicates(
        checkpoint_rows(spark, sf), rows, rows, ["export_time_utc", "event_id"], ["event_id"])
    return repaired["normalized_events"].select("event_id", "primary_category")


@query("collapse_duplicates", f"""WITH {q.NORM_SQL}, {_KEPT}, {CHECKPOINTS_SQL}, {_BEST}
SELECT 'checkpoints' AS table_name, count(*) AS rows_kept FROM best UNION ALL SELECT 'raw_events', count(*) FROM kept
UNION ALL SELECT 'normalized_events', count(*) FROM kept""")
def _collapse(spark, sf):
    rows = normalized_events(spark, sf)
    repaired = constraints.collapse_duplicates(
        checkpoint_rows(spark, sf), rows, rows, ["export_time_utc", "event_id"], ["event_id"])
    counts = [df.agg(F.lit(name).alias("table_name"), F.count("*").alias("rows_kept")) for name, df in repaired.items()]
    return counts[0].unionByName(counts[1]).unionByName(counts[2])
