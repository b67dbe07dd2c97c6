"""Expressions over whole tables: cleaning, parsing, lookups, classification and validation."""

from __future__ import annotations

from pyspark.sql import functions as F

from contract import sql_text as q
from contract.adapters import AS_OF, RAW_SQL, normalized_like, normalized_sql, raw_like, table
from contract.registry import query, value_query
from tidewatch import fixed_values as fv
from tidewatch.functions import flags, lookup, numeric, text, times
from tidewatch.operators import classify, normalize, validate
from tidewatch.plans import monitor
from tidewatch.schemas import LAT_LONG


def on_raw(key: str, columns: dict, sql_columns: dict, extra_with: str = "") -> None:
    value_query(key, raw_like, columns, RAW_SQL + extra_with, "raw", sql_columns)


ACTOR1, ACTOR2, CODE, CC = '"Actor1Name"', '"Actor2Name"', '"EventCode"', '"ActionGeo_CountryCode"'
LAT, LON, TONE = '"ActionGeo_Lat"', '"ActionGeo_Long"', '"AvgTone"'

# ---------------------------------------------------------------- text

on_raw("clean_text",
       {"a1": lambda: text.clean_text("Actor1Name"), "a2": lambda: text.clean_text("Actor2Name")},
       {"a1": q.clean(ACTOR1), "a2": q.clean(ACTOR2)})
on_raw("normalize_text",
       {"a1": lambda: text.normalize_text("Actor1Name"), "place": lambda: text.normalize_text("ActionGeo_FullName")},
       {"a1": q.folded(ACTOR1), "place": q.folded('"ActionGeo_FullName"')})
on_raw("clean_actor",
       {"a1": lambda: text.clean_actor("Actor1Name"), "a2": lambda: text.clean_actor("Actor2Name")},
       {"a1": q.actor(ACTOR1), "a2": q.actor(ACTOR2)})
on_raw("normalize_country_code",
       {"code": lambda: text.normalize_country_code("ActionGeo_CountryCode"),
        "table_code": lambda: text.canonical_code("ActionGeo_CountryCode")},
       {"code": q.country_code(CC), "table_code": q.country_code(CC)})
on_raw("validate_event_code",
       {"code": lambda: text.valid_event_code("EventCode"), "bad": lambda: text.is_bad_event_code("EventCode")},
       {"code": q.event_code(CODE), "bad": f"({q.event_code(CODE)}) IS NULL"})
on_raw("text_blob",
       {"blob": lambda: text.text_blob("Actor1Name", "Actor2Name", "ActionGeo_FullName", "SOURCEURL")},
       {"blob": q.BLOB})
on_raw("strip_upper_len",
       {"upper_code": lambda: text.trimmed_upper("ActionGeo_CountryCode"),
        "code_length": lambda: F.length("ActionGeo_CountryCode")},
       {"upper_code": f"upper(trim({CC}))", "code_length": f"length({CC})"})
on_raw("nullif_blank_default",
       {"actor": lambda: text.blank_to_default("Actor1Name"), "blank": lambda: text.is_blank("Actor2Name")},
       {"actor": f"coalesce({q.clean(ACTOR1)}, 'Unknown')", "blank": f"coalesce(trim({ACTOR2}), '') = ''"})
on_raw("code_prefix",
       {"root": lambda: text.code_root("EventCode"), "breaking": lambda: text.code_root("EventCode").isin(fv.BREAKING_ROOTS)},
       {"root": f"left({CODE}, 2)", "breaking": f"left({CODE}, 2) IN ('17', '18', '19', '20')"})
on_raw("dedupe_key", {"dedupe_key": text.dedupe_key}, {"dedupe_key": q.DEDUPE_KEY})
on_raw("format_event_line",
       {"line": monitor.event_line},
       {"line": f"""CASE WHEN {ACTOR1} = '' THEN 'Unknown' ELSE {ACTOR1} END || ' -> ' ||
        CASE WHEN {ACTOR2} = '' THEN 'Unknown' ELSE {ACTOR2} END || ' | ' || {q.label(f"coalesce(nullif({CODE}, ''), 'Unknown')")}
        || ' (' || coalesce(nullif({CODE}, ''), 'Unknown') || ') | ' || "ActionGeo_FullName" || ' | ' ||
        coalesce(nullif({CC}, ''), 'Unknown') || ' | ' ||
        CASE WHEN TRY_CAST({LAT} AS DOUBLE) IS NOT NULL AND TRY_CAST({LON} AS DOUBLE) IS NOT NULL
             THEN printf('%.2f, %.2f', CAST({LAT} AS DOUBLE), CAST({LON} AS DOUBLE)) ELSE 'Unknown, Unknown' END"""},
       ",\n" + q.LABELS_SQL)
on_raw("format_country_display",
       {"shown": lambda: text.country_display("Actor2Name", "ActionGeo_CountryCode")},
       {"shown": f"CASE WHEN coalesce({q.clean(CC)}, '') = '' OR {q.clean(ACTOR2)} IS NULL "
                 f"THEN coalesce({q.clean(ACTOR2)}, 'Unknown') ELSE {q.clean(ACTOR2)} || ' (' || trim({CC}) || ')' END"})
on_raw("first_not_none",
       {"first_code": lambda: numeric.first_not_null(
           text.normalize_country_code("ActionGeo_CountryCode"), text.valid_event_code("EventCode"), "SQLDATE")},
       {"first_code": f"coalesce({q.country_code(CC)}, {q.event_code(CODE)}, \"SQLDATE\")"})
on_raw("regex_in_predicates",
       {"letters": lambda: text.trimmed_upper("ActionGeo_CountryCode").rlike(r"^[A-Z]{2,3}\z"),
        "not_letters": lambda: ~text.trimmed_upper("ActionGeo_CountryCode").rlike(r"^[A-Z]{2,3}\z"),
        "placeholder": lambda: text.trimmed_upper("ActionGeo_CountryCode").isin(fv.UNKNOWN_CODE_TEXTS),
        "missing": lambda: text.clean_actor("Actor1Name").isNull()},
       {"letters": f"regexp_matches(upper(trim({CC})), '^[A-Z]{{2,3}}$')",
        "not_letters": f"NOT regexp_matches(upper(trim({CC})), '^[A-Z]{{2,3}}$')",
        "placeholder": f"upper(trim({CC})) IN ({q.quoted(fv.UNKNOWN_CODE_TEXTS)})",
        "missing": f"({q.actor(ACTOR1)}) IS NULL"})
on_raw("is_distinct_from",
       {"differs": lambda: ~text.clean_actor("Actor1Name").eqNullSafe(text.clean_actor("Actor2Name")),
        "code_differs": lambda: ~F.col("ActionGeo_CountryCode").eqNullSafe(text.canonical_code("ActionGeo_CountryCode"))},
       {"differs": f"({q.actor(ACTOR1)}) IS DISTINCT FROM ({q.actor(ACTOR2)})",
        "code_differs": f"{CC} IS DISTINCT FROM ({q.country_code(CC)})"})

# ---------------------------------------------------------------- numbers

on_raw("parse_decimal",
       {"lat": lambda: numeric.parse_decimal("ActionGeo_Lat"), "tone": lambda: numeric.parse_decimal("AvgTone"),
        "lat_stored": lambda: numeric.parse_decimal("ActionGeo_Lat").cast(LAT_LONG)},
       {"lat": f"CAST({q.decimal(LAT)} AS DOUBLE)", "tone": f"CAST({q.decimal(TONE)} AS DOUBLE)",
        "lat_stored": f"CAST(CAST({q.decimal(LAT)} AS DECIMAL(9,6)) AS DOUBLE)"})
on_raw("parse_int",
       {"id": lambda: numeric.parse_int("GLOBALEVENTID"), "code": lambda: numeric.parse_int("EventCode")},
       {"id": q.GID, "code": q.integer(CODE)})
on_raw("parse_float_default",
       {"tone": lambda: numeric.parse_float_or_zero("AvgTone"), "lat": lambda: numeric.parse_float_or_zero("ActionGeo_Lat")},
       {"tone": f"coalesce(TRY_CAST({TONE} AS DOUBLE), 0.0)", "lat": f"coalesce(TRY_CAST({LAT} AS DOUBLE), 0.0)"})
on_raw("clamp_tone",
       {"tone": lambda: numeric.clamp_tone(numeric.parse_decimal("AvgTone")),
        "flag": lambda: numeric.tone_flag(numeric.parse_decimal("AvgTone"))},
       {"tone": f"CASE WHEN ({q.decimal(TONE)}) IS NOT NULL "
                f"THEN CAST(greatest(least(({q.decimal(TONE)}), 20), -20) AS DOUBLE) END",
        "flag": f"CASE WHEN ({q.decimal(TONE)}) IS NULL THEN 'missing_tone' WHEN ({q.decimal(TONE)}) < -20 "
                f"THEN 'tone_clamped_low' WHEN ({q.decimal(TONE)}) > 20 THEN 'tone_clamped_high' END"})
_LATD, _LOND = q.decimal(LAT), q.decimal(LON)


def _pair(i: int):
    return lambda: numeric.geo_pair(numeric.parse_decimal("ActionGeo_Lat"), numeric.parse_decimal("ActionGeo_Long"))[i]


on_raw("geo_pair_check",
       {"lat": _pair(0), "lon": _pair(1),
        "partial": lambda: numeric.is_partial_geo(
            numeric.parse_decimal("ActionGeo_Lat"), numeric.parse_decimal("ActionGeo_Long")),
        "out_of_range": lambda: numeric.is_geo_out_of_range(
            numeric.parse_decimal("ActionGeo_Lat"), numeric.parse_decimal("ActionGeo_Long"))},
       {"lat": f"CASE WHEN ({_LATD}) BETWEEN -90 AND 90 AND ({_LOND}) BETWEEN -180 AND 180 THEN CAST(({_LATD}) AS DOUBLE) END",
        "lon": f"CASE WHEN ({_LATD}) BETWEEN -90 AND 90 AND ({_LOND}) BETWEEN -180 AND 180 THEN CAST(({_LOND}) AS DOUBLE) END",
        "partial": f"(({_LATD}) IS NULL) <> (({_LOND}) IS NULL)",
        "out_of_range": f"coalesce(({_LATD}) NOT BETWEEN -90 AND 90 OR ({_LOND}) NOT BETWEEN -180 AND 180, false) "
                        f"AND ({_LATD}) IS NOT NULL AND ({_LOND}) IS NOT NULL"})
_NE = normalized_sql()
value_query("safe_divide", normalized_like,
            {"ratio": lambda: numeric.round_half_up(
                numeric.safe_divide("goldstein_score", F.col("event_code").cast("int")), 4)},
            _NE, "ne",
            {"ratio": "CAST(round(CAST(CAST(goldstein_score AS DOUBLE) / nullif(CAST(event_code AS INTEGER), 0) "
                      "AS DECIMAL(38,9)), 4) AS DOUBLE)"})
value_query("round_half_up", normalized_like,
            {"two": lambda: numeric.round_half_up("goldstein_score", 2),
             "one": lambda: numeric.round_half_up("goldstein_score", 1)},
            _NE, "ne",
            {"two": "CAST(round(CAST(goldstein_score AS DECIMAL(38,9)), 2) AS DOUBLE)",
             "one": "CAST(round(CAST(goldstein_score AS DECIMAL(38,9)), 1) AS DOUBLE)"})
value_query("format_percent", normalized_like,
            {"share": lambda: numeric.percent_text(F.col("event_id") % 7, F.col("event_id") % 12)},
            _NE, "ne",
            {"share": "CASE WHEN event_id % 12 <= 0 THEN '0.00%' "
                      "ELSE printf('%.2f%%', (event_id % 7) / CAST(event_id % 12 AS DOUBLE) * 100) END"})
on_raw("derive_location_point",
       {"wkt": lambda: numeric.location_wkt(_pair(0)().cast(LAT_LONG), _pair(1)().cast(LAT_LONG))},
       {"wkt": f"CASE WHEN ({_LATD}) BETWEEN -90 AND 90 AND ({_LOND}) BETWEEN -180 AND 180 THEN 'POINT(' || "
               f"CAST(({_LOND}) AS DECIMAL(9,6)) || ' ' || CAST(({_LATD}) AS DECIMAL(9,6)) || ')' END"})

# ---------------------------------------------------------------- times

on_raw("parse_sql_date", {"day": lambda: times.parse_sql_date("SQLDATE")}, {"day": q.day('"SQLDATE"')})
on_raw("parse_date_added", {"added": lambda: times.parse_date_added("DATEADDED")}, {"added": q.second('"DATEADDED"')})
on_raw("resolve_event_time",
       {"event_time": lambda: times.event_time("DATEADDED", "SQLDATE", "export_time_utc")},
       {"event_time": f"coalesce({q.second(chr(34) + 'DATEADDED' + chr(34))}, "
                      f"CAST({q.day(chr(34) + 'SQLDATE' + chr(34))} AS TIMESTAMP), export_time_utc)"})
_GIVEN = "CASE event_id % 4 WHEN 0 THEN {plain} WHEN 1 THEN {plain} || '+02:00' WHEN 2 THEN 'no time' END"


@query("assume_utc", f"""WITH {RAW_SQL} SELECT event_id, event_id % 4 = 2 AS fallback, CASE event_id % 4
 WHEN 0 THEN date_trunc('second', ts) WHEN 1 THEN date_trunc('second', ts) - INTERVAL 2 HOUR ELSE export_time_utc END AS event_time
FROM raw JOIN (SELECT event_id, ts FROM events) USING (event_id)""")
def _assume_utc(spark, sf):
    """Texts without a zone, with one, that are no time, and none at all."""
    times_given = table(spark, sf, "events").select("event_id", F.expr(_GIVEN.format(plain="date_format(ts, 'yyyy-MM-dd HH:mm:ss')")).alias("event_time_utc"))
    rows = raw_like(spark, sf).select("event_id", "export_time_utc").join(times_given, "event_id")
    return validate.assume_utc(rows, "fallback").select("event_id", "fallback", F.col("event_time_utc").cast("timestamp_ntz").alias("event_time"))


value_query("time_bucket", normalized_like,
            {"hour": lambda: times.time_bucket("event_time_utc", "hour"),
             "day": lambda: times.time_bucket("event_time_utc", "day")},
            _NE, "ne", {"hour": "date_trunc('hour', event_time_utc)",
                        "day": "CAST(date_trunc('day', event_time_utc) AS TIMESTAMP)"})
value_query("age_seconds", normalized_like,
            {"age": lambda: times.age_seconds("event_time_utc", "2024-01-15 12:00:00")},
            _NE, "ne",
            {"age": "greatest(CAST(floor((epoch_us(TIMESTAMP '2024-01-15 12:00:00') - epoch_us(event_time_utc)) "
                    "/ 1000000) AS BIGINT), 0)"})
value_query("format_utc", normalized_like,
            {"shown": lambda: times.format_utc(F.when(F.col("event_id") % 9 > 0, F.col("event_time_utc")))},
            _NE, "ne", {"shown": "CASE WHEN event_id % 9 > 0 THEN strftime(event_time_utc, '%Y-%m-%d %H:%M UTC') "
                                 "ELSE 'Unknown' END"})


@query("lookback", f"WITH {_NE} SELECT event_id FROM ne WHERE event_time_utc >= TIMESTAMP '{AS_OF}' - INTERVAL 36 HOUR")
def _lookback(spark, sf):
    events = normalized_like(spark, sf)
    return events.filter(times.since(events, "event_time_utc", AS_OF, hours=36)).select("event_id")


# ---------------------------------------------------------------- lookups

@query("map_country", f"WITH {RAW_SQL}, {q.COUNTRIES_SQL} SELECT event_id, {q.country_name(CC)} AS country_name FROM raw")
def _map_country(spark, sf):
    return lookup.with_country_name(raw_like(spark, sf), "ActionGeo_CountryCode").select("event_id", "country_name")


on_raw("map_event_label", {"label": lambda: lookup.event_label("EventCode")}, {"label": q.label(CODE)}, ",\n" + q.LABELS_SQL)
on_raw("translation_tier", {"tier": lambda: lookup.translation_tier("EventCode")}, {"tier": q.tier(CODE)})
on_raw("category_display",
       {"shown": lambda: text.category_display(F.coalesce(lookup.root_category("EventCode"), F.lit("politics")),
                                               text.clean_actor("Actor2Name"))},
       {"shown": f"(CASE left({CODE}, 2) " + " ".join(f"WHEN '{r}' THEN '{c}'" for r, c in fv.ROOT_CATEGORY.items())
                 + f" ELSE 'politics' END) || CASE WHEN ({q.actor(ACTOR2)}) IS NULL THEN '' ELSE ':' || ({q.actor(ACTOR2)}) END"})


@query("lookup_dimension", f"""WITH {RAW_SQL}, {q.COUNTRIES_SQL}, {q.LABELS_SQL}
SELECT event_id, {q.country_name(CC)} AS country_name, {q.label(CODE)} AS label,
       (CASE left({CODE}, 2) {" ".join(f"WHEN '{r}' THEN '{c}'" for r, c in fv.ROOT_CATEGORY.items())} END) AS category
FROM raw""")
def _lookup_dimension(spark, sf):
    rows = lookup.with_country_name(raw_like(spark, sf), "ActionGeo_CountryCode")
    return rows.select("event_id", "country_name", lookup.event_label("EventCode").alias("label"),
                       lookup.root_category("EventCode").alias("category"))


# ---------------------------------------------------------------- classification

def _blobs(spark, sf):
    blob = text.text_blob("Actor1Name", "Actor2Name", "ActionGeo_FullName", "SOURCEURL")
    return raw_like(spark, sf).withColumn("blob", blob).withColumn("keyword", classify.keyword_reason("blob"))


def _category_query(key: str, reason: str, struct) -> None:
    sql = f"""WITH {q.BLOB_SQL}, r AS (SELECT event_id, {reason} AS category_reason FROM blobs)
    SELECT event_id, {q.primary_of('category_reason')} AS primary_category,
           {q.secondary_of('category_reason')} AS secondary_category,
           CAST({q.confidence_of('category_reason')} AS DOUBLE) AS category_confidence, category_reason FROM r"""

    @query(key, sql)
    def run(spark, sf):
        return _blobs(spark, sf).withColumn("c", struct()).select("event_id", "c.*")


value_query("keyword_match", _blobs,
            {"cyber": lambda: text.first_keyword("blob", fv.CYBER_KEYWORDS)}, q.BLOB_SQL, "blobs",
            {"cyber": "CASE " + " ".join(f"WHEN contains(blob, '{w}') THEN '{w}'" for w in fv.CYBER_KEYWORDS) + " END"})
_category_query("detect_cyber", q.CYBER_REASON, lambda: classify.detect_cyber("EventCode", "blob"))
_category_query("detect_crisis", q.CRISIS_REASON, lambda: classify.detect_crisis("EventCode", "blob"))
_category_query("root_category", q.ROOT_REASON, lambda: classify.detect_root("EventCode"))
_category_query("categorize_event",
                f"coalesce({q.CYBER_REASON}, {q.CRISIS_REASON}, {q.ROOT_REASON}, '{fv.FALLBACK_REASON}')",
                lambda: classify.category("EventCode", "keyword"))

_NORM_COLUMNS = ["event_id", "source", "export_time_utc", "export_url", "ingestion_run_id", "dedupe_key", "global_event_id",
                 "sql_date", "event_time_utc", "actor1_name", "actor2_name", "event_code", "action_geo_full_name",
                 "action_geo_country_code", "country_name", "source_url", "primary_category", "secondary_category",
                 "category_reason"]


@query("normalize_event", f"""WITH {q.NORM_SQL} SELECT {", ".join(_NORM_COLUMNS)},
CAST(category_confidence AS DOUBLE) AS category_confidence, CAST(lat AS DOUBLE) AS action_geo_lat,
CAST(lon AS DOUBLE) AS action_geo_long, CAST(tone AS DOUBLE) AS avg_tone, CAST(goldstein AS DOUBLE) AS goldstein_score
FROM norm""")
def _normalize_event(spark, sf):
    events = normalize.normalize_events(raw_like(spark, sf))
    return events.select(*_NORM_COLUMNS, "category_confidence", "action_geo_lat", "action_geo_long", "avg_tone",
                         "goldstein_score")


def normalized_events(spark, sf):
    return normalize.normalize_events(raw_like(spark, sf))


def validated_events(spark, sf):
    return validate.validate_and_clean(normalize.normalize_events(raw_like(spark, sf), country_names=False), AS_OF)


# ---------------------------------------------------------------- validation

VALID_COLUMNS = ["event_id", "dedupe_key", "event_time_utc", "actor1_name", "actor2_name", "event_code",
                 "action_geo_country_code", "country_name", "primary_category", "quality_flags"]
VALID_DECIMALS = ["action_geo_lat", "action_geo_long", "avg_tone", "goldstein_score"]
_DOUBLES = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in VALID_DECIMALS)


@query("validate_and_clean", f'WITH {q.VALID_SQL} SELECT {", ".join(VALID_COLUMNS)}, {_DOUBLES}, "drop" FROM valid')
def _validate(spark, sf):
    return validated_events(spark, sf).select(*VALID_COLUMNS, *VALID_DECIMALS, "drop")


_DROP_SQL = f"""WITH {q.VALID_SQL}
SELECT ingestion_run_id, source, export_time_utc, export_url, dedupe_key, 'validation_drop' AS drop_reason,
       replace(quality_flags, ',', ', ') AS error_detail, quality_flags FROM valid WHERE "drop" """


@query("quarantine_split", _DROP_SQL)
def _quarantine(spark, sf):
    return validate.validation_drops(validated_events(spark, sf)).drop("raw_payload")


@query("union_dropped", f"""{_DROP_SQL} UNION ALL
SELECT ingestion_run_id, '{fv.SOURCE}', export_time_utc, export_url, NULL, 'parse_error',
       'reason=parse_error row_number=' || row_number || ' row_length=3', 'parse_error' FROM raw WHERE trim("Actor1Name") = ''""")
def _union_dropped(spark, sf):
    short = raw_like(spark, sf).filter(text.is_blank("Actor1Name"))
    malformed = short.withColumn("cols", F.array("GLOBALEVENTID", "SQLDATE", "Actor1Name"))
    return validate.quarantine(validated_events(spark, sf), malformed).drop("raw_payload")


@query("future_outlier_guard", f'WITH {q.VALID_SQL} SELECT event_id, event_time_utc FROM valid WHERE NOT "drop"')
def _guard(spark, sf):
    from tidewatch.streaming.hourly import guard_future

    return guard_future(normalized_events(spark, sf), AS_OF).select("event_id", "event_time_utc")


@query("collect_flags", f"WITH {q.VALID_SQL} SELECT event_id, quality_flags FROM valid")
def _collect_flags(spark, sf):
    return validated_events(spark, sf).select("event_id", "quality_flags")


@query("flags_to_text", f"""WITH {q.VALID_SQL}
SELECT event_id, coalesce(nullif(replace(quality_flags, ',', ', '), ''), 'validation_drop') AS detail FROM valid""")
def _flags_to_text(spark, sf):
    return validated_events(spark, sf).select("event_id", flags.flags_to_text("quality_flags").alias("detail"))


def _payloads(spark, sf):
    return raw_like(spark, sf).withColumn("payload", flags.payload_json(F.struct(*fv.FIELD_POSITIONS)))


value_query("payload_json", _payloads, {"payload": lambda: F.col("payload")}, RAW_SQL, "raw",
            {"payload": "'{' || " + " || ',' || ".join(
                f"'\"{n}\":' || CAST(to_json(\"{n}\") AS VARCHAR)" for n in fv.FIELD_POSITIONS) + " || '}'"})
value_query("payload_field", _payloads, {"code": lambda: flags.payload_field("payload", "ActionGeo_CountryCode")},
            RAW_SQL, "raw", {"code": CC})


@query("quality_predicates", f"""WITH {q.VALID_SQL}
SELECT event_id, coalesce(actor1_name, '') = '' AND coalesce(actor2_name, '') = '' AS missing_actor,
  coalesce(action_geo_country_code, '') = '' AND action_geo_lat IS NULL AND action_geo_long IS NULL AS missing_geo,
  coalesce(action_geo_country_code, '') = '' OR country_name = 'Unknown' AS unknown_country,
  country_name = 'Unknown' AS unknown_country_table,
  action_geo_country_code IS NULL AND action_geo_lat IS NULL AND action_geo_long IS NULL AS missing_geo_table
FROM valid""")
def _predicates(spark, sf):
    geo = ("action_geo_country_code", "action_geo_lat", "action_geo_long")
    return validated_events(spark, sf).select(
        "event_id",
        flags.missing_actor_at_load("actor1_name", "actor2_name").alias("missing_actor"),
        flags.missing_geo_at_load(*geo).alias("missing_geo"),
        flags.unknown_country_at_load("action_geo_country_code", "country_name").alias("unknown_country"),
        flags.unknown_country_in_table("country_name").alias("unknown_country_table"),
        flags.missing_geo_in_table(*geo).alias("missing_geo_table"),
    )
