"""SQL forms of cleaning, classification and validation for the oracle, over the ``raw`` adapter view."""

from __future__ import annotations

from contract.adapters import AS_OF, RAW_SQL
from tidewatch import fixed_values as fv
from tidewatch.functions.lookup import country_codes


def quoted(values) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


def clean(x: str) -> str:
    return f"nullif(trim({x}), '')"


def folded(x: str) -> str:
    return f"coalesce(lower(regexp_replace({clean(x)}, '\\s+', ' ', 'g')), '')"


def integer(x: str) -> str:
    return f"CASE WHEN regexp_matches(trim({x}), '^[+-]?\\d+$') THEN TRY_CAST(trim({x}) AS BIGINT) END"


def decimal(x: str) -> str:
    return (f"CASE WHEN regexp_matches(trim({x}), '^[+-]?\\d+(\\.\\d+)?$') "
            f"THEN TRY_CAST(trim({x}) AS DECIMAL(38,18)) END")


def day(x: str) -> str:
    return f"CASE WHEN regexp_matches(trim({x}), '^\\d{{8}}$') THEN CAST(try_strptime(trim({x}), '%Y%m%d') AS DATE) END"


def second(x: str) -> str:
    return f"CASE WHEN regexp_matches(trim({x}), '^\\d{{14}}$') THEN try_strptime(trim({x}), '%Y%m%d%H%M%S') END"


def country_code(x: str) -> str:
    return (f"CASE WHEN upper(trim({x})) NOT IN ({quoted(fv.UNKNOWN_CODE_TEXTS)}) "
            f"AND regexp_matches(upper(trim({x})), '^[A-Z]{{2,3}}$') THEN upper(trim({x})) END")


def actor(x: str) -> str:
    return f"CASE WHEN lower({clean(x)}) NOT IN ({quoted(fv.UNKNOWN_ACTOR_TEXTS)}) THEN {clean(x)} END"


def event_code(x: str) -> str:
    c = f"trim(coalesce({x}, ''))"
    return f"CASE WHEN {c} = '' OR regexp_matches({c}, '^\\d{{2,3}}$') THEN {c} END"


def table_of(name: str, columns: str, entries: dict[str, str]) -> str:
    rows = ", ".join(f"({quoted([k])}, {quoted([v])})" for k, v in entries.items())
    return f"{name}({columns}) AS (VALUES {rows})"


COUNTRIES_SQL = table_of("countries", "code, known_name", country_codes())
LABELS_SQL = table_of("labels_exact", "code, label", fv.EVENT_LABELS) + ", " + table_of(
    "labels_root", "root, label", fv.ROOT_LABELS)


def label(x: str) -> str:
    return (f"coalesce((SELECT label FROM labels_exact WHERE code = coalesce({x}, '')), "
            f"(SELECT label FROM labels_root WHERE root = left(coalesce({x}, ''), 2)), '{fv.UNKNOWN_EVENT_LABEL}')")


def tier(x: str) -> str:
    return (f"CASE WHEN trim({x}) IN ({quoted(fv.EVENT_LABELS)}) THEN 'exact' "
            f"WHEN left(trim({x}), 2) IN ({quoted(fv.ROOT_LABELS)}) THEN 'root' ELSE 'unknown' END")


def country_name(x: str) -> str:
    return f"coalesce((SELECT known_name FROM countries WHERE code = upper(trim({x}))), 'Unknown')"


COMPOSITE = " || '|' || ".join(folded(f'"{name}"') for name in fv.COMPOSITE_KEY_FIELDS)
GID = integer('"GLOBALEVENTID"')
DEDUPE_KEY = (f"CASE WHEN ({GID}) IS NOT NULL THEN '{fv.ID_KEY_PREFIX}' || ({GID}) "
              f"ELSE '{fv.COMPOSITE_KEY_PREFIX}' || sha256({COMPOSITE}) END")
BLOB = ("regexp_replace(lower(" + " || ' ' || ".join(
    f"coalesce(trim(\"{n}\"), '')" for n in ("Actor1Name", "Actor2Name", "ActionGeo_FullName", "SOURCEURL"))
    + "), '[^a-z0-9]+', ' ', 'g')")


def _keyword_case(prefix: str, words) -> str:
    return " ".join(f"WHEN contains(blob, '{w}') THEN '{prefix}{w}'" for w in words)


CYBER_REASON = (
    f"CASE WHEN code IN ({quoted(fv.CYBER_STRONG_CODES)}) THEN 'cyber_strong_event_code:' || code "
    + _keyword_case("cyber_keyword:", fv.CYBER_KEYWORDS)
    + f" WHEN code IN ({quoted(fv.CYBER_MEDIUM_CODES)}) THEN 'cyber_medium_event_code:' || code END")
CRISIS_REASON = (
    "CASE " + " ".join(_keyword_case(f"crisis_keyword:{kind}:", words) for kind, words in fv.CRISIS_KEYWORDS.items())
    + f" WHEN code IN ({quoted(fv.WEAK_HUMANITARIAN_CODES)}) THEN 'crisis_weak_humanitarian_code:' || code END")
ROOT_REASON = f"CASE WHEN left(code, 2) IN ({quoted(fv.ROOT_CATEGORY)}) THEN 'root_event_code:' || left(code, 2) END"
_ROOTS_OF = {c: [r for r, cat in fv.ROOT_CATEGORY.items() if cat == c] for c in dict.fromkeys(fv.ROOT_CATEGORY.values())}


def primary_of(reason: str) -> str:
    roots = " ".join(f"WHEN {reason} IN ({quoted('root_event_code:' + r for r in rs)}) THEN '{c}'"
                     for c, rs in _ROOTS_OF.items())
    return (f"CASE WHEN starts_with({reason}, 'cyber') THEN 'cyber' WHEN starts_with({reason}, 'crisis') THEN 'crisis' "
            f"{roots} WHEN {reason} IS NOT NULL THEN 'politics' END")


def secondary_of(reason: str) -> str:
    return (f"CASE WHEN starts_with({reason}, 'crisis_keyword') THEN split_part({reason}, ':', 2) "
            f"WHEN starts_with({reason}, 'crisis_weak') THEN 'humanitarian' END")


def confidence_of(reason: str) -> str:
    return (f"CASE WHEN starts_with({reason}, 'cyber_strong') THEN 0.95 WHEN starts_with({reason}, 'cyber_keyword') THEN 0.9 "
            f"WHEN starts_with({reason}, 'cyber_medium') THEN 0.72 "
            f"WHEN split_part({reason}, ':', 2) IN ('epidemic', 'natural_disaster') THEN 0.92 "
            f"WHEN starts_with({reason}, 'crisis_keyword') THEN 0.88 WHEN starts_with({reason}, 'crisis_weak') THEN 0.56 "
            f"WHEN starts_with({reason}, 'root') THEN 0.82 WHEN {reason} IS NOT NULL THEN 0.35 END")


BLOB_SQL = f"""{RAW_SQL},
blobs AS (SELECT *, coalesce(trim("EventCode"), '') AS code, {BLOB} AS blob FROM raw)"""

NORM_SQL = f"""{BLOB_SQL},
{COUNTRIES_SQL},
reasons AS (
  SELECT *, coalesce({CYBER_REASON}, {CRISIS_REASON}, {ROOT_REASON}, '{fv.FALLBACK_REASON}') AS category_reason FROM blobs
),
norm AS (
  SELECT event_id, '{fv.SOURCE}' AS source, export_time_utc, export_url, ingestion_run_id, row_number,
    {DEDUPE_KEY} AS dedupe_key,
    {GID} AS global_event_id,
    {day('"SQLDATE"')} AS sql_date,
    coalesce({second('"DATEADDED"')}, CAST({day('"SQLDATE"')} AS TIMESTAMP), export_time_utc) AS event_time_utc,
    {clean('"Actor1Name"')} AS actor1_name, {clean('"Actor2Name"')} AS actor2_name, {clean('"EventCode"')} AS event_code,
    {clean('"ActionGeo_FullName"')} AS action_geo_full_name,
    {clean('"ActionGeo_CountryCode"')} AS action_geo_country_code,
    {decimal('"ActionGeo_Lat"')} AS lat, {decimal('"ActionGeo_Long"')} AS lon, {decimal('"AvgTone"')} AS tone,
    {decimal('"GoldsteinScale"')} AS goldstein, {clean('"SOURCEURL"')} AS source_url,
    {primary_of('category_reason')} AS primary_category, {secondary_of('category_reason')} AS secondary_category,
    {confidence_of('category_reason')} AS category_confidence, category_reason,
    {country_name('"ActionGeo_CountryCode"')} AS country_name
  FROM reasons
)"""

_FLAGS = {
    "time_future_outlier": "future",
    "bad_event_code": "code_ok IS NULL",
    "bad_country_code": "country IS NULL AND action_geo_country_code IS NOT NULL",
    "partial_geo": "(lat IS NULL) <> (lon IS NULL)",
    "invalid_geo_range": "lat IS NOT NULL AND lon IS NOT NULL AND (lat NOT BETWEEN -90 AND 90 OR lon NOT BETWEEN -180 AND 180)",
    "missing_tone": "tone IS NULL",
    "tone_clamped_low": "tone < -20",
    "tone_clamped_high": "tone > 20",
}
FLAG_TEXT = "concat_ws(',', " + ", ".join(f"CASE WHEN {c} THEN '{f}' END" for f, c in _FLAGS.items()) + ")"
_GEO_OK = "lat BETWEEN -90 AND 90 AND lon BETWEEN -180 AND 180"

VALID_SQL = f"""{NORM_SQL},
checked AS (
  SELECT *, event_time_utc > TIMESTAMP '{AS_OF}' + INTERVAL 24 HOUR AS future, {event_code('event_code')} AS code_ok,
         {country_code('action_geo_country_code')} AS country
  FROM norm
),
valid AS (
  SELECT event_id, source, export_time_utc, export_url, ingestion_run_id, row_number, dedupe_key, global_event_id, sql_date,
    event_time_utc, {actor('actor1_name')} AS actor1_name, {actor('actor2_name')} AS actor2_name, code_ok AS event_code,
    action_geo_full_name, country AS action_geo_country_code, {country_name('country')} AS country_name,
    CAST(CASE WHEN {_GEO_OK} THEN lat END AS DECIMAL(9,6)) AS action_geo_lat,
    CAST(CASE WHEN {_GEO_OK} THEN lon END AS DECIMAL(9,6)) AS action_geo_long,
    CAST(CASE WHEN tone < -20 THEN -20 WHEN tone > 20 THEN 20 ELSE tone END AS DECIMAL(8,3)) AS avg_tone,
    CAST(goldstein AS DECIMAL(8,3)) AS goldstein_score, source_url, primary_category, secondary_category,
    category_confidence, category_reason, {FLAG_TEXT} AS quality_flags, future AS "drop"
  FROM checked
)"""

#: First surviving row per key, in file order: what a load stores.
STORED_SQL = f"""{VALID_SQL},
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY source, dedupe_key ORDER BY export_time_utc, row_number) AS rn
  FROM valid WHERE NOT "drop"
),
stored AS (SELECT * EXCLUDE (rn) FROM ranked WHERE rn = 1)"""
