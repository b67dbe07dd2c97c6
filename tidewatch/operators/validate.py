"""Validation: clean what can be cleaned, flag what was wrong, mark what must not be loaded."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch import fixed_values as fv
from tidewatch.functions.flags import collect_flags, flag_if, flags_to_text, payload_json
from tidewatch.functions.lookup import with_country_name
from tidewatch.functions.numeric import (
    clamp_tone, first_not_null, geo_pair, is_geo_out_of_range, is_partial_geo, parse_decimal, tone_flag,
)
from tidewatch.functions.text import clean_actor, is_bad_event_code, normalize_country_code, strip, valid_event_code
from tidewatch.functions.times import is_future_outlier
from tidewatch.schemas import LAT_LONG, TONE, WIDE


def _first_present(df: DataFrame, *names: str) -> Column:
    present = [F.col(name) for name in names if name in df.columns]
    return first_not_null(*present) if present else F.lit(None).cast("string")


def _as_decimal(df: DataFrame, *names: str) -> Column:
    value = _first_present(df, *names)
    is_text = any(isinstance(df.schema[n].dataType, T.StringType) for n in names if n in df.columns)
    return parse_decimal(value.cast("string")) if is_text else value.try_cast(WIDE)


def _event_time(df: DataFrame) -> tuple[Column, Column]:
    """The event time, and whether a value was given that is no time."""
    given, fallback = F.col("event_time_utc"), F.col("export_time_utc").cast("timestamp")
    if isinstance(df.schema["event_time_utc"].dataType, T.StringType):
        parsed = given.try_cast("timestamp")
        return F.coalesce(parsed, fallback), F.coalesce(given != "", F.lit(False)) & parsed.isNull()
    return F.coalesce(given.cast("timestamp"), fallback), F.lit(False)


def assume_utc(df: DataFrame, flag: str = "time_fallback") -> DataFrame:
    """``event_time_utc`` as a time: without a zone it is UTC, missing or unreadable it is the export's time; ``flag`` says
    whether a value was given that is no time."""
    time, bad = _event_time(df)
    return df.withColumns({"event_time_utc": time, flag: bad})


def _payload_code(df: DataFrame) -> Column:
    if "raw_payload" not in df.columns:
        return F.lit(None).cast("string")
    if isinstance(df.schema["raw_payload"].dataType, T.StructType):
        has_code = "ActionGeo_CountryCode" in df.schema["raw_payload"].dataType.names
        return F.col("raw_payload.ActionGeo_CountryCode") if has_code else F.lit(None).cast("string")
    return F.get_json_object("raw_payload", "$.ActionGeo_CountryCode")


def validate_and_clean(df: DataFrame, as_of: datetime | str) -> DataFrame:
    """Cleaned events with ``quality_flags`` (in rule order) and ``drop``.

    Alternative input names (``country_code``, ``latitude``, ``longitude``, ``tone``, ``actor1``, ``actor2``) are used
    where present. Only a time more than a day after ``as_of`` drops a row. A goldstein score too large for its column
    becomes NULL with a flag instead of failing the load.
    """
    time, bad_time = _event_time(df)
    codes = [F.col(name) for name in ("action_geo_country_code", "country_code") if name in df.columns]
    country = F.coalesce(*[normalize_country_code(c) for c in [*codes, _payload_code(df)]])
    any_code = F.coalesce(*codes, F.lit(None).cast("string")).isNotNull()
    category = F.lower(strip(F.coalesce("primary_category", F.lit(""))))

    staged = (
        df.withColumns({
            "_time": time,
            "_country": country,
            "_lat": _as_decimal(df, "latitude", "action_geo_lat"),
            "_lon": _as_decimal(df, "longitude", "action_geo_long"),
            "_tone": _as_decimal(df, "tone", "avg_tone"),
            "_known_category": category.isin(fv.PRIMARY_CATEGORIES),
        })
    )
    score = F.col("goldstein_score") if "goldstein_score" in df.columns else F.lit(None).cast(TONE)
    flags = collect_flags(
        flag_if(bad_time, "time_fallback_export_time"),
        flag_if(is_future_outlier("_time", as_of), "time_future_outlier"),
        flag_if(is_bad_event_code("event_code"), "bad_event_code"),
        flag_if(~F.col("_known_category"), "category_fallback"),
        flag_if(F.col("_country").isNull() & any_code, "bad_country_code"),
        flag_if(is_partial_geo("_lat", "_lon"), "partial_geo"),
        flag_if(is_geo_out_of_range("_lat", "_lon"), "invalid_geo_range"),
        tone_flag("_tone"),
        flag_if(score.isNotNull() & score.try_cast(TONE).isNull(), "goldstein_out_of_range"),
    )
    lat, lon = geo_pair("_lat", "_lon")
    cleaned = (
        staged.withColumns({
            "quality_flags": flags,
            "drop": is_future_outlier("_time", as_of),
            "event_time_utc": F.col("_time"),
            "event_code": valid_event_code("event_code"),
            "primary_category": F.when(F.col("_known_category"), category).otherwise(F.lit(fv.FALLBACK_CATEGORY)),
            "action_geo_country_code": F.col("_country"),
            "action_geo_lat": lat.cast(LAT_LONG),
            "action_geo_long": lon.cast(LAT_LONG),
            "avg_tone": clamp_tone("_tone").cast(TONE),
            "goldstein_score": score.try_cast(TONE),
            "actor1_name": clean_actor(_first_present(df, "actor1", "actor1_name")),
            "actor2_name": clean_actor(_first_present(df, "actor2", "actor2_name")),
        })
        .drop("_time", "_country", "_lat", "_lon", "_tone", "_known_category", "country_name")
    )
    return with_country_name(cleaned, "action_geo_country_code")


def surviving(validated: DataFrame) -> DataFrame:
    """Rows to load, with their flags as ``validation_flags``."""
    return validated.filter(~F.col("drop")).withColumn("validation_flags", F.col("quality_flags"))


def validation_drops(validated: DataFrame) -> DataFrame:
    """Quarantine rows of the events that validation rejected."""
    return validated.filter("drop").select(
        "ingestion_run_id", "source", "export_time_utc", "export_url", "dedupe_key",
        F.lit("validation_drop").alias("drop_reason"),
        flags_to_text("quality_flags").alias("error_detail"),
        "quality_flags",
        payload_json("raw_payload").alias("raw_payload"),
    )


def parse_error_drops(malformed: DataFrame, source: str = fv.SOURCE) -> DataFrame:
    """Quarantine rows of malformed lines (``row_number``, ``cols`` and the export's columns)."""
    length = F.size("cols")
    detail = F.format_string("reason=parse_error row_number=%d row_length=%d", F.col("row_number"), length)
    context = F.struct("row_number", length.alias("row_length"), F.col("cols").alias("row"))
    return malformed.select(
        "ingestion_run_id",
        F.lit(source).alias("source"),
        "export_time_utc",
        "export_url",
        F.lit(None).cast("string").alias("dedupe_key"),
        F.lit("parse_error").alias("drop_reason"),
        detail.alias("error_detail"),
        F.array(F.lit("parse_error")).alias("quality_flags"),
        payload_json(F.struct(context.alias("parser_context"))).alias("raw_payload"),
    )


def quarantine(validated: DataFrame, malformed: DataFrame, source: str = fv.SOURCE) -> DataFrame:
    """All rejected rows: malformed lines and validation drops, none removed as duplicates."""
    return parse_error_drops(malformed, source).unionByName(validation_drops(validated))
