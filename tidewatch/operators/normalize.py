"""Parsed rows of 13 texts to typed, keyed and classified events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch import fixed_values as fv
from tidewatch.functions.lookup import with_country_name
from tidewatch.functions.numeric import parse_decimal, parse_int
from tidewatch.functions.text import clean_text, dedupe_key
from tidewatch.functions.times import event_time, parse_sql_date
from tidewatch.operators.classify import with_category

#: Columns that identify where a row came from; those present are carried through.
ORIGIN = ["export_time_utc", "export_url", "ingestion_run_id", "row_number"]


def normalize_events(
    parsed: DataFrame, source: str = fv.SOURCE, run_id: Column | str | None = None, country_names: bool = True
) -> DataFrame:
    """Type and classify parsed rows.

    ``parsed`` holds the 13 feed fields as text and ``export_time_utc`` (optionally ``export_url``,
    ``ingestion_run_id`` and ``row_number``). One projection, no shuffle: the only join is with a fixed broadcast list.
    Without ``country_names`` it is left out, for rows that validation names anew anyway.
    """
    if run_id is not None:
        parsed = parsed.withColumn("ingestion_run_id", F.lit(run_id))
    origin = [name for name in ORIGIN if name in parsed.columns]
    extra = [name for name in parsed.columns if name not in origin and name not in fv.FIELD_POSITIONS]
    typed = parsed.select(
        F.lit(source).alias("source"),
        *origin,
        dedupe_key().alias("dedupe_key"),
        parse_int("GLOBALEVENTID").alias("global_event_id"),
        parse_sql_date("SQLDATE").alias("sql_date"),
        event_time("DATEADDED", "SQLDATE", "export_time_utc").alias("event_time_utc"),
        clean_text("Actor1Name").alias("actor1_name"),
        clean_text("Actor2Name").alias("actor2_name"),
        clean_text("EventCode").alias("event_code"),
        clean_text("ActionGeo_FullName").alias("action_geo_full_name"),
        clean_text("ActionGeo_CountryCode").alias("action_geo_country_code"),
        parse_decimal("ActionGeo_Lat").alias("action_geo_lat"),
        parse_decimal("ActionGeo_Long").alias("action_geo_long"),
        parse_decimal("AvgTone").alias("avg_tone"),
        parse_decimal("GoldsteinScale").alias("goldstein_score"),
        clean_text("SOURCEURL").alias("source_url"),
        F.struct(*fv.FIELD_POSITIONS).alias("raw_payload"),
        *extra,
    )
    events = with_category(typed)
    return with_country_name(events, "action_geo_country_code") if country_names else events
