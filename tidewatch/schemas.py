"""Schemas of the stored tables. Keys are natural: ``(source, dedupe_key)`` identifies an event everywhere."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch import fixed_values as fv

LAT_LONG = T.DecimalType(9, 6)
TONE = T.DecimalType(8, 3)
CONFIDENCE = T.DecimalType(5, 4)
SPIKE_STAT = T.DecimalType(12, 4)
WIDE = T.DecimalType(38, 18)


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, dtype) for name, dtype in fields.items()])


S, L, I, TS, D = T.StringType(), T.LongType(), T.IntegerType(), T.TimestampType(), T.DoubleType()

EVENT_FIELDS = _struct(**{name: S for name in fv.FIELD_POSITIONS})

INGESTION_RUNS = _struct(
    id=S, started_at=TS, finished_at=TS, status=S, trigger_mode=S, exports_seen=I, exports_completed=I,
    events_inserted=L, events_duplicated=L, error_summary=S,
)
EXPORT_CHECKPOINTS = _struct(
    id=L, source=S, export_time_utc=TS, export_url=S, export_filename=S, status=S, discovered_at=TS,
    processing_started_at=TS, completed_at=TS, attempt_count=I, last_error=S, row_count_raw=L,
    row_count_inserted=L, row_count_duplicates=L,
)
RAW_EVENTS = _struct(
    source=S, export_time_utc=TS, export_url=S, ingestion_run_id=S, dedupe_key=S, global_event_id=L,
    sql_date=T.DateType(), event_time_utc=TS, actor1_name=S, actor2_name=S, event_code=S, action_geo_full_name=S,
    action_geo_country_code=S, action_geo_lat=LAT_LONG, action_geo_long=LAT_LONG, avg_tone=TONE, raw_payload=S,
    validation_flags=T.ArrayType(S), row_number=L, inserted_at=TS,
)
NORMALIZED_EVENTS = _struct(
    dedupe_key=S, event_time_utc=TS, actor1_name=S, actor2_name=S, event_code=S, country_code=S, country_name=S,
    latitude=LAT_LONG, longitude=LAT_LONG, goldstein_score=TONE, primary_category=S, secondary_category=S,
    category_confidence=CONFIDENCE, category_reason=S, source=S, export_time_utc=TS, row_number=L, inserted_at=TS,
    location_wkt=S, location_key=L,
)
DROPPED_EVENTS = _struct(
    ingestion_run_id=S, source=S, export_time_utc=TS, export_url=S, dedupe_key=S, drop_reason=S, error_detail=S,
    quality_flags=T.ArrayType(S), raw_payload=S, created_at=TS,
)
QUALITY_AUDIT = _struct(
    run_timestamp=TS, total_events=L, missing_actor_pct=D, missing_geo_pct=D, unknown_country_pct=D,
)
QUALITY_WARNINGS = _struct(run_timestamp=TS, reason=S, value=D, threshold=D)
LOAD_HISTOGRAMS = _struct(run_timestamp=TS, kind=S, value=S, n=L)
SPIKE_SNAPSHOT = _struct(
    computed_at=TS, window_hours=I, category=S, country=S, recent_count=L, baseline_avg=SPIKE_STAT,
    baseline_std=SPIKE_STAT, z_score=SPIKE_STAT, lift_ratio=SPIKE_STAT,
)


def apply_defaults(df: DataFrame, schema: T.StructType, defaults: dict[str, Column]) -> DataFrame:
    """Shape ``df`` to ``schema``: absent columns and NULLs take their default, other columns keep NULL."""
    def value(field: T.StructField) -> Column:
        default = defaults.get(field.name, F.lit(None))
        present = F.coalesce(F.col(field.name), default) if field.name in df.columns else default
        return present.cast(field.dataType).alias(field.name)

    return df.select([value(field) for field in schema.fields])
