"""Table projections of validated events."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch import fixed_values as fv
from tidewatch import schemas
from tidewatch.functions.flags import payload_json
from tidewatch.functions.numeric import location_key, location_wkt
from tidewatch.functions.times import moment_literal


def raw_rows(events: DataFrame, as_of: datetime | str) -> DataFrame:
    """Accepted events in the shape of the raw table."""
    shaped = events.withColumn("raw_payload", payload_json("raw_payload"))
    defaults = {
        "source": F.lit(fv.SOURCE),
        "validation_flags": F.array().cast("array<string>"),
        "inserted_at": moment_literal(as_of),
    }
    return schemas.apply_defaults(shaped.drop("inserted_at"), schemas.RAW_EVENTS, defaults)


def normalized_rows(events: DataFrame, as_of: datetime | str) -> DataFrame:
    """The same accepted events in the shape of the query table."""
    shaped = events.drop("country_code", "latitude", "longitude", "inserted_at").withColumnsRenamed({
        "action_geo_country_code": "country_code",
        "action_geo_lat": "latitude",
        "action_geo_long": "longitude",
    })
    if {"latitude", "longitude"} <= set(shaped.columns):
        shaped = shaped.withColumns({"location_wkt": location_wkt("latitude", "longitude"), "location_key": location_key("latitude", "longitude")})
    defaults = {
        "country_name": F.lit(fv.UNKNOWN),
        "source": F.lit(fv.SOURCE),
        "inserted_at": moment_literal(as_of),
    }
    return schemas.apply_defaults(shaped, schemas.NORMALIZED_EVENTS, defaults)


def dropped_rows(rejected: DataFrame, as_of: datetime | str) -> DataFrame:
    defaults = {
        "source": F.lit(fv.SOURCE),
        "quality_flags": F.array().cast("array<string>"),
        "created_at": moment_literal(as_of),
    }
    return schemas.apply_defaults(rejected, schemas.DROPPED_EVENTS, defaults)
