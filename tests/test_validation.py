from __future__ import annotations

from datetime import datetime
from decimal import Decimal

import pytest

from tests.helpers import EVENT, one
from tidewatch.operators.normalize import normalize_events
from tidewatch.operators.validate import validate_and_clean, validation_drops

AS_OF = "2026-03-27 00:00:00"
EXPORT_TIME = datetime(2026, 3, 26, 0, 30)


def validated(spark, **changes):
    row = {**EVENT, **changes, "export_time_utc": EXPORT_TIME, "export_url": "u", "ingestion_run_id": "r", "row_number": 1}
    return validate_and_clean(normalize_events(spark.createDataFrame([row])), AS_OF)


def test_clean_event(spark):
    row = one(validated(spark))
    assert row.quality_flags == [] and not row["drop"]
    assert (row.action_geo_country_code, row.country_name, row.primary_category) == ("NOR", "Norway", "conflict")
    assert (row.action_geo_lat, row.avg_tone, row.goldstein_score) == (Decimal("69.649200"), Decimal("-4.750"), Decimal("-6.250"))
    assert row.event_time_utc == datetime(2026, 3, 26, 0, 15)


@pytest.mark.parametrize(("changes", "flags"), [
    ({"DATEADDED": "20991231000000"}, ["time_future_outlier"]),
    ({"EventCode": "1901"}, ["bad_event_code"]),
    ({"ActionGeo_CountryCode": "Unknown"}, ["bad_country_code"]),
    ({"ActionGeo_CountryCode": ""}, []),
    ({"ActionGeo_Lat": ""}, ["partial_geo"]),
    ({"ActionGeo_Lat": "90", "ActionGeo_Long": "-180"}, []),
    ({"ActionGeo_Lat": "90.0001"}, ["invalid_geo_range"]),
    ({"ActionGeo_Lat": "NaN"}, ["partial_geo"]),
    ({"AvgTone": ""}, ["missing_tone"]),
    ({"AvgTone": "20"}, []),
    ({"AvgTone": "-20.5"}, ["tone_clamped_low"]),
    ({"AvgTone": "25", "EventCode": "x", "ActionGeo_Long": ""}, ["bad_event_code", "partial_geo", "tone_clamped_high"]),
    ({"GoldsteinScale": "123456789"}, ["goldstein_out_of_range"]),
])
def test_flags(spark, changes, flags):
    assert one(validated(spark, **changes)).quality_flags == flags


def test_future_is_the_only_drop(spark):
    assert one(validated(spark, DATEADDED="20260328000000"))["drop"] is False  # exactly a day ahead
    late = validated(spark, DATEADDED="20260328000001")
    assert one(late)["drop"] is True
    drop = one(validation_drops(late))
    assert (drop.drop_reason, drop.error_detail) == ("validation_drop", "time_future_outlier")
    assert '"GLOBALEVENTID":"7041"' in drop.raw_payload


def test_category_comes_from_the_raw_code(spark):
    row = one(validated(spark, EventCode="1901"))
    assert (row.event_code, row.primary_category) == (None, "conflict")
    assert one(validated(spark, EventCode="")).event_code == ""


def test_time_falls_back(spark):
    assert one(validated(spark, DATEADDED="x")).event_time_utc == datetime(2026, 3, 26)
    assert one(validated(spark, DATEADDED="", SQLDATE="bad")).event_time_utc == EXPORT_TIME


def test_alternative_names_and_payload_fallback(spark):
    columns = ("event_time_utc timestamp, export_time_utc timestamp, event_code string, primary_category string, "
               "country_code string, latitude double, longitude double, tone double, actor1 string, actor2_name string, "
               "raw_payload string")
    rows = [(EXPORT_TIME, EXPORT_TIME, "190", "Weather", None, 0.0, 0.0, 0.0, "none", "B", '{"ActionGeo_CountryCode":"br"}'),
            (None, EXPORT_TIME, None, "PROTEST", " Unknown ", 1.0, None, None, "A", None, "{}")]
    first, second = validate_and_clean(spark.createDataFrame(rows, columns), AS_OF).collect()
    assert (first.action_geo_country_code, first.action_geo_lat, first.avg_tone) == ("BR", Decimal("0.000000"), Decimal("0.000"))
    assert (first.actor1_name, first.actor2_name, first.primary_category) == (None, "B", "politics")
    assert first.quality_flags == ["category_fallback"]
    assert second.quality_flags == ["bad_country_code", "partial_geo", "missing_tone"]
    assert (second.event_time_utc, second.event_code, second.primary_category) == (EXPORT_TIME, "", "protest")


def test_text_time_that_does_not_parse(spark):
    columns = ("event_time_utc string, export_time_utc timestamp, event_code string, primary_category string, "
               "avg_tone double, actor1_name string, actor2_name string")
    row = one(validate_and_clean(spark.createDataFrame([("soon", EXPORT_TIME, "190", "conflict", 1.0, "A", "B")], columns), AS_OF))
    assert row.event_time_utc == EXPORT_TIME and row.quality_flags == ["time_fallback_export_time"]
