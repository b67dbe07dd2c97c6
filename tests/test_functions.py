from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tests.helpers import EVENT
from tidewatch import fixed_values as fv
from tidewatch.functions import flags, lookup, numeric, text, times
from tidewatch.operators.classify import with_category
from tidewatch.plans.monitor import event_line


def values(spark, inputs, expression):
    """Results of an expression over one text column, in input order."""
    rows = [(i, v) for i, v in enumerate(inputs)]
    df = spark.createDataFrame(rows, "i int, x string")
    return [r.v for r in df.select("i", expression.alias("v")).orderBy("i").collect()]


def test_clean_text_strips_all_unicode_whitespace(spark):
    inputs = ["  a b ", " x ", "\x1c\t", "", None]
    assert values(spark, inputs, text.clean_text("x")) == [(v.strip() or None) if v is not None else None for v in inputs]


@pytest.mark.parametrize("word", ["Straße", "ΟΔΟΣ", "ﬁn", "ẞ", "ABC", "İx", "ŉ"])
def test_casefold_equals_python(spark, word):
    assert values(spark, [word], text.casefold("x")) == [word.casefold()]


def test_normalize_text(spark):
    assert values(spark, [" New \t  YORK ", None, "  "], text.normalize_text("x")) == ["new york", "", ""]


def test_clean_actor_keeps_na(spark):
    assert values(spark, ["Unknown ", "null", "-", "n/a", " Police "], text.clean_actor("x")) == [None, None, None, "n/a", "Police"]


def test_country_code(spark):
    inputs = ["us", " usa ", "Unknown", "NA", "Z1", "ABCD", None]
    assert values(spark, inputs, text.normalize_country_code("x")) == ["US", "USA", None, None, None, None, None]


def test_event_code(spark):
    inputs = ["190", " 19 ", "1901", "ABC", "", None]
    assert values(spark, inputs, text.valid_event_code("x")) == ["190", "19", None, None, "", ""]


def _key(spark, **changes):
    df = spark.createDataFrame([{**EVENT, **changes}])
    return df.select(text.dedupe_key().alias("k")).first().k


def test_dedupe_key(spark):
    assert _key(spark, GLOBALEVENTID="0012345") == "gdelt-global-event-id:12345"
    first = _key(spark, GLOBALEVENTID="", Actor1Name=" Police ", ActionGeo_CountryCode="USA")
    assert first == _key(spark, GLOBALEVENTID="x", Actor1Name="police", ActionGeo_CountryCode="usa")
    assert first.startswith("gdelt-composite:") and len(first) == len("gdelt-composite:") + 64
    assert first != _key(spark, GLOBALEVENTID="", Actor1Name="fire", ActionGeo_CountryCode="USA")


def test_numbers(spark):
    assert values(spark, ["7.0", "+7", " 12 ", "x", None], numeric.parse_int("x")) == [None, 7, 12, None, None]
    assert values(spark, ["1e3", "NaN", "Infinity", " -2.5 "], numeric.parse_decimal("x")) == [
        Decimal("1000"), None, None, Decimal("-2.5")]
    tone = numeric.parse_decimal("x")
    assert values(spark, ["-20", "20", "20.5", "-31", None], numeric.clamp_tone(tone)) == [-20, 20, 20, -20, None]
    assert values(spark, ["-20", "20", "20.5", "-31", None], numeric.tone_flag(tone)) == [
        None, None, "tone_clamped_high", "tone_clamped_low", "missing_tone"]


def test_geo_pair_bounds_are_inclusive(spark):
    df = spark.createDataFrame([(90.0, -180.0), (90.1, 0.0), (None, 1.0), (None, None)], "lat double, lon double")
    rows = df.select(*numeric.geo_pair("lat", "lon"), numeric.is_partial_geo("lat", "lon"),
                     numeric.is_geo_out_of_range("lat", "lon")).collect()
    assert [tuple(r) for r in rows] == [
        (90.0, -180.0, False, False), (None, None, False, True), (None, None, True, False), (None, None, False, False)]


def test_times(spark):
    assert values(spark, ["20260311", "2026113", "20261340", "bad", None], times.parse_sql_date("x")) == [
        date(2026, 3, 11), None, None, None, None]
    assert values(spark, ["20260311001500", "20260311", "not"], times.parse_date_added("x")) == [
        datetime(2026, 3, 11, 0, 15), None, None]


def test_age_is_never_negative(spark):
    df = spark.sql("SELECT TIMESTAMP '2026-01-01 00:00:10' AS t")
    assert df.select(times.age_seconds("t", "2026-01-01 00:00:00")).first()[0] == 0
    assert df.select(times.age_seconds("t", "2026-01-01 00:01:10")).first()[0] == 60


def test_percent_and_rounding(spark):
    assert values(spark, ["1"], numeric.percent_text(F.lit(1), F.lit(3))) == ["33.33%"]
    assert values(spark, ["1"], numeric.percent_text(F.lit(1), F.lit(0))) == ["0.00%"]
    assert values(spark, ["1"], numeric.round_half_up(F.lit(0.125), 2)) == [Decimal("0.13")]
    assert values(spark, ["1"], numeric.round_half_up(F.lit(-0.125), 2)) == [Decimal("-0.13")]


def test_countries(spark):
    df = spark.createDataFrame([(c,) for c in ["US", " usa ", "NI", "GB", "ZZZ", "", None]], "code string")
    named = {r.code: r.country_name for r in lookup.with_country_name(df, "code").collect()}
    assert named == {"US": "United States", " usa ": "United States", "NI": "Nigeria", "GB": "United Kingdom",
                     "ZZZ": "Unknown", "": "Unknown", None: "Unknown"}
    dimension = lookup.country_dimension(spark)
    assert dimension.count() == dimension.select("code").distinct().count() == 290


def test_labels_and_tiers(spark):
    inputs = ["190", "194", "999", "", None]
    assert values(spark, inputs, lookup.event_label("x")) == ["Fight", "Fight", "Unknown event", "Unknown event", "Unknown event"]
    assert values(spark, inputs, lookup.translation_tier("x")) == ["exact", "root", "unknown", "unknown", "unknown"]


def _category(spark, code, url="https://example.com", actor="A"):
    df = spark.createDataFrame([(code, actor, "B", "place", url)],
                               "event_code string, actor1_name string, actor2_name string, action_geo_full_name string, source_url string")
    return with_category(df).select("primary_category", "secondary_category", "category_confidence", "category_reason").first()


@pytest.mark.parametrize(("code", "url", "expected"), [
    ("176", "x", ("cyber", None, "0.9500", "cyber_strong_event_code:176")),
    ("112", "https://x.com/ransomware-hits", ("cyber", None, "0.9000", "cyber_keyword:ransomware")),
    ("112", "https://x.com/cyber-attack", ("cyber", None, "0.9000", "cyber_keyword:cyber attack")),
    ("064", "x", ("cyber", None, "0.7200", "cyber_medium_event_code:064")),
    ("064", "https://x.com/flood", ("cyber", None, "0.7200", "cyber_medium_event_code:064")),
    ("112", "https://x.com/cholera-outbreak", ("crisis", "epidemic", "0.9200", "crisis_keyword:epidemic:outbreak")),
    ("112", "https://x.com/drought", ("crisis", "environmental", "0.8800", "crisis_keyword:environmental:drought")),
    ("023", "x", ("crisis", "humanitarian", "0.5600", "crisis_weak_humanitarian_code:023")),
    ("190", "x", ("conflict", None, "0.8200", "root_event_code:19")),
    ("1901", "x", ("conflict", None, "0.8200", "root_event_code:19")),
    (None, "x", ("politics", None, "0.3500", "fallback_unknown_event_code")),
])
def test_categories(spark, code, url, expected):
    row = _category(spark, code, url)
    assert (row[0], row[1], str(row[2]), row[3]) == expected


def test_any_keyword_pattern_finds_each_keyword(spark):
    words = fv.CYBER_KEYWORDS + [w for ws in fv.CRISIS_KEYWORDS.values() for w in ws]
    inputs = [f"x{w}y" for w in words] + ["nothing of the kind"]
    assert values(spark, inputs, text.first_keyword("x", words).isNotNull()) == [True] * len(words) + [False]


def test_event_line(spark):
    df = spark.createDataFrame([{**EVENT, "ActionGeo_Lat": "64.1466", "ActionGeo_Long": "-21.9426", "ActionGeo_FullName": "Reykjavik",
                                 "ActionGeo_CountryCode": "IC"}])
    assert df.select(event_line()).first()[0] == "HARBOUR UNION -> PORT OFFICE | Fight (190) | Reykjavik | IC | 64.15, -21.94"
    empty = spark.createDataFrame([{**EVENT, "Actor1Name": "", "EventCode": "", "ActionGeo_Lat": ""}])
    assert empty.select(event_line()).first()[0] == (
        "Unknown -> PORT OFFICE | Unknown event (Unknown) | Tromso, Troms, Norway | NOR | Unknown, Unknown")


def test_flags_keep_order_and_skip_null(spark):
    df = spark.range(1).select(
        flags.collect_flags(F.lit("b"), F.lit(None).cast("string"), F.lit("a")).alias("f"),
        flags.collect_flags(F.lit(None).cast("string")).alias("none"))
    row = df.select("f", "none", flags.flags_to_text("f"), flags.flags_to_text("none")).first()
    assert tuple(row) == (["b", "a"], [], "b, a", "validation_drop")


def test_payload_keeps_empty_fields(spark):
    row = spark.sql("SELECT named_struct('a', CAST(NULL AS STRING), 'b', '\"q') AS p").select(flags.payload_json("p").alias("j"))
    assert row.first().j == '{"a":null,"b":"\\"q"}'
    assert row.select(flags.payload_field("j", "b")).first()[0] == '"q'
