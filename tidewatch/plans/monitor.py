"""The feed monitor: breaking events and the first events of each category, straight from parsed rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch import fixed_values as fv
from tidewatch.functions.lookup import event_label
from tidewatch.functions.numeric import parse_float_or_zero
from tidewatch.functions.text import clean_text, code_root, or_unknown, strip
from tidewatch.operators.classify import with_category
from tidewatch.operators.dedupe import rank_per_key


#: The report's first section.
BREAKING = "breaking"


def classify_parsed(parsed: DataFrame) -> DataFrame:
    """Parsed rows with their category columns."""
    return with_category(parsed, "EventCode", "Actor1Name", "Actor2Name", "ActionGeo_FullName", "SOURCEURL")


def is_breaking() -> Column:
    """Very negative tone, a coercion-to-violence code, or a protest."""
    root = code_root(F.coalesce("EventCode", F.lit("")))
    tone = parse_float_or_zero("AvgTone")
    return (tone < fv.BREAKING_TONE) | root.isin(fv.BREAKING_ROOTS) | (F.col("primary_category") == "protest")


def breaking(classified: DataFrame) -> DataFrame:
    return classified.filter(is_breaking())


def top_breaking(classified: DataFrame, limit: int = fv.BREAKING_LIMIT, order: list[str] | None = None) -> DataFrame:
    """The lowest tones among breaking events, ties in file order."""
    file_order = order or ["export_time_utc", "row_number"]
    return breaking(classified).orderBy(parse_float_or_zero("AvgTone"), *file_order).limit(limit)


def first_per_category(
    classified: DataFrame, n: int = fv.EVENTS_PER_CATEGORY, order: list[str] | None = None
) -> DataFrame:
    """The first ``n`` events of each category in file order, categories in report order.

    At most ``n`` rows per category and task reach the shuffle.
    """
    file_order = order or ["export_time_utc", "row_number"]
    position = F.array_position(F.array(*[F.lit(c) for c in fv.PRIMARY_CATEGORIES]), F.col("primary_category"))
    ranked = rank_per_key(classified, ["primary_category"], file_order, "category_rank")
    return ranked.filter(F.col("category_rank") <= n).orderBy(position, "category_rank")


def event_line() -> Column:
    """``actor -> actor | label (code) | place | country | lat, lon`` of a parsed row."""
    lat, lon = (clean_text(name).try_cast("double") for name in ("ActionGeo_Lat", "ActionGeo_Long"))
    both = lat.isNotNull() & lon.isNotNull()

    def coordinate(value: Column) -> Column:
        return F.when(both, F.format_string("%.2f", value)).otherwise(F.lit(fv.UNKNOWN))

    code = or_unknown("EventCode")
    return F.concat(
        or_unknown("Actor1Name"), F.lit(" -> "), or_unknown("Actor2Name"), F.lit(" | "),
        event_label(code), F.lit(" ("), code, F.lit(") | "),
        or_unknown("ActionGeo_FullName"), F.lit(" | "), or_unknown("ActionGeo_CountryCode"), F.lit(" | "),
        coordinate(lat), F.lit(", "), coordinate(lon),
    )


def stripped(parsed: DataFrame) -> DataFrame:
    """Parsed rows with every feed field stripped, as a file reader delivers them."""
    return parsed.withColumns({name: strip(name) for name in fv.FIELD_POSITIONS})


def monitor_report(parsed: DataFrame, order: list[str] | None = None) -> DataFrame:
    """Both parts of the report as lines: section, rank and display line.

    One pass: an event is classified once and stands in the section of its category and, if it is one, among the breaking
    ones; of each section at most as many rows as the report shows reach the shuffle from a task.
    """
    file_order = order or ["export_time_utc", "row_number"]
    sections = F.array_compact(F.array(F.when(is_breaking(), F.lit(BREAKING)), F.col("primary_category")))
    rows = classify_parsed(parsed).withColumn("section", F.explode(sections))
    by_tone = F.when(F.col("section") == BREAKING, parse_float_or_zero("AvgTone"))
    ranked = rank_per_key(rows, ["section"], [by_tone, *file_order], "rank").filter(F.col("rank") <= max(fv.BREAKING_LIMIT, fv.EVENTS_PER_CATEGORY))
    shown = F.when(F.col("section") == BREAKING, F.lit(fv.BREAKING_LIMIT)).otherwise(F.lit(fv.EVENTS_PER_CATEGORY))
    return ranked.filter(F.col("rank") <= shown).select("section", "rank", event_line().alias("line"))
