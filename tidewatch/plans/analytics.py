"""Reports over the query table. Every report takes ``as_of`` and returns a lazy DataFrame.

The table needs ``event_time_utc`` and ``primary_category`` plus whatever the report names; only the columns used are read.
"""

from __future__ import annotations

import math
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidewatch import fixed_values as fv
from tidewatch.functions.flags import missing_actor_in_table, missing_geo_in_table, unknown_country_in_table
from tidewatch.functions.lookup import event_label, translation_tier
from tidewatch.functions.numeric import EARTH_KILOMETRES, kilometres, percent_text, round_half_up, safe_divide
from tidewatch.functions.text import blank_to_default, category_display, country_display, or_unknown
from tidewatch.functions.times import at_least_one, before, format_utc, moment_for, moment_literal, since, time_bucket, utc
from tidewatch.schemas import LAT_LONG, SPIKE_STAT

Moment = datetime | str


def recent(events: DataFrame, as_of: Moment, hours: int = 24) -> DataFrame:
    """Events of the last ``hours``; later events count as recent, events without a time do not."""
    return events.filter(since(events, "event_time_utc", as_of, hours=at_least_one(hours)))


def baseline_range(events: DataFrame, as_of: Moment, hours: int = 24, days: int = fv.SPIKE_BASELINE_DAYS) -> DataFrame:
    """Events from ``days`` ago up to, not including, the recent window."""
    start = since(events, "event_time_utc", as_of, days=days)
    return events.filter(start & before(events, "event_time_utc", as_of, hours=at_least_one(hours)))


# ---------------------------------------------------------------- trends

def hourly_counts(events: DataFrame, as_of: Moment, days: int = 7) -> DataFrame:
    window = events.filter(since(events, "event_time_utc", as_of, days=days))
    hour = time_bucket("event_time_utc", "hour").alias("hour_bucket")
    return window.groupBy(hour, F.col("primary_category").alias("category")).agg(F.count("*").alias("event_count"))


def moving_average(hourly: DataFrame, rows: int = 24) -> DataFrame:
    """Mean of the last ``rows`` rows per category (rows, not clock hours: empty hours have no row).

    The window runs over aggregated hours, whose number per category does not grow with the number of events.
    """
    window = W.partitionBy("category").orderBy("hour_bucket").rowsBetween(-(rows - 1), 0)
    return hourly.withColumn("ma_24h", F.avg("event_count").over(window))


def hourly_trend(events: DataFrame, as_of: Moment, days: int = 7) -> DataFrame:
    return moving_average(hourly_counts(events, as_of, days)).orderBy("hour_bucket", "category")


def dense_hours(hourly: DataFrame, as_of: Moment, days: int = 7) -> DataFrame:
    """Hourly counts with a row for every hour of the window and category, zero where nothing happened.

    Hours are listed per category that occurs, from the window's first whole hour to the last before ``as_of``; an hour
    that the window cuts keeps the count it has.
    """
    start, end = utc(as_of) - timedelta(days=days), utc(as_of)
    first, last = (F.date_trunc("hour", moment_for(hourly, "hour_bucket", m)) for m in (start, end - timedelta(microseconds=1)))
    hours = F.explode(F.sequence(first, last, F.expr("INTERVAL 1 HOUR"))).alias("hour_bucket")
    grid = hourly.select("category").distinct().select("category", hours)
    zeros = grid.withColumn("event_count", F.lit(0).cast("bigint"))
    return hourly.select("category", "hour_bucket", "event_count").unionByName(zeros).groupBy("hour_bucket", "category").agg(
        F.sum("event_count").alias("event_count"))


def hourly_trend_by_clock(events: DataFrame, as_of: Moment, days: int = 7) -> DataFrame:
    """The hourly trend over clock hours: empty ones count as zero, and the mean is over the last 24 of them."""
    return moving_average(dense_hours(hourly_counts(events, as_of, days), as_of, days)).orderBy("hour_bucket", "category")


# ---------------------------------------------------------------- spikes

def daily_counts(events: DataFrame, as_of: Moment, hours: int = 24, days: int = fv.SPIKE_BASELINE_DAYS) -> DataFrame:
    day = time_bucket("event_time_utc", "day").alias("day_bucket")
    return (
        baseline_range(events, as_of, hours, days)
        .groupBy(F.col("primary_category").alias("category"), "country_name", day)
        .agg(F.count("*").alias("daily_count"))
    )


def baseline_stats(daily: DataFrame) -> DataFrame:
    return daily.groupBy("category", "country_name").agg(
        F.avg("daily_count").alias("baseline_avg"), F.stddev_pop("daily_count").alias("baseline_std")
    )


def spike_scores(
    events: DataFrame,
    as_of: Moment,
    hours: int = 24,
    days: int = fv.SPIKE_BASELINE_DAYS,
    min_count: int = fv.SPIKE_MIN_COUNT,
    digits: int = 2,
    weight: str | None = None,
) -> DataFrame:
    """Recent count of each category and country against its daily baseline, unordered and unlimited.

    ``weight`` names a column that says how many events a row stands for; without it a row is one event.

    One scan and one pass: per day both the recent and the baseline events are counted, then the days are folded into
    the group. Groups without a baseline day, or with too few recent events, give no row; empty days do not count.
    """
    def events_where(condition: Column) -> Column:
        return F.count_if(condition) if weight is None else F.coalesce(F.sum(F.when(condition, F.col(weight))), F.lit(0).cast("bigint"))

    hours = at_least_one(hours)
    now = utc(as_of)
    in_recent = since(events, "event_time_utc", as_of, hours=hours)
    in_baseline = since(events, "event_time_utc", as_of, days=days) & ~in_recent
    earliest = min(now - timedelta(hours=hours), now - timedelta(days=days))
    per_day = (
        events.filter(F.col("event_time_utc") >= moment_for(events, "event_time_utc", earliest))
        .groupBy(
            F.col("primary_category").alias("category"),
            "country_name",
            time_bucket("event_time_utc", "day").alias("_day"),
        )
        .agg(events_where(in_recent).alias("_recent"), F.nullif(events_where(in_baseline), F.lit(0).cast("bigint")).alias("_base"))
    )
    grouped = (
        per_day.groupBy("category", "country_name")
        .agg(
            F.sum("_recent").alias("recent_count"),
            F.avg("_base").alias("baseline_avg"),
            F.stddev_pop("_base").alias("baseline_std"),
        )
        .filter((F.col("recent_count") >= min_count) & F.col("baseline_avg").isNotNull()
                & F.col("category").isNotNull() & F.col("country_name").isNotNull())
    )
    excess = safe_divide(F.col("recent_count") - F.col("baseline_avg"), "baseline_std")
    lift = safe_divide("recent_count", "baseline_avg")
    return grouped.withColumns({"z_score": round_half_up(excess, digits), "lift_ratio": round_half_up(lift, digits)})


def dense_baseline(events: DataFrame, as_of: Moment, hours: int = 24, days: int = fv.SPIKE_BASELINE_DAYS) -> DataFrame:
    """Baseline statistics over all days that the baseline window touches; days without an event count as zero.

    The zeros are not made as rows: count, sum and sum of squares of the days that occur are all it takes.
    """
    daily = daily_counts(events, as_of, hours, days)
    first, last = utc(as_of) - timedelta(days=days), utc(as_of) - timedelta(hours=at_least_one(hours), microseconds=1)
    n = F.lit(max((last.date() - first.date()).days + 1, 1)).cast("double")
    sums = daily.groupBy("category", "country_name").agg(
        F.sum("daily_count").alias("_sum"), F.sum(F.col("daily_count") * F.col("daily_count")).alias("_squares"))
    mean = F.col("_sum") / n
    return sums.select("category", "country_name", mean.alias("baseline_avg"), F.sqrt(F.greatest(F.col("_squares") / n - mean * mean, F.lit(0.0))).alias("baseline_std"))


def spikes_from_hours(
    hourly: DataFrame, as_of: Moment, hours: int = 24, days: int = fv.SPIKE_BASELINE_DAYS, limit: int | None = fv.SPIKE_LIMIT, **options: int
) -> DataFrame:
    """Top spikes from stored hourly counts (``hour_bucket``, ``category``, ``country_name``, ``event_count``).

    Reads a row for each hour and group instead of every event. The windows must begin and end on the hour, as they do if
    ``as_of`` does; else ValueError.
    """
    now = utc(as_of)
    if (now.minute, now.second, now.microsecond) != (0, 0, 0):
        raise ValueError("stored hours answer only for moments on the hour")
    scores = spike_scores(
        hourly.select(F.col("hour_bucket").alias("event_time_utc"), F.col("category").alias("primary_category"), "country_name", "event_count"),
        as_of, hours, days, weight="event_count", **options)
    ranked = scores.drop("baseline_std").orderBy(*_spike_order())
    return ranked if limit is None else ranked.limit(limit)


def _spike_order() -> list[Column]:
    return [F.desc_nulls_last("z_score"), F.desc_nulls_last("lift_ratio"), F.asc("category"), F.asc("country_name")]


def spikes(
    events: DataFrame, as_of: Moment, hours: int = 24, limit: int | None = fv.SPIKE_LIMIT, **options: int
) -> DataFrame:
    """Top spikes; ties are broken by category and country. ``limit=None`` gives all of them."""
    ranked = spike_scores(events, as_of, hours, **options).drop("baseline_std").orderBy(*_spike_order())
    return ranked if limit is None else ranked.limit(limit)


def spike_snapshot(events: DataFrame, as_of: Moment, hours: int = 24, **options: int) -> DataFrame:
    """All spikes, four digits, in the shape of the snapshot table; append the result to keep it."""
    rows = spike_scores(events, as_of, hours, digits=4, **options)
    stats = ["baseline_avg", "baseline_std", "z_score", "lift_ratio"]
    return rows.select(
        moment_literal(as_of).alias("computed_at"),
        F.lit(at_least_one(hours)).alias("window_hours"),
        "category",
        F.col("country_name").alias("country"),
        "recent_count",
        *[F.col(name).cast(SPIKE_STAT).alias(name) for name in stats],
    )


# ---------------------------------------------------------------- tension and momentum

def tension_events(events: DataFrame, threshold: float = fv.TENSION_TONE) -> DataFrame:
    """Events whose tone (the goldstein score) is known and at or below the threshold."""
    return events.filter(F.col("goldstein_score").isNotNull() & (F.col("goldstein_score") <= threshold))


def tension_pairs(
    events: DataFrame, as_of: Moment, hours: int = 48,
    threshold: float = fv.TENSION_TONE, min_count: int = fv.TENSION_MIN_COUNT,
) -> DataFrame:
    return (
        tension_events(recent(events, as_of, hours), threshold)
        .groupBy(
            F.coalesce("actor1_name", F.lit(fv.UNKNOWN)).alias("actor1"),
            F.coalesce("actor2_name", F.lit(fv.UNKNOWN)).alias("actor2"),
            F.col("primary_category").alias("category"),
        )
        .agg(
            F.count("*").alias("event_count"),
            F.sum("goldstein_score").alias("_tone_sum"),
            F.min("goldstein_score").alias("worst_tone"),
        )
        .filter(F.col("event_count") >= min_count)
        .select(
            "actor1", "actor2", "category", "event_count",
            F.round(F.col("_tone_sum").cast("decimal(38,9)") / F.col("event_count"), 2).alias("avg_tone"),
            "worst_tone",
        )
    )


def tension(
    events: DataFrame, as_of: Moment, hours: int = 48, limit: int | None = fv.TENSION_LIMIT, **options: float
) -> DataFrame:
    """Actor pairs with the most negative tone; ties are broken by the names and the category."""
    ranked = tension_pairs(events, as_of, hours, **options).orderBy(
        F.asc("avg_tone"), F.desc("event_count"), F.asc("actor1"), F.asc("actor2"), F.asc("category")
    )
    return ranked if limit is None else ranked.limit(limit)


def momentum(events: DataFrame, as_of: Moment, corrected: bool = False) -> DataFrame:
    """Three-hour counts against the day. One scan counts both windows.

    ``c_24h_hourly_avg`` keeps its established formula, the day's count over 8, which is a mean per three hours;
    ``corrected=True`` adds ``momentum_ratio_hourly``, where a steady feed gives 1.
    """
    in_short = since(events, "event_time_utc", as_of, hours=3)
    counts = (
        recent(events, as_of, 24)
        .groupBy(F.col("primary_category").alias("category"))
        .agg(F.count_if(in_short).alias("c_3h"), F.count("*").alias("_day"))
        .filter((F.col("c_3h") > 0) & F.col("category").isNotNull())
    )
    eighth = (F.col("_day") / F.lit(8.0)).alias("c_24h_hourly_avg")
    ratio = safe_divide(F.col("c_3h") / 3.0, F.col("_day") / 8.0)
    columns = ["category", "c_3h", eighth, round_half_up(ratio, 2).alias("momentum_ratio")]
    if corrected:
        columns.append(round_half_up(ratio * 3, 2).alias("momentum_ratio_hourly"))
    return counts.select(*columns).orderBy(F.desc_nulls_last("momentum_ratio"), F.desc("c_3h"), F.asc("category"))


# ---------------------------------------------------------------- statistics

def stats_overview(events: DataFrame, as_of: Moment, hours: int = 24) -> DataFrame:
    """One row of counters; an empty window gives 0 events and NULL counters."""
    def total(condition: Column, name: str) -> Column:
        return F.sum(F.when(condition, 1).otherwise(0)).alias(name)

    return recent(events, as_of, hours).agg(
        F.count("*").alias("total_events"),
        total(missing_actor_in_table("actor1_name", "actor2_name"), "missing_actor_count"),
        total(missing_geo_in_table("country_code", "latitude", "longitude"), "missing_geo_count"),
        total(unknown_country_in_table("country_name"), "unknown_country_count"),
        total(F.col("category_reason") == fv.FALLBACK_REASON, "fallback_unknown_category_count"),
    )


def count_by_category(events: DataFrame, as_of: Moment, hours: int = 24) -> DataFrame:
    counts = recent(events, as_of, hours).groupBy("primary_category").agg(F.count("*").alias("count"))
    return counts.orderBy(F.desc("count"), F.asc_nulls_last("primary_category"))


def count_by_country(events: DataFrame, as_of: Moment, hours: int = 24, limit: int = 10) -> DataFrame:
    counts = (
        recent(events, as_of, hours)
        .groupBy(blank_to_default("country_name").alias("country_name"))
        .agg(F.count("*").alias("count"))
    )
    return counts.orderBy(F.desc("count"), F.asc("country_name")).limit(limit)


def count_by_event_code(events: DataFrame, as_of: Moment, hours: int = 24) -> DataFrame:
    """Counts per code; NULL and '' are groups of their own."""
    counts = recent(events, as_of, hours).groupBy("event_code").agg(F.count("*").alias("count"))
    return counts.orderBy(F.desc_nulls_last("count"), F.asc_nulls_last("event_code"))


def event_stats(events: DataFrame, as_of: Moment, hours: int = 24) -> dict[str, DataFrame]:
    """The four statistics of one window. Cache ``recent(...)`` first if all four are collected."""
    return {
        "overview": stats_overview(events, as_of, hours),
        "category_counts": count_by_category(events, as_of, hours),
        "top_countries": count_by_country(events, as_of, hours),
        "event_code_counts": count_by_event_code(events, as_of, hours),
    }


def tier_counts(code_counts: DataFrame) -> DataFrame:
    """Events per translation tier from counts per code."""
    return code_counts.groupBy(translation_tier("event_code").alias("tier")).agg(F.sum("count").alias("tier_count"))


def translation_coverage(events: DataFrame, as_of: Moment, hours: int = 24) -> DataFrame:
    """Count and percentage of events whose code is labelled exactly, by root or not, and of fallback categories.

    Events are counted per code first, so tiers are looked up once per distinct code.
    """
    per_code = recent(events, as_of, hours).groupBy("event_code").agg(
        F.count("*").alias("count"),
        F.count_if(F.col("category_reason") == fv.FALLBACK_REASON).alias("_fallback"),
    )
    tier = translation_tier("event_code")
    totals = per_code.agg(
        F.coalesce(F.sum("count"), F.lit(0)).alias("total_events"),
        *[F.coalesce(F.sum(F.when(tier == t, F.col("count"))), F.lit(0)).alias(t) for t in ("exact", "root", "unknown")],
        F.coalesce(F.sum("_fallback"), F.lit(0)).alias("fallback"),
    )
    parts = [F.struct(F.lit(t).alias("measure"), F.col(t).alias("events"), percent_text(t, "total_events").alias("share"))
             for t in ("exact", "root", "unknown", "fallback")]
    return totals.select(F.inline(F.array(*parts)))


# ---------------------------------------------------------------- latest events

LATEST_COLUMNS = [
    "event_time_utc", "actor1_name", "actor2_name", "event_code", "country_code", "country_name", "latitude",
    "longitude", "primary_category", "secondary_category", "category_confidence", "goldstein_score",
]


def latest_events(events: DataFrame, limit: int = 20, tie_break: list[str] | None = None) -> DataFrame:
    """Newest events: by time, unknown times last, then by the newest key. Runs as a distributed top-k."""
    ties = [F.desc(name) for name in (tie_break or ["export_time_utc", "row_number"])]
    order = [F.desc_nulls_last("event_time_utc"), *ties]
    return events.orderBy(*order).limit(at_least_one(limit)).select(*LATEST_COLUMNS)


def events_near(events: DataFrame, lat: float, lon: float, km: float) -> DataFrame:
    """Events within ``km`` of a point, with ``distance_km``.

    A box of latitudes and longitudes around the circle reaches the scan, where row groups outside are skipped by their
    statistics; the exact distance follows. A circle over a pole or the date line has no bounds of longitude.
    """
    reach = math.degrees(km / EARTH_KILOMETRES) * (1 + 1e-9)
    box = F.col("latitude").between(F.lit(max(lat - reach, -90.0)).cast(LAT_LONG), F.lit(min(lat + reach, 90.0)).cast(LAT_LONG))
    if abs(lat) + reach < 90:
        wide = math.degrees(math.asin(min(1.0, math.sin(math.radians(reach)) / math.cos(math.radians(lat))))) * (1 + 1e-9) + 1e-6
        if -180 <= lon - wide and lon + wide <= 180:
            box = box & F.col("longitude").between(F.lit(lon - wide).cast(LAT_LONG), F.lit(lon + wide).cast(LAT_LONG))
    near = events.filter(box).withColumn("distance_km", kilometres("latitude", "longitude", lat, lon))
    return near.filter(F.col("distance_km") <= km)


def latest_display(rows: DataFrame) -> DataFrame:
    """Display columns of latest events."""
    return rows.select(
        format_utc("event_time_utc").alias("time"),
        or_unknown("actor1_name").alias("actor1"),
        or_unknown("actor2_name").alias("actor2"),
        F.concat(event_label("event_code"), F.lit(" ("), or_unknown("event_code"), F.lit(")")).alias("event"),
        country_display("country_name", "country_code").alias("country"),
        or_unknown(category_display("primary_category", "secondary_category")).alias("category"),
        "category_confidence",
        F.col("goldstein_score").alias("tone"),
    )


def latest(events: DataFrame, limit: int = 20, tie_break: list[str] | None = None) -> DataFrame:
    return latest_display(latest_events(events, limit, tie_break))
