"""Reports over the query table, the monitor and the quality counters."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import functions as F

from contract import sql_text as q
from contract.adapters import AS_OF, RAW_SQL, normalized_like, normalized_sql, raw_like
from contract.registry import query
from contract.row_queries import validated_events
from tidewatch import fixed_values as fv
from tidewatch.functions.lookup import with_country_name
from tidewatch.functions.numeric import round_half_up, safe_divide
from tidewatch.functions.times import utc
from tidewatch.operators import dedupe, quality, validate
from tidewatch.plans import analytics, country_codes, monitor
from tidewatch.session import shared_folder
from tidewatch.sources.tables import EventTables
from tidewatch.streaming import hourly

NE = normalized_sql()
NOW = f"TIMESTAMP '{AS_OF}'"


def _table_like(spark, sf):
    """What a load stores, in the shape of the query table, with the event id."""
    rows = dedupe.new_events(validate.surviving(validated_events(spark, sf)))
    renamed = rows.withColumnsRenamed({
        "action_geo_country_code": "country_code", "action_geo_lat": "latitude", "action_geo_long": "longitude"})
    return renamed


TABLE_SQL = f"""{q.STORED_SQL},
nt AS (SELECT * EXCLUDE (action_geo_country_code, action_geo_lat, action_geo_long), action_geo_country_code AS country_code,
       action_geo_lat AS latitude, action_geo_long AS longitude FROM stored)"""

# ---------------------------------------------------------------- scans and filters


@query("scan_events_table", f"WITH {NE} SELECT event_time_utc, primary_category AS category, country_name, "
                            "CAST(goldstein_score AS DOUBLE) AS tone FROM ne")
def _scan(spark, sf):
    return normalized_like(spark, sf).select(
        "event_time_utc", F.col("primary_category").alias("category"), "country_name", F.col("goldstein_score").alias("tone"))


@query("filter_recent", f"WITH {NE} SELECT event_id, event_time_utc FROM ne WHERE event_time_utc >= {NOW} - INTERVAL 48 HOUR")
def _recent(spark, sf):
    return analytics.recent(normalized_like(spark, sf), AS_OF, 48).select("event_id", "event_time_utc")


@query("filter_baseline_range", f"""WITH {NE} SELECT event_id, event_time_utc FROM ne
WHERE event_time_utc >= {NOW} - INTERVAL 15 DAY AND event_time_utc < {NOW} - INTERVAL 48 HOUR""")
def _baseline(spark, sf):
    return analytics.baseline_range(normalized_like(spark, sf), AS_OF, 48).select("event_id", "event_time_utc")


@query("filter_tension", f"""WITH {NE} SELECT event_id, CAST(goldstein_score AS DOUBLE) AS goldstein_score FROM ne
WHERE goldstein_score IS NOT NULL AND goldstein_score <= -5""")
def _tension_events(spark, sf):
    return analytics.tension_events(normalized_like(spark, sf)).select("event_id", "goldstein_score")


_BREAKING = """(coalesce(TRY_CAST("AvgTone" AS DOUBLE), 0.0) < -5 OR left("EventCode", 2) IN ('17', '18', '19', '20')
 OR primary_category = 'protest')"""
_CLASSIFIED = f"""{q.NORM_SQL}, cl AS (SELECT raw.*, norm.primary_category FROM raw JOIN norm USING (event_id))"""


@query("filter_breaking", f'WITH {_CLASSIFIED} SELECT event_id, primary_category FROM cl WHERE {_BREAKING}')
def _breaking(spark, sf):
    return monitor.breaking(monitor.classify_parsed(raw_like(spark, sf))).select("event_id", "primary_category")


@query("filter_min_count", f"""WITH {NE} SELECT primary_category AS category, actor2_name, count(*) AS n FROM ne
GROUP BY ALL HAVING count(*) >= 10""")
def _min_count(spark, sf):
    counts = normalized_like(spark, sf).groupBy(F.col("primary_category").alias("category"), "actor2_name")
    return counts.agg(F.count("*").alias("n")).filter("n >= 10")


# ---------------------------------------------------------------- trends and spikes

_HOURLY = f"""hourly AS (SELECT date_trunc('hour', event_time_utc) AS hour_bucket, primary_category AS category,
  count(*) AS event_count FROM ne WHERE event_time_utc >= {NOW} - INTERVAL 7 DAY GROUP BY ALL)"""
_MA = """avg(event_count) OVER (PARTITION BY category ORDER BY hour_bucket ROWS BETWEEN 23 PRECEDING AND CURRENT ROW)"""


@query("hourly_counts", f"WITH {NE}, {_HOURLY} SELECT * FROM hourly")
def _hourly(spark, sf):
    return analytics.hourly_counts(normalized_like(spark, sf), AS_OF)


@query("moving_avg_24", f"WITH {NE}, {_HOURLY} SELECT hour_bucket, category, round({_MA}, 6) AS ma_24h FROM hourly")
def _moving(spark, sf):
    trend = analytics.moving_average(analytics.hourly_counts(normalized_like(spark, sf), AS_OF))
    return trend.select("hour_bucket", "category", F.round("ma_24h", 6).alias("ma_24h"))


@query("hourly_trend", f"WITH {NE}, {_HOURLY} SELECT hour_bucket, category, event_count, round({_MA}, 6) AS ma_24h FROM hourly")
def _trend(spark, sf):
    trend = analytics.hourly_trend(normalized_like(spark, sf), AS_OF)
    return trend.withColumn("ma_24h", F.round("ma_24h", 6))


@query("hourly_trend_by_clock", f"""WITH {NE}, {_HOURLY},
grid AS (SELECT category, unnest(generate_series(date_trunc('hour', {NOW} - INTERVAL 7 DAY), date_trunc('hour', {NOW} - INTERVAL 1 MICROSECOND),
 INTERVAL 1 HOUR)) AS hour_bucket FROM (SELECT DISTINCT category FROM hourly)),
dense AS (SELECT hour_bucket, category, CAST(sum(event_count) AS BIGINT) AS event_count FROM
 (SELECT hour_bucket, category, event_count FROM hourly UNION ALL SELECT hour_bucket, category, 0 FROM grid) GROUP BY ALL)
SELECT hour_bucket, category, event_count, round({_MA}, 6) AS ma_24h FROM dense""")
def _trend_by_clock(spark, sf):
    trend = analytics.hourly_trend_by_clock(normalized_like(spark, sf), AS_OF)
    return trend.withColumn("ma_24h", F.round("ma_24h", 6))


def _spike_sql(hours: int, digits: int, country: str = "n_name") -> str:
    return f"""WITH {normalized_sql(country)},
recent AS (SELECT primary_category AS category, country_name, count(*) AS recent_count FROM ne
  WHERE event_time_utc >= {NOW} - INTERVAL {hours} HOUR GROUP BY ALL),
daily AS (SELECT primary_category AS category, country_name, date_trunc('day', event_time_utc) AS day_bucket,
  count(*) AS daily_count FROM ne WHERE event_time_utc >= {NOW} - INTERVAL 15 DAY
  AND event_time_utc < {NOW} - INTERVAL {hours} HOUR GROUP BY ALL),
stats AS (SELECT category, country_name, avg(daily_count) AS baseline_avg, stddev_pop(daily_count) AS baseline_std
  FROM daily GROUP BY ALL),
scored AS (SELECT r.category, r.country_name, r.recent_count, b.baseline_avg, b.baseline_std,
  CAST(round(CAST((r.recent_count - b.baseline_avg) / nullif(b.baseline_std, 0) AS DECIMAL(38,9)), {digits}) AS DOUBLE) AS z_score,
  CAST(round(CAST(r.recent_count / nullif(b.baseline_avg, 0) AS DECIMAL(38,9)), {digits}) AS DOUBLE) AS lift_ratio
  FROM recent r JOIN stats b ON r.category = b.category AND r.country_name = b.country_name WHERE r.recent_count >= 10)"""


_SPIKE_TOP = """SELECT category, country_name, recent_count, round(baseline_avg, 6) AS baseline_avg, z_score, lift_ratio
FROM scored ORDER BY z_score DESC NULLS LAST, lift_ratio DESC, category, country_name LIMIT 50"""


@query("spikes", f"{_spike_sql(48, 2)} {_SPIKE_TOP}")
def _spikes(spark, sf):
    spikes = analytics.spikes(normalized_like(spark, sf), AS_OF, 48)
    return spikes.withColumn("baseline_avg", F.round("baseline_avg", 6))


@query("top_spikes", f"{_spike_sql(168, 2, 'r_name')} {_SPIKE_TOP}")
def _top_spikes(spark, sf):
    spikes = analytics.spikes(normalized_like(spark, sf, "r_name"), AS_OF, 168)
    return spikes.withColumn("baseline_avg", F.round("baseline_avg", 6))


_DAILY = f"""daily AS (SELECT primary_category AS category, country_name,
 CAST(date_trunc('day', event_time_utc) AS TIMESTAMP) AS day_bucket, count(*) AS daily_count FROM ne
 WHERE event_time_utc >= {NOW} - INTERVAL 15 DAY AND event_time_utc < {NOW} - INTERVAL 48 HOUR GROUP BY ALL)"""


@query("daily_counts", f"WITH {NE}, {_DAILY} SELECT * FROM daily")
def _daily(spark, sf):
    return analytics.daily_counts(normalized_like(spark, sf), AS_OF, 48)


@query("baseline_mean_std", f"""WITH {NE}, {_DAILY} SELECT category, country_name, round(avg(daily_count), 6) AS baseline_avg,
round(stddev_pop(daily_count), 6) AS baseline_std FROM daily GROUP BY ALL""")
def _stats(spark, sf):
    stats = analytics.baseline_stats(analytics.daily_counts(normalized_like(spark, sf), AS_OF, 48))
    return stats.withColumns({c: F.round(c, 6) for c in ("baseline_avg", "baseline_std")})


@query("dense_baseline", f"""WITH {NE}, {_DAILY}, days AS (SELECT unnest(generate_series(CAST({NOW} - INTERVAL 15 DAY AS DATE),
 CAST({NOW} - INTERVAL 48 HOUR - INTERVAL 1 MICROSECOND AS DATE), INTERVAL 1 DAY)) AS day_bucket),
dense AS (SELECT g.category, g.country_name, coalesce(d.daily_count, 0) AS n FROM (SELECT DISTINCT category, country_name FROM daily) g
 CROSS JOIN days LEFT JOIN daily d ON d.category = g.category AND d.country_name = g.country_name AND d.day_bucket = days.day_bucket)
SELECT category, country_name, round(avg(n), 6) AS baseline_avg, round(stddev_pop(n), 6) AS baseline_std FROM dense GROUP BY ALL""")
def _dense_baseline(spark, sf):
    stats = analytics.dense_baseline(normalized_like(spark, sf), AS_OF, 48)
    return stats.withColumns({c: F.round(c, 6) for c in ("baseline_avg", "baseline_std")})


@query("spikes_from_hours", f"{_spike_sql(48, 2)} {_SPIKE_TOP}")
def _spikes_from_hours(spark, sf):
    """The spikes again, from a stored table of hours that four micro-batches have built."""
    events = normalized_like(spark, sf)
    hours = hourly.hourly_table(spark, shared_folder(spark, "hours"), ("category", "country_name"))
    for number in range(4):
        hourly.merge_hourly(hours, events.filter(F.col("event_id") % 4 == number), "events", number)
    since = (utc(AS_OF) - timedelta(days=15)).strftime("%Y-%m-%d")
    spikes = analytics.spikes_from_hours(hours.read(lambda d: d is not None and d >= since), AS_OF, 48)
    return spikes.withColumn("baseline_avg", F.round("baseline_avg", 6))


@query("join_recent_baseline", f"{_spike_sql(48, 4)} SELECT category, country_name, recent_count, z_score, lift_ratio FROM scored")
def _recent_baseline(spark, sf):
    """The two-sided form of the spike query, which the one-pass form must equal."""
    events = normalized_like(spark, sf)
    recent = analytics.recent(events, AS_OF, 48).groupBy(F.col("primary_category").alias("category"), "country_name").agg(
        F.count("*").alias("recent_count")).filter("recent_count >= 10")
    stats = analytics.baseline_stats(analytics.daily_counts(events, AS_OF, 48))
    excess = safe_divide(F.col("recent_count") - F.col("baseline_avg"), "baseline_std")
    return recent.join(stats, ["category", "country_name"]).select(
        "category", "country_name", "recent_count", round_half_up(excess, 4).alias("z_score"),
        round_half_up(safe_divide("recent_count", "baseline_avg"), 4).alias("lift_ratio"))


_SNAPSHOT_SQL = f"""{_spike_sql(24, 4, 'r_name')} SELECT {NOW} AS computed_at, CAST(24 AS BIGINT) AS window_hours,
category, country_name AS country, recent_count, CAST(CAST(baseline_avg AS DECIMAL(12,4)) AS DOUBLE) AS baseline_avg,
CAST(CAST(baseline_std AS DECIMAL(12,4)) AS DOUBLE) AS baseline_std, z_score, lift_ratio FROM scored"""


@query("stored_spike_snapshot", _SNAPSHOT_SQL)
def _stored_snapshot(spark, sf):
    """Kept twice, read from the stored table."""
    tables = EventTables(spark, shared_folder(spark, "snapshots"))
    snapshot = analytics.spike_snapshot(normalized_like(spark, sf, "r_name"), AS_OF, 24)
    for _ in range(2):
        tables.keep_spikes(snapshot, AS_OF, 24)
    return tables.spike_snapshots().read()


@query("snapshot_spikes", _SNAPSHOT_SQL)
def _snapshot(spark, sf):
    return analytics.spike_snapshot(normalized_like(spark, sf, "r_name"), AS_OF, 24)


# ---------------------------------------------------------------- tension and momentum

_PAIRS = f"""pairs AS (SELECT coalesce(actor1_name, 'Unknown') AS actor1, coalesce(actor2_name, 'Unknown') AS actor2,
 primary_category AS category, count(*) AS event_count,
 CAST(round(CAST(sum(goldstein_score) / count(*) AS DECIMAL(38,9)), 2) AS DOUBLE) AS avg_tone,
 CAST(min(goldstein_score) AS DOUBLE) AS worst_tone FROM ne
 WHERE event_time_utc >= {NOW} - INTERVAL 720 HOUR AND goldstein_score <= -5 GROUP BY ALL HAVING count(*) >= 3)"""


@query("avg_min_having", f"WITH {NE}, {_PAIRS} SELECT * FROM pairs")
def _pairs(spark, sf):
    return analytics.tension_pairs(normalized_like(spark, sf), AS_OF, 720)


@query("tension", f"WITH {NE}, {_PAIRS} SELECT * FROM pairs ORDER BY avg_tone, event_count DESC, actor1, actor2, category LIMIT 50")
def _tension(spark, sf):
    return analytics.tension(normalized_like(spark, sf), AS_OF, 720)


@query("top_tension", f"WITH {NE}, {_PAIRS} SELECT * FROM pairs ORDER BY avg_tone, event_count DESC, actor1, actor2, category LIMIT 20")
def _top_tension(spark, sf):
    return analytics.tension(normalized_like(spark, sf), AS_OF, 720, limit=20)


_MOMENTUM = f"""short AS (SELECT primary_category AS category, count(*) AS c_3h FROM ne
 WHERE event_time_utc >= {NOW} - INTERVAL 27 HOUR GROUP BY ALL),
long AS (SELECT primary_category AS category, count(*) / 8.0 AS c_24h_hourly_avg FROM ne
 WHERE event_time_utc >= {NOW} - INTERVAL 48 HOUR GROUP BY ALL)"""
_MOMENTUM_AS_OF = "2024-01-30 00:00:00"  # a day earlier, when the short window holds events at every scale


@query("momentum", f"""WITH {NE}, {_MOMENTUM} SELECT category, c_3h, CAST(c_24h_hourly_avg AS DOUBLE) AS c_24h_hourly_avg,
CAST(round(CAST((c_3h / 3.0) / nullif(c_24h_hourly_avg, 0) AS DECIMAL(38,9)), 2) AS DOUBLE) AS momentum_ratio
FROM short JOIN long USING (category)""")
def _momentum(spark, sf):
    return analytics.momentum(normalized_like(spark, sf), _MOMENTUM_AS_OF)


@query("join_short_long", f"WITH {NE}, {_MOMENTUM} SELECT category, c_3h, CAST(c_24h_hourly_avg AS DOUBLE) AS c_24h_hourly_avg "
                          "FROM short JOIN long USING (category)")
def _short_long(spark, sf):
    return analytics.momentum(normalized_like(spark, sf), _MOMENTUM_AS_OF, corrected=True).select(
        "category", "c_3h", "c_24h_hourly_avg")


@query("scaled_count", f"WITH {NE} SELECT country_name, CAST(count(*) / 8.0 AS DOUBLE) AS c_24h_hourly_avg FROM ne GROUP BY ALL")
def _scaled(spark, sf):
    counts = normalized_like(spark, sf).groupBy("country_name").agg(F.count("*").alias("n"))
    return counts.select("country_name", (F.col("n") / F.lit(8.0)).alias("c_24h_hourly_avg"))


# ---------------------------------------------------------------- statistics

_WINDOW = 720
_OVERVIEW = f"""SELECT count(*) AS total_events,
 CAST(sum(CASE WHEN coalesce(trim(actor1_name), '') = '' AND coalesce(trim(actor2_name), '') = '' THEN 1 ELSE 0 END) AS BIGINT) AS missing_actor_count,
 CAST(sum(CASE WHEN ({q.country_code('country_code')}) IS NULL AND latitude IS NULL AND longitude IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS missing_geo_count,
 CAST(sum(CASE WHEN coalesce(nullif(trim(country_name), ''), 'Unknown') = 'Unknown' THEN 1 ELSE 0 END) AS BIGINT) AS unknown_country_count,
 CAST(sum(CASE WHEN category_reason = '{fv.FALLBACK_REASON}' THEN 1 ELSE 0 END) AS BIGINT) AS fallback_unknown_category_count
 FROM nt WHERE event_time_utc >= {NOW} - INTERVAL"""


@query("stats_overview", f"WITH {TABLE_SQL} {_OVERVIEW} {_WINDOW} HOUR")
def _overview(spark, sf):
    return analytics.stats_overview(_table_like(spark, sf), AS_OF, _WINDOW)


@query("conditional_sums", f"WITH {TABLE_SQL} {_OVERVIEW} 1 HOUR")
def _empty_overview(spark, sf):
    """The same counters over a window that may hold nothing."""
    return analytics.stats_overview(_table_like(spark, sf), AS_OF, 0)


@query("count_by_category", f"WITH {NE} SELECT primary_category, count(*) AS count FROM ne "
                            f"WHERE event_time_utc >= {NOW} - INTERVAL 240 HOUR GROUP BY ALL")
def _by_category(spark, sf):
    return analytics.count_by_category(normalized_like(spark, sf), AS_OF, 240)


@query("count_by_country_top10", f"WITH {NE} SELECT coalesce(nullif(trim(country_name), ''), 'Unknown') AS country_name, "
       f"count(*) AS count FROM ne WHERE event_time_utc >= {NOW} - INTERVAL 240 HOUR GROUP BY ALL "
       "ORDER BY count DESC, country_name LIMIT 10")
def _by_country(spark, sf):
    return analytics.count_by_country(normalized_like(spark, sf), AS_OF, 240)


_CODE_COUNTS = f"""codes AS (SELECT event_code, count(*) AS count FROM nt
 WHERE event_time_utc >= {NOW} - INTERVAL {_WINDOW} HOUR GROUP BY ALL)"""


@query("count_by_event_code", f"WITH {TABLE_SQL}, {_CODE_COUNTS} SELECT * FROM codes")
def _by_code(spark, sf):
    return analytics.count_by_event_code(_table_like(spark, sf), AS_OF, _WINDOW)


@query("tier_weighted_sum", f"WITH {TABLE_SQL}, {_CODE_COUNTS} SELECT {q.tier('event_code')} AS tier, "
                            "CAST(sum(count) AS BIGINT) AS tier_count FROM codes GROUP BY ALL")
def _tiers(spark, sf):
    return analytics.tier_counts(analytics.count_by_event_code(_table_like(spark, sf), AS_OF, _WINDOW))


@query("translation_coverage", f"""WITH {TABLE_SQL}, w AS (SELECT {q.tier('event_code')} AS tier, category_reason FROM nt
 WHERE event_time_utc >= {NOW} - INTERVAL {_WINDOW} HOUR), t AS (SELECT count(*) AS n FROM w),
m AS (SELECT 'exact' AS measure, count_if(tier = 'exact') AS events FROM w
 UNION ALL SELECT 'root', count_if(tier = 'root') FROM w UNION ALL SELECT 'unknown', count_if(tier = 'unknown') FROM w
 UNION ALL SELECT 'fallback', count_if(category_reason = '{fv.FALLBACK_REASON}') FROM w)
SELECT measure, CAST(events AS BIGINT) AS events,
 CASE WHEN n > 0 THEN printf('%.2f%%', events / CAST(n AS DOUBLE) * 100) ELSE '0.00%' END AS share FROM m, t""")
def _coverage(spark, sf):
    return analytics.translation_coverage(_table_like(spark, sf), AS_OF, _WINDOW)


# ---------------------------------------------------------------- latest events and the monitor

_LATEST = """SELECT * FROM nt ORDER BY event_time_utc DESC NULLS LAST, export_time_utc DESC, row_number DESC LIMIT"""
_LATEST_DECIMALS = ["latitude", "longitude", "category_confidence", "goldstein_score"]


@query("latest_events", f"WITH {TABLE_SQL}, l AS ({_LATEST} 200) SELECT " + ", ".join(
    f"CAST({c} AS DOUBLE) AS {c}" if c in _LATEST_DECIMALS else c for c in analytics.LATEST_COLUMNS) + " FROM l")
def _latest_events(spark, sf):
    return analytics.latest_events(_table_like(spark, sf), 200)


@query("latest", f"""WITH {TABLE_SQL}, {q.LABELS_SQL}, l AS ({_LATEST} 20)
SELECT coalesce(strftime(event_time_utc, '%Y-%m-%d %H:%M UTC'), 'Unknown') AS time,
 coalesce(actor1_name, 'Unknown') AS actor1, coalesce(actor2_name, 'Unknown') AS actor2,
 {q.label('event_code')} || ' (' || coalesce(nullif(event_code, ''), 'Unknown') || ')' AS event,
 CASE WHEN country_code IS NULL OR country_name = 'Unknown' THEN country_name ELSE country_name || ' (' || country_code || ')' END AS country,
 primary_category || coalesce(':' || secondary_category, '') AS category,
 CAST(category_confidence AS DOUBLE) AS category_confidence, CAST(goldstein_score AS DOUBLE) AS tone FROM l""")
def _latest(spark, sf):
    return analytics.latest(_table_like(spark, sf), 20)


_TONE = 'coalesce(TRY_CAST("AvgTone" AS DOUBLE), 0.0)'


@query("top5_breaking", f"""WITH {_CLASSIFIED} SELECT event_id, "AvgTone", primary_category FROM cl WHERE {_BREAKING}
ORDER BY {_TONE}, export_time_utc, row_number LIMIT 5""")
def _top5(spark, sf):
    rows = monitor.top_breaking(monitor.classify_parsed(raw_like(spark, sf)))
    return rows.select("event_id", "AvgTone", "primary_category")


_FIRST = """fc AS (SELECT *, row_number() OVER (PARTITION BY primary_category ORDER BY export_time_utc, row_number) AS category_rank
 FROM cl)"""


@query("first_n_per_category", f"WITH {_CLASSIFIED}, {_FIRST} SELECT event_id, primary_category, category_rank FROM fc WHERE category_rank <= 3")
def _first_n(spark, sf):
    rows = monitor.first_per_category(monitor.classify_parsed(raw_like(spark, sf)))
    return rows.select("event_id", "primary_category", "category_rank")


_LINE = f"""coalesce(nullif("Actor1Name", ''), 'Unknown') || ' -> ' || coalesce(nullif("Actor2Name", ''), 'Unknown') || ' | ' ||
 {q.label("coalesce(nullif(" + '"EventCode"' + ", ''), 'Unknown')")} || ' (' || coalesce(nullif("EventCode", ''), 'Unknown') || ') | ' ||
 "ActionGeo_FullName" || ' | ' || coalesce(nullif("ActionGeo_CountryCode", ''), 'Unknown') || ' | ' ||
 CASE WHEN TRY_CAST("ActionGeo_Lat" AS DOUBLE) IS NOT NULL AND TRY_CAST("ActionGeo_Long" AS DOUBLE) IS NOT NULL
 THEN printf('%.2f, %.2f', CAST("ActionGeo_Lat" AS DOUBLE), CAST("ActionGeo_Long" AS DOUBLE)) ELSE 'Unknown, Unknown' END"""


@query("breaking_report", f"""WITH {_CLASSIFIED}, {_FIRST}, {q.LABELS_SQL},
br AS (SELECT *, row_number() OVER (ORDER BY {_TONE}, export_time_utc, row_number) AS rk FROM cl WHERE {_BREAKING}),
lines AS (SELECT 'breaking' AS section, rk AS rank, * EXCLUDE (rk) FROM br WHERE rk <= 5
 UNION ALL BY NAME SELECT primary_category AS section, category_rank AS rank, * EXCLUDE (category_rank) FROM fc WHERE category_rank <= 3)
SELECT section, rank, {_LINE} AS line FROM lines""")
def _report(spark, sf):
    return monitor.monitor_report(raw_like(spark, sf))


# ---------------------------------------------------------------- quality

_GEO_MISSING = "action_geo_country_code IS NULL AND action_geo_lat IS NULL AND action_geo_long IS NULL"
_UNKNOWN = "action_geo_country_code IS NULL OR country_name = 'Unknown'"
_COUNTERS = f"""count_if(NOT "drop" AND actor1_name IS NULL AND actor2_name IS NULL) AS missing_actor_count,
 count_if(NOT "drop" AND {_GEO_MISSING}) AS missing_geo_count, count_if(NOT "drop" AND ({_UNKNOWN})) AS unknown_country_count"""


@query("flag_histogram", f"""WITH {q.VALID_SQL}, f AS (SELECT unnest(string_split(quality_flags, ',')) AS flag FROM valid
 WHERE quality_flags <> '') SELECT flag, count(*) AS flag_count FROM f GROUP BY ALL""")
def _flag_histogram(spark, sf):
    return quality.flag_histogram(validated_events(spark, sf))


@query("batch_quality_summary", f"WITH {q.VALID_SQL}, c AS (SELECT {_COUNTERS} FROM valid) "
       "SELECT " + ", ".join(f"CAST({c} AS BIGINT) AS {c}" for c in
                             ("missing_actor_count", "missing_geo_count", "unknown_country_count")) + " FROM c")
def _summary(spark, sf):
    return quality.batch_quality(validated_events(spark, sf))


@query("category_histogram", f'WITH {q.VALID_SQL} SELECT primary_category AS category, count(*) AS category_count FROM valid '
                             'WHERE NOT "drop" GROUP BY ALL')
def _category_histogram(spark, sf):
    return quality.category_histogram(validated_events(spark, sf))


def _pct(count: str) -> str:
    return f"round({count}_count / CAST(total_events AS DOUBLE) * 100, 6) AS {count}_pct"


_AUDIT = f"""audit AS (SELECT export_time_utc, total_events, {_pct('missing_actor')}, {_pct('missing_geo')},
 {_pct('unknown_country')} FROM (SELECT export_time_utc, count(*) AS total_events, {_COUNTERS} FROM valid GROUP BY export_time_utc))"""


@query("quality_audit", f"WITH {q.VALID_SQL}, {_AUDIT} SELECT CAST(export_time_utc AS TIMESTAMP) AS export_time_utc, "
       f"{NOW} AS run_timestamp, * EXCLUDE (export_time_utc) FROM audit")
def _audit(spark, sf):
    audit = quality.quality_audit(validated_events(spark, sf), AS_OF, by=["export_time_utc"])
    return audit.withColumns({c: F.round(c, 6) for c in ("missing_actor_pct", "missing_geo_pct", "unknown_country_pct")})


@query("append_quality_audit", f"""WITH {q.VALID_SQL}, a AS (SELECT count(*) AS total_events, {_COUNTERS} FROM valid)
SELECT {NOW} AS run_timestamp, total_events, {_pct('missing_actor')}, {_pct('missing_geo')}, {_pct('unknown_country')} FROM a""")
def _audit_row(spark, sf):
    audit = quality.quality_audit(validated_events(spark, sf), AS_OF)
    return audit.withColumns({c: F.round(c, 6) for c in ("missing_actor_pct", "missing_geo_pct", "unknown_country_pct")})


@query("quality_warnings", f"""WITH {q.VALID_SQL}, {_AUDIT}
SELECT 'high_missing_actor_percent' AS reason, missing_actor_pct AS value, CAST(35 AS DOUBLE) AS threshold FROM audit WHERE missing_actor_pct > 35
UNION ALL SELECT 'high_missing_geo_percent', missing_geo_pct, 45 FROM audit WHERE missing_geo_pct > 45
UNION ALL SELECT 'high_unknown_country_percent', unknown_country_pct, 30 FROM audit WHERE unknown_country_pct > 30""")
def _warnings(spark, sf):
    audit = quality.quality_audit(validated_events(spark, sf), AS_OF, by=["export_time_utc"])
    return quality.quality_warnings(audit).withColumn("value", F.round("value", 6))


# ---------------------------------------------------------------- country diagnostics and repairs

def _dirty(spark, sf):
    """A query table from before the codes were cleaned: raw codes, names only for a third of the rows."""
    events = with_country_name(raw_like(spark, sf), "ActionGeo_CountryCode", "mapped")
    return events.select(
        "event_id", F.lit("feed").alias("source"), F.col("event_id").cast("string").alias("dedupe_key"), "export_time_utc",
        "row_number", F.when(F.col("event_id") % 10 > 0, F.col("ActionGeo_CountryCode")).alias("country_code"),
        F.when(F.col("event_id") % 3 == 0, F.col("mapped")).otherwise(
            F.when(F.col("event_id") % 3 == 1, F.lit(" "))).alias("country_name"))


_DIRTY_SQL = f"""{RAW_SQL}, {q.COUNTRIES_SQL}, dirty AS (SELECT event_id, 'feed' AS source, CAST(event_id AS VARCHAR) AS dedupe_key,
 export_time_utc, row_number, CASE WHEN event_id % 10 > 0 THEN "ActionGeo_CountryCode" END AS country_code,
 CASE WHEN event_id % 3 = 0 THEN {q.country_name('"ActionGeo_CountryCode"')} WHEN event_id % 3 = 1 THEN ' ' END AS country_name FROM raw)"""


def _raw_twin(spark, sf):
    """The raw rows of the same events, whose codes are shifted against them."""
    events = raw_like(spark, sf)
    return events.select(
        F.lit("feed").alias("source"), F.col("event_id").cast("string").alias("dedupe_key"),
        F.when(F.col("event_id") % 4 > 0, F.col("ActionGeo_CountryCode")).otherwise(F.lit(" fra ")).alias("action_geo_country_code"))


_TWIN_SQL = """twin AS (SELECT 'feed' AS source, CAST(event_id AS VARCHAR) AS dedupe_key,
 CASE WHEN event_id % 4 > 0 THEN "ActionGeo_CountryCode" ELSE ' fra ' END AS action_geo_country_code FROM raw)"""
_CODE = q.country_code("country_code")


@query("country_code_counts", f"WITH {_DIRTY_SQL} SELECT country_code, count(*) AS count FROM dirty GROUP BY ALL")
def _code_counts(spark, sf):
    return country_codes.code_counts(_dirty(spark, sf))


@query("distinct_values_counted", f"WITH {TABLE_SQL} SELECT country_code, count(*) AS count FROM nt GROUP BY ALL")
def _stored_code_counts(spark, sf):
    return country_codes.code_counts(_table_like(spark, sf))


_VARIANTS = """SELECT country_code AS raw_value, upper(trim(country_code)) AS normalized_value,
 length(country_code) AS raw_length, count(*) AS count FROM dirty WHERE country_code IS NOT NULL GROUP BY ALL"""


@query("country_code_variants", f"WITH {_DIRTY_SQL} {_VARIANTS}")
def _variants(spark, sf):
    return country_codes.code_variants(_dirty(spark, sf))


_BUCKET = f"""CASE WHEN country_code IS NULL THEN 'null' WHEN upper(trim(country_code)) IN ({q.quoted(fv.UNKNOWN_CODE_TEXTS)})
 THEN 'unknown_variant' WHEN regexp_matches(upper(trim(country_code)), '^[A-Z]{{2,3}}$') THEN 'valid_code' ELSE 'invalid_other' END"""


@query("country_code_buckets", f"WITH {_DIRTY_SQL} SELECT {_BUCKET} AS bucket, count(*) AS count FROM dirty GROUP BY ALL")
def _buckets(spark, sf):
    return country_codes.code_buckets(_dirty(spark, sf))


@query("group_by_expression", f"WITH {_DIRTY_SQL} SELECT {_BUCKET} AS bucket, upper(trim(country_code)) AS code, "
                              "length(country_code) AS code_length, count(*) AS count FROM dirty GROUP BY ALL")
def _group_expression(spark, sf):
    return _dirty(spark, sf).groupBy(
        country_codes.code_bucket("country_code").alias("bucket"), F.upper(F.trim("country_code")).alias("code"),
        F.length("country_code").alias("code_length")).agg(F.count("*").alias("count"))


_SIDE = """SELECT d.source, d.dedupe_key, d.country_code AS normalized_country, t.action_geo_country_code AS raw_country,
 upper(trim(d.country_code)) AS normalized_country_clean, upper(trim(t.action_geo_country_code)) AS raw_country_clean
 FROM dirty d JOIN twin t USING (source, dedupe_key) WHERE d.country_code IS DISTINCT FROM t.action_geo_country_code
 ORDER BY d.export_time_utc DESC, d.row_number DESC LIMIT"""


@query("country_raw_vs_normalized", f"WITH {_DIRTY_SQL}, {_TWIN_SQL} {_SIDE} 200")
def _side_by_side(spark, sf):
    return country_codes.raw_versus_normalized(_raw_twin(spark, sf), _dirty(spark, sf))


@query("join_raw_normalized", f"WITH {_DIRTY_SQL}, {_TWIN_SQL} {_SIDE} 1000")
def _raw_normalized(spark, sf):
    return country_codes.raw_versus_normalized(_raw_twin(spark, sf), _dirty(spark, sf), limit=1000)


_LETTERS = "regexp_matches(upper(trim({})), '^[A-Z]{{2,3}}$')"
_COVERAGE = f"""SELECT CAST(total_raw AS BIGINT) AS total_raw, CAST(raw_valid_country AS BIGINT) AS raw_valid_country,
 CAST(total_norm AS BIGINT) AS total_norm, CAST(norm_valid_country AS BIGINT) AS norm_valid_country FROM
 (SELECT count(*) AS total_raw, count(*) FILTER (WHERE {_LETTERS.format('action_geo_country_code')}) AS raw_valid_country FROM twin),
 (SELECT count(*) AS total_norm, count(*) FILTER (WHERE {_LETTERS.format('country_code')}) AS norm_valid_country FROM dirty)"""


@query("country_coverage", f"WITH {_DIRTY_SQL}, {_TWIN_SQL} {_COVERAGE}")
def _country_coverage(spark, sf):
    return country_codes.coverage(_raw_twin(spark, sf), _dirty(spark, sf))


@query("cross_join_singletons", f"WITH {_DIRTY_SQL}, {_TWIN_SQL} {_COVERAGE}")
def _singletons(spark, sf):
    return country_codes.coverage(_raw_twin(spark, sf), _dirty(spark, sf))


@query("filtered_counts", f"""WITH {_DIRTY_SQL} SELECT count(*) AS total_norm,
 CAST(count(*) FILTER (WHERE {_LETTERS.format('country_code')}) AS BIGINT) AS norm_valid_country FROM dirty""")
def _filtered(spark, sf):
    letters = F.upper(F.trim("country_code")).rlike(r"^[A-Z]{2,3}\z")
    return _dirty(spark, sf).agg(F.count("*").alias("total_norm"), F.count_if(letters).alias("norm_valid_country"))


_STEP1 = f"s1 AS (SELECT *, {_CODE} AS code1, country_code IS DISTINCT FROM ({_CODE}) AS changed1 FROM dirty)"
_FILL = f"s1.code1 IS NULL AND ({q.country_code('t.action_geo_country_code')}) IS NOT NULL"


@query("backfill_country_code", f"""WITH {_DIRTY_SQL}, {_TWIN_SQL}, {_STEP1}
SELECT s1.event_id, CASE WHEN {_FILL} THEN {q.country_code('t.action_geo_country_code')} ELSE s1.code1 END AS country_code,
 s1.changed1 OR ({_FILL}) AS changed FROM s1 LEFT JOIN twin t USING (source, dedupe_key)""")
def _backfill(spark, sf):
    rows = country_codes.backfill_country_codes(_dirty(spark, sf), _raw_twin(spark, sf))
    return rows.select("event_id", "country_code", F.col("_changed").alias("changed"))


@query("update_from_join", f"""WITH {_DIRTY_SQL}, {_TWIN_SQL}
SELECT d.event_id, CASE WHEN ({q.country_code('d.country_code')}) IS NULL AND ({q.country_code('t.action_geo_country_code')}) IS NOT NULL
 THEN {q.country_code('t.action_geo_country_code')} ELSE d.country_code END AS country_code
FROM dirty d LEFT JOIN twin t USING (source, dedupe_key)""")
def _update_from_join(spark, sf):
    rows = country_codes.fill_codes_from_raw(_dirty(spark, sf), _raw_twin(spark, sf))
    return rows.select("event_id", "country_code")


@query("backfill_country_name", f"""WITH {_DIRTY_SQL}
SELECT event_id, CASE WHEN country_name IS NULL OR trim(country_name) = '' OR country_name = 'Unknown'
 THEN {q.country_name('country_code')} ELSE country_name END AS country_name FROM dirty""")
def _backfill_names(spark, sf):
    return country_codes.backfill_country_names(_dirty(spark, sf)).select("event_id", "country_name")
