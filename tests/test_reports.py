from __future__ import annotations

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from contract import all_queries
from contract.adapters import AS_OF, normalized_like
from contract.check import compare
from tests.conftest import SF_DIR
from tests.helpers import one
from tidewatch.plans import analytics

NOW = datetime(2026, 3, 26, 12)
SCHEMA = "event_time_utc timestamp, primary_category string, country_name string"


def events(spark, *groups):
    rows = [(NOW - timedelta(hours=h), c, n) for h, c, n, copies in groups for _ in range(copies)]
    return spark.createDataFrame(rows, SCHEMA)


def test_every_query_has_an_oracle_and_agrees(spark):
    """The whole contract on the smallest data set."""
    assert set(all_queries.ORACLES) == set(all_queries.QUERIES)
    assert compare(spark, SF_DIR) == []


def test_flagship(spark):
    assert all_queries.flagship(spark, SF_DIR).count() == 7


def two_sided(frame, hours, days=15, min_count=10):
    """The same report as a join of two aggregates."""
    recent = analytics.recent(frame, NOW, hours).groupBy(F.col("primary_category").alias("category"), "country_name").agg(
        F.count("*").alias("recent_count")).filter(F.col("recent_count") >= min_count)
    stats = analytics.baseline_stats(analytics.daily_counts(frame, NOW, hours, days))
    return recent.join(stats, ["category", "country_name"]).select(
        "category", "country_name", "recent_count", "baseline_avg", "baseline_std")


@pytest.mark.parametrize("hours", [1, 24, 100, 359, 360, 400])
def test_one_pass_spikes_equal_the_join(spark, hours):
    frame = events(spark, (2, "a", "X", 30), (30, "a", "X", 10), (60, "a", "X", 20), (2, "b", "X", 12), (100, "c", "Y", 50),
                   (2, "d", "Z", 9), (300, "d", "Z", 5), (-5, "a", "X", 3))
    columns = ["category", "country_name", "recent_count", "baseline_avg", "baseline_std"]
    got = sorted(map(tuple, analytics.spike_scores(frame, NOW, hours).select(columns).collect()))
    assert got == sorted(map(tuple, two_sided(frame, hours).collect()))
    if hours >= 360:
        assert got == []


def test_flat_baseline_has_no_z_score_and_sorts_last(spark):
    frame = events(spark, (2, "flat", "X", 20), (40, "flat", "X", 10), (2, "spiky", "X", 20), (40, "spiky", "X", 10), (70, "spiky", "X", 4))
    rows = analytics.spikes(frame, NOW, 24).collect()
    assert [r.category for r in rows] == ["spiky", "flat"] and rows[1].z_score is None and rows[1].lift_ratio == 2


def test_empty_window_counts_zero_and_sums_null(spark):
    columns = SCHEMA + ", actor1_name string, actor2_name string, country_code string, latitude double, longitude double, category_reason string"
    row = one(analytics.stats_overview(spark.createDataFrame([], columns), NOW))
    assert row.total_events == 0 and row.missing_actor_count is None and row.unknown_country_count is None


def test_times_null_and_future(spark):
    frame = events(spark, (-3, "a", "X", 1), (0, "a", "X", 1)).unionByName(spark.createDataFrame([(None, "a", "X")], SCHEMA))
    assert analytics.recent(frame, NOW, 1).count() == 2
    assert analytics.recent(frame, NOW, 0).count() == 2  # at least one hour


def test_momentum_steady_state_is_a_third(spark):
    frame = events(spark, *[(h + 0.5, "a", "X", 1) for h in range(24)])
    row = one(analytics.momentum(frame, NOW, corrected=True))
    assert (row.c_3h, float(row.momentum_ratio), float(row.momentum_ratio_hourly)) == (3, 0.33, 1.0)


def test_filters_and_columns_reach_the_scan(spark):
    plan = analytics.spikes(normalized_like(spark, SF_DIR), AS_OF, 48)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(ts" in plan
    assert "value:double" not in plan
