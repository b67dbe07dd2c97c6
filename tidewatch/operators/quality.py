"""Load-time quality counters, audit rows and warnings."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch import fixed_values as fv
from tidewatch.functions.flags import missing_actor_at_load, missing_geo_at_load, unknown_country_at_load
from tidewatch.functions.times import age_seconds, moment_literal


def flag_histogram(validated: DataFrame) -> DataFrame:
    """Rows per validation flag, dropped rows included."""
    flags = validated.select(F.explode("quality_flags").alias("flag"))
    return flags.groupBy("flag").agg(F.count("*").alias("flag_count"))


def quality_counters(counted: Column) -> list[Column]:
    """The three load-time counters over the rows where ``counted`` holds."""
    return [
        F.count_if(counted & missing_actor_at_load("actor1_name", "actor2_name")).alias("missing_actor_count"),
        F.count_if(counted & missing_geo_at_load("action_geo_country_code", "action_geo_lat", "action_geo_long"))
        .alias("missing_geo_count"),
        F.count_if(counted & unknown_country_at_load("action_geo_country_code", "country_name"))
        .alias("unknown_country_count"),
    ]


def batch_quality(validated: DataFrame) -> DataFrame:
    """One row of counters over the surviving rows."""
    return validated.agg(*quality_counters(~F.col("drop")))


def category_histogram(validated: DataFrame) -> DataFrame:
    category = F.coalesce(F.nullif("primary_category", F.lit("")), F.lit("unknown"))
    kept = validated.filter(~F.col("drop"))
    return kept.groupBy(category.alias("category")).agg(F.count("*").alias("category_count"))


def _percent(count: str, total: str) -> Column:
    share = F.col(count).cast("double") / F.nullif(F.col(total), F.lit(0).cast("bigint")) * 100
    return F.coalesce(share, F.lit(0.0))


def quality_audit(validated: DataFrame, as_of: datetime | str, by: list[str] | None = None) -> DataFrame:
    """Percentages of surviving rows over all rows seen, one row in total or per group (such as per export)."""
    counts = validated.groupBy(*(by or [])).agg(F.count("*").alias("total_events"), *quality_counters(~F.col("drop")))
    return audit_rows(counts, as_of, by)


def audit_rows(counts: DataFrame, as_of: datetime | str, by: list[str] | None = None) -> DataFrame:
    """Audit rows from ``total_events`` and the three counters; other columns of ``by`` are kept."""
    return counts.select(
        *(by or [c for c in counts.columns if c in ("source", "export_time_utc")]),
        moment_literal(as_of).alias("run_timestamp"),
        "total_events",
        *[_percent(f"{name}_count", "total_events").alias(f"{name}_pct")
          for name in ("missing_actor", "missing_geo", "unknown_country")],
    )


def load_histograms(validated: DataFrame, as_of: datetime | str) -> DataFrame:
    """Per export, how often each flag was set and each category given to a surviving row (``kind``, ``value``, ``n``)."""
    def entry(kind: str, value: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), value.alias("value"))

    flags = F.transform("quality_flags", lambda flag: entry("validation_flag", flag))
    category = F.when(~F.col("drop"), F.array(entry("category", F.col("primary_category"))))
    entries = F.concat(F.coalesce(flags, F.array().cast("array<struct<kind:string,value:string>>")), F.coalesce(category, F.array().cast("array<struct<kind:string,value:string>>")))
    rows = validated.select("source", "export_time_utc", F.inline(entries))
    counted = rows.groupBy("source", "export_time_utc", "kind", "value").agg(F.count("*").alias("n"))
    return counted.withColumn("run_timestamp", moment_literal(as_of))


def quality_warnings(audit: DataFrame, parse_errors: Column | int = 0, keep: list[str] | None = None) -> DataFrame:
    """One row per limit exceeded (strictly), with the value and the limit; any parse error also warns."""
    limits = {
        "missing_actor": fv.MISSING_ACTOR_WARNING_PCT,
        "missing_geo": fv.MISSING_GEO_WARNING_PCT,
        "unknown_country": fv.UNKNOWN_COUNTRY_WARNING_PCT,
    }

    def warning(condition: Column, reason: str, value: Column, limit: float) -> Column:
        return F.when(condition, F.struct(
            F.lit(reason).alias("reason"), value.cast("double").alias("value"), F.lit(float(limit)).alias("threshold")
        ))

    checks = [warning(F.col(f"{name}_pct") > limit, f"high_{name}_percent", F.col(f"{name}_pct"), limit)
              for name, limit in limits.items()]
    errors = parse_errors if isinstance(parse_errors, Column) else F.lit(parse_errors)
    checks.append(warning(errors > 0, "parse_errors", errors, 0))
    return audit.select(*(keep or []), F.inline(F.array_compact(F.array(*checks))))


def load_metrics(outcomes: DataFrame, as_of: datetime | str, by: list[str] | None = None) -> DataFrame:
    """Counters of a load from rows labelled with ``outcome``: inserted, duplicate, dropped or parse_error.

    Parse errors are counted on their own: they are in neither the rows seen nor the rows dropped.
    """
    def rows(label: str) -> Column:
        return F.count_if(F.col("outcome") == label)

    seen = F.count_if(F.col("outcome") != "parse_error")
    return outcomes.groupBy(*(by or [])).agg(
        seen.alias("rows_seen"),
        rows("inserted").alias("rows_inserted"),
        F.greatest(seen - rows("inserted") - rows("dropped"), F.lit(0).cast("bigint")).alias("rows_duplicated"),
        rows("dropped").alias("rows_dropped"),
        rows("parse_error").alias("parse_errors"),
        rows("inserted").alias("normalized_inserted"),
        age_seconds(F.max("export_time_utc"), as_of).alias("export_lag_seconds"),
    )
