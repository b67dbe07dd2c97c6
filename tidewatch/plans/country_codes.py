"""Country-code diagnostics and repairs over the raw and the query table, joined on ``(source, dedupe_key)``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch import fixed_values as fv
from tidewatch.functions.lookup import country_dimension
from tidewatch.functions.text import ColumnOrName, canonical_code, col, is_blank, trimmed_upper
from tidewatch.operators.dedupe import EVENT_KEY
from tidewatch.sources.tables import EventTables


def code_counts(normalized: DataFrame) -> DataFrame:
    counts = normalized.groupBy("country_code").agg(F.count("*").alias("count"))
    return counts.orderBy(F.desc("count"), F.asc_nulls_last("country_code"))


def code_variants(normalized: DataFrame) -> DataFrame:
    """Spelling variants. Rows are counted per stored value; the derived columns follow from it."""
    counts = normalized.filter(F.col("country_code").isNotNull()).groupBy("country_code").agg(F.count("*").alias("count"))
    return counts.select(
        F.col("country_code").alias("raw_value"),
        trimmed_upper("country_code").alias("normalized_value"),
        F.length("country_code").alias("raw_length"),
        "count",
    ).orderBy(F.desc("count"), F.asc("raw_value"))


def code_bucket(c: ColumnOrName) -> Column:
    upper = trimmed_upper(c)
    return (
        F.when(col(c).isNull(), "null")
        .when(upper.isin(fv.UNKNOWN_CODE_TEXTS), "unknown_variant")
        .when(upper.rlike(r"^[A-Z]{2,3}\z"), "valid_code")
        .otherwise("invalid_other")
    )


def code_buckets(normalized: DataFrame) -> DataFrame:
    buckets = normalized.groupBy(code_bucket("country_code").alias("bucket")).agg(F.count("*").alias("count"))
    return buckets.orderBy(F.desc("count"), F.asc("bucket"))


def raw_versus_normalized(
    raw: DataFrame, normalized: DataFrame, limit: int = 200, newest: list[str] | None = None
) -> DataFrame:
    """The newest events whose stored code differs from the raw one, NULLs compared as values."""
    newest = newest or ["export_time_utc", "row_number"]
    pairs = normalized.join(raw.select(*EVENT_KEY, "action_geo_country_code"), EVENT_KEY)
    differing = pairs.filter(~F.col("country_code").eqNullSafe(F.col("action_geo_country_code")))
    return differing.orderBy(*[F.desc(name) for name in newest]).limit(limit).select(
        *EVENT_KEY,
        F.col("country_code").alias("normalized_country"),
        F.col("action_geo_country_code").alias("raw_country"),
        trimmed_upper("country_code").alias("normalized_country_clean"),
        trimmed_upper("action_geo_country_code").alias("raw_country_clean"),
    )


def coverage(raw: DataFrame, normalized: DataFrame) -> DataFrame:
    """Totals and valid codes of both tables. Here a code is valid by its letters alone, so 'NA' counts."""
    def summary(df: DataFrame, code: str, total: str, valid: str) -> DataFrame:
        letters = trimmed_upper(code).rlike(r"^[A-Z]{2,3}\z")
        return df.agg(F.count("*").alias(total), F.count_if(letters).alias(valid))

    left = summary(raw, "action_geo_country_code", "total_raw", "raw_valid_country")
    right = summary(normalized, "country_code", "total_norm", "norm_valid_country")
    both = left.unionByName(right, allowMissingColumns=True)  # one row each, side by side without a join
    return both.agg(*[F.max(name).alias(name) for name in both.columns])


def canonicalize_codes(normalized: DataFrame) -> DataFrame:
    """Repair step 1: canonical codes in place; ``_changed`` marks rewritten rows."""
    canonical = canonical_code("country_code")
    changed = ~F.col("country_code").eqNullSafe(canonical)
    return normalized.withColumns({"_changed": changed, "country_code": canonical})


def fill_codes_from_raw(normalized: DataFrame, raw: DataFrame) -> DataFrame:
    """Repair step 2: take the raw row's code where it is valid and the own one is missing or invalid.

    Only rows without a valid code go into the join, against raw rows with one, which are unique by key; all others pass
    without a shuffle. The frame is read twice: give a stored one, or one that is cheap to derive.
    """
    marked = normalized if "_changed" in normalized.columns else normalized.withColumn("_changed", F.lit(False))
    needy = canonical_code("country_code").isNull()
    from_raw = raw.select(*EVENT_KEY, canonical_code("action_geo_country_code").alias("_raw_code"))
    joined = marked.filter(needy).join(from_raw.filter("_raw_code is not null"), EVENT_KEY, "left")
    filled = joined.withColumns({
        "_changed": F.col("_changed") | F.col("_raw_code").isNotNull(),
        "country_code": F.coalesce("_raw_code", "country_code"),
    })
    return marked.filter(~needy).unionByName(filled.drop("_raw_code"))


def backfill_country_codes(normalized: DataFrame, raw: DataFrame) -> DataFrame:
    """Both repair steps; rows keep their other columns and say in ``_changed`` whether the code was rewritten."""
    return fill_codes_from_raw(canonicalize_codes(normalized), raw)


def backfill_country_names(normalized: DataFrame) -> DataFrame:
    """Map the name from the code where the name is unknown, blank or missing; ``_changed`` marks rewritten rows."""
    dimension = country_dimension(normalized.sparkSession).withColumnRenamed("code", "_lookup_code")
    joined = normalized.join(F.broadcast(dimension), trimmed_upper("country_code") == F.col("_lookup_code"), "left")
    missing = is_blank("country_name") | (F.col("country_name") == fv.UNKNOWN)
    name = F.when(missing, F.coalesce("known_name", F.lit(fv.UNKNOWN))).otherwise(F.col("country_name"))
    changed = ~name.eqNullSafe(F.col("country_name"))
    return joined.withColumns({"_changed": changed, "country_name": name}).drop("_lookup_code", "known_name")


def repair_stored_countries(tables: EventTables) -> bool:
    """Both code repairs and then the names, written back to the query table; whether any row changed."""
    codes = tables.repair("normalized_events", backfill_country_codes(tables.read("normalized_events"), tables.read("raw_events")))
    names = tables.repair("normalized_events", backfill_country_names(tables.read("normalized_events")))
    return codes or names
