"""Table rules: value ranges, unique keys, references and the effects of deletes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch import fixed_values as fv
from tidewatch.operators.dedupe import EVENT_KEY, first_per_key
from tidewatch.operators.ledger import best_checkpoints


def normalized_rules() -> dict[str, Column]:
    """Rules of the query table; a row breaks a rule when it is false, NULL satisfies the optional ones."""
    return {
        "primary_category": F.coalesce(F.col("primary_category").isin(fv.PRIMARY_CATEGORIES), F.lit(False)),
        "secondary_category": F.col("secondary_category").isNull()
        | F.col("secondary_category").isin(fv.SECONDARY_CATEGORIES),
        "confidence_range": F.coalesce(F.col("category_confidence").between(0, 1), F.lit(False)),
        "latitude_range": F.col("latitude").isNull() | F.col("latitude").between(-fv.LATITUDE_LIMIT, fv.LATITUDE_LIMIT),
        "longitude_range": F.col("longitude").isNull()
        | F.col("longitude").between(-fv.LONGITUDE_LIMIT, fv.LONGITUDE_LIMIT),
    }


def check_constraints(normalized: DataFrame) -> DataFrame:
    """Violations per rule, in one scan."""
    rules = normalized_rules()
    counts = normalized.agg(*[F.count_if(~rule).alias(name) for name, rule in rules.items()])
    pairs = [F.struct(F.lit(name).alias("rule"), F.col(name).alias("violations")) for name in rules]
    return counts.select(F.inline(F.array(*pairs)))


def enforce_constraints(normalized: DataFrame) -> DataFrame:
    """The same rows; reading a violating one fails the job and names the rule."""
    broken = F.concat_ws(", ", *[F.when(~rule, F.lit(name)) for name, rule in normalized_rules().items()])
    message = F.concat(F.lit("constraint violated: "), broken)
    return normalized.filter(F.when(broken == "", F.lit(True)).otherwise(F.raise_error(message).cast("boolean")))


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once. Counts are combined per task first, so hot keys do no harm."""
    return df.groupBy(*keys).agg(F.count("*").alias("copies")).filter("copies > 1")


def orphans(child: DataFrame, parent: DataFrame, on: list[tuple[str, str]]) -> DataFrame:
    """Child rows without a parent; ``on`` pairs child and parent columns. NULL references are not checked."""
    keys = parent.select(*[F.col(p).alias(f"_{c}") for c, p in on]).distinct()
    given = [F.col(c).isNotNull() for c, _ in on]
    match = [F.col(c) == F.col(f"_{c}") for c, _ in on]
    checked = child
    for condition in given:
        checked = checked.filter(condition)
    condition = match[0]
    for part in match[1:]:
        condition = condition & part
    return checked.join(keys, condition, "left_anti")


def check_references(child: DataFrame, parent: DataFrame, on: list[tuple[str, str]]) -> DataFrame:
    """Number of child rows whose reference has no parent, counted per reference before the join."""
    columns = [c for c, _ in on]
    references = child.groupBy(*columns).agg(F.count("*").alias("_rows"))
    return orphans(references, parent, on).agg(F.coalesce(F.sum("_rows"), F.lit(0)).alias("orphans"))


def cascade_delete(children: DataFrame, deleted: DataFrame, on: tuple[str, str] = ("ingestion_run_id", "id")) -> DataFrame:
    """Children that remain when the rows in ``deleted`` go."""
    child, parent = on
    keys = deleted.select(F.col(parent).alias(child)).distinct()
    return children.join(keys, child, "left_anti")


def keep_first_raw(raw: DataFrame, order: list[str]) -> DataFrame:
    """Raw rows after collapsing duplicates to the first one stored."""
    return first_per_key(raw, EVENT_KEY, [F.asc(name) for name in order])


def collapse_duplicates(
    checkpoints: DataFrame, raw: DataFrame, normalized: DataFrame, order: list[str], row_id: list[str]
) -> dict[str, DataFrame]:
    """Repair tables that were filled before keys were enforced.

    The best checkpoint and the first raw row per key stay, and normalized rows go with the raw row they came from
    (``row_id`` names the columns that identify a raw row in both tables).
    """
    kept = keep_first_raw(raw, order)
    return {
        "checkpoints": best_checkpoints(checkpoints),
        "raw_events": kept,
        "normalized_events": normalized.join(kept.select(*row_id), row_id, "left_semi"),
    }
