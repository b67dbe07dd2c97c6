"""Lookups of codes: country names, event labels and translation tiers."""

from __future__ import annotations

from collections.abc import Mapping
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch import fixed_values as fv
from tidewatch.functions.text import ColumnOrName, clean_text, code_root, col, strip


@lru_cache
def country_codes() -> dict[str, str]:
    """Code to country name; a later country wins a shared code."""
    return {code: name for name, codes in fv.COUNTRY_CODES.items() for code in codes}


def country_dimension(spark: SparkSession) -> DataFrame:
    """The lookup as a table of unique codes. It is a fixed list, a few kilobytes at any data size."""
    names = country_codes()
    return spark.createDataFrame(pa.table({"code": list(names), "known_name": list(names.values())}))


def with_country_name(df: DataFrame, code: ColumnOrName, out: str = "country_name") -> DataFrame:
    """Add the country name of a code, ``Unknown`` where there is none: a hash lookup in the broadcast fixed list."""
    dimension = country_dimension(df.sparkSession).withColumnRenamed("code", "_lookup_code")
    return (
        df.join(F.broadcast(dimension), F.upper(strip(code)) == F.col("_lookup_code"), "left")
        .withColumn(out, F.coalesce(F.col("known_name"), F.lit(fv.UNKNOWN)))
        .drop("_lookup_code", "known_name")
    )


def text_map(entries: Mapping[str, str]) -> Column:
    return F.create_map(*[F.lit(part) for entry in entries.items() for part in entry])


def event_label(c: ColumnOrName) -> Column:
    """Label of the exact code, else of its two-digit root, else ``Unknown event``."""
    code = F.coalesce(col(c), F.lit(""))
    return F.coalesce(
        F.try_element_at(text_map(fv.EVENT_LABELS), code),
        F.try_element_at(text_map(fv.ROOT_LABELS), code_root(code)),
        F.lit(fv.UNKNOWN_EVENT_LABEL),
    )


def translation_tier(c: ColumnOrName) -> Column:
    """``exact``, ``root`` or ``unknown``: how well an event code can be labelled."""
    code = clean_text(c)
    return (
        F.when(code.isin(list(fv.EVENT_LABELS)), "exact")
        .when(code_root(code).isin(list(fv.ROOT_LABELS)), "root")
        .otherwise("unknown")
    )


def root_category(c: ColumnOrName) -> Column:
    """Category of a code's two-digit root, else NULL."""
    return F.try_element_at(text_map(fv.ROOT_CATEGORY), code_root(c))
