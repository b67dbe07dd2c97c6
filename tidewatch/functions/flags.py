"""Flag lists, payload JSON and the quality predicates that reports and loads share."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidewatch import fixed_values as fv
from tidewatch.functions.text import ColumnOrName, blank_to_default, canonical_code, col, is_blank


def collect_flags(*flags: Column) -> Column:
    """Array of the non-NULL flags, in the given order. Flag names hold no comma, so the array passes through text."""
    joined = F.concat_ws(",", *flags)
    return F.when(joined == "", F.array().cast("array<string>")).otherwise(F.split(joined, ","))


def flag_if(condition: Column, flag: str) -> Column:
    return F.when(condition, F.lit(flag))


def flags_to_text(c: ColumnOrName, default: str = "validation_drop") -> Column:
    return F.coalesce(F.nullif(F.array_join(col(c), ", "), F.lit("")), F.lit(default))


def payload_json(payload: ColumnOrName) -> Column:
    """JSON text of a payload struct with empty fields kept."""
    return F.to_json(col(payload), {"ignoreNullFields": "false"})


def payload_field(payload: ColumnOrName, field: str) -> Column:
    return F.get_json_object(col(payload), f"$.{field}")


def missing_actor_in_table(actor1: ColumnOrName, actor2: ColumnOrName) -> Column:
    return is_blank(actor1) & is_blank(actor2)


def missing_geo_in_table(code: ColumnOrName, lat: ColumnOrName, lon: ColumnOrName) -> Column:
    return canonical_code(code).isNull() & col(lat).isNull() & col(lon).isNull()


def unknown_country_in_table(name: ColumnOrName) -> Column:
    return blank_to_default(name) == fv.UNKNOWN


def _empty(c: ColumnOrName) -> Column:
    return F.coalesce(col(c), F.lit("")) == ""


def missing_actor_at_load(actor1: ColumnOrName, actor2: ColumnOrName) -> Column:
    return _empty(actor1) & _empty(actor2)


def missing_geo_at_load(code: ColumnOrName, lat: ColumnOrName, lon: ColumnOrName) -> Column:
    return _empty(code) & col(lat).isNull() & col(lon).isNull()


def unknown_country_at_load(code: ColumnOrName, name: ColumnOrName) -> Column:
    return _empty(code) | F.coalesce(col(name) == fv.UNKNOWN, F.lit(False))
