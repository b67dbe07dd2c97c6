"""Time expressions. Nothing here reads a clock: every window hangs on an explicit ``as_of``."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch import fixed_values as fv
from tidewatch.functions.text import ColumnOrName, clean_text, col


def utc(moment: datetime | str) -> datetime:
    """The moment in UTC; values without a zone are taken to be UTC."""
    if isinstance(moment, str):
        moment = datetime.fromisoformat(moment)
    if moment.tzinfo is None:
        return moment.replace(tzinfo=timezone.utc)
    return moment.astimezone(timezone.utc)


def moment_literal(moment: datetime | str, dtype: T.DataType | None = None) -> Column:
    """A constant of the wanted timestamp type, so that comparisons with it reach the file scan."""
    text = utc(moment).strftime("%Y-%m-%d %H:%M:%S.%f")
    if isinstance(dtype, T.TimestampNTZType):
        return F.expr(f"TIMESTAMP_NTZ '{text}'")
    return F.expr(f"TIMESTAMP_LTZ '{text} UTC'")


def moment_for(df: DataFrame, column: str, moment: datetime | str) -> Column:
    return moment_literal(moment, df.schema[column].dataType)


def since(df: DataFrame, column: str, as_of: datetime | str, **span: float) -> Column:
    """``column >= as_of - span``; rows without a time do not qualify, later ones do."""
    return F.col(column) >= moment_for(df, column, utc(as_of) - timedelta(**span))


def before(df: DataFrame, column: str, as_of: datetime | str, **span: float) -> Column:
    return F.col(column) < moment_for(df, column, utc(as_of) - timedelta(**span))


def at_least_one(value: int) -> int:
    return max(int(value), 1)


def parse_sql_date(c: ColumnOrName) -> Column:
    """Date of strict ``yyyyMMdd`` text, else NULL."""
    text = clean_text(c)
    return F.when(text.rlike(r"^\d{8}\z"), F.try_to_timestamp(text, F.lit("yyyyMMdd"))).cast("date")


def parse_date_added(c: ColumnOrName) -> Column:
    """UTC time of strict ``yyyyMMddHHmmss`` text, else NULL."""
    text = clean_text(c)
    return F.when(text.rlike(r"^\d{14}\z"), F.try_to_timestamp(text, F.lit("yyyyMMddHHmmss")))


def event_time(date_added: ColumnOrName, sql_date: ColumnOrName, export_time: ColumnOrName) -> Column:
    """Time added, else midnight of the event date, else the export's time."""
    return F.coalesce(
        parse_date_added(date_added), parse_sql_date(sql_date).cast("timestamp"), col(export_time).cast("timestamp")
    )


def time_bucket(c: ColumnOrName, unit: str) -> Column:
    return F.date_trunc(unit, col(c))


def age_seconds(c: ColumnOrName, as_of: datetime | str) -> Column:
    """Whole seconds from the column's time to ``as_of``, never negative."""
    now = F.unix_micros(moment_literal(as_of))
    seconds = F.floor((now - F.unix_micros(col(c).cast("timestamp"))) / F.lit(1_000_000)).cast("bigint")
    return F.greatest(seconds, F.lit(0).cast("bigint"))


def format_utc(c: ColumnOrName) -> Column:
    return F.coalesce(F.date_format(col(c), "yyyy-MM-dd HH:mm 'UTC'"), F.lit(fv.UNKNOWN))


def is_future_outlier(c: ColumnOrName, as_of: datetime | str) -> Column:
    limit = moment_literal(utc(as_of) + timedelta(hours=fv.FUTURE_TOLERANCE_HOURS))
    return F.coalesce(col(c).cast("timestamp") > limit, F.lit(False))
