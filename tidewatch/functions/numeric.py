"""Number expressions: tolerant parsing, clamping, pair checks, exact ratios and rounding."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidewatch import fixed_values as fv

ColumnOrName = Column | str


def _text(c: ColumnOrName) -> Column:
    from tidewatch.functions.text import clean_text

    return clean_text(c)


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_decimal(c: ColumnOrName) -> Column:
    """Exact number or NULL; exponents are read, 'NaN' and 'Infinity' give NULL."""
    return _text(c).try_cast("decimal(38,18)")


def parse_int(c: ColumnOrName) -> Column:
    """64-bit integer or NULL; '+7' is 7, '7.0' is NULL."""
    return _text(c).try_cast("bigint")


def parse_float_or_zero(c: ColumnOrName) -> Column:
    return F.coalesce(_text(c).try_cast("double"), F.lit(0.0))


def clamp_tone(c: ColumnOrName) -> Column:
    """Tone limited to -20 .. 20; NULL stays NULL."""
    tone, limit = _col(c), F.lit(fv.TONE_LIMIT)
    return F.when(tone.isNotNull(), F.greatest(F.least(tone, limit), -limit))


def tone_flag(c: ColumnOrName) -> Column:
    tone = _col(c)
    return (
        F.when(tone.isNull(), "missing_tone")
        .when(tone < -fv.TONE_LIMIT, "tone_clamped_low")
        .when(tone > fv.TONE_LIMIT, "tone_clamped_high")
    )


def is_partial_geo(lat: ColumnOrName, lon: ColumnOrName) -> Column:
    return _col(lat).isNull() != _col(lon).isNull()


def is_geo_out_of_range(lat: ColumnOrName, lon: ColumnOrName) -> Column:
    """True when both are given and one lies outside its inclusive bounds."""
    outside = (F.abs(_col(lat)) > fv.LATITUDE_LIMIT) | (F.abs(_col(lon)) > fv.LONGITUDE_LIMIT)
    return F.coalesce(_col(lat).isNotNull() & _col(lon).isNotNull() & outside, F.lit(False))


def geo_pair(lat: ColumnOrName, lon: ColumnOrName) -> tuple[Column, Column]:
    """Both coordinates, or NULL for both when the pair is partial or out of range."""
    usable = ~is_partial_geo(lat, lon) & ~is_geo_out_of_range(lat, lon)
    return F.when(usable, _col(lat)), F.when(usable, _col(lon))


def safe_divide(x: ColumnOrName, y: ColumnOrName) -> Column:
    """``x / y``, NULL for a zero divisor."""
    return _col(x) / F.nullif(_col(y), F.lit(0).cast("double"))


def round_half_up(c: ColumnOrName, digits: int) -> Column:
    """Decimal rounding, half away from zero, of a value first fixed to nine places."""
    return F.round(_col(c).cast("decimal(38,9)"), digits)


def percent_text(count: ColumnOrName, total: ColumnOrName) -> Column:
    """``12.34%``; ``0.00%`` without a positive total."""
    count, total = _col(count), _col(total)
    share = F.when(total > 0, count.cast("double") / F.nullif(total, F.lit(0).cast("bigint")) * 100)
    return F.format_string("%.2f%%", F.coalesce(share, F.lit(0.0)))


def first_not_null(*columns: ColumnOrName) -> Column:
    return F.coalesce(*[_col(c) for c in columns])


def location_wkt(lat: ColumnOrName, lon: ColumnOrName) -> Column:
    """``POINT(longitude latitude)`` text, NULL unless both coordinates are present."""
    lat, lon = _col(lat), _col(lon)
    text = F.concat(F.lit("POINT("), lon.cast("string"), F.lit(" "), lat.cast("string"), F.lit(")"))
    return F.when(lat.isNotNull() & lon.isNotNull(), text)


EARTH_KILOMETRES = 6371.0088


def _spread(x: Column) -> Column:
    """The 16 bits of ``x`` with a free place after each."""
    for shift, mask in ((8, 0x00FF00FF), (4, 0x0F0F0F0F), (2, 0x33333333), (1, 0x55555555)):
        x = x.bitwiseOR(F.shiftleft(x, shift)).bitwiseAND(F.lit(mask).cast("bigint"))
    return x


def location_key(lat: ColumnOrName, lon: ColumnOrName) -> Column:
    """Place of a point on a curve that keeps near points together (bits of longitude and latitude in turn); rows that are
    sorted by it lie in files and row groups of small boxes. NULL unless both coordinates are present."""
    def part(value: Column, low: int, span: int) -> Column:
        share = (value.cast("double") - low) / span
        return F.greatest(F.least(F.floor(share * 65_536), F.lit(65_535).cast("bigint")), F.lit(0).cast("bigint"))

    return F.shiftleft(_spread(part(_col(lon), -180, 360)), 1).bitwiseOR(_spread(part(_col(lat), -90, 180)))


def kilometres(lat: ColumnOrName, lon: ColumnOrName, from_lat: float, from_lon: float) -> Column:
    """Great-circle distance to a point, on a sphere of the mean radius."""
    a, b = (F.radians(_col(x).cast("double")) for x in (lat, lon))
    c, d = math.radians(from_lat), math.radians(from_lon)
    half = F.pow(F.sin((a - F.lit(c)) / 2), 2) + F.cos(a) * F.lit(math.cos(c)) * F.pow(F.sin((b - F.lit(d)) / 2), 2)
    return 2 * EARTH_KILOMETRES * F.asin(F.sqrt(F.least(half, F.lit(1.0))))


def location_point(lat: ColumnOrName, lon: ColumnOrName) -> Column:
    lat, lon = _col(lat), _col(lon)
    point = F.struct(lon.alias("longitude"), lat.alias("latitude"))
    return F.when(lat.isNotNull() & lon.isNotNull(), point)
