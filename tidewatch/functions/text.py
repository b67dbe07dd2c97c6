"""Text expressions: cleaning, case folding, codes, dedupe keys and display strings."""

from __future__ import annotations

import sys

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidewatch import fixed_values as fv
from tidewatch.functions.numeric import parse_int

ColumnOrName = Column | str

#: Every code point that Python treats as whitespace, derived by rule; Spark's own trim knows the space only.
WHITESPACE = "".join(ch for ch in map(chr, range(0x3001)) if ch.isspace())
_WHITESPACE_RUN = r"(?U)[\s\x1c-\x1f]+"

#: Lower-case characters whose full case folding differs from lower-casing (sharp s, final sigma, ligatures, ...).
_FOLDS = {
    ch: ch.casefold()
    for ch in map(chr, range(sys.maxunicode + 1))
    if ch.lower() == ch and ch.casefold() != ch
}
_SINGLE = {ch: to for ch, to in _FOLDS.items() if len(to) == 1}
_EXPANDING = " ".join(f"{ch}={to}" for ch, to in _FOLDS.items() if len(to) > 1)


def col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: ColumnOrName) -> Column:
    """Remove leading and trailing Unicode whitespace."""
    return F.btrim(col(c), F.lit(WHITESPACE))


def clean_text(c: ColumnOrName) -> Column:
    """Stripped text, NULL when nothing is left."""
    return F.nullif(strip(c), F.lit(""))


def casefold(c: ColumnOrName, *inputs: ColumnOrName) -> Column:
    """Full Unicode case folding: lower-casing, then the few characters that fold further.

    Text without characters beyond ASCII, by far the most common, takes the short way. ``inputs`` names the columns
    ``c`` is made of, so that the test need not compute ``c`` itself.
    """
    lowered = F.lower(col(c))
    single = F.translate(lowered, "".join(_SINGLE), "".join(_SINGLE.values()))
    folded = F.aggregate(
        F.split(F.lit(_EXPANDING), " "), single,
        lambda text, fold: F.replace(text, F.substring_index(fold, "=", 1), F.substring_index(fold, "=", -1)),
    )
    is_ascii = F.lit(True)
    for part in inputs or (c,):
        is_ascii = is_ascii & F.coalesce(F.length(col(part)) == F.octet_length(col(part)), F.lit(True))
    return F.when(is_ascii, lowered).otherwise(folded)


def normalize_text(c: ColumnOrName) -> Column:
    """Stripped, inner whitespace collapsed to one space, case-folded; empty text for NULL."""
    return F.coalesce(casefold(F.regexp_replace(strip(c), _WHITESPACE_RUN, " "), c), F.lit(""))


def clean_actor(c: ColumnOrName) -> Column:
    """Stripped actor name, NULL for blanks and placeholders."""
    text = clean_text(c)
    return F.when(~F.lower(text).isin(fv.UNKNOWN_ACTOR_TEXTS), text)


def _canonical_code(upper: Column) -> Column:
    return F.when(~upper.isin(fv.UNKNOWN_CODE_TEXTS) & upper.rlike(r"^[A-Z]{2,3}\z"), upper)


def normalize_country_code(c: ColumnOrName) -> Column:
    """Upper-case code of 2 or 3 letters, NULL for placeholders and anything else."""
    return _canonical_code(F.upper(strip(c)))


def canonical_code(c: ColumnOrName) -> Column:
    """The table-repair form of :func:`normalize_country_code`, which trims spaces only."""
    return _canonical_code(trimmed_upper(c))


def trimmed_upper(c: ColumnOrName) -> Column:
    return F.upper(F.trim(col(c)))


def valid_event_code(c: ColumnOrName) -> Column:
    """Stripped code; '' when missing, NULL when it is not two or three digits."""
    code = strip(F.coalesce(col(c), F.lit("")))
    return F.when((code == "") | code.rlike(r"(?U)^\d{2,3}\z"), code)


def is_bad_event_code(c: ColumnOrName) -> Column:
    return valid_event_code(c).isNull()


def text_blob(*fields: ColumnOrName) -> Column:
    """Fields joined by a space, folded, with every run of other characters than a-z and 0-9 made one space."""
    parts = [F.coalesce(strip(field), F.lit("")) for field in fields]
    return F.regexp_replace(casefold(F.concat_ws(" ", *parts), *fields), "[^a-z0-9]+", " ")


def any_keyword_pattern(keywords: list[str]) -> str:
    """One pattern that finds whether any keyword occurs, with alternatives grouped by first letter."""
    rests: dict[str, list[str]] = {}
    for keyword in keywords:
        rests.setdefault(keyword[0], []).append(keyword[1:])
    return "|".join(f"{first}(?:{'|'.join(rest)})" for first, rest in rests.items())


def first_keyword(blob: ColumnOrName, keywords: dict[str, str] | list[str]) -> Column:
    """First keyword, in declared order, that occurs anywhere in the text; NULL if none does.

    ``keywords`` may map each keyword to the value to give instead. Most texts hold none, which one pass decides.
    """
    values = keywords if isinstance(keywords, dict) else dict(zip(keywords, keywords, strict=True))
    found = F
    for keyword, value in values.items():
        found = found.when(col(blob).contains(keyword), F.lit(value))
    return F.when(col(blob).rlike(any_keyword_pattern(list(values))), found)


def blank_to_default(c: ColumnOrName, default: str = fv.UNKNOWN) -> Column:
    return F.coalesce(F.nullif(F.trim(col(c)), F.lit("")), F.lit(default))


def is_blank(c: ColumnOrName) -> Column:
    return F.coalesce(F.trim(col(c)), F.lit("")) == ""


def code_root(c: ColumnOrName) -> Column:
    return F.substring(col(c), 1, 2)


def dedupe_key(fields: dict[str, ColumnOrName] | None = None) -> Column:
    """Key of an event: its integer id if it has one, else a hash of nine normalised fields.

    ``fields`` maps the feed's field names to columns and defaults to columns of the same names.
    """
    fields = fields or {name: name for name in fv.FIELD_POSITIONS}
    event_id = parse_int(fields["GLOBALEVENTID"])
    parts = [normalize_text(fields[name]) for name in fv.COMPOSITE_KEY_FIELDS]
    digest = F.sha2(F.concat_ws("|", *parts), 256)
    return (
        F.when(event_id.isNotNull(), F.concat(F.lit(fv.ID_KEY_PREFIX), event_id.cast("string")))
        .otherwise(F.concat(F.lit(fv.COMPOSITE_KEY_PREFIX), digest))
    )


def country_display(name: ColumnOrName, code: ColumnOrName) -> Column:
    """``name (code)``, or the name alone when the code is blank or the name unknown."""
    shown = F.coalesce(clean_text(name), F.lit(fv.UNKNOWN))
    shown_code = F.coalesce(strip(code), F.lit(""))
    return (
        F.when((shown_code == "") | (shown == fv.UNKNOWN), shown)
        .otherwise(F.concat(shown, F.lit(" ("), shown_code, F.lit(")")))
    )


def category_display(primary: ColumnOrName, secondary: ColumnOrName) -> Column:
    return F.concat_ws(":", col(primary), F.nullif(col(secondary), F.lit("")))


def or_unknown(c: ColumnOrName) -> Column:
    """The value, or ``Unknown`` for NULL and empty text."""
    return F.coalesce(F.nullif(col(c), F.lit("")), F.lit(fv.UNKNOWN))
