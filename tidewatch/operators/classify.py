"""Rule classification of events into one primary and at most one secondary category."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch import fixed_values as fv
from tidewatch.functions.lookup import root_category
from tidewatch.functions.text import ColumnOrName, code_root, col, first_keyword, strip, text_blob
from tidewatch.schemas import CONFIDENCE

BLOB = "_text_blob"
KEYWORD = "_keyword_reason"


def _result(primary: Column | str, secondary: Column | None, confidence: Column | str, reason: Column) -> Column:
    return F.struct(
        (primary if isinstance(primary, Column) else F.lit(primary)).alias("primary_category"),
        (F.lit(None).cast("string") if secondary is None else secondary).alias("secondary_category"),
        (confidence if isinstance(confidence, Column) else F.lit(confidence)).cast(CONFIDENCE).alias("category_confidence"),
        reason.alias("category_reason"),
    )


def _first_rule(*rules: tuple[Column, Column]) -> Column:
    matched = F
    for condition, result in rules:
        matched = matched.when(condition, result)
    return matched


def cyber_keyword_reason(blob: ColumnOrName) -> Column:
    return first_keyword(blob, {word: f"cyber_keyword:{word}" for word in fv.CYBER_KEYWORDS})


def crisis_keyword_reason(blob: ColumnOrName) -> Column:
    """Reason of the first crisis keyword: kinds in declared order, keywords in declared order within a kind."""
    kinds = fv.CRISIS_KEYWORDS.items()
    return first_keyword(blob, {word: f"crisis_keyword:{kind}:{word}" for kind, words in kinds for word in words})


def keyword_reason(blob: ColumnOrName) -> Column:
    """Reason of the first keyword of either list, cyber keywords first."""
    words = {word: f"cyber_keyword:{word}" for word in fv.CYBER_KEYWORDS}
    for kind, crisis_words in fv.CRISIS_KEYWORDS.items():
        words.update({word: f"crisis_keyword:{kind}:{word}" for word in crisis_words})
    return first_keyword(blob, words)


def _cyber_code(code: Column, codes: list[str], confidence: str, reason: str) -> tuple[Column, Column]:
    return code.isin(codes), _result("cyber", None, confidence, F.concat(F.lit(f"{reason}:"), code))


def _cyber_word(reason: Column) -> tuple[Column, Column]:
    return reason.startswith("cyber_keyword:"), _result("cyber", None, fv.CYBER_KEYWORD_CONFIDENCE, reason)


def _crisis_word(reason: Column) -> tuple[Column, Column]:
    kind = F.split_part(reason, F.lit(":"), F.lit(2))
    confidences = sorted(set(fv.CRISIS_KEYWORD_CONFIDENCE.values()))
    confidence = F.lit(confidences[-1])
    for value in confidences[:-1]:
        kinds = [k for k, v in fv.CRISIS_KEYWORD_CONFIDENCE.items() if v == value]
        confidence = F.when(kind.isin(kinds), value).otherwise(confidence)
    return reason.startswith("crisis_keyword:"), _result("crisis", kind, confidence, reason)


def _weak_code(code: Column) -> tuple[Column, Column]:
    reason = F.concat(F.lit("crisis_weak_humanitarian_code:"), code)
    result = _result("crisis", F.lit("humanitarian"), fv.WEAK_HUMANITARIAN_CONFIDENCE, reason)
    return code.isin(fv.WEAK_HUMANITARIAN_CODES), result


def _root(code: Column) -> tuple[Column, Column]:
    reason = F.concat(F.lit("root_event_code:"), code_root(code))
    return code_root(code).isin(list(fv.ROOT_CATEGORY)), _result(
        root_category(code), None, fv.ROOT_CODE_CONFIDENCE, reason)


def _strong_code(code: Column) -> tuple[Column, Column]:
    return _cyber_code(code, fv.CYBER_STRONG_CODES, fv.CYBER_STRONG_CONFIDENCE, "cyber_strong_event_code")


def _medium_code(code: Column) -> tuple[Column, Column]:
    return _cyber_code(code, fv.CYBER_MEDIUM_CODES, fv.CYBER_MEDIUM_CONFIDENCE, "cyber_medium_event_code")


def _code(code: ColumnOrName) -> Column:
    return F.coalesce(strip(code), F.lit(""))


def detect_cyber(code: ColumnOrName, blob: ColumnOrName) -> Column:
    """Category struct of the cyber rules, NULL if none applies."""
    code = _code(code)
    return _first_rule(_strong_code(code), _cyber_word(cyber_keyword_reason(blob)), _medium_code(code))


def detect_crisis(code: ColumnOrName, blob: ColumnOrName) -> Column:
    """Category struct of the crisis rules, NULL if none applies."""
    return _first_rule(_crisis_word(crisis_keyword_reason(blob)), _weak_code(_code(code)))


def detect_root(code: ColumnOrName) -> Column:
    return _first_rule(_root(_code(code)))


def category(code: ColumnOrName, keyword: ColumnOrName) -> Column:
    """Category struct of the first rule that applies, given the text's :func:`keyword_reason`; never NULL."""
    code, keyword = _code(code), col(keyword)
    fallback = _result(fv.FALLBACK_CATEGORY, None, fv.FALLBACK_CONFIDENCE, F.lit(fv.FALLBACK_REASON))
    return _first_rule(
        _strong_code(code), _cyber_word(keyword), _medium_code(code), _crisis_word(keyword), _weak_code(code), _root(code)
    ).otherwise(fallback)


def with_category(
    df: DataFrame,
    code: ColumnOrName = "event_code",
    actor1: ColumnOrName = "actor1_name",
    actor2: ColumnOrName = "actor2_name",
    place: ColumnOrName = "action_geo_full_name",
    url: ColumnOrName = "source_url",
) -> DataFrame:
    """Add the four category columns.

    Text, keyword and rules are computed in projections of their own, so each is evaluated once per row. The columns
    come out of a one-element ``inline``: a later filter on them stays above it, where otherwise Catalyst would move
    the filter below the projections and repeat the whole computation inside the condition.
    """
    return (
        df.withColumn(BLOB, text_blob(actor1, actor2, place, url))
        .withColumn(KEYWORD, keyword_reason(BLOB))
        .select("*", F.inline(F.array(category(code, KEYWORD))))
        .drop(BLOB, KEYWORD)
    )
