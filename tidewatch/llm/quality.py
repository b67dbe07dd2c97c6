"""Quality rules with thresholds learned per language and source (operator 1), in DataFrame functions only.

Signals are whole numbers. Each group's distribution of a signal is a mergeable quantile sketch: counts by bucket, where a
bucket keeps a number's leading six bits (relative error below 1/32), so counts of any parts of the data may be added in
any order. Sketches of (language, source) are merged to those of the language and of the whole corpus, which stand in where
a group has fewer than ``LEAST_DOCUMENTS`` documents that pass the base rules. From the quartiles comes a fence: a document
beyond it is rejected. Only documents that pass the base rules are counted, so that junk below them moves no threshold.

Defined results: a null or empty text has no words and fails the base rules; a null language or source is a group of its
own; repeated documents count each; an empty table gives no row; columns of any name pass through.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.llm.common import SPACE_CLASS, bind, staged, unused, words

LEAST_WORDS = 50
LEAST_DOCUMENTS = 100
#: Signal: (name, least distance of a fence from the quartile, whether low values are outliers too).
#: Shares are per thousand; the mean word length is in hundredths of a character.
SIGNALS = [("symbols", 50, False), ("same_lines", 340, False), ("repeats", 400, False), ("word_length", 100, True)]
#: A fence lies this many quartile ranges beyond its quartile, or by the least distance if that is more.
FENCE_RANGES = 3
#: Threshold rows (a language and source each) that are broadcast at most; more are joined by their keys.
BROADCAST_ROWS = 50_000
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines"]


def repeated_words(w: Column) -> Column:
    """Words inside three-word windows that occur twice or more in the text.

    Windows are sorted by hash, then place; one with an equal neighbour is repeated. Their places, in order, cover three
    words each, less what the one before covers.
    """
    windows = F.slice(F.transform(w, lambda x, i: F.struct(F.xxhash64(x, F.get(w, i + 1), F.get(w, i + 2)).alias("h"), i.alias("i"))), 1, F.greatest(F.size(w) - 2, F.lit(0)))

    def places(s: Column) -> Column:
        twice = F.filter(s, lambda x, i: (x["h"] == F.get(s, i - 1)["h"]) | (x["h"] == F.get(s, i + 1)["h"]))
        return F.array_sort(F.transform(twice, lambda x: x["i"]))

    def covered(p: Column) -> Column:
        return F.aggregate(F.zip_with(p, F.slice(p, 2, F.greatest(F.size(p), F.lit(1))), lambda a, b: F.coalesce(F.least(b - a, F.lit(3)), F.lit(3))), F.lit(0).cast("long"), lambda n, x: n + x)

    return bind(bind(F.array_sort(windows), places), covered)


def counts(text: Column) -> Column:
    """The base rules' counts of a text, as a struct of ``COUNTS``."""
    lines = F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda x: x.rlike(f"[^{SPACE_CLASS}]"))

    def of_words(w: Column) -> Column:
        def of_lines(x: Column) -> Column:
            return F.struct(
                F.size(w).cast("long").alias("n_words"), F.char_length(F.array_join(w, "")).cast("long").alias("word_chars"),
                F.coalesce(F.regexp_count(text, F.lit("[#*$%&|<>]")), F.lit(0)).cast("long").alias("n_symbols"),
                (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
                repeated_words(w).alias("n_repeat_words"), F.size(x).cast("long").alias("n_lines"))

        return bind(lines, of_lines)

    return bind(words(text), of_words)


def base_failed(c: Column) -> Column:
    return (c["n_words"] < LEAST_WORDS) | (100 * c["n_repeat_words"] > 50 * c["n_words"])


def _per(part: Column, whole: Column, scale: int) -> Column:
    return F.floor(part * scale / F.greatest(whole, F.lit(1))).cast("long")


def signals(c: Column) -> list[Column]:
    return [
        _per(c["n_symbols"], c["word_chars"], 1000).alias("symbols"), _per(c["n_dup_lines"], c["n_lines"], 1000).alias("same_lines"),
        _per(c["n_repeat_words"], c["n_words"], 1000).alias("repeats"), _per(c["word_chars"], c["n_words"], 100).alias("word_length"),
    ]


def sketches(rows: DataFrame) -> DataFrame:
    """Counts by language, source, signal and bucket, summed in each task before the shuffle."""
    each = F.explode(F.array(*[F.struct(F.lit(name).alias("signal"), F.col(name).alias("v")) for name, _, _ in SIGNALS]))
    drop = F.greatest(F.length(F.bin("s.v")) - 6, F.lit(0))
    bucket = F.call_function("shiftleft", F.call_function("shiftright", F.col("s.v"), drop), drop)
    return (
        rows.where(~F.col("base_failed")).select("lang", "source", each.alias("s"))
        .groupBy("lang", "source", F.col("s.signal").alias("signal"), bucket.alias("bucket")).agg(F.count("*").alias("n"))
    )


def merged(sketch: DataFrame, keys: list[str]) -> DataFrame:
    return sketch.groupBy(*keys, "signal", "bucket").agg(F.sum("n").alias("n"))


def fences(sketch: DataFrame, keys: list[str]) -> DataFrame:
    """One row per group: documents counted, and low and high fence of each signal. A group has a few hundred buckets."""
    upto = Window.partitionBy(*keys, "signal").orderBy("bucket")
    total = Window.partitionBy(*keys, "signal")
    ranked = sketch.withColumns({"upto": F.sum("n").over(upto), "total": F.sum("n").over(total)})
    quartile = {q: F.min(F.when(F.col("upto") * 4 >= F.col("total") * q, F.col("bucket"))).alias(f"q{q}") for q in (1, 2, 3)}
    per_signal = ranked.groupBy(*keys, "signal").agg(F.max("total").alias("docs"), *quartile.values())
    out = []
    for name, least, both in SIGNALS:
        reach = F.greatest((F.col("q3") - F.col("q1")) * FENCE_RANGES, F.lit(least))
        here = F.col("signal") == name
        out.append(F.max(F.when(here, F.col("q3") + reach)).alias(f"{name}_high"))
        if both:
            out.append(F.max(F.when(here, F.col("q1") - reach)).alias(f"{name}_low"))
    return per_signal.groupBy(*keys).agg(F.max("docs").alias("docs"), *out)


def thresholds(rows: DataFrame) -> DataFrame:
    """Fences for every (language, source), from the narrowest group with enough documents."""
    sketch = staged(sketches(rows), "quality-sketch")
    names = [f"{name}_{end}" for name, _, both in SIGNALS for end in (("high", "low") if both else ("high",))]
    narrow = fences(sketch, ["lang", "source"])
    by_lang = fences(merged(sketch, ["lang"]), ["lang"]).select(F.col("lang").alias("l_lang"), F.struct("docs", *names).alias("l"))
    overall = fences(merged(sketch.withColumn("everything", F.lit(1)), ["everything"]), ["everything"]).select(F.struct("docs", *names).alias("a"), F.col("everything"))
    groups = rows.select("lang", "source").distinct().withColumn("everything", F.lit(1))
    n = narrow.select(F.col("lang").alias("n_lang"), F.col("source").alias("n_source"), F.struct("docs", *names).alias("n"))
    joined = (
        groups.join(n, F.col("lang").eqNullSafe(F.col("n_lang")) & F.col("source").eqNullSafe(F.col("n_source")), "left")
        .join(by_lang, F.col("lang").eqNullSafe(F.col("l_lang")), "left").join(overall, "everything", "left")
    )
    enough = F.when(F.col("n.docs") >= LEAST_DOCUMENTS, F.col("n")).when(F.col("l.docs") >= LEAST_DOCUMENTS, F.col("l")).otherwise(F.col("a"))
    return joined.select(F.col("lang").alias("t_lang"), F.col("source").alias("t_source"), enough.alias("fence"))


def verdict(fence: Column) -> Column:
    """True if no signal lies beyond its fence."""
    tests = [F.coalesce(F.col(name) <= fence[f"{name}_high"], F.lit(True)) for name, _, _ in SIGNALS]
    tests += [F.coalesce(F.col(name) >= fence[f"{name}_low"], F.lit(True)) for name, _, both in SIGNALS if both]
    return reduce(lambda a, b: a & b, tests)


def judged(docs: DataFrame, carry: list[str], result: str) -> DataFrame:
    """The columns ``carry`` of every document and a struct ``result``: the counts, ``base_failed`` and ``kept``.

    Counts are computed once and staged; all further steps read narrow columns of that table.
    """
    named = [F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(carry)]
    counted = docs.select(*named, F.col("lang").cast("string").alias("lang"), F.col("source").cast("string").alias("source"), counts(F.col("text").cast("string")).alias("counts"))
    rows = staged(counted.select("*", base_failed(F.col("counts")).alias("base_failed"), *signals(F.col("counts"))), "quality")
    limits = staged(thresholds(rows), "quality-thresholds")
    if limits.count() <= BROADCAST_ROWS:
        limits = F.broadcast(limits)
    joined = rows.join(limits, F.col("lang").eqNullSafe(F.col("t_lang")) & F.col("source").eqNullSafe(F.col("t_source")), "left")
    kept = ~F.col("base_failed") & verdict(F.col("fence"))
    out = F.struct(*[F.col("counts")[c].alias(c) for c in COUNTS], F.col("base_failed"), kept.alias("kept"))
    return joined.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(carry)], out.alias(result))


def keep_good(docs: DataFrame) -> DataFrame:
    """The documents that all rules keep, with their own columns."""
    result = unused(docs, "quality")
    return judged(docs, docs.columns, result).where(F.col(f"{result}.kept")).drop(result)
