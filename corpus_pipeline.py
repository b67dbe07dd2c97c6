"""The corpus pipeline: quality rules, near-duplicates, decontamination, pseudonyms, packing.

Each stage works on all that the stage before kept. All stages but the last return the columns of ``documents``; the last
returns the packed pieces. Nulls, empty texts, repeated rows and empty tables follow each operator's docstring: a document
without words is rejected by the first stage, and repeated rows of an id that stays all stay.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.llm import minwise, packing, pii, quality, simhash, wumanber
from tidewatch.llm.common import staged, table, unused
from tidewatch.llm.queries import PSEUDONYM_KEY, WORD_VOCABULARY, vocabulary


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What both searches keep: close copies by fingerprints of 64 bits, and documents that share four fifths of their shingles."""
    close = simhash.near_duplicates(docs, minwise.WORDS).where("doc_id = component_id").select("doc_id")
    return minwise.one_of_each(docs, also=close)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return wumanber.without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def pseudonyms(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """New texts, and ``n_chars`` (where there is one) after them."""
    result = unused(docs, "found")
    rows = pii.pseudonymised(docs, result, PSEUDONYM_KEY).drop(result)
    return rows.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else rows


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    pieces = packing.pack_documents(docs, vocabulary(WORD_VOCABULARY), end_id=2)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


STAGES = [
    ("quality rules", quality_rules), ("near duplicates", near_duplicates), ("decontamination", decontamination),
    ("pseudonyms", pseudonyms), ("packing", packed),
]

#: Fingerprints and token ids are beyond SQL; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
