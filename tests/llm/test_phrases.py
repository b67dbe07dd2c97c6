"""Collocations against a plain count, on small data and on texts that meet every edge."""

from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pytest

from tests.conftest import SF_DIR
from tidewatch.llm import phrases
from tidewatch.llm.queries import QUERIES

COLUMNS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def plain(rows, least=100, top=2000):
    """(lang, rank, phrase, a, l, r, n, score) by counting every phrase."""
    lower = {i: i + 32 for i in range(65, 91)}
    counts, totals = Counter(), Counter()
    for lang, text in rows:
        if text is None:
            continue
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text.translate(lower)):
            w = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(w)
            for m in range(1, 6):
                for i in range(len(w) - m + 1):
                    counts[lang, tuple(w[i:i + m])] += 1
    found = {k: a for k, a in counts.items() if len(k[1]) > 1 and a >= least}
    out = []
    for (lang, w), a in found.items():
        n = totals[lang]
        inside = any(
            lang == x and len(p) > len(w) and 100 * b >= 100 * a and any(p[i:i + len(w)] == w for i in range(len(p) - len(w) + 1))
            for (x, p), b in found.items())
        if not inside:
            cuts = [(1000 * a * n // (counts[lang, w[:k]] * counts[lang, w[k:]]), k, counts[lang, w[:k]], counts[lang, w[k:]]) for k in range(1, len(w))]
            score, _, left, right = min(cuts)
            out.append((lang, " ".join(w), a, left, right, n, score))
    ranked = []
    for lang in {x[0] for x in out}:
        best = sorted((x for x in out if x[0] == lang), key=lambda x: (-x[6], -x[2], x[1].encode()))[:top]
        ranked += [(lang, i, *x[1:]) for i, x in enumerate(best, 1)]
    return sorted(ranked)


def got(frame):
    return sorted(tuple(r[c] for c in COLUMNS) for r in frame.collect())


def some_rows():
    draw = random.Random(7)
    words = ["a", "B", "cc", "d\x1ce", "é", "\xa0", "x" * 50, "z", "\x00"]
    gaps = [" ", "  ", "\t", " ", " ", ". ", ",", "\n", "\r\n", "\x0b", "!?"]
    rows = [(draw.choice(["en", "fr", "", None]), "".join(draw.choice(words) + draw.choice(gaps) for _ in range(draw.randint(0, 60)))) for _ in range(150)]
    return rows + [(None, None), ("en", ""), ("en", " ... "), ("xx", None), ("en", "b a " * 400), ("en", "b a " * 400), ("de", "hot " * 700)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, lang, text, "p", 1) for i, (lang, text) in enumerate(some_rows())], "doc_id long, lang string, text string, phrase string, n int")


@pytest.mark.parametrize("least", [3, 8, 40])
def test_counts_scores_and_order(docs, least):
    assert got(phrases.collocations(docs, least, 30)) == plain(some_rows(), least, 30)


def test_extended_prefixes_and_small_blocks(docs, monkeypatch):
    """Prefixes beyond their share, texts cut into blocks, pairs sent before the end: the counts stay."""
    import pyarrow as pa

    monkeypatch.setattr(phrases, "BLOCK_BYTES", 37)
    monkeypatch.setattr(phrases, "COMBINED_PAIRS", 5)
    rows = [(lang or "und", text) for lang, text in some_rows() if text is not None]
    batch = pa.record_batch({"lang": [r[0] for r in rows], "text": [r[1] for r in rows]})
    blocks = list(phrases._make_blocks(iter([batch])))
    assert len(blocks) > 100
    want, pairs, words = Counter(), Counter(), Counter()
    lower = {i: i + 32 for i in range(65, 91)}
    for lang, text in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text.translate(lower)):
            w = re.findall(r"[^\x20\x09]+", piece)
            words.update((lang, x) for x in w)
            words[lang, None] += len(w)
            for m in range(2, 6):
                for i in range(len(w) - m + 1):
                    want[lang, " ".join(w[i:i + m])] += 1
                    if m == 2:
                        pairs[lang, w[i], w[i + 1]] += 1
    every = phrases.Bitmap(b"\xff" * (phrases.BITS // 8))
    for extended in (every, phrases.Bitmap(b"\0" * (phrases.BITS // 8))):
        totals = Counter()
        for out in phrases._send_suffixes(every, every, extended, 7)(iter(blocks)):
            for lang, suffixes, counts in zip(out["lang"].to_pylist(), out["suffixes"].to_pylist(), out["n"].to_pylist(), strict=True):
                for suffix, n in zip(suffixes.decode().split("\n"), np.frombuffer(counts, "<i8").tolist(), strict=True):
                    w = suffix.split(" ")
                    for m in range(2, len(w) + 1):
                        totals[lang, " ".join(w[:m])] += n
        assert totals == want
    sent = Counter()
    for out in phrases._count_pairs(every)(iter(blocks)):
        sent.update(dict(zip(out["h"].to_pylist(), out["n"].to_pylist(), strict=True)))
    assert sorted(sent.values()) == sorted(pairs.values()) or sum(sent.values()) == sum(pairs.values())
    found = Counter()
    for out in phrases._count_words(iter(blocks)):
        for lang, word, n in zip(out["lang"].to_pylist(), out["word"].to_pylist(), out["n"].to_pylist(), strict=True):
            found[lang, word] += n
    assert +found == +words


def test_prefixes_beyond_their_share(docs, monkeypatch):
    monkeypatch.setattr(phrases, "GROUP_SUFFIXES", 50)
    monkeypatch.setattr(phrases, "PREFIX_SUFFIXES", 10)
    assert got(phrases.collocations(docs, 3, 30)) == plain(some_rows(), 3, 30)


def _peak(step) -> float:
    """MB at most that a step's Python objects and arrays take, beside its input."""
    import tracemalloc

    tracemalloc.start()
    try:
        for _ in step:
            pass
        return tracemalloc.get_traced_memory()[1] / 1e6
    finally:
        tracemalloc.stop()


def test_memory_of_steps(monkeypatch):
    """Blocks of 300,000 words, nearly all pairs and suffixes distinct: a step takes a few arrays of their size."""
    monkeypatch.setattr(phrases, "COMBINED_PAIRS", 1_000_000)
    draw = np.random.default_rng(3)
    words = [f"word{i}".encode() for i in range(3000)]
    blocks = [phrases._batch(phrases.BLOCKS, **{k: [v] for k, v in zip(phrases.BLOCKS, phrases.block("en", [words[i] for i in draw.integers(0, 3000, 300_000)], 300_000), strict=True)}) for _ in range(4)]
    every, none = phrases.Bitmap(b"\xff" * (phrases.BITS // 8)), phrases.Bitmap(b"\0" * (phrases.BITS // 8))
    assert _peak(phrases._count_pairs(every)(iter(blocks))) < 40
    for extended in (none, every):
        assert _peak(phrases._send_suffixes(every, every, extended, 50)(iter(blocks[:1]))) < 60


def test_batches_of_blocks(docs, spark, tmp_path, monkeypatch):
    """Tasks get about a block at a time, in all steps; the session keeps its own setting."""
    key, value = phrases.BATCH_BYTES
    large = spark.range(0, 8, 1, 1).selectExpr("cast(repeat('x', 1500000) as binary) AS numbers")
    large.write.parquet(f"{tmp_path}/blocks")

    def sizes(batches):
        import pyarrow as pa

        for batch in batches:
            yield pa.record_batch({"n": pa.array([batch.num_rows])})

    with phrases.with_setting(spark, key, value):
        assert [r["n"] for r in spark.read.parquet(f"{tmp_path}/blocks").mapInArrow(sizes, "n long").collect()] == [1] * 8
    seen, write = [], phrases.staged
    monkeypatch.setattr(phrases, "staged", lambda *given, **more: seen.append(spark.conf.get(key)) or write(*given, **more))
    phrases.collocations(docs, 8, 30)
    assert seen == [value] * 4
    assert spark.conf.get(key) != value


def test_files_of_blocks(docs, spark, monkeypatch):
    """A page of a file of blocks has one block, not the first hundred: each page adds its header."""
    import pyarrow.parquet as pq

    given, write = {}, phrases.staged
    monkeypatch.setattr(phrases, "staged", lambda df, purpose, **more: given.update({purpose: more.get("options")}) or write(df, purpose, **more))
    phrases.phrase_counts(docs, 8)
    blocks = spark.range(0, 40, 1, 1).selectExpr("cast(concat(id, repeat('x', 1500000)) as binary) AS numbers")

    def size(options):
        made = write(blocks, "blocks", options=options)
        assert made.count() == 40
        return pq.ParquetFile(made.inputFiles()[0].replace("file://", "")).metadata.row_group(0).column(0).total_uncompressed_size

    assert size(given["word-blocks"]) - size(None) >= 39 * 15


def test_products_beyond_64_bits(spark):
    counts = [("en", "a b", 2, 3 * 10**12), ("en", "a", 1, 4 * 10**12), ("en", "b", 1, 7 * 10**12)]
    made = phrases.scored(
        spark.createDataFrame(counts, "lang string, phrase string, depth int, a long"), spark.createDataFrame([("en", 10**13 + 7)], "lang string, total long"))
    assert [(r["l"], r["r"], r["score"]) for r in made.collect()] == [(4 * 10**12, 7 * 10**12, 1000 * 3 * 10**12 * (10**13 + 7) // (28 * 10**24))]


def test_empty_table(docs):
    assert phrases.collocations(docs.limit(0)).count() == 0
    assert phrases.collocations(docs.where("text IS NULL")).count() == 0


def test_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("lang", "text").collect()]
    assert got(QUERIES["op11_phrase_collocations"](spark, SF_DIR)) == plain(rows)
