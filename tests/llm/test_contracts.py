"""Each query against its plain Python version, on the smallest data set."""

from __future__ import annotations

import zlib
from collections import Counter

import pytest

from tests.conftest import SF_DIR
from tests.llm import brute
from tidewatch.llm.queries import BYTE_VOCABULARY, QUERIES, WORD_VOCABULARY, vocabulary


@pytest.fixture(scope="module")
def docs(spark):
    return [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()]


def rows(spark, key, *columns):
    return sorted(tuple(r[c] for c in columns) for r in QUERIES[key](spark, SF_DIR).collect())


def test_base_counts_and_verdict(spark, docs):
    got = QUERIES["op1_quality_rules"](spark, SF_DIR).collect()
    columns = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    assert sorted(tuple(r[c] for c in columns) for r in got) == sorted((d, *brute.base_counts(t)) for d, t in docs)
    for r in got:
        assert r["base_failed"] == (r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"])
        assert not (r["base_failed"] and r["kept"])


def test_fingerprints_and_components(spark, docs):
    prints = {d: brute.fingerprint(t) for d, t in docs}
    roots = brute.reach(prints)
    want = sorted((d, f"{p:016x}", roots[d]) for d, p in prints.items())
    assert rows(spark, "op2_simhash_near_dedup", "doc_id", "fingerprint", "component_id") == want


def test_tokens_read_back(spark, docs):
    want = [x[:4] for x in brute.tokens(docs, vocabulary(BYTE_VOCABULARY), 0)]
    assert rows(spark, "op3_wavelet_tokens", "doc_id", "start", "n_tokens", "ids_crc32") == want


def test_packed_pieces(spark, docs):
    ids = {x[0]: x[4] for x in brute.tokens(docs, vocabulary(WORD_VOCABULARY), 2)}
    filled, seen = Counter(), Counter()
    for seq, offset, doc, start, n, crc, whole in rows(spark, "op4_packing", "sequence_id", "offset", "doc_id", "start", "length", "ids_crc32", "doc_tokens"):
        assert offset == filled[seq] and whole == len(ids[doc]) and n > 0
        assert crc == zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids[doc][start : start + n]))
        filled[seq] += n
        seen[doc] += n
    assert seen == {d: len(x) for d, x in ids.items()}
    assert max(filled.values()) <= 4096
    assert len(filled) * 4096 - sum(filled.values()) < 4096


def test_contamination(spark, docs):
    items = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").select("item_id", "text").collect()]
    got = rows(spark, "op5_decontamination", "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    assert got == brute.contamination(docs, items)


def test_chats_read_back(spark):
    turns = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    turns += [(-1, 0, "user", "</s>[INST] ok [/INST]"), (-1, 1, "assistant", "</s>[INST] ok [/INST]")]
    assert rows(spark, "op8_chat_format", "conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256") == brute.chats(turns)


def test_archives_read_back(spark):
    pages = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/pages.parquet").select("page_id", "html").collect()]
    got = rows(spark, "op9_warc_normaliser", "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    assert got == brute.archives(pages)


def test_repeats_removed(spark, docs):
    assert rows(spark, "op10_substring_dedup", "doc_id", "n_words", "n_removed", "kept_sha256") == brute.repeats(docs)


def test_pipeline_against_its_stages_by_hand(spark, docs):
    """The wider near-duplicate search is held against all pairs of its own fingerprints, which estimate a similarity."""
    import corpus_pipeline
    from tidewatch.llm import minwise

    kept = {r["doc_id"] for r in QUERIES["op1_quality_rules"](spark, SF_DIR).collect() if r["kept"]}
    left = {d: t for d, t in docs if d in kept}
    close = brute.reach({d: brute.fingerprint(t, 5) for d, t in left.items()})
    slots = {d: brute.slots(t) for d, t in left.items()}
    alike = brute.reach(slots, lambda a, b: int((a == b).sum()) >= minwise.LEAST_EQUAL)
    left = {d: t for d, t in left.items() if close[d] == d == alike[d]}
    items = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").select("item_id", "text").collect()]
    clean = {r[0] for r in brute.contamination(left.items(), items) if not r[5]}
    new = {r["doc_id"]: r["text"] for r in QUERIES["op6_pii"](spark, SF_DIR).collect()}
    want = {x[0]: x[2] for x in brute.tokens([(d, new[d]) for d in clean], vocabulary(WORD_VOCABULARY), 2)}
    got = Counter()
    for r in corpus_pipeline.run(spark, SF_DIR).collect():
        got[r["doc_id"]] += r["length"]
    assert got == want
