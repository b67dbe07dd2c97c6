"""Pieces against the library: ids, spans and texts; the normaliser against the library's own rules."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest
import sentencepiece
from sentencepiece import sentencepiece_model_pb2

from tests.conftest import SF_DIR
from tidewatch.llm import pieces
from tidewatch.llm.queries import PIECE_MODEL, QUERIES, vocabulary

PARTS = [
    " ", "  ", "\n", "\t", "a", "the", "▁", "▁▁", "é", "日本", "😀", "\xa0", "\x00", "\x07", "ß", "word", "<0x0A>", "<s>", "</s>", "<unk>", "　", "ﬁ",
    "½", "é", "Å", "①", "123", "."]


def texts(n, seed=1):
    draw = random.Random(seed)
    return ["".join(draw.choices(PARTS, k=draw.randint(0, 12))) for _ in range(n)] + ["", " ", "   ", "\n", "▁", "x" * 5_000, " ".join(["word"] * 30_000)]


@pytest.mark.parametrize("block", [pieces.BLOCK, 3])
def test_ids_spans_and_text(block, monkeypatch):
    monkeypatch.setattr(pieces, "BLOCK", block)
    coder = pieces.Pieces(vocabulary(PIECE_MODEL))
    library = sentencepiece.SentencePieceProcessor(model_file=vocabulary(PIECE_MODEL))
    for text in texts(3_000):
        ids, begins, ends = coder.encode(text)
        want = library.encode(text)
        assert ids.tolist() == want, text
        assert coder.decode(want) == library.decode(want)
        spans = [(p.begin, p.end) for p in library.encode(text, return_type="proto").pieces]
        assert list(zip(begins.tolist(), ends.tolist(), strict=True)) == spans, text


@pytest.mark.parametrize("rule", ["identity", "nfkc", "nmt_nfkc", "nfkc_cf", "nmt_nfkc_cf"])
@pytest.mark.parametrize("trim", [True, False])
def test_normaliser_follows_the_compiled_map(rule, trim):
    library = sentencepiece.SentencePieceNormalizer(rule_name=rule, add_dummy_prefix=True, escape_whitespaces=True, remove_extra_whitespaces=trim)
    mine = pieces.Normaliser(sentencepiece_model_pb2.ModelProto.FromString(library.serialized_model_proto()).normalizer_spec)
    for text in texts(1_500, 2)[:-2]:
        made, points = mine(text)
        want, offsets = library.normalize(text, with_offsets=True)
        assert made.decode() == want, text
        places = np.cumsum([0] + [len(c.encode()) for c in want])
        source = np.cumsum([0] + [len(c.encode()) for c in text])
        assert pieces.project(points, places).tolist() == source[offsets].tolist(), text


def test_query_and_round_trip(spark):
    library = sentencepiece.SentencePieceProcessor(model_file=vocabulary(PIECE_MODEL))
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    rows = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    got = {r["doc_id"]: (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in QUERIES["op13_sentence_pieces"](spark, SF_DIR).collect()}
    want = {i: library.encode(t) for i, t in rows.items()}
    assert got == {i: (len(x), sha(",".join(map(str, x))), sha(library.decode(x))) for i, x in want.items()}
    coded = pieces.encoded(docs, vocabulary(PIECE_MODEL))
    back = {r["doc_id"]: r["text"] for r in pieces.decoded(coded, vocabulary(PIECE_MODEL)).collect()}
    assert back == {i: library.decode(x) for i, x in want.items()}


def test_edges(spark):
    frame = spark.createDataFrame([(1, None, 1), (2, "", 1), (2, "", 1), (None, "a", 1), (3, "b" * 300_000, 1)], "doc_id long, text string, ids int")
    got = sorted(((r["doc_id"] or 0, r["n_tokens"]) for r in pieces.digests(frame, vocabulary(PIECE_MODEL)).collect()))
    assert [x for x in got if x[0] != 3] == [(0, 1), (1, 0), (2, 0), (2, 0)] and got[-1][1] > 1_000
    coded = pieces.encoded(frame, vocabulary(PIECE_MODEL)).where("doc_id = 1").first()
    assert (coded["ids"], coded["begins"], coded["ends"]) == ([], [], [])
    assert pieces.digests(frame.limit(0), vocabulary(PIECE_MODEL)).count() == 0
    assert pieces.decoded(spark.createDataFrame([(1, None)], "doc_id long, ids array<int>"), vocabulary(PIECE_MODEL)).first()["text"] == ""
