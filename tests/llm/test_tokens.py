"""Texts encoded piece by piece have the ids of the whole texts."""

from __future__ import annotations

import random

import numpy as np
import pytest

from tidewatch.llm import tokens
from tidewatch.llm.queries import BYTE_VOCABULARY, WORD_VOCABULARY, vocabulary
from tidewatch.llm.tokens import OTHER_SPACE, PieceEncoder

PARTS = [*"ab1.,'\n \t\x01_é!", "</w>", "word", "  ", "<|endoftext|>", "\x85", "é", "　", "\x1c", "İ", "क़", "אַ", "\xa0", " menu 2, 3 item", "日本"]


@pytest.mark.parametrize(("name", "leading_space"), [(WORD_VOCABULARY, False), (BYTE_VOCABULARY, True)])
def test_pieces_give_the_ids_of_whole_texts(name, leading_space):
    draw = random.Random(3)
    texts = ["".join(draw.choices(PARTS, k=draw.randint(1, 14))) for _ in range(20_000)] + ["", " ", "\n", ".", "\x01"]
    coder = PieceEncoder(vocabulary(name), leading_space)
    whole = coder.tokenizer.encode_batch(texts, add_special_tokens=False)
    assert coder.ids(texts) == [np.array(x.ids, "<u4").tobytes() for x in whole]


@pytest.mark.parametrize(("name", "leading_space"), [(WORD_VOCABULARY, False), (BYTE_VOCABULARY, True)])
def test_texts_that_begin_with_any_white_space(name, leading_space):
    """In one batch with pieces of other scripts, which share separators with them."""
    others = ["日本 語 文", "é 1 2", "a - b"]
    texts = [f"{a}{b}{rest}" for a in [*OTHER_SPACE, " ", "\n"] for b in ["", " ", "\n", "\xa0"] for rest in ("menu 2, 3 item", "日本", "")] + others
    coder = PieceEncoder(vocabulary(name), leading_space)
    want = [np.array(x.ids, "<u4").tobytes() for x in coder.tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert coder.ids(texts) == want and coder.ids(texts[::-1]) == want[::-1]


def test_a_joined_separator_falls_back_to_single_pieces(monkeypatch):
    coder = PieceEncoder(vocabulary(BYTE_VOCABULARY), True)
    monkeypatch.setattr(coder, "_odd_start", lambda piece: False)
    texts = ["\xa0 menu 2, 3 item", "日本 語", "x - y"]
    assert coder.ids(texts) == [np.array(x.ids, "<u4").tobytes() for x in coder.tokenizer.encode_batch(texts, add_special_tokens=False)]


@pytest.mark.parametrize(("name", "leading_space"), [(WORD_VOCABULARY, False), (BYTE_VOCABULARY, True)])
def test_a_word_is_learned_once_whatever_stands_at_it(name, leading_space):
    """Symbols after a word, and other runs of white space in its text, make no new piece of the word."""
    texts = ["x alpha béta x", "x alpha, béta; x  y alpha&&& béta) x", "x\n\nx alpha: béta... \u00a0 x", " x alpha* béta# "]
    coder = PieceEncoder(vocabulary(name), leading_space)
    whole = coder.tokenizer.encode_batch(texts, add_special_tokens=False)
    assert coder.ids(texts) == [np.array(x.ids, "<u4").tobytes() for x in whole]
    assert sorted(p.strip() for p in coder.known if "alpha" in p or "béta" in p) == ["alpha", "béta"]


@pytest.mark.parametrize(("name", "leading_space"), [(WORD_VOCABULARY, False), (BYTE_VOCABULARY, True)])
def test_pieces_between_characters_of_every_kind(name, leading_space, monkeypatch):
    """Letters of all scripts, symbols, white space and apostrophes; the encoder forgets most of what it has learned."""
    draw = random.Random(11)
    pool = [chr(c) for c in range(1, 0x3100)] + [*" \n"] * 1500 + [*"'.,!-_()<|>/&$#"] * 200 + [*"abXY01"] * 300 + OTHER_SPACE * 20
    pool += [*tokens.JOINING, "'s", "'ll", "\0", "</w>", "\U0002f800", "\U0001d7d8", "\U0010ffff"]
    texts = ["".join(draw.choices(pool, k=draw.randint(0, 40))) for _ in range(5_000)]
    monkeypatch.setattr(tokens, "REMEMBERED", 500)
    coder = PieceEncoder(vocabulary(name), leading_space)
    made = [x for at in range(0, len(texts), 100) for x in coder.ids(texts[at : at + 100])]
    assert made == [np.array(x.ids, "<u4").tobytes() for x in coder.tokenizer.encode_batch(texts, add_special_tokens=False)]


def test_texts_without_anything():
    coder = PieceEncoder(vocabulary(BYTE_VOCABULARY), True)
    assert coder.ids([]) == [] and coder.ids([None, "", None]) == [b""] * 3
    assert [len(x) > 0 for x in coder.ids([None, "a", "", "b"])] == [False, True, False, True]
