"""Whole texts to token ids with a public tokenizer, each distinct piece between spaces encoded once.

Both vocabularies that are used split a text before their merges, and neither lets a token cross the place before a
space or line end that stands between two other characters, or the place between a letter or digit and an ASCII symbol
other than the apostrophe. So a text may be encoded piece by piece there, with the ids of the whole text; tests compare
both. Other runs of white space stay inside a piece where they matter (``leading_space``).

Strings of special tokens inside a text, such as ``<|endoftext|>``, are ordinary text (``encode_special_tokens``, as in the
description of the vocabulary files), so a document cannot end another or forge an end.
"""

from __future__ import annotations

import os
import unicodedata
from functools import cache, lru_cache
from itertools import chain, repeat
from operator import attrgetter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Pieces that a worker learns before it forgets those not met since it last did so. Bounds memory, not results.
REMEMBERED = 500_000

#: What a character is to the cuts; all bytes of a character have its kind.
OTHER, LETTER, SYMBOL, GAP, WHITE = range(5)
#: Letters whose lower case or composed form ends in a mark, which would join the symbol after it.
JOINING = "".join(c for c in map(chr, range(0x80, 0x30000)) if c.isalnum() and not unicodedata.normalize("NFC", c.lower())[-1].isalnum())
OTHER_SPACE = [c for c in map(chr, range(0x110000)) if c.isspace() and c not in " \n"]
#: A word of Latin letters (not the one whose lower case is two characters): neither vocabulary splits it, so it can go to
#: the merges without the steps before them.
LATIN = "^ ?[A-Za-zÀ-ÖØ-öø-įı-ɏ]+$"
#: Words that must come out of the short way as of the whole one, or it is not taken.
PROBES = ["Probe", " Émigré", "straße", " ÅBEN"]
#: Pieces that are encoded as one text, with a separator between them whose id no piece has.
AT_ONCE = 4096


@cache
def kinds() -> np.ndarray:
    """The kind of each character; letters and digits are the tokenizers library's, since its splits hang on them."""
    from tokenizers import Regex
    from tokenizers.pre_tokenizers import Split

    split = Split(Regex(r"[\p{L}\p{N}]+"), "removed", invert=True)
    blocks = (np.arange(at, at + 0x800, dtype="<u4").tobytes().decode("utf-32-le") for at in range(0, 0x110000, 0x800) if at != 0xD800)
    letters = "".join(run for block in blocks for run, _ in split.pre_tokenize_str(block))
    table = np.full(0x110000, OTHER, np.uint8)
    symbols = "".join(c for c in map(chr, range(33, 127)) if not c.isalnum() and c != "'")
    for kind, chars in ((LETTER, letters), (OTHER, JOINING), (SYMBOL, symbols), (GAP, " \n"), (WHITE, "".join(OTHER_SPACE))):
        table[np.frombuffer(chars.encode("utf-32-le"), "<u4")] = kind
    return table


def kinds_of(data: np.ndarray) -> np.ndarray:
    """The kind of each byte of UTF-8."""
    table = kinds()
    found = table[:256][data]
    for low, high, size in ((0xC0, 0xE0, 2), (0xE0, 0xF0, 3), (0xF0, 0xF8, 4)):
        first = np.flatnonzero((data >= low) & (data < high))
        if len(first):
            code = data[first].astype(np.uint32) & (0x7F >> size)
            for k in range(1, size):
                code = code << 6 | data[first + k] & 0x3F
            kind = table[code]
            for k in range(size):
                found[first + k] = kind
    return found


def piece_bounds(data: np.ndarray, bounds: np.ndarray, leading_space: bool) -> np.ndarray:
    """Where the pieces of texts begin and the last one ends; the texts are ``data`` cut at ``bounds``."""
    cut = np.zeros(len(data) + 1, bool)
    if len(data):
        kind = kinds_of(data)
        cut[1:-1] = (kind[1:] == SYMBOL) & (kind[:-1] == LETTER)
        gap = kind == GAP
        if leading_space:  # white space at another white space, or at either end of a text, may share a token
            white = kind >= GAP
            before, after = np.append(True, white[:-1]), np.append(white[1:], True)
            before[bounds[bounds < len(data)]] = True
            after[bounds[bounds > 0] - 1] = True
            gap &= ~(before | after)
        cut[:-1] |= gap
        cut[1:] |= gap & (data == 10)
    cut[bounds] = True
    return np.flatnonzero(cut)


class PieceEncoder:
    """``ids(texts)`` gives each text's ids as little-endian unsigned 32-bit integers."""

    def __init__(self, path: str, leading_space: bool):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        os.environ.setdefault("RAYON_NUM_THREADS", "1")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # control strings inside a text are ordinary text
        self.leading_space = leading_space
        # Either is always a token of its own: a line end that no white space touches, a lone control character.
        self.mark, self.between = ("\n", "\n") if leading_space else ("\x01", " \x01 ")
        (self.mark_id,) = self.tokenizer.encode(self.between, add_special_tokens=False).ids
        self.byte_names = self._byte_names()
        words = PROBES if leading_space else [p.strip() for p in PROBES]
        self.short_way = self._merged(words).to_pylist() == [self._encoded(p).tobytes() for p in words]
        self.known: dict[str, int] = {}
        self.older: dict[str, int] = {}
        self.ids_known = self.ids_older = pa.array([], pa.large_binary())

    @staticmethod
    def _byte_names() -> dict[int, str]:
        """The character that stands for each byte but the line end: itself if printable, else the next one over 255."""
        from tokenizers.pre_tokenizers import ByteLevel

        alphabet = sorted(ByteLevel.alphabet())
        others = iter([c for c in alphabet if ord(c) > 255])
        names = {b: chr(b) if chr(b) in alphabet else next(others) for b in range(256)}
        return {b: c for b, c in names.items() if b != 10}

    def _merged(self, pieces: list[str]) -> pa.LargeBinaryArray:
        """Ids of pieces that ``LATIN`` matches, from the merges alone."""
        text = "\n".join(pieces)
        named = (text if self.leading_space else text.replace(" ", "").lower()).encode().decode("latin-1").translate(self.byte_names)
        merge, number, ids, ends = self.tokenizer.model.tokenize, attrgetter("id"), [], [0]
        for unit in named.split("\n") if pieces else ():
            ids.extend(map(number, merge(unit)))
            ends.append(len(ids))
        data = np.array(ids, "<u4")
        return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(pieces), [None, pa.py_buffer(np.array(ends, np.int64) * 4), pa.py_buffer(data)])

    def _joined(self, pieces: list[str]) -> pa.LargeBinaryArray:
        """Ids of any pieces, many at a time, but those that a separator could join or be taken for alone."""
        found = {}
        plain = [p for p in pieces if p and self.mark not in p and not p[-1].isspace() and not self._odd_start(p)]
        found.update((p, self._encoded(p).tobytes()) for p in set(pieces).difference(plain))
        for at in range(0, len(plain), AT_ONCE):
            part = plain[at : at + AT_ONCE]
            ids = self._encoded(self.between.join(part))
            ends = np.append(np.flatnonzero(ids == self.mark_id), len(ids)) * 4
            if len(ends) != len(part):  # a separator was joined to its neighbour after all
                found.update((p, self._encoded(p).tobytes()) for p in part)
                continue
            raw, starts = ids.tobytes(), np.append(0, ends[:-1] + 4)
            found.update((p, raw[a:b]) for p, a, b in zip(part, starts.tolist(), ends.tolist(), strict=True))
        return pa.array(map(found.get, pieces), pa.large_binary())

    def _odd_start(self, piece: str) -> bool:
        """White space at the start, which a token may join to the separator before it; but for the one space of a word."""
        return piece[0].isspace() and not (self.leading_space and piece[0] == " " and not piece[1:2].isspace())

    def _encoded(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")

    def _places(self, pieces: pa.LargeStringArray) -> np.ndarray:
        """Where ``ids_known`` has the ids of these distinct pieces, learned now if not met before."""
        if len(self.known) > REMEMBERED:
            self.older, self.ids_older = self.known, self.ids_known
            self.known, self.ids_known = {}, self.ids_known[:0]
        names = pieces.to_numpy(zero_copy_only=False).tolist()
        places = np.fromiter(map(self.known.get, names, repeat(-1)), np.int64, len(names))
        missing = np.flatnonzero(places < 0)
        older = np.fromiter(map(self.older.get, map(names.__getitem__, missing.tolist()), repeat(-1)), np.int64, len(missing))
        met, new = missing[older >= 0], missing[older < 0]
        latin = pc.match_substring_regex(pieces.take(new), LATIN).to_numpy(zero_copy_only=False) if self.short_way else np.zeros(len(new), bool)
        groups = [[names[at] for at in some.tolist()] for some in (met, new[latin], new[~latin])]
        parts = [self.ids_older.take(older[older >= 0]), self._merged(groups[1]), self._joined(groups[2])]
        order, base = np.concatenate([met, new[latin], new[~latin]]), len(self.ids_known)
        places[order] = np.arange(base, base + len(order))
        self.known.update(zip(chain(*groups), range(base, base + len(order)), strict=True))
        self.ids_known = pa.concat_arrays([self.ids_known, *parts])
        return places

    def ids(self, texts: list[str | None]) -> list[bytes]:
        """Pieces are cut, numbered and put together as columns; only the distinct ones of these texts are Python's."""
        _, offsets, data = pa.array([t or "" for t in texts], pa.large_string()).buffers()
        data, bounds = pa.py_buffer(b"") if data is None else data, np.frombuffer(offsets, np.int64)[: len(texts) + 1]
        starts = piece_bounds(np.frombuffer(data, np.uint8)[: bounds[-1]], bounds, self.leading_space)
        pieces = pa.LargeStringArray.from_buffers(len(starts) - 1, pa.py_buffer(starts), data).dictionary_encode()
        places = self._places(pieces.dictionary)
        found = self.ids_known.take(places[pieces.indices.to_numpy()])
        _, offsets, data = found.buffers()
        ends = np.frombuffer(offsets, np.int64)[np.searchsorted(starts, bounds)].tolist()
        raw = b"" if data is None else data.to_pybytes()
        return [raw[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)]


@lru_cache(maxsize=4)
def encoder(path: str, leading_space: bool) -> PieceEncoder:
    """A worker's encoder, kept from task to task with what it has learned."""
    return PieceEncoder(path, leading_space)


def slices(texts: list[str | None], limit: int = 4_000_000):
    """Index ranges of consecutive texts of about ``limit`` characters, a longer text alone."""
    start = size = 0
    for at, text in enumerate(texts):
        n = len(text or "")
        if size and size + n > limit:
            yield start, at
            start, size = at, 0
        size += n
    if start < len(texts):
        yield start, len(texts)
