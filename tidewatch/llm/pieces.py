"""SentencePiece encoding that keeps offsets, and decoding (operator 13).

A text is normalised by the longest prefixes that the model's compiled character map knows; breakpoints record where the
normalised bytes part from the source. The normalised text is cut into blocks where no piece of the vocabulary can reach
across (a space mark after another character), the pairs of each block are merged by the library, with its own normaliser
switched off, and the length of every piece projects it back, through the breakpoints, to a span of the source's bytes.

A character that falls back to bytes has its span on the last of its bytes; the others are empty spans at its start, as in
the library. The model must be of kind BPE with byte fallback and white space before words.

Defined results: a null or empty text has no pieces and decodes to an empty text; rows are judged one by one, so repeated
rows, ties and null ids pass as they are; an empty table gives no row; columns beside those named are left out. Blocks are
merged one at a time, so memory beyond the text and its ids is bounded by the longest run without a space.
"""

from __future__ import annotations

import functools
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SPACE_MARK = "▁"
#: Characters of a block, about: it ends at the next place where a text can be cut.
BLOCK = 32_768
#: Rows of one output batch.
ROWS = 256
ENCODED = "ids array<int>, begins array<long>, ends array<long>"


class CharacterMap:
    """The compiled map: a double-array trie from byte strings to places of their replacements."""

    def __init__(self, blob: bytes):
        size = int.from_bytes(blob[:4], "little") if blob else 0
        self.units = np.frombuffer(blob, "<u4", size // 4, 4).tolist() if size else []
        self.replacements = blob[4 + size:]
        self.first = self._first_bytes()

    @staticmethod
    def _children(unit: int) -> int:
        return (unit >> 10) << ((unit & 512) >> 6)

    def _first_bytes(self) -> re.Pattern[bytes] | None:
        """Finds the bytes that any key starts with; the bytes of a text between them stay as they are."""
        if not self.units:
            return None
        base = self._children(self.units[0])
        known = [b for b in range(1, 256) if (base ^ b) < len(self.units) and self.units[base ^ b] & 0x800000FF == b]
        return re.compile(b"[" + b"".join(re.escape(bytes([b])) for b in known) + b"]") if known else None

    def longest(self, data: bytes, at: int) -> tuple[int, bytes] | None:
        """Length and replacement of the longest key that ``data`` has at ``at``."""
        units, found = self.units, None
        node = self._children(units[0])
        for place in range(at, len(data)):
            byte = data[place]
            node ^= byte
            if not byte or node >= len(units) or units[node] & 0x800000FF != byte:
                break
            unit = units[node]
            node ^= self._children(unit)
            if unit & 256:
                found = (place + 1 - at, units[node] & 0x7FFFFFFF)
        if not found:
            return None
        start = found[1]
        return found[0], self.replacements[start:self.replacements.index(b"\0", start)]

    def replaced(self, data: bytes) -> Iterator[tuple[int, int, bytes]]:
        """(start, end, replacement) of each match from left to right. Bytes are tried at starts of characters only."""
        at, first = 0, self.first
        while first and (hit := first.search(data, at)):
            at = hit.start()
            if data[at] & 0xC0 == 0x80:
                at += 1
                continue
            match = self.longest(data, at)
            if match:
                yield at, at + match[0], match[1]
                at += match[0]
            else:
                at += 1
                while at < len(data) and data[at] & 0xC0 == 0x80:
                    at += 1


class Aligned:
    """Normalised bytes, and the source place of each of their places by breakpoints.

    Between two breakpoints both sides advance alike; ``flat`` stretches stand for one source place (the first of a
    replaced key), until the next breakpoint.
    """

    def __init__(self):
        self.parts: list[bytes] = []
        self.length = 0
        self.at, self.source, self.flat = array("q"), array("q"), array("b")

    def add(self, data: bytes, source: int, flat: bool) -> None:
        if data:
            self.at.append(self.length)
            self.source.append(source)
            self.flat.append(flat)
            self.parts.append(data)
            self.length += len(data)

    def add_stretch(self, data: bytes, source: int, mark: bytes) -> None:
        """``data`` as it is but for a mark in place of each space."""
        spaces = np.flatnonzero(np.frombuffer(data, np.uint8) == 32)
        made = spaces + np.arange(len(spaces)) * (len(mark) - 1)
        at = np.stack([made, made + len(mark)], 1).ravel() + self.length
        places = np.stack([spaces, spaces + 1], 1).ravel() + source
        self.at.frombytes(np.r_[self.length, at].astype(np.int64).tobytes())
        self.source.frombytes(np.r_[source, places].astype(np.int64).tobytes())
        self.flat.frombytes(np.r_[0, np.tile([1, 0], len(spaces))].astype(np.int8).tobytes())
        self.parts.append(data.replace(b" ", mark))
        self.length += len(self.parts[-1])

    def finished(self, source_end: int, without: bytes = b"") -> tuple[bytes, tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """All bytes but those of a run of ``without`` at the end, and the breakpoints."""
        data, points = b"".join(self.parts), (np.array(self.at, np.int64), np.array(self.source, np.int64), np.array(self.flat, bool))
        length = len(data)
        while without and data.endswith(without, 0, length):
            length -= len(without)
        if length < len(data):
            source_end = int(project(points, np.array([length]))[0])
            points, data = tuple(p[points[0] < length] for p in points), data[:length]
        return data, tuple(np.append(p, x).astype(p.dtype) for p, x in zip(points, (length, source_end, True), strict=True))


def project(points: tuple[np.ndarray, np.ndarray, np.ndarray], places: np.ndarray) -> np.ndarray:
    """Source places of normalised places."""
    at, source, flat = points
    which = np.searchsorted(at, places, "right") - 1
    return source[which] + np.where(flat[which], 0, places - at[which])


class Normaliser:
    """The model's normalisation: character map, space marks, dummy prefix, extra spaces."""

    def __init__(self, spec):
        self.map = CharacterMap(spec.precompiled_charsmap)
        self.dummy_prefix, self.trim = spec.add_dummy_prefix, spec.remove_extra_whitespaces
        self.mark = SPACE_MARK.encode() if spec.escape_whitespaces else b" "

    def _steps(self, data: bytes) -> Iterator[tuple[int, bytes, bool]]:
        """(source place, bytes, replaced) in order, spaces still plain."""
        done = 0
        for start, end, new in self.map.replaced(data):
            if start > done:
                yield done, data[done:start], False
            yield start, new, True
            done = end
        if done < len(data):
            yield done, data[done:], False

    def __call__(self, text: str) -> tuple[bytes, tuple[np.ndarray, np.ndarray, np.ndarray]]:
        data = text.encode("utf-8", "surrogatepass")
        out, mark = Aligned(), self.mark
        begun, after_space = not self.dummy_prefix, self.trim
        for source, new, flat in self._steps(data):
            at = 0
            if not begun:  # the prefix stands before the first step that is not a trimmed space, even one replaced by nothing
                at = len(new) - len(new.lstrip(b" ")) if self.trim and (not flat or new == b" ") else 0
                if at == len(new) and at:
                    continue
                out.add(mark, source if flat else source + at, True)
                begun = True
            if not flat and not self.trim:
                out.add_stretch(new, source, mark)
                continue
            while at < len(new):
                space = new.find(b" ", at)
                stop = len(new) if space < 0 else space
                if stop > at:
                    out.add(new[at:stop], source if flat else source + at, flat)
                    after_space = False
                if space >= 0:
                    if not (self.trim and after_space):
                        out.add(mark, source if flat else source + space, True)
                    after_space = self.trim
                at = stop + 1
        return out.finished(len(data) if out.parts else 0, mark if self.trim else b"")


class Pieces:
    """Encoder and decoder of one model."""

    def __init__(self, model: str):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2

        with open(model, "rb") as file:
            data = file.read()
        proto = sentencepiece_model_pb2.ModelProto.FromString(data)
        kinds = sentencepiece_model_pb2.ModelProto.SentencePiece
        if proto.trainer_spec.model_type != 2 or not proto.trainer_spec.byte_fallback or proto.trainer_spec.treat_whitespace_as_suffix:
            raise ValueError("the model must be BPE with byte fallback and white space before words")
        if any(p.type in (kinds.USER_DEFINED, kinds.UNUSED) for p in proto.pieces):
            raise ValueError("models with user-defined or unused pieces are not supported")
        self.whole = sentencepiece.SentencePieceProcessor(model_proto=data)
        self.normalise = Normaliser(proto.normalizer_spec)
        self.is_byte = np.array([p.type == kinds.BYTE for p in proto.pieces])
        self.lengths = np.array([1 if p.type == kinds.BYTE else len(p.piece.encode()) for p in proto.pieces], np.int64)
        spec = proto.normalizer_spec
        spec.precompiled_charsmap = b""
        spec.add_dummy_prefix = spec.remove_extra_whitespaces = spec.escape_whitespaces = False
        self.merger = sentencepiece.SentencePieceProcessor(model_proto=proto.SerializeToString())
        reaches = any(p.type == kinds.NORMAL and SPACE_MARK in p.piece.lstrip(SPACE_MARK) for p in proto.pieces)
        #: Finds the place where a text can be cut: before a space mark after another character, if no piece reaches across.
        self.cut = None if reaches else re.compile(f"(?<!{SPACE_MARK}){SPACE_MARK}")

    def ids(self, normalised: bytes) -> np.ndarray:
        text, at, made = normalised.decode("utf-8", "surrogatepass"), 0, []
        while at < len(text):
            hit = self.cut and self.cut.search(text, at + BLOCK)
            stop = hit.start() if hit else len(text)
            made.append(np.array(self.merger.encode(text[at:stop]), np.int32))
            at = stop
        return np.concatenate(made) if made else np.zeros(0, np.int32)

    def spans(self, normalised: bytes, points, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Source byte spans of the pieces."""
        ends = np.cumsum(self.lengths[ids])
        begins = ends - self.lengths[ids]
        if len(ids) and ends[-1] != len(normalised):
            raise ValueError("the pieces do not add up to the normalised text")
        alone = self.is_byte[ids]
        if alone.any():
            starts = np.r_[(np.frombuffer(normalised, np.uint8) & 0xC0) != 0x80, True]
            places = np.flatnonzero(starts)
            own = places[np.searchsorted(places, begins[alone], "right") - 1]
            last = starts[ends[alone]]
            ends[alone] = np.where(last, ends[alone], own)
            begins[alone] = own
        return project(points, begins), project(points, ends)

    def encode(self, text: str | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids, begins and ends (bytes of the source, UTF-8)."""
        normalised, points = self.normalise(text or "")
        ids = self.ids(normalised)
        return ids, *self.spans(normalised, points, ids)

    def decode(self, ids: list[int]) -> str:
        return self.whole.decode(ids) if ids else ""


@functools.lru_cache(maxsize=2)
def pieces_of(model: str) -> Pieces:
    """One encoder a worker and model."""
    return Pieces(model)


def _lists(arrays: list[np.ndarray], kind) -> pa.ListArray:
    offsets = np.zeros(len(arrays) + 1, np.int32)
    np.cumsum([len(a) for a in arrays], out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(arrays) if arrays else np.zeros(0), kind))


def _slices(batches) -> Iterator[tuple[pa.RecordBatch, list]]:
    """Batches of few rows, and of about 8 million values or characters (a single longer row stays whole)."""
    for batch in batches:
        column = batch.column(1)
        at = 0
        while at < batch.num_rows:
            rows, size = 0, 0
            while at + rows < batch.num_rows and rows < ROWS and size < 8_000_000:
                value = column[at + rows]
                size += value.as_buffer().size if value.is_valid and isinstance(value, pa.StringScalar) else len(value.values or ()) if value.is_valid else 0
                rows += 1
            part = batch.slice(at, rows)
            yield part, part.column(1).to_pylist()
            at += rows


def encoded(docs: DataFrame, model: str) -> DataFrame:
    """``doc_id``, ``ids``, and ``begins`` and ``ends``: the span of each piece in the bytes of the text."""

    def run(batches):
        coder = pieces_of(model)
        for part, texts in _slices(batches):
            made = [coder.encode(t) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), _lists([m[0] for m in made], pa.int32()), _lists([m[1] for m in made], pa.int64()), _lists([m[2] for m in made], pa.int64())],
                names=["doc_id", "ids", "begins", "ends"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, f"doc_id long, {ENCODED}")


def decoded(rows: DataFrame, model: str) -> DataFrame:
    """``doc_id`` and ``text`` of rows of ``ids``; null ids give an empty text."""

    def run(batches):
        coder = pieces_of(model)
        for part, ids in _slices(batches):
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array([coder.decode(x or []) for x in ids], pa.string())], names=["doc_id", "text"])

    return rows.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("ids").cast("array<int>").alias("ids")).mapInArrow(run, "doc_id long, text string")


DIGESTS = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, spans_crc32 long"


def digests(docs: DataFrame, model: str) -> DataFrame:
    """Digests of the ids, of the text decoded from them, and of the spans (begins, then ends, 64-bit little-endian), in
    the task that encodes, so that no id leaves it."""

    def digest(coder: Pieces, text: str | None):
        import hashlib
        import zlib

        ids, begins, ends = coder.encode(text)
        listed = ids.tolist()
        written = hashlib.sha256(",".join(map(str, listed)).encode()).hexdigest()
        back = hashlib.sha256(coder.decode(listed).encode()).hexdigest()
        return len(listed), written, back, zlib.crc32(ends.astype("<i8").tobytes(), zlib.crc32(begins.astype("<i8").tobytes()))

    def run(batches):
        coder = pieces_of(model)
        for part, texts in _slices(batches):
            made = [digest(coder, t) for t in texts]
            kinds = (pa.int64(), pa.string(), pa.string(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [part.column(0), *(pa.array([m[i] for m in made], k) for i, k in enumerate(kinds))],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "spans_crc32"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, DIGESTS)
