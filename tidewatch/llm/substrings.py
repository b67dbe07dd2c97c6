"""Repeated passages removed by difference-cover anchors (operator 10).

{0, 1, 3} is a difference cover modulo 7: for any two places some shift below 7 brings both to a residue of the cover. So
two equal windows of 13 words share an anchor, seven words at a cover place of both texts, and only 3 of 7 places are
hashed. Texts are compressed and put into units of about ``UNIT_BYTES``, as they come, without a shuffle. Then:

1. Each unit sends each of its anchors once, with the smallest document that has it and whether another has it too. A
   bucket of anchors tells the units which anchors stand in two documents or more.
2. A unit extends those, and those it shares within itself, to the windows of 13 words around them.
3. Each unit sends each such window once, with the smallest document that has it; a bucket of windows tells the units
   which have a smaller document elsewhere. A unit removes the words under windows that a smaller document has.

Between units and buckets one row passes for each pair of them that has anything to say, with all hashes in it, so there
are never more rows than hashes; a hash arrives as often as there are units, however common it is, and no row is addressed
to a document, so neither a common text nor a common id makes a large group. Anchors are 63-bit hashes, and only choose
candidates; windows are compared by 128 bits.

Defined results: a null or empty text has no words and keeps none; texts below 13 words lose nothing; rows of one id, equal
or not, count as one document and none removes from another; a null id sorts before all; an empty table gives no row; other
columns are ignored. A text longer than a unit is one by itself.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import groups_for, shuffle_partitions, staged, text_bytes
from tidewatch.session import remove_shared_folder, shared_folder

WINDOW, PERIOD, COVER = 13, 7, (0, 1, 3)
ANCHOR = WINDOW - PERIOD + 1
#: Bytes of text whose hashes share a bucket, on average; bytes of text in a unit.
BUCKET_BYTES = 16_000_000
UNIT_BYTES = 12_000_000
#: Stands for a null id, which sorts before all.
NULL_ID = -(2**63)
ROWS = 256
UNITS = "unit long, doc_id long, data binary"
SENT = "bucket long, unit long, hashes binary"
TOLD = "unit long, hashes binary"
RESULT = "doc_id long, n_words long, n_removed long, kept_sha256 string, kept_text string"
FIRST = f"{RESULT}, unit long, data binary, marks binary"
NAMES = ["doc_id", "n_words", "n_removed", "kept_sha256", "kept_text"]
TYPES = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string())
_MIX = np.uint64(0x9E3779B97F4A7C15)
_ONE = np.uint64(1)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(29))


def _rolled(h: np.ndarray, length: int, at: np.ndarray, factor: np.uint64) -> np.ndarray:
    """A hash of ``length`` words from each place of ``at``; every step mixes, so order counts."""
    out = np.zeros(len(at), np.uint64)
    for k in range(length):
        out = _mixed(out * factor + h[at + k])
    return out


def packed_text(text: str | None) -> bytes | None:
    return None if text is None else zstandard.ZstdCompressor(level=3).compress(text.encode("utf-8", "surrogatepass"))


def unpacked_words(data: bytes | None) -> list[bytes]:
    return zstandard.ZstdDecompressor().decompress(data).split() if data else []


class Unit:
    """The words of some documents, one after another."""

    def __init__(self, ids: list[int | None], data: list[bytes | None]):
        self.ids, self.data = ids, data
        self.words: list[bytes] = []
        bounds = [0]
        for part in data:
            self.words += unpacked_words(part)
            bounds.append(len(self.words))
        self.bounds = np.array(bounds)
        self.sizes = np.diff(self.bounds)
        self.docs = np.array([NULL_ID if i is None else i for i in ids], np.int64)
        self.h = np.fromiter(map(xxhash.xxh3_64_intdigest, self.words), np.uint64, len(self.words))
        self.doc_of = np.repeat(np.arange(len(ids)), self.sizes)
        self.place = np.arange(len(self.words)) - self.bounds[self.doc_of]

    def anchors(self) -> tuple[np.ndarray, np.ndarray]:
        """Places and hashes of all anchors; a text too short for a window has none."""
        size = self.sizes[self.doc_of]
        at = np.flatnonzero(np.isin(self.place % PERIOD, COVER) & (self.place + ANCHOR <= size) & (size >= WINDOW))
        return at, _rolled(self.h, ANCHOR, at, _MIX) & ~_ONE

    def around(self, at: np.ndarray) -> np.ndarray:
        """Which words start a window that holds an anchor at one of ``at``."""
        marked = np.zeros(len(self.words), bool)
        for back in range(PERIOD):
            inside = (self.place[at] >= back) & (self.place[at] - back + WINDOW <= self.sizes[self.doc_of[at]])
            marked[at[inside] - back] = True
        return marked

    def windows(self, starts: np.ndarray) -> np.ndarray:
        """128 bits of each window, as 16-byte rows."""
        out = np.empty((len(starts), 2), np.uint64)
        out[:, 0] = _rolled(self.h, WINDOW, starts, _MIX)
        out[:, 1] = _rolled(self.h ^ np.uint64(0x5851F42D4C957F2D), WINDOW, starts, np.uint64(0xC2B2AE3D27D4EB4F))
        return out

    def results(self, which: np.ndarray, covered: np.ndarray, with_text: bool) -> list[pa.Array]:
        made = []
        for i in which.tolist():
            a, b = self.bounds[i], self.bounds[i + 1]
            hit = covered[a:b]
            gone = int(hit.sum())
            words = self.words[a:b]
            left = b" ".join([w for w, c in zip(words, hit.tolist(), strict=True) if not c] if gone else words)
            made.append((self.ids[i], len(words), gone, hashlib.sha256(left).hexdigest(), left.decode("utf-8", "surrogatepass") if with_text else None))
        return [pa.array([m[k] for m in made], kind) for k, kind in enumerate(TYPES)]


def _groups(hashes: np.ndarray, docs: np.ndarray):
    """Entries by hash, then document: their order, where each hash starts, and the smallest and largest document of each."""
    order = np.lexsort((docs, hashes)) if hashes.ndim == 1 else np.lexsort((docs, hashes[:, 1], hashes[:, 0]))
    h = hashes[order]
    new = np.ones(len(h), bool)
    new[1:] = h[1:] != h[:-1] if hashes.ndim == 1 else (h[1:] != h[:-1]).any(axis=1)
    starts = np.flatnonzero(new)
    return order, starts, docs[order][starts], docs[order][np.r_[starts[1:], len(h)] - 1] if len(h) else docs[:0]


def pack(lows: np.ndarray, hashes: np.ndarray) -> bytes:
    """Hashes with a document each, which follow in runs."""
    order = np.argsort(lows, kind="stable")
    lows, hashes = lows[order], hashes[order]
    starts = np.flatnonzero(np.r_[True, lows[1:] != lows[:-1]]) if len(lows) else np.zeros(0, int)
    counts = np.diff(np.r_[starts, len(lows)])
    return struct.pack("<I", len(starts)) + lows[starts].astype("<i8").tobytes() + counts.astype("<u4").tobytes() + hashes.astype("<u8").tobytes()


def unpack(data: bytes, width: int) -> tuple[np.ndarray, np.ndarray]:
    runs = struct.unpack_from("<I", data)[0]
    lows, counts = np.frombuffer(data, "<i8", runs, 4), np.frombuffer(data, "<u4", runs, 4 + 8 * runs)
    hashes = np.frombuffer(data, "<u8", -1, 4 + 12 * runs)
    return np.repeat(lows, counts), hashes if width == 1 else hashes.reshape(-1, width)


def _rows(schema: str, *columns) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "binary": pa.binary()}
    fields = [f.split(" ") for f in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[kind]) for c, (_, kind) in zip(columns, fields, strict=True)], names=[name for name, _ in fields])


def _to_buckets(unit: int, lows: np.ndarray, hashes: np.ndarray, buckets: int) -> pa.RecordBatch:
    key = hashes if hashes.ndim == 1 else hashes[:, 0]
    bucket = ((key >> np.uint64(17)) % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    found, starts = np.unique(bucket[order], return_index=True)
    parts = [pack(lows[o], hashes[o]) for o in np.split(order, starts[1:])] if len(found) else []
    return _rows(SENT, found, [unit] * len(found), parts)


def _in_units(batches):
    """Texts, compressed, with a number for each run of about ``UNIT_BYTES`` of them."""
    from pyspark import TaskContext

    unit, size = TaskContext.get().partitionId() << 32, 0
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            part = batch.slice(at, ROWS)
            units, data = [], []
            for text in part.column(1).to_pylist():
                if size and size + len(text or "") > UNIT_BYTES:
                    unit, size = unit + 1, 0
                size += len(text or "")
                units.append(unit)
                data.append(packed_text(text))
            yield pa.RecordBatch.from_arrays([pa.array(units, pa.int64()), part.column(0), pa.array(data, pa.binary())], names=["unit", "doc_id", "data"])


def _unit_runs(batches) -> Iterator[tuple[int, list[list]]]:
    """(unit, columns) for each run of rows of one unit; a run that was split between tasks comes in parts."""
    unit, held = None, []
    for batch in batches:
        columns = [c.to_pylist() for c in batch.columns]
        cuts = [i for i in range(1, batch.num_rows) if columns[0][i] != columns[0][i - 1]]
        for a, b in zip([0, *cuts], [*cuts, batch.num_rows], strict=True):
            if a == b:
                continue
            if columns[0][a] != unit and held:
                yield unit, held
                held = []
            unit = columns[0][a]
            held = [x + c[a:b] for x, c in zip(held, columns[1:], strict=True)] if held else [c[a:b] for c in columns[1:]]
    if held:
        yield unit, held


def _send_anchors(buckets: int):
    def run(batches):
        for unit, (ids, data) in _unit_runs(batches):
            texts = Unit(ids, data)
            at, h = texts.anchors()
            order, starts, low, high = _groups(h, texts.docs[texts.doc_of[at]])
            yield _to_buckets(unit, low, h[order][starts] | (low != high).astype(np.uint64), buckets)

    return run


def _answer_anchors(group: pa.Table) -> pa.Table:
    """Anchors of two documents or more, for each unit that sent one of a single document."""
    units, lows, hashes = _received(group, 1)
    several = hashes & _ONE
    hashes = hashes & ~_ONE
    order, starts, low, high = _groups(hashes, lows)
    shared = (low != high) | (np.maximum.reduceat(several[order], starts) > 0)
    told = np.repeat(shared, np.diff(np.r_[starts, len(order)])) & (several[order] == 0)
    return _to_units(units[order][told], hashes[order][told, None])


def _send_windows(buckets: int):
    def run(batches):
        for unit, (ids, data, marks) in _unit_runs(batches):
            texts = Unit(ids, data)
            starts = _marked(texts, marks)
            h = texts.windows(starts)
            order, first, low, _ = _groups(h, texts.docs[texts.doc_of[starts]])
            yield _to_buckets(unit, low, h[order][first], buckets)

    return run


def _answer_windows(group: pa.Table) -> pa.Table:
    """Windows with the smallest document that has them, for each unit whose own smallest is larger."""
    units, lows, hashes = _received(group, 2)
    order, starts, low, _ = _groups(hashes, lows)
    least = np.repeat(low, np.diff(np.r_[starts, len(order)]))
    told = lows[order] > least
    return _to_units(units[order][told], np.c_[hashes[order][told], least[told].view(np.uint64)])


def _received(group: pa.Table, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    parts = [unpack(part.as_buffer(), width) for part in group["hashes"]]
    units = np.repeat(group["unit"].to_numpy(), [len(p[0]) for p in parts])
    return units, np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])


def _to_units(units: np.ndarray, values: np.ndarray) -> pa.Table:
    order = np.argsort(units, kind="stable")
    found, starts = np.unique(units[order], return_index=True)
    parts = [np.ascontiguousarray(values[o]).astype("<u8").tobytes() for o in np.split(order, starts[1:])] if len(found) else []
    return pa.Table.from_batches([_rows(TOLD, found, parts)])


def _told(group: pa.Table, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(group["hashes"].to_pylist()), "<u8").reshape(-1, width)


def _mark(with_text: bool):
    """Task over one unit: ends the work on documents without a window to compare, and marks the windows of the others."""

    def run(docs: pa.Table, told: pa.Table) -> pa.Table:
        if not len(docs):
            return pa.table({n: pa.array([], t) for n, t in zip([*NAMES, "unit", "data", "marks"], [*TYPES, pa.int64(), pa.binary(), pa.binary()], strict=True)})
        ids, data = docs["doc_id"].to_pylist(), docs["data"].to_pylist()
        texts = Unit(ids, data)
        at, h = texts.anchors()
        order, starts, low, high = _groups(h, texts.docs[texts.doc_of[at]])
        flagged = np.union1d(h[order][starts][low != high], _told(told, 1)[:, 0])
        marked = texts.around(at[np.isin(h, flagged)])
        waits = np.zeros(len(ids), bool)
        waits[texts.doc_of[marked]] = True
        done, waiting = np.flatnonzero(~waits), np.flatnonzero(waits)
        bits = [zlib.compress(np.packbits(marked[texts.bounds[i]:texts.bounds[i + 1]]).tobytes(), 1) for i in waiting.tolist()]
        ended = pa.table([*texts.results(done, np.zeros(len(texts.words), bool), with_text), *(pa.nulls(len(done), t) for t in (pa.int64(), pa.binary(), pa.binary()))], names=[*NAMES, "unit", "data", "marks"])
        unit = docs["unit"][0].as_py()
        left = [pa.array([ids[i] for i in waiting.tolist()], pa.int64()), *(pa.nulls(len(waiting), t) for t in TYPES[1:])]
        open_ = pa.table([*left, pa.array([unit] * len(waiting), pa.int64()), pa.array([data[i] for i in waiting.tolist()], pa.binary()), pa.array(bits, pa.binary())], names=ended.column_names)
        return pa.concat_tables([ended, open_])

    return run


def _marked(texts: Unit, marks: list[bytes]) -> np.ndarray:
    """Starts of the marked windows of a unit's documents."""
    bits = [np.unpackbits(np.frombuffer(zlib.decompress(m), np.uint8), count=n) for m, n in zip(marks, texts.sizes.tolist(), strict=True)]
    return np.flatnonzero(np.concatenate(bits))


def _remove(with_text: bool):
    """Task over one unit: documents without the words under windows that a smaller document has."""

    def run(docs: pa.Table, told: pa.Table) -> pa.Table:
        if not len(docs):
            return pa.table({n: pa.array([], t) for n, t in zip(NAMES, TYPES, strict=True)})
        texts = Unit(docs["doc_id"].to_pylist(), docs["data"].to_pylist())
        starts = _marked(texts, docs["marks"].to_pylist())
        answers = _told(told, 3)
        mine = texts.docs[texts.doc_of[starts]]
        every = np.concatenate([texts.windows(starts), answers[:, :2]])
        order, first, low, _ = _groups(every, np.concatenate([mine, answers[:, 2].view(np.int64)]))
        least = np.empty(len(every), np.int64)
        least[order] = np.repeat(low, np.diff(np.r_[first, len(every)]))
        hit = starts[mine > least[: len(starts)]]
        edges = np.zeros(len(texts.words) + 1, np.int64)
        np.add.at(edges, hit, 1)
        np.add.at(edges, hit + WINDOW, -1)
        covered = np.cumsum(edges[:-1]) > 0
        return pa.table(texts.results(np.arange(len(texts.ids)), covered, with_text), names=NAMES)

    return run


def without_repeats(docs: DataFrame, with_text: bool = True) -> DataFrame:
    """``doc_id``, ``n_words``, ``n_removed``, ``kept_sha256`` and ``kept_text`` (null unless asked for) of every document.

    Texts, compressed, are moved once to meet what their unit was told; those without a window to compare are done then,
    and only the others are staged and moved again. Before that the first pass gives back its disk: the units and all that
    was shuffled.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    buckets = groups_for(text_bytes(rows), BUCKET_BYTES, shuffle_partitions(docs.sparkSession))

    folder = shared_folder(docs.sparkSession, "units")
    units = staged(rows.mapInArrow(_in_units, UNITS), "units", folder)
    anchors = units.mapInArrow(_send_anchors(buckets), SENT).groupBy("bucket").applyInArrow(_answer_anchors, TOLD)
    first = staged(units.groupBy("unit").cogroup(anchors.groupBy("unit")).applyInArrow(_mark(with_text), FIRST), "first-pass", release=True)
    remove_shared_folder(docs.sparkSession, folder)
    waiting = first.where("marks IS NOT NULL").select("unit", "doc_id", "data", "marks")
    windows = waiting.mapInArrow(_send_windows(buckets), SENT).groupBy("bucket").applyInArrow(_answer_windows, TOLD)
    changed = waiting.groupBy("unit").cogroup(windows.groupBy("unit")).applyInArrow(_remove(with_text), RESULT)
    return first.where("marks IS NULL").select(*NAMES).union(changed)
