"""Token ids as one wavelet matrix per shard, in ascending document order (operator 3).

Documents are range-partitioned by id, encoded, and written as shard files to the shared folder. A file holds one bit
plane per id bit with a directory of ranks, so a token is read, an id counted up to a place, or its k-th occurrence
found, without decoding the rest; and it holds the shard's document ids and lengths. At most ``SHARD_TOKENS`` ids (or one
longer document) stand in a file, which bounds a task's memory.

Defined results: a null text is an empty one, which has only the end id; documents of equal id stand side by side, ordered
by text; a null id sorts first; an empty table writes no file and gives no row; other columns are ignored.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.llm.common import open_folder, shuffle_partitions, staged, write_whole
from tidewatch.llm.tokens import encoder, slices
from tidewatch.session import shared_folder

MAGIC = b"TWWM0001"
SHARD_TOKENS = 2_000_000
BLOCK = 2048  # bits between two entries of the rank directory
MANIFEST = "file string, first_doc long, n_docs long, n_tokens long"
READ = "doc_id long, start long, n_tokens long, ids_crc32 long"


class WaveletMatrix:
    """Ids below 2**planes. ``planes[0]`` holds the highest bits; each plane orders the next, zeros first."""

    def __init__(self, n: int, planes: list[np.ndarray], zeros: list[int], ranks: list[np.ndarray]):
        self.n, self.planes, self.zeros, self.ranks = n, planes, zeros, ranks

    @classmethod
    def build(cls, ids: np.ndarray) -> WaveletMatrix:
        depth = max(1, int(ids.max(initial=0)).bit_length())
        kind = np.uint16 if depth <= 16 else np.uint32
        ids, planes, zeros, ranks = ids.astype(kind), [], [], []
        for k in range(depth - 1, -1, -1):
            ones = ids & kind(1 << k) != 0
            packed = np.packbits(ones, bitorder="little")
            counts = np.add.reduceat(np.bitwise_count(packed), np.arange(0, len(packed), BLOCK // 8), dtype=np.uint32) if len(packed) else np.zeros(0, np.uint32)
            planes.append(packed)
            ranks.append(np.concatenate([np.zeros(1, np.uint32), np.cumsum(counts, dtype=np.uint32)]))
            mask, values = pa.Array.from_buffers(pa.bool_(), len(ids), [None, pa.py_buffer(packed)]), pa.array(ids)
            low, high = (values.filter(m).to_numpy() for m in (pc.invert(mask), mask))
            zeros.append(len(low))
            ids = np.concatenate([low, high])
        return cls(sum(map(len, (ids,))), planes, zeros, ranks)

    def _ones(self, level: int, i: int) -> int:
        """Ones of a plane before place ``i``."""
        block = i // BLOCK
        at = block * BLOCK // 8
        count = int(self.ranks[level][block]) + int(np.bitwise_count(self.planes[level][at : i // 8]).sum(dtype=np.int64))
        return count + (int(self.planes[level][i // 8]) & ((1 << i % 8) - 1)).bit_count() if i % 8 else count

    def _bit(self, level: int, i: int) -> int:
        return int(self.planes[level][i // 8]) >> (i % 8) & 1

    def access(self, i: int) -> int:
        value = 0
        for level, zeros in enumerate(self.zeros):
            bit, ones = self._bit(level, i), self._ones(level, i)
            value, i = value << 1 | bit, zeros + ones if bit else i - ones
        return value

    def _range(self, value: int, i: int) -> tuple[int, int]:
        """Where the occurrences of ``value`` before place ``i`` stand after the last plane."""
        if value >> len(self.planes):
            return 0, 0
        low = 0
        for level, zeros in enumerate(self.zeros):
            a, b = self._ones(level, low), self._ones(level, i)
            low, i = (zeros + a, zeros + b) if value >> (len(self.planes) - 1 - level) & 1 else (low - a, i - b)
        return low, i

    def count(self, value: int, i: int | None = None) -> int:
        low, high = self._range(value, self.n if i is None else i)
        return high - low

    def occurrence(self, value: int, k: int) -> int:
        """Place of the k-th occurrence (from 0); IndexError beyond the last."""
        low, high = self._range(value, self.n)
        if not 0 <= k < high - low:
            raise IndexError(k)
        place = low + k
        for level in range(len(self.planes) - 1, -1, -1):
            zeros = self.zeros[level]
            one = place >= zeros
            place = self._select(level, place - zeros if one else place, one)
        return place

    def _select(self, level: int, k: int, one: bool) -> int:
        """Place of the k-th one or zero of a plane: search the directory, then one block."""
        starts = self.ranks[level].astype(np.int64)
        if not one:
            starts = np.minimum(np.arange(len(starts)) * BLOCK, self.n) - starts
        block = int(np.searchsorted(starts, k, side="right")) - 1
        at = block * BLOCK
        bits = np.unpackbits(self.planes[level][at // 8 : (at + BLOCK) // 8], bitorder="little")[: self.n - at]
        return at + int(np.flatnonzero(bits == one)[k - int(starts[block])])

    def decode(self) -> np.ndarray:
        """All ids: each plane, from the last, undoes its ordering."""
        kind = np.uint16 if len(self.planes) <= 16 else np.uint32
        ids = np.zeros(self.n, kind)
        for level in range(len(self.planes) - 1, -1, -1):
            ones = np.unpackbits(self.planes[level], count=self.n, bitorder="little").astype(bool)
            before = np.empty(self.n, kind)
            before[np.flatnonzero(~ones)] = ids[: self.zeros[level]]
            before[np.flatnonzero(ones)] = ids[self.zeros[level] :] | kind(1 << (len(self.planes) - 1 - level))
            ids = before
        return ids

    def chunks(self) -> Iterator[bytes]:
        yield struct.pack("<QQ", self.n, len(self.planes))
        yield np.array(self.zeros, "<u8").tobytes()
        for plane, ranks in zip(self.planes, self.ranks, strict=True):
            yield ranks.astype("<u4").tobytes()
            yield plane.tobytes()

    @classmethod
    def read(cls, data: bytes) -> WaveletMatrix:
        n, depth = struct.unpack_from("<QQ", data)
        zeros = np.frombuffer(data, "<u8", depth, 16).astype(int).tolist()
        at, width, blocks, planes, ranks = 16 + 8 * depth, -(-n // 8), -(-n // BLOCK), [], []
        for _ in range(depth):
            ranks.append(np.frombuffer(data, "<u4", blocks + 1, at))
            planes.append(np.frombuffer(data, np.uint8, width, at + 4 * (blocks + 1)))
            at += 4 * (blocks + 1) + width
        return cls(n, planes, zeros, ranks)


def shard_chunks(ids: np.ndarray, doc_ids: list[int | None], lengths: list[int]) -> Iterator[bytes]:
    """A shard file: magic, size of the document part, document part (compressed), wavelet matrix."""
    docs = pa.table({"doc_id": pa.array(doc_ids, pa.int64()), "n": pa.array(lengths, pa.int64())})
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, docs.schema) as out:
        out.write_table(docs)
    part = zlib.compress(sink.getvalue().to_pybytes(), 6)
    yield MAGIC + struct.pack("<Q", len(part))
    yield part
    yield from WaveletMatrix.build(ids).chunks()


def read_shard(data: bytes) -> tuple[WaveletMatrix, list[int | None], np.ndarray]:
    """Wavelet matrix, document ids and lengths of a shard file."""
    if data[:8] != MAGIC:
        raise ValueError("not a shard file")
    size = struct.unpack_from("<Q", data, 8)[0]
    docs = pa.ipc.open_stream(zlib.decompress(data[16 : 16 + size])).read_all()
    return WaveletMatrix.read(data[16 + size :]), docs["doc_id"].to_pylist(), docs["n"].to_numpy()


def write_shards(docs: DataFrame, folder: str, tokenizer_path: str, end_id: int = 0) -> DataFrame:
    """Encode and write all documents; returns the table of files (``MANIFEST``), written once."""

    def write(batches):
        coder, ids, doc_ids, lengths, size = encoder(tokenizer_path, leading_space=True), [], [], [], 0
        end = np.array([end_id], "<u4").tobytes()

        def flush() -> pa.RecordBatch:
            name = write_whole(folder, f"shard-{doc_ids[0]}", shard_chunks(np.frombuffer(b"".join(ids), "<u4"), doc_ids, lengths))
            made = pa.RecordBatch.from_pylist(
                [{"file": name, "first_doc": doc_ids[0], "n_docs": len(doc_ids), "n_tokens": size}],
                pa.schema([("file", pa.string()), ("first_doc", pa.int64()), ("n_docs", pa.int64()), ("n_tokens", pa.int64())]))
            ids.clear(), doc_ids.clear(), lengths.clear()
            return made

        for batch in batches:
            keys, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for a, b in slices(texts):
                for key, coded in zip(keys[a:b], coder.ids(texts[a:b]), strict=True):
                    n = len(coded) // 4 + 1
                    if size and size + n > SHARD_TOKENS:
                        yield flush()
                        size = 0
                    ids += (coded, end)
                    doc_ids.append(key)
                    lengths.append(n)
                    size += n
        if doc_ids:
            yield flush()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    ordered = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    return staged(ordered.mapInArrow(write, MANIFEST), "token-shards")


def read_documents(manifest: DataFrame, folder: str) -> DataFrame:
    """Read every shard file back: place, length and checksum of each document's ids (``READ``).

    Only the table of files, a few rows for every million ids, is ordered as a whole to place the shards.
    """
    order = Window.orderBy(F.col("first_doc").asc_nulls_first(), "file").rowsBetween(Window.unboundedPreceding, -1)
    placed = manifest.select("file", F.coalesce(F.sum("n_tokens").over(order), F.lit(0)).alias("start"))

    def read(batches):
        for batch in batches:
            for name, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                system, path = open_folder(folder)
                with system.open_input_file(f"{path}/{name}") as file:
                    matrix, doc_ids, lengths = read_shard(file.read())
                ids = matrix.decode().astype("<u4")
                ends = np.cumsum(lengths)
                starts = ends - lengths
                sums = [zlib.crc32(ids[a:b].tobytes()) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(doc_ids, pa.int64()), pa.array(starts + start, pa.int64()), pa.array(lengths, pa.int64()), pa.array(sums, pa.int64())],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return placed.repartition(shuffle_partitions(manifest.sparkSession), F.col("file")).mapInArrow(read, READ)


def token_documents(docs: DataFrame, tokenizer_path: str, end_id: int = 0) -> DataFrame:
    """Write the documents' ids as shards in the shared folder and return what reading them back gives."""
    folder = shared_folder(docs.sparkSession, "wavelet")
    return read_documents(write_shards(docs, folder, tokenizer_path, end_id), folder)
