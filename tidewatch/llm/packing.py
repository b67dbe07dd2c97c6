"""First-fit decreasing packing with a tournament tree, in random groups of documents (operator 4).

A document's group is a hash of its place in the input, so neither a common id nor a common text makes a large group; there
are as many groups as keep each at about ``GROUP_BYTES`` of text, so memory is bounded at any size. (Rows must come in an
order that does not change when a task is repeated, as those of files do.) In a group, whole sequences are cut off long documents first; what is left of each goes, longest
first, to the first sequence that has room. A sequence more than the group's ids need is taken apart to fill the gaps of
the others, so a group pads less than one sequence. A sequence whose length is a power of two is not padded.

Defined results: a null or empty text is its end id alone; documents of equal id are packed each for itself; a null id is
kept; an empty table gives no row; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import groups_for, text_bytes
from tidewatch.llm.tokens import encoder, slices

SEQUENCE = 4096
GROUP_BYTES = 4_000_000
PIECES = "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"
#: Sequence ids of a group are its number shifted left by this many bits, plus the place in the group.
GROUP_SHIFT = 28


class TournamentTree:
    """Rooms of bins in the leaves, the larger of two children in each parent: the first bin with room in log steps."""

    def __init__(self, bins: int, room: int):
        self.leaves = 1 << max(0, bins - 1).bit_length()
        self.most = [room] * (2 * self.leaves)

    def place(self, size: int) -> int:
        """Take ``size`` from the first bin that has it; there must be one."""
        most, node = self.most, 1
        while node < self.leaves:
            node *= 2
            if most[node] < size:
                node += 1
        most[node] -= size
        found = node - self.leaves
        while node > 1:
            node //= 2
            most[node] = max(most[2 * node], most[2 * node + 1])
        return found


def pack(lengths: list[int], room: int = SEQUENCE) -> list[tuple[int, int, int, int, int]]:
    """Pieces (document, start, length, sequence, offset) of documents of these lengths, all at least 1."""
    pieces, sequence, rest = [], 0, []
    for doc, n in enumerate(lengths):
        for start in range(0, n - n % room, room):
            pieces.append((doc, start, room, sequence, 0))
            sequence += 1
        if n % room:
            rest.append((n % room, doc, n - n % room))
    rest.sort(key=lambda x: (-x[0], x[1]))
    tree, bins = TournamentTree(len(rest), room), []
    for size, doc, start in rest:
        at = tree.place(size)
        if at == len(bins):
            bins.append([])
        bins[at].append((doc, start, size))
    filled = [sum(x[2] for x in b) for b in bins]
    need = -(-sum(filled) // room)
    order = sorted(range(len(bins)), key=lambda i: (filled[i], -i))
    spare, keep = order[: len(bins) - need], sorted(order[len(bins) - need :])
    gaps = [i for i in keep if filled[i] < room]
    for i in spare:
        for doc, start, size in bins[i]:
            while size:
                to = gaps[-1]
                part = min(size, room - filled[to])
                bins[to].append((doc, start, part))
                filled[to] += part
                start, size = start + part, size - part
                if filled[to] == room:
                    gaps.pop()
    for i in keep:
        offset = 0
        for doc, start, size in bins[i]:
            pieces.append((doc, start, size, sequence, offset))
            offset += size
        sequence += 1
    return pieces


def encoded(docs: DataFrame, tokenizer_path: str, end_id: int) -> DataFrame:
    """``doc_id``, ``group_key`` and ids with the end id: unsigned integers of 16 bits where the vocabulary and the end id
    fit, else (``wide``) of 32."""

    def encode(batches):
        coder = encoder(tokenizer_path, leading_space=False)
        wide = max(coder.tokenizer.get_vocab_size(), end_id + 1) > 65_536
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for a, b in slices(texts):
                ids = [np.append(np.frombuffer(x, "<u4"), end_id).astype("<u4" if wide else "<u2").tobytes() for x in coder.ids(texts[a:b])]
                part = batch.slice(a, b - a)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("group_key"), pa.array([wide] * len(ids), pa.bool_()), pa.array(ids, pa.binary())], names=["doc_id", "group_key", "wide", "ids"])

    return docs.mapInArrow(encode, "doc_id long, group_key long, wide boolean, ids binary")


def pack_documents(docs: DataFrame, tokenizer_path: str, end_id: int, seed: int = 42) -> DataFrame:
    """All pieces of all documents with their ids (little-endian unsigned 32-bit)."""
    groups = groups_for(text_bytes(docs), GROUP_BYTES, 1)
    key = F.pmod(F.xxhash64(F.monotonically_increasing_id(), F.lit(seed)), F.lit(groups)).cast("long")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), key.alias("group_key"))

    def pack_group(group: pa.Table) -> pa.Table:
        group = group.sort_by([("doc_id", "ascending"), ("ids", "ascending")])
        kind = "<u4" if group["wide"][0].as_py() else "<u2"
        ids = [np.frombuffer(x.as_buffer(), kind) for x in group["ids"]]
        base = group["group_key"][0].as_py() << GROUP_SHIFT
        made = pack([len(x) for x in ids])
        docs_at, starts, lengths, sequences, offsets = (np.array(x, np.int64) for x in zip(*made, strict=True))
        return pa.table({
            "doc_id": group["doc_id"].combine_chunks().take(pa.array(docs_at)), "start": starts, "length": lengths,
            "doc_tokens": np.array([len(x) for x in ids], np.int64)[docs_at], "sequence_id": sequences + base, "offset": offsets,
            "ids": pa.array([ids[d][s : s + n].astype("<u4").tobytes() for d, s, n, _, _ in made], pa.binary()),
        })

    return encoded(rows, tokenizer_path, end_id).groupBy("group_key").applyInArrow(pack_group, PIECES)


def sequences(pieces: DataFrame) -> DataFrame:
    """The packed sequences: ids in order of offset, at most 4096 a row, and how far a trainer pads them."""
    ordered = F.array_sort(F.collect_list(F.struct("offset", "ids", "doc_id", "start", "length")))
    rows = pieces.groupBy("sequence_id").agg(ordered.alias("parts"))
    length = F.aggregate("parts", F.lit(0).cast("long"), lambda n, p: n + p["length"])
    return rows.select(
        "sequence_id", length.alias("length"),
        F.when(F.log2(length) == F.floor(F.log2(length)), length).otherwise(F.lit(SEQUENCE)).alias("padded"),
        F.aggregate("parts", F.lit(b"").cast("binary"), lambda b, p: F.concat(b, p["ids"])).alias("ids"),
        F.transform("parts", lambda p: p.dropFields("ids")).alias("parts"))
