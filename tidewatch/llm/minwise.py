"""Documents that share four fifths of their five-word shingles: the wider search of the pipeline's near-duplicate stage.

Two documents of similarity 0.8 differ in about ten of 64 SimHash bits, and no chain of segments within such a budget leaves
a key worth looking up. So this search takes min-wise fingerprints: ``SLOTS`` slots of a byte each, of which two documents
share about as many as their similarity says. ``BANDS`` bands of eight slots are keys; a pair is compared where a band is
equal, and linked where at least ``LEAST_EQUAL`` slots are.

A band's group is cut into parts of about ``PART`` fingerprints. In a part, each fingerprint is compared with the leaders, those
that were like none before them, and links to all that it is like; the leaders of the parts of a group are then compared in
the same way. So a group of n near copies costs n comparisons with a few leaders, not n squared, and no task holds a group.
The order within a part is another one in each band, so that two documents which missed each other behind one leader meet in
other bands. Equal fingerprints are one row from the start.

Defined results: a null text or one without words has the empty fingerprint, like any other of its kind; a null id sorts after
all; rows equal in id and text are one document and stay or go together; an empty table gives no row; columns of any name
pass through.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import staged, unused
from tidewatch.llm.simhash import components, shingles

WORDS = 5
BANDS, BAND_SLOTS = 30, 8
SLOTS = BANDS * BAND_SLOTS
#: Equal slots of a link: similarity 0.8 less 0.7 standard deviations of the share of equal slots.
LEAST_EQUAL = round((0.8 - 0.7 * (0.8 * 0.2 / SLOTS) ** 0.5) * SLOTS)
#: Fingerprints of a part of a band's group; hashes that are multiplied at once.
PART, CHUNK = 4096, 2048
_FACTORS = np.random.default_rng(20_240_101).integers(1, 2**63, SLOTS, np.uint64) * np.uint64(2) + np.uint64(1)


def fingerprint(hashes: np.ndarray) -> bytes:
    """The low byte of the least product of each slot's factor with any of the hashes (upper halves are compared)."""
    least = np.full(SLOTS, 2**64 - 1, np.uint64)
    hashes = hashes ^ (hashes >> np.uint64(29))
    for at in range(0, len(hashes), CHUNK):
        np.minimum(least, (hashes[at : at + CHUNK, None] * _FACTORS[None, :]).min(axis=0), out=least)
    return ((least >> np.uint64(32)) & np.uint64(0xFF)).astype(np.uint8).tobytes()


def _fingerprints(batches):
    for batch in batches:
        hashes = batch.column(1)
        values, ends = hashes.flatten().to_numpy(zero_copy_only=False).astype("<i8", copy=False).view(np.uint64), hashes.offsets.to_numpy()
        ends = (ends - ends[0]).tolist()
        prints = [fingerprint(values[a:b]) for a, b in zip(ends[:-1], ends[1:], strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(prints, pa.binary())], names=["row", "doc_id", "print"])


def _row_key(doc_id: str = "doc_id", text: str = "text"):
    return F.xxhash64(F.col(doc_id).cast("long"), F.col(text).cast("string"))


def fingerprints(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """``row`` (hash of id and text), ``doc_id`` and ``print`` of every row."""
    rows = docs.select(_row_key().alias("row"), shingles(F.col("text").cast("string"), words).alias("hashes"), F.col("doc_id").cast("long").alias("doc_id"))
    return rows.mapInArrow(_fingerprints, "row long, doc_id long, print binary")


def _banded(batches):
    """A row for each band: number, its eight slots as a key, node, and the node's place in the band's own order."""
    for batch in batches:
        nodes = batch.column(0).to_numpy()
        keys = np.frombuffer(b"".join(batch.column(1).to_pylist()), "<i8").reshape(-1, BANDS)
        for band in range(BANDS):
            place = (nodes.view(np.uint64) ^ _FACTORS[band]) * _FACTORS[-1 - band] >> np.uint64(24)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(nodes), band, np.int32)), pa.array(keys[:, band]), pa.array(nodes), pa.array(place.astype(np.int64))],
                names=["band", "key", "node", "place"])


class Leaders:
    """The fingerprints of one part that were like none before them."""

    def __init__(self):
        self.nodes: list[int] = []
        self.prints = np.empty((4, SLOTS), np.uint8)

    def meet(self, node: int, print_: bytes) -> list[int]:
        """The leaders that a fingerprint is like; one that is like none becomes a leader."""
        mine, n = np.frombuffer(print_, np.uint8), len(self.nodes)
        like = np.flatnonzero((self.prints[:n] == mine).sum(axis=1) >= LEAST_EQUAL) if n else ()
        if not len(like):
            if n == len(self.prints):
                self.prints = np.concatenate([self.prints, np.empty_like(self.prints)])
            self.prints[n] = mine
            self.nodes.append(node)
        return [self.nodes[i] for i in like]


LINKS = "a long, b long, band int, key long"


def _lead(batches):
    """Rows sorted by band, key, part and place; links, and each leader as a link to itself that names its group."""
    group, leaders = None, Leaders()

    def of_leaders():
        return [(node, node, group[0], group[1]) for node in leaders.nodes]

    out = []
    for batch in batches:
        for band, key, part, node, print_ in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if (band, key, part) != group:
                if group:
                    out += of_leaders()
                group, leaders = (band, key, part), Leaders()
            out += [(leader, node, band, key) for leader in leaders.meet(node, print_)]
        if len(out) > 10_000:
            yield _links(out)
            out = []
    if group:
        out += of_leaders()
    if out:
        yield _links(out)


def _links(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=["a", "b", "band", "key"])


def links(nodes: DataFrame) -> DataFrame:
    """Links (a, b) between ``node``s by their ``print``s. Prints meet keys only where a key is shared."""
    banded = nodes.mapInArrow(_banded, "band int, key long, node long, place long")
    shared = banded.groupBy("band", "key").agg(F.count("*").alias("n")).where("n > 1")
    # As in op2's search: a row for each band is more than Spark expects of mapInArrow, so it must not choose a broadcast.
    met = staged(banded.join(shared.hint("merge"), ["band", "key"]).withColumn("part", F.pmod("place", F.ceil(F.col("n") / PART).cast("long"))), "bands")

    def led(rows: DataFrame) -> DataFrame:
        order = ["band", "key", "part"]
        rows = rows.join(nodes, "node").select(*order, "node", "print", "place")
        return staged(rows.repartition(*order).sortWithinPartitions(*order, "place", "node").drop("place").mapInArrow(_lead, LINKS), "leaders")

    first = led(met)
    cut = met.where(F.col("n") > PART).select("band", "key").distinct()
    again = first.where("a = b").join(cut, ["band", "key"], "left_semi").select("band", "key", F.lit(0).cast("long").alias("part"), F.col("a").alias("node"), F.col("a").alias("place"))
    return first.unionByName(led(again)).where("a <> b").select("a", "b").distinct()


def one_of_each(docs: DataFrame, words: int = WORDS, also: DataFrame | None = None) -> DataFrame:
    """Of each group of similar documents the one with the smallest id, with its own columns; with ``also`` (``doc_id``, those
    that another search keeps) only if that keeps it too, or if it has no id.

    The smallest id of all that the two searches connect is kept by both, so each such group keeps one. Documents are moved
    once, to meet what stays.
    """
    prints = staged(fingerprints(docs, words), "min-wise")
    smallest = F.min(F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "row"))
    nodes = staged(prints.groupBy("print").agg(smallest.alias("least")).withColumn("node", F.xxhash64("print")).select("node", "print", "least"), "min-wise-nodes")
    rooted = components(links(nodes.select("node", "print")))
    of = nodes.select("node", "least").join(rooted, "node", "left").select(F.coalesce("root", "node").alias("root"), "least")
    stay = of.groupBy("root").agg(F.min("least").alias("least")).select("least.row")
    if also is not None:
        known = prints.select("row", "doc_id")
        allowed = known.join(also.select("doc_id"), "doc_id", "left_semi").select("row").union(known.where("doc_id IS NULL").select("row"))
        stay = stay.join(allowed, "row", "left_semi")
    row = unused(docs, "row")
    stay = stay.select(F.col("row").alias(row))
    return docs.withColumn(row, _row_key()).join(stay, row, "left_semi").select(*[F.col(f"`{c}`") for c in docs.columns])
