"""SimHash near-duplicates: candidates by pigeonring chains, exact Hamming check, connected components (operator 2).

A fingerprint is a ring of eight segments of eight bits. If two differ in at most three bits, some chain of consecutive
segments keeps within the proportional budget at each of its lengths: length k may have floor(3k/8) differences. So its
first two segments are equal, and of the next three, with one difference together at most, two are equal. These four
segments (32 bits) are a key; there are 24 kinds, and a pair is a candidate only where a key is equal *and* the rest of
the chain keeps its budgets. The full check comes last. Equal fingerprints are one row from the start.

A key's group is compared by blocks, so no task holds more than two blocks of ``BLOCK`` fingerprints, and it emits a
spanning forest of the links it finds (at most as many as it has rows), never all pairs. Copies thus stay cheap, and
reachability is exact.

Defined results: a null text or one without words has fingerprint zero, linked like any other; repeated rows of one id
are one member; a null id is a member without a number: it has a component's smallest id, which is null only where no member
has one (``one_of_each`` keeps rows without an id); an empty table gives no row; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import SPACE_CLASS, staged, unused

SEGMENTS, WIDTH, DISTANCE = 8, 8, 3
#: Fingerprints of one key that are compared at once.
BLOCK = 2048
#: (first segment of the chain, equal segments) of each kind of key.
KINDS = [(s, (s, (s + 1) % 8, *(((s + 2 + k) % 8) for k in range(3) if k != left))) for s in range(SEGMENTS) for left in range(3)]


def _segment_mask(segments) -> int:
    return sum(0xFF << (WIDTH * s) for s in segments)


KEY_MASKS = np.array([_segment_mask(segments) for _, segments in KINDS], np.uint64)


def shingles(text: Column, words: int = 3) -> Column:
    """XXH64 (seed 42) of each ``words`` words of the lower-cased text, or of all words if they are fewer."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    plain = F.when(F.char_length(text) == F.octet_length(text), F.lower(text)).otherwise(F.translate(text, upper, lower))
    w = F.array_remove(F.split(plain, f"[{SPACE_CLASS}]+"), "")
    hashed = F.transform(F.array(w), lambda w: F.when(F.size(w) == 0, F.array().cast("array<bigint>")).when(
        F.size(w) < words, F.array(F.xxhash64(F.array_join(w, " ")))).otherwise(
        F.slice(F.transform(w, lambda x, i: F.xxhash64(F.concat_ws(" ", x, *[F.get(w, i + k) for k in range(1, words)]))), 1, F.size(w) - words + 1)))
    return F.coalesce(F.get(hashed, F.lit(0)), F.array().cast("array<bigint>"))


def _majority(values: np.ndarray) -> int:
    """Bits that over half of the hashes have, counted in slices so that a long text needs little memory."""
    ones = np.zeros(64, np.int64)
    for at in range(0, len(values), 65536):
        part = np.ascontiguousarray(values[at : at + 65536])
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(values), bitorder="little").view("<u8")[0])


def _fingerprints(batches):
    for batch in batches:
        hashes = batch.column(1)
        values, ends = hashes.flatten().to_numpy(zero_copy_only=False).astype("<i8", copy=False), hashes.offsets.to_numpy()
        ends = ends - ends[0]
        made = np.array([_majority(values[a:b]) for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)], np.uint64)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(made.view(np.int64))], names=["doc_id", "fingerprint"])


def fingerprints(docs: DataFrame, words: int = 3) -> DataFrame:
    """``doc_id`` and the 64 bits as a signed long."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), shingles(F.col("text").cast("string"), words).alias("hashes"))
    return rows.mapInArrow(_fingerprints, "doc_id long, fingerprint long")


def chain_keeps_budget(differing: np.ndarray, first: int) -> np.ndarray:
    """Whether the chain from segment ``first`` keeps floor(3k/8) at every length, for arrays of XORed fingerprints."""
    total, good = np.zeros(differing.shape, np.uint8), np.ones(differing.shape, bool)
    for k in range(SEGMENTS):
        total += np.bitwise_count((differing >> np.uint64(WIDTH * ((first + k) % SEGMENTS))) & np.uint64(0xFF))
        good &= total <= DISTANCE * (k + 1) // SEGMENTS
    return good


def _keys(batches):
    """A row for each kind of key: kind, the 32 key bits, fingerprint, and its block within hot keys."""
    for batch in batches:
        fp = batch.column(0).to_numpy().view(np.uint64)
        mixed = (fp * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)
        for kind in range(len(KINDS)):
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(fp), kind, np.int32)), pa.array((fp & KEY_MASKS[kind]).view(np.int64)), pa.array(fp.view(np.int64)), pa.array(mixed.astype(np.int64))],
                names=["kind", "key", "fingerprint", "mixed"])


def _forest(a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
    """A spanning forest of the links (a, b), each node tied to its tree."""
    parent: dict[int, int] = {}

    def root(x):
        while (up := parent.setdefault(x, x)) != x:
            parent[x] = x = parent[up]
        return x

    kept = []
    for x, y in zip(a.tolist(), b.tolist(), strict=True):
        rx, ry = root(x), root(y)
        if rx != ry:
            parent[ry] = rx
            kept.append((x, y))
    return kept


def _compare(left: np.ndarray, right: np.ndarray, kind: int, same: bool) -> list[tuple[int, int]]:
    """Links between two blocks of one key, as a forest. Rows are compared 256 at a time."""
    links: list[tuple[int, int]] = []
    for at in range(0, len(left), 256):
        x = left[at : at + 256, None] ^ right[None, :]
        if same:
            x = np.where(np.arange(len(right))[None, :] > np.arange(at, at + len(x))[:, None], x, ~np.uint64(0))
        i, j = np.nonzero(np.bitwise_count(x & ~KEY_MASKS[kind]) <= WIDTH)
        d = x[i, j]
        good = chain_keeps_budget(d, KINDS[kind][0])
        i, j, d = i[good], j[good], d[good]
        close = np.bitwise_count(d) <= DISTANCE
        links += _forest(left[at + i[close]].view(np.int64), right[j[close]].view(np.int64))
    return _forest(*np.array(links, np.int64).T) if len(links) > 1 else links


def _links_of_groups(batches):
    """Rows come sorted by (kind, key, pair of blocks); a pair's rows are one or two blocks."""
    held, group = [], None

    def finish():
        fp = np.array([h[0] for h in held], np.int64).view(np.uint64)
        side = np.array([h[1] for h in held], bool)
        kind, same = group[0], group[2] == group[3]
        return _compare(fp, fp, kind, True) if same else _compare(fp[~side], fp[side], kind, False)

    def batch_of(links):
        a, b = (np.array(x, np.int64) for x in zip(*links, strict=True))
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    out = []
    for batch in batches:
        kinds, keys, fps, firsts, seconds, sides = (c.to_pylist() for c in batch.columns)
        for row in zip(kinds, keys, firsts, seconds, fps, sides, strict=True):
            if row[:4] != group:
                if len(held) > 1:
                    out += finish()
                held, group = [], row[:4]
            held.append((row[4], row[5]))
        if len(out) > 10_000:
            yield batch_of(out)
            out = []
    if len(held) > 1:
        out += finish()
    if out:
        yield batch_of(out)


def links(distinct: DataFrame) -> DataFrame:
    """Links (a, b) between distinct fingerprints that connect all pairs at Hamming distance 3 or less."""
    keyed = distinct.mapInArrow(_keys, "kind int, key long, fingerprint long, mixed long")
    sizes = keyed.groupBy("kind", "key").agg(F.count("*").alias("n")).where("n > 1")
    cut = sizes.withColumn("blocks", F.ceil(F.col("n") / BLOCK).cast("long"))
    # Spark takes mapInArrow to give as many rows as it gets, so it sizes both sides at a 24th and would broadcast one.
    own = keyed.join(cut.hint("merge"), ["kind", "key"]).withColumn("block", F.pmod("mixed", "blocks"))
    paired = own.select("kind", "key", "fingerprint", "block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("other"))
    rows = paired.select(
        "kind", "key", "fingerprint", F.least("block", "other").alias("first"), F.greatest("block", "other").alias("second"),
        (F.col("block") > F.col("other")).alias("side"))
    order = ["kind", "key", "first", "second"]
    return rows.repartition(*order).sortWithinPartitions(*order).mapInArrow(_links_of_groups, "a long, b long").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root``, its component's smallest node, by alternating large and small stars on staged tables."""
    edges = staged(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), "links")
    before = None
    while True:
        both = edges.union(edges.select("b", "a")).toDF("u", "v")
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))
        large = large.where("a <> b").distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e")).select("e.*")
        edges = staged(small.where("a <> b").distinct(), "stars")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        if now == before:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = now


def near_duplicates(docs: DataFrame, words: int = 3) -> DataFrame:
    """``doc_id``, ``fingerprint`` (long) and ``component_id``, the smallest id that can be reached."""
    prints = staged(fingerprints(docs, words).distinct(), "fingerprints")
    distinct = staged(prints.groupBy("fingerprint").agg(F.min("doc_id").alias("least")), "distinct-fingerprints")
    rooted = components(links(distinct.select("fingerprint")))
    of = distinct.join(rooted, distinct.fingerprint == rooted.node, "left").select("fingerprint", "least", F.coalesce("root", "fingerprint").alias("root"))
    smallest = of.groupBy("root").agg(F.min("least").alias("component_id"))
    named = of.join(smallest, "root").select("fingerprint", "component_id")
    return prints.join(named, "fingerprint").select("doc_id", "fingerprint", "component_id")


def hex_text(fingerprint: Column) -> Column:
    return F.lower(F.lpad(F.hex(fingerprint), 16, "0"))


def one_of_each(docs: DataFrame, words: int = 3) -> DataFrame:
    """Of each component the document with the smallest id, with its own columns, and all documents without an id."""
    name = unused(docs, "stay_id")
    stay = near_duplicates(docs, words).where("doc_id = component_id").select(F.col("doc_id").alias(name))
    return docs.join(stay, F.col("doc_id").cast("long") == F.col(name), "left_semi").union(docs.where("doc_id IS NULL"))
