"""Phrase collocations by vertical partitioning of word suffixes (operator 11).

Phrases of two to five words are counted by depth-truncated suffix trees, built independently per group of prefixes. Texts
are read once, into blocks of numbered words that are written to the shared folder; all steps read those:

1. Words are counted per language, combined in each block. Words below the least count cannot be part of a candidate.
2. Prefixes, pairs of words, are counted by 64-bit hash. Pairs below the least count end a suffix, so suffixes are
   truncated there. What is kept is a bitmap of fixed size: a wrong hit lets a suffix run on and changes no count.
3. The frequencies of the prefixes give the number of groups that keep each within the memory budget. A prefix beyond its
   share is extended to the whole truncated suffix (a second bitmap), so that no prefix, however common, makes one group.
4. Each block combines equal truncated suffixes and sends each once, with its count, to its group: one row for each group,
   with all the block has for it. A group sorts its suffixes; those below a node are then neighbours, and the node's count
   is the total of its leaves. Counts of the prefixes that were extended are added up over their groups.

Scores are decimal integers; products have up to 38 digits. All joins are on a phrase that one side has once.

Memory of a task: Arrow batches between Spark and Python hold about a megabyte, so a block at a time; pairs are combined in one
array that is sorted in place; suffixes become text for a few groups of a block at a time.

Defined results: a null text has no word; a null language is ``und``; repeated rows count each time; ties are ordered by
count, then phrase; an empty table gives no row; columns beside those named are ignored. A very long text is cut into several
blocks, each of which ends with the first words of the next.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidewatch.llm.common import groups_for, shuffle_partitions, staged
from tidewatch.session import with_setting

#: Words in a phrase, at most; characters that end a piece, and those that only part words.
DEPTH = 5
PIECE_ENDS, BLANKS = b".,;:!?\n\x0b\x0c\r", b" \t"
#: Bits of a bitmap of hashes: 8 MB, whatever the table.
BITS = 1 << 26
CHUNK_BITS = 1 << 14
#: Bytes of text in a block; pairs that a task combines before sending.
BLOCK_BYTES, COMBINED_PAIRS = 4_000_000, 4_000_000
#: Spark's setting and value for the bytes of a batch that tasks get (a row more, at most).
BATCH_BYTES = ("spark.sql.execution.arrow.maxBytesPerBatch", "1000000")
#: Files of blocks: about a block a page. Otherwise a page ends after 100 rows at first, and writers and readers hold it whole,
#: several times.
BLOCK_FILES = {"parquet.page.size.row.check.min": "1", "parquet.page.size.row.check.max": "1"}
#: Pairs and, about, suffixes of a batch that they return.
BATCH_PAIRS, BATCH_SUFFIXES = 1 << 18, 1 << 16
#: Suffixes of a group, about, and of a prefix before it is extended.
GROUP_SUFFIXES = 1_000_000
PREFIX_SUFFIXES = GROUP_SUFFIXES // 4
_END = b"."
_TABLE = bytes.maketrans(bytes(range(65, 91)) + PIECE_ENDS + BLANKS, bytes(range(97, 123)) + _END * len(PIECE_ENDS) + b" " * len(BLANKS))
#: Rows of a batch that are Python objects at once.
ROWS = 256
_MIX = np.uint64(0x9E3779B97F4A7C15)


def hashes(lang: str, words: list[bytes]) -> np.ndarray:
    key = lang.encode() + b"\0"
    return np.fromiter((xxhash.xxh3_64_intdigest(key + w) for w in words), np.uint64, len(words))


def mixed(h: np.ndarray, more: np.ndarray) -> np.ndarray:
    """The hash of a sequence, from the hash of its beginning and that of its next word."""
    h = (h * _MIX) ^ more
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


class Bitmap:
    """A set of hashes; may hold others too."""

    def __init__(self, data: bytes):
        self.bytes = np.frombuffer(data, np.uint8)

    def holds(self, h: np.ndarray) -> np.ndarray:
        at = h % np.uint64(BITS)
        return (self.bytes[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 > 0


def bitmap(rows: DataFrame, column: str = "h") -> bytes:
    """A bitmap of the hashes in ``column``: bits are set chunk by chunk in tasks, only chunks pass the driver (8 MB)."""

    def pack(group: pa.Table) -> pa.Table:
        bits = np.zeros(CHUNK_BITS, np.uint8)
        bits[group["bit"].to_numpy()] = 1
        return pa.table({"chunk": group["chunk"][:1], "data": pa.array([np.packbits(bits, bitorder="little").tobytes()], pa.binary())})

    low = F.col(column).bitwiseAND(F.lit(BITS - 1))  # hashes are unsigned in signed columns: the low bits agree
    places = rows.select(F.shiftright(low, CHUNK_BITS.bit_length() - 1).cast("int").alias("chunk"), low.bitwiseAND(F.lit(CHUNK_BITS - 1)).cast("int").alias("bit")).distinct()
    made = bytearray(BITS // 8)
    for row in places.groupBy("chunk").applyInArrow(pack, "chunk int, data binary").collect():
        made[row["chunk"] * (CHUNK_BITS // 8):(row["chunk"] + 1) * (CHUNK_BITS // 8)] = row["data"]
    return bytes(made)


class Numbers(dict):
    """Words to numbers in order of appearance."""

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number


def _plain(text: str) -> bytes:
    """The text in lower case, with one kind of end and of blank."""
    return text.encode("utf-8", "surrogatepass").translate(_TABLE)


def _words(plain: bytes) -> list[bytes]:
    """Words and ends of pieces."""
    return plain.replace(_END, b" . ").split()


def block(lang: str, words: list[bytes], starts: int) -> tuple:
    """A row of ``BLOCKS``: distinct words, the number of each word of the block (0 ends a piece), and how many places, from
    the first, may start a phrase (what follows is there to end phrases)."""
    numbers = Numbers({_END: 0})
    listed = np.fromiter(map(numbers.__getitem__, words), np.int32, len(words))
    return lang, b" ".join(numbers), listed.tobytes(), starts


def _make_blocks(batches):
    held: dict[str, tuple[list[bytes], int]] = {}

    def row(lang: str, words: list[bytes], starts: int) -> pa.RecordBatch:
        return _batch(BLOCKS, **{name: [value] for name, value in zip(BLOCKS, block(lang, words, starts), strict=True)})

    def whole(lang: str, texts: list[bytes]) -> pa.RecordBatch:
        words = _words(_END.join([*texts, b""]))
        return row(lang, words, len(words))

    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            for lang, text in zip(*(c.to_pylist() for c in batch.slice(at, ROWS).columns), strict=True):
                texts, size = held.pop(lang, ([], 0))
                if len(text) > BLOCK_BYTES:  # alone, in several blocks
                    new = _words(_plain(text))
                    step = max(1, BLOCK_BYTES * len(new) // max(1, len(text)))
                    for first in range(0, len(new), step):
                        part = new[first : first + step + DEPTH - 1]
                        yield row(lang, part, min(step, len(part)))
                else:
                    texts.append(_plain(text))
                    size += len(text)
                if size >= BLOCK_BYTES:
                    yield whole(lang, texts)
                    texts, size = [], 0
                held[lang] = texts, size
            if sum(size for _, size in held.values()) > 2 * BLOCK_BYTES:  # many languages in one task
                for lang, (texts, _) in held.items():
                    yield whole(lang, texts)
                held.clear()
    for lang, (texts, _) in held.items():
        if texts:
            yield whole(lang, texts)


class Block:
    """Words of one language: their numbers, and hash and frequency of each number."""

    def __init__(self, lang: str, vocabulary: bytes, numbers: bytes, starts: int, frequent: Bitmap | None = None):
        self.lang, self.starts = lang, starts
        self.words = vocabulary.split(b" ")
        self.numbers = np.frombuffer(numbers, np.int32).astype(np.int64)
        self.h = hashes(lang, self.words)
        self.known = frequent.holds(self.h) if frequent else np.ones(len(self.words), bool)
        self.known[0] = False


def _read_blocks(batches, frequent: Bitmap | None = None):
    for batch in batches:
        for at in range(batch.num_rows):
            (lang,), (vocabulary,), (numbers,), (starts,) = (c.to_pylist() for c in batch.slice(at, 1).columns)
            yield Block(lang, vocabulary, numbers, starts, frequent)


def _batch(kinds: dict, **columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[name], kind) for name, kind in kinds.items()], names=list(kinds))


BLOCKS = {"lang": pa.string(), "vocabulary": pa.binary(), "numbers": pa.binary(), "starts": pa.int64()}
WORDS = {"lang": pa.string(), "word": pa.string(), "h": pa.int64(), "n": pa.int64()}
PAIRS = {"h": pa.int64(), "n": pa.int64()}
#: Suffixes of one block and group, a line each; of each the count, and whether its prefix was extended.
SUFFIXES = {"grp": pa.int64(), "lang": pa.string(), "suffixes": pa.binary(), "n": pa.binary(), "extended": pa.binary()}
NODES = {"lang": pa.string(), "phrase": pa.string(), "depth": pa.int32(), "a": pa.int64()}


def _ddl(kinds: dict) -> str:
    names = {pa.string(): "string", pa.int64(): "long", pa.bool_(): "boolean", pa.int32(): "int", pa.binary(): "binary"}
    return ", ".join(f"{name} {names[kind]}" for name, kind in kinds.items())


def _count_words(batches):
    """Counts of a block's words, and under no word the count of all."""
    for part in _read_blocks(batches):
        n = np.bincount(part.numbers[: part.starts], minlength=len(part.words))[1:]
        some = np.flatnonzero(n)
        words = [part.words[i + 1].decode("utf-8", "surrogatepass") for i in some.tolist()]
        h = np.r_[part.h[1:][some], np.zeros(1, np.uint64)].view(np.int64)
        yield _batch(WORDS, lang=[part.lang] * (len(some) + 1), word=[*words, None], h=h, n=np.r_[n[some], n.sum()])


def _pairs_of(part: Block, flagged: Bitmap | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Whether each place and the next make a pair of frequent words (that ``flagged`` holds), and the hashes of those that
    do, in order."""
    known = part.known[part.numbers]
    both = known[:-1] & known[1:]
    at = np.flatnonzero(both)
    pair = mixed(part.h[part.numbers[at]], part.h[part.numbers[at + 1]])
    if flagged:
        held = flagged.holds(pair)
        both[at[~held]] = False
        pair = pair[held]
    return both, pair


def _count_pairs(frequent: Bitmap):
    def run(batches):
        held, size = np.empty(COMBINED_PAIRS, np.uint64), 0

        def sent():
            some = held[:size]
            some.sort()
            for at in range(0, size, BATCH_PAIRS):
                h, n = np.unique(some[at : at + BATCH_PAIRS], return_counts=True)
                yield _batch(PAIRS, h=h.view(np.int64), n=n)

        for part in _read_blocks(batches, frequent):
            both, pair = _pairs_of(part)
            pair = pair[: np.count_nonzero(both[: part.starts])]
            while len(pair):
                new, pair = pair[: COMBINED_PAIRS - size], pair[COMBINED_PAIRS - size :]
                held[size : size + len(new)] = new
                size += len(new)
                if size == COMBINED_PAIRS:
                    yield from sent()
                    size = 0
        if size:
            yield from sent()

    return run


def _send_suffixes(frequent: Bitmap, flagged: Bitmap, extended: Bitmap, groups: int):
    def combined(part: Block):
        both, pair = _pairs_of(part, flagged)
        numbers, size = part.numbers, len(part.words)
        at = np.flatnonzero(both[: part.starts])
        if not len(at):
            return
        prefix = pair[: len(at)]
        both = np.r_[both, np.zeros(DEPTH, bool)]
        length = np.full(len(at), 2)
        key = numbers[at] * size + numbers[at + 1]
        going = np.ones(len(at), bool)
        for more in range(1, DEPTH - 1):
            going &= both[at + more]
            on = np.flatnonzero(going)
            length[on] += 1
            # A rank, so that the next word fits beside it; suffixes that have ended keep a rank of their own.
            ranks = np.unique(key, return_inverse=True)[1]
            key = ranks * (size + 1)
            key[on] += numbers[at[on] + more + 1] + 1
        _, first, n = np.unique(key, return_index=True, return_counts=True)
        at, length, key = at[first], length[first], prefix[first]
        long = extended.holds(key)
        for more in range(2, DEPTH):
            on = np.flatnonzero(long & (length > more))
            key[on] = mixed(key[on], part.h[numbers[at[on] + more]])
        group = (key % np.uint64(groups)).astype(np.int64)
        order = np.argsort(group, kind="stable")
        found, starts = np.unique(group[order], return_index=True)
        parts = np.split(order, starts[1:])
        words, numbers = part.words, np.r_[numbers, np.zeros(DEPTH, np.int64)]

        def lines(p: np.ndarray) -> bytes:
            paths = numbers[at[p][:, None] + np.arange(DEPTH)].tolist()
            return b"\n".join([b" ".join([words[w] for w in path[:d]]) for path, d in zip(paths, length[p].tolist(), strict=True)])

        for some in np.split(np.arange(len(found)), np.flatnonzero(np.diff(starts // BATCH_SUFFIXES)) + 1):
            own = [parts[i] for i in some.tolist()]
            yield _batch(
                SUFFIXES, grp=found[some], lang=[part.lang] * len(own), suffixes=[lines(p) for p in own],
                n=[n[p].astype("<i8").tobytes() for p in own], extended=[long[p].tobytes() for p in own])

    def run(batches):
        for part in _read_blocks(batches, frequent):
            yield from combined(part)

    return run


def _subtree(least: int):
    """Task over one group: the nodes of its truncated suffix tree, from suffixes in order."""

    def nodes(group: pa.Table) -> pa.Table:
        numbers: dict[bytes, int] = {}
        tongues: dict[str, int] = {}
        leaves = np.frombuffer(b"".join(group["n"].to_pylist()), "<i8")
        extended = np.frombuffer(b"".join(group["extended"].to_pylist()), bool)
        path = np.full((len(leaves), DEPTH + 1), -1, np.int32)
        at = 0
        for lang, suffixes in zip(group["lang"].to_pylist(), group["suffixes"], strict=True):
            tongue = tongues.setdefault(lang, len(tongues))
            for suffix in suffixes.as_py().split(b"\n"):
                words = suffix.split(b" ")
                path[at, 0] = tongue
                path[at, 1 : len(words) + 1] = [numbers.setdefault(w, len(numbers)) for w in words]
                at += 1
        langs, vocabulary = list(tongues), [w.decode("utf-8", "surrogatepass") for w in numbers]
        order = np.lexsort(path.T[::-1])
        path = path[order]
        leaves, extended = leaves[order], extended[order]
        new = np.ones(len(path), bool)
        new[1:] = path[1:, 0] != path[:-1, 0]
        new[1:] |= path[1:, 1] != path[:-1, 1]
        made = {name: [] for name in NODES}
        for depth in range(2, DEPTH + 1):
            new[1:] |= path[1:, depth] != path[:-1, depth]
            starts = np.flatnonzero(new)
            totals = np.add.reduceat(leaves, starts)
            kept = (path[starts, depth] >= 0) & ((totals >= least) | extended[starts])
            for place, total in zip(starts[kept].tolist(), totals[kept].tolist(), strict=True):
                made["lang"].append(langs[path[place, 0]])
                made["phrase"].append(" ".join(vocabulary[w] for w in path[place, 1 : depth + 1]))
                made["depth"].append(depth)
                made["a"].append(total)
        return pa.table({name: pa.array(made[name], kind) for name, kind in NODES.items()})

    return nodes


def _decimal(column: str, digits: int) -> Column:
    return F.col(column).cast(f"decimal({digits},0)")


def phrase_counts(docs: DataFrame, least: int = 100) -> tuple[DataFrame, DataFrame]:
    """Phrases (``lang``, ``phrase``, ``depth``, ``a``) of one to five words found ``least`` times or more, and all words of
    each language (``lang``, ``total``). Both are written once."""
    spark = docs.sparkSession
    with with_setting(spark, *BATCH_BYTES):
        rows = docs.where("text IS NOT NULL").select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.col("text").cast("string").alias("text"))
        blocks = staged(rows.mapInArrow(_make_blocks, _ddl(BLOCKS)), "word-blocks", options=BLOCK_FILES)
        counted = blocks.mapInArrow(_count_words, _ddl(WORDS)).groupBy("lang", "word").agg(F.min("h").alias("h"), F.sum("n").alias("n"))
        words = staged(counted.where(F.col("word").isNull() | (F.col("n") >= least)), "words")
        known = words.where("word IS NOT NULL")
        share = spark.sparkContext.broadcast
        frequent = share(bitmap(known))

        pairs = blocks.mapInArrow(lambda batches: _count_pairs(Bitmap(frequent.value))(batches), _ddl(PAIRS))
        pairs = staged(pairs.groupBy("h").agg(F.sum("n").alias("n")).where(F.col("n") >= least), "prefixes")
        suffixes = pairs.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()["n"]
        groups = groups_for(suffixes, GROUP_SUFFIXES, shuffle_partitions(spark))
        flagged, extended = share(bitmap(pairs)), share(bitmap(pairs.where(F.col("n") > PREFIX_SUFFIXES)))

        def send(batches):
            return _send_suffixes(Bitmap(frequent.value), Bitmap(flagged.value), Bitmap(extended.value), groups)(batches)

        nodes = blocks.mapInArrow(send, _ddl(SUFFIXES)).groupBy("grp").applyInArrow(_subtree(least), _ddl(NODES))
        phrases = nodes.groupBy("lang", "phrase", "depth").agg(F.sum("a").alias("a")).where(F.col("a") >= least)
        single = known.select("lang", F.col("word").alias("phrase"), F.lit(1).alias("depth"), F.col("n").alias("a"))
        return staged(single.unionByName(phrases), "phrases"), words.where("word IS NULL").select("lang", F.col("n").alias("total"))


def scored(counts: DataFrame, totals: DataFrame) -> DataFrame:
    """Each candidate with its lowest-scoring cut: ``lang``, ``phrase``, ``depth``, ``a``, ``l``, ``r``, ``n``, ``score``."""
    words = F.split("phrase", " ")
    part = [F.array_join(F.slice(words, F.lit(1), F.col("k")), " "), F.array_join(F.slice(words, F.col("k") + 1, F.col("depth") - F.col("k")), " ")]
    cuts = counts.where("depth > 1").withColumn("k", F.explode(F.sequence(F.lit(1), F.col("depth") - 1)))
    cuts = cuts.select("lang", "phrase", "depth", "a", "k", part[0].alias("first"), part[1].alias("rest"))
    for name, found in (("first", "l"), ("rest", "r")):
        cuts = cuts.join(counts.select("lang", F.col("phrase").alias(name), F.col("a").alias(found)), ["lang", name])
    cuts = cuts.join(totals, "lang").withColumnRenamed("total", "n")
    over = (_decimal("a", 17) * F.lit(1000).cast("decimal(4,0)") * _decimal("n", 15)).alias("over")
    score = cuts.select("lang", "phrase", "depth", "a", "l", "r", "n", "k", over, (_decimal("l", 18) * _decimal("r", 18)).alias("under"))
    score = score.select("lang", "phrase", "depth", "a", F.struct(F.expr("over div under").alias("score"), "k", "l", "r", "n").alias("cut"))
    best = score.groupBy("lang", "phrase", "depth", "a").agg(F.min("cut").alias("cut"))
    return best.select("lang", "phrase", "depth", "a", "cut.l", "cut.r", "cut.n", "cut.score")


def not_inside(candidates: DataFrame, counts: DataFrame) -> DataFrame:
    """Candidates without those that always stand inside a longer one.

    A longer one with the same count has, one word longer than the candidate, a part that holds it and has that count too.
    """
    words = F.split("phrase", " ")
    parts = F.array(F.array_join(F.slice(words, F.lit(1), F.col("depth") - 1), " "), F.array_join(F.slice(words, F.lit(2), F.col("depth") - 1), " "))
    longer = counts.where("depth > 2").select("lang", F.explode(parts).alias("phrase"), F.col("a").alias("outer")).groupBy("lang", "phrase").agg(F.max("outer").alias("outer"))
    return candidates.join(longer, ["lang", "phrase"], "left").where("outer IS NULL OR 100 * outer < 100 * a").drop("outer")


def collocations(docs: DataFrame, least: int = 100, top: int = 2000) -> DataFrame:
    """The ``top`` collocations of each language: ``lang``, ``rank``, ``phrase``, ``a``, ``l``, ``r``, ``n``, ``score``."""
    counts, totals = phrase_counts(docs, least)
    found = not_inside(scored(counts, totals), counts)
    order = W.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), F.col("phrase"))
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
