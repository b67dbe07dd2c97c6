"""Benchmark windows found in documents by Wu-Manber multi-pattern search over words (operator 5).

Items are read in blocks of a bounded size; each block's patterns are sent to the tasks and every document passes through
all of them, in one narrow job without shuffle. For each pattern length there is a table of shifts by the last two words:
a pair that ends no part of a pattern lets the search skip all but one word; a pair that ends patterns gives, with their
first two words, the few patterns that are compared word by word.

Defined results: a null or empty text has no words; items without words find nothing; items with a null id hit like any
other, but have no place among the items found; repeated documents are judged each for itself; equal windows count for all
their items; empty tables give no row or no hit; other columns stay untouched.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.llm.common import unused

WINDOW = 10
#: Bytes of item text in one block, a single longer item aside: what is sent to every task at once.
BLOCK_BYTES = 8_000_000
#: Bytes to words: ASCII letters in lower case, digits and all bytes of other characters stay; the rest ends a word.
WORD_BYTES = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else 0x20 for b in range(256))


def word_list(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(WORD_BYTES).split() if text else []


class WuManber:
    """Patterns of one length (in words). ``find`` yields (start, items) of each occurrence."""

    def __init__(self, length: int, patterns: dict[tuple, list]):
        self.length, self.block = length, min(2, length)
        self.longest = length - self.block + 1
        self.shift: dict[tuple, int] = {}
        self.bucket: dict[tuple, dict] = defaultdict(lambda: defaultdict(list))
        for words, items in patterns.items():
            for end in range(self.block, length + 1):
                part = words[end - self.block : end]
                self.shift[part] = min(self.shift.get(part, self.longest), length - end)
            self.bucket[words[-self.block :]][words[: self.block]].append((words, items))

    def find(self, words: list[bytes]) -> Iterator[tuple[int, list]]:
        n, m, block, longest, shift = len(words), self.length, self.block, self.longest, self.shift.get
        at = m
        while at <= n:
            part = tuple(words[at - block : at])
            step = shift(part, longest)
            if step:
                at += step
                continue
            start = at - m
            for pattern, items in self.bucket[part].get(tuple(words[start : start + block]), ()):
                if tuple(words[start:at]) == pattern:
                    yield start, items
            at += 1


def matchers(items: list[tuple[object, str | None]]) -> list[WuManber]:
    """One search for each length of window that the items have."""
    by_length: dict[int, dict[tuple, list]] = defaultdict(lambda: defaultdict(list))
    for item_id, text in items:
        words = word_list(text)
        m = min(WINDOW, len(words))
        for start in range(len(words) - m + 1 if m else 0):
            found = by_length[m][tuple(words[start : start + m])]
            if not found or found[-1] != item_id:
                found.append(item_id)
    return [WuManber(m, patterns) for m, patterns in sorted(by_length.items())]


def item_blocks(items: DataFrame) -> Iterator[list[tuple[str | None, str]]]:
    """The items in blocks of bounded size, one at a time on the driver."""
    block, size = [], 0
    for row in items.select(F.col("item_id").cast("string"), "text").where("text IS NOT NULL").toLocalIterator():
        if block and size + len(row[1]) > BLOCK_BYTES:
            yield block
            block, size = [], 0
        block.append((row[0], row[1]))
        size += len(row[1])
    if block:
        yield block


RESULT = T.StructType([
    T.StructField("n_words", T.LongType()),
    T.StructField("spans", T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))),
    T.StructField("items", T.ArrayType(T.StringType())),
])


def _joined(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def find_windows(docs: DataFrame, items: DataFrame, result: str) -> DataFrame:
    """``docs`` with a column ``result``: words, hit spans (words from, to) and, as sorted texts, the items found."""
    spark = docs.sparkSession
    found = docs.withColumn(result, F.lit(None).cast(RESULT))
    schema, text_at = found.schema, docs.columns.index("text")

    def searching(sent):
        def search(batches):
            searches = sent.value and matchers(sent.value)
            for batch in batches:
                made = []
                for text, old in zip(batch.column(text_at).to_pylist(), batch.column(len(schema) - 1).to_pylist(), strict=True):
                    words = word_list(text)
                    spans = [(s["start"], s["end"]) for s in old["spans"]] if old else []
                    names = set(old["items"]) if old else set()
                    for one in searches:
                        for start, items_found in one.find(words):
                            spans.append((start, start + one.length))
                            names.update(x for x in items_found if x is not None)
                    made.append({"n_words": len(words), "spans": [{"start": a, "end": b} for a, b in _joined(spans)], "items": sorted(names)})
                columns = [*batch.columns[:-1], pa.array(made, batch.schema.field(len(schema) - 1).type)]
                yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

        return search

    blocks = False
    for block in item_blocks(items):
        found, blocks = found.mapInArrow(searching(spark.sparkContext.broadcast(block)), schema), True
    return found if blocks else found.mapInArrow(searching(spark.sparkContext.broadcast([])), schema)


def hit_words(result: str):
    return F.aggregate(F.col(result)["spans"], F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])


def without_contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The documents in which no window of an item occurs, with their own columns."""
    result = unused(docs, "found")
    return find_windows(docs, items, result).where(hit_words(result) == 0).select(*[F.col(f"`{c}`") for c in docs.columns])


def items_digest(names: list[str]) -> str:
    """What ``items_sha256`` holds, for tests."""
    return hashlib.sha256(",".join(sorted(names)).encode()).hexdigest()
