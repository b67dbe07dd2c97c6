"""Tables whose partitions are replaced together, by one atomic switch.

A table is a folder with data folders and manifests. A manifest is a small file, never changed, that names the data folders
of every partition; the one with the highest number is the table. A commit first writes its data folders and then one
manifest, so a stop at any point leaves the old or the new table whole, and partitions that a commit does not touch keep
their files. Readers open the folders that the manifest names and list nothing else, so a read that wants some partitions
never looks at the others, however many there are.

Each manifest has room for a few facts of its own (``notes``), which change with the data or not at all: how far a stream has
come, or what a summary covers. One writer at a time is assumed; a second one gets an error at its switch and has changed
nothing. Folders that no manifest in use names (of commits that broke off, or replaced) are removed by :meth:`sweep`.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.sources import files

_PARTITION = "_partition"
_NONE = "__HIVE_DEFAULT_PARTITION__"


@dataclass(frozen=True)
class Version:
    """What one manifest says: data folders by partition, relative to the table, and notes."""

    number: int = 0
    partitions: dict[str, list[str]] = field(default_factory=dict)
    notes: dict = field(default_factory=dict)


class VersionedTable:
    """A table under ``root``. ``partition`` gives a row's partition as text, from its columns; null is a partition too."""

    def __init__(self, spark: SparkSession, root: str, schema: T.StructType, partition: Column):
        self.spark, self.root, self.schema, self.partition = spark, root.rstrip("/"), schema, partition

    # ------------------------------------------------------------ reading

    def version(self, number: int | None = None) -> Version:
        """The newest version, or one by its number."""
        names = [n for n in files.children(self.spark, f"{self.root}/manifests") if n.endswith(".json") and not n.startswith(".")]
        if number is not None:
            names = [n for n in names if int(n.removesuffix(".json")) == number]
            if not names:
                raise FileNotFoundError(f"{self.root}: no version {number}")
        if not names:
            return Version()
        found = json.loads(files.read_text(self.spark, f"{self.root}/manifests/{max(names)}"))
        return Version(int(max(names).removesuffix(".json")), found["partitions"], found["notes"])

    def read(self, wanted: Callable[[str | None], bool] | Iterable[str | None] | None = None, at: Version | None = None) -> DataFrame:
        """The rows of the partitions that are wanted (a test of, or a collection of, partition texts), or all."""
        version = at or self.version()
        if wanted is not None and not callable(wanted):
            wanted = set(wanted).__contains__
        folders = [f for text, some in version.partitions.items() if wanted is None or wanted(None if text == _NONE else text) for f in some]
        if not folders:
            return self.spark.createDataFrame([], self.schema)
        paths = [f"{self.root}/{f}" for f in folders]
        return self.spark.read.schema(self.schema).option("recursiveFileLookup", "true").parquet(*paths)

    # ------------------------------------------------------------ writing

    def write(self, rows: DataFrame) -> dict[str, str]:
        """Data folders of the partitions that ``rows`` has, by partition. No version names them yet."""
        commit = f"data/{uuid.uuid4().hex}"
        keyed = rows.select(*self.schema.names).withColumn(_PARTITION, self.partition)
        keyed.hint("rebalance", _PARTITION).write.partitionBy(_PARTITION).parquet(f"{self.root}/{commit}")
        named = [n for n in files.children(self.spark, f"{self.root}/{commit}") if n.startswith(f"{_PARTITION}=")]
        return {_unescaped(n.split("=", 1)[1]): f"{commit}/{n}" for n in named}

    def _switch(self, before: Version, partitions: dict[str, list[str]], notes: dict | None) -> Version:
        after = Version(before.number + 1, partitions, before.notes if notes is None else notes)
        body = json.dumps({"partitions": after.partitions, "notes": after.notes}, sort_keys=True)
        files.write_once(self.spark, f"{self.root}/manifests/{after.number:020d}.json", body)
        return after

    def append(
        self, rows: DataFrame, notes: dict | None = None, before: Version | None = None, replaces: str | None = None,
        written: dict[str, str] | None = None,
    ) -> Version:
        """Add rows: touched partitions get one more folder. With ``replaces``, a column, stored rows of those partitions
        that have one of its new values go with the same switch. ``written``: the folders of ``rows``, if they are written."""
        before = before or self.version()
        partitions = {text: list(folders) for text, folders in before.partitions.items()}
        written = self.write(rows) if written is None else written
        known = [text for text in written if replaces and text in partitions]
        if known:
            texts = [None if text == _NONE else text for text in known]
            new = self.read(texts, Version(partitions={text: [folder] for text, folder in written.items()}))
            stored = self.read(texts, before)
            old = stored.join(new.select(replaces).distinct(), replaces, "left_semi")
            if not old.isEmpty():
                kept = stored.join(new.select(replaces).distinct(), replaces, "left_anti")
                rewritten = self.write(kept)
                partitions |= {text: [rewritten[text]] if text in rewritten else [] for text in known}
        for text, folder in written.items():
            partitions.setdefault(text, []).append(folder)
        return self._switch(before, partitions, notes)

    def replace(self, rows: DataFrame, touched: Iterable[str | None], notes: dict | None = None, before: Version | None = None) -> Version:
        """``rows`` instead of all rows of the touched partitions (one without rows is left out). Rows must lie in them."""
        before = before or self.version()
        gone = {_NONE if t is None else t for t in touched}
        written = self.write(rows)
        if not set(written) <= gone:
            raise ValueError(f"rows outside the touched partitions: {sorted(set(written) - gone)[:3]}")
        partitions = {text: folders for text, folders in before.partitions.items() if text not in gone}
        return self._switch(before, partitions | {text: [folder] for text, folder in written.items()}, notes)

    def compact(self, most: int = 16) -> Version | None:
        """Partitions of more than ``most`` folders rewritten as one each."""
        before = self.version()
        many = [text for text, folders in before.partitions.items() if len(folders) > most]
        if not many:
            return None
        texts = [None if t == _NONE else t for t in many]
        return self.replace(self.read(texts, before), texts, before=before)

    def sweep(self, keep: int = 2) -> int:
        """Delete manifests but the newest ``keep``, and the data folders that none of those names. Returns how many."""
        names = sorted(n for n in files.children(self.spark, f"{self.root}/manifests") if n.endswith(".json") and not n.startswith("."))
        kept, old = names[-keep:], names[:-keep]
        used = set()
        for name in kept:
            for folders in self.version(int(name.removesuffix(".json"))).partitions.values():
                used |= set(folders)
        commits = {f.split("/")[1] for f in used}
        gone = 0
        for commit in files.children(self.spark, f"{self.root}/data"):
            if commit not in commits:
                files.delete(self.spark, f"{self.root}/data/{commit}")
                gone += 1
            else:
                for part in files.children(self.spark, f"{self.root}/data/{commit}"):
                    if part.startswith(_PARTITION) and f"data/{commit}/{part}" not in used:
                        files.delete(self.spark, f"{self.root}/data/{commit}/{part}")
                        gone += 1
        for name in old:
            files.delete(self.spark, f"{self.root}/manifests/{name}")
        return gone


def _unescaped(text: str) -> str:
    """A partition's text from its folder name, where Spark writes some characters as per cent and two hex digits."""
    from urllib.parse import unquote

    return unquote(text)


def partitions_of(rows: DataFrame, partition: Column) -> list[str | None]:
    """The distinct partition texts of ``rows``: one value a partition, as many as a manifest names."""
    return [r[0] for r in rows.select(partition.alias(_PARTITION)).distinct().collect()]


def day(column: str) -> Column:
    return F.date_format(column, "yyyy-MM-dd")
