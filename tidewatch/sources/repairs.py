"""Repaired rows written back: whole partitions beside the table, one journal, then the moves.

A repair writes the new state of the partitions it changes under ``_repairs``, then a journal that names them, then moves each into
place. Before the journal the table is the old one; from the journal on it is the new one, since whoever opens the tables
finishes the moves first (each can be repeated). Partitions without a changed row keep their files.
"""

from __future__ import annotations

import json
import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.operators.dedupe import BROADCAST_KEY_LIMIT
from tidewatch.sources import files

JOURNAL = "journal.json"


def prepare(spark: SparkSession, root: str, table: str, repaired: DataFrame, partitions: list[str]) -> str | None:
    """Write the changed partitions of ``repaired`` (a table's rows, ``_changed`` where a row differs, ``_deleted`` where one
    goes) and the journal; the repair's folder, or None where nothing changes. The names of touched partitions pass the
    driver."""
    folder = f"{root}/_repairs/{uuid.uuid4().hex}"
    texts = [F.col(p).cast("string").alias(f"_{p}") for p in partitions]
    found = repaired.filter("_changed OR _deleted").select(*texts).distinct().collect()
    if not found:
        return None
    # Found once and kept as rows: to find them ranks or compares the whole table, and few names need no shuffle of all rows.
    touched = spark.createDataFrame(found, ", ".join(f"_{p} string" for p in partitions))
    touched = F.broadcast(touched) if len(found) <= BROADCAST_KEY_LIMIT else touched
    same = [F.col(p).cast("string").eqNullSafe(F.col(f"_{p}")) for p in partitions]
    rows = repaired.join(touched, same, "left_semi").filter("NOT _deleted").drop("_changed", "_deleted")
    rows.hint("rebalance", *partitions).write.partitionBy(*partitions).parquet(f"{folder}/new")
    names = _partition_folders(spark, f"{folder}/new", len(partitions))
    escaped = _Escaped(spark)
    emptied = sorted({_folder_name(escaped, partitions, row) for row in found}.difference(names))
    files.write_once(spark, f"{folder}/{JOURNAL}", json.dumps({"table": table, "partitions": names, "emptied": emptied}))
    return folder


class _Escaped(dict):
    """Partition values as Spark's writer names their folders; Spark is asked once for each that is not plain."""

    def __init__(self, spark: SparkSession):
        super().__init__({None: "__HIVE_DEFAULT_PARTITION__"})
        self.escape = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName

    def __missing__(self, value: str) -> str:
        self[value] = value if re.fullmatch(r"[0-9A-Za-z_.-]+", value, re.ASCII) else self.escape(value)
        return self[value]


def _folder_name(escaped: _Escaped, partitions: list[str], values) -> str:
    """A partition's folder, named as Spark's writer names it."""
    return "/".join(f"{p}={escaped[v]}" for p, v in zip(partitions, values, strict=True))


def _partition_folders(spark: SparkSession, folder: str, depth: int) -> list[str]:
    names = [n for n in files.children(spark, folder) if "=" in n]
    if depth == 1:
        return names
    return [f"{n}/{rest}" for n in names for rest in _partition_folders(spark, f"{folder}/{n}", depth - 1)]


def finish(spark: SparkSession, root: str) -> int:
    """Finish the moves of journalled repairs and remove what others left; how many were finished."""
    done = 0
    for repair in files.children(spark, f"{root}/_repairs"):
        folder = f"{root}/_repairs/{repair}"
        if JOURNAL in files.children(spark, folder):
            journal = json.loads(files.read_text(spark, f"{folder}/{JOURNAL}"))
            table = f"{root}/{journal['table']}"
            files.replace_folders(spark, [(f"{folder}/new/{name}", f"{table}/{name}") for name in journal["partitions"]])
            files.delete_all(spark, [f"{table}/{name}" for name in journal["emptied"]])
            done += 1
        files.delete(spark, folder)
    return done
