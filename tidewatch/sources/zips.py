"""Zipped exports as a Spark data source: files are opened where they lie and read as streams.

A task opens each of its files as a seekable stream, so neither a whole archive nor a whole member is ever held, and no limit on
the size of a row applies. An input partition is a bundle of files of about ``BUNDLE_BYTES``, less where that would leave cores idle, or one
larger file: a format that cannot be split is still read by one task. A file that is missing, broken or not an archive gives one row that says
why; the others are read.
"""

from __future__ import annotations

import csv
import io
import json
import sys
import zipfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from tidewatch import fixed_values as fv

#: Rows of a file: the 13 kept fields, or for a row that is too short all its columns; or why the file is unreadable.
FILE_ROWS = T.StructType(
    [T.StructField("path", T.StringType()), T.StructField("row_number", T.LongType())]
    + [T.StructField(name, T.StringType()) for name in fv.FIELD_POSITIONS]
    + [T.StructField("cols", T.ArrayType(T.StringType())), T.StructField("file_error", T.StringType())]
)
BUNDLE_BYTES = 16_000_000
#: What opening a file costs, in bytes read: keeps bundles of tiny files short.
OPENING_BYTES = 250_000
_ROWS_PER_BLOCK = 5_000
_KINDS = [pa.string(), pa.int64(), *[pa.string()] * len(fv.FIELD_POSITIONS), pa.list_(pa.string()), pa.string()]


def open_seekable(path: str):
    """A stream over a file by the name that Spark lists it under."""
    from pyarrow import fs

    scheme, _, rest = path.partition(":")
    if not rest or "/" in scheme:
        return fs.LocalFileSystem().open_input_file(path)
    if scheme == "file":
        return fs.LocalFileSystem().open_input_file("/" + rest.lstrip("/"))
    authority, _, key = rest.removeprefix("//").partition("/")
    system, base = fs.FileSystem.from_uri(f"{scheme}://{authority}/")
    return system.open_input_file(f"{base.rstrip('/')}/{key}")


def member_rows(file) -> Iterator[list[str]]:
    """Rows of the first ``.CSV`` member of an open archive."""
    csv.field_size_limit(sys.maxsize)
    with zipfile.ZipFile(file) as archive:
        members = [name for name in archive.namelist() if name.endswith(".CSV")]
        if not members:
            raise ValueError("no .CSV member in the archive")
        with archive.open(members[0]) as member:
            yield from csv.reader(io.TextIOWrapper(member, encoding="utf-8", newline=""), delimiter="\t")


def file_rows(path: str) -> Iterator[pa.RecordBatch]:
    positions = list(fv.FIELD_POSITIONS.values())
    block: list[tuple] = []
    row_number = 0

    def made() -> pa.RecordBatch:
        columns = [pa.array(c, kind) for c, kind in zip(zip(*block, strict=True), _KINDS, strict=True)]
        return pa.RecordBatch.from_arrays(columns, names=FILE_ROWS.names)

    try:
        with open_seekable(path) as file:
            for row_number, row in enumerate(member_rows(file), start=1):
                if len(row) >= fv.EXPORT_COLUMNS:
                    block.append((path, row_number, *[row[i].strip() for i in positions], None, None))
                else:
                    block.append((path, row_number, *[None] * len(positions), row, None))
                if len(block) == _ROWS_PER_BLOCK:
                    yield made()
                    block = []
    except (ValueError, EOFError, OSError, RuntimeError, NotImplementedError, csv.Error, zipfile.BadZipFile) as error:
        block.append((path, row_number + 1, *[None] * len(positions), None, str(error) or type(error).__name__))
    if block:
        yield made()


class Bundle(InputPartition):
    def __init__(self, paths: list[str]):
        self.paths = paths


class _Reader(DataSourceReader):
    def __init__(self, files: list[tuple[str, int]], most: int = BUNDLE_BYTES):
        self.files, self.most = files, most

    def partitions(self) -> list[Bundle]:
        bundles, size = [[]], 0
        for path, length in self.files:
            cost = length + OPENING_BYTES
            if bundles[-1] and size + cost > self.most:
                bundles.append([])
                size = 0
            bundles[-1].append(path)
            size += cost
        return [Bundle(paths) for paths in bundles]

    def read(self, partition: Bundle) -> Iterator[pa.RecordBatch]:
        for path in partition.paths:
            yield from file_rows(path)


class ZippedExports(DataSource):
    """``files``: a JSON list of [name, length]; ``most``: bytes of a bundle."""

    @classmethod
    def name(cls) -> str:
        return "zipped_exports"

    def schema(self) -> T.StructType:
        return FILE_ROWS

    def reader(self, schema: T.StructType) -> _Reader:
        return _Reader([(path, length) for path, length in json.loads(self.options["files"])], int(self.options.get("most", BUNDLE_BYTES)))


def list_zips(spark: SparkSession, paths: str | list[str], pattern: str = "*.export.CSV.zip") -> DataFrame:
    """``path`` and ``length`` of files. Contents are not read."""
    return spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(paths).select("path", "length")


def read_zips(spark: SparkSession, files: list[tuple[str, int]]) -> DataFrame:
    """Rows of zipped exports (``FILE_ROWS``) by name and length; a length is only used to bundle."""
    if not files:
        return spark.createDataFrame([], FILE_ROWS)
    spark.dataSource.register(ZippedExports)
    share = -(-sum(length + OPENING_BYTES for _, length in files) // spark.sparkContext.defaultParallelism)
    read = spark.read.format(ZippedExports.name()).option("files", json.dumps([list(f) for f in files]))
    return read.option("most", str(min(BUNDLE_BYTES, share))).load()


def scan_zips(spark: SparkSession, paths: str | list[str], pattern: str = "*.export.CSV.zip") -> DataFrame:
    """Rows of all files that a folder has now. Names pass the driver, as they do in Spark's own file index."""
    return read_zips(spark, [tuple(r) for r in list_zips(spark, paths, pattern).orderBy(F.col("path")).collect()])
