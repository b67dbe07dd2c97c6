"""Helpers of the corpus operators: words, staged tables, unused column names, files in the shared folder."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.session import shared_folder

#: The six ASCII white-space characters that end a word.
SPACE_CLASS = " \\t-\\r"
#: Spark's setting: remove a query's shuffle files when it ends.
RELEASE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def unused(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` has it (Spark compares without case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def words(text: Column) -> Column:
    """Runs of characters other than ASCII white space; a null text has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), f"[{SPACE_CLASS}]+"), "")


def bind(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once a row, however often ``use`` mentions it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def staged(df: DataFrame, purpose: str, folder: str | None = None, release: bool = False, options: dict[str, str] | None = None) -> DataFrame:
    """``df`` written once to the shared folder (``folder``, if given) and read back: cuts lineage, survives lost executors.

    With ``release`` the shuffle files of the write go when it ends, not when the driver next collects its garbage: nothing
    reads them again. ``options`` are the writer's.
    """
    spark = df.sparkSession
    folder = folder or shared_folder(spark, purpose)
    before = spark.conf.get(RELEASE, "false")
    spark.conf.set(RELEASE, str(release or before == "true").lower())
    try:
        df.write.options(**(options or {})).parquet(folder)
    finally:
        spark.conf.set(RELEASE, before)
    return spark.read.schema(df.schema).parquet(folder)


def text_bytes(df: DataFrame, column: str = "text") -> int:
    """Bytes of all texts: one narrow scan, to size groups in proportion to the input."""
    return df.agg(F.coalesce(F.sum(F.octet_length(column)), F.lit(0)).alias("n")).first()["n"]


def groups_for(total: int, each: int, least: int) -> int:
    """How many groups keep each at about ``each`` units, ``least`` at least."""
    return max(least, -(-total // each))


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def open_folder(uri: str):
    """(file system, path) of a folder's URI, for files that tasks write and read in ranges."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")


def write_whole(folder: str, name: str, chunks) -> str:
    """Write a file under a name of this attempt's own, so that a repeated task never touches another's file."""
    import uuid

    system, path = open_folder(folder)
    system.create_dir(path, recursive=True)
    name = f"{name}-{uuid.uuid4().hex[:12]}"
    with system.open_output_stream(f"{path}/{name}", compression=None) as out:
        for chunk in chunks:
            out.write(chunk)
    return name
