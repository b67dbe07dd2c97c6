"""Export files: zipped or plain tab-separated rows, their names, manifests and listings.

Both readers take quotes as the format does; a line break inside quotes continues a row in a zipped file and ends it in a
plain one (where Spark splits lines), and bytes that are not UTF-8 make a zipped file unreadable and a plain line's
characters replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidewatch import fixed_values as fv
from tidewatch.functions.text import ColumnOrName, col, strip
from tidewatch.sources.zips import scan_zips

def scan_export_zip(spark: SparkSession, paths: str | list[str], pattern: str = "*.export.CSV.zip") -> DataFrame:
    """Rows of zipped exports, files in parallel. An unreadable file gives one row with ``file_error``."""
    return scan_zips(spark, paths, pattern)


_QUOTED_FIELD = r'\t("(?:[^"]|"")*"[^\t]*|[^\t]*)'


def split_line(line: ColumnOrName) -> Column:
    """Columns of one tab-separated line; quoted columns lose their quotes, doubled quotes become single."""
    line = col(line)
    quoted = F.transform(
        F.regexp_extract_all(F.concat(F.lit("\t"), line), F.lit(_QUOTED_FIELD), 1),
        lambda f: F.when(
            f.startswith('"'), F.replace(F.regexp_replace(f, r'^"((?:[^"]|"")*)"', "$1"), F.lit('""'), F.lit('"'))
        ).otherwise(f),
    )
    plain = F.split(line, "\t")
    no_columns = F.array().cast("array<string>")
    return F.when(line == "", no_columns).when(line.contains('"'), quoted).otherwise(plain)


def project_fields(cols: ColumnOrName = "cols") -> list[Column]:
    """The 13 kept fields of a column array, stripped; NULL where the row is too short."""
    complete = F.size(col(cols)) >= fv.EXPORT_COLUMNS
    return [F.when(complete, strip(F.get(col(cols), F.lit(i)))).alias(n) for n, i in fv.FIELD_POSITIONS.items()]


def scan_export_tsv(spark: SparkSession, paths: str | list[str], pattern: str = "*.export.CSV") -> DataFrame:
    """The same rows from unzipped landings, which Spark can split.

    Row numbers are exact and need no sort of the lines: each block of a file counts its lines, the few block counts
    are summed up in file order, and a line adds its place within its block.
    """
    lines = (
        spark.read.option("pathGlobFilter", pattern).text(paths)
        .select(
            F.col("value").alias("line"),
            F.col("_metadata.file_path").alias("path"),
            F.col("_metadata.file_block_start").alias("_block"),
            F.monotonically_increasing_id().alias("_place"),
        )
    )
    earlier = W.partitionBy("path").orderBy("_block").rowsBetween(W.unboundedPreceding, -1)
    blocks = (
        lines.groupBy("path", "_block").agg(F.count("*").alias("_lines"), F.min("_place").alias("_first"))
        .select("path", "_block", (F.coalesce(F.sum("_lines").over(earlier), F.lit(0)) - F.col("_first")).alias("_shift"))
    )
    numbered = lines.join(blocks, ["path", "_block"]).select(
        "path", (F.col("_place") + F.col("_shift") + 1).alias("row_number"), split_line("line").alias("cols")
    )
    short = F.when(F.size("cols") < fv.EXPORT_COLUMNS, F.col("cols"))
    return numbered.select(
        "path", "row_number", *project_fields("cols"), short.alias("cols"), F.lit(None).cast("string").alias("file_error")
    )


def well_formed(rows: DataFrame) -> DataFrame:
    return rows.filter(F.col("cols").isNull() & F.col("file_error").isNull()).drop("cols", "file_error")


def malformed(rows: DataFrame) -> DataFrame:
    """Rows with too few columns; longer rows are fine."""
    return rows.filter(F.col("cols").isNotNull())


# ---------------------------------------------------------------- names, manifests, listings

def export_filename(url: ColumnOrName) -> Column:
    """Last part of a URL or path, query and fragment removed."""
    url = col(url)
    marked = url.contains("?") | url.contains("#")  # most have neither, and need no pattern
    return F.substring_index(F.when(marked, F.regexp_replace(url, r"[?#].*$", "")).otherwise(url), "/", -1)


def export_time(url: ColumnOrName) -> Column:
    """UTC time in an export's file name, NULL when the name is not an export's."""
    digits = F.regexp_extract(export_filename(url), fv.EXPORT_FILE_PATTERN, 1)
    return F.try_to_timestamp(F.nullif(digits, F.lit("")), F.lit("yyyyMMddHHmmss"))


def with_export_metadata(df: DataFrame, url: str = "export_url", strict: bool = False) -> DataFrame:
    """Add ``export_filename`` and ``export_time_utc``; ``strict`` fails on a name without a time."""
    time = export_time(url)
    if strict:
        message = F.concat(F.lit(fv.MISNAMED_TEXT), export_filename(url))
        time = F.when(time.isNull(), F.raise_error(message).cast("timestamp")).otherwise(time)
    return df.withColumns({"export_filename": export_filename(url), "export_time_utc": time})


def manifest_url(text: ColumnOrName) -> Column:
    """First export address in a manifest's text, NULL if there is none."""
    return F.nullif(F.regexp_extract(col(text), f"({fv.MANIFEST_URL_PATTERN})", 1), F.lit(""))


def read_manifest(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """One row per manifest file with its export address."""
    texts = spark.read.text(paths, wholetext=True)
    return texts.select(normalize_export_url(manifest_url("value")).alias("export_url"))


def normalize_export_url(url: ColumnOrName, host: str = fv.FEED_HOST, prefix: str = fv.STORE_PREFIX) -> Column:
    """Rewrite addresses on the feed's host to its object-store mirror; others stay as they are."""
    url = col(url)
    path = F.coalesce(F.try_parse_url(url, F.lit("PATH")), F.lit(""))
    rooted = F.when(path.startswith("/"), path).otherwise(F.concat(F.lit("/"), path))
    on_feed = F.lower(F.try_parse_url(url, F.lit("HOST"))) == host.lower()
    return F.when(on_feed, F.concat(F.lit(prefix), rooted)).otherwise(url)


def list_exports(
    spark: SparkSession, folder: str, source: str = fv.SOURCE, pattern: str = "*.export.CSV.zip",
    archive_suffix: str = "",
) -> DataFrame:
    """Landed exports with their times (NULL where a name tells none) and sizes. File contents are not read.

    ``archive_suffix`` is what unpacking took off the names, so that zipped and plain landings name an export alike.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder)
    listed = with_export_metadata(files.select(F.concat("path", F.lit(archive_suffix)).alias("export_url"), "length"))
    return listed.select(F.lit(source).alias("source"), "export_time_utc", "export_url", "export_filename", "length")


def latest_export(listing: DataFrame) -> DataFrame:
    return listing.filter("export_time_utc is not null").orderBy(F.desc("export_time_utc"), F.desc("export_url")).limit(1)


def discover_new(listing: DataFrame, ledger: DataFrame) -> DataFrame:
    """Listed exports that are neither completed nor being processed, by source and time."""
    from tidewatch.operators.ledger import CHECKPOINT_KEY

    taken = ledger.filter(F.col("status").isin("completed", "processing")).select(*CHECKPOINT_KEY)
    return listing.filter("export_time_utc is not null").join(taken, CHECKPOINT_KEY, "left_anti")
