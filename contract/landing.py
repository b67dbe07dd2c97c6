"""Export files written from the given events by Spark tasks, for the queries that read files.

A file takes a fixed number of rows, so the number of files grows with the data and no task writes an unbounded group.
"""

from __future__ import annotations

import csv
import io
import zipfile

import pandas as pd
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contract.adapters import AS_OF, RAW_SQL, raw_like
from tidewatch import fixed_values as fv
from tidewatch.plans.load import load_landing
from tidewatch.session import shared_folder
from tidewatch.sources.tables import EventTables
from tidewatch.sources.zips import list_zips
from tidewatch.streaming.loader import stream_load

ROWS_PER_FILE = 1000
FIRST_EXPORT = "2024-02-01 00:00:00"

_PLACE = """CASE WHEN event_id % 31 = 0 THEN 'The "North" Gate' ELSE {place} END"""
_SHORT = "event_id % 50 = 7"


def export_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dirty rows spread over exports of a quarter hour each; some rows are too short, some need quoting."""
    number = F.floor(F.col("event_id") / ROWS_PER_FILE).cast("int")
    return (
        raw_like(spark, sf_dir).drop("export_time_utc", "export_url", "row_number", "ingestion_run_id")
        .withColumns({
            "export_time_utc": F.expr(f"TIMESTAMP '{FIRST_EXPORT}'") + F.make_dt_interval(mins=number * 15),
            "ActionGeo_FullName": F.expr(_PLACE.format(place="ActionGeo_FullName")),
            "short": F.expr(_SHORT),
        })
        .withColumn("name", F.concat(F.date_format("export_time_utc", "yyyyMMddHHmmss"), F.lit(".export.CSV")))
    )


FX_SQL = RAW_SQL.replace("\nraw AS (", "\nraw0 AS (") + f""",
raw1 AS (
  SELECT * EXCLUDE (export_time_utc, export_url, row_number) REPLACE (
    {_PLACE.format(place='"ActionGeo_FullName"')} AS "ActionGeo_FullName"),
    TIMESTAMP '{FIRST_EXPORT}' + to_minutes(CAST(floor(event_id / {ROWS_PER_FILE}) AS INTEGER) * 15) AS export_time_utc
  FROM raw0
),
fx AS (
  SELECT *, strftime(export_time_utc, '%Y%m%d%H%M%S') || '.export.CSV.zip' AS export_filename, {_SHORT} AS short,
    row_number() OVER (PARTITION BY export_time_utc ORDER BY event_id) AS row_number
  FROM raw1
),
raw AS (SELECT * REPLACE ({", ".join(f'trim("{n}") AS "{n}"' for n in fv.FIELD_POSITIONS)}), export_filename AS export_url
  FROM fx WHERE NOT short)"""


def _writer(folder: str):
    positions, width = dict(fv.FIELD_POSITIONS), fv.EXPORT_COLUMNS

    def write(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("event_id")
        text = io.StringIO(newline="")
        out = csv.writer(text, delimiter="\t", lineterminator="\n")
        for row in rows.to_dict("records"):
            line = [""] * width
            for name, position in positions.items():
                line[position] = row[name]
            out.writerow(line[:3] if row["short"] else line)
        name, data = rows["name"].iloc[0], text.getvalue().encode()
        packed = io.BytesIO()
        with zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED) as archive:
            archive.writestr(name, data)
        store, base = fs.FileSystem.from_uri(folder)
        for sub, file, content in (("zip", f"{name}.zip", packed.getvalue()), ("tsv", name, data)):
            with store.open_output_stream(f"{base}/{sub}/{file}") as stream:
                stream.write(content)
        return pd.DataFrame({"name": [name], "rows": [len(rows)]})

    return write


_LANDED: dict[tuple[str, str], str] = {}
_LOADED: dict[tuple[str, str], str] = {}
_OVER_HISTORY: dict[tuple[str, str], str] = {}
_STREAMED: dict[tuple[str, str, int, int], str] = {}


def landing(spark: SparkSession, sf_dir: str) -> str:
    """Folder with the exports of a data set, zipped under ``zip`` and plain under ``tsv``; written once per session."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _LANDED:
        folder = shared_folder(spark, "landing")
        store, base = fs.FileSystem.from_uri(folder)
        for sub in ("zip", "tsv"):
            store.create_dir(f"{base}/{sub}", recursive=True)
        written = export_rows(spark, sf_dir).groupBy("name").applyInPandas(_writer(folder), "name string, rows long")
        written.agg(F.sum("rows")).collect()
        _LANDED[key] = folder
    return _LANDED[key]


def loaded(spark: SparkSession, sf_dir: str) -> EventTables:
    """The tables after loading that landing folder; loaded once per session."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _LOADED:
        root = shared_folder(spark, "tables")
        load_landing(spark, EventTables(spark, root), f"{landing(spark, sf_dir)}/zip", AS_OF)
        _LOADED[key] = root
    return EventTables(spark, _LOADED[key])


def loaded_over_history(spark: SparkSession, sf_dir: str) -> EventTables:
    """The tables after three loads: a third of the exports each, so that the later ones meet stored events."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _OVER_HISTORY:
        root, third = shared_folder(spark, "history-tables"), max(1, -(-_exports(spark, sf_dir) // 3))
        load_landing(spark, EventTables(spark, root), f"{landing(spark, sf_dir)}/zip", AS_OF, exports_per_load=third)
        _OVER_HISTORY[key] = root
    return EventTables(spark, _OVER_HISTORY[key])


def _exports(spark: SparkSession, sf_dir: str) -> int:
    return list_zips(spark, f"{landing(spark, sf_dir)}/zip").count()


def streamed(spark: SparkSession, sf_dir: str, runs: int = 1, files_per_batch: int = 50) -> EventTables:
    """The tables after streaming the landing folder ``runs`` times into them, each time with a new stream checkpoint."""
    key = (spark.sparkContext.applicationId, sf_dir, runs, files_per_batch)
    if key not in _STREAMED:
        root = shared_folder(spark, "stream-tables")
        for _ in range(runs):
            checkpoint = shared_folder(spark, "stream-checkpoint")
            stream_load(
                spark, f"{landing(spark, sf_dir)}/zip", EventTables(spark, root), checkpoint, lambda: AS_OF, files_per_batch
            ).awaitTermination()
        _STREAMED[key] = root
    return EventTables(spark, _STREAMED[key])
