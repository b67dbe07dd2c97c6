"""Export files and rows for tests."""

from __future__ import annotations

import zipfile
from pathlib import Path

from tidewatch import fixed_values as fv

EVENT = {
    "GLOBALEVENTID": "7041", "SQLDATE": "20260326", "DATEADDED": "20260326001500", "Actor1Name": "HARBOUR UNION",
    "Actor2Name": "PORT OFFICE", "EventCode": "190", "GoldsteinScale": "-6.25", "ActionGeo_FullName": "Tromso, Troms, Norway",
    "ActionGeo_CountryCode": "NOR", "ActionGeo_Lat": "69.6492", "ActionGeo_Long": "18.9553", "AvgTone": "-4.75",
    "SOURCEURL": "https://example.net/harbour",
}


def line(**changes: str) -> str:
    row = [""] * fv.EXPORT_COLUMNS
    for name, value in {**EVENT, **changes}.items():
        row[fv.FIELD_POSITIONS[name]] = value
    return "\t".join(row)


def write_export(folder: Path, stamp: str, lines: list[str], member: str | None = None) -> Path:
    folder.mkdir(parents=True, exist_ok=True)
    path = folder / f"{stamp}.export.CSV.zip"
    with zipfile.ZipFile(path, "w") as archive:
        archive.writestr(member or f"{stamp}.export.CSV", "\n".join(lines) + "\n")
    return path


def write_plain(folder: Path, stamp: str, lines: list[str]) -> Path:
    folder.mkdir(parents=True, exist_ok=True)
    path = folder / f"{stamp}.export.CSV"
    path.write_text("\n".join(lines) + "\n")
    return path


def one(df):
    rows = df.collect()
    assert len(rows) == 1, rows
    return rows[0]
