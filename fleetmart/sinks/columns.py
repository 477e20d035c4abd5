"""Which columns the landing days have, noted when they land.

Every landing write leaves a small note (its day and columns) in ``_columns`` below the landing
folder, before its files.  Readers unite the notes instead of opening the footers of all history.
All landed columns are text.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import SparkSession

from fleetmart.sinks import versions

_SCHEMA = "day string, columns array<string>"


def _folder(base: str) -> str:
    return f"{base.rstrip('/')}/_columns"


def note(spark: SparkSession, base: str, days: Sequence[str | None], columns: Sequence[str]) -> None:
    """Note that these days have these columns."""
    if not days:
        return
    fs, place = versions.located(spark, f"{_folder(base)}/{uuid.uuid4().hex}.json")
    text = "".join(json.dumps({"day": day, "columns": list(columns)}) + "\n" for day in days)
    out = fs.create(place, False)
    out.write(bytearray(text.encode()))
    out.close()


def notes(spark: SparkSession, base: str) -> list[str]:
    """Names of the notes there are."""
    return versions.children(spark, _folder(base)) or []


def forget(spark: SparkSession, base: str, names: Sequence[str], days: Sequence[str | None]) -> None:
    """Remove those of the named notes that are about these days only."""
    if not names or not days:
        return
    paths = [f"{_folder(base)}/{n}" for n in names if n.endswith(".json")]
    by_file: dict[str, set[str | None]] = {}
    rows = spark.read.schema(_SCHEMA).json(paths).selectExpr("_metadata.file_name AS file", "day")
    for row in rows.collect():
        by_file.setdefault(row["file"], set()).add(row["day"])
    for name, noted in by_file.items():
        if noted <= set(days):
            versions.delete(spark, f"{_folder(base)}/{name}")


def known(spark: SparkSession, base: str) -> dict[str | None, list[str]]:
    """The columns of each noted day, in the order in which they were noted."""
    if not any(n.endswith(".json") for n in notes(spark, base)):
        return {}
    found: dict[str | None, list[str]] = {}
    rows = spark.read.schema(_SCHEMA).json(_folder(base)).distinct()
    for row in sorted(rows.collect(), key=lambda r: (r["day"] or "", len(r["columns"]), r["columns"])):
        own = found.setdefault(row["day"], [])
        own += [c for c in row["columns"] if c not in own]
    return found
