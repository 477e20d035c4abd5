"""What runs that stopped have left to do, kept on storage.

Three kinds of notes, one folder each below the layout's ``pending``: ``landed`` (the landing day of
positions that are not refined yet), ``refined`` (the event days and parts of positions that are
not in the daily totals yet) and ``whole`` (no daily totals hold since a refresh of all positions).  A stage writes its note before it changes anything and removes the
notes it found at its start when all their work is done, so whatever stops a run, the next one
does what is left.  Work done twice gives the same tables.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from fleetmart.plans.layout import Layout
from fleetmart.sinks import versions


def _folder(layout: Layout, kind: str) -> str:
    return f"{layout.path('pending').rstrip('/')}/{kind}"


def note(rows: DataFrame, layout: Layout, kind: str) -> str:
    """Keep these rows until :func:`done`."""
    folder = f"{_folder(layout, kind)}/{uuid.uuid4().hex}"
    rows.write.parquet(folder)
    return folder


def notes(spark: SparkSession, layout: Layout, kind: str) -> list[str]:
    """Folders of the notes that were written whole."""
    folders = [f"{_folder(layout, kind)}/{n}" for n in versions.children(spark, _folder(layout, kind)) or []]
    return [f for f in folders if versions.is_complete(spark, f)]


def rows_of(spark: SparkSession, folders: Sequence[str]) -> DataFrame | None:
    return spark.read.parquet(*folders) if folders else None


def done(spark: SparkSession, folders: Sequence[str]) -> None:
    for folder in folders:
        versions.delete(spark, folder)
