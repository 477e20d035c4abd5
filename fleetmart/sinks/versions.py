"""Tables that change in one step.

A table's folder holds complete versions, ``_v00000001`` and so on, of which readers take the
newest. A new version is written beside them under a name that readers pass over and becomes one
by a single rename, so a reader finds the old table or the new one whenever a writer stops. A
folder without versions is a table of its own files, as other programs write them.

One writer at a time; readers need nothing. The version before the newest stays for readers that
have begun with it.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import SparkSession

_VERSION = re.compile(r"_v(\d{8,})")
_STAGED, _REDO = "_staged_", "_redo_"
#: Written by Spark when all files of a folder are in place.
_COMPLETE = "_SUCCESS"


class LostTableError(RuntimeError):
    """The folder of a table is there, but no complete version in it."""


def located(spark: SparkSession, path: str):
    """The file system of a path, and the path as it takes it."""
    sc = spark.sparkContext
    place = sc._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(sc._jsc.hadoopConfiguration()), place


def children(spark: SparkSession, path: str) -> list[str] | None:
    """Names in a folder; None if there is no such folder."""
    fs, place = located(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(place)) if fs.exists(place) else None


def exists(spark: SparkSession, path: str) -> bool:
    fs, place = located(spark, path)
    return fs.exists(place)


def touch(spark: SparkSession, path: str) -> None:
    """An empty file, if there is none."""
    fs, place = located(spark, path)
    if not fs.exists(place):
        fs.create(place, True).close()


def rename(spark: SparkSession, source: str, target: str) -> None:
    fs, place = located(spark, target)
    if not fs.rename(located(spark, source)[1], place):
        raise OSError(f"cannot rename {source} to {target}")


def delete(spark: SparkSession, path: str) -> None:
    fs, place = located(spark, path)
    fs.delete(place, True)


def _numbers(names: list[str]) -> list[int]:
    return sorted(int(m[1]) for m in map(_VERSION.fullmatch, names) if m)


def _name(path: str, number: int) -> str:
    return f"{path.rstrip('/')}/_v{number:08d}"


def current(spark: SparkSession, path: str) -> str:
    """The folder that holds the table's files now: its newest version, or itself."""
    names = children(spark, path)
    if names is None:
        return path
    numbers = _numbers(names)
    if numbers:
        return _name(path, numbers[-1])
    if any(n.startswith((_STAGED, _REDO)) for n in names) and not any(not n.startswith(("_", ".")) for n in names):
        raise LostTableError(f"no complete version in {path}, only what a writer left: {names}")
    return path


def staged_folder(path: str) -> str:
    return f"{path.rstrip('/')}/{_STAGED}{uuid.uuid4().hex}"


def publish(spark: SparkSession, staged: str, path: str, *, keep: int = 1) -> str:
    """Make a staged folder the table, and remove versions but the newest and ``keep`` before it,
    what writers that stopped have left, and files of a table without versions."""
    numbers = _numbers(children(spark, path) or [])
    number = numbers[-1] + 1 if numbers else 1
    rename(spark, staged, _name(path, number))
    kept = {_name(path, n) for n in [*numbers, number][-1 - keep :]}
    for name in children(spark, path) or []:
        if f"{path.rstrip('/')}/{name}" not in kept:
            delete(spark, f"{path.rstrip('/')}/{name}")
    return _name(path, number)


def is_complete(spark: SparkSession, folder: str) -> bool:
    """Whether the job that wrote a folder has committed."""
    return _COMPLETE in (children(spark, folder) or [])


def redo_folder(path: str) -> str:
    return f"{path.rstrip('/')}/{_REDO}{uuid.uuid4().hex}"


def unfinished(spark: SparkSession, path: str) -> list[str]:
    """Folders of replacements that are written whole but perhaps not in the table yet; those of
    writers that stopped while writing are removed."""
    found = []
    for name in children(spark, path) or []:
        if name.startswith(_REDO):
            folder = f"{path.rstrip('/')}/{name}"
            if is_complete(spark, folder):
                found.append(folder)
            else:
                delete(spark, folder)
    return found
