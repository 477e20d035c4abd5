"""Place for intermediate tables that every executor can reach."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

_own: list[str] = []


def _own_folder() -> str:
    """One folder of this process, removed when it ends."""
    if not _own:
        _own.append(tempfile.mkdtemp(prefix="fleetmart-"))
        atexit.register(shutil.rmtree, _own[0], ignore_errors=True)
    return _own[0]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder of ``spark.checkpoint.dir``, gone when the
    application ends.

    Only a local session without that setting gets a folder of this machine.
    """
    sc = spark.sparkContext
    shared = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if shared is None:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        shared = _own_folder()
    folder = f"{shared.rstrip('/')}/fleetmart-{uuid.uuid4().hex}"
    path = sc._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(sc._jsc.hadoopConfiguration())
    fs.mkdirs(path)
    fs.deleteOnExit(path)
    return f"{folder}/{name}"
