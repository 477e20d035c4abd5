"""Table and landing-zone scans."""

from __future__ import annotations

from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetmart.contract import LANDING_DAY
from fleetmart.sinks import columns, versions

# Error conditions that mean "there is no such table yet".
_ABSENT = {
    "PATH_NOT_FOUND",
    "UNABLE_TO_INFER_SCHEMA",
    "DELTA_TABLE_NOT_FOUND",
    "DELTA_PATH_DOES_NOT_EXIST",
}


# Fixed value: the folder name that Spark gives rows without a partition value.
_NO_DAY = "__HIVE_DEFAULT_PARTITION__"


def load_table(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """The newest version of a table; raises :class:`~fleetmart.sinks.versions.LostTableError`
    where writers have left a folder but no table."""
    return spark.read.format(fmt).load(path if fmt == "delta" else versions.current(spark, path))


def scan_landing(
    spark: SparkSession,
    base: str,
    *,
    since: str | None = None,
    keep_day: bool = False,
    merge_schema: bool = False,
) -> DataFrame:
    """All landed files below ``base``, from day ``since`` on (directories are pruned).

    The landing day is dropped unless ``keep_day``.  ``merge_schema`` unites the columns
    of all days, which their notes tell (:mod:`fleetmart.sinks.columns`): only the folders from
    ``since`` on are listed, and footers are opened of days without a note alone.
    """
    df = _united(spark, base, since) if merge_schema else None
    if df is None:
        df = spark.read.parquet(base)
    if LANDING_DAY not in df.columns:
        return df
    if since is not None:
        df = df.filter(F.col(LANDING_DAY) >= F.lit(since))
    return df if keep_day else df.drop(LANDING_DAY)


def _united(spark: SparkSession, base: str, since: str | None) -> DataFrame | None:
    """The days from ``since`` on with the columns of all; None without folders of days."""
    prefix, root = f"{LANDING_DAY}=", base.rstrip("/")
    days = [n.removeprefix(prefix) for n in versions.children(spark, base) or [] if n.startswith(prefix)]
    if not days:
        return None
    noted = {day or _NO_DAY: names for day, names in columns.known(spark, base).items()}
    fields: dict[str, T.DataType] = {}
    for day in sorted(set(days) & set(noted)):
        fields |= {c: T.StringType() for c in noted[day] if c not in fields}
    others = [f"{root}/{prefix}{day}" for day in days if day not in noted]
    if others:
        foreign = spark.read.option("mergeSchema", True).option("basePath", root).parquet(*others)
        fields |= {f.name: f.dataType for f in foreign.schema if f.name not in fields and f.name != LANDING_DAY}
    day_type = T.DateType() if all(_is_date(day) for day in days if day != _NO_DAY) else T.StringType()
    schema = T.StructType([*(T.StructField(n, t) for n, t in fields.items()), T.StructField(LANDING_DAY, day_type)])
    chosen = [day for day in days if since is None or (day != _NO_DAY and day >= since)]
    if not chosen:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", root).parquet(*[f"{root}/{prefix}{day}" for day in chosen])


def _is_date(text: str) -> bool:
    try:
        return date.fromisoformat(text).isoformat() == text
    except ValueError:
        return False


def if_present(load, *args, **kwargs) -> DataFrame | None:
    """Call a loader; None if its path does not exist.  Any other error is raised."""
    try:
        return load(*args, **kwargs)
    except AnalysisException as err:
        condition = (err.getCondition() or "").split(".")[0]
        if condition in _ABSENT:
            return None
        raise
