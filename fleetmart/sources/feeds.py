"""JSON feeds: unwrap the record list out of its envelope and tabulate it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetmart.functions.parse import named
from fleetmart.functions.schema import unused

_RECORDS = "array<map<string,string>>"

# The envelopes a feed may come in, tried in this order.
_ENVELOPE = f"entidades {_RECORDS}, records {_RECORDS}, result struct<records: {_RECORDS}>"


class EmptyInputError(ValueError):
    """A source that must hold rows holds none."""


class UnusableBodyError(EmptyInputError):
    """Feed bodies in which no record is found."""


def read_bodies(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """One row per response file: ``body``.  A file is one value, so it must stay below 2 GB;
    larger feeds come as a table of bodies."""
    return spark.read.text(path, wholetext=True).withColumnRenamed("value", "body")


def _filled(records: Column) -> Column:
    return F.when(F.size(records) > 0, records)


def _enclosed(envelope: Column) -> Column:
    """Record list of a parsed envelope: the first filled one of its three places."""
    return F.coalesce(
        _filled(envelope["entidades"]),
        _filled(envelope["records"]),
        _filled(envelope["result"]["records"]),
    )


def salvaged_object(body: Column) -> Column:
    """Text from the first ``{`` to the last ``}``; NULL if there is no such span."""
    start = F.instr(body, "{")
    end = F.length(body) - F.length(F.substring_index(body, "}", -1))
    return F.when((start > 0) & (end > start), body.substr(start, end - start + 1))


def _values(text: Column, kind: str) -> Column:
    """The JSON values that a whole text holds.  Inside brackets, whatever follows a value is
    an error or one more element."""
    return F.from_json(F.concat(F.lit("["), text, F.lit("]")), f"array<{kind}>")


def _only(values: str) -> Column:
    return F.when(F.size(values) == 1, F.get(F.col(values), F.lit(0)))


def split_feed(
    bodies: DataFrame, body: str = "body", *, keep: Sequence[str] = (), salvage: bool = True
) -> DataFrame:
    """One row per feed record, as a ``record`` map of text values, and one per body in which
    none is found, with the reason in ``reject`` (plus ``keep``).

    A body is a list of records or an object holding one, and nothing after it.  With
    ``salvage``, a body in which neither is found is searched for an embedded JSON object.
    Reasons: ``empty``, ``not JSON`` (text beyond the value, cut short, no JSON at all) and
    ``no records`` (JSON without a filled list of objects).  Each parse is a column of its own
    and the explode an outer one: the filter Spark infers for an inner explode repeats the
    whole expression, parses and all.
    """
    keys = [named(k) for k in keep]
    text = named(body)
    is_list, is_object = text.rlike(r"^\s*\["), text.rlike(r"^\s*\{")
    taken = [*bodies.columns, *keep]
    whole, records, envelope = unused("body", taken), unused("list", taken), unused("object", taken)
    found, embedded = unused("found", taken), unused("embedded", taken)
    parsed = bodies.select(
        *keys,
        text.alias(whole),
        _values(F.when(is_list, text), _RECORDS).alias(records),
        _values(F.when(is_object, text), f"struct<{_ENVELOPE}>").alias(envelope),
    )
    sought = parsed.select(
        *keys, whole, F.coalesce(_filled(_only(records)), _enclosed(_only(envelope))).alias(found)
    )
    if salvage:
        span = F.when(F.col(found).isNull(), salvaged_object(F.col(whole)))
        sought = sought.withColumn(embedded, _values(span, f"struct<{_ENVELOPE}>"))
        sought = sought.withColumn(found, F.coalesce(found, _enclosed(_only(embedded))))
    json = F.try_parse_json(F.concat(F.lit("["), whole, F.lit("]"))).isNotNull()
    reason = (
        F.when(F.col(found).isNotNull(), F.lit(None))
        .when(F.col(whole).isNull() | (F.trim(whole) == ""), "empty")
        .when(json, "no records")
        .otherwise("not JSON")
    )
    return sought.select(*keys, reason.alias("reject"), F.explode_outer(found).alias("record"))


def unwrap_feed(
    bodies: DataFrame, body: str = "body", *, keep: Sequence[str] = (), salvage: bool = True
) -> DataFrame:
    """The records of :func:`split_feed` alone; look there for bodies without any."""
    rows = split_feed(bodies, body, keep=keep, salvage=salvage)
    return rows.filter(F.col("record").isNotNull()).drop("reject")


def require_records(rows: DataFrame, what: str) -> DataFrame:
    """The records of a split feed; raises when there is none or a body was rejected."""
    reasons = {r["reject"]: r["count"] for r in rows.groupBy("reject").count().collect()}
    rejected = {reason: n for reason, n in reasons.items() if reason is not None}
    if rejected:
        raise UnusableBodyError(f"{what}: {sum(rejected.values())} bodies without records: {rejected}")
    if not reasons:
        raise EmptyInputError(f"{what} is empty")
    return rows.filter(F.col("record").isNotNull()).drop("reject")


def record_fields(records: DataFrame, record: str = "record") -> list[str]:
    """Distinct field names of the records, sorted; only the names reach the driver."""
    names = records.select(F.explode(F.map_keys(named(record))).alias("name")).distinct()
    return sorted(row["name"] for row in names.toLocalIterator())


def tabulate(
    records: DataFrame,
    fields: Sequence[str] | None = None,
    *,
    record: str = "record",
    keep: Sequence[str] = (),
) -> DataFrame:
    """One text column per field; a missing field or JSON null is NULL."""
    if fields is None:
        fields = record_fields(records, record)
    values = named(record)
    return records.select(*[named(k) for k in keep], *[F.try_element_at(values, F.lit(f)).alias(f) for f in fields])


def require_rows(df: DataFrame, what: str) -> DataFrame:
    """Return ``df``, or raise :class:`EmptyInputError` when it has no row."""
    if df.isEmpty():
        raise EmptyInputError(f"{what} is empty")
    return df
