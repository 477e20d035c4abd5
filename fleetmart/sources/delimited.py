"""Delimited text with a header line."""

from __future__ import annotations

import csv
import re
from collections import defaultdict
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetmart.functions.schema import unused

# A separator that no text has, to read lines whole in any encoding.
_NO_SEPARATOR = "\x01"
# Encodings in which a line feed is one byte that nothing else holds and that
# ``decode`` knows.
_SPLITTABLE = {"utf-8", "utf8", "iso-8859-1", "latin-1", "latin1", "us-ascii", "ascii"}
# File systems that tasks open by themselves, under the name they have there.
_OPENED = {"file": "file", "hdfs": "hdfs", "s3": "s3", "s3a": "s3", "gs": "gs"}
_FILES_A_TASK = 100


def read_delimited(
    spark: SparkSession,
    path: str | list[str],
    *,
    sep: str = ";",
    encoding: str = "UTF-8",
    multi_line: bool = False,
) -> DataFrame:
    """Read ``sep``-separated files as strings, header names upper-cased and stripped.

    Files are read by the names in their own headers, one scan for each distinct header; one
    that lacks a column of another makes the job fail.  Headers are read in tasks.  Types are not
    inferred, so codes keep leading zeros.  A line with too few fields is filled with NULLs; one
    with more filled fields than the header makes the job fail instead of losing them, and so does
    one with an unclosed quote.  Files are split between tasks, with ``multi_line`` (where quoted
    fields hold line breaks) too, which reads them twice; then compressed files, and files in other
    encodings than UTF-8, ISO-8859-1 and ASCII, are read by one task each.
    """
    found = [(line, files) for line, files in _headers(spark, [path] if isinstance(path, str) else path, encoding) if line is not None]
    if not found:
        raise ValueError(f"no header line in {path}")
    by_header: dict[tuple[str, ...], list[str]] = defaultdict(list)
    for line, files in found:
        by_header[tuple(next(csv.reader([line], delimiter=sep)))] += files
    read = _read_lines if not multi_line else _read_records if encoding.lower() in _SPLITTABLE else _read_files
    parts = [upper_headers(read(spark, sorted(files), list(header), sep, encoding)) for header, files in sorted(by_header.items())]
    return reduce(DataFrame.unionByName, parts)


def _files(spark: SparkSession, paths: list[str]) -> list[str]:
    """Files under the paths, which may hold patterns; hidden ones are left out."""
    sc = spark.sparkContext
    hadoop, conf = sc._jvm.org.apache.hadoop, sc._jsc.hadoopConfiguration()
    found = []
    for path in paths:
        place = hadoop.fs.Path(path)
        fs = place.getFileSystem(conf)
        for status in fs.globStatus(place) or []:
            listed = fs.listStatus(status.getPath()) if status.isDirectory() else [status]
            found += [s.getPath().toString() for s in listed if s.isFile() and not s.getPath().getName().startswith(("_", "."))]
    return found


def _headers(spark: SparkSession, paths: list[str], encoding: str) -> list[tuple[str, list[str]]]:
    """The distinct first lines with the files that have them; empty files have none."""
    by_scheme: dict[bool, list[str]] = defaultdict(list)
    for file in _files(spark, paths):
        by_scheme[file.partition(":")[0] in _OPENED].append(file)
    heads = []
    if by_scheme[True]:
        heads.append(_opened_heads(spark, by_scheme[True], encoding))
    if by_scheme[False]:
        heads.append(_scanned_heads(spark, by_scheme[False], encoding))
    if not heads:
        return []
    lines = reduce(DataFrame.unionByName, heads).filter("line is not null").groupBy("line").agg(F.collect_list("file").alias("files"))
    return [(r["line"], r["files"]) for r in lines.collect()]


def _opened(file: str):
    """The file system of a file, and its path there; names are as they are, not escaped."""
    from pyarrow import fs

    scheme, _, rest = file.partition(":")
    authority, _, path = rest[2:].partition("/") if rest.startswith("//") else ("", "", rest.lstrip("/"))
    kind = _OPENED[scheme]
    if kind == "file":
        return fs.LocalFileSystem(), f"/{path}"
    place, _ = fs.FileSystem.from_uri(f"{kind}://{authority}/")
    return place, f"/{path}" if kind == "hdfs" else f"{authority}/{path}"


def _opened_heads(spark: SparkSession, files: list[str], encoding: str) -> DataFrame:
    """``file, line``: tasks open the files and read no further than the first line."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lines = []
            for file in batch.column("file").to_pylist():
                place, inner = _opened(file)
                with place.open_input_stream(inner) as stream:
                    head = b""
                    while b"\n" not in head and b"\r" not in head and (more := stream.read(1 << 16)):
                        head += more
                line = re.split(b"[\r\n]", head, maxsplit=1)[0].decode(encoding).removeprefix("\ufeff")
                lines.append(line if head else None)
            yield pa.RecordBatch.from_arrays([batch.column("file"), pa.array(lines, pa.string())], names=["file", "line"])

    rows = spark.createDataFrame([(f,) for f in files], "file string").repartition(-(-len(files) // _FILES_A_TASK))
    return rows.mapInArrow(read, "file string, line string")


def _scanned_heads(spark: SparkSession, files: list[str], encoding: str) -> DataFrame:
    """The same for file systems that only Spark opens: its reader goes over the files once."""
    options = {"sep": _NO_SEPARATOR, "quote": "", "encoding": encoding}
    lines = spark.read.options(**options).schema("line string").csv(files)
    lines = lines.select("line", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("at"), F.monotonically_increasing_id().alias("row"))
    first = lines.filter("at = 0").groupBy("file").agg(F.min_by("line", "row").alias("line"))
    return first.select("file", F.regexp_replace("line", "^\ufeff", "").alias("line"))


def _numbered(n: int) -> list[str]:
    return [f"_{k}" for k in range(n)]


def _read_lines(spark: SparkSession, files: list[str], header: list[str], sep: str, encoding: str) -> DataFrame:
    """Lines parsed one by one, each checked as a whole first."""
    options = {"sep": _NO_SEPARATOR, "quote": "", "header": True, "encoding": encoding}
    lines = spark.read.options(**options).schema("line string").csv(files)
    return _parsed(lines, header, sep, "line with an unclosed quote (set multi_line for line breaks in quotes): ")


def _field(sep: str) -> str:
    """A pattern of one field; possessive, so that no line makes it go back."""
    s = re.escape(sep)
    return f'(?:"[^"]*+(?:""[^"]*+)*+"|[^"{s}][^{s}]*+|)'


def _parsed(lines: DataFrame, header: list[str], sep: str, unclosed: str) -> DataFrame:
    s, field = re.escape(sep), _field(sep)
    closed = F.col("line").rlike(f"^{field}(?:{s}{field})*+\\z")
    bare = F.regexp_replace(F.regexp_replace("line", f'(?<=^|{s})"[^"]*+(?:""[^"]*+)*+"', "q"), f"{s}+\\z", "")
    fits = F.size(F.split(bare, s)) <= len(header)

    def stopped(why: str):
        return F.raise_error(F.concat(F.lit(why), F.col("line"))).cast("boolean")

    whole = lines.filter(F.when(~closed, stopped(unclosed)).when(~fits, stopped("line has more fields than the header: ")).otherwise(True))
    schema = T.StructType([T.StructField(name, T.StringType()) for name in _numbered(len(header))])
    fields = F.from_csv(
        "line", schema.simpleString().removeprefix("struct<").removesuffix(">").replace(":", " "), {"sep": sep, "quote": '"', "escape": '"', "multiLine": "true", "lineSep": "\x02"}
    )
    return whole.select(fields.alias("f")).select("f.*").toDF(*header)


def _leaves_open(line: Column, sep: str) -> Column:
    """Whether a quote is open at the end of a line that begins outside of quotes."""
    return line.rlike(f'^(?:{_field(sep)}{re.escape(sep)})*+"[^"]*+(?:""[^"]*+)*+\\z')


def _read_records(spark: SparkSession, files: list[str], header: list[str], sep: str, encoding: str) -> DataFrame:
    """Records with line breaks in quotes, out of files that are cut anywhere.

    A line maps "begins inside of quotes" to "ends inside of quotes". The maps of a split's lines
    are composed to one, those of a file's splits give where each split begins, and with that a second
    scan tells in which lines a record ends. Records that lie in several splits are put together by
    a shuffle of their pieces alone.
    """
    text = spark.read.option("lineSep", "\n").text(files)
    decoded = F.decode(F.col("value").cast("binary"), "UTF-8" if encoding.lower() in ("utf-8", "utf8") else "ISO-8859-1")
    value = F.regexp_replace(decoded, "^\ufeff", "")
    lines = text.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("at"), value.alias("line"))
    quoted = F.col("line").contains('"')
    # what ends open: a line that begins outside, and one that begins inside
    mapped = lines.withColumns(
        {"out": F.when(quoted, _leaves_open(F.col("line"), sep)).otherwise(False), "in": F.when(quoted, _leaves_open(F.concat(F.lit('"'), "line"), sep)).otherwise(True)}
    )

    def compose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, out, inn = None, False, True
        schema = pa.schema([("file", pa.string()), ("at", pa.int64()), ("out", pa.bool_()), ("in", pa.bool_())])

        def row():
            return pa.RecordBatch.from_pylist([{"file": split[0], "at": split[1], "out": out, "in": inn}], schema)

        for batch in batches:
            for file, at, o, i in zip(*(batch.column(c).to_pylist() for c in ("file", "at", "out", "in")), strict=True):
                if (file, at) != split:
                    if split is not None:
                        yield row()
                    split, out, inn = (file, at), False, True
                out, inn = (i if out else o), (i if inn else o)
        if split is not None:
            yield row()

    splits = mapped.select("file", "at", "out", "in").mapInArrow(compose, "file string, at long, out boolean, in boolean")
    in_order = splits.groupBy("file").agg(F.sort_array(F.collect_list(F.struct("at", "out", "in"))).alias("splits"))
    inside = in_order.select(
        "file",
        F.explode(
            F.expr(
                """aggregate(splits, named_struct('open', false, 'found', cast(array() as array<bigint>)),
                (s, x) -> named_struct('open', if(s.open, x.in, x.out), 'found', if(s.open, array_append(s.found, x.at), s.found)), s -> s.found)"""
            )
        ).alias("at"),
    )
    known = mapped.join(F.broadcast(inside.withColumn("open", F.lit(True))), ["file", "at"], "left").na.fill(False, ["open"])

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, held, first, number = None, [], 0, 0
        names = ["file", "at", "number", "part", "line"]

        def close(done, part):
            done.append((split[0], split[1], number, part, "\n".join(held)))

        for batch in batches:
            done: list[tuple] = []
            for file, at, o, i, begins, line in zip(*(batch.column(c).to_pylist() for c in ("file", "at", "out", "in", "open", "line")), strict=True):
                if (file, at) != split:
                    if held:
                        close(done, "begun" if first == 0 else "between")
                    split, held, number, opened = (file, at), [], 0, begins
                    first = 1 if begins else 0  # 1: the record in hand began in an earlier split
                opened = i if opened else o
                held.append(line)
                if not opened:
                    close(done, "ended" if first else "whole")
                    held, first, number = [], 0, number + 1
            columns = list(zip(*done, strict=True)) if done else [[]] * 5
            kinds = (pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)
        if held:
            yield pa.RecordBatch.from_pydict({"file": [split[0]], "at": [split[1]], "number": [number], "part": ["between" if first else "begun"], "line": ["\n".join(held)]})

    pieces = known.select("file", "at", "out", "in", "open", "line").mapInArrow(records, "file string, at long, number long, part string, line string")
    # the header is the first record of a file
    pieces = pieces.filter(~((F.col("at") == 0) & (F.col("number") == 0) & (F.col("part") == "whole")))
    whole = pieces.filter("part = 'whole'").select("line")
    begun = F.count_if(F.col("part") == "begun").over(Window.partitionBy("file").orderBy("at", "number"))
    joined = pieces.filter("part <> 'whole'").withColumn("record", begun).groupBy("file", "record").agg(F.sort_array(F.collect_list(F.struct("at", "line"))).alias("p"))
    joined = joined.select(F.array_join("p.line", "\n").alias("line"))
    every = whole.unionByName(joined).select(F.regexp_replace("line", "\r\\z", "").alias("line")).filter("line <> ''")
    return _parsed(every, header, sep, "record with an unclosed quote: ")


def _read_files(spark: SparkSession, files: list[str], header: list[str], sep: str, encoding: str) -> DataFrame:
    """Whole files parsed by one task each, where quoted fields hold line breaks."""
    names = _numbered(len(header))
    excess, bad = unused("excess", names), unused("bad", names)
    fields = [T.StructField(name, T.StringType()) for name in [*names, excess, bad]]
    options = {"sep": sep, "quote": '"', "escape": '"', "header": True, "encoding": encoding, "multiLine": True, "columnNameOfCorruptRecord": bad}
    rows = spark.read.options(**options).schema(T.StructType(fields)).csv(files)
    # A record of too few fields is bad too, but then its last ones are NULL.
    last = F.col(names[-1])
    lost = F.col(excess).isNotNull() | (F.col(bad).isNotNull() & last.isNotNull() & F.col(bad).rlike(f"{re.escape(sep)}[^{re.escape(sep)}\\s]"))
    over = F.size(F.split(F.regexp_replace(F.regexp_replace(F.col(bad), '"[^"]*+(?:""[^"]*+)*+"', "q"), f"{re.escape(sep)}+\\s*$", ""), re.escape(sep))) > len(header)
    too_long = F.raise_error(F.concat(F.lit("record has more fields than the header: "), F.coalesce(F.col(bad), F.col(excess)))).cast("boolean")
    whole = rows.filter(F.when(F.coalesce(lost & (F.col(excess).isNotNull() | over), F.lit(False)), too_long).otherwise(True))
    return whole.select(*names).toDF(*header)


def upper_headers(df: DataFrame) -> DataFrame:
    return df.toDF(*[name.upper().strip() for name in df.columns])
