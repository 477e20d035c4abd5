"""Queries: feeds, link catalogues and delimited files."""

from __future__ import annotations

from pyspark.sql import functions as F

from fleetmart.catalog.registry import query, table
from fleetmart.sinks.scratch import scratch_path
from fleetmart.sources import feeds, links
from fleetmart.sources.delimited import read_delimited

# The envelopes of a feed, by event_id % 4.
_SHAPES = ('[%s]', '{"entidades": [%s]}', '{"entidades": [], "records": [%s]}', '{"result": {"records": [%s]}}')


_BATCH = 40  # events in a body


def _records(spark, sf_dir):
    """Events as JSON records that hold their props, numbered by the body they belong in."""
    events = table(spark, sf_dir, "events")
    props = F.col("props").substr(F.lit(2), F.length("props"))
    record = F.concat(F.lit('{"id": '), "event_id", F.lit(', "type": "'), "event_type", F.lit('", '), props)
    return events.select(F.floor(F.col("event_id") / _BATCH).alias("batch"), "event_id", record.alias("record"))


def _bodies(spark, sf_dir, shapes=_SHAPES):
    """Feed bodies of many records each, in turn in the given envelopes."""
    listed = _records(spark, sf_dir).groupBy("batch").agg(F.array_sort(F.collect_list(F.struct("event_id", "record"))).alias("r"))
    records = F.array_join("r.record", ", ")
    wrapped = F.array(*[F.concat(*_split(shape, records)) for shape in shapes])
    return listed.select("batch", F.element_at(wrapped, (F.col("batch") % len(shapes) + 1).cast("int")).alias("body"))


def _split(pattern: str, record):
    before, after = pattern.split("%s")
    return F.lit(before), record, F.lit(after)


@query("feed_unwrap", f"""SELECT event_id // {_BATCH} AS batch, CAST(event_id AS VARCHAR) AS id,
    regexp_extract(props, '"k": *([0-9]+)', 1) AS k, event_type AS type FROM events""")
def feed_unwrap(spark, sf_dir):
    records = feeds.unwrap_feed(_bodies(spark, sf_dir), keep=["batch"], salvage=False)
    return feeds.tabulate(feeds.require_rows(records, "feed"), keep=["batch"])


# a bare list between other text is no object: its records are not found
@query("feed_salvage", f"""SELECT event_id // {_BATCH} AS batch, regexp_extract(props, '"k": *([0-9]+)', 1) AS k
    FROM events WHERE event_id // {_BATCH} % 4 <> 0""")
def feed_salvage(spark, sf_dir):
    around = [f"<pre>feed: {shape} </pre>" for shape in _SHAPES]
    records = feeds.unwrap_feed(_bodies(spark, sf_dir, around), keep=["batch"])
    return feeds.tabulate(records, ["k"], keep=["batch"])


# Good bodies and bad ones: cut short, no JSON, a list with something else in it, two values in a
# row, a byte-order mark, nothing in the list.
_MIXED = (
    '[%s]', '{"records": [%s', "<html>%s</html>", '[%s, 3]', '{"records": [%s]}{"records": []}', "\ufeff[%s]",
    '{"entidades": [], "other": [%s]}', '{"result": {"records": [%s]}}',
)
_REASONS = (None, "not JSON", "not JSON", "no records", "not JSON", "not JSON", "no records", None)


@query("feed_rejects", f"""SELECT DISTINCT event_id // {_BATCH} AS batch,
    list_extract({[r or "" for r in _REASONS]}, CAST(event_id // {_BATCH} % {len(_MIXED)} AS INTEGER) + 1) AS reject
    FROM events WHERE event_id // {_BATCH} % {len(_MIXED)} NOT IN (0, {len(_MIXED) - 1})""")
def feed_rejects(spark, sf_dir):
    rows = feeds.split_feed(_bodies(spark, sf_dir, _MIXED), keep=["batch"])
    return rows.filter("reject is not null").select("batch", "reject")


_LINKS = """
anchors AS (
    SELECT page_id, regexp_extract(url, '^(https?://[^/?#]*)', 1) AS origin,
           regexp_extract_all(html, '<a href="([^"]*)">([^<]*)</a>', 1) AS hrefs,
           regexp_extract_all(html, '<a href="([^"]*)">([^<]*)</a>', 2) AS texts FROM pages),
numbered AS (
    SELECT page_id, origin, hrefs, texts, unnest(range(1, len(hrefs) + 1)) AS i FROM anchors),
links AS (
    SELECT page_id, CAST(i - 1 AS INTEGER) AS pos, origin || replace(hrefs[i], '&amp;', '&') AS href,
           replace(trim(texts[i]), '&amp;', '&') AS text, '' AS title FROM numbered)
"""


@query("link_harvest", f"WITH {_LINKS} SELECT * FROM links WHERE contains(lower(href), 'en')")
def link_harvest(spark, sf_dir):
    return feeds.require_rows(links.harvest_links(table(spark, sf_dir, "pages"), contains="EN"), "catalogue")


@query("latest_resource", f"""WITH {_LINKS},
    dated AS (SELECT page_id, pos, href, text || ' ' || CAST(2019 + (page_id + pos) % 9 AS VARCHAR) AS text, title,
              2019 + (page_id + pos) % 9 AS said FROM links),
    ranked AS (SELECT *, CASE WHEN said BETWEEN 2022 AND 2026 THEN CAST(said AS VARCHAR) END AS year FROM dated)
    SELECT page_id, pos, href, text, title, year FROM ranked
    QUALIFY row_number() OVER (PARTITION BY page_id ORDER BY coalesce(year, '0') DESC, pos DESC) = 1""")
def latest_resource(spark, sf_dir):
    found = links.harvest_links(table(spark, sf_dir, "pages"), contains="/")
    said = (F.lit(2019) + (F.col("page_id") + F.col("pos")) % 9).cast("string")
    latest = links.latest_resource(found.withColumn("text", F.concat_ws(" ", "text", said)), newest_year=2026)
    return latest.withColumn("year", F.col("year").cast("string"))


@query("csv_semicolon_scan", """SELECT CAST(o_orderkey AS VARCHAR) AS O_ORDERKEY,
    lpad(CAST(o_custkey AS VARCHAR), 12, '0') AS O_CUSTKEY,
    o_orderpriority || ';"' || o_orderstatus || '"' AS "CONCESSIONÁRIA",
    replace(CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS VARCHAR), '.', ',') AS TOTAL,
    strftime(o_orderdate, '%d/%m/%Y') AS DATA FROM orders""")
def csv_semicolon_scan(spark, sf_dir):
    path = scratch_path(spark, "orders-csv")
    rows = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias(" o_orderkey "),
        F.lpad(F.col("o_custkey").cast("string"), 12, "0").alias("o_custkey"),
        F.concat("o_orderpriority", F.lit(';"'), "o_orderstatus", F.lit('"')).alias("concessionária "),
        F.replace(F.col("o_totalprice").cast("decimal(12,2)").cast("string"), F.lit("."), F.lit(",")).alias(" total"),
        F.date_format("o_orderdate", "dd/MM/yyyy").alias("data"),
    )
    as_is = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    rows.write.options(sep=";", header=True, escape='"', **as_is).csv(path)
    return read_delimited(spark, path)


@query("csv_many_headers", """SELECT CAST(o_orderkey AS VARCHAR) AS O_ORDERKEY, CAST(o_custkey AS VARCHAR) AS O_CUSTKEY,
    o_orderpriority || ';' AS PRIORITY FROM orders""")
def csv_many_headers(spark, sf_dir):
    """Three sets of files with the same columns in other orders."""
    path = scratch_path(spark, "orders-csv")
    orders = table(spark, sf_dir, "orders")
    names = ["o_orderkey", "o_custkey", "priority "]
    for n in range(3):
        rows = orders.filter(F.col("o_orderkey") % 3 == n).withColumn("priority ", F.concat("o_orderpriority", F.lit(";")))
        rows.select(*names[n:], *names[:n]).write.mode("append").options(sep=";", header=True, escape='"').csv(path)
    return read_delimited(spark, path)
