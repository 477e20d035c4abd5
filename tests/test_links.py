from __future__ import annotations

import random
from html.parser import HTMLParser
from urllib.parse import urljoin

import duckdb
import pytest
from pyspark.sql import functions as F

from fleetmart.functions.html import absolute_url
from fleetmart.sources import links

BASE = "https://data.example.org/set/map/index.html?page=2#top"


def harvest(spark, html, contains=".csv", base=BASE):
    pages = spark.createDataFrame([(1, base, html)], "page_id int, url string, html string")
    return [tuple(r)[1:] for r in links.harvest_links(pages, contains=contains).orderBy("pos").collect()]


def test_document_order_text_and_title(spark):
    html = """<p><a href="/a.csv">One</a> <A class='x' HREF='b.CSV' title="It &amp; two">
       <b>Two</b>&nbsp; and <i>more</i></A> <a name=top>no</a><a href=c.csv>three</a><a href="/d.pdf">d</a>"""
    assert harvest(spark, html) == [
        (0, "https://data.example.org/a.csv", "One", ""),
        (1, "https://data.example.org/set/map/b.CSV", "Two and more", "It & two"),
        (3, "https://data.example.org/set/map/c.csv", "three", ""),
    ]


def test_anchors_in_comments_and_scripts_are_none(spark):
    html = """<!-- <a href="/a.csv">a</a> --><script>var s = '<a href="/b.csv">b</a>';</script>
        <abbr href="/c.csv">c</abbr><a href="/d.csv">d</a><!-- open <a href="/e.csv">e</a>"""
    assert [x[1:3] for x in harvest(spark, html)] == [("https://data.example.org/d.csv", "d")]


class Anchors(HTMLParser):
    """Anchors as the standard library's parser sees them."""

    def __init__(self, html):
        super().__init__()
        self.found, self.open = [], False
        self.feed(html)
        self.close()

    def handle_starttag(self, tag, attrs):
        if tag == "a":
            first = dict(reversed(attrs))
            self.found.append([first.get("href"), "", first.get("title") or ""])
            self.open = True
        elif tag == "br":
            self.handle_data(" ")

    def handle_endtag(self, tag):
        self.open = self.open and tag != "a"

    def handle_data(self, data):
        if self.open and not self.cdata_elem:  # scripts and styles show no text
            self.found[-1][1] += data


PIECES = [
    '<a href="/x.csv">', "<A HREF='y.csv' title='T &lt; u'>", "<a class=k href=z.csv>", '<a name="n">', '<a\nhref = "/w.csv"\ttitle="a > b">',
    '<a href="/1.csv" href="/2.csv">', "</a>", "</A >", "</a>", "<b>", "</b>", "<br/>", " text ", "two\n  words", "&amp;", "&quot;q&quot;",
    '<!-- <a href="/c.csv">c</a> -->', '<script>x = "<a href=/s.csv>"</script>', "<style>a{}</style>", '<abbr title="/t.csv">', "<p>", "1 &lt; 2",
    '<img alt="> <" src="/i.csv">',
]


def test_random_pages_against_another_parser(spark):
    rng = random.Random(11)
    pages = {p: "".join(rng.choice(PIECES) for _ in range(rng.randint(1, 25))) for p in range(400)}
    df = spark.createDataFrame([(p, BASE, h) for p, h in pages.items()], "page_id int, url string, html string")
    got = {}
    for row in links.harvest_links(df).collect():
        got.setdefault(row["page_id"], {})[row["pos"]] = (row["href"], row["text"], row["title"])
    for p, html in pages.items():
        anchors = enumerate(Anchors(html).found)
        wanted = {i: (urljoin(BASE, h), " ".join(text.split()), title) for i, (h, text, title) in anchors if h is not None}
        assert got.get(p, {}) == wanted, html


def test_signs_inside_attribute_values(spark):
    html = """<a title="a > b href=/no.csv" data-href="/no.csv" href="/yes.csv?x='1'">t</a>"""
    assert harvest(spark, html) == [(0, "https://data.example.org/yes.csv?x='1'", "t", "a > b href=/no.csv")]


def test_unclosed_anchor_ends_at_the_next(spark):
    assert [x[2] for x in harvest(spark, '<a href="/1.csv">one <a href="/2.csv">two</a> rest')] == ["one", "two"]


def test_pages_without_links(spark):
    for html in ("", None, "plain", "<a>", "<a href>x</a>", '<a href="/x.pdf">x</a>'):
        assert harvest(spark, html) == []


def test_long_pages_are_read_whole(spark):
    filler = "<p title='" + "x" * 200_000 + "'>" + "word < " * 50_000 + "</p>"
    html = filler + '<a href="/first.csv">1</a>' + filler + "<a " + "k='v' " * 20_000 + 'href="/last.csv">2</a>'
    assert [x[1].rsplit("/")[-1] for x in harvest(spark, html)] == ["first.csv", "last.csv"]


def test_loose_angle_brackets_cost_no_time(spark):
    html = '<a href="/a.csv">a < b <i>c</i> ' + "< " * 300_000
    assert harvest(spark, html)[0][2].startswith("a < b c < <")


HREFS = [
    "/x.csv", "x.csv", "./x.csv", "../x.csv", "../../x.csv", "../../../x.csv", "a/../b/./x.csv", "/a/../x.csv", "//other.org/x.csv",
    "http://other.org/x.csv", "?y=1", "a?y=../z", "x.csv#frag", "#f", "", " /x.csv ", "mailto:a@b.c", "a/..", "a/.", "/..x/y",
]


@pytest.mark.parametrize("base", ["https://data.example.org/set/map/index.html?page=2", "http://h.org/", "https://h.org/a/?q=/b/"])
def test_urls_resolve_as_the_standard_says(spark, base):
    df = spark.createDataFrame([(h,) for h in HREFS], "h string")
    got = {r["h"]: r["u"] for r in df.select("h", absolute_url(F.lit(base), F.col("h")).alias("u")).collect()}
    assert got == {h: urljoin(base, h.strip()) or base for h in HREFS}


def test_a_bare_host_has_the_root_path(spark):
    # as in a browser; urljoin leaves the slash out before a query
    df = spark.createDataFrame([("?y=1",), ("x.csv",)], "h string").select(absolute_url(F.lit("http://h.org"), F.col("h")))
    assert [r[0] for r in df.collect()] == ["http://h.org/?y=1", "http://h.org/x.csv"]


def latest(spark, rows, newest_year=2026):
    df = spark.createDataFrame([(1, *r) for r in rows], "page_id int, pos int, href string, text string, title string")
    row = links.latest_resource(df, newest_year=newest_year).first()
    return row["pos"], row["year"]


@pytest.mark.parametrize(
    ("rows", "expected"),
    [
        ([(0, "/2024.csv", "", ""), (1, "/x.csv", "2025", ""), (2, "/y.csv", "", "2025"), (3, "/z.csv", "", "")], (2, 2025)),
        ([(0, "/a.csv", "", ""), (1, "/b.csv", "", "")], (1, None)),
        ([(0, "/2022.csv", "", ""), (1, "/2021.csv", "", ""), (2, "/2019.csv", "", "")], (0, 2022)),
        ([(0, "/2021.csv", "", ""), (1, "/2027.csv", "", "")], (1, None)),
        ([(0, "/2023-2025.csv", "", ""), (1, "/2024.csv", "", "")], (0, 2025)),
    ],
)
def test_latest_resource(spark, rows, expected):
    assert latest(spark, rows) == expected


def test_latest_resource_of_random_pages(spark):
    """Against SQL: of a page's links the one that names the newest year allowed, else any; the
    last of equals."""
    rng = random.Random(7)
    rows = [
        (p, i, *(rng.choice(["", "x", str(rng.randint(2018, 2029))]) for _ in range(3)))
        for p in range(200)
        for i in range(rng.randint(1, 6))
    ]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "page_id int, pos int, href string, text string, title string").repartition(6)
    got = {r["page_id"]: (r["pos"], r["year"]) for r in links.latest_resource(df, newest_year=2026).collect()}
    con = duckdb.connect()
    con.execute("CREATE TABLE links (page_id INT, pos INT, href VARCHAR, text VARCHAR, title VARCHAR)")
    con.executemany("INSERT INTO links VALUES (?, ?, ?, ?, ?)", rows)
    expected = con.execute("""
        WITH named AS (
            SELECT page_id, pos, greatest(
                CASE WHEN TRY_CAST(href AS INT) BETWEEN 2022 AND 2026 THEN CAST(href AS INT) END,
                CASE WHEN TRY_CAST(text AS INT) BETWEEN 2022 AND 2026 THEN CAST(text AS INT) END,
                CASE WHEN TRY_CAST(title AS INT) BETWEEN 2022 AND 2026 THEN CAST(title AS INT) END) AS year
            FROM links)
        SELECT page_id, pos, year FROM named
        QUALIFY row_number() OVER (PARTITION BY page_id ORDER BY year DESC NULLS LAST, pos DESC) = 1""").fetchall()
    assert got == {page: (pos, year) for page, pos, year in expected}
