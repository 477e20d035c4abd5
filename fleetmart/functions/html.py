"""Expressions over HTML text and URLs.

Patterns are written so that they read each page once: comment and raw-text patterns
always match to the end of the page when unclosed, and repeated groups are possessive
(no backtracking, no deep recursion in the JVM regex engine).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_NOT_MARKUP = r"(?is)<(?:!--.*?(?:-->|\z)|(script|style|textarea|title)(?=[\s/>]).*?(?:</\1\s*>|\z))"
_ANCHOR_START = r"(?i)<a(?=[\s/>])"
_TAG_BODY = r"""(?is)^((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>"""
_ANCHOR = _TAG_BODY + r".*?(?=</a\s*>|\z)"
_TAG = r"""<(?:(?:[^<>"']++|"[^"]*+"|'[^']*+')*+|[^<>]*+)>"""
_ATTRIBUTE = r"""([^\s"'>/=]++)(?:\s*+=\s*+("[^"]*+"|'[^']*+'|[^\s"'>]++))?"""
_TO_THE_END = 1 << 30  # more elements than an array can hold; asking its size would build it twice
_SCHEME = r"^([a-zA-Z][a-zA-Z0-9+.\-]*):"

# The named character references decoded in link text and attributes.
_ENTITIES = (
    ("&nbsp;", " "),
    ("&lt;", "<"),
    ("&gt;", ">"),
    ("&quot;", '"'),
    ("&#39;", "'"),
    ("&apos;", "'"),
    ("&amp;", "&"),
)


def anchor_chunks(html: Column) -> Column:
    """Array with one chunk per ``<a`` tag: its attributes, ``>`` and what follows.

    A chunk ends where the next anchor starts, as in a browser, where an anchor cannot
    hold another one.  Comments and raw-text elements become an empty mark first, which
    shows no text and keeps what is around it apart.
    """
    chunks = F.split(F.regexp_replace(html, _NOT_MARKUP, "<!>"), _ANCHOR_START, -1)
    return F.slice(chunks, 2, _TO_THE_END)


def anchor_part(chunk: Column) -> Column:
    """The part of a chunk up to ``</a>``; empty if the tag itself never ends."""
    return F.regexp_extract(chunk, _ANCHOR, 0)


def tag_body(anchor: Column) -> Column:
    """Attribute text of the tag an anchor starts with."""
    return F.regexp_extract(anchor, _TAG_BODY, 1)


def attribute_names(tag: Column) -> Column:
    return F.transform(F.regexp_extract_all(tag, F.lit(_ATTRIBUTE), F.lit(1)), F.lower)


def attribute_values(tag: Column) -> Column:
    return F.regexp_extract_all(tag, F.lit(_ATTRIBUTE), F.lit(2))


def attribute(names: Column, values: Column, name: str) -> Column:
    """Value of the first attribute called ``name``, unquoted; NULL when absent."""
    position = F.array_position(names, F.lit(name)).cast("int")
    value = F.get(values, position - 1)
    quoted = value.startswith('"') | value.startswith("'")
    bare = F.when(quoted, value.substr(F.lit(2), F.length(value) - 2)).otherwise(value)
    return decode_entities(bare)


def anchor_text(anchor: Column, tag: Column) -> Column:
    """Visible text of an anchor: tags removed, whitespace collapsed."""
    inner = anchor.substr(F.length(tag) + 2, F.length(anchor))
    no_breaks = F.regexp_replace(inner, r"(?i)<br\s*/?>", " ")
    no_tags = F.when(inner.contains("<"), F.regexp_replace(no_breaks, _TAG, "")).otherwise(inner)
    return F.trim(F.regexp_replace(decode_entities(no_tags), r"[\s\u00a0]+", " "))


def decode_entities(text: Column) -> Column:
    decoded = text
    for entity, char in _ENTITIES:
        decoded = F.replace(decoded, F.lit(entity), F.lit(char))
    return F.when(text.contains("&"), decoded).otherwise(text)


def _without_dot_segments(path: Column) -> Column:
    """Remove ``.`` and ``..`` segments of an absolute path."""

    def step(kept: Column, segment: Column) -> Column:
        parent = F.when(F.size(kept) > 1, F.slice(kept, F.lit(1), F.size(kept) - 1)).otherwise(kept)
        return (
            F.when(segment == "..", parent)
            .when(segment == ".", kept)
            .otherwise(F.concat(kept, F.array(segment)))
        )

    # a path ending in a dot segment names a directory and keeps its final slash
    closed = F.regexp_replace(path, r"/(\.{1,2})$", "/$1/")
    segments = F.split(closed, "/", -1)
    kept = F.aggregate(segments, F.array().cast("array<string>"), step)
    return F.when(path.rlike(r"/\.{1,2}(/|$)"), F.array_join(kept, "/")).otherwise(path)


def absolute_url(base: Column, href: Column) -> Column:
    """Resolve ``href`` against the URL of the page that holds it."""
    href = F.trim(href)
    origin = F.regexp_extract(base, r"^([a-zA-Z][a-zA-Z0-9+.\-]*:(?://[^/?#]*)?)", 1)
    before_query = F.regexp_extract(base, r"^[^?#]*", 0)
    base_path = before_query.substr(F.length(origin) + 1, F.length(before_query))
    base_path = F.when(base_path == "", F.lit("/")).otherwise(base_path)
    folder = F.regexp_extract(base_path, r"^(.*/)", 1)

    path = F.regexp_extract(href, r"^[^?#]*", 0)
    rest = href.substr(F.length(path) + 1, F.length(href))
    full_path = F.when(path.startswith("/"), path).otherwise(F.concat(folder, path))
    return (
        F.when(href.rlike(_SCHEME), href)
        .when(href.startswith("//"), F.concat(F.regexp_extract(base, _SCHEME, 1), F.lit(":"), href))
        .when(href == "", F.regexp_replace(base, "(?s)#.*$", ""))
        .when(href.startswith("#"), F.concat(F.regexp_replace(base, "(?s)#.*$", ""), href))
        .when(href.startswith("?"), F.concat(origin, base_path, href))
        .otherwise(F.concat(origin, _without_dot_segments(full_path), rest))
    )
