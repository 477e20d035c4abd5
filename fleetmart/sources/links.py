"""Link catalogues: harvest anchors of HTML pages and choose the newest resource."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetmart.contract import OLDEST_RESOURCE_YEAR
from fleetmart.functions import html as H
from fleetmart.functions.parse import named


def harvest_links(
    pages: DataFrame,
    *,
    contains: str = ".csv",
    key: Sequence[str] = ("page_id",),
    url: str = "url",
    html: str = "html",
) -> DataFrame:
    """One row per link whose absolute href contains ``contains`` in any case.

    Columns: ``key``, ``pos`` (place of the anchor on its page, from 0), ``href``,
    ``text``, ``title``.
    """
    keys = [named(k) for k in key]
    # outer, since the filter Spark infers for an inner explode cuts up every page twice
    chunks = pages.select(
        *keys, named(url).alias("_base"), F.posexplode_outer(H.anchor_chunks(named(html))).alias("pos", "_chunk")
    ).filter(F.col("pos").isNotNull())
    anchors = chunks.withColumn("_anchor", H.anchor_part(F.col("_chunk"))).drop("_chunk")
    tags = anchors.withColumn("_tag", H.tag_body(F.col("_anchor")))
    fields = tags.withColumns(
        {"_names": H.attribute_names(F.col("_tag")), "_values": H.attribute_values(F.col("_tag"))}
    )
    names, values = F.col("_names"), F.col("_values")
    targets = fields.withColumn("_href", H.attribute(names, values, "href"))
    link = F.struct(
        H.absolute_url(F.col("_base"), F.col("_href")).alias("href"),
        H.anchor_text(F.col("_anchor"), F.col("_tag")).alias("text"),
        F.coalesce(H.attribute(names, values, "title"), F.lit("")).alias("title"),
    )
    # a filter stays above inline, so no expression below it is copied into the filter
    links = targets.select(*keys, "pos", F.inline_outer(F.array(link)))
    return links.filter(F.lower("href").contains(contains.lower()))


def latest_resource(
    links: DataFrame,
    *,
    newest_year: int,
    oldest_year: int = OLDEST_RESOURCE_YEAR,
    key: Sequence[str] = ("page_id",),
) -> DataFrame:
    """The link to take from each catalogue page.

    The newest year within the bounds named in a text, title or href wins, and of that
    year the last link; without any such year the last link of the page.  ``year`` is
    then NULL.  Aggregation is partial before the shuffle, so a page of any size sends
    one row per task.
    """

    def names_year(year: int):
        digits = str(year)
        return F.col("text").contains(digits) | F.col("title").contains(digits) | F.col("href").contains(digits)

    year = F.lit(0)
    for candidate in range(oldest_year, newest_year + 1):
        year = F.when(names_year(candidate), F.lit(candidate)).otherwise(year)

    best = F.max_by(F.struct("pos", "href", "text", "title", "_year"), F.struct("_year", "pos"))
    return (
        links.withColumn("_year", year)
        .groupBy(*[named(k) for k in key])
        .agg(best.alias("_best"))
        .select(
            *[named(k) for k in key],
            "_best.pos",
            "_best.href",
            "_best.text",
            "_best.title",
            F.when(F.col("_best._year") > 0, F.col("_best._year")).alias("year"),
        )
    )
