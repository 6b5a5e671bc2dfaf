"""Text of a whole site, put together from its pages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stewardry.functions.html import clean_html
from stewardry.functions.text import compact_lines
from stewardry.functions.urls import authority
from stewardry.operators.once import compute_once
from stewardry.operators.spread import spread_small


def page_texts(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """`site, url, text`: every page as one line of text."""
    named = spread_small(pages).select(
        authority(url).alias("site"), F.col(url).alias("url"), F.col(html).alias("_html")
    )
    texts = compute_once(named, text=compact_lines(clean_html("_html")))
    return texts.select("site", "url", "text")


def site_text(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """`site, url, text`: every page of a site as a row, sites together and pages in URL order.

    One shape at any size: a site of a third of all pages is simply many rows, as the
    range sort may cut anywhere. `joined_site_text` gives a site as one string.
    """
    return page_texts(pages, url, html).orderBy("site", "url")


def joined_site_text(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """`site, n_pages, text`: a site's pages joined by blank lines, in URL order.

    The whole text of a site becomes one value, so this is for sites known to be small.
    """
    ordered = F.sort_array(F.collect_list(F.struct("url", "text")))
    return page_texts(pages, url, html).groupBy("site").agg(
        F.count(F.lit(1)).alias("n_pages"),
        F.array_join(F.transform(ordered, lambda p: p["text"]), "\n\n").alias("text"),
    )
