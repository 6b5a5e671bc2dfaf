"""Links of a page that lead to management pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stewardry import vocab
from stewardry.functions.html import clean_html, decode_references, markup_only
from stewardry.functions.urls import resolve_link
from stewardry.operators.once import compute_once
from stewardry.operators.spread import spread_small

_ANCHOR = r"""(?is)<a(?=[\s/>])((?:[^>"']|"[^"]*"|'[^']*')*+)>(.*?)(?=</a\s*>|<a[\s>]|\z)"""
_HREF = r"""(?is)(?:^|\s)href\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""


def _hrefs(html: Column) -> Column:
    """`array<struct<href, text>>` of the anchors that have an address."""
    html = markup_only(html)
    attributes = F.regexp_extract_all(html, F.lit(_ANCHOR), F.lit(1))
    inner = F.regexp_extract_all(html, F.lit(_ANCHOR), F.lit(2))

    def anchor(attrs: Column, body: Column) -> Column:
        href = F.concat(*(F.regexp_extract(attrs, _HREF, g) for g in (1, 2, 3)))
        return F.struct(
            F.when(attrs.rlike(_HREF), decode_references(href)).alias("href"),
            clean_html(body).alias("text"),
        )

    return F.filter(F.zip_with(attributes, inner, anchor), lambda a: a["href"].isNotNull())


def management_links(
    pages: DataFrame, base: str = "url", html: str = "html", prefix: str | None = None
) -> DataFrame:
    """One row per distinct link of a page that may lead to management pages.

    A link counts when its text or address holds one of the link words and its full
    address begins with `prefix` (a column, by default the base itself). The work stays
    inside the page's row: distinct links of one page need no shuffle.
    """
    words = vocab.words_pattern(vocab.LINK_WORDS)
    base_col, prefix_col = F.col(base), F.col(prefix or base)
    chosen = F.filter(
        _hrefs(F.col(html)),
        lambda a: F.lower(a["text"]).rlike(words) | F.lower(a["href"]).rlike(words),
    )
    full = F.transform(chosen, lambda a: resolve_link(base_col, a["href"]))
    internal = F.array_distinct(F.filter(full, lambda u: F.startswith(u, prefix_col)))
    others = [c for c in pages.columns if c != html]
    return compute_once(spread_small(pages), _links=internal).select(*others, F.explode("_links").alias("link"))
