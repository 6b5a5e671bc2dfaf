"""Main text of web pages by removing what a site repeats.

Every element's subtree is hashed. In Spark, the pages of a host that hold a subtree among
different text are counted; one that recurs on many of them is template and is deleted from every page of
that host. Elements that HTML itself, their role or their name sets apart from the article
(menus, footers, forms, adverts, comments) go on any site, also on one of few pages.
What a page declares as its article is evidence: inside of it only containers that recur on
more pages are taken for template, since articles and passages recur on a site as well.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stewardry.llm.hashing import mixed
from stewardry.llm.markup import ARTICLE, Page, blocks, parsed, text_sizes
from stewardry.session import written

#: A subtree is template on at least so many different pages of the host and on this share of
#: them, or, outside of articles, on so many however large the host is. Pages of the same text are
#: one page.
LEAST_PAGES, LEAST_SHARE, MANY_PAGES = 4, 0.2, 200
#: What a page declares as its article is evidence against template: inside of it a subtree needs
#: so many times the share, and only containers count, as headings and passages recur.
INSIDE = 2.5
CONTAINERS = frozenset("article aside center details div dl figure footer header hgroup li menu ol section table ul".split())

#: Tasks that the pages of one host may be dealt over.
SALTS = 64

_SPACE = re.compile(r"\s+")
_MASK = (1 << 64) - 1
_BASE = 0x9E3779B97F4A7C15
_INVERSE = np.uint64(pow(_BASE, -1, 1 << 64))


def _powers(base: np.uint64, exponents: np.ndarray) -> np.ndarray:
    """base ** exponent modulo 2**64, by squaring."""
    out, exponents = np.ones(len(exponents), np.uint64), exponents.copy()
    while exponents.any():
        out = np.where(exponents & 1, out * base, out)
        with np.errstate(over="ignore"):
            base = base * base
        exponents >>= 1
    return out


def host_of(url: Column) -> Column:
    """The host in lower case, without user and port; empty if there is none."""
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


def page_of(source: str | None) -> Page:
    """The parsed page, any white space in it as one space."""
    return parsed(_SPACE.sub(" ", source or ""))


def _contents(page: Page) -> tuple[int, list[int]]:
    """A hash of the page's text outside of what is apart, and what each subtree adds to it."""
    whole, parts = 0, [0] * len(page.elements)
    for at, _, text in page.texts:
        words = " ".join(text.split())
        if words and (at < 0 or not page.elements[at].apart):
            h = int.from_bytes(hashlib.blake2b(words.encode("utf-8", "surrogatepass"), digest_size=8).digest())
            whole += h
            if at >= 0:
                parts[at] += h
    for i in range(len(parts) - 1, -1, -1):
        if page.elements[i].parent >= 0:
            parts[page.elements[i].parent] += parts[i]
    return whole & _MASK, [p & _MASK for p in parts]


def _subtrees(page: Page) -> Iterator[tuple[int, int]]:
    """(element, hash) of all subtrees that may be template: inside an article its containers, and
    nothing that holds the article most of the page's text is in."""
    # the main text, and what is around it: nothing that holds half of the page's text or more
    sizes, total = text_sizes(page)
    around = {i for i, e in enumerate(page.elements) if e.tag in ARTICLE and 2 * sizes[i] >= total}
    for i in tuple(around):
        up = page.elements[i].parent
        while up >= 0 and up not in around:
            around.add(up)
            up = page.elements[up].parent
    # one running sum over the page gives every subtree's polynomial hash
    letters = np.frombuffer(page.source.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64) + np.uint64(1)
    factors = np.full(len(letters) + 1, _BASE, np.uint64)
    factors[0] = 1
    factors = np.cumprod(factors)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(letters * factors[:-1])])
    asked = [
        i for i, e in enumerate(page.elements)
        if i not in around and e.tag not in ("html", "body") and (not e.inside or e.tag in CONTAINERS)]
    starts = np.array([page.elements[i].start for i in asked], np.int64)
    ends = np.array([page.elements[i].end for i in asked], np.int64)
    # brought to the power a subtree at the page's start would have
    hashes = mixed((sums[ends] - sums[starts]) * _powers(_INVERSE, starts))
    # the lowest bit tells those inside an article
    inside = np.array([page.elements[i].inside for i in asked], np.uint64)
    hashes = (hashes & ~np.uint64(1)) | inside
    yield from zip(asked, hashes.view(np.int64).tolist(), strict=True)


def template_subtrees(pages: DataFrame, least_pages: int = LEAST_PAGES, least_share: float = LEAST_SHARE) -> DataFrame:
    """host (its hash), templates: the hashes of each host's recurring subtrees.

    A subtree counts once for each different text around it, so that copies of a page are one.

    A host has no more of them than a page has subtrees on average, divided by the share.
    """
    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hosts, found, rests = [], [], []
            for host, source in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                page = page_of(source.as_py())
                whole, parts = _contents(page)
                # without a subtree: the page itself
                own = {(None, whole)} | {(h, whole - parts[i] & _MASK) for i, h in _subtrees(page) if parts[i] and not page.elements[i].apart}
                hosts += [host] * len(own)
                found += [h for h, _ in own]
                rests += [r - (1 << 63) for _, r in own]
            yield pa.RecordBatch.from_arrays(
                [pa.array(hosts, pa.int64()), pa.array(found, pa.int64()), pa.array(rests, pa.int64())], ["host", "subtree", "rest"])

    sited = pages.select(F.xxhash64(host_of(F.col("url"))).alias("host"), "html")
    differing = sited.mapInArrow(hashes, "host long, subtree long, rest long").groupBy("host", "subtree", "rest").agg(F.lit(1).alias("_one"))
    counted = differing.groupBy("host", "subtree").agg(F.count("*").alias("_n")).where(F.col("_n") >= least_pages)
    counted = written(counted, "subtrees")
    counts = counted.where("subtree IS NULL").select("host", F.col("_n").alias("_of"))
    recurring = counted.where("subtree IS NOT NULL").join(counts, "host")
    inside = F.col("subtree").bitwiseAND(F.lit(1)) == 1
    least = F.when(inside, F.col("_of") * min(1.0, INSIDE * least_share)).otherwise(F.least(F.col("_of") * least_share, F.lit(MANY_PAGES)))
    many = recurring.where(F.col("_n") >= least)
    return many.groupBy("host").agg(F.sort_array(F.collect_set("subtree")).alias("templates"))


def main_text(pages: DataFrame, least_pages: int = LEAST_PAGES, least_share: float = LEAST_SHARE) -> DataFrame:
    """Per page: page_id, url, text, n_chars.

    Blocks are joined by a line end; character references are decoded and white space
    within a block is one space. A null or empty page has the empty text. Pages without a
    host count as one site. Repeated rows each give theirs; other columns do not matter.
    """
    templates = template_subtrees(pages, least_pages, least_share)
    # a host's pages are dealt over SALTS tasks; its short list of templates is there for each
    salt = F.pmod(F.xxhash64("page_id", "url"), F.lit(SALTS)).cast("int")
    sited = pages.select("page_id", "url", "html", F.xxhash64(host_of(F.col("url"))).alias("host"), salt.alias("salt"))
    salted = templates.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    given = sited.join(salted, ["host", "salt"], "left")

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets: dict[int, set[int]] = {}
        for batch in batches:
            texts = []
            for source, templates in zip(batch.column(2), batch.column(3), strict=True):
                page = page_of(source.as_py())
                known = templates.as_py() or []
                name = zlib.crc32(repr(known).encode())
                if name not in sets:
                    sets.clear()
                    sets[name] = set(known)
                dropped = {i for i, h in _subtrees(page) if h in sets[name]} if known else set()
                texts.append("\n".join(blocks(page, dropped)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                ["page_id", "url", "text", "n_chars"])

    return given.select("page_id", "url", "html", "templates").mapInArrow(extract, "page_id long, url string, text string, n_chars long")
