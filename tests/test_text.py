from __future__ import annotations

import html as stdlib_html

import pytest
from pyspark.sql import functions as F

from stewardry.functions import spans, text
from stewardry.functions.html import clean_html, decode_references
from stewardry.operators.sites import joined_site_text, site_text
from stewardry.sources.pages import page_text


@pytest.mark.parametrize("source, expected", [
    ("<p>A</p><p>B</p>", "AB"),
    ("a<!-- <b>x</b> -->b", "ab"),
    ("<SCRIPT>var t='</p>';</SCRIPT>x<style>p{}</style>y", "xy"),
    ("<p title='a>b'>t</p>", "t"),
    ("1 < 2 and 3 > 2", "1 < 2 and 3 > 2"),
    ("<!DOCTYPE html><?php x ?>z", "z"),
    ("&lt;b&gt; &amp;lt; &#38;lt;", "<b> &lt; &lt;"),
    ("&foo; &copy;", "&foo; ©"),
    ("no markup", "no markup"),
])
def test_clean_html(value, source, expected):
    assert value(clean_html("t"), t=source) == expected


@pytest.mark.parametrize("source", [
    "&eacute;&nbsp;&rarr;&#8364;&#x20AC;&#x1F600;", "&amp;&quot;&apos;&lt;", "&amp;amp;", "&Aacute;&zwj;",
])
def test_references_as_the_standard_library(value, source):
    assert value(decode_references("t"), t=source) == stdlib_html.unescape(source)


def test_page_text(value):
    get = page_text("b", "s")
    assert value(get, b="body", s='{"a":"x"}') == "body"
    assert value(get, b="", s='{"a":"x","b":"y"}') == "x y"
    assert value(get, b=None, s='["x","y"]') == "x y"
    assert value(get, b="", s="just text") == "just text"
    assert value(get, b="", s=None) == ""
    assert value(get, b="", s="[]") == ""


def test_sections(value):
    found = value(text.relevant_sections("t"), t="Hello there. Our cookies! Board of Directors? Bye.")
    assert found == ["Our cookies!", "Board of Directors?"]
    assert value(text.relevant_sections("t"), t="Nothing. Here.") == ["Nothing. Here."]


def test_compact_lines(value):
    source = " a  b \r\n\n\tc  d   e \n  \n"
    lines = (line.strip() for line in source.splitlines())
    expected = " ".join(p.strip() for line in lines for p in line.split("  ") if p.strip())
    assert value(text.compact_lines("t"), t=source) == expected


def test_offsets(value):
    source = "xx CEO, ceo\u0001 and cOO."
    found = value(spans.find_all(spans.without_marks(F.col("t")), "(?i)c[eo]o"), t=source)
    assert [(m["start"], m["text"]) for m in found] == [(3, "CEO"), (8, "ceo"), (17, "cOO")]
    assert value(spans.find_all(F.col("t"), "zzz"), t=source.replace("\u0001", " ")) == []
    assert value(spans.find_all(F.col("t"), "a"), t="aaba") [2]["start"] == 3


def test_sites_of_any_size_have_one_shape(spark):
    rows = [(f"https://big.com/{i:03d}", f"<p>page {i}</p>") for i in range(200)]
    rows += [("https://small.com/a", "one"), ("https://small.com/b", "two")]
    pages = spark.createDataFrame(rows, "url string, html string")
    got = [(r["site"], r["text"]) for r in site_text(pages).collect()]
    assert got == [("big.com", f"page {i}") for i in range(200)] + [("small.com", "one"), ("small.com", "two")]
    joined = {r["site"]: r for r in joined_site_text(pages).collect()}
    assert joined["small.com"]["text"] == "one\n\ntwo" and joined["big.com"]["n_pages"] == 200


@pytest.mark.parametrize(("source", "text"), [
    ("<p>a</p><script>var x=1;", "a"), ("<p>a</p><style>p{}</style>b<STYLE>p{", "ab"), ("a<script>b</script>c", "ac"),
    ("a<template>b</template>c", "ac"), ("a<template>b", "ab"),
])
def test_scripts_without_an_end(value, source, text):
    assert value(clean_html("t"), t=source) == text


def test_hostile_texts_do_not_break_the_matcher(value):
    unclosed = "x <b " + "word \"quoted\" 'single' " * 50_000
    assert value(clean_html("t"), t=unclosed) == unclosed
    assert value(clean_html("t"), t="<!-- " + "open " * 50_000).startswith("<!-- open")
    assert value(text.strip("t"), t=" " * 200_000 + "a" + " " * 200_000 + "b\u2003\n") == "a" + " " * 200_000 + "b"
    assert len(value(text.compact_lines("t"), t="a" + " " * 200_001 + "b")) == 3


def test_folded_patterns_find_what_plain_ones_find(spark):
    import random

    from stewardry import vocab

    rng = random.Random(3)
    phrases = vocab.CONTACT_PHRASES + vocab.MANAGEMENT_PHRASES + vocab.ROLE_PHRASES
    pieces = [*phrases, *vocab.EXCLUDED_BY_READER, *vocab.NON_PERSON_WORDS, *vocab.ROLE_PHRASES]
    odd = {"s": "ſ", "i": "İ", "k": "K", " ": "  "}

    def noisy(text):
        chars = [odd[c] if c in odd and rng.random() < 0.1 else c.swapcase() if rng.random() < 0.2 else c for c in text.rstrip("?")]
        if rng.random() < 0.3:
            del chars[rng.randrange(len(chars))]
        return "".join(chars)

    texts = ["".join(noisy(rng.choice(pieces)) + rng.choice(["", "s", " ", "-"]) for _ in range(rng.randrange(1, 4))) for _ in range(3000)]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    first = "".join(sorted({p[0] for p in phrases}))
    plain = rf"(?=[{first}{first.upper()}ſİı])(?iuU:{vocab.phrase_pattern(phrases)})"
    lists = (vocab.EXCLUDED_BY_READER, vocab.NON_PERSON_WORDS, vocab.BOARD_PAGE_WORDS)
    wrong = df.where(
        (F.regexp_replace("t", f"({plain})", "<$1>") != F.regexp_replace("t", f"({vocab.any_case(phrases)})", "<$1>"))
        | F.exists(F.array(*(F.lower("t").rlike("|".join(w)) != F.col("t").rlike(vocab.words_any_case(w)) for w in lists)), lambda x: x))
    assert wrong.count() == 0 and df.where(F.col("t").rlike(plain)).count() > 500
