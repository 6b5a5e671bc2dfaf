from __future__ import annotations

from urllib.parse import urljoin, urlparse

import pytest

from stewardry import vocab
from stewardry.functions import urls
from stewardry.operators.links import management_links


@pytest.mark.parametrize("url, name, expected", [
    ("https://www.company1.com", "Company One", "https://www.company1.com"),
    ("www.company2.com", "Company Two", "https://www.company2.com"),
    ("", "Company Three", "http://placeholder/company-three"),
    (None, "Company Three", "http://placeholder/company-three"),
    (" \t ", "A  B", "http://placeholder/a--b"),
    ("http://company4.com", "Company Four", "http://company4.com"),
    ("https://test3.com/", "Test Company 3", "https://test3.com/"),
    ("HTTP://x.com", "X", "https://HTTP://x.com"),
])
def test_website(value, url, name, expected):
    assert value(urls.website_or_placeholder("url", "name"), url=url, name=name) == expected


@pytest.mark.parametrize("url, expected", [
    ("https://www.A.com/x:1", "www.a.com"),
    ("a.com:80/b", "a.com"),
    ("https://user@a.com?q", "user@a.com?q"),
    ("http://a.com/r?u=http://b.com", "a.com"),
    ("", ""),
    (None, ""),
])
def test_extract_domain(value, url, expected):
    assert value(urls.extract_domain("url"), url=url) == expected


@pytest.mark.parametrize("url", [
    "https://www.a.com/x", "//b.com/x", "c.com/x", "http://u@www.d.com:81?x#y", "mailto:x@y", "http://a www.b/", "",
])
def test_netloc_domain(value, url):
    assert value(urls.netloc_domain("url"), url=url) == urlparse(url).netloc.replace("www.", "")


def test_netloc_domain_of_null(value):
    assert value(urls.netloc_domain("url"), url=None) is None


@pytest.mark.parametrize("name, expected", [
    ("https%3A%2F%2Fa.com%2Fb.json", "https://a.com/b"),
    ("a+b%2Bc.json", "a+b+c"),
    ("100%25.json", "100%"),
    ("bad%zz%20x.json", "bad%zz x"),
    ("caf%C3%A9.json", "café"),
])
def test_page_url(value, name, expected):
    assert value(urls.page_url("name"), name=name) == expected


def test_file_names(value):
    name = "https%3A%2F%2Fa.com%2Fb%3Fx=1&y.json"
    assert value(urls.short_filename("n"), n=name) == "b_x_1_y.json"
    assert value(urls.flat_filename("n"), n=name) == "a.com_b%3Fx=1&y.json"
    assert value(urls.company_file_key("n"), n="A/B Corp") == "a_b_corp"


def test_word_lists(value):
    assert value(urls.is_excluded("u"), u="https://xpressway.com/")
    assert not value(urls.is_excluded("u", vocab.EXCLUDED_BY_MATCHER), u="https://xpressway.com/")
    assert value(urls.is_excluded("u", vocab.EXCLUDED_BY_MATCHER), u="https://x.com/NEWS/")
    assert value(urls.is_board_page("u"), u="https://x.com/directory")
    assert not value(urls.is_executive_page("u"), u="https://x.com/people")


@pytest.mark.parametrize("base", ["https://a.com", "https://a.com/", "https://a.com/x/y/z.html?q=1#f", "http://a.com/x/"])
@pytest.mark.parametrize("href", [
    "/About", "team", "../t", "../../../t?x=/../y", "#g", "//o.com/z", "https://b.com/../c", "./k/", "..", ".",
    "mailto:x@y", "", "a/./b/../c", "?p=2",
])
def test_resolve_link(value, base, href):
    expected = urljoin(base, href)
    assert value(urls.resolve_link("b", "h"), b=base, h=href) == expected


def test_management_links(spark):
    html = (
        '<a href="/about">x</a><A class=y HREF=/x><b>Our</b> TEAM</A><a name="board">no address</a>'
        "<a href='https://other.com/team'>t</a><a href=\"/about\">again</a><a title='>' href='/board?a=1&amp;b=2'>z</a>"
        '<a href="/plain">plain</a><!-- <a href="/team/hidden">h</a> -->'
    )
    pages = spark.createDataFrame([("https://a.com", html), ("https://b.com", "none")], "url string, html string")
    found = {r["link"] for r in management_links(pages).collect()}
    assert found == {"https://a.com/about", "https://a.com/x", "https://a.com/board?a=1&b=2"}
