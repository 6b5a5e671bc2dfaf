"""Near-duplicates of texts and vectors, exact search and page text on small rows."""

from __future__ import annotations

import html
from collections import defaultdict

import numpy as np
import pytest

import corpus_pipeline
from stewardry.llm import extraction, markup, neardup, topk, vectordup
from stewardry.llm.components import components
from stewardry.llm.minhash import SHARED

SCHEMA = "doc_id long, text string, lang string, kept string, component_id int, node string"


def shingles(text):
    lower = "".join(c.lower() if c.isascii() else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        lower = lower.replace(c, " ")
    words = [w for w in lower.split(" ") if w]
    return {tuple(words)} if 0 < len(words) < 3 else {tuple(words[i:i + 3]) for i in range(len(words) - 2)}


def components_of(nodes, linked):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for i, a in enumerate(nodes):
        for b in nodes[i + 1:]:
            if linked(a, b):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {n: find(n) for n in nodes}


def random_edges(seed):
    rng = np.random.default_rng(seed)
    order = rng.permutation(400).tolist()
    return [
        [], [(1, 1), (None, 2), (3, None)], [(i, i + 1) for i in range(150)], [(150 - i, 149 - i) for i in range(150)],
        list(zip(order, order[1:])), [(0, i) for i in range(1, 80)] + [(200, i) for i in range(120, 200)],
        rng.integers(0, 300, (150, 2)).tolist(), rng.integers(0, 300, (420, 2)).tolist() * 2,
    ]


@pytest.mark.parametrize("case", range(8))
def test_components_are_the_smallest_nodes_reached(spark, case):
    edges = random_edges(9)[case]
    got = components(spark.createDataFrame([tuple(e) for e in edges], "a long, b long"))
    real = [(a, b) for a, b in edges if a is not None and b is not None and a != b]
    links = {frozenset(e) for e in real}
    want = components_of(sorted({n for e in real for n in e}), lambda a, b: frozenset((a, b)) in links)
    assert sorted(tuple(r) for r in got.collect()) == sorted(want.items())


def test_vectors_of_any_size_link_by_their_angle(spark):
    rows = [(1, [1e200, 1e200]), (2, [2e200, 2e200]), (3, [1e-200, 1e-200]), (4, [1e300, -1e300]), (5, [-3e-310, 3e-310]), (6, [0.0, 5e-324]),
            (7, [1.0, 0.0, 0.0]), (8, [9.0, 19.0 ** 0.5, 0.0]), (9, [1e308, 0.0, 0.0])]
    out = {r["vec_id"]: r for r in vectordup.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    assert [out[i]["component_id"] for i in (1, 2, 3)] == [1, 1, 1] and [out[i]["n_links"] for i in (1, 2, 3)] == [2, 2, 2]
    assert out[4]["n_links"] == out[5]["n_links"] == 0 and out[6]["component_id"] == 6
    # 0.9 to the last bit, whichever way it is found
    edge = vectordup.cosines(np.array([[1.0, 0.0]]), np.array([[9.0, 19.0 ** 0.5]]))[0] >= vectordup.LEAST
    assert out[7]["component_id"] == 7 == out[9]["component_id"] and (out[8]["component_id"] == 7) == edge
    for a, b in ((rows[6][1], rows[7][1]), (rows[0][1], rows[1][1])):
        x, y = (vectordup.scaled(np.array([v])) for v in (a, b))
        assert vectordup.linked(x, y)[0, 0] == (vectordup.cosines(x, y)[0] >= vectordup.LEAST)


def test_scores_that_would_not_fit_are_an_error(spark):
    rows = spark.createDataFrame([(0, [1.0, 2.0]), (1, [1e9, 0.0])], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="would not fit"):
        topk.top_k(rows).collect()


def corpus(seed):
    """Families of near copies in chains, exact copies, a shared passage, short texts."""
    rng = np.random.default_rng(seed)
    word = lambda: f"w{rng.integers(0, 5000)}"
    out = []
    passage = [word() for _ in range(60)]
    for family in range(6):
        text = [word() for _ in range(80)]
        for _ in range(14):
            if rng.random() < 0.7:
                text = list(text)
                text[rng.integers(0, len(text))] = word()
            out.append(" ".join(text))
        out += [" ".join(text).upper(), "\n".join(text)]
    out += [" ".join([*passage, *(word() for _ in range(15))]) for _ in range(20)]
    out += ["", None, " \t ", "one", "One", "one two", "one  two", "two one", "one two three", "one two three four"]
    order = rng.permutation(len(out))
    return [(int(i) * 3, out[k]) for i, k in enumerate(order)]


@pytest.mark.parametrize("block", [5, 512])
def test_near_duplicates_against_all_pairs(spark, block):
    rows = corpus(1)
    docs = spark.createDataFrame([(i, t, "en", "x", 1, "n") for i, t in rows], SCHEMA)
    sets = {i: shingles(t) for i, t in rows}

    def linked(a, b):
        common = len(sets[a] & sets[b])
        return common > 0 and 100 * common >= SHARED * len(sets[a] | sets[b])

    want = components_of([i for i, _ in rows], linked)
    got = {r["doc_id"]: r for r in neardup.near_duplicates(docs, block).collect()}
    assert {i: (len(sets[i]), want[i], want[i] == i) for i in want} == {
        i: (r["n_shingles"], r["component_id"], r["kept"]) for i, r in got.items()}
    if block == 512:
        kept = neardup.first_of_each(docs)
        assert kept.columns == docs.columns
        assert sorted(r["doc_id"] for r in kept.collect()) == sorted(set(want.values()))


def test_near_duplicates_of_odd_rows(spark):
    rows = [(None, "a b c d"), (None, None), (5, "a b c d"), (5, "a b c d"), (9, "A B  c\nd"), (7, "q " * 50_000), (8, "q q q q")]
    docs = spark.createDataFrame([(i, t, "en", "x", 1, "n") for i, t in rows], SCHEMA)
    got = sorted(((r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in neardup.near_duplicates(docs).collect()), key=repr)
    assert got == sorted([
        (None, 2, 5, False), (None, 0, None, True), (5, 2, 5, True), (5, 2, 5, True), (9, 2, 5, False), (7, 1, 7, True), (8, 1, 7, False),
    ], key=repr)
    assert neardup.near_duplicates(docs.limit(0)).collect() == []
    assert neardup.first_of_each(docs.limit(0)).collect() == []


def vectors(seed, n=600, dim=24):
    """Tight groups in chains, copies, scaled copies, noise and unfit vectors."""
    rng = np.random.default_rng(seed)
    out = [rng.normal(size=dim) for _ in range(n)]
    for _ in range(12):
        x = rng.normal(size=dim)
        for _ in range(15):
            x = x + rng.normal(size=dim) * 0.22
            out.append(x)
        out += [x, x, x * 7.0]
    rows = [(int(i), [float(np.float32(v)) for v in x]) for i, x in enumerate(out)]
    rows += [(9001, None), (9050, [0.0] * dim), (9002, [float("nan")] * dim), (9003, [1.0] * (dim - 1)), (9004, [None] + [1.0] * (dim - 1)), (9100, [])]
    return rows


VECTORS = "vec_id long, embedding array<float>, label int, kept string, node int"


@pytest.mark.parametrize("block", [7, 512])
def test_near_vectors_against_all_pairs(spark, block):
    rows = vectors(2)
    frame = spark.createDataFrame([(i, v, 0, "x", 1) for i, v in rows], VECTORS)
    fit = {i: np.array(v) for i, v in rows if v and None not in v and np.isfinite(v).all() and np.any(v)}
    links = defaultdict(set)
    for a in fit:
        for b in fit:
            if a < b and len(fit[a]) == len(fit[b]) and fit[a] @ fit[b] / np.sqrt((fit[a] @ fit[a]) * (fit[b] @ fit[b])) >= 0.9:
                links[a].add(b), links[b].add(a)
    want = components_of(sorted(i for i, _ in rows), lambda a, b: b in links[a])
    got = {r["vec_id"]: r for r in vectordup.near_vectors(frame, block).collect()}
    assert len(got) == len(rows)
    found = sum(r["n_links"] for r in got.values())
    assert 0.99 * sum(map(len, links.values())) <= found <= sum(map(len, links.values()))
    assert np.mean([got[i]["component_id"] == want[i] for i in want]) >= 0.99
    assert all(r["kept"] == (i == r["component_id"]) for i, r in got.items())
    assert all(got[i]["n_links"] == 0 for i in got if i not in fit)


def test_near_vectors_of_nothing(spark):
    assert vectordup.near_vectors(spark.createDataFrame([], VECTORS)).collect() == []


@pytest.mark.parametrize("blocks", [(3, 50), (2048, 8192)])
def test_top_k_against_all_pairs(spark, blocks):
    rows = vectors(4, n=300)
    rows += [(10_000 + i, rows[50][1]) for i in range(9)]  # ties
    rows += [(50, rows[50][1])]  # a repeated row
    frame = spark.createDataFrame([(i, v, 0, "x", 1) for i, v in rows], VECTORS)
    whole = [(i, np.floor(256 * np.array(v)).astype(int)) for i, v in rows if v and None not in v and np.isfinite(v).all()]
    want = []
    for q in sorted({i for i, _ in whole if i % 50 == 0}):
        x = next(v for i, v in whole if i == q)
        best = sorted((-int(x @ v), i) for i, v in whole if i != q and len(v) == len(x))[:5]
        want += [(q, r + 1, i, -s) for r, (s, i) in enumerate(best)]
    got = topk.top_k(frame, query_block=blocks[0], candidate_block=blocks[1]).collect()
    assert sorted(map(tuple, got)) == want
    assert topk.top_k(frame.limit(0)).collect() == []


PAGES = "page_id long, url string, html string, text string, n_chars string, host int"


def text_of(source):
    return "\n".join(markup.blocks(markup.parsed(source), set()))


@pytest.mark.parametrize(("source", "want"), [
    ("<p>a &amp; b<p>c\n  d&nbsp;e<br>f", "a & b\nc d e f"),
    ("<nav><p>x</p></nav><article><h1>T</h1><p>a</p></article><footer>z</footer>", "T\na"),
    ("<article><p>a <b>bold<p>b</article><p>after", "a bold\nb"),
    ("<p>a</p><script>if (a</p>b) x</script><style>p{}</style><p>b</p><script>open", "a\nb"),
    ("<p>a<!-- <p>no</p> --> b</p><!-- open <p>c", "a b"),
    ('<p title="a > b">x</p><p class=\'ad\'>y</p><div id=comments-list><p>z</div><p>w', "x\nw"),
    ("<ul><li>one<li>two</ul>tail", "one\ntwo\ntail"),
    ("<table><tr><td>a<td>b<tr><td>c</table>", "a\nb\nc"),
    ("<div class='reader-comments'>no</div><main><div class=cookie>no</div>yes</main>", "yes"),
    ("3 < 5 & 6 > 2 <b>x", "3 < 5 & 6 > 2 x"),
    ("<form><p>no</form><p>a</b></i></div>b", "a\nb"),
    ("", ""), ("plain", "plain"), ("<p>" * 3000 + "deep", "deep"), ("<div>" * 2000 + "x", "x"), ("<" * 50, "<" * 50),
])
def test_blocks(source, want):
    assert text_of(source) == want


def test_hostile_markup_takes_linear_time():
    import time

    start = time.perf_counter()
    for source in ('<a "' * 40_000, "<a b='" * 40_000, "<!--" * 40_000, "<p " * 60_000, "&#" * 90_000, "<b>" * 30_000):
        text_of(source)
    assert time.perf_counter() - start < 20


def test_site_templates_go_and_articles_stay(spark):
    box = "<div><span>Read   more of us</span></div>"
    rows = [(i, f"http://Site.example:80/{i}", f"{box}<div><p>own text {i}</p></div>", "x", "y", 1) for i in range(6)]
    rows += [(10 + i, f"https://b.example/{i}", f"<article><p>the same words</p></article>{box}", "x", "y", 1) for i in range(6)]
    rows += [(20, "https://small.example/", box + "<p>a", "x", "y", 1), (21, None, box, "x", "y", 1), (22, "http://x", None, "x", "y", 1),
             (None, "http://x", "", "x", "y", 1), (20, "https://small.example/", box + "<p>a", "x", "y", 1)]
    out = extraction.main_text(spark.createDataFrame(rows, PAGES)).collect()
    texts = defaultdict(list)
    for r in out:
        texts[r["page_id"]].append(r["text"])
        assert r["n_chars"] == len(r["text"])
    assert all(texts[i] == [f"own text {i}"] for i in range(6))
    assert all(texts[10 + i] == ["the same words"] for i in range(6))
    assert texts[20] == ["Read more of us\na"] * 2 and texts[21] == ["Read more of us"] and texts[22] == [""] and texts[None] == [""]
    assert extraction.main_text(spark.createDataFrame([], PAGES)).collect() == []


def test_pages_against_their_articles(spark):
    """Every page of the smallest table: the paragraphs of its article, read by a plain rule."""
    import re

    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    got = {r["page_id"]: r["text"] for r in extraction.main_text(pages).collect()}
    for r in pages.collect():
        inner = re.search(r"<article>(.*?)(?:</article>|<footer)", r["html"], re.S)[1]
        parts = (" ".join(html.unescape(re.sub(r"<[^>]*>", "", p)).split()) for p in re.split(r"</?(?:p|h1)>", inner))
        assert got[r["page_id"]] == "\n".join(p for p in parts if p)


def runs_of(text, size):
    words = text.lower().split()
    return {tuple(words)} if 0 < len(words) < size else {tuple(words[i:i + size]) for i in range(len(words) - size + 1)}


def brute_components(rows, size, shared):
    sets = {i: runs_of(t, size) for i, t in rows}
    return components_of(
        [i for i, _ in rows],
        lambda a, b: bool(sets[a] & sets[b]) and 100 * len(sets[a] & sets[b]) >= shared * len(sets[a] | sets[b]))


def test_the_stage_takes_five_words_and_four_fifths(spark):
    rng = np.random.default_rng(8)
    word = lambda: f"w{rng.integers(0, 10**9)}"
    out = []
    for _ in range(8):
        base = [word() for _ in range(100)]
        out += [" ".join(base), " ".join([*base, *(word() for _ in range(20))])]  # linked on five words at 0.80 alone
        edited = [word() for _ in range(100)]
        out.append(" ".join(edited))
        edited = list(edited)
        for at in (50, 98):
            edited[at] = word()
        out.append(" ".join(edited))  # three words: 93 / 103
        scattered = [word() for _ in range(160)]
        out.append(" ".join(scattered))
        scattered = list(scattered)
        for at in (30, 70, 110, 140):
            scattered[at] = word()
        out.append(" ".join(scattered))  # three words: 146 / 170 >= 0.85; five: 136 / 176 < 0.80
    out += ["a b c d", "A b  c d", "a b c", "b a c d", "a", "a b c d e", "a b c d e f"]
    rows = list(enumerate(out))
    docs = spark.createDataFrame([(i, t, "en", "x", 1, "n") for i, t in rows], SCHEMA)
    for size, shared in ((5, 80), (3, 85)):
        want = brute_components(rows, size, shared)
        got = {r["doc_id"]: r["component_id"] for r in neardup.near_duplicates(docs, shingle=size, shared=shared).collect()}
        assert got == want
    stage = brute_components(rows, 5, 80)
    assert stage != brute_components(rows, 3, 85) and stage[1] == 0 and stage[5] == 5
    assert {r["doc_id"] for r in corpus_pipeline.distinct(spark, docs, "").collect()} == set(stage.values())


@pytest.mark.parametrize(("source", "want"), [
    ("<div class='content no-sidebar'><p>out</p><article><p>the whole article</article></div>", "the whole article"),
    ("<div class='has-sidebar'><article>text</article></div>", "text"),
    ("<div class='with-menu elementor-widget-container'><p>text</div>", "text"),
    ("<div class='widget'><article><p>the whole article</article></div>", "the whole article"),
    ("<article><div class='entry-header'><h1>T</h1></div><div class=header><p>by</div><p>a</article>", "T\nby\na"),
    ("<form><div class=menu><a>x</a></div><p>the text of an old page</form>", "the text of an old page"),
    ("<div class='share site-footer'>no</div><p>text of a page</p><p class=related_links>no", "text of a page"),
])
def test_names_do_not_take_the_article(source, want):
    assert text_of(source) == want


@pytest.mark.parametrize(("source", "want"), [
    # one long text in a div, four teasers: the text stays
    ("<div><p>" + "the main text of this page " * 9 + "</p></div>" + "".join(f"<article><p>teaser {i} of another page, with some words to it</p></article>" for i in range(4)),
     " ".join("the main text of this page".split() * 9) + "\n" + "\n".join(f"teaser {i} of another page, with some words to it" for i in range(4))),
    ("<article><p>" + "the article of this page " * 9 + "</p></article><article><p>a teaser</p></article>", " ".join("the article of this page".split() * 9)),
    *((f"<article><p>{'words of the article ' * 20}</p><div class='{name}'><p>box</p></div></article>", " ".join("words of the article".split() * 20))
      for name in ("ads-wrapper", "advert-slot", "ad-container", "newsletter-signup", "cookie-banner", "comment-thread", "main_ad_slot")),
    ("<article><div class='ad-free comment-policy'><p>" + "words of the article " * 20 + "</p></div></article>", " ".join("words of the article".split() * 20)),
    ("<p>Energy is <math><mi>E</mi><mo>=</mo><mi>m</mi></math> and x</p>", "Energy is E=m and x"),
    ("<header><h1>Site</h1></header><section><header><h1>Headline</h1></header><p>text of it</p></section>", "Headline\ntext of it"),
])
def test_articles_are_not_lost_to_teasers_and_boxes_go(source, want):
    assert text_of(source) == want


@pytest.mark.parametrize("n", [5, 60, 1200])
def test_recurring_boxes_without_names_go(spark, n):
    """Articles of the given kind among boxes that no name or tag tells, on hosts of any size."""
    def page(i):
        own = f"<article><h1>Title {i}</h1><p>text number {i} of the page</p><p>and its end {i}</p></article>"
        banner = f"<div><p>banner {i % 3} of three</p></div>"
        return f"<div><div>home</div><div>about us</div></div><div>read this notice</div>{banner}<div>{own}</div><div><b>sign up</b> here</div><div>the end of a site</div>"

    rows = [(i, f"http://h.example/{i}", page(i), "", "", 0) for i in range(n)]
    out = extraction.main_text(spark.createDataFrame(rows, PAGES)).collect()
    assert {r["page_id"]: r["text"] for r in out} == {i: f"Title {i}\ntext number {i} of the page\nand its end {i}" for i in range(n)}
    # without a declared article the counts alone tell; a banner of few pages stays
    bare = [(i, u, h.replace("article>", "div>"), *rest) for i, u, h, *rest in rows]
    texts = {r["page_id"]: r["text"] for r in extraction.main_text(spark.createDataFrame(bare, PAGES)).collect()}
    if n > 5:
        assert texts == {i: f"Title {i}\ntext number {i} of the page\nand its end {i}" for i in range(n)}
    else:
        assert all(t.endswith(f"Title {i}\ntext number {i} of the page\nand its end {i}") and "notice" not in t for i, t in texts.items())


def test_a_list_in_the_article_stays_on_large_hosts(spark):
    """One page in six has the same list inside of its article: on hosts of any size it stays."""
    for n in (60, 1500):
        rows = [(i, "http://h.example/", f"<article><p>the text {i} of a page</p>" + ("<ul><li>a list that is there again</ul>" if i % 6 == 0 else "") + "</article>", "", "", 0) for i in range(n)]
        out = extraction.main_text(spark.createDataFrame(rows, PAGES)).collect()
        assert all(r["text"].endswith("there again") == (r["page_id"] % 6 == 0) for r in out)


def test_subtree_counts_equal_brute_force(spark):
    """Recurring subtrees per host, with the different texts around each counted by hand."""
    rng = np.random.default_rng(2)
    parts = [f"<div><i>part {k}</i></div>" for k in range(8)]
    sources = ["".join(parts[k] for k in rng.choice(8, 3, replace=False)) + f"<div>own {rng.integers(0, 9)}</div>" for _ in range(40)]
    hosts = [("a.example", "b.example")[i % 2] for i in range(40)]
    rows = [(i, f"http://{hosts[i]}/", sources[i], "", "", 0) for i in range(40)]
    found = extraction.template_subtrees(spark.createDataFrame(rows, PAGES)).collect()
    want = {}
    for host in set(hosts):
        around, pages = defaultdict(set), set()
        for h, source in zip(hosts, sources, strict=True):
            if h == host:
                page = extraction.page_of(source)
                words = lambda t: sorted(" ".join(x[2].split()) for x in t if x[2].strip())
                pages.add(tuple(words(page.texts)))
                for e, name in extraction._subtrees(page):
                    below = {i for i in range(len(page.elements)) if any(a == e for a in ancestors(page, i))}
                    around[name].add(tuple(words([t for t in page.texts if t[0] not in below])))
        want[host] = {s for s, rest in around.items() if len(rest) >= 4 and len(rest) >= 0.2 * len(pages)}
    assert sorted(sorted(r["templates"]) for r in found) == sorted(sorted(v) for v in want.values() if v)


def ancestors(page, i):
    while i >= 0:
        yield i
        i = page.elements[i].parent


def test_copies_of_a_page_are_one_and_large_hosts_have_sections(spark, monkeypatch):
    body = "<div><p>the body of a page that is stored often</p></div>"
    rows = [(i, f"http://a.example/?from={i}", f"<a href='?{i}'></a>{body}", "", "", 0) for i in range(5)]
    rows += [(10 + i, f"http://a.example/{i}", f"<div><p>another page {i}</p></div>", "", "", 0) for i in range(15)]
    menu = "<div><b>menu of a section</b></div>"
    rows += [(100 + i, f"http://b.example/{i}", (menu if i < 12 else "") + f"<div><p>page {i} of many</p></div>", "", "", 0) for i in range(100)]
    monkeypatch.setattr(extraction, "MANY_PAGES", 10)
    got = {r["page_id"]: r["text"] for r in extraction.main_text(spark.createDataFrame(rows, PAGES)).collect()}
    assert all(got[i] == "the body of a page that is stored often" for i in range(5))
    assert all(got[100 + i] == f"page {i} of many" for i in range(100))


def test_boxes_in_main_go_and_teasers_do_not_hide_the_text(spark):
    box = "<div class=x17><p>Sign up for our letter</p></div>"
    rows = [(i, f"http://a.example/{i}", f"<main><h1>Title {i}</h1><p>the text of page {i}</p>{box}<p>its end {i}</p></main>", "", "", 0) for i in range(6)]
    # a passage and a whole article that recur stay
    rows += [(10 + i, f"http://b.example/{i}", f"<article><p>The same passage</p><p>and words {i}</p></article>", "", "", 0) for i in range(6)]
    rows += [(20 + i, f"http://c.example/{i}", f"<p>{i}</p><article><p>one article on all pages</p></article>", "", "", 0) for i in range(6)]
    text = "<div><p>the long main text of this page, which no tag declares, number {}</p></div>"
    rows += [(30 + i, f"http://d.example/{i}", f"{text.format(i)}<article><p>teaser {i}</p></article>", "", "", 0) for i in range(6)]
    # a teaser that recurs is template
    rows += [(40 + i, f"http://e.example/{i}", f"{text.format(i)}<article><p>one teaser</p></article>", "", "", 0) for i in range(6)]
    got = {r["page_id"]: r["text"] for r in extraction.main_text(spark.createDataFrame(rows, PAGES)).collect()}
    for i in range(6):
        own = f"the long main text of this page, which no tag declares, number {i}"
        assert got[i] == f"Title {i}\nthe text of page {i}\nits end {i}"
        assert got[10 + i] == f"The same passage\nand words {i}"
        assert got[20 + i] == "one article on all pages"
        assert got[30 + i] == f"{own}\nteaser {i}"
        assert got[40 + i] == own


def test_one_row_of_each_component(spark):
    long = "one two three four five six seven eight nine ten"
    rows = [(1, long), (1, long), (2, long), (5, "some other text of an id used twice"), (5, long), (None, long.upper()),
            (None, "no id but six words here"), (None, "no id but six words here"), (None, "without any id and of words unlike"),
            (9, "without any id and of words unlike"), (7, "a text that stays"), (8, ""), (8, None)]
    docs = spark.createDataFrame([(i, t, "en", "x", 1, "n") for i, t in rows], SCHEMA)
    kept = neardup.first_of_each(docs, shingle=5, shared=80)
    assert kept.columns == docs.columns
    got = sorted(((r["doc_id"], (r["text"] or "").lower()) for r in kept.collect()), key=repr)
    assert [g for g in got if g[0] != 8] == sorted([
        (1, long), (5, "some other text of an id used twice"), (None, "no id but six words here"),
        (9, "without any id and of words unlike"), (7, "a text that stays")], key=repr)
