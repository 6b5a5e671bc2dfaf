"""A page's elements and text blocks, from its HTML in one pass.

A small helper for the extraction operator: it keeps open elements on a stack, closes what
HTML closes by itself (paragraphs, list items, rows), and reads scripts and the like as
raw text. Broken markup is read on as far as it goes.
"""

from __future__ import annotations

import html
import re
from collections import Counter, defaultdict
from dataclasses import dataclass, field

_TAG = re.compile(r"""<(/?)([A-Za-z][^\s/>]*)((?>[^>"']+|"[^"]*"|'[^']*')*+)>|<(/?)([A-Za-z][^\s/>]*)([^>]*)>|<!--(?:.*?)--!?>|<!--|<[!?/][^>]*>""", re.S)
_ATTRIBUTE = re.compile(r"""(?:^|\s)(class|id|role|hidden|aria-hidden)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?(?=\s|/|$)""", re.I)

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Their content is text up to their own end tag.
RAW = frozenset("script style noscript template textarea title iframe object svg".split())
#: Tags that begin and end a block of text.
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html li main menu nav ol option p pre search section select summary table tbody td "
    "tfoot th thead title tr ul".split())
#: What an opening tag closes if it is the innermost of its kind, up to the given limits.
_CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
#: What never belongs to the main text.
APART = frozenset(
    "nav aside footer form script style noscript template iframe object svg head button select option textarea input "
    "dialog menu search canvas audio video title annotation annotation-xml".split())
_APART_ROLES = frozenset("navigation banner contentinfo complementary search menu menubar dialog alert form".split())
#: Classes and ids, as a whole, that name what is not the article.
_APART_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising adsense adslot sponsor sponsored promo promotion banner nav navbar navigation "
    "menu menubar breadcrumb breadcrumbs sidebar sidebars footer header masthead topbar comment comments commentlist disqus "
    "cookie cookies consent gdpr notice notices newsletter subscribe subscription signup login popup modal overlay share sharing "
    "social related recommended recommendations widget widgets toolbar pagination pager skip copyright disclaimer".split())
_APART_TOKENS = _APART_WORDS | {f"{w}-{s}" for w in _APART_WORDS for s in ("list", "area", "section", "box", "block", "links")} | {
    f"{s}-{w}" for w in _APART_WORDS for s in ("reader", "user", "site", "page", "global")}
#: Words that tell the same as a part of a class or id, of a block with little text.
_HINTS = frozenset(
    "ad ads advert adverts advertisement sponsor sponsored promo banner newsletter signup subscribe subscription cookie cookies "
    "consent gdpr comment comments popup modal".split())
_HINTED_TAGS = frozenset("div section ul ol p table dl figure li h2 h3 h4 h5 h6".split())
#: The most text that such a part of a name takes along: characters, and the share of the page.
LITTLE, LITTLE_SHARE = 400, 0.2
#: Tags that stay the text's if they hold the article or most of the page's text.
_AROUND = frozenset({"form", "dialog"})
#: Beside a declared article, a text is taken against its name if it is longer than this.
LONG = 200
#: Elements whose content is the article's, where a page has them.
ARTICLE = frozenset({"article", "main"})


@dataclass(slots=True)
class Element:
    tag: str
    parent: int
    start: int
    apart: bool
    inside: bool
    end: int = -1
    #: set apart by its name alone, if it does not hold the article or most of the text
    named: bool = False
    #: a part of its name says so, which counts for a block with little text
    hinted: bool = False


@dataclass(slots=True)
class Page:
    source: str
    elements: list[Element] = field(default_factory=list)
    #: (element, text) in page order; a block ends where the block element around it changes
    texts: list[tuple[int, int, str]] = field(default_factory=list)


def _set_apart(tag: str, attributes: str, inside: bool) -> tuple[bool, bool, bool]:
    """Whether an element is set apart in any case, by its name, by a part of its name."""
    named, hinted = tag in _AROUND, False
    if tag in APART and not named:
        return True, False, False
    if not attributes or tag in ("html", "body", "article", "main"):
        return False, named, False
    for m in _ATTRIBUTE.finditer(attributes):
        name, value = m[1].lower(), (m[2] or m[3] or m[4] or "").lower()
        if name == "hidden" or (name == "aria-hidden" and value == "true"):
            return True, False, False
        if name == "role" and value in _APART_ROLES:
            named = True
        if name in ("class", "id"):
            tokens = _APART_TOKENS.intersection(value.replace("_", "-").split())
            # a header in an article belongs to it
            named = named or bool(tokens - {"header"} if inside else tokens)
            hinted = hinted or tag in _HINTED_TAGS and not _HINTS.isdisjoint(re.split(r"[\s_-]+", value))
    return False, named, hinted


def text_sizes(page: Page) -> tuple[list[int], int]:
    """Characters of text in each element and in the page, outside of what is apart."""
    elements, total = page.elements, 0
    size = [0] * len(elements)
    for at, _, text in page.texts:
        if at < 0 or not elements[at].apart:
            n = len(text.strip())
            total += n
            if at >= 0:
                size[at] += n
    for i in range(len(elements) - 1, -1, -1):
        if elements[i].parent >= 0:
            size[elements[i].parent] += size[i]
    return size, total


def _settle(page: Page) -> None:
    """Sets apart what names alone tell, but for what holds the article or most of the text."""
    elements = page.elements
    if not any(e.named or e.hinted for e in elements):
        return
    size, total = text_sizes(page)
    # the article: the largest declared one, if it has a third of the text
    most = max((i for i, e in enumerate(elements) if e.tag in ARTICLE and not e.apart), key=size.__getitem__, default=-1)
    holding: set[int] = set()
    # most of the text: half; beside a declared article three quarters, and LONG characters
    much = max(0.75 * total, LONG) if most >= 0 and size[most] else 0.5 * total
    if most >= 0 and size[most] and 3 * size[most] >= total:
        while most >= 0:
            holding.add(most)
            most = elements[most].parent
    little = min(LITTLE, LITTLE_SHARE * total)
    for i, e in enumerate(elements):
        above = e.parent >= 0 and elements[e.parent].apart
        told = (e.named and size[i] <= much) or (e.hinted and size[i] <= little)
        e.apart = e.apart or above or (told and i not in holding)


def parsed(source: str) -> Page:
    """The page's elements, in order of their start, and its texts by element and block."""
    page = Page(source)
    elements, texts = page.elements, page.texts
    stack: list[int] = []
    #: depths at which a tag, or any block, is open, so that no search walks the stack
    depths: dict[str, list[int]] = defaultdict(list)
    block_depths: list[int] = []
    block = at = 0
    size = len(source)
    last_close = source.rfind(">")

    def close(depth: int, where: int) -> None:
        nonlocal block
        while len(stack) > depth:
            e = elements[stack.pop()]
            e.end = where
            depths[e.tag].pop()
            if e.tag in BLOCK:
                block += 1
                block_depths.pop()

    def innermost(tags: frozenset[str] | set[str]) -> int:
        return max((depths[t][-1] for t in tags if depths[t]), default=-1)

    def add(text: str) -> None:
        if text and not text.isspace():
            texts.append((stack[-1] if stack else -1, block, html.unescape(text) if "&" in text else text))
        elif text:
            texts.append((stack[-1] if stack else -1, block, " "))

    while at < size:
        m = _TAG.search(source, at) if at <= last_close else None
        if m is None:
            add(source[at:])
            break
        add(source[at:m.start()])
        at = m.end()
        name = m[2] or m[5]
        if name is None:
            if m[0] == "<!--":  # a comment without an end
                at = size
            continue
        tag, closing = name.lower(), (m[1] or m[4]) == "/"
        if closing:
            depth = depths[tag][-1] if depths[tag] else -1
            # an inline end tag does not close the blocks around it
            if depth >= 0 and (tag in BLOCK or not block_depths or block_depths[-1] < depth):
                close(depth, at)
            block += tag in BLOCK
            continue
        attributes = m[3] if m[2] else m[6] or ""
        if tag in _CLOSES:
            what, limits = _CLOSES[tag]
            depth = innermost(what)
            if depth > innermost(limits):
                close(depth, m.start())
        elif tag in BLOCK and block_depths and elements[stack[block_depths[-1]]].tag == "p":
            close(block_depths[-1], m.start())
        if tag in BLOCK:
            block += 1
        if tag in VOID:
            if tag == "br" or tag == "wbr":
                texts.append((stack[-1] if stack else -1, block, " " if tag == "br" else ""))
            continue
        above = elements[stack[-1]] if stack else None
        # a page's own header is no part of the text, an article's is
        inside = bool(above and above.inside) or tag in ARTICLE
        apart, named, hinted = _set_apart(tag, attributes, inside)
        apart = apart or bool(above and above.apart)
        # the header of a section has its headline
        if tag == "header" and not inside and not depths["section"]:
            apart = True
        if attributes.endswith("/") and tag in RAW:
            continue
        elements.append(Element(tag, stack[-1] if stack else -1, m.start(), apart, inside, named=named, hinted=hinted))
        depths[tag].append(len(stack))
        if tag in BLOCK:
            block_depths.append(len(stack))
        stack.append(len(elements) - 1)
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>", re.I).search(source, at)
            at = end.end() if end else size
            close(len(stack) - 1, at)
    close(0, size)
    _settle(page)
    return page


def blocks(page: Page, dropped: set[int]) -> list[str]:
    """The text blocks outside of what is apart or dropped; inside the article if there is one.

    White space inside a block becomes one space. What a page declares as its article counts
    alone if it holds a third of the text that is left, with other articles at least half as
    long; shorter ones beside it are teasers. If no single article holds as much, all counts.
    """
    gone: list[bool] = []
    #: the outermost article that an element is in
    article: list[int] = []
    for i, e in enumerate(page.elements):
        gone.append(e.apart or i in dropped or (e.parent >= 0 and gone[e.parent]))
        above = article[e.parent] if e.parent >= 0 else -1
        article.append(above if above >= 0 else i if e.tag in ARTICLE else -1)
    kept = [t for t in page.texts if t[0] < 0 or not gone[t[0]]]
    lengths: Counter[int] = Counter()
    for at, _, text in kept:
        lengths[article[at] if at >= 0 else -1] += len(text.strip())
    largest = max((n for a, n in lengths.items() if a >= 0), default=0)
    if largest and 3 * largest >= sum(lengths.values()):
        kept = [t for t in kept if t[0] >= 0 and article[t[0]] >= 0 and 2 * lengths[article[t[0]]] >= largest]
    out: list[str] = []
    held: list[str] = []
    for i, (_, block, text) in enumerate(kept):
        held.append(text)
        if i + 1 == len(kept) or kept[i + 1][1] != block:
            joined = " ".join("".join(held).split())
            if joined:
                out.append(joined)
            held.clear()
    return out
