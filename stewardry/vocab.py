"""Word lists, role names and patterns the results depend on.

Everything below is a fixed value, but for the blocks whose comment calls them our own.
Order matters only where a comment says so.
"""

from __future__ import annotations

import re
from collections.abc import Iterable

# Role phrases, in tie-break order: at equal distance the earlier phrase wins.
ROLE_PHRASES = (
    "ceo",
    "chief executive officer",
    "cfo",
    "chief financial officer",
    "coo",
    "chief operating officer",
    "president",
    "director",
    "chairman",
    "chairperson",
    "vice president",
    "treasurer",
    "secretary",
    "investor relations",
    "corporate secretary",
    "corporate communications",
    "corporate development",
    "corporate affairs",
    "corporate relations",
    "corporate contact",
    "contact person",
    "contact representative",
)

CONTACT_PHRASES = (
    "corporate office",
    "investor relations contact",
    "contact information",
    "contact us",
    "corporate contacts?",
)

MANAGEMENT_PHRASES = (
    "board of directors",
    "executive team",
    "management team",
    "leadership team",
    "senior management",
    "officers",
    "directors",
)

# Pattern of the whole (trimmed) role -> standard role; the first hit wins.
ROLE_STANDARDS = (
    ("[Cc][Ee][Oo]", "Chief Executive Officer"),
    ("[Cc][Ff][Oo]", "Chief Financial Officer"),
    ("[Cc][Oo][Oo]", "Chief Operating Officer"),
    ("[Vv][Pp]", "Vice President"),
    ("[Ii][Rr]", "Investor Relations"),
    ("[Dd]irector", "Director"),
    ("[Pp]resident", "President"),
    ("[Cc]hairman", "Chairman"),
    ("[Cc]hairperson", "Chairman"),
    ("[Tt]reasurer", "Treasurer"),
    ("[Ss]ecretary", "Secretary"),
)

EXECUTIVE_ROLES = (
    "Chief Executive Officer",
    "Chief Operating Officer",
    "President",
    "Vice President",
    "Corporate Secretary",
    "Chief Financial Officer",
)
BOARD_ROLES = ("Director", "Chairman", "Board Member")
CHIEF_EXECUTIVE = "Chief Executive Officer"

EMAIL_PATTERN = r"\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}\b"
PHONE_PATTERN = r"(?:\+\d{1,2}\s?)?\(?\d{3}\)?[\s.-]?\d{3}[\s.-]?\d{4}"

# Pages whose URL holds one of these are not matched to a company.
EXCLUDED_BY_MATCHER = (
    "press-release", "news", "blog", "announcement",
    "news-room", "press-releases", "projects",
)
# Pages whose URL holds one of these are not mined for people.
EXCLUDED_BY_READER = (
    "press-release", "news", "blog", "announcement", "press", "update", "release",
    "media", "breaking", "newsroom", "reports", "financial-news", "corporate-news",
    "projects",
)
EXECUTIVE_PAGE_WORDS = ("team", "management", "leadership", "executive", "officer")
BOARD_PAGE_WORDS = ("board", "director", "chairman")
LINK_WORDS = (
    "management", "leadership", "team", "board", "directors",
    "governance", "about", "company", "corporate", "executives",
)
PAGE_KEYWORDS = ("chief", "officer", "director", "president", "leadership", "management")

# A name that contains one of these is not a person.
NON_PERSON_WORDS = (
    "qualified person", "mine", "mines", "silver mine", "gold mine", "copper mine",
    "zinc mine", "ore", "ores", "mineral", "minerals", "mining", "quarry", "deposit",
    "resource", "resources", "exploration", "development", "corporation", "company",
    "inc", "llc", "limited", "group", "holdings", "press", "media", "news", "blog",
    "announcement", "report", "consultant", "advisor",
)
MIN_NAME_LENGTH = 3

# Titles looked for in front of a name; each one is searched for separately.
LEADING_TITLES = (
    "CEO", "CFO", "COO", "President", "Vice President", "VP", "Director", "Chairman",
    "Chair", "Chief", "Executive", "Manager", "Head", "Lead", "Superintendent",
    "Supervisor", "Coordinator", "Advisor", "Consultant", "Specialist",
)
NAME_AFTER_TITLE = r"[A-Z][a-z]+(?:\s+[A-Z][a-z]+)*"
CONTEXT_CHARS = 50

# Titles (lower case) that count as the two key positions.
CHIEF_TITLES = ("chief executive officer", "ceo")
CHAIR_TITLES = ("chairman", "chairman of the board")

# Capitalised words that never belong to a person's name (our own list, used by
# the rule-based recogniser only).
NOT_IN_NAMES = (
    "Chief", "Executive", "Financial", "Operating", "Officer", "Officers", "President",
    "Director", "Directors", "Chairman", "Chairperson", "Chair", "Vice", "Treasurer",
    "Secretary", "Investor", "Relations", "Corporate", "Communications", "Development",
    "Affairs", "Contact", "Contacts", "Person", "Representative", "Board", "Management",
    "Leadership", "Team", "Senior", "Office", "Information", "Our", "The", "Us", "And",
    "Company", "Corp", "Corporation", "Inc", "Ltd", "Limited", "Mr", "Mrs", "Ms", "Dr",
)

# White space as a Unicode-aware reader has it (our own list, by the Unicode property).
WHITESPACE = (
    " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007"
    "\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)

PLACEHOLDER_SITE = "http://placeholder/"
PROMPT_TEXT_CHARS = 5000
PROMPT_TEMPLATE = (
    "Analyze the following text about {company} and extract information about:\n"
    "1. Chief Executive Officer (CEO)\n"
    "2. Chairman of the Board\n"
    "\n"
    "Format the response as a JSON object with two arrays:\n"
    "- officers: Array of objects with 'name' and 'title' fields\n"
    "- board_members: Array of objects with 'name' and 'title' fields\n"
    "\n"
    "Only include the CEO and Chairman if they are explicitly mentioned.\n"
    "If a position is not found, return an empty array.\n"
    "\n"
    "Text to analyze:\n"
    "{text}\n"
    "\n"
    "Response format:\n"
    "{{\n"
    '    "officers": [\n'
    '        {{"name": "John Doe", "title": "Chief Executive Officer"}}\n'
    "    ],\n"
    '    "board_members": [\n'
    '        {{"name": "Jane Smith", "title": "Chairman of the Board"}}\n'
    "    ]\n"
    "}}"
)


def words_pattern(words: tuple[str, ...]) -> str:
    """One alternation of literal words, regex characters escaped; those that begin alike share
    their begin, so that a search tries few letters at a place and not every word."""
    special = set(r".^$*+?()[]{}|\\")
    return _behind_first(["\\" + c if c in special else c for c in w] for w in words)


def words_any_case(words: tuple[str, ...]) -> str:
    """`words_pattern` that finds in a text what that one finds in its lower case.

    Of characters beyond ASCII only the Kelvin sign has an ASCII letter as its lower case; a
    dotted capital I becomes two characters, so that a word may not end in i.
    """
    if any(w.startswith("k") or w.endswith("i") for w in words):
        raise ValueError("words must not begin with k or end in i")
    return f"(?i:{_behind_first([r'[k\u212a]' if c == 'k' else c for c in w] for w in words)})"


def phrase_pattern(phrases: tuple[str, ...]) -> str:
    """One alternation of phrases whose words may be any white space apart."""
    return "|".join(p.replace(" ", r"\s+") for p in phrases)


# What a case-blind search of all of Unicode takes for an ASCII letter besides its two cases.
_ALSO = {"s": r"\u017f", "i": r"\u0130\u0131", "k": r"\u212a"}
_ASCII = " .,'0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"


def any_case(phrases: tuple[str, ...]) -> str:
    """`phrase_pattern` in any letter case. First letters are classes of their cases, which a
    search looks up, where a case-blind one folds each letter of a text anew.

    Flags: i = any letter case, u and U = Unicode case, \\s.
    """
    firsts: dict[str, list[list[str]]] = {}
    for phrase in phrases:
        first, *rest = re.findall(r".\??", phrase)
        firsts.setdefault(first, []).append([r"\s+" if c == " " else c for c in rest])
    words = "|".join(f"[{c}{c.upper()}{_ALSO.get(c, '')}](?iu:{_folded(rest)})" for c, rest in firsts.items())
    return f"(?U:{_not_behind(firsts)}(?:{words}))"


def quick_look(phrases: tuple[str, ...]) -> str:
    """A look that passes over the usual characters which begin none of the phrases, in any case."""
    return _not_behind(p[0] for p in phrases)


def _behind_first(words: Iterable[list[str]]) -> str:
    """An alternation of words given by their characters, behind a look at the first one."""
    words = list(words)
    return f"{_not_behind(w[0][-1] for w in words)}(?:{_folded(words)})"


def _not_behind(firsts: Iterable[str]) -> str:
    """A quick look that passes over the usual characters which begin nothing, in any case."""
    begins = {c for f in firsts for c in (f, f.swapcase())}
    return f"(?![{''.join(c for c in _ASCII if c not in begins)}])"


def _folded(words: list[list[str]]) -> str:
    """The alternation with common beginnings folded. At any place it matches what the plain one
    does: of words that match there, the first one."""
    groups: dict[str | None, list[list[str]]] = {}
    for word in words:
        groups.setdefault(word[0] if word else None, []).append(word[1:])
    if None in groups:
        groups[None] = [[]]

    def behind(rest: list[list[str]]) -> str:
        several = len({w[0] if w else None for w in rest}) > 1
        return f"(?:{_folded(rest)})" if several else _folded(rest)

    return "|".join("" if c is None else c + behind(rest) for c, rest in groups.items())
