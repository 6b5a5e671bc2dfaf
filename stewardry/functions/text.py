"""Text preparation (Column in, Column out)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from stewardry import vocab
from stewardry.functions.spans import let

SECTION_PATTERN = vocab.any_case(
    vocab.CONTACT_PHRASES + vocab.MANAGEMENT_PHRASES + vocab.ROLE_PHRASES
)
# The look ahead passes over printable ASCII before anything else is tried.
_SENTENCE_END = r"(?U)(?![!-~])(?<=[.!?])\s+"
_CUT = "\x03"


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def first_filled(*values: Column | str) -> Column:
    """The first value that is neither NULL nor empty, else ''."""
    return F.coalesce(*(F.nullif(_col(v), F.lit("")) for v in values), F.lit(""))


def coalesce_text(content: Column | str, text: Column | str) -> Column:
    """Page text under either documented key."""
    return first_filled(content, text)


def coalesce_company(
    company: Column | str, company_name: Column | str, url: Column | str
) -> Column:
    """Company of a page under any documented key."""
    return first_filled(company, company_name, url)


def sections_text(sections: Column | str) -> Column:
    """Text of a raw JSON `sections` value: object or list values joined by a space."""
    raw = F.nullif(_col(sections), F.lit(""))
    as_object = F.from_json(raw, "map<string,string>")
    as_list = F.from_json(raw, "array<string>")
    return F.coalesce(
        F.when(F.startswith(raw, F.lit("{")), F.array_join(F.map_values(as_object), " ", "None")),
        F.when(F.startswith(raw, F.lit("[")), F.array_join(as_list, " ", "None")),
        raw,
        F.lit(""),
    )


def collapse_whitespace(text: Column | str) -> Column:
    """Runs of white space as one space, none at the ends."""
    return F.trim(F.regexp_replace(_col(text), r"(?U)[\s\x1c-\x1f]+", " "))


def has_page_keyword(text: Column | str) -> Column:
    """True where the text holds a management word."""
    return F.lower(_col(text)).rlike(vocab.words_pattern(vocab.PAGE_KEYWORDS))


def sentences(text: Column | str) -> Column:
    """Sentences, cut at white space after `.`, `!` or `?`."""
    text = _col(text)
    # A split compiles its pattern anew for every text, a replacement does not.
    marked = F.split(F.regexp_replace(text, _SENTENCE_END, _CUT), _CUT, -1)
    return F.when(F.contains(text, F.lit(_CUT)), F.split(text, _SENTENCE_END, -1)).otherwise(marked)


def relevant_sections(text: Column | str) -> Column:
    """The sentences about contacts, management or roles; none -> the whole text.

    One search of the whole text comes first, so that the many texts without any of the
    words are not cut up at all.
    """
    text = _col(text)
    found = let(
        F.filter(sentences(text), lambda s: s.rlike(SECTION_PATTERN)),
        lambda kept: F.when(F.size(kept) > 0, kept).otherwise(F.array(text)),
    )
    return F.when(text.rlike(SECTION_PATTERN), found).otherwise(F.array(text))


def compact_lines(text: Column | str) -> Column:
    """Lines trimmed and cut at double spaces, the non-empty pieces joined by a space."""
    pieces = F.flatten(
        F.transform(
            F.split(_col(text), r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85\u2028\u2029]", -1),
            lambda line: F.split(strip(line), "  ", -1),
        )
    )
    return F.array_join(F.filter(F.transform(pieces, strip), lambda p: p != ""), " ")


def strip(text: Column | str) -> Column:
    """The text without white space at its ends."""
    return F.btrim(_col(text), F.lit(vocab.WHITESPACE))
