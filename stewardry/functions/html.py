"""Markup to text with native expressions: tags out, character references decoded."""

from __future__ import annotations

import html.entities
import json

from pyspark.sql import Column
from pyspark.sql import functions as F

# Elements whose content is not markup; without an end tag it runs to the end of the text.
_RAW_BLOCKS = r"(?is)<(script|style)(?=[\s/>])[^>]*>.*?(?:</\1\s*>|\z)"
# Elements whose content is never part of a document's text.
_HIDDEN_BLOCKS = r"(?is)<(?:(script|style)(?=[\s/>])[^>]*>.*?(?:</\1\s*>|\z)|(template|rt|rp)(?=[\s/>])[^>]*>.*?</\2\s*>)"
_COMMENTS = r"(?s)<!--.*?-->"
# Tags (quoted attribute values may hold '>'), declarations, processing instructions.
# The possessive loop keeps the matcher from recursing on a '<' that is never closed.
_TAGS = r"""(?s)</?[A-Za-z](?:[^>"']|"[^"]*"|'[^']*')*+>|<[!?][^>]*>"""
_REFERENCE = r"&(?:#[0-9]{1,7}|#[xX][0-9A-Fa-f]{1,6}|[A-Za-z][A-Za-z0-9]{1,31});"

# Decoded first and without a table search.
_FREQUENT = {"&amp;": "&", "&nbsp;": "\u00a0", "&lt;": "<", "&gt;": ">", "&quot;": '"'}


def _named_references() -> Column:
    """Name -> characters, from the standard library's table, as one literal map."""
    names = {k[:-1]: v for k, v in html.entities.html5.items() if k.endswith(";")}
    return F.from_json(F.lit(json.dumps(names)), "map<string,string>")


def _code_point(number: Column) -> Column:
    """The character of a code point; outside Unicode -> U+FFFD."""
    units = F.when(
        number < 0x10000, F.lpad(F.hex(number), 4, "0")
    ).otherwise(
        F.concat(
            F.hex(F.shiftright(number - 0x10000, 10) + 0xD800),
            F.hex((number - 0x10000).bitwiseAND(0x3FF) + 0xDC00),
        )
    )
    surrogate = number.between(0xD800, 0xDFFF)
    return F.when(
        (number == 0) | surrogate | (number > 0x10FFFF), F.lit("\ufffd")
    ).otherwise(F.decode(F.unhex(units), "UTF-16BE"))


def _decode_reference(ref: Column, names: Column) -> Column:
    hexadecimal = F.conv(F.regexp_extract(ref, "^&#[xX]([0-9A-Fa-f]+);$", 1), 16, 10)
    decimal = F.regexp_extract(ref, "^&#([0-9]+);$", 1)
    frequent = F.lit(None).cast("string")
    for name, char in _FREQUENT.items():
        frequent = F.when(ref == name, F.lit(char)).otherwise(frequent)
    return F.coalesce(
        frequent,
        F.when(ref.rlike("^&#[xX]"), _code_point(hexadecimal.cast("long")))
        .when(ref.rlike("^&#"), _code_point(F.try_to_number(decimal, F.lit("9999999")).cast("long")))
        .otherwise(F.try_element_at(names, F.substr(ref, F.lit(2), F.length(ref) - 2))),
        ref,
    )


def decode_references(text: Column | str) -> Column:
    """Every `&name;`, `&#n;` and `&#xn;` decoded, each exactly once.

    The text is cut at its references and put together again with the decoded ones, so
    a decoded `&` never starts a second reference.
    """
    text = F.col(text) if isinstance(text, str) else text
    names = _named_references()
    between = F.split(text, _REFERENCE, -1)
    decoded = F.transform(
        F.regexp_extract_all(text, F.lit(_REFERENCE), F.lit(0)),
        lambda ref: _decode_reference(ref, names),
    )
    joined = F.array_join(
        F.zip_with(between, decoded, lambda a, b: F.concat(a, F.coalesce(b, F.lit("")))), ""
    )
    return F.when(F.contains(text, F.lit("&")), joined).otherwise(text)


def markup_only(html_text: Column | str) -> Column:
    """The document without comments, scripts and style sheets, tags kept."""
    html_text = F.col(html_text) if isinstance(html_text, str) else html_text
    return F.regexp_replace(F.regexp_replace(html_text, _COMMENTS, ""), _RAW_BLOCKS, "")


def strip_tags(html_text: Column | str) -> Column:
    """Tags, comments, declarations and hidden blocks removed, nothing put in their place."""
    html_text = F.col(html_text) if isinstance(html_text, str) else html_text
    text = F.regexp_replace(html_text, _COMMENTS, "")
    text = F.regexp_replace(text, _HIDDEN_BLOCKS, "")
    text = F.regexp_replace(text, _TAGS, "")
    return F.when(F.contains(html_text, F.lit("<")), text).otherwise(html_text)


def clean_html(html_text: Column | str) -> Column:
    """The text of an HTML document or fragment."""
    return decode_references(strip_tags(html_text))
