"""Matches of a pattern with their exact offsets, without a UDF.

One `regexp_replace` puts a control character before and after every match; splitting
at them gives the matches, and running lengths give their offsets.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_OPEN, _CLOSE = "\x01", "\x02"
_MATCHES = "array<struct<start:int,text:string>>"
_CHUNK = 64
#: Up to so many matches are cut out one by one.
_FEW = 8


def without_marks(text: Column) -> Column:
    """The text with the two control characters replaced by spaces (same length)."""
    # Hardly a text has them, and looking for them is far cheaper than going through it.
    held = F.contains(text, F.lit(_OPEN)) | F.contains(text, F.lit(_CLOSE))
    return F.when(held, F.translate(text, _OPEN + _CLOSE, "  ")).otherwise(text)


def mark(text: Column, pattern: str) -> Column:
    """The text with every match of the pattern between the two control characters.

    `text` must be free of them (see `without_marks`).
    """
    return F.regexp_replace(text, pattern, f"{_OPEN}$0{_CLOSE}")


def mark_copies(text: Column, pattern: str, look: str = "") -> Column:
    """The text with a copy of the match, between the two control characters, before every place
    where the pattern matches. So matches that overlap are all found, in one search.

    `look` is a quick look at a place that tells where there is no match.
    """
    return F.regexp_replace(text, f"{look}(?=({pattern}))", f"{_OPEN}$1{_CLOSE}")


def has_marks(marked: Column) -> Column:
    """Whether there are matches in a marked text."""
    return F.contains(marked, F.lit(_OPEN))


def marked_matches(marked: Column, copies: bool = False) -> Column:
    """The matches in a marked text, left to right: `array<struct<start, text>>`.

    Offsets count from 0 in the text without its marks, and without the copies of `mark_copies`.
    A text of many matches is worked through in chunks, as a list that grows by one entry is
    copied each time.
    """
    def chunked(pieces: Column) -> Column:
        cut = F.transform(
            F.sequence(F.lit(0), F.size(pieces) - 1, F.lit(_CHUNK)), lambda b: _matches_of(F.slice(pieces, b + 1, _CHUNK), copies))

        def moved(chunks: Column) -> Column:
            ends = F.aggregate(
                chunks, F.array(F.lit(0)), lambda acc, c: F.concat(acc, F.array(F.element_at(acc, -1) + c["at"])))
            return F.flatten(F.zip_with(chunks, F.slice(ends, 1, F.size(chunks)), lambda c, at: F.transform(
                c["found"], lambda m: F.struct((m["start"] + at).alias("start"), m["text"].alias("text")))))

        return let(cut, moved)

    def few(text: Column, pieces: Column) -> Column:
        # before a match lie the marks of those before it, two each, and their copies
        def row(match: Column, i: Column, copied: Column | int = 0) -> Column:
            before = F.length(F.call_function("substring_index", text, F.lit(_OPEN), i + 1))
            return F.struct((before - 2 * i - copied).alias("start"), match.alias("text"))

        if not copies:
            return F.transform(F.slice(pieces, 2, _FEW), lambda piece, i: row(F.substring_index(piece, _CLOSE, 1), i))
        matches = F.transform(F.slice(pieces, 2, _FEW), lambda piece: F.substring_index(piece, _CLOSE, 1))
        return let(matches, lambda found: F.transform(found, lambda match, i: row(
            match, i, F.when(i == 0, 0).otherwise(F.length(F.array_join(F.slice(found, F.lit(1), i), ""))))))

    def found(text: Column) -> Column:
        return let(F.split(text, _OPEN, -1), lambda pieces: F.when(F.size(pieces) <= _FEW + 1, few(text, pieces)).when(
            F.size(pieces) <= _CHUNK, _matches_of(pieces, copies)["found"]).otherwise(chunked(pieces)))

    return let(marked, lambda text: F.when(has_marks(text), found(text)).when(
        text.isNotNull(), F.array().cast(_MATCHES)))


def _matches_of(pieces: Column, copies: bool) -> Column:
    """`struct<at, found>`: the length of successive pieces, and the matches in them."""
    def step(acc: Column, piece: Column) -> Column:
        # Every piece but the first of a text begins with a match and its closing mark.
        begins = F.contains(piece, F.lit(_CLOSE))
        match = F.struct(
            acc["at"].alias("start"), F.substring_index(piece, _CLOSE, 1).alias("text")
        )
        beside = F.length(match["text"]) + 1 if copies else F.lit(1)
        return F.struct(
            (acc["at"] + F.length(piece) - F.when(begins, beside).otherwise(0)).alias("at"),
            F.when(begins, F.concat(acc["found"], F.array(match)))
            .otherwise(acc["found"]).alias("found"),
        )

    return F.aggregate(pieces, F.struct(F.lit(0).alias("at"), F.array().cast(_MATCHES).alias("found")), step)


def find_all(text: Column, pattern: str) -> Column:
    """All matches of a pattern with their offsets (see `mark`, `marked_matches`)."""
    return marked_matches(mark(text, pattern))


def grouped(items: Column, key) -> Column:
    """The items of each key together, keys in the order in which they first appear.

    One sort puts equal keys side by side; `key` gives a struct or value that can be sorted.
    """
    placed = F.transform(items, lambda x, i: F.struct(key(x).alias("key"), i.alias("at"), x.alias("item")))

    def cut(ordered: Column) -> Column:
        def first(i: Column) -> Column:
            return (i == 0) | ~F.equal_null(F.get(ordered, i)["key"], F.get(ordered, i - 1)["key"])

        def groups(begins: Column) -> Column:
            together = F.transform(begins, lambda b, k: F.slice(
                ordered, b + 1, F.coalesce(F.get(begins, k + 1), F.size(ordered)) - b))
            first_at = F.transform(together, lambda g: F.struct(F.get(g, F.lit(0))["at"].alias("at"), g.alias("g")))
            return F.transform(F.array_sort(first_at), lambda x: F.transform(x["g"], lambda y: y["item"]))

        return let(F.filter(F.transform(ordered, lambda _, i: i), first), groups)

    return let(F.array_sort(placed), cut)


def let(value: Column, body) -> Column:
    """`body(value)` with `value` computed once, for use inside array functions."""
    return F.get(F.transform(F.array(value), body), F.lit(0))
