"""Pages to people: the whole extraction as one narrow step per page."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stewardry.functions import people as P
from stewardry.functions.text import relevant_sections
from stewardry.functions.urls import is_excluded
from stewardry.operators.once import compute_once
from stewardry.operators.spread import spread_small
from stewardry.schemas import PEOPLE
from stewardry.sources.pages import page_text


def with_sections(pages: DataFrame) -> DataFrame:
    """Pages with `relevant`, the sections to mine; none for excluded or empty pages."""
    text = page_text("body_text", "sections")
    return _mined(pages, F.when(~is_excluded("url"), text).otherwise(F.lit("")))


def _mined(pages: DataFrame, text: Column) -> DataFrame:
    sections = F.when(F.col("_text") != "", relevant_sections("_text")).otherwise(
        F.array().cast("array<string>")
    )
    spread = spread_small(pages)
    return compute_once(compute_once(spread, _text=text), relevant=sections).drop("_text")


def process_pages(
    pages: DataFrame, spans: str | None = None, keep: str = "first",
    merge_contacts: bool = False, valid_mode: str = "substring",
) -> DataFrame:
    """`url, title, source_file, relevant, executives, board_members` per page.

    Input: `url, title, source_file, body_text, sections`. Every page comes out, excluded
    and empty ones with empty lists. With `spans` the names come from that column (see
    `operators.people.attach_spans`; the pages must then have `relevant`).
    """
    sectioned = pages if spans else with_sections(pages)
    found = compute_once(sectioned, _found=P.people_of_sections("relevant", spans))
    unique = compute_once(found, _unique=P.dedup_people("_found"))
    merged = compute_once(unique, _merged=P.merge_similar_people("_unique", keep, merge_contacts))
    people = F.filter("_merged", lambda p: P.is_valid_name(p["name"], valid_mode))
    done = compute_once(merged, _people=F.coalesce(people, F.array().cast(PEOPLE)), _list=P.page_list(F.col("url")))
    executives, board_members = P.listed_people(F.col("_people"), F.col("_list"))
    listed = compute_once(done, executives=executives, board_members=board_members)
    return listed.select(
        "url", "title", "source_file", "relevant", "executives", "board_members"
    )


def process_pages_by_role(pages: DataFrame) -> DataFrame:
    """The older flow: every page mined, one entry per name and role, sorted by name.

    Roles and names are told apart inside the page's row, so this too is free of shuffles.
    """
    sectioned = _mined(pages, page_text("body_text", "sections"))
    found = compute_once(sectioned, _found=P.people_of_sections("relevant"))
    return compute_once(found, people=P.dedup_by_role("_found")).select(
        "url", "title", "source_file", "relevant", "people"
    )
