"""People tables: one row per find, folded with grouped aggregates."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stewardry import vocab
from stewardry.functions.people import leading_title_hits
from stewardry.functions.text import collapse_whitespace
from stewardry.functions.urls import authority
from stewardry.operators.once import compute_once
from stewardry.operators.spread import spread_small
from stewardry.schemas import SPANS


def _where(value: Column, condition: Column) -> Column:
    return F.when(condition, value)


def dedup_people_rows(people: DataFrame, page: str = "page_id", seq: str = "seq") -> DataFrame:
    """One row per page and name: `seq` of the first find, folded role, last contacts.

    The fold of `functions.people.dedup_people` for people that come as rows. All
    aggregates combine before the shuffle, so a page with very many finds stays cheap.
    """
    order, role = F.col(seq), F.col("role")
    known_exec = role.isin(*vocab.EXECUTIVE_ROLES)
    email, phone = F.col("email"), F.col("phone")
    folded = people.groupBy(page, "name").agg(
        F.min(order).alias(seq),
        F.min_by(role, order).alias("_first"),
        F.min_by(_where(role, known_exec), _where(order, known_exec)).alias("_executive"),
        F.max_by(email, _where(order, email.isNotNull())).alias("email"),
        F.max_by(phone, _where(order, phone.isNotNull())).alias("phone"),
    )
    first = F.col("_first")
    role = F.when(
        first.isin(*vocab.BOARD_ROLES), F.coalesce("_executive", "_first")
    ).otherwise(first)
    return folded.select(page, seq, "name", role.alias("role"), "email", "phone")


def dedup_people_by_role(people: DataFrame, page: str = "page_id", seq: str = "seq") -> DataFrame:
    """One row per page, name and role with the last known contacts."""
    order, email, phone = F.col(seq), F.col("email"), F.col("phone")
    return people.groupBy(page, "name", "role").agg(
        F.min(order).alias(seq),
        F.max_by(email, _where(order, email.isNotNull())).alias("email"),
        F.max_by(phone, _where(order, phone.isNotNull())).alias("phone"),
    )


def title_then_name(pages: DataFrame, text: str = "body_text") -> DataFrame:
    """One row per name that follows a title, with its context; page columns are kept."""
    others = [c for c in pages.columns if c != text]
    collapsed = compute_once(spread_small(pages), _text=collapse_whitespace(text))
    hits = compute_once(collapsed, _hits=leading_title_hits("_text"))
    return hits.select(*others, F.explode("_hits").alias("_hit")).select(
        *others, F.col("_hit.name").alias("name"), F.col("_hit.title").alias("title"),
        F.col("_hit.context").alias("context"), F.col("_hit.start").alias("start"),
    )


def officers_by_domain(pages: DataFrame, url: str = "url", text: str = "body_text") -> DataFrame:
    """`title_then_name` with the page's authority as `domain`."""
    return title_then_name(pages.withColumn("domain", authority(url)), text)


def attach_spans(
    pages: DataFrame,
    recogniser: Callable[[], Callable[[str], list[tuple[str, int]]]],
    sections: str = "sections",
) -> DataFrame:
    """Pages with a `spans` column filled by any recogniser of person names.

    `recogniser()` is called once per task and returns a function from a section to its
    `(name, start)` pairs. Pages stay where they are; batches go through Arrow.
    """
    schema = T.StructType([*pages.schema.fields, T.StructField("spans", SPANS)])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        find = recogniser()
        for batch in batches:
            spans = [
                [
                    {"section": i, "name": name, "start": start}
                    for i, section in enumerate([] if texts is None else texts)
                    for name, start in find(section)
                ]
                for texts in batch[sections]
            ]
            yield batch.assign(spans=spans)

    return pages.mapInPandas(run, schema)
