"""Pages to the people table and the reports of their companies."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stewardry.functions.urls import company_domain, netloc_domain
from stewardry.operators.reports import company_people_summary, found_people, unique_people
from stewardry.operators.spread import join_hot
from stewardry.plans.extraction import process_pages
from stewardry.session import written
from stewardry.sinks.summaries import render_company_report


def company_people_table(processed: DataFrame, companies: DataFrame) -> DataFrame:
    """The people table: `company_id, name, role, email, phone, source_url, source_title`.

    Pages are joined before their people are unfolded, so that fewer rows move.
    """
    owned = companies.select(F.col("id").alias("company_id"), company_domain("website").alias("_domain"))
    pages = processed.select(
        netloc_domain("url").alias("_domain"), F.col("url").alias("source_url"),
        F.col("title").alias("source_title"), F.concat("executives", "board_members").alias("_people"),
    ).filter((F.size("_people") > 0) & (F.col("_domain") != ""))
    return join_hot(pages, owned, "_domain", "source_url").select(
        "company_id", F.inline("_people"), "source_url", "source_title"
    )


def company_reports(pages: DataFrame, companies: DataFrame) -> DataFrame:
    """The report rows of all companies (see `sinks.summaries.render_company_report`).

    Three steps need the processed pages, so these are written once in between.
    """
    processed = process_pages(pages).select("url", "executives", "board_members")
    people = written(processed, "processed-pages")
    return render_company_report(
        company_people_summary(people, companies), unique_people(found_people(people))
    )
