"""Registry and object listing to coverage figures."""

from __future__ import annotations

from pyspark.sql import DataFrame

from stewardry.operators.matching import company_file_counts
from stewardry.operators.reports import files_per_domain, top_companies


def coverage(companies: DataFrame, objects: DataFrame) -> DataFrame:
    """Companies with their domain and number of page objects.

    The objects are counted per domain before the join, so a site with very many pages
    reaches it as one row.
    """
    return company_file_counts(companies, files_per_domain(objects))


def top_covered(companies: DataFrame, objects: DataFrame, n: int = 20) -> DataFrame:
    """The companies with the most page objects."""
    return top_companies(coverage(companies, objects), n)
