"""Company list to registry."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame

from stewardry.operators.registry import import_notes, prepare_companies, upsert_companies
from stewardry.operators.reports import import_summary


def import_companies(registry: DataFrame, rows: DataFrame, now: Column) -> tuple[DataFrame, DataFrame]:
    """The registry after the import, and the import's summary.

    `rows`: `row_no, website, company_name, ticker, exchange` as scanned.
    """
    return (
        upsert_companies(registry, prepare_companies(rows), now),
        import_summary(rows, import_notes(rows)),
    )
