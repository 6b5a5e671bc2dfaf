"""Columns an operator does not look at, kept out of the way of those it makes."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def set_aside(rows: DataFrame, used: tuple[str, ...]) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """`rows` with all but the used columns under names that clash with nothing, and what
    gives the rows of a result their columns back."""
    names = rows.columns
    renamed = [c if c in used else f"_aside_{i}" for i, c in enumerate(names)]
    return rows.toDF(*renamed), lambda result: result.select(*renamed).toDF(*names)
