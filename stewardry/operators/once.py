"""Expressions that must be evaluated once per row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def compute_once(df: DataFrame, **columns: Column) -> DataFrame:
    """`df` with the given columns added (or replaced), each computed once per row.

    A column made with `withColumn` is copied into every filter on it, and `explode`
    filters out empty arrays by itself; for the long text expressions of this library
    that would mean running them several times per row. A one-element `explode` keeps
    the optimizer from doing so and stays inside the generated code.
    """
    values = F.struct(*(value.alias(name) for name, value in columns.items()))
    kept = [c for c in df.columns if c not in columns]
    return df.select(*kept, F.explode(F.array(values)).alias("_once")).select(
        *kept, *(F.col(f"_once.{name}").alias(name) for name in columns)
    )
