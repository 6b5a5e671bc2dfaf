"""The list of registered queries: a Spark query and, where SQL can say it, its oracle."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}
#: Queries that learn from the tables; SQL cannot say their results, tests hold them otherwise.
LEARNED: dict[str, Query] = {}


def query(sql: str | None = None, name: str | None = None) -> Callable[[Query], Query]:
    """Registers a query under its function name, with its oracle SQL."""
    def register(build: Query) -> Query:
        key = name or build.__name__
        if key in QUERIES:
            raise ValueError(f"query {key} is registered twice")
        QUERIES[key] = build
        if sql is not None:
            ORACLES[key] = sql
        return build

    return register


def learned(build: Query) -> Query:
    """Registers a query whose result no SQL can say."""
    LEARNED[build.__name__] = build
    return build
