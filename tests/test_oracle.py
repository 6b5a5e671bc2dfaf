"""Every registered query against its SQL, row by row, on the smallest tables."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as entry_point
from checks.inputs import TABLES
from checks.registered import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry_point.queries())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_its_sql(spark, duck, name):
    df = entry_point.queries()[name](spark, SF_DIR)
    columns = sorted(df.columns)
    ours = sorted(repr(tuple(row[c] for c in columns)) for row in df.collect())
    result = duck.execute(ORACLES[name])
    theirs_columns = [c[0] for c in result.description]
    assert sorted(theirs_columns) == columns
    order = [theirs_columns.index(c) for c in columns]
    theirs = sorted(repr(tuple(row[i] for i in order)) for row in result.fetchall())
    assert ours == theirs


def test_entry(spark):
    rows = entry_point.entry(spark).collect()
    assert 0 < len(rows) <= 20
    assert [r["n_files"] for r in rows] == sorted((r["n_files"] for r in rows), reverse=True)
