from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from stewardry.session import build_session


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests", master="local[8]", spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false", spark__sql__shuffle__partitions="8",
        spark__driver__memory="8g",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def value(spark):
    """Evaluates one expression over one row of string columns."""
    def run(expression, **columns):
        from pyspark.sql import types as T

        schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
        df = spark.createDataFrame([tuple(columns.values())], schema)
        return df.select(expression.alias("x")).first()["x"]

    return run


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().treeString()
