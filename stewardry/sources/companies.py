"""Company lists (CSV) and the registry table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stewardry.schemas import REGISTRY_COLUMNS

# Header of either dialect -> our column.
_HEADERS = {
    "Website": "website",
    "Company Name": "company_name",
    "URL": "website",
    "Name": "company_name",
    "Ticker": "ticker",
    "Exchange": "exchange",
}


def rename_company_columns(df: DataFrame) -> DataFrame:
    """Columns of either header dialect under our names; other columns are kept."""
    return df.withColumnsRenamed({c: _HEADERS[c] for c in df.columns if c in _HEADERS})


def scan_companies_csv(spark: SparkSession, path: str) -> DataFrame:
    """`website, company_name, ticker, exchange`, all text; an empty cell is NULL."""
    raw = spark.read.option("header", True).option("multiLine", True).csv(path)
    return rename_company_columns(raw).select("website", "company_name", "ticker", "exchange")


def scan_registry(registry: DataFrame) -> DataFrame:
    """All companies, eleven columns, in name order."""
    return registry.select(*REGISTRY_COLUMNS).orderBy("company_name")


def read_registry(spark: SparkSession, path: str) -> DataFrame:
    """The registry as written by `sinks.tables.write_registry`."""
    return spark.read.parquet(path)


def read_registry_jdbc(spark: SparkSession, url: str, table: str, **options: str) -> DataFrame:
    """The registry in a database; array columns arrive as JSON text and are parsed."""
    from stewardry.schemas import MEMBERS, SOURCE_TAGS

    rows = spark.read.format("jdbc").options(url=url, dbtable=table, **options).load()
    for column, schema in (
        ("officers", MEMBERS), ("board_members", MEMBERS), ("data_source", SOURCE_TAGS)
    ):
        if column in rows.columns:
            rows = rows.withColumn(column, F.from_json(F.col(column).cast("string"), schema))
    return rows
