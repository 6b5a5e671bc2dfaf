"""Tables and files written by the library."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stewardry.functions.urls import company_file_key


def _flat(df: DataFrame) -> DataFrame:
    """Nested columns as JSON text, as CSV needs it."""
    nested = (T.ArrayType, T.StructType, T.MapType)
    return df.select(*(
        F.to_json(f.name).alias(f.name) if isinstance(f.dataType, nested) else F.col(f.name)
        for f in df.schema.fields
    ))


def write_coverage_csv(counted: DataFrame, path: str) -> None:
    """Registry, domain and file count as CSV with a header."""
    renamed = counted.withColumnRenamed("n_files", "files_in_bucket")
    _flat(renamed).write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def management_rows(people: DataFrame, source: str, name: str = "name", role: str = "role") -> DataFrame:
    """People in the output form `source, name, role`."""
    return people.select(
        F.col(source).alias("source"), F.col(name).alias("name"), F.col(role).alias("role")
    )


def write_management_rows(rows: DataFrame, path: str, form: str = "csv") -> None:
    """`source, name, role` as CSV with a header (quoted where needed) or JSON lines."""
    writer = rows.select("source", "name", "role").write.mode("overwrite")
    if form == "csv":
        writer.option("header", True).option("escape", '"').csv(path)
    elif form == "json":
        writer.json(path)
    else:
        raise ValueError(f"form must be 'csv' or 'json', not {form!r}")


def write_company_json(companies: DataFrame, path: str, one_file_each: bool = False) -> None:
    """Companies as JSON, one line each, with their `company_key`.

    `one_file_each` puts every company into a file of its own below
    `company_key=<file key>`; that suits some thousands of companies, not millions. A
    company is one row, so each of these files is written by exactly one task.
    """
    keyed = companies.withColumn("company_key", company_file_key("company_name"))
    writer = keyed.write.mode("overwrite")
    (writer.partitionBy("company_key") if one_file_each else writer).json(path)


def write_registry(registry: DataFrame, path: str) -> None:
    """A new version of the registry; `path` must not be the one it was read from.

    Sorted by name within files, so that name lookups skip most of them.
    """
    registry.repartitionByRange("company_name").sortWithinPartitions("company_name").write.mode(
        "overwrite"
    ).parquet(path)
