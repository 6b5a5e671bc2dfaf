"""Per-company local files: `{"officers": [...], "board_members": [...]}`."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stewardry.functions.urls import company_file_key
from stewardry.schemas import MEMBERS
from stewardry.sources.pages import scan_page_files


def valid_members(raw: Column) -> Column:
    """Entries of a raw JSON list with both a name and a title; none -> NULL."""
    items = F.from_json(raw, "array<string>")
    members = F.transform(items, lambda item: F.from_json(item, MEMBERS.elementType))
    kept = F.filter(members, lambda m: m["name"].isNotNull() & m["title"].isNotNull())
    return F.when(F.startswith(F.ltrim(raw), F.lit("[")), F.nullif(kept, F.array().cast(MEMBERS)))


def local_management(files: DataFrame) -> DataFrame:
    """`company_key, officers, board_members` out of `source_file, raw`."""
    fields = F.from_json("raw", "map<string,string>")
    return files.select(
        F.regexp_replace("source_file", r"\.json$", "").alias("company_key"),
        valid_members(F.try_element_at(fields, F.lit("officers"))).alias("officers"),
        valid_members(F.try_element_at(fields, F.lit("board_members"))).alias("board_members"),
    )


def scan_local_management(spark: SparkSession, folder: str) -> DataFrame:
    return local_management(scan_page_files(spark, folder))


def with_local_management(companies: DataFrame, local: DataFrame) -> DataFrame:
    """Companies with the lists of their local file; no file -> NULL lists."""
    keyed = companies.withColumn("company_key", company_file_key("company_name"))
    renamed = local.withColumnsRenamed(
        {"officers": "local_officers", "board_members": "local_board_members"}
    )
    return keyed.join(renamed, "company_key", "left").drop("company_key")
