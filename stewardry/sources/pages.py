"""Scraped page objects: one JSON object per file, file name = percent-encoded URL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stewardry.functions.html import clean_html
from stewardry.functions.text import coalesce_company, coalesce_text, first_filled, sections_text
from stewardry.functions.urls import page_url
from stewardry.operators.once import compute_once
from stewardry.operators.spread import spread_small
from stewardry.sources.objects import name_below

# How a bare NaN token comes out of the JSON reader when a string is asked for.
_BARE_NAN = '"NaN"'


def scan_page_files(spark: SparkSession, folder: str, glob: str = "*.json") -> DataFrame:
    """`source_file, raw` of the page files below a folder, each file read once.

    Bytes that are not UTF-8 are taken as Latin-1.
    """
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", glob)
        .load(folder)
    )
    raw = F.when(
        F.is_valid_utf8(F.col("content").cast("string")), F.col("content").cast("string")
    ).otherwise(F.decode("content", "ISO-8859-1"))
    return files.select(
        name_below(folder).alias("source_file"), raw.alias("raw")
    )


def _field(fields: Column, key: str) -> Column:
    return F.nullif(F.try_element_at(fields, F.lit(key)), F.lit(_BARE_NAN))


def _unusable(fields: Column, key: str) -> Column:
    """The key is there, but holds null or NaN."""
    return F.map_contains_key(fields, key) & _field(fields, key).isNull()


def decode_pages(files: DataFrame) -> DataFrame:
    """Page rows out of `source_file, raw`, each with a `reject_reason` (NULL = good).

    A page is rejected when its JSON is broken or a text field holds null or NaN. Other
    columns are kept as they are. The body falls back to `content` when body and
    markdown are both empty.
    """
    fields = F.col("_fields")
    parsed = compute_once(spread_small(files), _fields=F.from_json("raw", "map<string,string>"))
    cleaned = (
        compute_once(
            parsed,
            _body=clean_html(first_filled(_field(fields, "body_text"))),
            markdown_content=clean_html(first_filled(_field(fields, "markdown_content"))),
        )
        .withColumn("url", page_url("source_file"))
        .withColumn("title", _field(fields, "title"))
        .withColumn("meta_description", _field(fields, "meta_description"))
        .withColumn("sections", _field(fields, "sections"))
    )
    needs_content = (
        (F.col("_body") == "") & (F.col("markdown_content") == "")
        & F.map_contains_key(fields, "content")
    )
    reason = (
        F.when(fields.isNull(), F.lit("malformed json"))
        .when(_unusable(fields, "body_text"), F.lit("body_text is null"))
        .when(_unusable(fields, "markdown_content"), F.lit("markdown_content is null"))
        .when(needs_content & _unusable(fields, "content"), F.lit("content is null"))
    )
    return (
        cleaned.withColumn("reject_reason", reason)
        .withColumn(
            "body_text",
            F.when(needs_content, clean_html(first_filled(_field(fields, "content"))))
            .otherwise(F.col("_body")),
        )
        .drop("_fields", "_body", "raw")
    )


def scan_pages_json(spark: SparkSession, folder: str) -> DataFrame:
    """The good pages of a folder."""
    return accepted_pages(decode_pages(scan_page_files(spark, folder)))


def accepted_pages(pages: DataFrame) -> DataFrame:
    return pages.filter(F.col("reject_reason").isNull()).drop("reject_reason")


def rejected_pages(pages: DataFrame) -> DataFrame:
    """`source_file, reject_reason` of the pages that cannot be used."""
    return pages.filter(F.col("reject_reason").isNotNull()).select("source_file", "reject_reason")


def page_text(body_text: Column | str, sections: Column | str) -> Column:
    """The text to mine: the body, else the raw `sections` value as text."""
    return first_filled(body_text, sections_text(sections))


def parse_json_files(files: DataFrame) -> DataFrame:
    """`source_file, fields` of `source_file, raw`; `fields` is NULL for a bad file."""
    return files.select("source_file", F.from_json("raw", "map<string,string>").alias("fields"))


def scan_json_dir(spark: SparkSession, folder: str) -> DataFrame:
    """`source_file, fields` of every readable `.json` file of a folder."""
    return parse_json_files(scan_page_files(spark, folder)).filter(F.col("fields").isNotNull())


def documented_page(fields: Column | str) -> Column:
    """`company, text` of a page under any of the documented keys."""
    fields = F.col(fields) if isinstance(fields, str) else fields

    def get(key: str) -> Column:
        return F.try_element_at(fields, F.lit(key))

    return F.struct(
        coalesce_company(get("company"), get("company_name"), get("url")).alias("company"),
        coalesce_text(get("content"), get("text")).alias("text"),
    )
