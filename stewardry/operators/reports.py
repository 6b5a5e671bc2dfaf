"""Counts and summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stewardry import vocab
from stewardry.functions.urls import company_domain, decode_name, netloc_domain, own_name
from stewardry.operators.matching import domain_key


def files_per_domain(objects: DataFrame) -> DataFrame:
    """`domain, n_files` over all objects that have a domain."""
    domains = objects.select(netloc_domain(decode_name(own_name("object_name"))).alias("domain"))
    return domains.filter(F.col("domain") != "").groupBy("domain").agg(
        F.count(F.lit(1)).alias("n_files")
    )


def distinct_domains(objects: DataFrame) -> DataFrame:
    """The distinct first path parts of the object names, decoded."""
    first = F.split_part(F.col("object_name"), F.lit("/"), F.lit(1))
    return objects.select(decode_name(first).alias("domain")).distinct()


def coverage_report(counted: DataFrame) -> DataFrame:
    """One row: companies, those with a website, those with files."""
    return counted.agg(
        F.count(F.lit(1)).alias("n_companies"),
        F.count("website").alias("n_with_website"),
        F.count_if(F.col("n_files") > 0).alias("n_with_files"),
    )


def top_companies(counted: DataFrame, n: int = 20) -> DataFrame:
    """The `n` companies with the most files; ties by name, then website."""
    return (
        counted.select("company_name", "website", "n_files")
        .orderBy(F.desc("n_files"), "company_name", "website")
        .limit(n)
    )


def exchange_counts(companies: DataFrame, by: str = "name") -> DataFrame:
    """`exchange, n_companies`, ordered by exchange (`name`) or largest first (`count`)."""
    counts = (
        companies.filter(F.coalesce("exchange", F.lit("")) != "")
        .groupBy("exchange").agg(F.count(F.lit(1)).alias("n_companies"))
    )
    if by == "name":
        return counts.orderBy("exchange")
    if by == "count":
        return counts.orderBy(F.desc("n_companies"), "exchange")
    raise ValueError(f"by must be 'name' or 'count', not {by!r}")


def exchange_totals(companies: DataFrame) -> DataFrame:
    """One row: companies with and without an exchange, number of exchanges."""
    exchange = F.nullif(F.col("exchange"), F.lit(""))
    return companies.agg(
        F.count(exchange).alias("n_with_exchange"),
        F.count_if(exchange.isNull()).alias("n_without_exchange"),
        F.countDistinct(exchange).alias("n_exchanges"),
    )


def _n_people() -> Column:
    return F.size("executives") + F.size("board_members")


def people_per_domain(processed: DataFrame) -> DataFrame:
    """`domain, processed_files, total_people` over processed pages."""
    return (
        processed.select(netloc_domain("url").alias("domain"), _n_people().alias("_n"))
        .filter(F.col("domain") != "")
        .groupBy("domain")
        .agg(
            F.count_if(F.col("_n") > 0).alias("processed_files"),
            F.sum("_n").alias("total_people"),
        )
    )


def company_people_summary(processed: DataFrame, companies: DataFrame) -> DataFrame:
    """Per company: pages that yielded people, people found (a CEO on both lists twice).

    Pages are counted per domain first, so the join sees one row per domain however
    many pages a site has.
    """
    owned = companies.select("id", "company_name", company_domain("website").alias("domain"))
    found = people_per_domain(processed).withColumnRenamed("domain", "_key")
    keyed = owned.withColumn("_key", domain_key("domain", "company_name"))
    return keyed.join(found, "_key", "left").select(
        "id", "company_name", "domain",
        F.coalesce("processed_files", F.lit(0)).alias("processed_files"),
        F.coalesce("total_people", F.lit(0)).alias("total_people"),
    )


def found_people(processed: DataFrame) -> DataFrame:
    """Processed pages as rows `domain, url, seq, name, role, email, phone`: the
    executives of a page, then its board members."""
    both = F.concat("executives", "board_members")
    return processed.select(
        netloc_domain("url").alias("domain"), "url", F.posexplode(both).alias("seq", "_p")
    ).select("domain", "url", "seq", "_p.*")


def unique_people(found: DataFrame, group: str = "domain") -> DataFrame:
    """Per group, list and name the last entry, with the place the name first came at.

    `list` is `executive` or `board` by role; people of other roles are left out before
    the grouping. `found` is ordered by `url, seq`.
    """
    role = F.col("role")
    which = F.when(role.isin(*vocab.EXECUTIVE_ROLES), F.lit("executive")).when(
        role.isin(*vocab.BOARD_ROLES), F.lit("board")
    )
    place = F.struct("url", "seq")
    return (
        found.withColumn("list", which)
        .filter(F.col("list").isNotNull())
        .groupBy(group, "list", "name")
        .agg(
            F.min(place).alias("first_seen"),
            F.max_by(F.struct("role", "email", "phone"), place).alias("_last"),
        )
        .select(group, "list", "name", "_last.*", "first_seen")
    )


def registry_count(registry: DataFrame) -> DataFrame:
    return registry.agg(F.count(F.lit(1)).alias("n_companies"))


def registry_sample(registry: DataFrame, n: int = 5) -> DataFrame:
    """The first `n` companies by id."""
    return registry.orderBy("id").limit(n)


def registry_types(spark: SparkSession, registry: DataFrame) -> DataFrame:
    """`column_name, data_type` of the registry, from its schema."""
    rows = [(f.name, f.dataType.simpleString()) for f in registry.schema.fields]
    return spark.createDataFrame(rows, "column_name string, data_type string")


def import_summary(rows: DataFrame, notes: DataFrame) -> DataFrame:
    """`reason, n_rows`: rows read, rows imported, and each reason of the notes."""
    named = F.coalesce("company_name", F.lit("")) != ""
    totals = rows.agg(
        F.count(F.lit(1)).alias("read"), F.count_if(named).alias("prepared")
    ).unpivot([], ["read", "prepared"], "reason", "n_rows")
    return totals.unionByName(notes.groupBy("reason").agg(F.count(F.lit(1)).alias("n_rows")))
