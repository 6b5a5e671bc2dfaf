"""The company registry: import, updates, checks and searches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stewardry.functions.urls import normalize_website, website_or_placeholder
from stewardry.operators.spread import join_hot, shuffled_if_large
from stewardry.schemas import MEMBERS, REGISTRY, REGISTRY_COLUMNS, REGISTRY_LENGTHS, SOURCE_TAGS
from stewardry.session import written

_ID_BUCKETS = 4096


# --- import -----------------------------------------------------------------

def split_rows(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows with a company name, and the others with the reason."""
    named = F.coalesce("company_name", F.lit("")) != ""
    return (
        rows.filter(named),
        rows.filter(~named).withColumn("reason", F.lit("Empty company name")),
    )


def prepare_companies(rows: DataFrame) -> DataFrame:
    """Rows ready for the registry: named, with a usable site, text never NULL."""
    accepted, _ = split_rows(rows)
    return (
        accepted.withColumn("website", website_or_placeholder("website", "company_name"))
        .withColumn("ticker", F.coalesce("ticker", F.lit("")))
        .withColumn("exchange", F.coalesce("exchange", F.lit("")))
    )


def import_notes(rows: DataFrame) -> DataFrame:
    """`row_no, reason` of the rows that were left out or given a placeholder site."""
    named = F.coalesce("company_name", F.lit("")) != ""
    reason = F.when(~named, F.lit("Empty company name")).when(
        normalize_website("website").isNull(), F.lit("Using placeholder website")
    )
    return rows.select("row_no", reason.alias("reason")).filter(F.col("reason").isNotNull())


def number_new(df: DataFrame, key: str, name: str, start: Column) -> DataFrame:
    """Numbers rows `start + 1, start + 2, ...` without gaps; `key` is unique.

    Rows are numbered inside hash buckets of the key, each bucket after the ones before
    it, so that the numbering is the same on every run and never passes through one
    task. The bucket sizes are at most `_ID_BUCKETS` rows and therefore broadcast.
    """
    bucket = (
        F.conv(F.substr(F.md5(F.col(key)), F.lit(1), F.lit(8)), 16, 10).cast("long") % _ID_BUCKETS
    )
    rows = df.withColumn("_bucket", bucket)
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        rows.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_size"))
        .select("_bucket", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_before"))
    )
    in_bucket = F.row_number().over(Window.partitionBy("_bucket").orderBy(key))
    return (
        rows.withColumn("_n", in_bucket)
        .join(F.broadcast(offsets), "_bucket")
        .withColumn(name, start + F.col("_before") + F.col("_n"))
        .drop("_bucket", "_n", "_before")
    )


def upsert_companies(
    registry: DataFrame, incoming: DataFrame, now: Column, order: str = "row_no"
) -> DataFrame:
    """The registry after an import.

    A known name gets the new website, ticker and exchange and keeps everything else; a
    new name is added with empty lists and the next free id. Of several incoming rows
    with one name the last by `order` counts.
    """
    latest = incoming.groupBy("company_name").agg(
        F.max_by(F.struct("website", "ticker", "exchange"), F.col(order)).alias("_new")
    )
    marked = add_missing_columns(registry).withColumn("_known", F.lit(True))
    # one join for both, written as the numbering goes over it more than once
    both = written(marked.join(latest, "company_name", "full_outer"), "upsert")
    known, is_new = both.filter("_known"), F.col("_new").isNotNull()
    kept = known.withColumns({
        **{c: F.when(is_new, F.col(f"_new.{c}")).otherwise(F.col(c)) for c in ("website", "ticker", "exchange")},
        "updated_at": F.when(is_new, now).otherwise(F.col("updated_at")),
    })
    fresh = both.filter(F.col("_known").isNull()).select("company_name", "_new")
    highest = F.coalesce(known.agg(F.max("id")).scalar(), F.lit(0))
    added = number_new(fresh, "company_name", "id", highest).select(
        "id", "company_name", "_new.*",
        F.array().cast(MEMBERS).alias("officers"),
        F.array().cast(MEMBERS).alias("board_members"),
        F.struct(F.lit(None).alias("officers"), F.lit(None).alias("board_members"))
        .cast(SOURCE_TAGS).alias("data_source"),
        now.alias("created_at"), now.alias("updated_at"),
    )
    columns = [f.name for f in REGISTRY.fields]
    return kept.select(*columns).unionByName(add_missing_columns(added).select(*columns))


def duplicate_names(incoming: DataFrame) -> DataFrame:
    """`company_name, n_rows` of the names that occur more than once."""
    counted = incoming.groupBy("company_name").agg(F.count(F.lit(1)).alias("n_rows"))
    return counted.filter(F.col("n_rows") > 1)


# --- updates ----------------------------------------------------------------

def _latest_updates(updates: DataFrame, order: str) -> DataFrame:
    """One row per id; each list and tag is the last one given."""
    at = F.col(order)

    def last(column: str) -> Column:
        value = F.col(column)
        return F.max_by(value, F.when(value.isNotNull(), at))

    wanted = ("officers", "board_members", "officers_source", "board_members_source")
    present = [c for c in wanted if c in updates.columns]
    return updates.groupBy("id").agg(*(last(c).alias(f"_{c}") for c in present))


def update_management(
    registry: DataFrame, updates: DataFrame, now: Column, order: str = "seq"
) -> DataFrame:
    """The registry with lists replaced for the ids in `updates`.

    `updates` has `id`, `order` and any of `officers`, `board_members` (NULL = leave) with
    the tags `officers_source`, `board_members_source`. Unknown ids do nothing.
    """
    latest = _latest_updates(updates, order)
    touched = F.col("_touched")
    result = registry.join(shuffled_if_large(latest.withColumn("_touched", F.lit(True))), "id", "left")
    for column in ("officers", "board_members"):
        if f"_{column}" in latest.columns:
            result = result.withColumn(column, F.coalesce(f"_{column}", column))
        if f"_{column}_source" in latest.columns:
            tags = F.col("data_source")
            result = result.withColumn(
                "data_source",
                tags.withField(
                    column, F.coalesce(F.col(f"_{column}_source"), tags[column])
                ),
            )
    result = result.withColumn("updated_at", F.when(touched, now).otherwise(F.col("updated_at")))
    return result.select(*registry.columns)


def _tagged(updates: DataFrame, columns: tuple[str, ...], source: str) -> DataFrame:
    for column in columns:
        updates = updates.withColumn(f"{column}_source", F.lit(source))
    return updates


def update_officers(
    registry: DataFrame, updates: DataFrame, source: str, now: Column, order: str = "seq"
) -> DataFrame:
    """Officer lists of the given ids replaced and tagged; boards are left alone."""
    chosen = _tagged(updates.select("id", order, "officers"), ("officers",), source)
    return update_management(registry, chosen, now, order)


def update_board(
    registry: DataFrame, updates: DataFrame, source: str, now: Column, order: str = "seq"
) -> DataFrame:
    """Board lists of the given ids replaced and tagged; officers are left alone."""
    chosen = _tagged(updates.select("id", order, "board_members"), ("board_members",), source)
    return update_management(registry, chosen, now, order)


def update_local(
    registry: DataFrame, updates: DataFrame, column: str, now: Column,
    preserve_other: bool = True, order: str = "seq",
) -> DataFrame:
    """One list replaced with tag `local`; `preserve_other=False` empties the other one
    and tags both."""
    other = {"officers": "board_members", "board_members": "officers"}[column]
    chosen = _tagged(updates.select("id", order, column), (column,), "local")
    if not preserve_other:
        chosen = _tagged(chosen.withColumn(other, F.array().cast(MEMBERS)), (other,), "local")
    return update_management(registry, chosen, now, order)


def update_data_source(
    registry: DataFrame, updates: DataFrame, now: Column, order: str = "seq"
) -> DataFrame:
    """Both tags replaced by the `data_source` of the last update of each id."""
    latest = updates.groupBy("id").agg(F.max_by("data_source", order).alias("_tags"))
    touched = F.col("_tags").isNotNull()
    return (
        registry.join(shuffled_if_large(latest), "id", "left")
        .withColumn("data_source", F.coalesce("_tags", "data_source"))
        .withColumn("updated_at", F.when(touched, now).otherwise(F.col("updated_at")))
        .select(*registry.columns)
    )


def replace_people(people: DataFrame, found: DataFrame) -> DataFrame:
    """The exploded people table after an update: companies in `found` are replaced.

    The row-wise form of `update_management`, for companies with more people than one
    array should hold.
    """
    updated = found.select("company_id").distinct()
    kept = join_hot(people, updated, "company_id", F.struct(*people.columns), how="left_anti")
    return kept.select(*people.columns).unionByName(found.select(*people.columns))


def add_missing_columns(registry: DataFrame) -> DataFrame:
    """The registry with every column it lacks, set to its default."""
    empty = F.array().cast(MEMBERS)
    defaults = {
        "officers": empty,
        "board_members": empty,
        "data_source": F.struct(
            F.lit("local").alias("officers"), F.lit("local").alias("board_members")
        ),
    }
    for field in REGISTRY.fields:
        if field.name not in registry.columns:
            value = defaults.get(field.name, F.lit(None))
            registry = registry.withColumn(field.name, value.cast(field.dataType))
    return registry


# --- checks -----------------------------------------------------------------

def validate_registry(registry: DataFrame) -> DataFrame:
    """`rule, value, n_rows`: every broken rule with the value that breaks it.

    One pass: a row gives an entry for each rule it breaks, and one for each value that
    must be unique; entries are counted before they are shuffled, and of the latter those
    that came once are dropped.
    """
    entries = []
    for column in ("website", "company_name"):
        entries.append(F.when(F.col(column).isNull(), _violation(f"{column} is null", F.lit(None))))
        entries.append(F.when(F.col(column).isNotNull(), _violation(f"{column} is not unique", F.col(column), least=2)))
    for column, limit in REGISTRY_LENGTHS.items():
        too_long = F.length(column) > limit
        entries.append(F.when(too_long, _violation(f"{column} is too long", F.col(column))))
    rows = registry.select(F.explode(F.filter(F.array(*entries), lambda v: v.isNotNull())).alias("v"))
    counted = rows.groupBy("v.rule", "v.value", "v.least").agg(F.count(F.lit(1)).alias("n_rows"))
    return counted.filter(F.col("n_rows") >= F.col("least")).drop("least")


def _violation(rule: str, value: Column, least: int = 1) -> Column:
    return F.struct(F.lit(rule).alias("rule"), value.cast(T.StringType()).alias("value"), F.lit(least).alias("least"))


def orphan_people(people: DataFrame, registry: DataFrame) -> DataFrame:
    """People whose `company_id` is not in the registry."""
    known = registry.select(F.col("id").alias("company_id"))
    return join_hot(people, known, "company_id", F.struct(*people.columns), how="left_anti").select(*people.columns)


# --- searches ---------------------------------------------------------------

def _same(column: str, value: str, any_case: bool) -> Column:
    if any_case:
        return F.lower(column) == value.lower()
    return F.col(column) == value


def company_by_name(registry: DataFrame, name: str, any_case: bool = False) -> DataFrame:
    return registry.filter(_same("company_name", name, any_case)).select(*REGISTRY_COLUMNS)


def company_by_website(registry: DataFrame, website: str) -> DataFrame:
    return registry.filter(F.col("website") == website).select(*REGISTRY_COLUMNS)


def companies_by_ticker(registry: DataFrame, ticker: str) -> DataFrame:
    return registry.filter(_same("ticker", ticker, True)).select(*REGISTRY_COLUMNS)


def companies_by_exchange(registry: DataFrame, exchange: str) -> DataFrame:
    return registry.filter(F.col("exchange") == exchange).select(*REGISTRY_COLUMNS)


def companies_by_url(registry: DataFrame, urls: DataFrame) -> DataFrame:
    """The companies of the given `website` values."""
    return registry.join(urls.select("website").distinct(), "website", "left_semi").select(*REGISTRY_COLUMNS)


def companies_by_officer(registry: DataFrame, name: str) -> DataFrame:
    """Companies with an officer of exactly that name, in name order."""
    found = F.exists("officers", lambda m: m["name"] == name)
    return registry.filter(found).select(*REGISTRY_COLUMNS).orderBy("company_name")


def companies_by_role(registry: DataFrame, role: str) -> DataFrame:
    """Companies with an officer or board member of exactly that title, in name order."""
    found = F.exists("officers", lambda m: m["title"] == role) | F.exists(
        "board_members", lambda m: m["title"] == role
    )
    return registry.filter(found).select(*REGISTRY_COLUMNS).orderBy("company_name")


def _members(registry: DataFrame, column: str, prefix: str) -> DataFrame:
    name = f"{prefix}_name"
    return (
        registry.select(
            "company_name", F.col("data_source")[column].alias("data_source"),
            F.explode(column).alias("_member"),
        )
        .select(
            "company_name", F.col("_member.name").alias(name),
            F.col("_member.title").alias(f"{prefix}_title"), "data_source",
        )
        .orderBy("company_name", name)
    )


def all_officers(registry: DataFrame) -> DataFrame:
    """One row per officer, by company and name."""
    return _members(registry, "officers", "officer")


def all_board_members(registry: DataFrame) -> DataFrame:
    """One row per board member, by company and name."""
    return _members(registry, "board_members", "member")
