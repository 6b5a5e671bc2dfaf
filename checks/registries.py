"""Queries over the company registry."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import inputs, sql
from checks.registered import query
from stewardry.operators import registry as R
from stewardry.operators import reports
from stewardry.plans.importing import import_companies

ROWS = inputs.COMPANY_ROWS
REG = f"({inputs.registry('duck')})"
NOW = "2025-06-01 12:00:00"

# The registry before the import: companies whose account is in credit.
_OLD = f"SELECT r.* FROM {{}} r JOIN customer c ON c.c_custkey = r.id - 1 WHERE c.c_acctbal > 4000"


def _old(dialect: str) -> str:
    return _OLD.format(f"({inputs.registry(dialect)})")


def _registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.spark_input(spark, sf_dir, inputs.registry("spark"))


def _rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.spark_input(spark, sf_dir, ROWS)


def _now():
    return F.lit(NOW).cast("timestamp")


def _names(lists: str) -> str:
    return f"array_to_string(list_transform({lists}, lambda m: m.name || '/' || m.title), ';')"


def _names_column(column: str):
    return F.array_join(F.transform(column, lambda m: F.concat(m["name"], F.lit("/"), m["title"])), ";").alias(column)


def _flat(registry: DataFrame) -> DataFrame:
    """Registry columns as plain values."""
    return registry.select(
        "id", "website", "company_name", "ticker", "exchange", "headquarters_location", "description",
        _names_column("officers"), _names_column("board_members"),
        F.col("data_source.officers").alias("officers_source"),
        F.col("data_source.board_members").alias("board_source"),
        F.date_format("updated_at", "yyyy-MM-dd HH:mm:ss").alias("updated_at"),
    )


def _flat_sql(source: str) -> str:
    return f"""SELECT id, website, company_name, ticker, exchange, headquarters_location, description,
       {_names('officers')} AS officers, {_names('board_members')} AS board_members,
       data_source.officers AS officers_source, data_source.board_members AS board_source,
       strftime(updated_at, '%Y-%m-%d %H:%M:%S') AS updated_at FROM {source}"""


# --- import -----------------------------------------------------------------

_NAMED = "coalesce(company_name, '') <> ''"


@query(f"SELECT row_no, website, ticker, 'Empty company name' AS reason FROM ({ROWS}) WHERE NOT {_NAMED}")
def reject_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, rejected = R.split_rows(_rows(spark, sf_dir))
    return rejected.select("row_no", "website", "ticker", "reason")


_PREPARED = f"""SELECT row_no, company_name, {sql.site_or_placeholder('website', 'company_name')} AS website,
       coalesce(ticker, '') AS ticker, coalesce(exchange, '') AS exchange FROM ({ROWS}) WHERE {_NAMED}"""


@query(_PREPARED)
def prepare_companies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.prepare_companies(_rows(spark, sf_dir)).select("row_no", "company_name", "website", "ticker", "exchange")


_UPSERTED = f"""
WITH latest AS (SELECT company_name, arg_max({{'w': website, 't': ticker, 'e': exchange}}, row_no) AS n FROM ({_PREPARED}) GROUP BY 1),
old AS ({_old('duck')}),
kept AS (SELECT id, CASE WHEN n IS NULL THEN website ELSE n.w END AS website, o.company_name,
                CASE WHEN n IS NULL THEN ticker ELSE n.t END AS ticker, CASE WHEN n IS NULL THEN exchange ELSE n.e END AS exchange,
                headquarters_location, description, officers, board_members, data_source,
                CASE WHEN n IS NULL THEN updated_at ELSE TIMESTAMP '{NOW}' END AS updated_at
         FROM old o LEFT JOIN latest l ON l.company_name = o.company_name),
fresh AS (SELECT *, CAST('0x' || substr(md5(company_name), 1, 8) AS BIGINT) % 4096 AS bucket FROM latest
          WHERE company_name NOT IN (SELECT company_name FROM old)),
added AS (SELECT (SELECT max(id) FROM old) + row_number() OVER (ORDER BY bucket, company_name) AS id, n.w AS website, company_name,
                 n.t AS ticker, n.e AS exchange, NULL AS headquarters_location, NULL AS description,
                 {inputs.member_list('duck', [])} AS officers, {inputs.member_list('duck', [])} AS board_members,
                 {inputs.tags('duck', 'CAST(NULL AS VARCHAR)', 'CAST(NULL AS VARCHAR)')} AS data_source, TIMESTAMP '{NOW}' AS updated_at FROM fresh),
result AS (SELECT * FROM kept UNION ALL SELECT * FROM added)
"""


@query(_UPSERTED + _flat_sql("result"))
def upsert_companies(spark: SparkSession, sf_dir: str) -> DataFrame:
    old = inputs.spark_input(spark, sf_dir, _old("spark"))
    result, _ = import_companies(old, _rows(spark, sf_dir), _now())
    return _flat(result)


@query(f"SELECT company_name, count(*) AS n_rows FROM ({_PREPARED}) GROUP BY 1 HAVING count(*) > 1")
def duplicate_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.duplicate_names(R.prepare_companies(_rows(spark, sf_dir)))


@query(f"""
SELECT 'read' AS reason, count(*) AS n_rows FROM ({ROWS}) UNION ALL
SELECT 'prepared', count(*) FROM ({ROWS}) WHERE {_NAMED} UNION ALL
SELECT 'Empty company name', count(*) FROM ({ROWS}) WHERE NOT {_NAMED} UNION ALL
SELECT 'Using placeholder website', count(*) FROM ({ROWS}) WHERE {_NAMED} AND coalesce({sql.stripped('website')}, '') = ''""")
def import_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _rows(spark, sf_dir)
    return reports.import_summary(rows, R.import_notes(rows))


@query(f"""
SELECT row_no, CASE WHEN NOT {_NAMED} THEN 'Empty company name' ELSE 'Using placeholder website' END AS reason
FROM ({ROWS}) WHERE NOT {_NAMED} OR coalesce({sql.stripped('website')}, '') = ''""")
def import_notes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.import_notes(_rows(spark, sf_dir))


# --- updates ----------------------------------------------------------------

UPDATES = inputs.management_updates("duck")
_LAST = f"""
WITH last AS (SELECT id, arg_max(officers, seq) FILTER (WHERE officers IS NOT NULL) AS new_officers,
                     arg_max(board_members, seq) FILTER (WHERE board_members IS NOT NULL) AS new_board FROM ({UPDATES}) GROUP BY id)"""


def _updated(officers: str, board: str, officers_source: str, board_source: str) -> str:
    return f"""{_LAST},
result AS (SELECT r.id, website, company_name, ticker, exchange, headquarters_location, description,
                  {officers} AS officers, {board} AS board_members,
                  {inputs.tags('duck', officers_source, board_source)} AS data_source,
                  CASE WHEN l.id IS NULL THEN updated_at ELSE TIMESTAMP '{NOW}' END AS updated_at
           FROM {REG} r LEFT JOIN last l ON l.id = r.id)
{_flat_sql('result')}"""


_NEW_OFFICERS, _NEW_BOARD = "coalesce(new_officers, officers)", "coalesce(new_board, board_members)"
_OLD_TAGS = ("data_source.officers", "data_source.board_members")


def _updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.spark_input(spark, sf_dir, inputs.management_updates("spark"))


@query(_updated(
    _NEW_OFFICERS, _NEW_BOARD,
    "CASE WHEN l.id IS NOT NULL THEN 'llm' ELSE data_source.officers END",
    "CASE WHEN l.id IS NOT NULL THEN 'llm' ELSE data_source.board_members END",
))
def update_management(spark: SparkSession, sf_dir: str) -> DataFrame:
    updates = _updates(spark, sf_dir).withColumns(
        {"officers_source": F.lit("llm"), "board_members_source": F.lit("llm")}
    )
    return _flat(R.update_management(_registry(spark, sf_dir), updates, _now()))


@query(_updated(_NEW_OFFICERS, "board_members", "CASE WHEN l.id IS NOT NULL THEN 'llm' ELSE data_source.officers END", _OLD_TAGS[1]))
def update_officers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat(R.update_officers(_registry(spark, sf_dir), _updates(spark, sf_dir), "llm", _now()))


@query(_updated("officers", _NEW_BOARD, _OLD_TAGS[0], "CASE WHEN l.id IS NOT NULL THEN 'web_scraping' ELSE data_source.board_members END"))
def update_board(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat(R.update_board(_registry(spark, sf_dir), _updates(spark, sf_dir), "web_scraping", _now()))


@query(_updated(_NEW_OFFICERS, "board_members", "CASE WHEN l.id IS NOT NULL THEN 'local' ELSE data_source.officers END", _OLD_TAGS[1]))
def update_local(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat(R.update_local(_registry(spark, sf_dir), _updates(spark, sf_dir), "officers", _now()))


@query(_updated(
    _NEW_OFFICERS, f"CASE WHEN l.id IS NOT NULL THEN {inputs.member_list('duck', [])} ELSE board_members END",
    "CASE WHEN l.id IS NOT NULL THEN 'local' ELSE data_source.officers END",
    "CASE WHEN l.id IS NOT NULL THEN 'local' ELSE data_source.board_members END",
))
def update_local_alone(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The other list is emptied, as the older behaviour has it."""
    return _flat(R.update_local(
        _registry(spark, sf_dir), _updates(spark, sf_dir), "officers", _now(), preserve_other=False
    ))


def _tag_updates(dialect: str) -> str:
    new = inputs.tags(dialect, "o_orderpriority", "o_orderstatus")
    return f"SELECT o_custkey + 1 AS id, o_orderkey AS seq, {new} AS data_source FROM orders"


@query(f"""
WITH last AS (SELECT id, arg_max(data_source, seq) AS new_tags FROM ({_tag_updates('duck')}) GROUP BY id),
result AS (SELECT r.id, website, company_name, ticker, exchange, headquarters_location, description, officers, board_members,
                  coalesce(new_tags, data_source) AS data_source,
                  CASE WHEN l.id IS NULL THEN updated_at ELSE TIMESTAMP '{NOW}' END AS updated_at FROM {REG} r LEFT JOIN last l ON l.id = r.id)
{_flat_sql('result')}""")
def update_data_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    updates = inputs.spark_input(spark, sf_dir, _tag_updates("spark"))
    return _flat(R.update_data_source(_registry(spark, sf_dir), updates, _now()))


_TOUCHED = f"SELECT id, strftime(CASE WHEN id IN (SELECT id FROM ({UPDATES})) THEN TIMESTAMP '{NOW}' ELSE updated_at END, '%Y-%m-%d %H:%M:%S') AS updated_at FROM {REG}"


@query(_TOUCHED)
def touch_updated_at(spark: SparkSession, sf_dir: str) -> DataFrame:
    updated = R.update_management(_registry(spark, sf_dir), _updates(spark, sf_dir), _now())
    return updated.select("id", F.date_format("updated_at", "yyyy-MM-dd HH:mm:ss").alias("updated_at"))


_TABLE = f"SELECT page_id AS company_id, name, role FROM ({inputs.PEOPLE_ROWS})"
_FOUND = f"SELECT page_id AS company_id, name, 'New ' || role AS role FROM ({inputs.PEOPLE_ROWS}) WHERE role = 'Board Member'"


@query(f"SELECT * FROM ({_TABLE}) WHERE company_id NOT IN (SELECT company_id FROM ({_FOUND})) UNION ALL SELECT * FROM ({_FOUND})")
def replace_people(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.replace_people(inputs.spark_input(spark, sf_dir, _TABLE), inputs.spark_input(spark, sf_dir, _FOUND))


@query(f"""
SELECT id, website, company_name, 0 AS n_officers, 0 AS n_board, 'local' AS officers_source, 'local' AS board_source FROM {REG}""")
def add_missing_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    bare = _registry(spark, sf_dir).select("id", "website", "company_name")
    return R.add_missing_columns(bare).select(
        "id", "website", "company_name", F.size("officers").alias("n_officers"), F.size("board_members").alias("n_board"),
        F.col("data_source.officers").alias("officers_source"), F.col("data_source.board_members").alias("board_source"),
    )


# --- checks -----------------------------------------------------------------

_FAULTY = f"SELECT row_no AS id, website, company_name, CASE WHEN row_no % 50 = 1 THEN repeat('T', 51) ELSE ticker END AS ticker, exchange, CAST(NULL AS STRING) AS headquarters_location FROM ({ROWS})"


@query(f"""
WITH r AS ({_FAULTY})
SELECT 'website is null' AS rule, CAST(NULL AS VARCHAR) AS value, count(*) AS n_rows FROM r WHERE website IS NULL UNION ALL
SELECT 'company_name is null', NULL, count(*) FROM r WHERE company_name IS NULL UNION ALL
SELECT 'ticker is too long', ticker, count(*) FROM r WHERE length(ticker) > 50 GROUP BY ticker UNION ALL
SELECT 'website is not unique', website, count(*) FROM r WHERE website IS NOT NULL GROUP BY website HAVING count(*) > 1 UNION ALL
SELECT 'company_name is not unique', company_name, count(*) FROM r WHERE company_name IS NOT NULL GROUP BY company_name HAVING count(*) > 1""")
def validate_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.validate_registry(inputs.spark_input(spark, sf_dir, _FAULTY))


_TABLE_PEOPLE = f"SELECT page_id * 2 AS company_id, seq, name FROM ({inputs.PEOPLE_ROWS})"


@query(f"SELECT company_id, seq, name FROM ({_TABLE_PEOPLE}) WHERE company_id NOT IN (SELECT id FROM {REG})")
def orphan_people(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.orphan_people(inputs.spark_input(spark, sf_dir, _TABLE_PEOPLE), _registry(spark, sf_dir))


# --- searches ---------------------------------------------------------------

_SHOWN = ["id", "company_name", "website", "ticker", "exchange"]


def _search(name: str, condition: str, find) -> None:
    def build(spark: SparkSession, sf_dir: str) -> DataFrame:
        return find(_registry(spark, sf_dir)).select(*_SHOWN)

    query(f"SELECT {', '.join(_SHOWN)} FROM {REG} WHERE {condition}", name)(build)


def _has(column: str, key: str, value: str) -> str:
    return f"len(list_filter({column}, lambda m: m.{key} = '{value}')) > 0"


_search("company_by_name", "company_name = 'Customer#000000042'", lambda r: R.company_by_name(r, "Customer#000000042"))
_search("company_by_name_any_case", "lower(company_name) = 'customer#000000042'",
        lambda r: R.company_by_name(r, "CUSTOMER#000000042", any_case=True))
_search("company_by_website", "website = 'https://corp77.example.com'",
        lambda r: R.company_by_website(r, "https://corp77.example.com"))
_search("companies_by_ticker", "lower(ticker) = 't15'", lambda r: R.companies_by_ticker(r, "t15"))
_search("companies_by_exchange", "exchange = 'TSX'", lambda r: R.companies_by_exchange(r, "TSX"))
_search("companies_by_officer", _has("officers", "name", "Ann Moore"), lambda r: R.companies_by_officer(r, "Ann Moore"))
_search("companies_by_role", _has("officers", "title", "Chairman") + " OR " + _has("board_members", "title", "Chairman"),
        lambda r: R.companies_by_role(r, "Chairman"))

_WANTED = "SELECT 'https://corp' || CAST(o_custkey AS STRING) || '.example.com' AS website FROM orders WHERE o_totalprice > 400000"


@query(f"SELECT {', '.join(_SHOWN)} FROM {REG} WHERE website IN ({_WANTED})")
def companies_by_url(spark: SparkSession, sf_dir: str) -> DataFrame:
    wanted = inputs.spark_input(spark, sf_dir, _WANTED)
    return R.companies_by_url(_registry(spark, sf_dir), wanted).select(*_SHOWN)


def _members_sql(column: str, prefix: str) -> str:
    return f"SELECT company_name, m.name AS {prefix}_name, m.title AS {prefix}_title, data_source FROM (SELECT company_name, unnest({column}) AS m, data_source.{column} AS data_source FROM {REG})"


@query(_members_sql("officers", "officer"))
def all_officers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.all_officers(_registry(spark, sf_dir))


@query(_members_sql("board_members", "member"))
def all_board_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.all_board_members(_registry(spark, sf_dir))
