"""Queries that join pages, people, companies and model answers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import expected, inputs, sql
from checks.registered import query
from stewardry.operators import matching, people, responses
from stewardry.operators.reports import files_per_domain

LISTING, COMPANIES = inputs.LISTING, inputs.COMPANIES
COUNTS = f"SELECT {sql.domain('url')} AS domain, count(*) AS n_files FROM pages WHERE {sql.domain('url')} <> '' GROUP BY 1"
# Names that also hold other hosts: redirects and longer hosts.
REDIRECTS = f"SELECT replace(object_name, '.json', '%3Fto%3Dx.' || {inputs.HOST.replace('url', 'other')} || '.json') AS object_name FROM (SELECT l.object_name, p.url AS other FROM ({LISTING}) l JOIN pages p ON p.page_id = l.page_id + 1)"


def _input(spark: SparkSession, sf_dir: str, text: str) -> DataFrame:
    return inputs.spark_input(spark, sf_dir, text)


_ALLOWED = f"NOT {sql.any_of('object_name', expected.EXCLUDED_BY_MATCHER)}"


@query(f"""
SELECT c.company_name, c.website, l.object_name FROM ({COMPANIES}) c JOIN ({LISTING}) l
  ON {sql.domain('c.website')} = {sql.domain('l.url')} WHERE {sql.domain('c.website')} <> '' AND {_ALLOWED}""")
def pages_for_company(spark: SparkSession, sf_dir: str) -> DataFrame:
    matched = matching.pages_for_company(_input(spark, sf_dir, LISTING), _input(spark, sf_dir, COMPANIES))
    return matched.select("company_name", "website", "object_name")


@query(f"""
WITH c AS (SELECT company_name, {sql.plain_domain('website')} AS domain FROM ({COMPANIES})),
l AS (SELECT object_name FROM ({LISTING}) UNION ALL SELECT object_name FROM ({REDIRECTS}))
SELECT company_name, domain, object_name FROM c JOIN l ON contains(object_name, domain) WHERE domain <> '' AND {_ALLOWED}""")
def pages_holding_domain(spark: SparkSession, sf_dir: str) -> DataFrame:
    listing = _input(spark, sf_dir, LISTING).select("object_name").unionByName(_input(spark, sf_dir, REDIRECTS))
    matched = matching.pages_for_company(listing, _input(spark, sf_dir, COMPANIES), mode="contains")
    return matched.select("company_name", "domain", "object_name")


@query(f"""
SELECT c.company_name, c.website, {sql.domain('c.website')} AS domain, coalesce(n_files, 0) AS n_files
FROM ({COMPANIES}) c LEFT JOIN ({COUNTS}) n ON n.domain = {sql.domain('c.website')}""")
def company_file_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = files_per_domain(_input(spark, sf_dir, LISTING))
    counted = matching.company_file_counts(_input(spark, sf_dir, COMPANIES), counts)
    return counted.select("company_name", "website", "domain", "n_files")


_OWNERS = f"SELECT id, company_name, website FROM ({inputs.registry('duck')})"
_TITLES = ", ".join(f"({sql.quoted(t)})" for t in expected.LEADING_TITLES)
_PATTERN = f"title || '\\s+{expected.NAME_AFTER_TITLE}'"
_OFFICERS = f"""
SELECT {sql.netloc('url')} AS domain, substr(m, length(title) + 2) AS name, title
FROM (SELECT url, title, unnest(regexp_extract_all(trim(regexp_replace(body_text, '\\s+', ' ', 'g')), {_PATTERN})) AS m
      FROM ({inputs.TITLED_TEXT}), (VALUES {_TITLES}) AS x(title))"""


def _officers(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = people.officers_by_domain(_input(spark, sf_dir, inputs.TITLED_TEXT))
    return found.select("domain", "name", "title")


@query(f"""
SELECT o.domain, o.name, o.title, c.id AS company_id, c.company_name FROM ({_OFFICERS}) o
JOIN ({_OWNERS}) c ON replace(o.domain, 'www.', '') = {sql.domain('c.website')}""")
def officers_to_company(spark: SparkSession, sf_dir: str) -> DataFrame:
    owners = _input(spark, sf_dir, inputs.registry("spark"))
    return matching.officers_to_company(_officers(spark, sf_dir), owners)


@query(f"""
SELECT o.domain, count(*) AS n_officers FROM ({_OFFICERS}) o
WHERE replace(o.domain, 'www.', '') NOT IN (SELECT {sql.domain('website')} FROM ({_OWNERS})) GROUP BY 1""")
def unmatched_domains(spark: SparkSession, sf_dir: str) -> DataFrame:
    owners = _input(spark, sf_dir, inputs.registry("spark"))
    return matching.unmatched_domains(_officers(spark, sf_dir), owners)


@query("SELECT c_custkey, c_name FROM customer WHERE c_custkey IN (SELECT c_custkey FROM customer ORDER BY c_custkey LIMIT 5)")
def sample_semi(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matching.sample_semi(inputs.table(spark, sf_dir, "customer"), "c_custkey").select("c_custkey", "c_name")


_TABLE_PEOPLE = f"SELECT page_id * 2 AS company_id, seq, name, role FROM ({inputs.PEOPLE_ROWS})"


@query(f"SELECT p.seq, p.name, p.role, p.company_id, c.company_name FROM ({_TABLE_PEOPLE}) p JOIN ({_OWNERS}) c ON c.id = p.company_id")
def people_to_company(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matching.people_to_company(_input(spark, sf_dir, _TABLE_PEOPLE), _input(spark, sf_dir, inputs.registry("spark")))


@query(f"""
SELECT c.company_name, coalesce(n_files, 0) AS n_files,
       CASE WHEN c.id IS NULL THEN 'no id' WHEN c.website IS NULL THEN 'no website' WHEN n_files IS NULL THEN 'no files' END AS skip_reason
FROM ({COMPANIES}) c LEFT JOIN ({COUNTS}) n ON n.domain = {sql.domain('c.website')}""")
def company_pages_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = files_per_domain(_input(spark, sf_dir, LISTING))
    gated = matching.company_pages_gate(_input(spark, sf_dir, COMPANIES), counts)
    return gated.select("company_name", "n_files", "skip_reason")


# --- model answers ----------------------------------------------------------

_PROMPT = expected.PROMPT_TEMPLATE.format(company="\x01", text="\x02")


@query(f"SELECT doc_id, replace(replace({sql.quoted(_PROMPT)}, chr(1), source), chr(2), text) AS prompt FROM documents")
def llm_prompt(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = inputs.table(spark, sf_dir, "documents")
    return docs.select("doc_id", responses.model_prompt("source", "text").alias("prompt"))


_LISTS = '{"officers": [{"name": "VARCHAR", "title": "VARCHAR", "bio": "VARCHAR"}], "board_members": [{"name": "VARCHAR", "title": "VARCHAR", "bio": "VARCHAR"}]}'
_PARSED = f"""(SELECT id, company_name, CASE WHEN json_valid(response) THEN from_json(response, '{_LISTS}') END AS r FROM ({inputs.RESPONSES}))"""


def _flat(lists: str) -> str:
    return f"array_to_string(list_transform(coalesce({lists}, []), lambda m: coalesce(m.name, '?') || '/' || coalesce(m.title, '?')), ';')"


def _flat_column(column: str):
    item = lambda m: F.concat(F.coalesce(m["name"], F.lit("?")), F.lit("/"), F.coalesce(m["title"], F.lit("?")))
    return F.array_join(F.transform(column, item), ";").alias(column.split(".")[-1])


@query(f"SELECT id, {_flat('r.officers')} AS officers, {_flat('r.board_members')} AS board_members FROM {_PARSED}")
def parse_llm_response(spark: SparkSession, sf_dir: str) -> DataFrame:
    answers = _input(spark, sf_dir, inputs.RESPONSES)
    parsed = answers.select("id", responses.parse_response("response").alias("r")).select("id", "r.*")
    return parsed.select("id", _flat_column("officers"), _flat_column("board_members"))


_PEOPLE_OF = "SELECT id, '{0}' AS category, coalesce(m.name, '') AS name, coalesce(m.title, '') AS title, coalesce(m.bio, '') AS bio FROM (SELECT id, unnest(r.{0}) AS m FROM {1})"


@query(_PEOPLE_OF.format("officers", _PARSED) + " UNION ALL " + _PEOPLE_OF.format("board_members", _PARSED))
def flatten_llm_people(spark: SparkSession, sf_dir: str) -> DataFrame:
    answers = _input(spark, sf_dir, inputs.RESPONSES).select("id", "response")
    return responses.flatten_response(answers)


_REG = f"({inputs.registry('duck')})"


def _key_positions(officers: str, board: str) -> str:
    return (
        f"(len(list_filter({officers}, lambda m: lower(m.title) IN {sql.strings(expected.CHIEF_TITLES)})) > 0"
        f" AND len(list_filter({board}, lambda m: lower(m.title) IN {sql.strings(expected.CHAIR_TITLES)})) > 0)"
    )


@query(f"SELECT id, {_key_positions('officers', 'board_members')} AS complete FROM {_REG}")
def has_key_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    registry = _input(spark, sf_dir, inputs.registry("spark"))
    return registry.select("id", responses.has_key_positions("officers", "board_members").alias("complete"))


def _union(own: str, other: str) -> str:
    """Both lists, each entry once, in order of first appearance."""
    both = f"list_concat({own}, coalesce(list_transform({other}, lambda m: {{'name': m.name, 'title': m.title}}), []))"
    return f"list_filter({both}, lambda m, i: list_position({both}, m) = i)"


@query(f"""
SELECT g.id, CASE WHEN complete THEN {_flat('g.officers')} ELSE {_flat(_union('g.officers', 'r.officers'))} END AS officers,
       CASE WHEN complete THEN {_flat('g.board_members')} ELSE {_flat(_union('g.board_members', 'r.board_members'))} END AS board_members,
       CASE WHEN complete THEN 'local' ELSE 'llm' END AS source
FROM (SELECT *, {_key_positions('officers', 'board_members')} AS complete FROM {_REG}) g JOIN {_PARSED} p ON p.id = g.id""")
def local_then_llm(spark: SparkSession, sf_dir: str) -> DataFrame:
    registry = _input(spark, sf_dir, inputs.registry("spark")).select("id", "officers", "board_members")
    combined = responses.local_then_model(registry, _input(spark, sf_dir, inputs.RESPONSES))
    return combined.select(
        "id", _flat_column("officers"), _flat_column("board_members"), F.col("data_source.officers").alias("source")
    )
