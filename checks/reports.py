"""Queries that count, summarise, write and stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import inputs, sql
from checks.matches import COUNTS
from checks.registered import query
from stewardry.operators import reports
from stewardry.operators.registry import add_missing_columns
from stewardry.operators.structure import json_structure as structure
from stewardry.plans.coverage import coverage, top_covered
from stewardry.plans.extraction import process_pages
from stewardry.plans.reporting import company_people_table as people_table
from stewardry.plans.reporting import company_reports
from stewardry.schemas import REGISTRY
from stewardry.session import scratch_path
from stewardry.sinks import summaries, tables
from stewardry.streaming.ingest import ingest_new_pages

LISTING, COMPANIES = inputs.LISTING, inputs.COMPANIES


def _input(spark: SparkSession, sf_dir: str, text: str) -> DataFrame:
    return inputs.spark_input(spark, sf_dir, text)


def _coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return coverage(_input(spark, sf_dir, COMPANIES), _input(spark, sf_dir, LISTING))


@query(COUNTS)
def files_per_domain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.files_per_domain(_input(spark, sf_dir, LISTING))


_COVERED = f"SELECT c.id, c.company_name, c.website, coalesce(n_files, 0) AS n_files FROM ({COMPANIES}) c LEFT JOIN ({COUNTS}) n ON n.domain = {sql.domain('c.website')}"


@query(f"SELECT count(*) AS n_companies, count(website) AS n_with_website, count(*) FILTER (WHERE n_files > 0) AS n_with_files FROM ({_COVERED})")
def domain_coverage_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.coverage_report(_coverage(spark, sf_dir))


@query(f"SELECT company_name, website, n_files FROM ({_COVERED}) ORDER BY n_files DESC, company_name, website LIMIT 20")
def top_companies_by_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_covered(_input(spark, sf_dir, COMPANIES), _input(spark, sf_dir, LISTING))


_EXCHANGES = f"SELECT exchange, count(*) AS n_companies FROM ({inputs.COMPANY_ROWS}) WHERE coalesce(exchange, '') <> '' GROUP BY 1"


@query(_EXCHANGES)
def exchange_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.exchange_counts(_input(spark, sf_dir, inputs.COMPANY_ROWS))


@query(_EXCHANGES)
def exchange_counts_largest_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.exchange_counts(_input(spark, sf_dir, inputs.COMPANY_ROWS), by="count")


@query(f"""
SELECT count(nullif(exchange, '')) AS n_with_exchange, count(*) - count(nullif(exchange, '')) AS n_without_exchange,
       count(DISTINCT nullif(exchange, '')) AS n_exchanges FROM ({inputs.COMPANY_ROWS})""")
def exchange_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.exchange_totals(_input(spark, sf_dir, inputs.COMPANY_ROWS))


# --- people of companies ----------------------------------------------------

_OWNERS = f"SELECT id, company_name, website FROM ({inputs.registry('duck')})"
_CTES = sql.processed_ctes()
_SUMMARY = f"""
per_page AS (SELECT url, count(*) AS n FROM final GROUP BY url),
per_domain AS (SELECT {sql.domain('url')} AS domain, count(*) AS processed_files, CAST(sum(n) AS BIGINT) AS total_people FROM per_page GROUP BY 1),
summary AS (SELECT id, company_name, {sql.domain('website')} AS domain, coalesce(processed_files, 0) AS processed_files,
                   coalesce(total_people, 0) AS total_people FROM ({_OWNERS}) o LEFT JOIN per_domain d ON d.domain = {sql.domain('o.website')})"""
_UNIQUE = f"""
placed AS (SELECT {sql.domain('url')} AS domain, name, role, email, phone, url,
                  row_number() OVER (PARTITION BY url ORDER BY CASE list WHEN 'executive' THEN 0 ELSE 1 END, pos) AS seq FROM final),
chosen AS (SELECT *, CASE WHEN role IN {sql._EXEC} THEN 'executive' WHEN role IN {sql._BOARD} THEN 'board' END AS list FROM placed),
uniq AS (SELECT domain, list, name, arg_max({{'r': role, 'e': email, 'p': phone}}, {{'u': url, 's': seq}}) AS l,
                min({{'u': url, 's': seq}}) AS first_seen FROM chosen WHERE list IS NOT NULL GROUP BY domain, list, name)"""


def _processed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return process_pages(_input(spark, sf_dir, inputs.COMPANY_PAGES))


def _registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _input(spark, sf_dir, inputs.registry("spark"))


@query(f"WITH {_CTES},{_SUMMARY} SELECT * FROM summary")
def company_people_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.company_people_summary(_processed(spark, sf_dir), _registry(spark, sf_dir))


@query(f"WITH {_CTES},{_UNIQUE} SELECT domain, list, name, l.r AS role, l.e AS email, l.p AS phone FROM uniq")
def unique_people(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.unique_people(reports.found_people(_processed(spark, sf_dir))).drop("first_seen")


@query(f"""WITH {_CTES}
SELECT o.id AS company_id, f.name, f.role, f.email, f.phone, f.url AS source_url, t.title AS source_title
FROM final f JOIN texts t ON t.page_id = f.page_id JOIN ({_OWNERS}) o ON {sql.domain('o.website')} = {sql.domain('f.url')}""")
def company_people_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return people_table(_processed(spark, sf_dir), _registry(spark, sf_dir))


# --- documents and tables ---------------------------------------------------

_DOCS = f"""
SELECT event_id, '{{"id": ' || {inputs.text('event_id')} || ', "type": "' || event_type || '", "value": ' || {inputs.text('value')}
       || ', "user": {{"id": ' || {inputs.text('user_id')} || ', "tags": ["a", 1], "none": null}}, "props": ' || props
       || ', "rows": [{{"x": [[1.5, 2]]}}, {{"y": 1}}], "empty": [], "ok": true, "nan": '
       || CASE WHEN event_id % 2 = 0 THEN 'NaN' ELSE '1' END || '}}' AS doc FROM events"""
_PATHS = [
    ("id", "int"), ("type", "str"), ("user", "dict"), ("user.id", "int"), ("user.tags", "list"), ("user.tags", "list[str]"),
    ("user.none", "NoneType"), ("props", "dict"), ("props.k", "int"), ("rows", "list"), ("rows", "list[dict]"),
    ("rows.x", "list"), ("rows.x", "list[list]"), ("rows.x", "list[float]"), ("empty", "list"), ("empty", "list[empty]"), ("ok", "bool"),
]


@query(" UNION ALL ".join(f"SELECT '{p}' AS path, '{t}' AS type, count(*) AS n FROM events" for p, t in _PATHS) + """
UNION ALL SELECT 'value', 'float', count(*) FROM events
UNION ALL SELECT 'nan', CASE WHEN event_id % 2 = 0 THEN 'NoneType' ELSE 'int' END, count(*) FROM events GROUP BY 2""")
def json_structure(spark: SparkSession, sf_dir: str) -> DataFrame:
    return structure(_input(spark, sf_dir, _DOCS), "doc")


@query("SELECT key AS path, CASE json_type(props, '$.' || key) WHEN 'UBIGINT' THEN 'int' WHEN 'BIGINT' THEN 'int' ELSE json_type(props, '$.' || key) END AS type, count(*) AS n FROM (SELECT props, unnest(json_keys(props)) AS key FROM events) GROUP BY 1, 2")
def json_structure_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return structure(inputs.table(spark, sf_dir, "events"), "props")


@query(f"SELECT DISTINCT url || '.json' AS domain FROM pages")
def distinct_domains(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.distinct_domains(_input(spark, sf_dir, LISTING))


@query("SELECT DISTINCT split_part(replace(url, '://', ':'), '/', 1) AS domain FROM pages")
def distinct_domains_of_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Objects named by path instead of by one encoded name."""
    named = inputs.table(spark, sf_dir, "pages").select(F.replace("url", F.lit("://"), F.lit(":")).alias("object_name"))
    return reports.distinct_domains(named)


@query("SELECT count(*) AS n_companies FROM customer")
def registry_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.registry_count(_registry(spark, sf_dir))


@query(f"SELECT id, company_name FROM ({_OWNERS}) ORDER BY id LIMIT 5")
def registry_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.registry_sample(_registry(spark, sf_dir)).select("id", "company_name")


@query("""
SELECT unnest(['id', 'website', 'company_name', 'ticker', 'exchange', 'headquarters_location', 'founded_date', 'description',
               'officers', 'board_members', 'data_source', 'created_at', 'updated_at']) AS column_name,
       unnest(['bigint', 'string', 'string', 'string', 'string', 'string', 'date', 'string', 'array<struct<name:string,title:string>>',
               'array<struct<name:string,title:string>>', 'struct<officers:string,board_members:string>', 'timestamp', 'timestamp']) AS data_type""")
def registry_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Column types of a registry as it is read back from its store."""
    path = scratch_path(spark, "registry")
    tables.write_registry(_registry(spark, sf_dir).select("id", "website", "company_name").transform(add_missing_columns), path)
    return reports.registry_types(spark, spark.read.parquet(path).select(*REGISTRY.names))


# --- sinks ------------------------------------------------------------------

@query(f"""
SELECT CAST(id AS VARCHAR) AS id, company_name, website, {sql.domain('website')} AS domain, CAST(n_files AS VARCHAR) AS files_in_bucket FROM ({_COVERED})""")
def write_coverage_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "coverage")
    tables.write_coverage_csv(_coverage(spark, sf_dir), path)
    back = spark.read.option("header", True).option("escape", '"').csv(path)
    return back.select("id", "company_name", "website", "domain", "files_in_bucket")


@query(f"""
SELECT company_name AS source, m.name AS name, m.title AS role
FROM (SELECT company_name || ', "Ltd"' AS company_name, unnest(officers) AS m FROM ({inputs.registry('duck')}))""")
def write_management_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    people = _registry(spark, sf_dir).select(
        F.concat("company_name", F.lit(', "Ltd"')).alias("company"), F.inline("officers")
    )
    path = scratch_path(spark, "management")
    tables.write_management_rows(tables.management_rows(people, "company", "name", "title"), path)
    return spark.read.option("header", True).option("escape", '"').csv(path)


_JSON = f"SELECT list, '  {{' || chr(10) || '    \"name\": \"' || name || '\",' || chr(10) || '    \"role\": \"' || role || '\",' || chr(10) || '    \"contact_info\": ' || contact || chr(10) || '  }}' AS item"
_CONTACT = """CASE WHEN email IS NULL AND phone IS NULL THEN 'null' ELSE '{' || chr(10)
       || concat_ws(',' || chr(10), '      "email": "' || email || '"', '      "phone": "' || phone || '"') || chr(10) || '    }' END AS contact"""


def _list_text(title: str, which: str, nobody: str) -> str:
    return f"""chr(10) || chr(10) || '=== {title} ===' || chr(10) || coalesce('[' || chr(10) ||
        (SELECT string_agg(item, ',' || chr(10) ORDER BY pos) FROM items f WHERE f.page_id = t.page_id AND f.list = '{which}')
        || chr(10) || ']', '{nobody}')"""


@query(f"""WITH {_CTES},
items AS ({_JSON}, page_id, pos FROM (SELECT *, {_CONTACT} FROM final))
SELECT source_file, 'URL: ' || url || chr(10) || 'Title: ' || title || chr(10) || 'Source File: ' || source_file || chr(10) || chr(10)
       || '=== Management Sections ===' || chr(10)
       || coalesce((SELECT string_agg(chr(10) || '[' || s || ']' || chr(10) || repeat('-', 50) || chr(10) || s, chr(10) ORDER BY i)
                    FROM relevant r WHERE r.page_id = t.page_id) || chr(10), '')
       || {_list_text('Final Executives List', 'executive', 'No executives extracted')} || chr(10)
       || {_list_text('Final Board Members List', 'board', 'No board members extracted')} AS summary
FROM texts t""")
def render_page_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summaries.render_page_summary(_processed(spark, sf_dir))


_REPORT = f"""
lasts AS (SELECT domain, max(first_seen) FILTER (WHERE list = 'executive') AS le, max(first_seen) FILTER (WHERE list = 'board') AS lb FROM uniq GROUP BY domain),
frame AS (SELECT s.*, le, lb FROM summary s LEFT JOIN lasts l ON l.domain = s.domain),
lines AS (
  SELECT company_name, 0 AS block, '' AS url, 'Processing Summary' || chr(10) || repeat('=', 50) || chr(10) || 'Company: ' || company_name || chr(10)
         || 'Domain: ' || domain || chr(10) || 'Files processed: ' || processed_files || chr(10) || 'Total people found: ' || total_people || chr(10) AS text FROM frame
  UNION ALL SELECT company_name, 9, '', 'No people found.' FROM frame WHERE total_people = 0
  UNION ALL SELECT company_name, b, '', h FROM frame, (VALUES
      (1, '=== Unique Executives/Officers ===' || chr(10) || repeat('-', 50)),
      (3, chr(10) || '=== Unique Board Members ===' || chr(10) || repeat('-', 50))) AS x(b, h) WHERE total_people > 0
  UNION ALL SELECT company_name, 5, '', chr(10) || chr(10) || '=== Final Executives List (JSON) ===' || chr(10) || CASE WHEN le IS NULL THEN '[]' ELSE '[' END FROM frame WHERE total_people > 0
  UNION ALL SELECT company_name, 8, '', chr(10) || chr(10) || '=== Final Board Members List (JSON) ===' || chr(10) || CASE WHEN lb IS NULL THEN '[]' ELSE '[' END FROM frame WHERE total_people > 0
  UNION ALL SELECT company_name, 7, '', ']' FROM frame WHERE total_people > 0 AND le IS NOT NULL
  UNION ALL SELECT company_name, 10, '', ']' FROM frame WHERE total_people > 0 AND lb IS NOT NULL
  UNION ALL SELECT company_name, CASE u.list WHEN 'executive' THEN 2 ELSE 4 END, first_seen.u, chr(10) || 'Name: ' || name || chr(10) || 'Role: ' || l.r
      || CASE WHEN l.e IS NULL AND l.p IS NULL THEN '' ELSE chr(10) || 'Contact Info:' || chr(10) || concat_ws(chr(10), '  email: ' || l.e, '  phone: ' || l.p) END
      FROM uniq u JOIN frame f ON f.domain = u.domain
  UNION ALL SELECT company_name, CASE list WHEN 'executive' THEN 6 ELSE 9 END, first_url, item || CASE WHEN is_last THEN '' ELSE ',' END
      FROM ({_JSON}, company_name, first_url, is_last FROM (SELECT *, {_CONTACT} FROM (
          SELECT f.company_name, u.list, u.name, u.l.r AS role, u.l.e AS email, u.l.p AS phone, u.first_seen.u AS first_url,
                 u.first_seen = CASE u.list WHEN 'executive' THEN le ELSE lb END AS is_last
          FROM uniq u JOIN frame f ON f.domain = u.domain))))"""


@query(f"WITH {_CTES},{_SUMMARY},{_UNIQUE},{_REPORT} SELECT company_name, block, url, text FROM lines")
def render_company_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = company_reports(_input(spark, sf_dir, inputs.COMPANY_PAGES), _registry(spark, sf_dir))
    return report.select("company_name", "block", F.col("place.url").alias("url"), "text")


@query(f"SELECT lower(company_name) AS company_key, id, len(officers) AS n_officers FROM ({inputs.registry('duck')})")
def write_company_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "company-json")
    registry = _registry(spark, sf_dir).select("id", "company_name", "officers", "board_members")
    tables.write_company_json(registry, path)
    back = spark.read.schema(registry.schema.add("company_key", "string")).json(path)
    return back.select("company_key", "id", F.size("officers").alias("n_officers"))


@query(f"SELECT id, company_name, website, ticker, len(officers) AS n_officers FROM ({inputs.registry('duck')})")
def write_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "registry")
    tables.write_registry(_registry(spark, sf_dir), path)
    return spark.read.parquet(path).select("id", "company_name", "website", "ticker", F.size("officers").alias("n_officers"))


# --- streaming --------------------------------------------------------------

@query(f"WITH {_CTES},{_UNIQUE} SELECT url, seq - 1 AS seq, name, role, email, phone FROM placed")
def ingest_new_pages_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Company pages as a stream of files, processed batch by batch; equals the batch result."""
    source = scratch_path(spark, "stream-in")
    pages = _input(spark, sf_dir, inputs.COMPANY_PAGES).drop("page_id", "company_id")
    pages.repartition(4).write.parquet(source)
    output = scratch_path(spark, "stream-out")
    stream = spark.readStream.schema(pages.schema).option("maxFilesPerTrigger", 2).parquet(source)
    ingest_new_pages(stream, output, scratch_path(spark, "stream-state")).awaitTermination()
    return spark.read.parquet(output).select("url", "seq", "name", "role", "email", "phone")
