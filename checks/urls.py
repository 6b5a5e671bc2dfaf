"""Queries over URLs, names, listings and page objects."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import expected, inputs, sql
from checks.registered import query
from stewardry import vocab
from stewardry.functions import urls
from stewardry.operators.links import management_links
from stewardry.sources import companies, management, objects, pages

SITES = ("SELECT row_no, website, company_name FROM (" + inputs.COMPANY_ROWS + ")")


def _listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.spark_input(spark, sf_dir, inputs.LISTING)


# --- sources ----------------------------------------------------------------

_URL = "url_decode(replace(replace(source_file, '.json', ''), '+', '%2B'))"
_GOOD = "page_id % 8 NOT IN (1, 2, 6)"


@query(f"""
SELECT page_id, source_file, {_URL} AS url,
       CASE page_id % 8 WHEN 0 THEN 'T' || page_id WHEN 3 THEN 'C' WHEN 4 THEN 'S' WHEN 7 THEN 'B' END AS title,
       CASE page_id % 8 WHEN 5 THEN 'm' END AS meta_description,
       CASE page_id % 8 WHEN 0 THEN 'CEO & more ' || page_id WHEN 3 THEN 'only content ' || page_id
            WHEN 7 THEN 'NaN' ELSE '' END AS body_text,
       CASE page_id % 8 WHEN 5 THEN '**md**' WHEN 7 THEN 'x' ELSE '' END AS markdown_content,
       CASE page_id % 8 WHEN 4 THEN '{{"a":"one","b":"two"}}' END AS sections
FROM ({inputs.RAW_PAGES}) WHERE {_GOOD}""")
def scan_pages_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = inputs.spark_input(spark, sf_dir, inputs.RAW_PAGES)
    return pages.accepted_pages(pages.decode_pages(raw))


@query(f"""
SELECT source_file, CASE page_id % 8 WHEN 2 THEN 'malformed json' ELSE 'body_text is null' END AS reject_reason
FROM ({inputs.RAW_PAGES}) WHERE NOT {_GOOD}""")
def rejected_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = inputs.spark_input(spark, sf_dir, inputs.RAW_PAGES)
    return pages.rejected_pages(pages.decode_pages(raw))


_EVENT_FILES = """
SELECT event_id, 'e' || CAST(event_id AS STRING) || '.json' AS source_file,
       CASE WHEN event_id % 9 = 4 THEN '{"k": ' ELSE props END AS raw FROM events"""


@query("SELECT source_file, json_extract_string(raw, '$.k') AS k FROM (" + _EVENT_FILES + ") WHERE event_id % 9 <> 4")
def scan_json_dir(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = pages.parse_json_files(inputs.spark_input(spark, sf_dir, _EVENT_FILES))
    return parsed.filter(F.col("fields").isNotNull()).select(
        "source_file", F.try_element_at("fields", F.lit("k")).alias("k")
    )


@query("SELECT object_name FROM (" + inputs.LISTING + ") WHERE starts_with(object_name, 'https%3A%2F%2Fblog.')")
def list_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return objects.list_objects(_listing(spark, sf_dir).select("object_name"), "https%3A%2F%2Fblog.")


@query("SELECT count(*) AS n_objects FROM pages")
def count_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return objects.count_objects(_listing(spark, sf_dir))


@query("SELECT object_name, md5(object_name) || '.json' AS file_name FROM ("
       + inputs.LISTING + ") ORDER BY object_name LIMIT 50")
def sample_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return objects.sample_objects(_listing(spark, sf_dir).select("object_name"), 50)


@query(f"SELECT website, company_name, ticker, exchange FROM ({inputs.COMPANY_ROWS})")
def scan_companies_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CSV text of the list in the second dialect, read back by column name."""
    rows = inputs.spark_input(spark, sf_dir, inputs.COMPANY_ROWS).select(
        F.col("website").alias("URL"), F.col("company_name").alias("Name"),
        F.col("exchange").alias("Exchange"), F.col("ticker").alias("Ticker"),
    )
    lines = rows.select(F.to_csv(F.struct("URL", "Name", "Exchange", "Ticker"), {"emptyValue": '""', "nullValue": "", "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}).alias("line"))
    schema = "URL string, Name string, Exchange string, Ticker string"
    parsed = lines.select(F.from_csv("line", schema, {"emptyValue": "", "nullValue": "\x00"}).alias("r")).select("r.*")
    return companies.rename_company_columns(parsed).select("website", "company_name", "ticker", "exchange")


@query(f"""
SELECT id, website, company_name, ticker, exchange, headquarters_location, founded_date, description,
       len(officers) AS n_officers, len(board_members) AS n_board, data_source.officers AS officers_source
FROM ({inputs.registry('duck')})""")
def scan_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    registry = inputs.spark_input(spark, sf_dir, inputs.registry("spark"))
    return companies.scan_registry(registry).select(
        "id", "website", "company_name", "ticker", "exchange", "headquarters_location",
        "founded_date", "description", F.size("officers").alias("n_officers"),
        F.size("board_members").alias("n_board"), F.col("data_source.officers").alias("officers_source"),
    )


_LOCAL_FILES = f"""
SELECT c_custkey, CASE WHEN c_nationkey < 20 THEN lower(c_name) ELSE 'other ' || lower(c_name) END || '.json' AS source_file,
       CASE c_custkey % 5
            WHEN 0 THEN '{{"officers": [{{"name": "' || {inputs.person('c_custkey')} || '", "title": "CEO"}}, {{"name": "No Title"}}, "text", 5], "board_members": []}}'
            WHEN 1 THEN '{{"officers": "none", "board_members": [{{"name": "' || {inputs.person('c_custkey + 1')} || '", "title": "Chairman", "x": 1}}, {{"name": "B", "title": "Director"}}]}}'
            WHEN 2 THEN '{{"officers": [{{"title": "CEO"}}]}}'
            WHEN 3 THEN 'broken'
            ELSE '{{"officers": [{{"name": "A", "title": "CFO"}}]}}' END AS raw
FROM customer"""


@query(f"""
SELECT c_custkey, CASE WHEN nk < 20 THEN CASE c_custkey % 5 WHEN 0 THEN {inputs.person('c_custkey')} || '/CEO' WHEN 4 THEN 'A/CFO' END END AS officers,
       CASE WHEN nk < 20 THEN CASE c_custkey % 5 WHEN 1 THEN {inputs.person('c_custkey + 1')} || '/Chairman;B/Director' END END AS board_members
FROM (SELECT c_custkey, c_nationkey AS nk FROM customer)""")
def local_management(spark: SparkSession, sf_dir: str) -> DataFrame:
    local = management.local_management(inputs.spark_input(spark, sf_dir, _LOCAL_FILES))
    customers = inputs.table(spark, sf_dir, "customer").select("c_custkey", F.col("c_name").alias("company_name"))
    joined = management.with_local_management(customers, local)

    def flat(column: str):
        return F.array_join(F.transform(column, lambda m: F.concat(m["name"], F.lit("/"), m["title"])), ";")

    return joined.select(
        "c_custkey", flat("local_officers").alias("officers"), flat("local_board_members").alias("board_members")
    )


# --- URL and name expressions -----------------------------------------------

def _per_row(name: str, source: str, key: str, oracle: str, column) -> None:
    """Registers `key, value` of one expression over an input."""
    def build(spark: SparkSession, sf_dir: str) -> DataFrame:
        return inputs.spark_input(spark, sf_dir, source).select(key, column().alias("value"))

    query(f"SELECT {key}, {oracle} AS value FROM ({source})", name)(build)


_per_row("normalize_website", SITES, "row_no", sql.website("website"), lambda: urls.normalize_website("website"))
_per_row("placeholder_website", SITES, "row_no", sql.site_or_placeholder("website", "company_name"),
         lambda: urls.website_or_placeholder("website", "company_name"))
_per_row("extract_domain", SITES, "row_no", sql.plain_domain("website"), lambda: urls.extract_domain("website"))
_per_row("netloc_domain", SITES, "row_no", sql.domain("website"), lambda: urls.netloc_domain("website"))
_per_row("decode_object_name", inputs.LISTING, "page_id", "url || '.json'", lambda: urls.decode_name("object_name"))
_per_row("decode_malformed_name",
         "SELECT c_custkey, 'https%3A%2F%2Fa.com%2F' || CAST(c_custkey AS STRING) || '%' || "
         "CASE c_custkey % 4 WHEN 0 THEN '' WHEN 1 THEN 'ZZ%20x' WHEN 2 THEN '2' ELSE '%41+' END AS object_name FROM customer", "c_custkey",
         "'https://a.com/' || CAST(c_custkey AS VARCHAR) || '%' || CASE c_custkey % 4 WHEN 0 THEN '' WHEN 1 THEN 'ZZ x' WHEN 2 THEN '2' ELSE 'A+' END",
         lambda: urls.decode_name("object_name"))
_per_row("decode_object_name_partly", inputs.LISTING, "page_id",
         "replace(replace(object_name, '%3A', ':'), '%2F', '/')", lambda: urls.decode_name_partly("object_name"))
_per_row("safe_filename", inputs.LISTING, "page_id",
         "translate(string_split(url || '.json', '/')[-1], '?=&', '___')", lambda: urls.short_filename("object_name"))
_per_row("flat_filename", inputs.LISTING, "page_id",
         "replace(split_part(replace(replace(object_name, '%3A', ':'), '%2F', '/'), '://', 2), '/', '_')",
         lambda: urls.flat_filename("object_name"))
_per_row("company_file_key", inputs.COMPANIES, "company_name", "replace(replace(lower(company_name), ' ', '_'), '/', '_')",
         lambda: urls.company_file_key("company_name"))

_ALL_URLS = "SELECT page_id, url FROM (" + inputs.COMPANY_PAGES + ")"
_per_row("is_excluded_url_matcher", inputs.LISTING, "page_id", sql.any_of("url", expected.EXCLUDED_BY_MATCHER),
         lambda: urls.is_excluded("url", vocab.EXCLUDED_BY_MATCHER))
_per_row("is_excluded_url", _ALL_URLS, "page_id", sql.any_of("url", expected.EXCLUDED_BY_READER), lambda: urls.is_excluded("url"))
_per_row("is_executive_page", _ALL_URLS, "page_id", sql.any_of("url", expected.EXECUTIVE_PAGE_WORDS),
         lambda: urls.is_executive_page("url"))
_per_row("is_board_page", _ALL_URLS, "page_id", sql.any_of("url", expected.BOARD_PAGE_WORDS), lambda: urls.is_board_page("url"))


# pages with links of every kind put into their navigation
_LINKED = """
SELECT page_id, url, split_part(url, '://', 1) || '://' || split_part(split_part(url, '://', 2), '/', 1) AS root,
       replace(html, '</nav>', '<a class="x" href="../about/?p=1">Us</a><A HREF=''/company/board''>B</A>'
         || '<a href="https://other.example.org/team">x</a><a href="#management">m</a><a>no address</a>'
         || '<a href="?team=2&amp;z=1">t</a><a title="a>b" href="lead/./x.html"><b>Our</b> Team ' || CAST(page_id AS STRING)
         || '</a><a href="/company/board">again</a><a href="/x/../y">Board &amp; more</a></nav>') AS html
FROM pages"""
# what those links resolve to, written out by hand
_LINK_ORACLE = rf"""
WITH linked AS (SELECT *, regexp_extract(url, '^([^?#]*)', 1) AS no_query, regexp_extract(url, '^([^#]*)', 1) AS no_fragment,
                       regexp_extract(url, '^(.*/)', 1) AS folder FROM ({_LINKED})),
nav AS (SELECT page_id, url, root, root || h AS link
        FROM (SELECT page_id, url, root, unnest(regexp_extract_all(html, '<a href="(/[^"]*)">', 1)) AS h FROM linked)
        WHERE {sql.any_of('h', expected.LINK_WORDS)}),
added AS (SELECT page_id, url, root, unnest([
              CASE WHEN length(regexp_extract(no_query, '^[a-z]+://[^/]+(.*)$', 1)) - length(replace(regexp_extract(no_query, '^[a-z]+://[^/]+(.*)$', 1), '/', '')) > 2
                   THEN regexp_extract(regexp_extract(folder, '^(.*)/$', 1), '^(.*/)', 1) || 'about/?p=1'
                   ELSE CASE WHEN length(replace(folder, root, '')) > 1
                             THEN regexp_extract(regexp_extract(folder, '^(.*)/$', 1), '^(.*/)', 1) ELSE root || '/' END || 'about/?p=1' END,
              root || '/company/board', no_fragment || '#management', no_query || '?team=2&z=1',
              folder || 'lead/x.html', root || '/y']) AS link FROM linked)
SELECT DISTINCT page_id, url, root, link FROM (SELECT * FROM nav UNION ALL SELECT * FROM added)"""


@query(_LINK_ORACLE, name="management_links")
def management_links_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return management_links(inputs.spark_input(spark, sf_dir, _LINKED), prefix="root")
