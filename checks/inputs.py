"""Inputs the queries need, derived from the driver tables.

Each is one SQL text that Spark and DuckDB both understand, so that a query and its
oracle start from the same rows. Only list and struct literals differ (`dialect`).
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)

FIRST = ("Mary", "Robert", "Ann", "Hubert", "Lena", "Peter", "Vincent", "Olga", "Tom", "Ida", "Karl")
LAST = (
    "Smith", "Keller", "Moore", "Laurent", "Novak", "Fisher", "Brandt", "Olsen", "Weiss",
    "Tanaka", "Silva", "Huber", "Lindqvist",
)


def spark_input(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    """The rows of a shared SQL text over the tables of a directory."""
    for name in TABLES:
        if re.search(rf"\b{name}\b", sql):
            spark.read.parquet(f"{sf_dir}/{name}.parquet").createOrReplaceTempView(name)
    return spark.sql(sql)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pick(values: tuple[str, ...], key: str) -> str:
    """SQL: one of the values, by an integer key."""
    return f"split_part('{'|'.join(values)}', '|', CAST(({key}) % {len(values)} AS INT) + 1)"


def person(key: str) -> str:
    """SQL: a first and last name, by an integer key."""
    return f"({pick(FIRST, key)} || ' ' || {pick(LAST, key)})"


def text(key: str) -> str:
    return f"CAST({key} AS STRING)"


def encoded(value: str) -> str:
    """SQL: a URL as it appears in object names."""
    for char, code in (
        ("%", "%25"), (":", "%3A"), ("/", "%2F"), ("?", "%3F"), ("=", "%3D"), ("&", "%26"), ("#", "%23")
    ):
        value = f"replace({value}, '{char}', '{code}')"
    return value


def member_list(dialect: str, members: list[tuple[str, str]]) -> str:
    """SQL: a list of `name, title` structs."""
    if dialect == "spark":
        items = ", ".join(f"named_struct('name', {n}, 'title', {t})" for n, t in members)
        return f"CAST(array({items}) AS ARRAY<STRUCT<name: STRING, title: STRING>>)"
    items = ", ".join(f"{{'name': {n}, 'title': {t}}}" for n, t in members)
    return f"CAST([{items}] AS STRUCT(name VARCHAR, title VARCHAR)[])"


def tags(dialect: str, officers: str, board: str) -> str:
    if dialect == "spark":
        return f"named_struct('officers', {officers}, 'board_members', {board})"
    return f"{{'officers': {officers}, 'board_members': {board}}}"


HOST = "split_part(split_part(url, '://', 2), '/', 1)"

# page objects: name = percent-encoded URL
LISTING = f"SELECT page_id, url, html, {encoded('url')} || '.json' AS object_name FROM pages"

# the company list as scanned: a third of the sites are those of pages, some rows broken
COMPANY_ROWS = f"""
SELECT c_custkey AS row_no,
       CASE WHEN c_custkey % 11 = 3 THEN NULL
            WHEN c_custkey % 11 = 4 THEN '  '
            WHEN c_custkey % 4 = 0 THEN host
            WHEN c_custkey % 4 = 1 THEN 'http://' || host
            WHEN c_custkey % 4 = 2 THEN ' https://www.' || host || '/ '
            ELSE 'https://' || host || ':8080/about' END AS website,
       CASE WHEN c_custkey % 19 = 7 THEN ''
            WHEN c_custkey % 19 = 8 THEN NULL
            WHEN c_custkey % 17 = 5
            THEN 'Customer#' || lpad({text('c_custkey - 1')}, 9, '0')
            ELSE c_name END AS company_name,
       CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE 'T' || {text('c_custkey')} END AS ticker,
       CASE c_custkey % 6 WHEN 0 THEN 'TSX' WHEN 1 THEN 'TSXV' WHEN 2 THEN 'CSE'
            WHEN 3 THEN c_mktsegment WHEN 4 THEN '' ELSE NULL END AS exchange
FROM (SELECT c_custkey, c_name, c_mktsegment,
             coalesce({HOST}, 'cust' || {text('c_custkey')} || '.example.org') AS host
      FROM customer LEFT JOIN pages ON page_id = c_custkey) h
"""

# companies with an id and a site whose host is one of the pages' or the company's own
COMPANIES = f"""
SELECT CASE WHEN c_custkey % 23 = 9 THEN NULL ELSE c_custkey + 1 END AS id,
       CASE WHEN c_custkey % 11 = 3 THEN NULL
            WHEN c_custkey % 4 = 0 THEN 'http://' || host
            WHEN c_custkey % 4 = 1 THEN 'https://www.' || host || '/'
            ELSE 'https://' || host || '/en/about?x=1' END AS website,
       c_name AS company_name, 'T' || {text('c_custkey')} AS ticker,
       CASE c_custkey % 4 WHEN 0 THEN 'TSX' WHEN 1 THEN 'TSXV' WHEN 2 THEN '' ELSE NULL END AS exchange
FROM (SELECT c_custkey, c_name,
             coalesce({HOST}, 'cust' || {text('c_custkey')} || '.example.org') AS host
      FROM customer LEFT JOIN pages ON page_id = c_custkey) h
"""


def registry(dialect: str) -> str:
    """The registry: every customer is a company with up to three officers."""
    k = "c_custkey"
    a, b, c = person(k), person(f"{k} * 3 + 1"), person(f"{k} + 4")
    return f"""
SELECT {k} + 1 AS id, 'https://corp' || {text(k)} || '.example.com' AS website,
       c_name AS company_name, 'T' || {text(k)} AS ticker,
       CASE {k} % 5 WHEN 0 THEN 'TSX' WHEN 1 THEN 'TSXV' WHEN 2 THEN 'CSE' WHEN 3 THEN '' ELSE NULL END AS exchange,
       CASE WHEN {k} % 2 = 0 THEN 'City ' || {text('c_nationkey')} END AS headquarters_location,
       CAST(NULL AS DATE) AS founded_date, c_mktsegment AS description,
       CASE {k} % 4 WHEN 0 THEN {member_list(dialect, [])}
            WHEN 1 THEN {member_list(dialect, [(a, "'CEO'")])}
            WHEN 2 THEN {member_list(dialect, [(a, "'Chief Executive Officer'"), (b, "'Treasurer'")])}
            ELSE {member_list(dialect, [(a, "'President'"), (b, "'Director'"), (c, "'Chairman'")])}
       END AS officers,
       CASE {k} % 3 WHEN 0 THEN {member_list(dialect, [])}
            WHEN 1 THEN {member_list(dialect, [(b, "'Chairman'")])}
            ELSE {member_list(dialect, [(c, "'Director'"), (a, "'Chairman of the Board'")])}
       END AS board_members,
       {tags(dialect, f"CASE WHEN {k} % 2 = 0 THEN 'local' ELSE 'llm' END", "'local'")} AS data_source,
       CAST('2024-01-01 00:00:00' AS TIMESTAMP) AS created_at,
       CAST('2024-01-01 00:00:00' AS TIMESTAMP) AS updated_at
FROM customer
"""


def management_updates(dialect: str) -> str:
    """New lists per company id; some ids twice, some unknown, some with one list only."""
    k = "o_custkey"
    none = "CAST(NULL AS ARRAY<STRUCT<name: STRING, title: STRING>>)" if dialect == "spark" else (
        "CAST(NULL AS STRUCT(name VARCHAR, title VARCHAR)[])"
    )
    new_officers = member_list(dialect, [(person("o_orderkey"), "'CEO'")])
    new_board = member_list(dialect, [(person("o_orderkey + 3"), "'Chairman'"), (person("o_orderkey + 6"), "'Director'")])
    return f"""
SELECT {k} + CASE WHEN {k} % 10 = 9 THEN 100000000 ELSE 1 END AS id, o_orderkey AS seq,
       CASE WHEN o_orderkey % 3 = 0 THEN {none} ELSE {new_officers} END AS officers,
       CASE WHEN o_orderkey % 3 = 1 THEN {none} ELSE {new_board} END AS board_members
FROM orders
"""


# people finds as rows: the orders of a customer are the finds of one page
_ROLES = (
    "Director", "Chief Executive Officer", "Chairman", "Treasurer", "President", "Board Member",
    "Secretary", "Vice President",
)
PEOPLE_ROWS = f"""
SELECT o_custkey AS page_id, o_orderkey AS seq,
       {pick(FIRST[:4], 'o_orderkey')} || ' ' || {pick(LAST[:3], 'o_orderkey')} AS name,
       {pick(_ROLES, 'o_orderkey * 5 + o_custkey')} AS role,
       CASE WHEN o_orderkey % 3 = 0 THEN 'mail' || {text('o_orderkey')} || '@example.com' END AS email,
       CASE WHEN o_orderkey % 4 = 1 THEN '604-555-' || lpad({text('o_orderkey % 10000')}, 4, '0') END AS phone
FROM orders
"""

_PATHS = (
    "about/team", "board-of-directors", "news/2024", "company/management", "team/board",
    "contact", "investors/overview", "people",
)


def _page_body() -> str:
    """SQL: the text of a company page, one of eight shapes by order key."""
    k = "o_orderkey"
    a, b, c = person(k), person(f"{k} * 3 + 1"), person(f"{k} + 5")
    phone = f"'604-555-' || lpad({text(f'{k} % 10000')}, 4, '0')"
    mail = f"'info' || {text(k)} || '@corp' || {text('o_custkey')} || '.example.com'"
    shapes = (
        f"'Our Leadership Team. CEO ' || {a} || ' joined in 2001. ' || {b} || ' is Vice  President of sales. Call ' || {phone} || ' today.'",
        f"'Board of Directors: ' || {a} || ', Chairman and Director. ' || {b} || ' (director), ' || {mail} || ' or ' || {phone} || '. Nothing to see here! ' || {a} || ' is also President and ceo. ' || {b} || ' left.'",
        f"'The cookies policy was signed by ' || {a} || '? Contact us at ' || {mail} || ' now.\n\nMore text follows here.'",
        f"'About the mine in the north. It was opened by ' || {a} || '. No jobs are listed.'",
        "''",
        f"'Corporate Secretary ' || {a} || '. Treasurer ' || {b} || '. Senior Management includes Ida ' || {c} || ', President. We also met ' || {c} || ', President. Then Secretary ' || {a} || ' spoke.'",
        f"'Officers and others: ' || {c} || ', investor relations, tel. +1 (604) 555-0199; ' || {a} || ', Chief  Operating Officer. ' || {c} || ' is a Director at ' || {mail} || '.'",
        f"'Chairperson ' || {b} || ' opened the meeting. ' || {b} || ' became President after ' || {a} || ', VICE PRESIDENT, retired. Our Director ' || {c} || ' and CFO ' || {a} || ' were there. ' || {phone} || ' reaches Director ' || {b} || '.'",
    )
    # The key's last digits choose the shape; multiplying spreads shapes over companies.
    cases = " ".join(f"WHEN {i} THEN {s}" for i, s in enumerate(shapes))
    return f"CASE (o_orderkey * 3 + o_custkey) % {len(shapes)} {cases} END"


# one company page per order
COMPANY_PAGES = f"""
SELECT o_orderkey AS page_id, o_custkey + 1 AS company_id,
       'https://www.corp' || {text('o_custkey')} || '.example.com/' || {pick(_PATHS, 'o_orderkey')}
         || '/' || {text('o_orderkey')} AS url,
       'Page ' || {text('o_orderkey')} AS title,
       'page' || {text('o_orderkey')} || '.json' AS source_file,
       {_page_body()} AS body_text,
       CASE WHEN o_orderkey % 5 = 0 THEN '{{"a": "Director Olga Weiss spoke.", "b": "CEO Tom Silva."}}'
            WHEN o_orderkey % 5 = 1 THEN '["President Lena Huber.", "Call us."]'
            WHEN o_orderkey % 5 = 2 THEN 'Chairman Karl Olsen'
            WHEN o_orderkey % 5 = 3 THEN '{{}}' ELSE NULL END AS sections
FROM orders
"""

# whole documents as pages: people named wherever a sentence or a clause ends. Letters beyond
# ASCII are made plain, as the oracle's patterns know no others.
_ACCENTS = ("äöüßéèêëàâçñóíáúîïôûùÄÖÜÉÈÊËÀÂÇÑÓÍÁÚÎÏÔÛÙ", "aouseeeeaacnoiauiiouuAOUEEEEAACNOIAUIIOUU")
_DOCUMENT_TEXT = (
    f"replace(replace(translate(coalesce(text, ''), '{_ACCENTS[0]}', '{_ACCENTS[1]}'),"
    f" ', ', ', Director ' || {person('doc_id * 7 + 3')} || ' saw '), '. ', ', said ' || {person('doc_id')} || '. President ' || {person('doc_id + 5')} || ' met ')"
)
DOCUMENT_PAGES = f"""
SELECT doc_id AS page_id, 'https://www.' || coalesce(source, 'none') || '.example.com/' || coalesce(lang, 'x') || '/' || {text('doc_id')} AS url,
       'Document ' || {text('doc_id')} AS title, 'doc' || {text('doc_id')} || '.json' AS source_file,
       {_DOCUMENT_TEXT} AS body_text, CAST(NULL AS STRING) AS sections
FROM documents
"""

# documents whose sentences also name officers
TITLED_TEXT = f"""
SELECT p_partkey,
       'https://www.corp' || {text('p_partkey * 2')} || '.example.com/p/' || {text('p_partkey')} AS url,
       'Our\tteam:\n\nCEO ' || {person('p_partkey')} || ', Vice President  ' || {person('p_partkey + 2')}
         || ' of ' || p_name || '. Head ' || {person('p_partkey * 3')} || ' and Lead Supervisor '
         || {pick(FIRST, 'p_partkey + 1')} || '. manager nobody; Executive Chairman ' || {person('p_partkey + 7')} AS body_text
FROM part
"""

# model answers, every seventh one broken
RESPONSES = f"""
SELECT c_custkey + 1 AS id, c_name AS company_name,
       CASE WHEN c_custkey % 7 = 3 THEN 'I could not find anyone.'
            WHEN c_custkey % 7 = 4 THEN '{{"officers": [{{"name": "' || {person('c_custkey')} || '", "title": "CEO"'
            WHEN c_custkey % 7 = 5 THEN '{{"officers": []}}'
            ELSE '{{"officers": [{{"name": "' || {person('c_custkey')} || '", "title": "CEO"}}, {{"name": "' || {person('c_custkey + 2')} || '", "title": "CFO", "bio": "b' || {text('c_custkey')} || '"}}], "board_members": [{{"name": "'
                 || {person('c_custkey * 3')} || '", "title": "Chairman"}}, {{"name": "' || {person('c_custkey * 3 + 2')} || '"}}]}}'
       END AS response
FROM customer
"""

# raw page objects: good ones, broken JSON, null and NaN texts, content-only ones
RAW_PAGES = f"""
SELECT o_orderkey AS page_id,
       'https%3A%2F%2Fwww.corp' || {text('o_custkey')} || '.example.com%2Fa+b%2F' || {text('o_orderkey')} || '.json' AS source_file,
       CASE o_orderkey % 8
            WHEN 0 THEN '{{"url": "x", "title": "T' || {text('o_orderkey')} || '", "meta_description": NaN, "structured_data": {{}}, "body_text": "<p>CEO &amp; more ' || {text('o_orderkey')} || '</p>", "markdown_content": ""}}'
            WHEN 1 THEN '{{"title": NaN, "body_text": NaN, "markdown_content": ""}}'
            WHEN 2 THEN '{{"title": "cut off'
            WHEN 3 THEN '{{"title": "C", "body_text": "", "markdown_content": "", "content": "<b>only</b> content ' || {text('o_orderkey')} || '"}}'
            WHEN 4 THEN '{{"title": "S", "body_text": "", "markdown_content": "", "sections": {{"a": "one", "b": "two"}}}}'
            WHEN 5 THEN '{{"title": null, "meta_description": "m", "markdown_content": "**md**"}}'
            WHEN 6 THEN '{{"title": "N", "body_text": null}}'
            ELSE '{{"title": "B", "body_text": "NaN", "markdown_content": "x", "content": "unused"}}' END AS raw
FROM orders
"""
