"""Queries over texts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import expected, inputs, sql
from checks.registered import learned, query
from stewardry.functions import people as P
from stewardry.functions import text as X
from stewardry.functions.html import clean_html as clean
from stewardry.operators import people as rows
from stewardry.operators import sites, tagger
from stewardry.operators.once import compute_once
from stewardry.operators.spread import spread_small
from stewardry.plans import extraction
from stewardry.session import written
from stewardry.sources.pages import documented_page, page_text


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread_small(inputs.table(spark, sf_dir, "documents").select("doc_id", "text"))


def _company_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.spark_input(spark, sf_dir, inputs.COMPANY_PAGES)


@query(f"SELECT page_id, {sql.clean('html')} AS text FROM pages")
def clean_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spread_small(inputs.table(spark, sf_dir, "pages").select("page_id", "html"))
    return pages.select("page_id", clean("html").alias("text"))


@query(f"WITH {sql.texts_cte(inputs.COMPANY_PAGES)} SELECT page_id, txt AS text FROM texts", name="page_text")
def page_text_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _company_pages(spark, sf_dir).select("page_id", page_text("body_text", "sections").alias("text"))


_LINES = rf"regexp_split_to_array({sql.clean('html')}, '\r\n|[\n\r\x0b\x0c\x1c-\x1e\x{{85}}\x{{2028}}\x{{2029}}]')"


_SITE_TEXTS = f"""
WITH lined AS (SELECT {sql.netloc('url')} AS site, url, list_transform({_LINES}, lambda l: string_split({sql.stripped('l')}, '  ')) AS ls FROM pages),
texts AS (SELECT site, url, array_to_string(list_filter(list_transform(flatten(ls), lambda p: {sql.stripped('p')}), lambda p: p <> ''), ' ') AS text FROM lined)"""


@query(f"{_SITE_TEXTS} SELECT site, url, text FROM texts")
def site_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sites.site_text(inputs.table(spark, sf_dir, "pages"))


@query(f"{_SITE_TEXTS} SELECT site, count(*) AS n_pages, string_agg(text, chr(10) || chr(10) ORDER BY url, text) AS text FROM texts GROUP BY site")
def joined_site_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sites.joined_site_text(inputs.table(spark, sf_dir, "pages"))


_DOCUMENTED = f"""
SELECT doc_id, '{{' || CASE doc_id % 4 WHEN 0 THEN '"company": "Co", "content": "c' || {inputs.text('doc_id')} || '"'
       WHEN 1 THEN '"company_name": "Name ' || lang || '", "company": "", "text": "t"'
       WHEN 2 THEN '"url": "https://' || source || '", "content": "", "text": "fallback"' ELSE '"id": 1' END || '}}' AS raw
FROM documents"""


@query(f"""
SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN 'Co' WHEN 1 THEN 'Name ' || lang WHEN 2 THEN 'https://' || source ELSE '' END AS company,
       CASE doc_id % 4 WHEN 0 THEN 'c' || doc_id WHEN 1 THEN 't' WHEN 2 THEN 'fallback' ELSE '' END AS text FROM documents""")
def coalesce_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = inputs.spark_input(spark, sf_dir, _DOCUMENTED)
    page = documented_page(F.from_json("raw", "map<string,string>"))
    return raw.select("doc_id", page.alias("p")).select("doc_id", "p.company", "p.text")


_KEYWORD_TEXT = "SELECT doc_id, text || CASE WHEN doc_id % 3 = 0 THEN ' The CHIEF left' ELSE '' END AS text FROM documents"


@query(f"SELECT doc_id FROM ({_KEYWORD_TEXT}) WHERE {sql.any_of('text', expected.PAGE_KEYWORDS)}")
def management_keyword_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.spark_input(spark, sf_dir, _KEYWORD_TEXT).filter(X.has_page_keyword("text")).select("doc_id")


@query(f"WITH texts AS (SELECT doc_id AS page_id, text AS txt FROM documents), {sql.sections_cte()} SELECT page_id AS doc_id, i, s FROM (SELECT page_id, s, row_number() OVER (PARTITION BY page_id ORDER BY i) AS i FROM relevant)")
def relevant_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = _documents(spark, sf_dir).filter(F.col("text") != "")
    cut = compute_once(found.select("doc_id", "text"), sections=X.relevant_sections("text"))
    return cut.select("doc_id", F.posexplode("sections").alias("i", "s")).withColumn("i", F.col("i") + 1)


@query(f"SELECT doc_id, regexp_replace(regexp_replace(text, '{sql.WS}+', ' ', 'g'), '^ | $', '', 'g') AS text FROM documents")
def collapse_whitespace(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _documents(spark, sf_dir).select("doc_id", X.collapse_whitespace("text").alias("text"))


# --- people -----------------------------------------------------------------

_SECTIONS = f"WITH {sql.texts_cte(inputs.COMPANY_PAGES)},{sql.sections_cte()},{sql.people_cte()}"


def _sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = page_text("body_text", "sections")
    texts = compute_once(spread_small(_company_pages(spark, sf_dir)), txt=text).filter(F.col("txt") != "")
    cut = compute_once(texts.select("page_id", "txt"), sections=X.relevant_sections("txt"))
    return cut.select("page_id", F.explode("sections").alias("s"))


@query(f"{_SECTIONS} SELECT page_id, s, name, pos0 AS start FROM spans")
def person_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    named = compute_once(_sections(spark, sf_dir), spans=P.person_spans("s"))
    found = named.select("page_id", "s", F.explode("spans").alias("m"))
    return found.select("page_id", "s", F.col("m.text").alias("name"), F.col("m.start").alias("start"))


@query(f"{_SECTIONS} SELECT page_id, s, pos0 AS start, name, raw_role AS role FROM nearest")
def nearest_role(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = compute_once(_sections(spark, sf_dir), hits=P.role_hits("s"), spans=P.person_spans("s"))
    hit = found.select("page_id", "s", "hits", F.explode("spans").alias("m"))
    role = P.nearest_role(F.col("hits"), F.col("m.start"))
    return hit.select(
        "page_id", "s", F.col("m.start").alias("start"), F.col("m.text").alias("name"), role.alias("role")
    ).filter(F.col("role").isNotNull())


@query(f"SELECT doc_id, nullif(regexp_extract(text, '{sql.EMAIL}'), '') AS email, nullif(regexp_extract(text, '{sql.PHONE}'), '') AS phone FROM documents")
def extract_contacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _documents(spark, sf_dir).select(
        "doc_id", P.extract_email("text").alias("email"), P.extract_phone("text").alias("phone")
    )


_RAW_ROLES = ("CEO", "cFo", "Coo", "vp", "IR", "director", "DIRECTOR", " President ", "chairperson", "Chairman",
              "treasurer", "Secretary", "Vice President", "chief executive officer", "Head")
_ROLE_ROWS = f"SELECT o_orderkey, {inputs.pick(_RAW_ROLES, 'o_orderkey')} AS role FROM orders"


@query(f"SELECT o_orderkey, {sql.role_standard('role')} AS role FROM ({_ROLE_ROWS})")
def standardize_role(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.spark_input(spark, sf_dir, _ROLE_ROWS).select("o_orderkey", P.standardize_role("role").alias("role"))


@query(sql.dedup_select(f"({inputs.PEOPLE_ROWS})"))
def dedup_people(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rows.dedup_people_rows(inputs.spark_input(spark, sf_dir, inputs.PEOPLE_ROWS))


# A page's list of people in one row: five names of one order, some holding others.
_LISTED = ", ".join(
    f"'{{\"name\": \"' || {name} || '\", \"role\": \"' || {inputs.pick(('Director', 'President'), f'o_orderkey + {n} * o_custkey')} || '\", \"email\": \"m{n}\"}}'"
    for n, name in enumerate((
        inputs.pick(inputs.LAST[:5], "o_orderkey"), inputs.person("o_orderkey"),
        f"'Dr ' || {inputs.person('o_orderkey')}", inputs.pick(inputs.FIRST[:4], "o_orderkey"),
        inputs.pick(inputs.LAST[:5], "o_custkey"),
    ))
)
_PEOPLE_LISTS = f"SELECT o_orderkey AS page_id, '[' || concat_ws(',', {_LISTED}) || ']' AS raw FROM orders"


@query(f"""
WITH parsed AS (SELECT page_id, from_json(raw, '[{{"name": "VARCHAR", "role": "VARCHAR", "email": "VARCHAR", "phone": "VARCHAR"}}]') AS l FROM ({_PEOPLE_LISTS})),
items AS (SELECT page_id, seq, l[seq].name AS name, l[seq].role AS role, l[seq].email AS email, l[seq].phone AS phone
          FROM (SELECT page_id, l, unnest(range(1, len(l) + 1)) AS seq FROM parsed)),
{sql.merged_cte('items')}
SELECT page_id, pos, p.name AS name, p.role AS role, p.email AS email FROM merged""")
def merge_similar_people(spark: SparkSession, sf_dir: str) -> DataFrame:
    from stewardry.schemas import PEOPLE

    raw = spread_small(inputs.spark_input(spark, sf_dir, _PEOPLE_LISTS))
    lists = compute_once(raw, l=F.from_json("raw", PEOPLE))
    folded = compute_once(lists.select("page_id", "l"), merged=P.merge_similar_people("l"))
    merged = folded.select("page_id", F.posexplode("merged").alias("pos", "p"))
    return merged.select("page_id", (F.col("pos") + 1).alias("pos"), "p.name", "p.role", "p.email")


_NAMES = f"""SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN {inputs.person('p_partkey')} WHEN 1 THEN p_name
       WHEN 2 THEN substr({inputs.pick(inputs.FIRST, 'p_partkey')}, 1, 1 + CAST(p_partkey % 3 AS INT)) ELSE p_type || ' Mine' END AS name FROM part"""


@query(f"SELECT p_partkey, name, {sql.valid('name')} AS valid FROM ({_NAMES})")
def is_valid_person(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.spark_input(spark, sf_dir, _NAMES).select("p_partkey", "name", P.is_valid_name("name").alias("valid"))


_CATEGORISED = f"SELECT p.page_id, p.seq, p.name, p.role, u.url FROM ({inputs.PEOPLE_ROWS}) p JOIN (SELECT page_id, url FROM ({inputs.COMPANY_PAGES})) u ON u.page_id = p.seq"


@query(f"SELECT page_id, seq, {sql.listed('role', 'url', 'executive')} AS is_exec, {sql.listed('role', 'url', 'board')} AS is_board FROM ({_CATEGORISED})")
def categorize_people(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = inputs.spark_input(spark, sf_dir, _CATEGORISED)
    role, url = F.col("role"), F.col("url")
    return found.select(
        "page_id", "seq", P.goes_to_executives(role, url).alias("is_exec"), P.goes_to_board(role, url).alias("is_board")
    )


def _processed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extraction.process_pages(_company_pages(spark, sf_dir))


_LISTED = "SELECT url, list, row_number() OVER (PARTITION BY url, list ORDER BY pos) AS pos, name, role, email, phone FROM final"


def _listed(done: DataFrame) -> DataFrame:
    both = F.array(
        F.struct(F.lit("executive").alias("list"), F.col("executives").alias("people")),
        F.struct(F.lit("board").alias("list"), F.col("board_members").alias("people")),
    )
    return done.select("url", F.explode(both).alias("l")).select("url", "l.list", F.posexplode("l.people").alias("pos", "p")).select(
        "url", "list", (F.col("pos") + 1).alias("pos"), "p.name", "p.role", "p.email", "p.phone"
    )


@query(f"WITH {sql.processed_ctes()} {_LISTED}")
def process_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _listed(_processed(spark, sf_dir))


@query(f"WITH {sql.processed_ctes(inputs.DOCUMENT_PAGES)} {_LISTED}")
def process_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """People of whole documents, some of hundreds of sentences."""
    return _listed(extraction.process_pages(inputs.spark_input(spark, sf_dir, inputs.DOCUMENT_PAGES)))


@query(f"""WITH {sql.processed_ctes()}
SELECT t.url, t.title, (SELECT count(*) FROM relevant r WHERE r.page_id = t.page_id) AS n_sections,
       (SELECT count(*) FROM final f WHERE f.page_id = t.page_id) AS n_people FROM texts t""")
def process_page_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page has its row, also those without people."""
    return _processed(spark, sf_dir).select(
        "url", "title", F.size("relevant").alias("n_sections"),
        (F.size("executives") + F.size("board_members")).alias("n_people"),
    )


@query("""SELECT page_id, name, role, min(seq) AS seq, arg_max(email, seq) FILTER (WHERE email IS NOT NULL) AS email,
       arg_max(phone, seq) FILTER (WHERE phone IS NOT NULL) AS phone FROM (""" + inputs.PEOPLE_ROWS + ") GROUP BY ALL")
def dedup_people_by_role(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rows.dedup_people_by_role(inputs.spark_input(spark, sf_dir, inputs.PEOPLE_ROWS))


@query(f"""{_SECTIONS},
kept AS (SELECT page_id, name, role, min(seq) AS first, arg_max(email, seq) FILTER (WHERE email IS NOT NULL) AS email,
         arg_max(phone, seq) FILTER (WHERE phone IS NOT NULL) AS phone FROM found GROUP BY page_id, name, role)
SELECT page_id, row_number() OVER (PARTITION BY page_id ORDER BY name, first) AS pos, name, role, email, phone FROM kept""")
def process_page_by_role(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = extraction.process_pages_by_role(_company_pages(spark, sf_dir))
    page_id = F.regexp_extract("source_file", "^page([0-9]+)", 1).cast("long").alias("page_id")
    return done.select(page_id, F.posexplode("people").alias("pos", "p")).select(
        "page_id", (F.col("pos") + 1).alias("pos"), "p.name", "p.role", "p.email", "p.phone"
    )


def _titled_oracle() -> str:
    collapsed = f"trim(regexp_replace(body_text, '{sql.WS}+', ' ', 'g'))"
    titles = ", ".join(f"({sql.quoted(t)})" for t in expected.LEADING_TITLES)
    pattern = f"title || '\\s+{expected.NAME_AFTER_TITLE}'"
    return f"""
WITH clean AS (SELECT p_partkey, url, {collapsed} AS t FROM ({inputs.TITLED_TEXT})),
hit AS (SELECT p_partkey, url, t, title, unnest({sql.offsets('t', pattern)}) AS o FROM clean, (VALUES {titles}) AS x(title))
SELECT p_partkey, {{columns}}, substr(o.m, length(title) + 2) AS name, title, o.at AS start,
       substr(t, greatest(o.at - 50, 0) + 1, o.at + length(o.m) + 50 - greatest(o.at - 50, 0)) AS context FROM hit"""


@query(_titled_oracle().replace("{columns}", "url"))
def title_then_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rows.title_then_name(inputs.spark_input(spark, sf_dir, inputs.TITLED_TEXT))


@query(_titled_oracle().replace("{columns}", f"url, {sql.netloc('url')} AS domain"))
def officers_by_domain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rows.officers_by_domain(inputs.spark_input(spark, sf_dir, inputs.TITLED_TEXT))


@learned
def learned_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names that a tagger finds on all company pages, with whether the rule it learned from,
    on three quarters of them, finds the same; a name of the rule alone is there as well."""
    # training, tagging and the rule each go over the sections
    pages = written(extraction.with_sections(_company_pages(spark, sf_dir)).select("url", "relevant"), "page-sections")
    sections = pages.select("url", F.posexplode("relevant").alias("section", "text"))
    held_out = F.crc32(F.col("url").cast("binary")) % 4 == 0
    known = sections.where(~held_out).select(F.col("text").alias("section"))
    model = tagger.train(tagger.by_rule(known))
    spanned = rows.attach_spans(pages, model.recogniser, "relevant")
    found = spanned.select("url", F.inline("spans")).withColumn("by_tagger", F.lit(True))
    ruled = sections.select("url", "section", F.inline(P.person_spans("text"))).select(
        "url", "section", F.col("text").alias("name"), "start", F.lit(True).alias("by_rule"))
    both = found.join(ruled, ["url", "section", "name", "start"], "full_outer")
    return both.select(
        "url", held_out.alias("held_out"), "section", "name", "start",
        F.coalesce("by_tagger", F.lit(False)).alias("by_tagger"), F.coalesce("by_rule", F.lit(False)).alias("by_rule"))
