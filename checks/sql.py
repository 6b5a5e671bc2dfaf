"""Pieces of oracle SQL (DuckDB)."""

from __future__ import annotations

from checks import expected, inputs

WS = r"[\s\x0b\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


def quoted(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def strings(values: tuple[str, ...]) -> str:
    return "(" + ", ".join(quoted(v) for v in values) + ")"


def any_of(expr: str, words: tuple[str, ...]) -> str:
    """True where the lower-cased value holds one of the words."""
    return "(" + " OR ".join(f"contains(lower({expr}), {quoted(w)})" for w in words) + ")"


def netloc(url: str) -> str:
    return rf"regexp_extract({url}, '^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)', 1)"


def domain(url: str) -> str:
    return f"replace({netloc(url)}, 'www.', '')"


def plain_domain(url: str) -> str:
    """The text after the first '://', cut at '/' and ':', lower case."""
    rest = f"CASE WHEN contains({url}, '://') THEN split_part({url}, '://', 2) ELSE {url} END"
    return f"coalesce(lower(split_part(split_part({rest}, '/', 1), ':', 1)), '')"


def decoded(name: str) -> str:
    return f"url_decode(replace({name}, '+', '%2B'))"


def stripped(value: str) -> str:
    return f"regexp_replace({value}, '^{WS}+|{WS}+$', '', 'g')"


def website(value: str) -> str:
    site = f"nullif({stripped(value)}, '')"
    return f"CASE WHEN regexp_matches({site}, '^https?://') THEN {site} ELSE 'https://' || {site} END"


def site_or_placeholder(value: str, name: str) -> str:
    return f"coalesce({website(value)}, 'http://placeholder/' || replace(lower({name}), ' ', '-'))"


def no_tags(html: str) -> str:
    out = f"regexp_replace({html}, '(?s)<!--.*?-->', '', 'g')"
    for tag in ("script", "style", "template", "rt", "rp"):
        out = rf"regexp_replace({out}, '(?is)<{tag}\b[^>]*>.*?</{tag}\s*>', '', 'g')"
    tags = r"""(?s)</?[A-Za-z](?:[^>"'']|"[^"]*"|''[^'']*'')*>|<[!?][^>]*>"""
    return f"regexp_replace({out}, '{tags}', '', 'g')"


def clean(html: str) -> str:
    """Text of markup that holds no references beyond the ones named here."""
    out = no_tags(html)
    for ref, char in (("&copy;", "©"), ("&middot;", "·"), ("&quot;", '"'), ("&lt;", "<"), ("&gt;", ">"), ("&amp;", "&")):
        out = f"replace({out}, '{ref}', '{char}')"
    return out


def sentence_list(value: str) -> str:
    return rf"string_split(regexp_replace({value}, '([.!?]){WS}+', '\1' || chr(31), 'g'), chr(31))"


def phrases(words: tuple[str, ...]) -> str:
    return "|".join(w.replace(" ", WS + "+") for w in words)


SECTION = "(?i)(?:" + "|".join(
    (phrases(expected.CONTACT_PHRASES), phrases(expected.MANAGEMENT_PHRASES), phrases(expected.ROLE_PHRASES))
) + ")"

EMAIL = expected.EMAIL_PATTERN
PHONE = expected.PHONE_PATTERN.replace(r"\s", WS).replace("[" + WS + ".-]", r"[\s.\x{a0}-]")


def role_standard(role: str) -> str:
    cases = " ".join(
        f"WHEN regexp_matches(trim({role}), '^(?:{p})$') THEN {quoted(s)}" for p, s in expected.ROLE_STANDARDS
    )
    return f"CASE {cases} ELSE {role} END"


def offsets(subject: str, pattern: str) -> str:
    """SQL list of `{at, m}`: the matches of a pattern with their offsets from 0."""
    parts = f"regexp_split_to_array({subject}, {pattern})"
    found = f"regexp_extract_all({subject}, {pattern})"
    return (
        f"list_transform(range(1, len({found}) + 1), lambda i: {{"
        f"'at': CAST(list_sum(list_transform({parts}[1:i], lambda x: length(x)))"
        f" + coalesce(list_sum(list_transform({found}[1:i-1], lambda x: length(x))), 0) AS BIGINT),"
        f" 'm': {found}[i]}})"
    )


def _masked(value: str) -> str:
    for word in expected.NOT_IN_NAMES:
        value = rf"regexp_replace({value}, '\b{word}\b', '{'_' * len(word)}', 'g')"
    return value


_NAME = r"[A-Z][A-Za-z''-]*[a-z]\b(?:[ \t]+[A-Z][A-Za-z''-]*[a-z]\b)+"
_EXEC, _BOARD = strings(expected.EXECUTIVE_ROLES), strings(expected.BOARD_ROLES)


def texts_cte(pages: str) -> str:
    """`pages`, `texts` (page_id, url, txt: the text to mine) of a company-page input."""
    sections = """CASE WHEN sections LIKE '{%' THEN array_to_string(map_values(CAST(from_json(sections, '"JSON"') AS MAP(VARCHAR, VARCHAR))), ' ')
        WHEN sections LIKE '[%' THEN array_to_string(from_json(sections, '["VARCHAR"]'), ' ')
        ELSE sections END"""
    return f"""pages_in AS ({pages}),
texts AS (SELECT *, coalesce(nullif(body_text, ''), {sections}, '') AS txt FROM pages_in)"""


def sections_cte(source: str = "texts", gate: str | None = None) -> str:
    """`relevant` (page_id, i, s): the sections of each page, in order."""
    where = f"AND NOT {gate}" if gate else ""
    return f"""
sents AS (SELECT page_id, unnest(l) AS s, generate_subscripts(l, 1) AS i
          FROM (SELECT page_id, {sentence_list('txt')} AS l FROM {source} WHERE txt <> '' {where})),
hit AS (SELECT page_id, i, s FROM sents WHERE regexp_matches(s, '{SECTION}')),
relevant AS (SELECT * FROM hit UNION ALL
             SELECT page_id, 1, txt FROM {source} WHERE txt <> '' {where}
               AND page_id NOT IN (SELECT page_id FROM hit))"""


def people_cte() -> str:
    """From `relevant`: `spans`, `hits`, `found` (page_id, i, pos0, seq, name, role, email, phone)."""
    pats = ", ".join(
        f"({n}, '(?i){p.replace(' ', WS + '+')}')" for n, p in enumerate(expected.ROLE_PHRASES, 1)
    )
    return f"""
spans AS (SELECT page_id, i, s, o.at AS pos0, substr(s, o.at + 1, length(o.m)) AS name
          FROM (SELECT *, unnest({offsets('masked', quoted(_NAME.replace("''", "'")))}) AS o
                FROM (SELECT *, {_masked('s')} AS masked FROM relevant))),
hits AS (SELECT page_id, i, rank, o.at AS pos0, substr(s, o.at + 1, length(o.m)) AS m
         FROM (SELECT page_id, i, s, rank, unnest({offsets('s', 'pat')}) AS o
               FROM relevant, (VALUES {pats}) AS r(rank, pat))),
nearest AS (SELECT s.page_id, s.i, s.s, s.pos0, s.name,
                   arg_min(h.m, {{'d': abs(h.pos0 - s.pos0), 'r': h.rank, 'a': h.pos0}}) AS raw_role
            FROM spans s JOIN hits h ON h.page_id = s.page_id AND h.i = s.i
            GROUP BY ALL),
found AS (SELECT page_id, i, pos0, i * 1000000 + pos0 AS seq, name, {role_standard('raw_role')} AS role,
                 nullif(regexp_extract(s, '{EMAIL}'), '') AS email,
                 nullif(regexp_extract(s, '{PHONE}'), '') AS phone
          FROM nearest)"""


def dedup_select(source: str) -> str:
    """One row per page and name, as the fold in order of `seq` leaves it."""
    return f"""
SELECT page_id, name, min(seq) AS seq,
       CASE WHEN arg_min(role, seq) IN {_BOARD}
            THEN coalesce(arg_min(role, seq) FILTER (WHERE role IN {_EXEC}), arg_min(role, seq))
            ELSE arg_min(role, seq) END AS role,
       arg_max(email, seq) FILTER (WHERE email IS NOT NULL) AS email,
       arg_max(phone, seq) FILTER (WHERE phone IS NOT NULL) AS phone
FROM {source} GROUP BY page_id, name"""


def merged_cte(source: str) -> str:
    """`merged` (page_id, p, pos): people after similar ones were absorbed, in order."""
    return f"""
lists AS (SELECT page_id, list({{'name': name, 'role': role, 'email': email, 'phone': phone}} ORDER BY seq) AS l
          FROM {source} GROUP BY page_id),
folded AS (SELECT page_id, list_reduce(list_transform(l, lambda x: [x]), lambda acc, x:
             CASE WHEN len(list_filter(acc, lambda q: q.role = x[1].role
                    AND (contains(lower(trim(q.name)), lower(trim(x[1].name)))
                      OR contains(lower(trim(x[1].name)), lower(trim(q.name)))))) > 0
                  THEN acc ELSE list_concat(acc, x) END) AS l FROM lists),
merged AS (SELECT page_id, unnest(l) AS p, generate_subscripts(l, 1) AS pos FROM folded)"""


def valid(name: str) -> str:
    return f"(NOT {any_of(name, expected.NON_PERSON_WORDS)} AND length({name}) >= 3)"


def listed(role: str, url: str, which: str) -> str:
    """True where a person is on the list `executive` or `board`."""
    executive, board = any_of(url, expected.EXECUTIVE_PAGE_WORDS), any_of(url, expected.BOARD_PAGE_WORDS)
    if which == "executive":
        return f"CASE WHEN {executive} AND NOT {board} THEN true WHEN {board} AND NOT {executive} THEN false ELSE {role} IN {_EXEC} END"
    return (
        f"CASE WHEN {board} AND NOT {executive} THEN true WHEN {executive} AND NOT {board} THEN false"
        f" ELSE ({role} IN {_BOARD} OR {role} = {quoted(expected.CHIEF_EXECUTIVE)}) END"
    )


def processed_ctes(pages: str = inputs.COMPANY_PAGES) -> str:
    """Everything from pages to `final` (page_id, url, list, pos, name, role, email, phone)."""
    gate = any_of("url", expected.EXCLUDED_BY_READER)
    return f"""{texts_cte(pages)},{sections_cte(gate=gate)},{people_cte()},
deduped AS ({dedup_select('found')}),{merged_cte('deduped')},
good AS (SELECT m.page_id, t.url, m.pos, m.p.name AS name, m.p.role AS role, m.p.email AS email, m.p.phone AS phone
         FROM merged m JOIN texts t ON t.page_id = m.page_id WHERE {valid('m.p.name')}),
final AS (SELECT 'executive' AS list, * FROM good WHERE {listed('role', 'url', 'executive')}
          UNION ALL SELECT 'board', * FROM good WHERE {listed('role', 'url', 'board')})"""
