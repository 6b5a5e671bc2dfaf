"""The same results in DuckDB's SQL, by plain ways: no index, no tiles, every pair of parts."""

from __future__ import annotations

from stewardry.llm import credentials


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _matches(kind: int, pattern: str, holds: str = "true", where: str | None = None) -> str:
    """Every match of a pattern with its place, by what stands before it; only of texts that
    match `where`, if given."""
    given, where = _quoted(f"(?:{pattern})"), _quoted(where or pattern)
    return f"""
  SELECT r, {kind} AS kind, start, start + length(value) AS stop, value FROM (
    SELECT r, unnest(list_transform(range(1, len(m) + 1), lambda i:
      (list_sum(list_transform(g[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0))::BIGINT)) AS start,
      unnest(m) AS value
    FROM (SELECT r, regexp_extract_all(text, {given}) AS m, string_split_regex(text, {given}) AS g FROM docs WHERE regexp_matches(text, {where})))
  WHERE {holds}"""


def secrets_sql() -> str:
    names, strong = credentials.KINDS, len(credentials.STRONG)
    # fixed values: the strong kinds as they are given, with their least lengths
    given = r"""((?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?)"""
    given = "".join(f"[{c.upper()}{c}]" if c.isalpha() and given[i - 1:i] != "\\" and given[i - 2:i] != "\\x" else c for i, c in enumerate(given))
    plain = [
        _matches(0, given + "[A-Za-z0-9+/_.=-]+", f"length(regexp_replace(value, {_quoted('^' + given)}, '')) >= 6"),
        _matches(1, "AKIA[A-Z0-9]+", "length(value) >= 20", "AKIA[A-Z0-9]{16}"),
        _matches(2, "[0-9a-f]+", "length(value) >= 24", "[0-9a-f]{24}"),
    ]
    mixed = "regexp_matches(value, '[a-z]') AND regexp_matches(value, '[A-Z]') AND regexp_matches(value, '[0-9]')"
    weak = [_matches(k, credentials.PATTERNS[n], mixed if n == "bare" else "true") for k, n in enumerate(names) if k >= strong]
    of_role = {role: ", ".join(str(k) for k, n in enumerate(names) if credentials.ROLES[n] == role) for role in ("identifier", "secret")}

    def near(role: str) -> str:
        return (f"EXISTS (SELECT 1 FROM parts o WHERE o.r = p.r AND o.kind IN ({of_role[role]}) AND o.scope = p.scope AND (o.start, o.kind) <> (p.start, p.kind)"
                f" AND (o.start - p.stop <= {credentials.REACH}) AND (p.start - o.stop <= {credentials.REACH}))")

    needs = {"identifier": near("secret"), "secret": near("identifier"), "endpoint": f"({near('secret')} AND {near('identifier')})"}
    reported = " OR ".join(f"(p.kind = {k} AND {needs[credentials.ROLES[n]]})" for k, n in enumerate(names) if k >= strong)
    label = "[" + ", ".join(_quoted(n) for n in names) + "][kind + 1] || ':' || start || ':' || stop"
    listed = lambda test: f"coalesce(string_agg({label}, ',' ORDER BY start, kind) FILTER (WHERE {test}), '')"
    return f"""
WITH docs AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
found AS MATERIALIZED ({" UNION ALL ".join(plain + weak)}),
breaks AS MATERIALIZED ({_matches(-1, credentials.SCOPE_END)}),
parts AS MATERIALIZED (
  SELECT f.*, (SELECT count(*) FROM breaks b WHERE b.r = f.r AND b.start < f.start) AS scope FROM found f
  WHERE kind < {strong} OR NOT EXISTS (
    SELECT 1 FROM found o WHERE o.r = f.r AND o.kind < f.kind AND o.start < f.stop AND f.start < o.stop)),
reported AS (SELECT * FROM parts p WHERE kind < {strong} OR {reported})
SELECT any_value(d.doc_id) AS doc_id, count(*) FILTER (WHERE kind = 0) AS n_assign, count(*) FILTER (WHERE kind = 1) AS n_access,
  count(*) FILTER (WHERE kind = 2) AS n_hex, sha256({listed(f"kind < {strong}")}) AS base_sha256, {listed("kind IS NOT NULL")} AS spans,
  count(*) FILTER (WHERE kind >= {strong}) AS n_linked
FROM docs d LEFT JOIN reported p ON p.r = d.r GROUP BY d.r"""


DIVERGENCE_SQL = r"""
WITH docs AS MATERIALIZED (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w
  FROM documents),
terms AS MATERIALIZED (SELECT r, lang, source, unnest(w) AS term FROM docs),
kept AS MATERIALIZED (SELECT lang, term, count(*) AS n FROM terms GROUP BY ALL HAVING count(DISTINCT r) >= 3),
counts AS MATERIALIZED (SELECT lang, source, term, count(*) AS n FROM terms SEMI JOIN kept USING (lang, term) GROUP BY ALL),
langs AS (SELECT l.lang, count(k.term)::HUGEINT AS v, coalesce(sum(k.n), 0)::HUGEINT AS total FROM (SELECT DISTINCT lang FROM docs) l LEFT JOIN kept k USING (lang) GROUP BY l.lang),
groups AS (SELECT g.lang, g.source, coalesce(sum(c.n), 0)::HUGEINT AS total FROM (SELECT DISTINCT lang, source FROM docs) g LEFT JOIN counts c USING (lang, source) GROUP BY ALL),
given AS MATERIALIZED (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
    1 + 1000000000::HUGEINT * (coalesce(c.n, 0) + 1) // (g.total + l.v) AS p,
    1 + 1000000000::HUGEINT * (k.n + 1) // (l.total + l.v) AS lang_p
  FROM groups g JOIN langs l USING (lang) JOIN kept k USING (lang) LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
pairs AS (
  SELECT a.lang, a.source, b.source AS item, coalesce(sum((x.p - y.p) * (x.p - y.p) // y.p), 0)::BIGINT AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN given x ON x.lang = a.lang AND x.source = a.source
  LEFT JOIN given y ON y.lang = b.lang AND y.source = b.source AND y.term = x.term GROUP BY ALL),
valued AS (
  SELECT lang, source, 'pair' AS part, item, value FROM pairs
  UNION ALL SELECT lang, source, 'term', term, ((p - lang_p) * (p - lang_p) // lang_p)::BIGINT FROM given WHERE n > 0 AND p > lang_p),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INT AS rank FROM valued)
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 200"""

MANIFEST_SQL = r"""
WITH RECURSIVE steps(b, k, x) AS (
  SELECT b, 0, b::BIGINT FROM range(256) t(b)
  UNION ALL SELECT b, k + 1, CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END FROM steps WHERE k < 8),
crc AS MATERIALIZED (SELECT list(x ORDER BY b) AS t FROM steps WHERE k = 8),
rows AS MATERIALIZED (
  SELECT *, CASE WHEN doc_id IS NULL THEN '-' ELSE strlen(doc_id::VARCHAR) || ':' || doc_id END
      || CASE WHEN source IS NULL THEN '-' ELSE strlen(source) || ':' || source END
      || CASE WHEN lang IS NULL THEN '-' ELSE strlen(lang) || ':' || lang END AS head,
    CASE WHEN text IS NULL THEN '-' ELSE strlen(text) || ':' || text END AS tail,
    coalesce(xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, length(doc_id::VARCHAR) + 1), lambda i: ascii(substr(doc_id::VARCHAR, i, 1))::BIGINT)),
      lambda c, b: xor(c >> 8, t[1 + (xor(c, b) & 255)])), 4294967295) % 7 = 0, false) AND doc_id IS NOT NULL AND n_chars IS NOT NULL AS changed
  FROM documents, crc),
leaves AS MATERIALIZED (
  SELECT lang, doc_id, sha256(head || CASE WHEN n_chars IS NULL THEN '-' ELSE strlen(n_chars::VARCHAR) || ':' || n_chars END || tail) AS leaf,
    CASE WHEN changed THEN sha256(head || strlen((n_chars::HUGEINT + 1)::VARCHAR) || ':' || (n_chars::HUGEINT + 1) || tail) END AS tampered,
  FROM rows),
places AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place FROM leaves),
trees(lang, level, nodes) AS (
  SELECT lang, 0, list(leaf ORDER BY place) FROM places GROUP BY lang
  UNION ALL SELECT lang, level + 1, list_transform(range(1, len(nodes) + 1, 2), lambda i: sha256(nodes[i] || coalesce(nodes[i + 1], ''))) FROM trees WHERE len(nodes) > 1),
subroots AS MATERIALIZED (
  SELECT lang, arg_max(nodes, level)[1] AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS tree_at FROM trees GROUP BY lang),
tops(level, nodes) AS (
  SELECT 0, list(subroot ORDER BY tree_at) FROM subroots
  UNION ALL SELECT level + 1, list_transform(range(1, len(nodes) + 1, 2), lambda i: sha256(nodes[i] || coalesce(nodes[i + 1], ''))) FROM tops WHERE len(nodes) > 1),
grown AS MATERIALIZED (SELECT lang, list(nodes ORDER BY level)[:-2] AS lower FROM trees GROUP BY lang),
top AS MATERIALIZED (SELECT list(nodes ORDER BY level)[:-2] AS upper, arg_max(nodes, level)[1] AS root FROM tops),
steps_of AS (
  SELECT p.doc_id, leaf, tampered, subroot, root,
    list_transform(range(1, len(lower) + 1), lambda l: CASE WHEN (place >> (l - 1)) & 1 = 1 THEN 'L' || lower[l][place >> (l - 1)] ELSE 'R' || coalesce(lower[l][(place >> (l - 1)) + 2], '') END)
    || list_transform(range(1, len(upper) + 1), lambda l: CASE WHEN (tree_at >> (l - 1)) & 1 = 1 THEN 'L' || upper[l][tree_at >> (l - 1)] ELSE 'R' || coalesce(upper[l][(tree_at >> (l - 1)) + 2], '') END) AS path
  FROM places p JOIN subroots s ON s.lang IS NOT DISTINCT FROM p.lang JOIN grown g ON g.lang IS NOT DISTINCT FROM p.lang, top),
proved AS (
  SELECT *, sha256(array_to_string(list_transform(path, lambda x: substr(x, 2)), '')) AS proof_sha256,
    list_reduce(list_prepend(coalesce(tampered, leaf), path), lambda d, x: CASE WHEN x[1] = 'L' THEN sha256(substr(x, 2) || d) ELSE sha256(d || substr(x, 2)) END) AS folded_root
  FROM steps_of)
SELECT doc_id, leaf, subroot, root, proof_sha256, folded_root, folded_root = root AS verified FROM proved"""
