"""Secret scans, source divergence and the Merkle manifest against plain versions."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from stewardry.llm import credentials, divergence, manifest, oracles, registered

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, found string, kind int, tree string, term string, at int"
HEX = "0123456789abcdef" * 2
MIXED = "aB3" * 12
ODD = [
    (1, None, "en", "a", None), (2, "", None, "a", 0), (3, " \n\t ", "de", None, 4), (4, "One two three four", "en", "b", 18),
    (4, "One two three four", "en", "b", 18), (4, "one TWO three four", "en", "b", 18), (6, "word " * 30_000, "fr", "a", 150_000),
    (None, "no id at all", None, None, 3), (None, "no id at all", None, None, 3), (None, "another", "en", None, 3),
    (8, "Ünïcode ñandú one łódź ΑΣΣ 漢字 one", "es", "a", 9), (-9, "one two \x00\x01\x02 three", "en", "", 2**63 - 1),
    (14, f"é password = 'hunter22' AKIA{'A1' * 9} {HEX}", "en", "c", 70),
    (63, f"user_name: bob\nkey {MIXED}\nhttps://host.example.com/a", "en", "c", 5), (64, f"login=bob\n \n{MIXED}", "en", "c", 6),
    (65, "login=bob" + " x" * 250 + " pwd=abcdefg", "en", "a", 7), (2**62, "secret=token : abcdefgh token\x01=abcdefgh", "de", "c", 8),
    (66, f"client_id={MIXED} https://a.example.com/{MIXED} token={MIXED} pwd=xyzw", "", "c", 8),
]


@pytest.fixture
def odd(spark):
    return spark.createDataFrame([(*r, "x", 7, "y", "z", 2) for r in ODD], SCHEMA)


@pytest.fixture
def empty(odd):
    return odd.limit(0)


def rows_of(df) -> list[str]:
    columns = sorted(df.columns)
    return sorted(repr(tuple(r[c] for c in columns)) for r in df.collect())


def sql_rows(documents, sql: str) -> list[str]:
    table = documents.select("doc_id", "text", "lang", "source", "n_chars").toArrow()
    connection = duckdb.connect()
    connection.register("documents", table)
    result = connection.execute(sql)
    names = [c[0] for c in result.description]
    order = [names.index(c) for c in sorted(names)]
    return sorted(repr(tuple(r[i] for i in order)) for r in result.fetchall())


# --- secrets ----------------------------------------------------------------

def brute_secrets(text: str | None, reach: int = credentials.REACH) -> str:
    """All reported spans, every pair of parts compared."""
    text, spans = text or "", []
    for k, name in enumerate(credentials.KINDS):
        pattern = credentials.PATTERNS[name]
        for m in re.finditer(pattern, text):
            value = m.group()
            if name == "assign" and len(m.group(1)) < 6:
                continue
            if name == "bare" and not all(re.search(c, value) for c in ("[a-z]", "[A-Z]", "[0-9]")):
                continue
            spans.append((m.start(), k, m.end()))
    strong = len(credentials.STRONG)
    parts = [s for s in spans if s[1] < strong or not any(o[1] < s[1] and o[0] < s[2] and s[0] < o[2] for o in spans)]
    ends = [m.start() for m in re.finditer(credentials.SCOPE_END, text)]
    scope = {s: sum(e < s[0] for e in ends) for s in parts}

    def near(s, role: str) -> bool:
        return any(o != s and credentials.ROLES[credentials.KINDS[o[1]]] == role and scope[o] == scope[s]
                   and max(o[0] - s[2], s[0] - o[2]) <= reach for o in parts)

    out = []
    for s in sorted(parts):
        role = credentials.ROLES[credentials.KINDS[s[1]]]
        needed = {"identifier": ["secret"], "secret": ["identifier"], "endpoint": ["secret", "identifier"]}[role]
        if s[1] < strong or all(near(s, r) for r in needed):
            out.append(f"{credentials.KINDS[s[1]]}:{s[0]}:{s[2]}")
    return ",".join(out)


def random_configs(n: int, seed: int = 3) -> list[str]:
    rng = np.random.default_rng(seed)
    parts = ["login=bob1", "user_name: 'ann'", MIXED, MIXED + "==", f"AKIA{'B2' * 9}", "password: s3cretpw", HEX, "pwd=abcd", "host = db.example.com",
             "postgres://u:p@db:5432/x", "\n\n", "\n \t\n", "\n", " words in between ", "x" * 120, "é漢 ", "token=", '"', "api_key=abc", f"client_id={MIXED}", "y " * 150]
    return ["".join(parts[i] + (" " if rng.random() < 0.6 else "") for i in rng.integers(0, len(parts), int(rng.integers(1, 40)))) for _ in range(n)]


def test_secrets_equal_all_pairs(spark):
    texts = random_configs(300)
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    got = {r["doc_id"]: r["spans"] for r in credentials.secret_digests(docs).collect()}
    want = {i: brute_secrets(t) for i, t in enumerate(texts)}
    assert got == want
    assert sum("id:" in s for s in want.values()) > 30 and sum("endpoint:" in s for s in want.values()) > 10


def test_secrets_equal_their_sql(spark, odd):
    docs = odd.unionByName(spark.createDataFrame([(100 + i, t) for i, t in enumerate(random_configs(60, 8))], "doc_id long, text string"), allowMissingColumns=True)
    assert rows_of(credentials.secret_digests(docs)) == sql_rows(docs, oracles.secrets_sql())


def test_weak_candidates_need_their_complement(spark):
    cases = [
        ("user_name=bob pwd=abcd", "id:0:13,key:14:22"), ("user_name=bob", ""), ("pwd=abcd", ""), ("https://a.example.com pwd=abcd", ""),
        ("user_name=bob\n\npwd=abcd", ""), ("user_name=bob" + "!" * 400 + " pwd=abcd", ""),
        (f"client_id={MIXED}", ""), (f"https://h/x login=bob {MIXED}", f"endpoint:0:11,id:12:21,bare:22:{22 + len(MIXED)}"),
        ("password=abc login=bob1", ""), ("password=abcdef login=bob1", "assign:0:15,id:16:26"),
    ]
    docs = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(cases)], "doc_id long, text string")
    got = {r["doc_id"]: r["spans"] for r in credentials.secret_digests(docs).collect()}
    assert [got[i] for i in range(len(cases))] == [w for _, w in cases]


def test_strong_spans_follow_their_rules(spark):
    text = f"é PassWord\"  : 'abc+/_.=-' secret=token : abcdefgh AKIA{'Z' * 15} AKIA{'Z' * 16}a {'f' * 23}g{'0' * 24} token\x01=abcdefgh api-key=abcdefg apikey=abcdefg"
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    row = credentials.secret_digests(docs).first()
    base = [(m.start(), 0, m.end()) for m in re.finditer(r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text) if len(m.group(2)) >= 6]
    base += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if m.end() - m.start() >= 20]
    base += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if m.end() - m.start() >= 24]
    said = ",".join(f"{credentials.KINDS[k]}:{a}:{b}" for a, k, b in sorted(base))
    assert (row["n_assign"], row["n_access"], row["n_hex"]) == (2, 1, 1)
    assert row["base_sha256"] == hashlib.sha256(said.encode()).hexdigest()


def test_a_text_of_thousands_of_parts(spark):
    text = ("login=bob pwd=abcd " * 3000 + "\n\n") * 2
    docs = spark.createDataFrame([(1, text), (1, text)], "doc_id long, text string")
    rows = credentials.secret_digests(docs).collect()
    assert len(rows) == 2 and {r["n_linked"] for r in rows} == {12_000}


def test_secrets_of_odd_rows(odd, empty):
    out = credentials.found_secrets(odd)
    assert out.columns == ["doc_id", "found"] and out.count() == len(ODD) and out.where("found IS NULL").isEmpty()
    assert credentials.secret_digests(empty).collect() == []
    texts = {r["doc_id"]: r["text"] for r in odd.collect()}
    for r in out.where("size(found) > 0").collect():
        for s in r["found"]:
            assert texts[r["doc_id"]].replace("\x01", "\x03")[s["start"]:s["end"]] == s["value"]


def test_secrets_run_without_python(odd):
    plan = credentials.secret_digests(odd)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


# --- divergence -------------------------------------------------------------

def test_terms_are_the_contracts():
    table = divergence.term_table()
    for text in ("Don't STOP-it_now 3x a1b ÄÖ ﬁ漢字 İß", "", "\x00\x7f[]^_`{|}~@", "".join(map(chr, range(300)))):
        want = [m.translate({c: c + 32 for c in range(65, 91)}) for m in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text)]
        assert [t.decode() for t in text.encode().translate(table).split()] == want


def brute_divergence(rows, least: int = 3, ranks: int = 200):
    texts = [((r["lang"] or ""), (r["source"] or ""), Counter(t.translate({c: c + 32 for c in range(65, 91)}) for t in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", r["text"] or ""))) for r in rows]
    out = []
    for lang in {t[0] for t in texts}:
        mine = [t for t in texts if t[0] == lang]
        seen = Counter(term for _, _, c in mine for term in c)
        kept = sorted(t for t, n in seen.items() if n >= least)
        counts = defaultdict(Counter)
        for _, source, c in mine:
            counts[source].update({t: c[t] for t in kept if t in c})
        whole = sum(counts.values(), Counter())
        probability = lambda c: {t: 1 + 10**9 * (c[t] + 1) // (sum(c.values()) + len(kept)) for t in kept}
        p, q = {s: probability(counts[s]) for s in counts}, probability(whole)
        for s in counts:
            pairs = [(-sum((p[s][t] - p[o][t]) ** 2 // p[o][t] for t in kept), o.encode(), o) for o in counts if o != s]
            terms = [(-((p[s][t] - q[t]) ** 2 // q[t]), t.encode(), t) for t in kept if counts[s][t] and p[s][t] > q[t]]
            for part, found in (("pair", sorted(pairs)), ("term", sorted(terms)[:ranks])):
                out += [(lang, s, part, item, -v, k + 1) for k, (v, _, item) in enumerate(found)]
    return out


@pytest.fixture
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def test_divergence_equals_brute_force(spark, documents, odd):
    repeated = odd.unionByName(odd).unionByName(odd)
    for docs, least, ranks in ((documents, 3, 200), (repeated, 3, 3), (odd, 99, 5), (odd.where("lang = 'es'"), 1, 200)):
        got = [tuple(r) for r in divergence.source_divergence(docs, least, ranks).select("lang", "source", "part", "item", "value", "rank").collect()]
        assert sorted(got) == sorted(brute_divergence(docs.collect(), least, ranks))


def test_blocks_and_tiles_do_not_change_distances(documents):
    kept, groups = divergence.kept_terms(documents)
    want = rows_of(divergence.source_distances(kept, groups))
    for terms, tile in ((7, 3), (100, 1), (10_000, 7)):
        assert rows_of(divergence.source_distances(kept, groups, terms, tile)) == want


def test_counts_are_handed_on_in_time(documents):
    assert rows_of(divergence.term_counts(documents, held=50)) == rows_of(divergence.term_counts(documents))


def test_large_counts_stay_exact(spark):
    counts = spark.createDataFrame([(9 * 10**18 // 7, 9 * 10**18, 12)], "n long, total long, terms long")
    got = counts.select(divergence._probability(F.col("n"), F.col("total"), F.col("terms")).alias("p")).first()["p"]
    assert got == 1 + 10**9 * (9 * 10**18 // 7 + 1) // (9 * 10**18 + 12)


def test_divergence_of_odd_rows(odd, empty):
    out = divergence.source_divergence(odd)
    assert out.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert divergence.source_divergence(empty).collect() == []
    assert rows_of(divergence.source_divergence(odd.repartition(5))) == rows_of(out)


# --- manifest ---------------------------------------------------------------

def H(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def brute_leaf(r, more: int = 0) -> str:
    n = None if r["n_chars"] is None else r["n_chars"] + more
    return H(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (r["doc_id"], r["source"], r["lang"], n, r["text"])))


def brute_levels(nodes: list[str]) -> list[list[str]]:
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([H(*out[-1][i:i + 2]) for i in range(0, len(out[-1]), 2)])
    return out


def brute_manifest(rows):
    trees = defaultdict(list)
    for r in rows:
        trees[r["lang"]].append(r)
    names = sorted(trees, key=lambda n: (n is not None, (n or "").encode()))
    ordered = {n: sorted(trees[n], key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, brute_leaf(r))) for n in names}
    levels = {n: brute_levels([brute_leaf(r) for r in ordered[n]]) for n in names}
    top = brute_levels([levels[n][-1][0] for n in names])
    out = []
    for t, n in enumerate(names):
        for k, r in enumerate(ordered[n]):
            changed = r["doc_id"] is not None and r["n_chars"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 7 == 0
            digest, siblings = brute_leaf(r, int(changed)), []
            for tree, at in ((levels[n], k), (top, t)):
                for nodes in tree[:-1]:
                    others = [nodes[i] for i in range(at - at % 2, min(at - at % 2 + 2, len(nodes))) if i != at]
                    siblings += others
                    digest = H(*others, digest) if at % 2 else H(digest, *others)
                    at //= 2
            out.append((r["doc_id"], brute_leaf(r), levels[n][-1][0], top[-1][0], H(*siblings), digest, digest == top[-1][0]))
    return out


@pytest.mark.parametrize("levels", [1, 3, 10])
def test_manifest_equals_brute_force(documents, odd, levels):
    for docs in (documents, odd):
        got = [tuple(r) for r in manifest.manifest(docs, levels).collect()]
        assert sorted(map(repr, got)) == sorted(map(repr, brute_manifest(docs.collect())))


def test_manifest_tells_tampering(documents):
    rows = manifest.manifest(documents).withColumn("changed", manifest.is_tampered(F.col("doc_id"))).collect()
    assert {(r["changed"], r["verified"]) for r in rows} == {(True, False), (False, True)}
    assert all(r["changed"] == (zlib.crc32(str(r["doc_id"]).encode()) % 7 == 0) for r in rows)


def test_manifest_of_odd_rows(spark, odd, empty):
    assert manifest.manifest(empty).collect() == []
    one = manifest.manifest(odd.where("doc_id = 8")).first()
    assert one["leaf"] == one["subroot"] == one["root"] and one["proof_sha256"] == H()
    assert rows_of(manifest.manifest(odd.repartition(7))) == rows_of(manifest.manifest(odd))
    assert manifest.manifest(odd).count() == len(ODD)


def test_manifest_equals_its_sql(odd):
    assert rows_of(manifest.manifest(odd)) == sql_rows(odd, oracles.MANIFEST_SQL)


def test_places_are_ranks(spark, monkeypatch):
    rng = np.random.default_rng(1)
    ids = [*rng.integers(-2**40, 2**40, 300).tolist(), *range(-70, 200), *[5] * 40, *[None] * 9, -2**63, 2**63 - 1]
    rows = [(("=a", "=b")[k % 2], i, H(str(i), str(k % 5)), None) for k, i in enumerate(ids)]
    monkeypatch.setattr(manifest, "STRETCH", 20)
    df = spark.createDataFrame(rows, "tree string, doc_id long, leaf string, tampered string")
    got = sorted(tuple(r) for r in manifest.placed(df).select("tree", "at", "size", F.coalesce("doc_id", F.lit(-1)), "leaf").collect())
    want = []
    for tree in ("=a", "=b"):
        mine = sorted((r for r in rows if r[0] == tree), key=lambda r: (r[1] is not None, r[1] or 0, r[2]))
        want += [(tree, k, len(mine), -1 if r[1] is None else r[1], r[2]) for k, r in enumerate(mine)]
    assert got == want


def test_large_classes_are_handed_on_in_parts(spark, monkeypatch):
    monkeypatch.setattr(manifest, "PART", 7)
    df = spark.createDataFrame([("", 3, "a", None)] * 50 + [("", 3, "b", None)] * 3 + [("", None, "c", None)] * 20, "tree string, doc_id long, leaf string, tampered string")
    rows = sorted((r["at"], r["leaf"]) for r in manifest.placed(df).collect())
    assert rows == [*((k, "c") for k in range(20)), *((20 + k, "a") for k in range(50)), *((70 + k, "b") for k in range(3))]


@pytest.mark.parametrize("name", ["op11_secret_scans", "op12_source_divergence", "op13_merkle_manifest"])
def test_queries_equal_their_sql(spark, documents, name):
    assert rows_of(registered.QUERIES[name](spark, SF)) == sql_rows(documents, registered.ORACLES[name])
