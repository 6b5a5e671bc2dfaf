from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from conftest import plan
from stewardry import vocab
from stewardry.functions import people as P
from stewardry.operators import people as rows
from stewardry.operators.people import attach_spans
from stewardry.plans.extraction import process_pages, process_pages_by_role, with_sections
from stewardry.schemas import PEOPLE
from stewardry.sinks.summaries import json_string, render_page_summary

PAGE = "url string, title string, source_file string, body_text string, sections string"


def _people(spark, *entries):
    return spark.createDataFrame([([tuple(e) for e in entries],)], PEOPLE_ROW)


PEOPLE_ROW = "people array<struct<name:string,role:string,email:string,phone:string>>"


def _fold(spark, expression, *entries):
    padded = [(*e, *[None] * (4 - len(e))) for e in entries]
    got = _people(spark, *padded).select(expression.alias("x")).first()["x"]
    return [tuple(p) for p in got]


@pytest.mark.parametrize("section, expected", [
    ("CEO Ann Lee", "CEO"),
    ("Ann Lee loves cookies", "coo"),
    ("Vice President Ann Lee", "President"),
    ("Ann Lee, Vice President", "Vice President"),
    ("Director Ann Lee President", "President"),
    ("Treasurer x Ann Lee x Secretary", "Secretary"),
])
def test_nearest_role(spark, section, expected):
    df = spark.createDataFrame([(section,)], "s string").select(
        P.role_hits("s").alias("hits"), P.person_spans("s").alias("spans")
    )
    role = df.select(P.nearest_role(F.col("hits"), F.get("spans", F.lit(0))["start"]).alias("r")).first()["r"]
    assert role == expected


@pytest.mark.parametrize("text, at, expected", [
    ("director  president", 5, "president"),
    ("president director", 5, "president"),
    ("Director  director", 5, "Director"),
])
def test_equal_distance_goes_to_the_earlier_phrase_then_match(spark, text, at, expected):
    hits = spark.createDataFrame([(text,)], "s string").select(P.role_hits("s").alias("h"))
    assert {abs(h["start"] - at) for h in hits.first()["h"]} == {5}
    assert hits.select(P.nearest_role(F.col("h"), F.lit(at)).alias("r")).first()["r"] == expected


def test_overlapping_phrases_are_all_found(spark):
    text = "corporate secretary; vice president; corporate contact person; president treasurer"
    hits = spark.createDataFrame([(text,)], "s string").select(P.role_hits("s").alias("h")).first()["h"]
    assert {h["text"] for h in hits} == {
        "corporate secretary", "secretary", "vice president", "president", "corporate contact",
        "contact person", "treasurer",
    }
    for hit in hits:
        assert text[hit["start"]:].startswith(hit["text"])


def test_no_break_space_counts_as_space(value):
    hits = value(P.role_hits("s"), s="Chief Executive Officer")
    assert [h["rank"] for h in hits] == [2]


@pytest.mark.parametrize("role, expected", [
    ("cEo", "Chief Executive Officer"), (" vp ", "Vice President"), ("DIRECTOR", "DIRECTOR"),
    ("chairperson", "Chairman"), ("Chief Executive Officer", "Chief Executive Officer"),
])
def test_standardize_role(value, role, expected):
    assert value(P.standardize_role("r"), r=role) == expected


def test_contacts(value):
    assert value(P.extract_email("t"), t="write info@yourdomain.com now") == "info@yourdomain.com"
    assert value(P.extract_email("t"), t="no mail @ all") is None
    assert value(P.extract_phone("t"), t="1.555.555.555") is None
    assert value(P.extract_phone("t"), t="call +1 (604) 555-0199.") == "+1 (604) 555-0199"


def test_dedup_keeps_first_role_unless_board_gives_way(spark):
    got = _fold(
        spark, P.dedup_people("people"),
        ("Ann", "Director", "a@x", None), ("Bob", "President"), ("Ann", "Chairman", None, "1"),
        ("Ann", "President", "b@x"), ("Bob", "Director"), ("Ann", "Vice President"), ("Cy", "Treasurer"), ("Cy", "President"),
    )
    assert got == [
        ("Ann", "President", "b@x", "1"), ("Bob", "President", None, None), ("Cy", "Treasurer", None, None),
    ]


def test_merge_similar(spark):
    entries = [
        ("Elouafi", "President", "a@x"), ("Mustapha Elouafi", "President", None, "1"), ("Mustapha", "Director"),
        ("mustapha elouafi jr", "Director"), ("Mustapha Jr", "President"),
    ]
    assert [p[0] for p in _fold(spark, P.merge_similar_people("people"), *entries)] == [
        "Elouafi", "Mustapha", "Mustapha Jr",
    ]
    merged = _fold(spark, P.merge_similar_people("people", keep="longest", merge_contacts=True), *entries)
    assert merged[0] == ("Mustapha Elouafi", "President", "a@x", "1")


@pytest.mark.parametrize("name, substring, word", [
    ("Vincent Vega", False, True), ("Ann Moore", False, True), ("Al", False, False),
    ("Gold Mine", False, False), ("Ann Lee", True, True),
])
def test_valid_names(value, name, substring, word):
    assert value(P.is_valid_name("n"), n=name) is substring
    assert value(P.is_valid_name("n", "word"), n=name) is word


@pytest.mark.parametrize("url, role, executive, board", [
    ("https://x.com/team", "Director", True, False),
    ("https://x.com/board", "President", False, True),
    ("https://x.com/team/board", "Chief Executive Officer", True, True),
    ("https://x.com/", "Chief Executive Officer", True, True),
    ("https://x.com/", "Director", False, True),
    ("https://x.com/", "Treasurer", False, False),
])
def test_lists(value, url, role, executive, board):
    assert value(P.goes_to_executives(F.col("r"), F.col("u")), r=role, u=url) is executive
    assert value(P.goes_to_board(F.col("r"), F.col("u")), r=role, u=url) is board


def _pages(spark):
    return spark.createDataFrame([
        ("https://x.com/about", "T", "a.json", "CEO Ann Lee leads. Director Bob Ray, b@x.com. Nothing else.", None),
        ("https://x.com/news/1", "N", "b.json", "CEO Ann Lee leads.", None),
        ("https://x.com/empty", None, "c.json", "", None),
        ("https://x.com/s", "S", "d.json", "", '{"k":"President Cy Fox."}'),
    ], PAGE)


def test_process_pages(spark):
    rows_ = {r["source_file"]: r for r in process_pages(_pages(spark)).collect()}
    assert [tuple(p) for p in rows_["a.json"]["executives"]] == [("Ann Lee", "Chief Executive Officer", None, None)]
    assert [tuple(p) for p in rows_["a.json"]["board_members"]] == [
        ("Ann Lee", "Chief Executive Officer", None, None), ("Bob Ray", "Director", "b@x.com", None),
    ]
    assert rows_["b.json"]["relevant"] == rows_["b.json"]["executives"] == []
    assert rows_["c.json"]["relevant"] == []
    assert [p["name"] for p in rows_["d.json"]["executives"]] == ["Cy Fox"]
    by_role = {r["source_file"]: r["people"] for r in process_pages_by_role(_pages(spark)).collect()}
    assert [p["name"] for p in by_role["b.json"]] == ["Ann Lee"]


def test_extraction_has_no_grouping_shuffle(spark, tmp_path):
    _pages(spark).write.parquet(str(tmp_path / "p"))
    text = plan(process_pages(spark.read.parquet(str(tmp_path / "p"))))
    exchanges = [line for line in text.split("\n") if "Exchange" in line]
    assert all("RoundRobinPartitioning" in line for line in exchanges) and len(exchanges) <= 1
    assert "Python" not in text


def test_other_recognisers(spark):
    def recogniser():
        import re

        return lambda s: [(m.group(), m.start()) for m in re.finditer("Lee|Bob Ray", s)]

    spanned = attach_spans(with_sections(_pages(spark)), recogniser, "relevant")
    rows_ = {r["source_file"]: r for r in process_pages(spanned, spans="spans").collect()}
    assert [p["name"] for p in rows_["a.json"]["board_members"]] == ["Lee", "Bob Ray"]


def test_page_summary(spark):
    texts = {r["source_file"]: r["summary"] for r in render_page_summary(process_pages(_pages(spark))).collect()}
    assert texts["c.json"] == (
        "URL: https://x.com/empty\nTitle: None\nSource File: c.json\n\n=== Management Sections ===\n\n\n"
        "=== Final Executives List ===\nNo executives extracted\n\n\n"
        "=== Final Board Members List ===\nNo board members extracted"
    )
    assert '"contact_info": {\n      "email": "b@x.com"\n    }\n  }\n]' in texts["a.json"]


def test_json_string_as_the_standard_library(value):
    import json

    for text in ("plain", 'a"b\\c\n\t', "café – \U0001F600"):
        assert value(json_string(F.col("t")), t=text) == json.dumps(text)


def test_folds_of_rows_do_not_depend_on_order_or_skew(spark):
    data = [
        (p, i, f"N{i % 5}", ["Director", "President", "Treasurer", "Chairman"][i % 4],
         f"m{i}" if i % 3 else None, None)
        for p, n in ((1, 3000), (2, 10)) for i in range(n)
    ]
    schema = "page_id int, seq int, name string, role string, email string, phone string"
    df = spark.createDataFrame(data, schema)
    for fold in (rows.dedup_people_rows, rows.dedup_people_by_role):
        one = sorted(map(repr, fold(df).collect()))
        assert one == sorted(map(repr, fold(df.orderBy(F.rand(3)).repartition(7)).collect()))
    folded = {(r["page_id"], r["name"]): r for r in rows.dedup_people_rows(df).collect()}
    assert folded[(1, "N0")]["role"] == "President" and folded[(1, "N0")]["seq"] == 0
    assert folded[(1, "N1")]["email"] == "m2996"


def test_very_long_runs_of_names(value):
    run = "Ann Lee " * 30_000
    found = value(P.person_spans("s"), s="CEO " + run)
    assert [(m["start"], len(m["text"])) for m in found] == [(4, len(run) - 1)]
    many = value(P.person_spans("s"), s="Ann Lee, " * 3_000)
    assert len(many) == 3_000 and many[-1]["start"] == 9 * 2_999


def test_long_lists_take_linear_time(spark):
    import time

    def seconds(n):
        rng = [f"{chr(65 + i % 26)}{'abcdefghij'[i % 10]}{'klmnopqrst'[i // 10 % 10]}{'uvwxyzaeio'[i // 100 % 10]}n" for i in range(n)]
        text = ", ".join(f"{name} Smith Director" if i % 2 else f"{name} Moore CEO" for i, name in enumerate(rng))
        df = spark.createDataFrame([([text],)], "s array<string>")
        found = df.select(F.size(P.dedup_people(P.people_of_sections("s"))).alias("n"))
        found.collect()
        start = time.perf_counter()
        found.collect()
        return time.perf_counter() - start

    small, large = seconds(1600), seconds(6400)
    assert large < 10 * max(small, 0.3), (small, large)


def test_nearest_roles_equal_the_nearest_role(spark):
    text = "Vice President and Secretary Ann Lee CFO, Tom Moore Corporate Secretary President Ida Karl x Director Bob Ray"
    df = spark.createDataFrame([(text,)], "s string").select(P.role_hits("s").alias("h"), P.person_spans("s").alias("p"))
    one = F.transform("p", lambda p: P.nearest_role(F.col("h"), p["start"]))
    row = df.select(one.alias("one"), F.transform(P.nearest_roles(F.col("h"), F.col("p")), lambda x: x["role"]).alias("all")).first()
    assert row["one"] == row["all"] and len(row["all"]) == 4


def _lists(n, letters, seed):
    import random

    rng = random.Random(seed)
    word = lambda: "".join(rng.choice(letters) for _ in range(rng.randrange(0, 6)))
    return [([(word() if rng.random() < 0.95 else None, rng.choice(["x", "x", "y", None]), f"m{k}", None)
              for k in range(rng.randrange(0, 60))],) for _ in range(n)]


@pytest.mark.parametrize("letters", ["ab ", "abcdefgh", "aA", "é漢\U0001F600a"])
def test_merging_by_suffixes_equals_the_fold(spark, letters):
    df = spark.createDataFrame(_lists(120, letters, 4), "p " + PEOPLE.simpleString())
    both = df.select(P._merged_one_by_one(F.col("p")).alias("a"), P._merged_by_suffixes(F.col("p")).alias("b"), P.merge_similar_people("p").alias("c"))
    for r in both.collect():
        assert r["a"] == r["b"] == r["c"]


def test_short_and_long_lists_fold_alike(spark, monkeypatch):
    df = spark.createDataFrame(_lists(80, "abc", 5), "p " + PEOPLE.simpleString())
    folds = lambda: [P.dedup_people("p").alias("a"), P.dedup_by_role("p").alias("b"), P.merge_similar_people("p").alias("c")]
    text = "Vice President and Secretary Ann Lee CFO, Tom Moore Corporate Secretary President Ida Karl x Director Bob Ray"
    section = spark.createDataFrame([(text,), ("CEO Ann Lee",), ("Ann Lee",)], "s string")
    roles = lambda: section.select(P.nearest_roles(P.role_hits("s"), P.person_spans("s"))).collect()
    plain, plain_roles = df.select(*folds()).collect(), roles()
    monkeypatch.setattr(P, "_FEW_ENTRIES", 0)
    monkeypatch.setattr(P, "_FEW_PAIRS", 0)
    assert df.select(*folds()).collect() == plain and roles() == plain_roles
    monkeypatch.setattr(P, "_FEW_ENTRIES", 10**6)
    monkeypatch.setattr(P, "_FEW_PAIRS", 10**6)
    assert df.select(*folds()).collect() == plain and roles() == plain_roles


def test_thousands_of_names_merge_in_seconds(spark):
    import time

    names = [f"{chr(65 + i % 26)}{'abcdefghij'[i % 10]}{'klmnopqrst'[i // 10 % 10]}{'uvwxyzaeio'[i // 100 % 10]}n{i} Smith" for i in range(6400)]
    df = spark.createDataFrame([([(n, ["CEO", "Director"][i % 2], None, None) for i, n in enumerate([*names, *(x.split()[0] for x in names[::9])])],)], "p " + PEOPLE.simpleString())
    found = df.select(F.size(P.merge_similar_people(P.dedup_people("p"))).alias("n"))
    found.collect()
    start = time.perf_counter()
    kept = found.first()["n"]
    assert time.perf_counter() - start < 3 and 6400 <= kept < 6400 + 712


def test_the_page_is_looked_at_once_for_both_lists(spark):
    pages = spark.createDataFrame([("https://x.com/team", "t", "f", "CEO Ann Lee.", None)], PAGE)
    assert plan(process_pages(pages)).count("leadership|executive|officer") == 1


def test_matches_start_where_they_do_however_many(spark):
    texts = ["ä" + " Ann Lee x" * n for n in (0, 1, 8, 9, 64, 65, 130)]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", P.person_spans("t").alias("m"))
    for row in df.collect():
        assert [m["start"] for m in row["m"]] == [2 + 10 * i for i in range(len(row["m"]))]
        assert len(row["m"]) == row["t"].count("Ann Lee") and {m["text"] for m in row["m"]} <= {"Ann Lee"}


def test_overlapping_role_phrases_are_found_in_one_search(spark):
    texts = [
        "presidentreasurer", "Corporate  Contact Person", "VICE\npresident, corporate affairsecretary; Corporate Secretary",
        *(" and ".join((["Vice President", "director", "Corporate contact person"] * 70)[:n]) for n in (8, 9, 10, 30, 63, 64, 65, 200)),
    ]
    df = spark.createDataFrame([(t,) for t in texts], "s string").select("s", P.role_hits("s").alias("h"))
    for text, hits in df.collect():
        want = [(rank, m.start(), m.group()) for rank, p in enumerate(vocab.ROLE_PHRASES, 1)
                for m in re.finditer(p.replace(" ", r"\s+"), text, re.IGNORECASE)]
        assert sorted(map(tuple, hits)) == sorted(want), text
        assert [h["start"] for h in hits] == sorted(h["start"] for h in hits)
    # one search of the text for the phrases, one of a phrase for its white space
    assert df._jdf.queryExecution().analyzed().toString().count("regexp_replace(") == 2


def test_control_characters_make_no_role(spark):
    """They count as spaces between names, but a section has a role only if it has one with them."""
    rows = [("Ann Lee is vice\x01secretar",), ("Ann Lee met corporate\x02contact",), ("Ann\x01Lee is Director",), (None,)]
    df = spark.createDataFrame(rows, "s string").select(P.people_of_sections(F.array("s")).alias("p"))
    assert [[p["role"] for p in r["p"]] for r in df.collect()] == [[], [], ["Director"], []]
