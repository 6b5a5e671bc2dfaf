from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from conftest import plan
from stewardry.operators import matching
from stewardry.operators.reports import files_per_domain
from stewardry.operators.structure import json_structure


@pytest.mark.parametrize("limit", [0, 10_000])
def test_containment_join_equals_brute_force(spark, limit):
    random.seed(5)
    domains = ["a", "bc", "x.c", "gold.co", "goldmine.com", "mine.com", "www.goldmine.com", "verylongdomainname.example.org", "zzz.zz"]
    domains += ["".join(random.choice("abc.") for _ in range(random.randint(1, 12))) for _ in range(60)]
    domains = sorted(set(domains))
    names = ["https%3A%2F%2Fwww.goldmine.com%2Fto%3Dmine.com.json", "", "b"]
    names += ["".join(random.choice("abc.") for _ in range(random.randint(1, 40))) for _ in range(300)]
    # A third of all names share one host.
    names += [f"verylongdomainname.example.org%2F{i}" for i in range(150)]
    names = sorted(set(names))
    found = matching.objects_holding_domain(
        spark.createDataFrame([(n,) for n in names], "object_name string"),
        spark.createDataFrame([(d,) for d in domains], "domain string"), limit,
    )
    text = plan(found)
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    got = sorted((r["object_name"], r["domain"]) for r in found.collect())
    assert got == sorted((n, d) for n in names for d in domains if d in n)


COMPANIES = "id int, company_name string, website string"


@pytest.fixture
def companies(spark):
    return spark.createDataFrame([
        (1, "A", "https://www.a.com/x"), (2, "B", "http://b.com"), (None, "C", "http://c.com"), (4, "D", None), (5, "E", "nonsense"),
        (6, "F", ""),
    ], COMPANIES)


@pytest.fixture
def listing(spark):
    return spark.createDataFrame([(n,) for n in (
        "https%3A%2F%2Fa.com%2F1.json", "https%3A%2F%2Fwww.a.com%2F2.json", "https%3A%2F%2Fwww.a.com%2Fnews.json",
        "https%3A%2F%2Fb.com.au%2F.json", "https%3A%2F%2Fc.com%2F.json", "no-scheme.json", "bad%zz.json",
    )], "object_name string")


def test_modes(companies, listing):
    host = {(r["company_name"], r["object_name"]) for r in matching.pages_for_company(listing, companies).collect()}
    assert host == {("A", "https%3A%2F%2Fa.com%2F1.json"), ("A", "https%3A%2F%2Fwww.a.com%2F2.json"), ("C", "https%3A%2F%2Fc.com%2F.json")}
    held = {(r["company_name"], r["object_name"]) for r in matching.pages_for_company(listing, companies, "contains").collect()}
    assert ("A", "https%3A%2F%2Fwww.a.com%2F2.json") in held and ("B", "https%3A%2F%2Fb.com.au%2F.json") in held
    assert ("A", "https%3A%2F%2Fa.com%2F1.json") not in held
    with pytest.raises(ValueError):
        matching.pages_for_company(listing, companies, "prefix")


def test_counts_and_gate(companies, listing):
    counts = files_per_domain(listing)
    assert {r["domain"]: r["n_files"] for r in counts.collect()} == {"a.com": 3, "b.com.au": 1, "c.com": 1}
    gated = {r["company_name"]: (r["n_files"], r["skip_reason"]) for r in matching.company_pages_gate(companies, counts).collect()}
    assert gated == {
        "A": (3, None), "B": (0, "no files"), "C": (1, "no id"), "D": (0, "no website"), "E": (0, "no files"), "F": (0, "no website"),
    }


def test_counting_happens_before_the_join(companies, listing):
    text = plan(matching.company_file_counts(companies, files_per_domain(listing)))
    assert text.index("Join") < text.index("HashAggregate")


def test_structure(spark):
    docs = spark.createDataFrame([
        ('{"a": [], "b": [null], "c": [[1]], "d": {"e": {"f": 1.0}}, "n": NaN, "s": "NaN, x", "big": 12345678901234567890}',),
        ("[1, 2]",), ("broken",), ('{"a": "x"}',),
    ], "doc string")
    found = {(r["path"], r["type"]): r["n"] for r in json_structure(docs, "doc").collect()}
    assert found == {
        ("a", "list"): 1, ("a", "list[empty]"): 1, ("a", "str"): 1, ("b", "list"): 1, ("b", "list[NoneType]"): 1,
        ("c", "list"): 1, ("c", "list[list]"): 1, ("c", "list[int]"): 1, ("d", "dict"): 1, ("d.e", "dict"): 1,
        ("d.e.f", "float"): 1, ("n", "NoneType"): 1, ("s", "str"): 1, ("big", "int"): 1, ("", "list[int]"): 1,
    }


def test_structure_to_the_last_level(spark):
    deep = "".join(f'{{"k{i}": ' for i in range(40)) + "1" + "}" * 40
    lists = "[" * 30 + "]" * 30
    found = json_structure(spark.createDataFrame([(deep,), (lists,)], "doc string"), "doc").collect()
    paths = {r["path"] for r in found}
    assert ".".join(f"k{i}" for i in range(40)) in paths
    assert {r["type"]: r["n"] for r in found if r["path"] == ""} == {"list[list]": 29, "list[empty]": 1}


@pytest.mark.parametrize("mode", ["host", "contains"])
def test_a_placeholder_is_no_site(spark, mode):
    companies = spark.createDataFrame(
        [(1, "http://placeholder/one", "One"), (2, "http://placeholder/two", "Two"), (3, "https://c.com", "Three")],
        "id long, website string, company_name string")
    objects = spark.createDataFrame(
        [("https%3A%2F%2Fx.com%2Fimg%2Fplaceholder.json",), ("https%3A%2F%2Fc.com%2F100%.json",), ("http%3A%2F%2Fplaceholder%2Fone.json",)],
        "object_name string")
    assert [r["id"] for r in matching.pages_for_company(objects, companies, mode=mode).collect()] == [3]
    gate = {r["id"]: r["skip_reason"] for r in matching.company_pages_gate(companies, files_per_domain(objects)).collect()}
    assert gate == {1: "no website", 2: "no website", 3: None}


@pytest.mark.parametrize("limit", [0, 100])
def test_hot_keys_join_completely(spark, limit):
    from stewardry.operators.spread import join_hot

    facts = [("hot" if i % 3 else f"k{i % 7}", f"u{i}") for i in range(900)]
    owners = [("hot", 1), ("hot", 2), ("k0", 3), ("k5", 4), ("unused", 5)]
    joined = join_hot(
        spark.createDataFrame(facts, "key string, url string"),
        spark.createDataFrame(owners, "key string, id int"), "key", "url", limit=limit,
    )
    expected = sorted((k, u, i) for k, u in facts for o, i in owners if o == k)
    assert sorted(tuple(r) for r in joined.select("key", "url", "id").collect()) == expected


def test_modes_without_broadcast(companies, listing):
    for mode in ("host", "contains"):
        both = [
            sorted(map(repr, matching.pages_for_company(listing, companies, mode, broadcast_companies=n).collect()))
            for n in (0, 100)
        ]
        assert both[0] == both[1] and both[0]


@pytest.mark.parametrize("how", ["left", "left_semi", "left_anti"])
@pytest.mark.parametrize("limit", [0, 100])
def test_hot_keys_in_other_joins(spark, how, limit):
    from stewardry.operators.spread import join_hot

    facts = [("hot" if i % 3 else f"k{i % 7}", f"u{i}") for i in range(300)] + [(None, "u")]
    owners = [("hot", 1), ("k0", 3), ("k5", 4)]
    f, o = spark.createDataFrame(facts, "key string, url string"), spark.createDataFrame(owners, "key string, id int")
    got = join_hot(f, o, "key", "url", limit=limit, how=how)
    assert sorted(map(repr, got.select(*sorted(got.columns)).collect())) == sorted(map(repr, f.join(o, "key", how).select(*sorted(got.columns)).collect()))


def test_nothing_runs_before_a_hot_join_is_asked_for(spark):
    from stewardry.operators.spread import join_hot

    broken = spark.range(3).select(F.raise_error(F.lit("ran")).alias("key"))
    join_hot(spark.createDataFrame([("a", "u")], "key string, url string"), broken, "key", "url")
    with pytest.raises(ValueError):
        join_hot(broken, broken, "key", "key", how="right")


def test_copies_of_many_owners_are_not_broadcast(spark, tmp_path):
    from stewardry.operators.spread import join_hot

    # under the limit of a broadcast as a file, beyond it with a copy for each salt
    spark.range(300_000).selectExpr("id AS key").write.parquet(str(tmp_path / "many"))
    spark.range(10).selectExpr("id AS key").write.parquet(str(tmp_path / "few"))
    facts = spark.range(600_000).selectExpr("id % 400000 AS key", "id AS u")
    many, few = (join_hot(facts, spark.read.parquet(str(tmp_path / n)), "key", "u") for n in ("many", "few"))
    assert "BroadcastHashJoin" not in plan(many) and many.count() == 500_000
    assert "BroadcastHashJoin" in plan(few) and few.count() == 20


def test_names_are_read_once_to_find_domains(spark, tmp_path):
    spark.createDataFrame([(f"https%3A%2F%2Fwww.d{i}.com%2F", ) for i in range(50)], "object_name string").write.parquet(str(tmp_path / "n"))
    domains = spark.createDataFrame([("d1.com",), ("x",), ("www.d22.com",)], "domain string")
    text = plan(matching.objects_holding_domain(spark.read.parquet(str(tmp_path / "n")), domains))
    assert text.count("/n]") == 1


def test_domains_beyond_the_filter_are_found(spark, monkeypatch):
    monkeypatch.setattr(matching, "_LEAST_BITS", 64)
    monkeypatch.setattr(matching, "_MOST_BITS", 64)
    domains = [f"d{i}.example.com" for i in range(200)]
    names = spark.createDataFrame([(f"https%3A%2F%2F{d}%2Fx",) for d in domains], "object_name string")
    found = matching.objects_holding_domain(names, spark.createDataFrame([(d,) for d in domains], "domain string"))
    assert found.count() == sum(a in f"https%3A%2F%2F{b}%2Fx" for a in domains for b in domains)


def test_names_of_a_site_with_few_owners_are_dealt_to_many_tasks(spark):
    """A name for every owner comes out, so that one task would make the whole product of a large site."""
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {key: spark.conf.get(key) for key in settings}
    companies = spark.createDataFrame([(i, f"C{i}", "https://large.site.com") for i in range(20)] + [(99, "X", "https://other.com")], COMPANIES)
    names = spark.createDataFrame([(f"https%3A%2F%2Flarge.site.com%2F{i}.json",) for i in range(400)], "object_name string")
    try:
        for key, to in settings.items():
            spark.conf.set(key, to)
        found = matching.pages_for_company(names, companies, mode="contains").withColumn("task", F.spark_partition_id()).collect()
    finally:
        for key, was in before.items():
            spark.conf.set(key, was)
    assert sorted((r["id"], r["object_name"]) for r in found) == sorted((i, f"https%3A%2F%2Flarge.site.com%2F{n}.json") for i in range(20) for n in range(400))
    assert len({r["task"] for r in found}) > 2


def test_a_domain_is_looked_up_by_a_piece_that_few_others_have(spark):
    domains = [f"www.name{i}.example.org" for i in range(500)] + ["", "a", "ab", "abc.com", "www.example.org"]
    pieces = {r["domain"]: r["gram"] for r in matching._anchors(spark.createDataFrame([(d,) for d in domains], "domain string")).collect()}
    assert set(pieces) == set(domains) - {""}
    assert all(gram in domain and len(gram) == (8 if len(domain) >= 8 else 3 if len(domain) >= 3 else 1) for domain, gram in pieces.items())
    assert all(sum(pieces[d] in other for other in domains) <= 12 for d in domains[:500])
