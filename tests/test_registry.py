from __future__ import annotations

import datetime

import pytest
from pyspark.sql import functions as F

from conftest import plan
from stewardry.operators import registry as R
from stewardry.operators import reports
from stewardry.operators.responses import (
    flatten_response, has_key_positions, model_prompt, parse_person_list, parse_response,
)
from stewardry.plans.importing import import_companies
from stewardry.schemas import REGISTRY

NOW = datetime.datetime(2025, 1, 2)
OLD = datetime.datetime(2024, 1, 1)
ROWS = "row_no int, website string, company_name string, ticker string, exchange string"


def _company(id, name, officers=(), board=(), website=None, ticker=None, exchange=None, tags=("local", "local")):
    return (id, website or f"https://{name}.com".lower(), name, ticker, exchange, None, None, None,
            list(officers), list(board), tags, OLD, OLD)


@pytest.fixture
def registry(spark):
    return spark.createDataFrame([
        _company(7, "Alpha", [("Ann", "CEO")], [("Bob", "Chairman")], ticker="ALP", exchange="TSX"),
        _company(9, "Beta", [("Bob", "CFO"), ("Ann", "Director")], exchange="CSE", ticker="bet"),
        _company(4, "Gamma", [], [("Cy", "CEO")]),
    ], REGISTRY)


def test_import(spark, registry):
    rows = spark.createDataFrame([
        (2, "www.beta.org", "Beta", "B2", None), (3, "", "New One", "", "TSX"), (4, "x.com", "", "E", "E"),
        (5, "https://same.com", "Same", "S1", "TSX"), (6, "https://last.com/", "Same", "S2", "CSE"),
        (7, None, None, None, None),
    ], ROWS)
    result, summary = import_companies(registry, rows, F.lit(NOW))
    found = {r["company_name"]: r for r in result.collect()}
    assert set(found) == {"Alpha", "Beta", "Gamma", "New One", "Same"}
    beta = found["Beta"]
    assert (beta["id"], beta["website"], beta["ticker"], beta["exchange"]) == (9, "https://www.beta.org", "B2", "")
    assert len(beta["officers"]) == 2 and beta["updated_at"] == NOW and beta["created_at"] == OLD
    assert found["Alpha"]["updated_at"] == OLD and found["Alpha"]["ticker"] == "ALP"
    assert found["New One"]["website"] == "http://placeholder/new-one"
    assert tuple(found["New One"]["data_source"]) == (None, None) and found["New One"]["officers"] == []
    assert (found["Same"]["website"], found["Same"]["ticker"]) == ("https://last.com/", "S2")
    assert {found["New One"]["id"], found["Same"]["id"]} == {10, 11}
    assert {r["reason"]: r["n_rows"] for r in summary.collect()} == {
        "read": 6, "prepared": 4, "Empty company name": 2, "Using placeholder website": 1,
    }


def test_import_into_an_empty_registry(spark):
    rows = spark.createDataFrame([(i, f"https://{i}.com", f"C{i}", None, None) for i in range(500)], ROWS)
    result, _ = import_companies(spark.createDataFrame([], REGISTRY), rows, F.lit(NOW))
    assert sorted(r["id"] for r in result.collect()) == list(range(1, 501))
    again, _ = import_companies(spark.createDataFrame([], REGISTRY), rows.repartition(13), F.lit(NOW))
    assert sorted(map(repr, again.collect())) == sorted(map(repr, result.collect()))


def test_updates(spark, registry):
    schema = "id long, seq int, officers array<struct<name:string,title:string>>, board_members array<struct<name:string,title:string>>"
    updates = spark.createDataFrame([
        (7, 1, [("Old", "x")], None), (7, 2, [("Zoe", "CEO")], None), (4, 1, None, [("Y", "Director")]), (99, 1, [("N", "x")], None),
    ], schema)
    done = {r["id"]: r for r in R.update_officers(registry, updates, "llm", F.lit(NOW)).collect()}
    assert [m["name"] for m in done[7]["officers"]] == ["Zoe"] and [m["name"] for m in done[7]["board_members"]] == ["Bob"]
    assert tuple(done[7]["data_source"]) == ("llm", "local") and done[7]["updated_at"] == NOW
    assert done[9]["updated_at"] == OLD and set(done) == {4, 7, 9}
    parity = {r["id"]: r for r in R.update_local(registry, updates, "officers", F.lit(NOW), preserve_other=False).collect()}
    assert parity[7]["board_members"] == [] and tuple(parity[7]["data_source"]) == ("local", "local")


def test_searches(spark, registry):
    def names(df):
        return [r["company_name"] for r in df.collect()]

    assert names(R.companies_by_officer(registry, "Ann")) == ["Alpha", "Beta"]
    assert names(R.companies_by_role(registry, "CEO")) == ["Alpha", "Gamma"]
    assert names(R.companies_by_role(registry, "ceo")) == []
    assert names(R.company_by_name(registry, "alpha")) == []
    assert names(R.company_by_name(registry, "alpha", any_case=True)) == ["Alpha"]
    assert names(R.companies_by_ticker(registry, "BET")) == ["Beta"]
    assert names(R.companies_by_exchange(registry, "NONE")) == []
    officers = [tuple(r) for r in R.all_officers(registry).collect()]
    assert officers == [("Alpha", "Ann", "CEO", "local"), ("Beta", "Ann", "Director", "local"), ("Beta", "Bob", "CFO", "local")]


def test_search_is_pushed_to_the_file(spark, registry, tmp_path):
    from stewardry.sinks.tables import write_registry

    write_registry(registry, str(tmp_path / "r"))
    text = plan(R.company_by_website(spark.read.parquet(str(tmp_path / "r")), "https://beta.com"))
    assert "PushedFilters: [IsNotNull(website), EqualTo(website,https://beta.com)]" in text
    assert "created_at" not in text and "Exchange" not in text


def test_violations(spark, registry):
    bad = registry.unionByName(spark.createDataFrame([
        _company(1, "Alpha", website="https://beta.com"), _company(2, "Long", ticker="T" * 51),
    ], REGISTRY)).withColumn("website", F.when(F.col("id") != 2, F.col("website")))
    assert {(r["rule"], r["value"], r["n_rows"]) for r in R.validate_registry(bad).collect()} == {
        ("website is null", None, 1), ("ticker is too long", "T" * 51, 1),
        ("website is not unique", "https://beta.com", 2), ("company_name is not unique", "Alpha", 2),
    }


def test_violations_take_one_pass(spark, registry, tmp_path):
    registry.write.parquet(str(tmp_path / "r"))
    text = plan(R.validate_registry(spark.read.parquet(str(tmp_path / "r"))))
    assert text.count("FileScan") == 1 and text.count("Exchange") == 1


def test_upsert_reads_the_registry_once(spark, registry, tmp_path, monkeypatch):
    plans = []
    monkeypatch.setattr(R, "written", lambda df, label: plans.append(plan(df)) or df)
    registry.write.parquet(str(tmp_path / "r"))
    rows = spark.createDataFrame([(1, "https://n.com", "New", "", "")], ROWS)
    R.upsert_companies(spark.read.parquet(str(tmp_path / "r")), rows, F.lit(NOW))
    assert len(plans) == 1 and plans[0].count("FileScan") == 1 and plans[0].count("Join") == 1


@pytest.mark.parametrize("limit", [0, 100])
def test_people_of_a_hot_company(spark, limit, monkeypatch):
    from functools import partial

    from stewardry.operators.spread import join_hot

    monkeypatch.setattr(R, "join_hot", partial(join_hot, limit=limit))
    people = spark.createDataFrame([(7 if i % 3 else i % 5, f"P{i}") for i in range(300)] + [(None, "nobody's")], "company_id long, name string")
    registry = spark.createDataFrame([(i,) for i in (0, 7, 3)], "id long")
    rows = [tuple(r) for r in people.collect()]
    orphans = sorted(map(repr, ((r["company_id"], r["name"]) for r in R.orphan_people(people, registry).collect())))
    assert orphans == sorted(repr(r) for r in rows if r[0] not in (0, 7, 3))
    found = spark.createDataFrame([(7, "New"), (7, "Newer"), (99, "Other")], "company_id long, name string")
    replaced = sorted(repr(tuple(r)) for r in R.replace_people(people, found).collect())
    assert replaced == sorted([repr(r) for r in rows if r[0] not in (7, 99)] + [repr(tuple(r)) for r in found.collect()])


def test_registry_types(spark, registry):
    types = {r["column_name"]: r["data_type"] for r in reports.registry_types(spark, registry).collect()}
    assert types["officers"] == "array<struct<name:string,title:string>>" and len(types) == 13


def test_responses(spark, value):
    good = "{'officers': [{'name': 'A', 'title': 'CEO', 'bio': 'b'}], 'board_members': [{'name': 'B'}]}"
    parsed = value(parse_response("r"), r=good)
    assert [tuple(m) for m in parsed["officers"]] == [("A", "CEO")] and [tuple(m) for m in parsed["board_members"]] == [("B", None)]
    for bad in ("sorry", "", None, "__import__('os')", '{"officers": "x"}'):
        assert tuple(value(parse_response("r"), r=bad)) == ([], [])
    assert [tuple(p) for p in value(parse_person_list("r"), r='[{"name": "A", "role": "CEO"}]')] == [("A", "CEO")]
    assert value(parse_person_list("r"), r="none") == []
    flat = flatten_response(spark.createDataFrame([(1, good)], "id int, response string"))
    assert sorted(tuple(r) for r in flat.collect()) == [(1, "board_members", "B", "", ""), (1, "officers", "A", "CEO", "b")]


def test_key_positions(spark):
    df = spark.createDataFrame([
        (1, [("A", "ceo")], [("B", "Chairman of the Board")]), (2, [("A", "CEO")], []), (3, [("A", None)], [("B", "Chairman")]), (4, None, None),
    ], "id int, o array<struct<name:string,title:string>>, b array<struct<name:string,title:string>>")
    assert [r["k"] for r in df.orderBy("id").select(has_key_positions("o", "b").alias("k")).collect()] == [True, False, False, False]


def test_prompt(value):
    prompt = value(model_prompt("c", "t"), c="Acme {x}", t="text " * 2000)
    assert prompt.startswith("Analyze the following text about Acme {x} and") and "text " * 2000 in prompt
    assert '        {"name": "John Doe", "title": "Chief Executive Officer"}\n' in prompt
    assert len(value(model_prompt("c", "t", 10), c="", t="x" * 99)) == len(value(model_prompt("c", "t"), c="", t="")) + 10


def test_many_updates_are_not_broadcast(spark, tmp_path):
    """Lists that repeat are small as files, and a broadcast of them fills the driver."""
    member = F.array(F.struct(F.lit("Ann Moore").alias("name"), F.lit("CEO").alias("title")))
    rows = spark.range(100_000).select("id", F.lit(0).alias("seq"), member.alias("officers"))
    rows.write.parquet(str(tmp_path / "u"))
    registry = R.add_missing_columns(spark.range(100_010).selectExpr("id", "'w' AS website", "'c' AS company_name"))
    registry.write.parquet(str(tmp_path / "r"))
    updated = R.update_management(spark.read.parquet(str(tmp_path / "r")), spark.read.parquet(str(tmp_path / "u")), F.current_timestamp())
    assert "BroadcastHashJoin" not in plan(updated)
    assert updated.where(F.size("officers") == 1).count() == 100_000
