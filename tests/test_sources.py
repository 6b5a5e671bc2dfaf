from __future__ import annotations

import json
from urllib.parse import quote

import pytest

from stewardry.sources import companies, management, objects, pages


def _put(folder, name, content):
    path = folder / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(content if isinstance(content, bytes) else content.encode())


@pytest.fixture
def page_folder(tmp_path):
    def name(url):
        return quote(url, safe="") + ".json"

    _put(tmp_path, name("https://a.com/x y+z"), '{"title": "T", "meta_description": NaN, "body_text": "<b>hi</b>", "markdown_content": ""}')
    _put(tmp_path, name("http://info@b.com/"), '{"title": NaN, "body_text": NaN, "markdown_content": ""}')
    _put(tmp_path, name("http://c.com/"), "{broken")
    _put(tmp_path, name("http://d.com/"), '{"body_text": "café"}'.encode("latin-1"))
    _put(tmp_path, "sub/" + name("http://e.com/"), '{"body_text": "", "markdown_content": "", "content": "<p>c</p>"}')
    _put(tmp_path, name("http://f.com/"), '{\n"title": "multi\\nline",\n"body_text": "t",\n"sections": {"a": "x"}\n}')
    _put(tmp_path, name("http://g.com/"), "[1, 2]")
    _put(tmp_path, name("http://h.com/"), "")
    _put(tmp_path, "notes.txt", "x")
    return str(tmp_path)


def test_scan_pages(spark, page_folder):
    found = {r["url"]: r for r in pages.scan_pages_json(spark, page_folder).collect()}
    assert set(found) == {"https://a.com/x y+z", "http://d.com/", "http://e.com/", "http://f.com/"}
    first = found["https://a.com/x y+z"]
    assert (first["body_text"], first["title"], first["meta_description"]) == ("hi", "T", None)
    assert first["source_file"] == quote("https://a.com/x y+z", safe="") + ".json"
    assert found["http://d.com/"]["body_text"] == "café"
    assert found["http://e.com/"]["body_text"] == "c"
    assert found["http://e.com/"]["source_file"] == "sub/" + quote("http://e.com/", safe="") + ".json"
    assert found["http://f.com/"]["sections"] == '{"a":"x"}'


def test_rejected_pages(spark, page_folder):
    decoded = pages.decode_pages(pages.scan_page_files(spark, page_folder))
    reasons = {r["source_file"]: r["reject_reason"] for r in pages.rejected_pages(decoded).collect()}
    assert sorted(reasons.values()) == ["body_text is null", "malformed json", "malformed json"]


def test_scan_json_dir(spark, tmp_path):
    _put(tmp_path, "a.json", '{"company": "C", "text": "t"}')
    _put(tmp_path, "b.json", "nope")
    found = pages.scan_json_dir(spark, str(tmp_path)).select(pages.documented_page("fields").alias("p")).collect()
    assert [tuple(r["p"]) for r in found] == [("C", "t")]


def test_objects(spark, page_folder):
    listing = objects.scan_objects(spark, page_folder)
    assert objects.count_objects(listing).first()["n_objects"] == 8
    some = objects.list_objects(listing, "https%3A").collect()
    assert [r["object_name"] for r in some] == ["https%3A%2F%2Fa.com%2Fx%20y%2Bz.json"]
    assert objects.sample_objects(listing, 100).count() == 8
    sample = objects.sample_objects(listing, 2).collect()
    assert len(sample) == 2 and all(len(r["file_name"]) == 37 for r in sample)


def test_company_lists(spark, tmp_path):
    _put(tmp_path, "a.csv", "﻿Website,Company Name,Ticker,Exchange\nhttps://x.com,Company One,ONE,TSX\n,\"Two, Inc\",,\n")
    _put(tmp_path, "b.csv", "URL,Name,Exchange,Ticker\nhttps://y.com,Three,NYSE,THR")
    one = companies.scan_companies_csv(spark, str(tmp_path / "a.csv")).collect()
    assert [tuple(r) for r in one] == [("https://x.com", "Company One", "ONE", "TSX"), (None, "Two, Inc", None, None)]
    two = companies.scan_companies_csv(spark, str(tmp_path / "b.csv")).collect()
    assert [tuple(r) for r in two] == [("https://y.com", "Three", "THR", "NYSE")]


def test_local_management(spark, tmp_path):
    _put(tmp_path, "a_b_corp.json", json.dumps({
        "officers": [{"name": "A", "title": "CEO"}, {"name": "B"}, "x", None, {"name": None, "title": "t"}, {"name": 5, "title": "CFO"}],
        "board_members": {"name": "no list"},
    }))
    _put(tmp_path, "empty.json", '{"officers": [], "board_members": [{"name": "only"}]}')
    local = management.scan_local_management(spark, str(tmp_path))
    asked = spark.createDataFrame([("A/B Corp",), ("Empty",), ("None",)], "company_name string")
    found = {r["company_name"]: r for r in management.with_local_management(asked, local).collect()}
    assert [tuple(m) for m in found["A/B Corp"]["local_officers"]] == [("A", "CEO"), ("5", "CFO")]
    for company, column in (("A/B Corp", "local_board_members"), ("Empty", "local_officers"), ("Empty", "local_board_members"), ("None", "local_officers")):
        assert found[company][column] is None


def test_names_are_paths_below_the_folder(spark, tmp_path):
    for name in ("sub1/a.json", "sub2/a.json", "b.json"):
        _put(tmp_path, name, "{}")
    for folder in (str(tmp_path), f"file://{tmp_path}/"):
        listing = objects.scan_objects(spark, folder)
        assert sorted(r["object_name"] for r in listing.collect()) == ["b.json", "sub1/a.json", "sub2/a.json"]
        assert [r["object_name"] for r in objects.list_objects(listing, "sub1/").collect()] == ["sub1/a.json"]


def test_the_schema_of_a_value_is_found_once_for_its_type(spark):
    from conftest import plan
    from stewardry.operators.structure import json_structure

    docs = spark.createDataFrame([('{"a": [1, {"b": 2.5}], "c": 12345678901234567890123}',)], "doc string")
    found = json_structure(docs, "doc")
    assert 0 < plan(found).lower().count("schemaofvariant") <= 8
    assert {tuple(r) for r in found.collect()} == {("a", "list", 1), ("a", "list[int]", 1), ("c", "int", 1)}
