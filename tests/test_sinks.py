from __future__ import annotations

import csv
import glob
import json

import pytest

from stewardry.operators import reports
from stewardry.plans.extraction import process_pages
from stewardry.session import scratch_path, shared_folder
from stewardry.sinks import summaries, tables
from stewardry.streaming.ingest import ingest_folder

PAGE = "url string, title string, source_file string, body_text string, sections string"


def _pages(spark):
    return spark.createDataFrame([
        ("https://x.com/a", "A", "a.json", "CEO Ann Lee. Director Bob Ray at b@x.com.", None),
        ("https://x.com/b", "B", "b.json", "President Ann Lee. CEO Zoe Fox.", None),
        ("https://y.com/c", "C", "c.json", "Nobody here.", None),
    ], PAGE)


def test_management_rows(spark, tmp_path):
    people = spark.createDataFrame([("Acme, \"Inc\"", "Ann\nLee", "CEO"), ("B", "C", None)], "company string, name string, role string")
    rows = tables.management_rows(people, "company")
    tables.write_management_rows(rows, str(tmp_path / "c"))
    text = [list(csv.reader(open(f, newline=""))) for f in glob.glob(str(tmp_path / "c/*.csv"))]
    assert all(t[0] == ["source", "name", "role"] for t in text)
    assert ["Acme, \"Inc\"", "Ann\nLee", "CEO"] in [row for t in text for row in t]
    tables.write_management_rows(rows, str(tmp_path / "j"), "json")
    lines = [json.loads(line) for f in glob.glob(str(tmp_path / "j/*.json")) for line in open(f)]
    assert {"source": "B", "name": "C"} in lines
    with pytest.raises(ValueError):
        tables.write_management_rows(rows, str(tmp_path / "x"), "xml")


def test_coverage_csv(spark, tmp_path):
    df = spark.createDataFrame([("A", "a.com", 3, [("n", "t")])], "company_name string, domain string, n_files long, officers array<struct<name:string,title:string>>")
    tables.write_coverage_csv(df, str(tmp_path / "c"))
    rows = [row for f in glob.glob(str(tmp_path / "c/*.csv")) for row in csv.DictReader(open(f))]
    assert rows == [
        {"company_name": "A", "domain": "a.com", "files_in_bucket": "3", "officers": '[{"name":"n","title":"t"}]'}
    ]


def test_company_json(spark, tmp_path):
    df = spark.createDataFrame([("A/B Corp", [("n", "t")]), ("C", [])], "company_name string, officers array<struct<name:string,title:string>>")
    tables.write_company_json(df, str(tmp_path / "one"), one_file_each=True)
    files = glob.glob(str(tmp_path / "one/*/*.json"))
    assert len(files) == 2 and any("company_key=a_b_corp/" in f for f in files)
    tables.write_company_json(df, str(tmp_path / "many"))
    assert {r["company_key"] for r in spark.read.json(str(tmp_path / "many")).collect()} == {"a_b_corp", "c"}


def test_company_report(spark, tmp_path):
    processed = process_pages(_pages(spark))
    owners = spark.createDataFrame([(1, "X", "https://www.x.com"), (2, "Y", "https://y.com")], "id int, company_name string, website string")
    report = summaries.render_company_report(
        reports.company_people_summary(processed, owners), reports.unique_people(reports.found_people(processed))
    )
    texts = {}
    for r in report.orderBy("company_name", "block", "place").collect():
        texts.setdefault(r["company_name"], []).append(r["text"])
    assert "\n".join(texts["Y"]) == (
        "Processing Summary\n" + "=" * 50 + "\nCompany: Y\nDomain: y.com\nFiles processed: 0\nTotal people found: 0\n\nNo people found."
    )
    text = "\n".join(texts["X"])
    assert text.startswith("Processing Summary\n" + "=" * 50 + "\nCompany: X\nDomain: x.com\nFiles processed: 2\nTotal people found: 6\n\n")
    executives = json.loads(text.split("List (JSON) ===\n")[1].split("\n\n\n===")[0])
    # Ann Lee came first and was last seen as President.
    assert [(p["name"], p["role"]) for p in executives] == [("Ann Lee", "President"), ("Zoe Fox", "Chief Executive Officer")]
    board = json.loads(text.split("List (JSON) ===\n")[2])
    assert board == [{"name": "Bob Ray", "role": "Director", "contact_info": {"email": "b@x.com"}}]
    summaries.write_company_reports(report, str(tmp_path / "r"))
    written = sorted(glob.glob(str(tmp_path / "r/company_name=X/*.txt")))
    assert "".join(open(f).read() for f in written) == text + "\n"


def test_companies_of_one_name_do_not_mix(spark, tmp_path):
    processed = process_pages(_pages(spark))
    owners = spark.createDataFrame([(1, "X", "https://www.x.com"), (2, "X", "https://y.com"), (3, "X", "https://x.com")], "id int, company_name string, website string")
    report = summaries.render_company_report(
        reports.company_people_summary(processed, owners), reports.unique_people(reports.found_people(processed)))
    assert {r["id"] for r in report.where("block = 0").collect()} == {1, 2, 3}
    summaries.write_company_reports(report, str(tmp_path / "r"))
    text = "".join(open(f).read() for f in sorted(glob.glob(str(tmp_path / "r/company_name=X/*.txt"))))
    first, second, third = (p for p in text.split("Processing Summary") if p)
    assert first.count("Ann Lee") == third.count("Ann Lee") == 2 and "No people found." in second


def test_page_summaries_are_one_file_each(spark, tmp_path):
    processed = process_pages(_pages(spark))
    summaries.write_page_summaries(processed, str(tmp_path / "lines"))
    assert spark.read.json(str(tmp_path / "lines")).count() == 3
    summaries.write_page_summaries(processed, str(tmp_path / "s"), one_file_each=True)
    assert len(glob.glob(str(tmp_path / "s/source_file=*/*.txt"))) == 3


def test_folder_ingest_is_incremental(spark, tmp_path):
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    (tmp_path / "in").mkdir()

    def put(name, text):
        (tmp_path / "in" / f"https%3A%2F%2Fx.com%2F{name}.json").write_text(json.dumps({"body_text": text}))

    put("a", "CEO Ann Lee.")
    (tmp_path / "in" / "broken.json").write_text("{")
    ingest_folder(spark, source, out, state).awaitTermination()
    assert {r["name"] for r in spark.read.parquet(out).collect()} == {"Ann Lee"}
    put("b", "President Bob Ray.")
    ingest_folder(spark, source, out, state).awaitTermination()
    found = spark.read.parquet(out).collect()
    assert sorted((r["name"], r["batch"]) for r in found) == [("Ann Lee", 0), ("Ann Lee", 0), ("Bob Ray", 1)]


def test_scratch_paths_lie_in_the_folder_the_session_names(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    assert scratch_path(spark, "x") != scratch_path(spark, "x")
