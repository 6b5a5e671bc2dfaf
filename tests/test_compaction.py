"""Page objects gathered into large files."""

from __future__ import annotations

import glob
import json
import os

import pytest
from pyspark.sql import functions as F

from stewardry.sources import compaction as C
from stewardry.sources.pages import accepted_pages, decode_pages, rejected_pages, scan_page_files, scan_pages_json


def put(folder, names, text="CEO Ann Lee."):
    for name in names:
        path = folder / f"{name}.json"
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(json.dumps({"body_text": f"{text} {name}"}))


@pytest.fixture
def folder(tmp_path):
    folder = tmp_path / "in"
    put(folder, [f"https%3A%2F%2Fx.com%2F{i}" for i in range(40)])
    put(folder, [f"deep/er/p{i}" for i in range(5)])
    (folder / "latin.json").write_bytes(b'{"body_text": "caf\xe9"}')
    (folder / "broken.json").write_text("{")
    (folder / "empty.json").write_text("")
    (folder / "notes.txt").write_text("no page")
    return folder


def same(a, b):
    return sorted(map(repr, a.collect())) == sorted(map(repr, b.collect()))


def test_pages_equal_those_of_the_files(spark, folder, tmp_path):
    store = str(tmp_path / "store")
    assert C.scan_compacted(spark, store).collect() == []
    assert C.compact_pages(spark, str(folder), store, target_bytes=200) == 48
    found = decode_pages(C.scan_compacted(spark, store))
    assert same(accepted_pages(found), scan_pages_json(spark, str(folder)))
    # files of zero bytes are not seen by the reader of files
    rejected = {r["source_file"] for r in rejected_pages(found).collect()}
    assert rejected == {r["source_file"] for r in rejected_pages(decode_pages(scan_page_files(spark, str(folder)))).collect()} | {"empty.json"}


def test_a_second_run_writes_nothing(spark, folder, tmp_path):
    store = str(tmp_path / "store")
    C.compact_pages(spark, str(folder), store)
    files = set(glob.glob(f"{store}/**/*", recursive=True))
    assert C.compact_pages(spark, str(folder), store) == 0
    assert set(glob.glob(f"{store}/**/*", recursive=True)) == files


def test_later_runs_take_new_and_changed_objects(spark, folder, tmp_path):
    store = str(tmp_path / "store")
    C.compact_pages(spark, str(folder), store)
    put(folder, ["new", "https%3A%2F%2Fx.com%2F3"], "President Bob Ray.")
    assert C.compact_pages(spark, str(folder), store) == 2
    assert len(glob.glob(f"{store}/pages/run=*")) == 2
    assert same(accepted_pages(decode_pages(C.scan_compacted(spark, store))), scan_pages_json(spark, str(folder)))


def test_a_run_without_its_manifest_is_not_read(spark, folder, tmp_path):
    store = str(tmp_path / "store")
    C.compact_pages(spark, str(folder), store)
    want = C.scan_compacted(spark, store).collect()
    os.makedirs(f"{store}/pages/run=lost")
    spark.createDataFrame([("x", "y")], "source_file string, raw string").write.mode("overwrite").parquet(f"{store}/pages/run=lost")
    assert sorted(C.scan_compacted(spark, store).collect()) == sorted(want)


def test_bins_have_about_one_size(spark):
    listing = spark.range(5000).select(F.concat(F.lit("n"), "id").alias("object_name"), (F.col("id") % 97 * 10).alias("length"))
    bins = C.planned(listing, 20_000)
    sizes = [r["s"] for r in bins.groupBy("part", "bin").agg(F.sum("length").alias("s"), F.count("*").alias("n")).collect()]
    total = sum(i % 97 * 10 for i in range(5000))
    assert sum(sizes) == total and max(sizes) < 20_000 + 970 and len(sizes) < 1.2 * total / 20_000 + 16
    assert bins.select("part").distinct().count() > 1
