"""Listing and copying of objects, empty and nested ones among them."""

from __future__ import annotations

import glob
import hashlib
import os

import pytest
from pyspark.sql.types import StructType

from stewardry.sources import object_store as O
from stewardry.sources.objects import count_objects, sample_objects

OBJECTS = {
    "a.json": "x", "empty.json": "", "b/c.json": "", "b/d/e%3A.json": "yy", "b/d/f.json": "z" * 9, "bb/z.json": "zz", "c/ü ñ.json": "é",
    "_hidden/h.json": "no", "b/_tmp/q": "no", ".dot": "no",
}
SEEN = {n: c for n, c in OBJECTS.items() if not any(p[0] in "_." for p in n.split("/"))}


@pytest.fixture
def folder(tmp_path):
    for name, content in OBJECTS.items():
        path = tmp_path / "objects" / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(content)
    (tmp_path / "objects" / "nothing here").mkdir()
    return str(tmp_path / "objects")


def test_all_objects_are_listed(spark, folder):
    for path in (folder, f"file://{folder}", folder + "/"):
        found = {r["object_name"]: r["length"] for r in O.scan_store(spark, path).collect()}
        assert found == {n: len(c.encode()) for n, c in SEEN.items()}
    assert count_objects(O.scan_store(spark, folder)).first()["n_objects"] == len(SEEN)


@pytest.mark.parametrize("prefix", ["", "b", "b/", "b/d", "b/d/", "a", "a.json", "zz", "b/c.json"])
def test_prefixes(spark, folder, prefix):
    assert {r["object_name"] for r in O.scan_store(spark, folder, prefix).collect()} == {n for n in SEEN if n.startswith(prefix)}


def test_the_driver_lists_the_first_level_alone(folder):
    parts = O._ObjectReader(folder, "", StructType()).partitions()
    assert sorted(os.path.basename(p.path) for p in parts if isinstance(p, O._Folder)) == ["b", "bb", "c", "nothing here"]
    assert sorted(os.path.basename(f[0]) for p in parts if isinstance(p, O._Names) for f in p.found) == ["a.json", "empty.json"]
    assert [p.path for p in O._ObjectReader(folder, "b/d/", StructType()).partitions()] == [f"{folder}/b"]


def test_contents(spark, folder):
    found = {r["object_name"]: bytes(r["content"]).decode() for r in O.scan_store(spark, folder, content=True).collect()}
    assert found == SEEN


def test_missing_and_empty_folders(spark, tmp_path):
    (tmp_path / "none").mkdir()
    assert O.scan_store(spark, str(tmp_path / "none")).collect() == []
    assert O.scan_store(spark, str(tmp_path / "not there")).collect() == []


def test_a_sample_is_stored(spark, folder, tmp_path):
    target = str(tmp_path / "sample")
    for _ in range(2):
        O.store_objects(sample_objects(O.scan_store(spark, folder), 4), folder, target)
        stored = {os.path.basename(p): open(p).read() for p in glob.glob(f"{target}/*.json")}
        assert stored == {hashlib.md5(n.encode()).hexdigest() + ".json": SEEN[n] for n in sorted(SEEN)[:4]}
    assert not glob.glob(f"{target}/_pending/*")
    assert {r["object_name"] for r in O.scan_store(spark, target).collect()} == set(stored)


def test_a_failed_copy_leaves_nothing(spark, folder, tmp_path):
    target = str(tmp_path / "sample")
    rows = spark.createDataFrame([("a.json", "1"), ("b/c.json", "2"), ("missing", "3")], "object_name string, file_name string").repartition(3)
    with pytest.raises(Exception, match="missing"):
        O.store_objects(rows, folder, target)
    assert O.scan_store(spark, target).collect() == [] and not glob.glob(f"{target}/_pending/*")


def test_large_objects_are_copied_in_blocks(spark, tmp_path):
    (tmp_path / "in").mkdir()
    content = os.urandom((1 << 22) * 2 + 17)
    (tmp_path / "in" / "big").write_bytes(content)
    O.store_objects(spark.createDataFrame([("big", "x/y")], "object_name string, file_name string"), str(tmp_path / "in"), str(tmp_path / "out"))
    assert (tmp_path / "out" / "x" / "y").read_bytes() == content
