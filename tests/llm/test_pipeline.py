"""The pipeline's stages, one after the other, and the registered queries."""

from __future__ import annotations

import subprocess
import sys
from pathlib import Path

from pyspark.sql import functions as F

import __spark_entry__ as entry_point
import corpus_pipeline
from stewardry.session import written

SF = "/root/testdata/sf0.001"


def test_stages_narrow_the_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").withColumns({"score": F.lit("own"), "a": F.lit(1), "kept": F.lit(False)})
    sizes = [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = written(stage(spark, docs, SF), name.replace(" ", "-"))
        assert after.columns == docs.columns
        assert after.exceptAll(docs).isEmpty()
        docs = after
        sizes.append(docs.count())
    assert sizes == sorted(sizes, reverse=True) and sizes[-1] > 0 and len(set(sizes)) > 3
    out = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert {r[0] for r in out.select("doc_id").distinct().collect()} == {r[0] for r in docs.select("doc_id").collect()}


def test_stages_of_nothing(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF).collect() == []


def test_one_query_for_each_operator():
    names = [n for n in entry_point.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert "pipeline" in entry_point.queries()


def test_the_library_does_without(tmp_path):
    """What is left without the subpackage still imports."""
    root = Path(entry_point.__file__).parent
    code = (
        "import sys\n"
        "class Gone:\n"
        "    def find_spec(self, name, path=None, target=None):\n"
        "        if name == 'corpus_pipeline' or name.startswith('stewardry.llm'):\n"
        "            raise ModuleNotFoundError(name, name=name)\n"
        "sys.meta_path.insert(0, Gone())\n"
        "import __spark_entry__ as e\n"
        "assert e.queries() and not any(n.startswith('op1') for n in e.queries())\n"
    )
    subprocess.run([sys.executable, "-c", code], cwd=root, check=True, timeout=120)
