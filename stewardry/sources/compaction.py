"""Page objects gathered into few large files, so that later runs do not open each again.

A run lists the folder, leaves out what earlier runs have taken, plans the rest into bins of
about one size by the objects' lengths and lets a task per bin read its objects and write
them as one file. Names and lengths alone are shuffled, never contents. A run counts once its
manifest, `manifest/run=<run>`, is written; files of a run that broke off are not read.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stewardry.session import written
from stewardry.sources.object_store import read_bytes, scan_store

#: Bytes of the objects of a bin, about, and bins that are planned together.
TARGET_BYTES, _BINS_A_PART = 256 << 20, 16
#: Bytes of contents handed on at once.
_BATCH_BYTES = 16 << 20

_TAKEN = "object_name string, length long, modificationTime timestamp, run string"
_PAGES = "source_file string, raw string, run string"


def planned(listing: DataFrame, target_bytes: int = TARGET_BYTES) -> DataFrame:
    """`listing` (object_name, length) with `part` and `bin`: objects of one bin have
    `target_bytes` together, but for the last object and the last bin of a part.

    Names are dealt to parts by hash; a part holds as many names as some bins take.
    """
    total = listing.agg(F.sum("length"), F.count(F.lit(1))).first()
    parts = max(1, -(-(total[0] or 0) // (target_bytes * _BINS_A_PART)), -(-total[1] // 1_000_000))
    dealt = listing.withColumn("part", F.pmod(F.xxhash64("object_name"), F.lit(parts)).cast("int"))
    before = Window.partitionBy("part").orderBy("object_name").rowsBetween(Window.unboundedPreceding, -1)
    return dealt.withColumn("bin", F.floor(F.coalesce(F.sum("length").over(before), F.lit(0)) / target_bytes).cast("int"))


def _taken(spark: SparkSession, store: str) -> DataFrame:
    try:
        return spark.read.schema(_TAKEN).parquet(f"{store}/manifest")
    except AnalysisException:
        return spark.createDataFrame([], _TAKEN)


def compact_pages(spark: SparkSession, folder: str, store: str, target_bytes: int = TARGET_BYTES, suffix: str = ".json") -> int:
    """Takes the objects of `folder` that are new or changed into `store`; how many they were.

    An object is known by its name, length and time; one that was changed is taken again and
    then stands for its name. Nothing is written if nothing is new.
    """
    listing = scan_store(spark, folder).where(F.endswith("object_name", F.lit(suffix)))
    key = ["object_name", "length", "modificationTime"]
    new = written(listing.join(_taken(spark, store).select(*key), key, "left_anti"), "new-objects")
    n = new.count()
    if not n:
        return 0
    bins = written(planned(new, target_bytes), "object-bins")
    n_bins = bins.select("part", "bin").distinct().count()

    def contents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, held, size = [], [], 0
        for batch in batches:
            for name in batch.column(0).to_pylist():
                names.append(name)
                held.append(read_bytes(folder, name))
                size += len(held[-1])
                if size >= _BATCH_BYTES:
                    yield pa.RecordBatch.from_arrays([pa.array(names), pa.array(held, pa.binary())], ["source_file", "content"])
                    names, held, size = [], [], 0
        if names:
            yield pa.RecordBatch.from_arrays([pa.array(names), pa.array(held, pa.binary())], ["source_file", "content"])

    text = F.col("content").cast("string")
    raw = F.when(F.is_valid_utf8(text), text).otherwise(F.decode("content", "ISO-8859-1"))
    read = bins.repartition(n_bins, "part", "bin").select("object_name").mapInArrow(contents, "source_file string, content binary")
    run = uuid.uuid4().hex
    read.select("source_file", raw.alias("raw")).write.parquet(f"{store}/pages/run={run}")
    bins.select(*key).coalesce(max(1, n // 1_000_000)).write.parquet(f"{store}/manifest/run={run}")
    return n


def scan_compacted(spark: SparkSession, store: str) -> DataFrame:
    """`source_file, raw` of all pages taken so far, as `sources.pages.scan_page_files` gives them.

    Of an object that was taken several times the latest counts.
    """
    taken = _taken(spark, store)
    runs = [r["run"] for r in taken.select("run").distinct().collect()]
    if not runs:
        return spark.createDataFrame([], "source_file string, raw string")
    pages = spark.read.schema(_PAGES).option("basePath", f"{store}/pages").parquet(*(f"{store}/pages/run={r}" for r in runs))
    later = Window.partitionBy("object_name").orderBy(F.desc("modificationTime"), F.desc("run"))
    old = taken.withColumn("_n", F.row_number().over(later)).where("_n > 1")
    replaced = old.select(F.col("object_name").alias("source_file"), "run")
    return pages.join(replaced, ["source_file", "run"], "left_anti").select("source_file", "raw")
