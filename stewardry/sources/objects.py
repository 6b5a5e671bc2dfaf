"""Object listings: names and sizes only, contents are not read."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def name_below(folder: str, path: Column | str = "path") -> Column:
    """An object's name: its path below the folder (its last part if the folder is a pattern)."""
    path = F.col(path) if isinstance(path, str) else path
    root = re.sub(r"^[A-Za-z][A-Za-z0-9+.-]*:(?://[^/]*)?", "", folder).rstrip("/") + "/"
    at = F.locate(root, path)
    return F.when(at > 0, F.substr(path, at + len(root))).otherwise(F.element_at(F.split(path, "/"), -1))


def scan_objects(spark: SparkSession, folder: str, glob: str = "*") -> DataFrame:
    """`object_name, length, modificationTime` of all files below a folder.

    Names are paths below the folder, so that equal names in two folders stay apart.

    Spark's file sources pass over files of zero bytes, so these are not listed.
    """
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", glob)
        .load(folder)
    )
    return files.select(name_below(folder).alias("object_name"), "length", "modificationTime")


def list_objects(listing: DataFrame, prefix: str = "") -> DataFrame:
    """Objects whose name begins with `prefix`."""
    return listing.filter(F.startswith("object_name", F.lit(prefix))) if prefix else listing


def count_objects(listing: DataFrame) -> DataFrame:
    """One row: the number of objects."""
    return listing.agg(F.count(F.lit(1)).alias("n_objects"))


def sample_objects(listing: DataFrame, size: int, prefix: str = "") -> DataFrame:
    """The first `size` objects by name and the file name each is stored under."""
    first = list_objects(listing, prefix).orderBy("object_name").limit(size)
    return first.withColumn("file_name", F.concat(F.md5("object_name"), F.lit(".json")))
