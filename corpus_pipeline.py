"""From raw documents to training sequences: the stages and the run over `documents`.

Every stage takes (spark, docs, sf_dir) and decides over all that the one before has kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from stewardry.llm import langid, mixing, neardup, packing, quality
from stewardry.session import written


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the network tells; those without letters or a clear language
    go, null and empty texts among them."""
    return langid.in_known_language(docs)


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn by importance resampling towards those labelled good. A null or empty
    text would have weight 1, like one that says nothing either way; the stage before keeps none."""
    return quality.of_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), pairs=True)


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: of runs of five words, 80 % shared. Null
    and blank texts would link with nothing and stay."""
    return neardup.first_of_each(docs, shingle=5, shared=80)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents sampled so that sources, languages and topics meet their target weights. The
    language is the one a document comes with, not the one predicted; null and empty texts
    have no tokens and would all be kept."""
    return mixing.mixed(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Their token sequences, packed: a row per piece with its sequence and place. A null text
    would be one piece with the closing id alone."""
    return packing.packed(docs)


STAGES = [
    ("language ID", language),
    ("quality classifier", good),
    ("MinHash near-dedup", distinct),
    ("mixing sources to target weights", mix),
    ("best-fit packing", pack),
]

#: Trained networks and shingle sets cannot be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
