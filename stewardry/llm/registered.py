"""One query for each operator, applied to its whole table, and the SQL that says the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from stewardry.llm import (
    credentials, divergence, extraction, langid, manifest, mixing, neardup, oracles, packing, quality, scoring, sharding, topk,
    vectordup,
)

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extraction.main_text(_table(spark, sf_dir, "pages"))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identified(_table(spark, sf_dir, "documents"))


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(_table(spark, sf_dir, "documents"))


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.scored(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"), pairs=True)


def op5_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(_table(spark, sf_dir, "embeddings"))


def op6_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.scored(_table(spark, sf_dir, "documents"))


def op7_embedding_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectordup.near_vectors(_table(spark, sf_dir, "embeddings"))


def op8_minhash_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(_table(spark, sf_dir, "documents"), shingle=3, shared=85)


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mixing.calibrated(_table(spark, sf_dir, "documents").select("doc_id", "text", "source", "lang"))
    return out.select(
        "doc_id", "source", "lang", F.col("_topic").alias("topic"), F.col("_tokens").alias("n_tokens"),
        F.round("probability", 6).alias("probability"), (mixing.uniform_of(F.col("doc_id")) < F.col("probability")).alias("kept"),
    )


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.sharded_documents(_table(spark, sf_dir, "documents"))


def op11_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return credentials.secret_digests(_table(spark, sf_dir, "documents"))


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.source_divergence(_table(spark, sf_dir, "documents"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.manifest(_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {
    "pipeline": corpus_pipeline.run,
    "op1_html_extraction": op1_html_extraction,
    "op2_language_id": op2_language_id,
    "op3_best_fit_packing": op3_best_fit_packing,
    "op4_quality_classifier": op4_quality_classifier,
    "op5_exact_topk": op5_exact_topk,
    "op6_lm_scoring": op6_lm_scoring,
    "op7_embedding_neardup": op7_embedding_neardup,
    "op8_minhash_neardup": op8_minhash_neardup,
    "op9_mixing": op9_mixing,
    "op10_sharding": op10_sharding,
    "op11_secret_scans": op11_secret_scans,
    "op12_source_divergence": op12_source_divergence,
    "op13_merkle_manifest": op13_merkle_manifest,
}

ORACLES: dict[str, str] = {
    "op5_exact_topk": """
WITH whole AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
  FROM whole q JOIN whole c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5""",
    "op7_embedding_neardup": """
WITH RECURSIVE whole AS MATERIALIZED (
  SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS MATERIALIZED (
  SELECT a.vec_id AS a, b.vec_id AS b FROM whole a JOIN whole b ON a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.v, b.v) >= 0.9),
reached(node, root) AS (SELECT a, a FROM links UNION SELECT b, root FROM reached JOIN links ON a = node)
SELECT e.vec_id, coalesce(n, 0)::BIGINT AS n_links, least(e.vec_id, coalesce(root, e.vec_id)) AS component_id,
  coalesce(root, e.vec_id) >= e.vec_id AS kept
FROM embeddings e LEFT JOIN (SELECT a, count(*) AS n FROM links GROUP BY a) l ON l.a = e.vec_id
LEFT JOIN (SELECT node, min(root) AS root FROM reached GROUP BY node) r ON r.node = e.vec_id""",
    "op8_minhash_neardup": r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
shingles AS MATERIALIZED (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN []::VARCHAR[] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END) AS s
  FROM words),
sizes AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
links AS MATERIALIZED (
  SELECT a, b FROM common c JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * c.n >= 85 * (x.n + y.n - c.n)),
both_ways AS MATERIALIZED (SELECT a, b FROM links UNION SELECT b, a FROM links),
reached(node, root) AS (SELECT a, a FROM both_ways UNION SELECT b, root FROM reached JOIN both_ways ON a = node)
SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, coalesce(least(root, d.doc_id), d.doc_id) AS component_id,
  coalesce(root >= d.doc_id, true) AS kept
FROM documents d LEFT JOIN sizes s ON s.doc_id = d.doc_id
LEFT JOIN (SELECT node, min(root) AS root FROM reached GROUP BY node) r ON r.node = d.doc_id""",
    "op9_mixing": f"""
WITH {mixing.mixing_sql("documents")}
SELECT doc_id, nullif(substr(source, 2), '') AS source, nullif(substr(lang, 2), '') AS lang, topic, n_tokens,
  round(probability, 6) AS probability, kept FROM mixed_docs""",
    "op11_secret_scans": oracles.secrets_sql(),
    "op12_source_divergence": oracles.DIVERGENCE_SQL,
    "op13_merkle_manifest": oracles.MANIFEST_SQL,
}
