"""Exact top-k by inner product with columnar branch and bound.

Vectors lie dimension by dimension. A query's products are summed up over one block of
dimensions after the other; after each block the mass that a candidate can still gain is
bounded by the product of both remainders' norms, candidates that cannot reach the k best
any more are dropped, and the survivors are compacted for the next block.

Queries and candidates are dealt to blocks of bounded size, and each task takes a pair of
blocks; the few best of each pair are merged per query.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stewardry.llm.groups import map_groups
from stewardry.llm.vectors import clean_vectors, matrix
from stewardry.session import written

SCALE = 256
QUERY_BLOCK, CANDIDATE_BLOCK = 2048, 8192
#: Dimensions summed up between two prunings.
DIMENSIONS = 16


def best_of_block(queries: np.ndarray, query_ids: np.ndarray, candidates: np.ndarray, ids: np.ndarray, k: int) -> list[np.ndarray]:
    """query id, vector id and score of each query's k best among the candidates, ties to smaller ids."""
    exact = np.float64 if max(np.abs(queries).max(initial=0), np.abs(candidates).max(initial=0)) < 1 << 20 else np.int64
    order = np.argsort(ids, kind="stable")
    ids, columns = ids[order], np.ascontiguousarray(candidates[order].T.astype(exact))
    queries = queries.astype(exact)
    dims = columns.shape[0]
    edges = [*range(0, dims, DIMENSIONS), dims]
    # norms of what is left from each block on, rounded up a little
    rest = np.sqrt(np.array([(columns[e:].astype(np.float64) ** 2).sum(0) for e in edges[1:]])) * (1 + 1e-9)
    out: list[tuple] = []
    for q, own in zip(queries, query_ids, strict=True):
        alive = np.flatnonzero(ids != own)
        score = np.zeros(len(alive), exact)
        for b, (lo, hi) in enumerate(zip(edges, edges[1:], strict=False)):
            score = score + q[lo:hi] @ (columns[lo:hi] if len(alive) == len(ids) else columns[lo:hi, alive])
            if hi < dims and len(alive) > k:
                room = rest[b][alive] * (np.sqrt((q[hi:].astype(np.float64) ** 2).sum()) * (1 + 1e-9)) + 1e-6
                least = np.partition(score - room, len(alive) - k)[len(alive) - k]
                keep = score + room >= least
                alive, score = alive[keep], score[keep]
        best = np.lexsort((ids[alive], -score))[:k]
        out.extend((own, ids[alive[i]], score[i]) for i in best)
    return [np.array(c).astype(np.int64) for c in zip(*out, strict=True)] or [np.zeros(0, np.int64)] * 3


def top_k(vectors: DataFrame, k: int = 5, every: int = 50, query_block: int = QUERY_BLOCK, candidate_block: int = CANDIDATE_BLOCK) -> DataFrame:
    """query_id, rank, vec_id, score: the k best for each vec_id divisible by `every`.

    Components become floor(256 * x); scores are integer inner products with every other
    row of as many dimensions. Rows of a query's own id are not its candidates; an id that
    repeats among queries is asked once, with its least vector. Nulls and non-finite
    components take no part. A component of 2**31 / 256 or more is an error.
    """
    clean = written(clean_vectors(vectors, "vec_id", "embedding"), "vectors").where("vector IS NOT NULL")
    queries = clean.where(F.col("node") % every == 0).groupBy("node").agg(F.min(F.struct("dim", "vector")).alias("v")).select("node", "v.*")
    n, asked = clean.count(), queries.count()
    blocks = {"c": max(1, -(-n // candidate_block)), "q": max(1, -(-asked // query_block))}

    def dealt(rows: DataFrame, own: str, other: str, kind: int) -> DataFrame:
        at = F.pmod(F.xxhash64(F.lit(5), "node"), F.lit(blocks[own]).cast("long"))
        return rows.select("dim", at.alias(own), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks[other] - 1).cast("long"))).alias(other),
                           F.lit(kind).cast("long").alias("asks"), "node", "vector")

    both = dealt(clean, "c", "q", 0).unionByName(dealt(queries, "q", "c", 1))

    def best(rows: pa.Table) -> list[np.ndarray]:
        asks = rows.column("asks").to_numpy() == 1
        if asks.all() or not asks.any():
            return [np.zeros(0, np.int64)] * 3
        values, ids = np.floor(SCALE * matrix(rows.column("vector"))), rows.column("node").to_numpy()
        if np.abs(values).max(initial=0) >= 1 << 31:
            raise ValueError("a component of 2**31 / 256 or more: its scores would not fit into 64 bits")
        values = values.astype(np.int64)
        return best_of_block(values[asks], ids[asks], values[~asks], ids[~asks], k)

    found = map_groups(both, ["dim", "c", "q"], ["asks", "node"], best, "query_id long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
