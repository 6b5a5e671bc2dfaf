"""Embedding near-duplicates by cross-polytope hashing.

A vector is rotated at random, by three rounds of sign flips and a fast Hadamard
transform, and hashed to the coordinate that is largest in size, with its sign: the
nearest vertex of the cross-polytope. Several such hashes make a table's key. Each vector
also probes the keys in which one hash is replaced by its second nearest vertex. Vectors
that meet in a bucket are compared in double precision.

Equal vectors are one class. Buckets give at most one edge per class, which the exact
cosine has confirmed; components of these edges are the groups, and within each group all
links are counted exactly, by pairs of blocks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stewardry.llm.buckets import BLOCK, in_block_pairs, shared_buckets
from stewardry.llm.components import Unions, components
from stewardry.llm.groups import map_groups
from stewardry.llm.hashing import mixed
from stewardry.llm.vectors import clean_vectors, matrix
from stewardry.session import written

LEAST = 0.9
TABLES, HASHES, SEED = 20, 3, 41
#: Tables that give the first edges; the others add edges between groups only.
FIRST_TABLES = 5


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of each row (a power of two long), in place."""
    n, width, half = *x.shape, 1
    while half < width:
        pairs = x.reshape(n, width // (2 * half), 2, half)
        upper, lower = pairs[:, :, 0].copy(), pairs[:, :, 1]
        pairs[:, :, 0] += lower
        np.subtract(upper, lower, out=pairs[:, :, 1])
        half *= 2
    return x


def bucket_keys(x: np.ndarray, tables: int = TABLES, hashes: int = HASHES, seed: int = SEED) -> np.ndarray:
    """Keys of each row: per table its own bucket and one probe per hash."""
    n, dim = x.shape
    width = max(2, 1 << (dim - 1).bit_length())
    signs = np.random.default_rng(seed).choice([-1.0, 1.0], (tables, hashes, 3, width))
    keys = np.empty((n, tables, hashes + 1), np.uint64)
    rows = np.arange(n)
    for t in range(tables):
        own, second = [], []
        for h in range(hashes):
            y = np.zeros((n, width))
            y[:, :dim] = x
            for flip in signs[t, h]:
                y *= flip
                hadamard(y)
            size = np.abs(y)
            best = size.argmax(1)
            own.append(2 * best + (y[rows, best] > 0))
            size[rows, best] = -1
            best = size.argmax(1)
            second.append(2 * best + (y[rows, best] > 0))
        for probe in range(hashes + 1):
            key = np.full(n, t * 1_000_003 + dim, np.uint64)
            for h in range(hashes):
                key = mixed(key * np.uint64(0x9E3779B97F4A7C15) + (second if probe == h + 1 else own)[h].astype(np.uint64) + np.uint64(1))
            keys[:, t, probe] = key
    return keys.reshape(n, -1)


def _keys_of(classes: DataFrame) -> DataFrame:
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            for dim in np.unique(dims):
                at = np.flatnonzero(dims == dim)
                for lo in range(0, len(at), 1024):
                    part = batch.take(pa.array(at[lo:lo + 1024]))
                    keys = bucket_keys(scaled(matrix(part.column("vector"))))
                    yield pa.RecordBatch.from_arrays([part.column("node"), pa.ListArray.from_arrays(
                        pa.array(np.arange(len(part) + 1, dtype=np.int32) * keys.shape[1]), pa.array(keys.view(np.int64).ravel()))], ["node", "keys"])

    return classes.select("node", "dim", "vector").mapInArrow(of, "node long, keys array<long>")


def scaled(x: np.ndarray) -> np.ndarray:
    """Rows brought to a largest component between 1/2 and 1 by a power of two, which changes
    no cosine and keeps squares from overflowing or vanishing."""
    return np.ldexp(x, -np.frexp(np.abs(x).max(1))[1][:, None])


def cosines(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """The cosine of each row of x with the same of y: what decides whether two are linked."""
    return (x * y).sum(1) / (np.sqrt((x * x).sum(1)) * np.sqrt((y * y).sum(1)))


def linked(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Which rows of x are linked with which of y. A product of matrices tells all but those
    next to the limit, which `cosines` decides."""
    near = x @ y.T / (np.sqrt((x * x).sum(1))[:, None] * np.sqrt((y * y).sum(1))[None, :])
    out = near >= LEAST
    a, b = np.nonzero(np.abs(near - LEAST) < 1e-9)
    out[a, b] = cosines(x[a], y[b]) >= LEAST
    return out


def _edges(rows: pa.Table) -> list[np.ndarray]:
    """Confirmed edges that connect what is linked in one pair of blocks of a bucket."""
    nodes, own, dims, families = (rows.column(c).to_numpy() for c in ("node", "_own", "dim", "family"))
    across = rows.column("_i")[0].as_py() != rows.column("_j")[0].as_py()
    out = []
    for dim in np.unique(dims):
        at = np.flatnonzero(dims == dim)
        x = scaled(matrix(rows.take(pa.array(at)).column("vector")))
        joined = Unions(len(at), families[at])
        for a in range(len(at) - 1):
            rest = np.flatnonzero(joined.label[a + 1:] != joined.label[a]) + a + 1
            if across:
                rest = rest[own[at[rest]] != own[at[a]]]
            if len(rest):
                for b in rest[linked(x[rest], x[a:a + 1])[:, 0]]:
                    if joined.merge(a, b):
                        out.append((nodes[at[a]], nodes[at[b]]))
    return list(np.array(out, np.int64).reshape(-1, 2).T)


def _links(rows: pa.Table) -> list[np.ndarray]:
    """node, links: of each row of a pair of blocks, to rows of the other block (or its own)."""
    nodes, own, copies = (rows.column(c).to_numpy() for c in ("node", "_own", "copies"))
    i, j = rows.column("_i")[0].as_py(), rows.column("_j")[0].as_py()
    x = scaled(matrix(rows.column("vector")))
    pairs = linked(x, x)
    np.fill_diagonal(pairs, False)
    if i != j:
        pairs &= own[:, None] != own[None, :]
    return [nodes, pairs @ copies]


def _confirmed(pairs: DataFrame) -> DataFrame:
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = np.zeros(len(batch), bool)
            dims = batch.column("dim").to_numpy()
            for dim in np.unique(dims):
                at = np.flatnonzero(dims == dim)
                part = batch.take(pa.array(at))
                x, y = (scaled(matrix(part.column(v))) for v in ("v_a", "v_b"))
                ok[at] = cosines(x, y) >= LEAST
            yield batch.select(["a", "b"]).filter(pa.array(ok))

    return pairs.select("a", "b", "dim", "v_a", "v_b").mapInArrow(of, "a long, b long")


def confirmed_edges(classes: DataFrame, keys: DataFrame, families: DataFrame | None, first: int, end: int, block: int) -> DataFrame:
    """Written edges a, b from the buckets of some tables, between classes of different families."""
    each = HASHES + 1
    members = keys.select("node", F.explode(F.slice("keys", first * each + 1, (end - first) * each)).alias("key")).distinct()
    if families is None:
        members = members.withColumn("family", F.col("node"))
    else:
        members = members.join(families, "node", "left").withColumn("family", F.coalesce("family", "node"))
    pairs, larger = shared_buckets(members, ["key"], "buckets")
    side = lambda k: classes.select(F.col("node").alias(k), "dim", F.col("vector").alias(f"v_{k}"))
    edges = _confirmed(pairs.join(side("a"), "a").join(side("b"), ["b", "dim"]))
    larger = written(larger.join(classes.select("node", "dim", "vector"), "node"), "members")
    inside = map_groups(in_block_pairs(larger, ["key"], "node", block), ["key", "_i", "_j"], ["node"], _edges, "a long, b long")
    return written(edges.union(inside).distinct(), "edges")


def near_vectors(vectors: DataFrame, block: int = BLOCK) -> DataFrame:
    """Per vector: vec_id, n_links, component_id, kept.

    Links join vectors of cosine >= 0.9, whatever else the rows say. Null, zero and
    non-finite vectors link with nothing; only vectors of equally many dimensions are
    compared. Rows that repeat an id with one vector count as links of one another.
    """
    clean = written(clean_vectors(vectors, "vec_id", "embedding", zero=False), "vectors")
    classes = written(
        clean.where("vector IS NOT NULL").groupBy("dim", "vector").agg(F.min("node").alias("node"), F.count("*").alias("copies")), "classes")
    keys = written(_keys_of(classes), "keys")
    edges = confirmed_edges(classes, keys, None, 0, FIRST_TABLES, block)
    families = components(edges).withColumnRenamed("component", "family")
    edges = edges.union(confirmed_edges(classes, keys, families, FIRST_TABLES, TABLES, block))
    labels = components(edges)

    grouped = in_block_pairs(written(labels.join(classes, "node"), "groups"), ["component"], "node", block)
    linked = map_groups(grouped, ["component", "_i", "_j"], ["node"], _links, "node long, links long")
    linked = linked.groupBy("node").agg(F.sum("links").alias("links"))
    of_class = classes.join(linked, "node", "left").join(labels, "node", "left").select(
        "dim", "vector", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
        F.coalesce("component", "node").alias("component_id"))
    given = clean.join(of_class, ["dim", "vector"], "left").select(
        F.col("node").alias("vec_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "node").alias("component_id"))
    return given.withColumn("kept", F.equal_null("vec_id", "component_id"))
