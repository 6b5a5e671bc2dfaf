"""MinHash near-duplicate detection over whole documents (see minhash.py for the sketch).

1. Texts of one shingle set are one class, so that copies cost nothing further.
2. Classes that share a band's value meet in a bucket. A bucket hands on star-shaped
   candidate edges only: each class is joined to one earlier class whose sketch is like
   its own, never to all of them, so a bucket of m classes gives fewer than m edges. The
   first bands do so alone; the others then join only what is not of one family yet.
3. Classes that candidate edges connect are a family. Whatever pair of texts a bucket held
   together and the sketches find alike is in one family.
4. Within a family, links are confirmed on full shingle sets; a pair whose classes
   are connected already needs no more confirming, every other pair with like sketches is.
5. Components of the confirmed links.

A bucket or family of any size is dealt to blocks and worked on by pairs of blocks, so no
task holds more than two blocks.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stewardry.llm.buckets import BLOCK, in_block_pairs, shared_buckets
from stewardry.llm.columns import set_aside
from stewardry.llm.components import Unions, components
from stewardry.llm.groups import map_groups
from stewardry.llm.hashing import WORDS, TokenHasher, mixed
from stewardry.llm.minhash import BANDS, BINS, SHARED, SHINGLE, band_values, shingle_sets, signatures
from stewardry.session import written

#: Bands that give the first candidates; the others add edges between families only.
FIRST_BANDS = 8
#: A sketch may fall short of the wanted similarity by so many standard deviations.
DEVIATIONS = 4.5

FEATURES = "doc_id long, n_shingles long, set_a long, set_b long, bands array<long>, sketch binary"


def features(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """Per document: its number of shingles, a 128-bit name of its set, bands and sketch."""
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = TokenHasher(WORDS)
        for batch in batches:
            ids = batch.column(0)
            for lo, hi, hashes, begins in hasher.of_texts(batch.column(1)):
                values, at = shingle_sets(hashes, begins, shingle)
                signature = signatures(values, at)
                sums = np.zeros((2, len(values) + 1), np.uint64)
                np.cumsum(values, out=sums[0][1:])
                np.cumsum(mixed(values ^ np.uint64(0xC2B2AE3D27D4EB4F)), out=sums[1][1:])
                names = sums[:, at[1:]] - sums[:, at[:-1]]
                bands = band_values(signature)
                sketch = mixed(signature).astype(np.uint8)
                yield pa.RecordBatch.from_arrays([
                    ids.slice(lo, hi - lo), pa.array(np.diff(at)), pa.array(names[0].view(np.int64)), pa.array(names[1].view(np.int64)),
                    pa.ListArray.from_arrays(pa.array(np.arange(hi - lo + 1, dtype=np.int32) * BANDS), pa.array(bands.view(np.int64).ravel())),
                    pa.array([row.tobytes() for row in sketch], pa.binary()),
                ], ["doc_id", "n_shingles", "set_a", "set_b", "bands", "sketch"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(of, FEATURES)


def least_alike(sizes: np.ndarray, shared: int = SHARED) -> np.ndarray:
    """How many of BINS sketch bytes must agree for a set of each size to be looked at."""
    wanted = shared / 100
    bins = np.clip(BINS * (1 - np.exp(-sizes / BINS)), 1, BINS)  # filled ones
    return np.floor(BINS * (wanted - DEVIATIONS * np.sqrt(wanted * (1 - wanted) / bins)))


def _longs(table: pa.Table, name: str) -> np.ndarray:
    return table.column(name).to_numpy()


def _binary(table: pa.Table, name: str) -> list[bytes]:
    return table.column(name).to_pylist()


def star_edges(rows: pa.Table, shared: int = SHARED) -> list[np.ndarray]:
    """Edges that connect what is alike in one pair of blocks: at most one per class but one."""
    nodes, own, sizes = _longs(rows, "node"), _longs(rows, "_own"), _longs(rows, "n_shingles")
    sketches = np.frombuffer(b"".join(_binary(rows, "sketch")), np.uint8).reshape(len(rows), BINS)
    across = _longs(rows, "_i")[0] != _longs(rows, "_j")[0]
    joined, out = Unions(len(rows), _longs(rows, "family")), []
    for a in range(len(rows) - 1):
        rest = _to_look_at(a, sizes, joined.label, own if across else None, shared)
        if len(rest):
            for b in rest[_alike(sketches[rest], sketches[a], sizes[rest], sizes[a], shared)]:
                if joined.merge(a, b):
                    out.append((nodes[a], nodes[b]))
    return list(np.array(out, np.int64).reshape(-1, 2).T)


def _to_look_at(a: int, sizes: np.ndarray, label: np.ndarray, own: np.ndarray | None, shared: int) -> np.ndarray:
    """Rows after `a` that are not joined to it, and whose size does not rule a link out."""
    ok = label[a + 1:] != label[a]
    rest = sizes[a + 1:]
    ok &= 100 * np.minimum(rest, sizes[a]) >= shared * np.maximum(rest, sizes[a])
    if own is not None:
        ok &= own[a + 1:] != own[a]
    return np.flatnonzero(ok) + a + 1


def _alike(sketches: np.ndarray, sketch: np.ndarray, sizes: np.ndarray, size: np.ndarray, shared: int) -> np.ndarray:
    return (sketches == sketch).sum(1) >= least_alike(np.minimum(sizes, size), shared)


def confirmed_links(rows: pa.Table, shared: int = SHARED) -> list[np.ndarray]:
    """Confirmed links that connect what is linked in one pair of blocks of a family."""
    nodes, own = _longs(rows, "node"), _longs(rows, "_own")
    sets = [np.frombuffer(s, np.uint64) for s in _binary(rows, "shingles")]
    sizes = np.array([len(s) for s in sets])
    ends = np.cumsum(sizes)
    everything = np.concatenate(sets)
    _, dense = np.unique(everything, return_inverse=True)
    sketches = mixed(signatures(everything, np.concatenate([[0], ends]))).astype(np.uint8)
    across = _longs(rows, "_i")[0] != _longs(rows, "_j")[0]
    flags = np.zeros(int(dense.max(initial=0)) + 1, bool)
    joined, out = Unions(len(rows)), []
    for a in range(len(rows) - 1):
        rest = _to_look_at(a, sizes, joined.label, own if across else None, shared)
        if not len(rest):
            continue
        mine = dense[ends[a] - sizes[a]:ends[a]]
        flags[mine] = True
        for b in rest[_alike(sketches[rest], sketches[a], sizes[rest], sizes[a], shared)]:
            if joined.label[a] != joined.label[b]:
                common = int(np.count_nonzero(flags[dense[ends[b] - sizes[b]:ends[b]]]))
                if 100 * common >= shared * (sizes[a] + sizes[b] - common) and joined.merge(a, b):
                    out.append((nodes[a], nodes[b]))
        flags[mine] = False
    return list(np.array(out, np.int64).reshape(-1, 2).T)


def alike_pairs(pairs: DataFrame, shared: int = SHARED) -> DataFrame:
    """The rows a, b of `pairs` (a, n_a, s_a, b, n_b, s_b) whose sketches are alike."""
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = [batch.column(k).to_numpy() for k in ("n_a", "n_b")]
            s = [np.frombuffer(b"".join(batch.column(k).to_pylist()), np.uint8).reshape(-1, BINS) for k in ("s_a", "s_b")]
            ok = 100 * np.minimum(*n) >= shared * np.maximum(*n)
            ok &= (s[0] == s[1]).sum(1) >= least_alike(np.minimum(*n), shared)
            yield batch.select(["a", "b"]).filter(pa.array(ok))

    return pairs.select("a", "n_a", "s_a", "b", "n_b", "s_b").mapInArrow(of, "a long, b long")


def _sets_of(docs: DataFrame, shingle: int) -> DataFrame:
    """node, family, shingles: the set of each text as bytes."""
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = TokenHasher(WORDS)
        for batch in batches:
            for lo, hi, hashes, begins in hasher.of_texts(batch.column(2)):
                values, at = shingle_sets(hashes, begins, shingle)
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(lo, hi - lo), batch.column(1).slice(lo, hi - lo),
                    pa.array([values[at[i]:at[i + 1]].tobytes() for i in range(hi - lo)], pa.binary()),
                ], ["node", "family", "shingles"])

    return docs.select("node", "family", "text").mapInArrow(of, "node long, family long, shingles binary")


def candidate_edges(classes: DataFrame, families: DataFrame | None, first: int, end: int, block: int, shared: int = SHARED) -> DataFrame:
    """Written edges a, b of the buckets of some bands, between classes of different families."""
    bands = classes.select("node", F.posexplode(F.slice("bands", first + 1, end - first)).alias("band", "value"))
    if families is None:
        bands = bands.withColumn("family", F.col("node"))
    else:
        bands = bands.join(families, "node", "left").withColumn("family", F.coalesce("family", "node"))
    pairs, larger = shared_buckets(bands, ["band", "value"], "buckets")
    sketched = classes.select("node", "n_shingles", "sketch")
    side = lambda k: sketched.toDF(k, f"n_{k}", f"s_{k}")
    edges = alike_pairs(pairs.join(side("a"), "a").join(side("b"), "b"), shared)
    members = in_block_pairs(written(larger.join(sketched, "node"), "members"), ["band", "value"], "node", block)
    edges = edges.union(map_groups(members, ["band", "value", "_i", "_j"], ["node"], partial(star_edges, shared=shared), "a long, b long"))
    return written(edges.distinct(), "candidates")


def near_duplicates(docs: DataFrame, block: int = BLOCK, shingle: int = SHINGLE, shared: int = SHARED) -> DataFrame:
    """Per document: doc_id, n_shingles, component_id, kept.

    Texts link where 100 * shared shingles >= `shared` * shingles of both, a shingle being
    `shingle` words; op8's contract is 3 and 85. `component_id` is the
    smallest doc_id that links lead to, `kept` whether that is the row's own. A null or
    blank text links with nothing. Rows that repeat an id with one text stay together. A
    row without an id is a component of its own with a null id unless its text links it.
    Empty inputs give no rows; other columns do not matter.
    """
    found = written(features(docs, shingle), "shingled")
    name = ["n_shingles", "set_a", "set_b"]
    classes = found.where("n_shingles > 0 AND doc_id IS NOT NULL").groupBy(*name).agg(
        F.min("doc_id").alias("node"), F.min_by(F.struct("bands", "sketch"), "doc_id").alias("sketches"))
    classes = written(classes.select("node", *name, "sketches.*"), "classes")

    edges = candidate_edges(classes, None, 0, FIRST_BANDS, block, shared)
    families = components(edges).withColumnRenamed("component", "family")
    edges = edges.union(candidate_edges(classes, families, FIRST_BANDS, BANDS, block, shared))
    families = components(edges).withColumnRenamed("component", "family")

    # a text that stands for its class; a repeated id with several texts has several classes
    # families grow with the documents: dealt by id at every size
    texts = docs.select(F.col("doc_id").cast("long").alias("node"), "text").join(families.hint("merge"), "node")
    sets = written(_sets_of(texts, shingle).distinct(), "sets")
    pairs = in_block_pairs(sets, ["family"], "node", block)
    links = written(map_groups(pairs, ["family", "_i", "_j"], ["node"], partial(confirmed_links, shared=shared), "a long, b long"), "links")
    labels = components(links)

    of_class = classes.select("node", *name).join(labels, "node", "left").select(
        *name, F.coalesce("component", "node").alias("_component"))
    rows = found.select("doc_id", *name).join(of_class, name, "left")
    component = F.coalesce("_component", "doc_id")
    return rows.select("doc_id", "n_shingles", component.alias("component_id"), F.equal_null(component, F.col("doc_id")).alias("kept"))


def first_of_each(docs: DataFrame, shingle: int = SHINGLE, shared: int = SHARED) -> DataFrame:
    """The documents that stand for their components, columns as they came.

    Exactly one row of each component. Texts of one id are documents of their own, as are
    those without an id; rows of one id and text, or without id and of one text, are one.
    """
    rows, restored = set_aside(docs, ("doc_id", "text"))
    own, name = F.col("doc_id").cast("long"), F.xxhash64(F.coalesce("text", F.lit("")), F.length("text"))
    apart = F.shiftrightunsigned(F.xxhash64("_id", "_name"), 2).bitwiseOR(F.lit(1 << 62))
    # one number for all rows of one id and text: the id itself for the first text of an id
    named = rows.withColumns({"_id": own, "_name": name})
    several = named.where("_id IS NOT NULL").groupBy("_id").agg(F.min("_name").alias("_first"), F.max("_name").alias("_last"))
    several = written(several.where("_first < _last").select("_id", "_first"), "several-texts")
    numbered = named.join(several, "_id", "left").withColumn(
        "_node", F.when(F.col("_id").isNull() | (F.col("_first") != F.col("_name")), apart).otherwise(F.col("_id")))
    found = near_duplicates(numbered.select(F.col("_node").alias("doc_id"), "text"), shingle=shingle, shared=shared)
    kept = found.where("kept").groupBy(F.col("doc_id").alias("_node")).agg((F.count("*") > 1).alias("_repeated"))
    # the kept ids grow with the documents, so both sides are dealt by id at every size
    kept = written(kept, "kept").hint("merge")
    once = numbered.join(kept.where("NOT _repeated"), "_node", "left_semi").select(*rows.columns)
    # rows of one id and text: one of them
    again = numbered.join(kept.where("_repeated"), "_node", "left_semi").dropDuplicates(["_node"]).select(*rows.columns)
    return restored(once.union(again))
