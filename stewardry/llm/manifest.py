"""A Merkle manifest of a dataset: a leaf for every row, a tree per group, a root over all.

Where a leaf stands in its group's tree is its rank by doc_id, and no sort of leaves finds
it. The ids of a group are a compressed bitmap: one 64-bit word for every 64 ids that has
any, ORed together from all tasks. A directory over the words holds the number of rows
before each, so an id's rank is its word's entry plus the set bits below its own. Rows of
repeated or null ids, which a bitmap cannot tell apart, are counted per class of equal
(doc_id, leaf) instead; equal leaves are interchangeable and share a range of places.

Levels are reduced by place: the nodes whose places differ in the last bits only are
dealt to one slot array, filled by place and folded some levels at once. The same arrays,
from the top down, hand every node the path from it to the root.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stewardry.llm.groups import runs
from stewardry.session import written

#: Nodes of a run that one digest covers.
RUN = 2
#: Levels folded in one slot array of RUN ** LEVELS nodes.
LEVELS = 10
#: Words of a directory's stretch on average, and rows a class hands on at once.
STRETCH, PART = 4096, 65_536
#: Ids whose checksum is divided by this are tampered with, to test the proofs.
TAMPERED = 7

_WORD_BITS = 6
_LOW = f"CAST(doc_id & {(1 << _WORD_BITS) - 1} AS INT)"


# --- leaves -----------------------------------------------------------------

def _field(value: Column) -> Column:
    text = value.cast("string")
    return F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_of(n_chars: Column) -> Column:
    """The digest of a row of `documents`, with `n_chars` in its place."""
    return F.sha2(F.concat(*(_field(c) for c in (F.col("doc_id"), F.col("source"), F.col("lang"), n_chars, F.col("text")))), 256)


def is_tampered(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % TAMPERED == 0, F.lit(False))


def leaves(docs: DataFrame) -> DataFrame:
    """`tree, doc_id, leaf, tampered`: `tree` names the group (null: empty), `tampered` is the
    leaf that a changed n_chars gives, null where nothing is changed."""
    more = F.col("n_chars").cast("decimal(20,0)") + 1
    changed = is_tampered(F.col("doc_id")) & F.col("n_chars").isNotNull()
    return docs.select(
        F.coalesce(F.concat(F.lit("="), F.col("lang")), F.lit("")).alias("tree"), F.col("doc_id").cast("long").alias("doc_id"),
        leaf_of(F.col("n_chars")).alias("leaf"), F.when(changed, leaf_of(more)).alias("tampered"))


# --- places -----------------------------------------------------------------

def running_total(rows: DataFrame, group: list[str], order: list[str], amount: str, label: str) -> DataFrame:
    """`rows` with `_before`, the sum of `amount` over the group's earlier rows, and `_total`,
    that over all of them; `order` tells the rows of a group apart.

    Rows are dealt to stretches by range and summed within them; only a row for each stretch
    and group is summed across.
    """
    rows = written(rows, label)
    n = max(1, -(-rows.count() // STRETCH))
    dealt = written(rows.repartitionByRange(n, *group, *order).withColumn("_stretch", F.spark_partition_id()), f"{label}-dealt")
    of_group = Window.partitionBy(*group)
    sums = dealt.groupBy(*group, "_stretch").agg(F.sum(amount).alias("_sum")).select(
        *group, "_stretch", (F.sum("_sum").over(of_group.orderBy("_stretch")) - F.col("_sum")).alias("_start"),
        F.sum("_sum").over(of_group).alias("_total"))
    within = Window.partitionBy(*group, "_stretch").orderBy(*order)
    summed = dealt.withColumn("_within", F.sum(amount).over(within) - F.col(amount))
    names = [*group, "_stretch"]
    sums = sums.withColumnsRenamed({c: f"_of{i}" for i, c in enumerate(names)})
    same = reduce(lambda a, b: a & b, (F.equal_null(F.col(c), F.col(f"_of{i}")) for i, c in enumerate(names)))
    return summed.join(sums, same).select(*rows.columns, (F.col("_start") + F.col("_within")).alias("_before"), "_total")


def _word(doc_id: Column) -> Column:
    return F.shiftright(doc_id, _WORD_BITS)


def directory(rows: DataFrame) -> DataFrame:
    """The bitmaps of all trees: `tree, word, bits, n, _before, _total`.

    `n` counts rows, more than the bits where ids repeat; the rows of null ids are a word of
    their own, the null one, before all others.
    """
    bit = F.coalesce(F.expr(f"shiftleft(1L, {_LOW})"), F.lit(0).cast("long"))
    words = rows.groupBy("tree", _word(F.col("doc_id")).alias("word")).agg(F.bit_or(bit).alias("bits"), F.count("*").alias("n"))
    return running_total(words, ["tree"], ["word"], "n", "manifest-words")


def placed(rows: DataFrame) -> DataFrame:
    """`rows` (tree, doc_id, leaf, tampered) with `at`, the place in its tree, and `size`, the
    number of the tree's leaves. `rows` is read twice and should be written."""
    words = written(directory(rows), "manifest-directory")
    single = F.bit_count("bits") == F.col("n")
    below = F.expr(f"bit_count(bits & ~shiftleft(-1L, {_LOW}))")
    keyed = rows.withColumn("word", _word(F.col("doc_id")))
    columns = ("tree", "doc_id", "leaf", "tampered", "at", "size")
    ranked = keyed.join(words.where(single), ["tree", "word"]).withColumns({
        "at": F.col("_before") + below, "size": F.col("_total")}).select(*columns)
    if words.where(~single).isEmpty():
        return ranked

    crowded = words.where(~single).withColumnsRenamed({"tree": "_tree", "word": "_word"})
    same = F.equal_null(F.col("word"), F.col("_word")) & (F.col("tree") == F.col("_tree"))
    classes = keyed.join(crowded, same).groupBy("tree", "word", "doc_id", "leaf").agg(
        F.first("tampered").alias("tampered"), F.count("*").alias("_rows"), F.first("_before").alias("_first"), F.first("_total").alias("size"))
    within = running_total(classes, ["tree", "word"], ["doc_id", "leaf"], "_rows", "manifest-classes").drop("_total")
    starts = F.explode(F.sequence(F.lit(0).cast("long"), F.col("_rows") - 1, F.lit(PART).cast("long")))
    parts = within.withColumn("_from", starts).repartition("tree", "word", "doc_id", "leaf", "_from")
    one_by_one = F.explode(F.sequence(F.col("_from"), F.least(F.col("_from") + PART, F.col("_rows")) - 1))
    each = parts.withColumn("_k", one_by_one).withColumn("at", F.col("_first") + F.col("_before") + F.col("_k"))
    return ranked.unionByName(each.select(*columns))


# --- slot arrays ------------------------------------------------------------

def _digest(nodes: list[bytes]) -> bytes:
    return hashlib.sha256(b"".join(nodes)).hexdigest().encode()


def _fold(nodes: list[bytes], levels: int) -> list[list[bytes]]:
    """The nodes and the levels above them; a last run may hold fewer nodes, even one."""
    out = [nodes]
    for _ in range(levels):
        nodes = [_digest(nodes[i:i + RUN]) for i in range(0, len(nodes), RUN)]
        out.append(nodes)
    return out


def _height(size: int) -> int:
    """Levels above `size` nodes until one is left."""
    height = 0
    while size > 1:
        size, height = -(-size // RUN), height + 1
    return height


def _slots(rows: pa.Table, block: int) -> tuple[np.ndarray, list[bytes], int, str]:
    """A block's rows by place, their digests, the size of their level, and the path from the
    block to the root, which a row without a place may bring."""
    at = rows["at"].to_numpy()
    with_place = np.flatnonzero(at >= 0)
    order = np.empty(len(with_place), np.int64)
    order[at[with_place] % block] = with_place
    digests = rows["digest"].to_pylist()
    path = "".join(digests[i] for i in np.flatnonzero(at < 0).tolist())
    return order, [digests[i].encode() for i in order.tolist()], int(rows["size"].to_numpy().max()), path


def _steps(levels: list[list[bytes]], slot: int) -> list[tuple[list[bytes], list[bytes]]]:
    """The nodes left and right of a slot's own in its run, level by level."""
    out = []
    for nodes in levels[:-1]:
        lo = slot - slot % RUN
        out.append((nodes[lo:slot], nodes[slot + 1:lo + RUN]))
        slot //= RUN
    return out


def _said(steps: list[tuple[list[bytes], list[bytes]]]) -> str:
    """Steps as text: left nodes, `<`, right nodes, `;` for each."""
    return "".join(f"{b''.join(left).decode()}<{b''.join(right).decode()};" for left, right in steps)


def _heard(path: str) -> list[tuple[list[bytes], list[bytes]]]:
    return [tuple([side.encode()] for side in step.split("<")) for step in path.split(";")[:-1]]


def _siblings(steps: list[tuple[list[bytes], list[bytes]]]) -> bytes:
    return b"".join(b"".join(left + right) for left, right in steps)


def _climbed(digest: bytes, steps: list[tuple[list[bytes], list[bytes]]]) -> bytes:
    for left, right in steps:
        digest = _digest([*left, digest, *right])
    return digest


_KEYS = ["tree", "block"]


def _blocked(nodes: DataFrame, block: int) -> DataFrame:
    return nodes.withColumn("block", F.expr(f"at DIV {block}"))


def _grouped(rows: DataFrame, work, schema: str) -> DataFrame:
    """`work` on the slot array of each tree and block, a batch for many of them."""
    names = [c.split()[0] for c in schema.split(", ")]
    types = {"long": pa.int64(), "string": pa.string()}
    kinds = [types[c.split()[1]] for c in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        for table in runs(batches, _KEYS):
            out += work(table)
            if len(out) >= 4096:
                yield packed(out)
                out = []
        if out:
            yield packed(out)

    def packed(out: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)], names)

    return rows.repartition(*_KEYS).sortWithinPartitions(*_KEYS).mapInArrow(run, schema)


def _reduced(nodes: DataFrame, levels: int) -> DataFrame:
    """`tree, at, digest, size`: the nodes some levels up; a tree that has one node is done."""
    block = RUN ** levels

    def up(rows: pa.Table) -> list[tuple]:
        _, slots, size, _ = _slots(rows, block)
        top = _fold(slots, min(levels, _height(size)))[-1]
        return [(rows["tree"][0].as_py(), rows["block"][0].as_py(), top[0].decode(), -(-size // block))]

    return _grouped(_blocked(nodes, block).select(*_KEYS, "at", "digest", "size"), up, "tree string, at long, digest string, size long")


def _handed_down(nodes: DataFrame, paths: DataFrame, levels: int) -> DataFrame:
    """`tree, at, digest` of the nodes, `digest` being their path to the root; `paths` has
    that of every block."""
    block = RUN ** levels

    def down(rows: pa.Table) -> list[tuple]:
        _, slots, size, above = _slots(rows, block)
        tree, first = rows["tree"][0].as_py(), rows["block"][0].as_py() * block
        folded = _fold(slots, min(levels, _height(size)))
        return [(tree, first + k, _said(_steps(folded, k)) + above) for k in range(len(slots))]

    both = _blocked(nodes, block).select(*_KEYS, "at", "digest", "size").unionByName(_brought(paths))
    return _grouped(both, down, "tree string, at long, digest string")


def _brought(paths: DataFrame) -> DataFrame:
    """Paths of blocks as rows without a place."""
    return paths.select("tree", F.col("at").alias("block"), F.lit(-1).cast("long").alias("at"), "digest", F.lit(0).cast("long").alias("size"))


def _levels_up(nodes: DataFrame, levels: int, label: str) -> list[DataFrame]:
    """The written nodes and the rounds above them, until every tree has one node."""
    out = [nodes]
    largest = nodes.agg(F.max("size")).first()[0] or 0
    for k in range(-(-_height(largest) // levels)):
        out.append(written(_reduced(out[-1], levels), f"{label}-{k}"))
    return out


# --- manifest ---------------------------------------------------------------

def manifest(docs: DataFrame, levels: int = LEVELS) -> DataFrame:
    """Per row: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified.

    Trees are the values of `lang` (null one of its own, first), leaves ascend by doc_id, null
    ids first; rows of one id follow by leaf, and equal rows are interchangeable. The proof is
    the digest of the siblings from the leaf to the root. `folded_root` starts from the
    tampered leaf where there is one; `verified` tells whether it is the root. A single row's
    proof is that of no siblings. No documents, no rows; columns other than doc_id, source,
    lang, n_chars and text do not matter.
    """
    base = written(leaves(docs), "manifest-leaves")
    nodes = written(placed(base), "manifest-places")
    of_trees = _levels_up(nodes.select("tree", "at", F.col("leaf").alias("digest"), "size"), levels, "manifest-nodes")
    subroots = of_trees[-1].select(F.col("tree").alias("name"), "digest", F.lit(1).cast("long").alias("_one"), F.lit("").alias("tree"))
    ranked = running_total(subroots, ["tree"], ["name"], "_one", "manifest-subroots")
    tops = written(ranked.select("tree", "name", F.col("_before").alias("at"), "digest", F.col("_total").alias("size")), "manifest-trees")

    of_tops = _levels_up(tops.select("tree", "at", "digest", "size"), levels, "manifest-tops")
    root = of_tops[-1].select("digest").first()
    root = root["digest"] if root else ""
    down = of_tops[-1].select("tree", "at", F.lit("").alias("digest"))
    for above in reversed(of_tops[:-1]):
        down = _handed_down(above, down, levels)
    # a path ends with the subroot of its tree
    down = tops.select("at", F.col("name").alias("tree"), F.col("digest").alias("_subroot")).join(down.select("at", "digest"), "at").select(
        "tree", F.lit(0).cast("long").alias("at"), F.concat("digest", F.lit("|"), "_subroot").alias("digest"))
    for above in reversed(of_trees[1:-1]):
        down = _handed_down(above, down, levels)
    proved = _proved(nodes, written(down, "manifest-paths"), levels)
    return proved.withColumns({"root": F.lit(root), "verified": F.col("folded_root") == F.lit(root)}).select(
        "doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def _proved(nodes: DataFrame, paths: DataFrame, levels: int) -> DataFrame:
    """`doc_id, leaf, subroot, proof_sha256, folded_root` of every leaf, given the paths of
    the blocks of leaves."""
    block = RUN ** levels

    def prove(rows: pa.Table) -> list[tuple]:
        order, slots, size, path = _slots(rows, block)
        steps_up, _, subroot = path.rpartition("|")
        above = _heard(steps_up)
        siblings_above = _siblings(above)
        doc_ids, tampered = rows["doc_id"].to_pylist(), rows["tampered"].to_pylist()
        folded = _fold(slots, min(levels, _height(size)))
        out = []
        for k, i in enumerate(order.tolist()):
            steps, leaf = _steps(folded, k), slots[k]
            proof = _digest([_siblings(steps), siblings_above])
            start = tampered[i].encode() if tampered[i] is not None else leaf
            out.append((doc_ids[i], leaf.decode(), subroot, proof.decode(), _climbed(_climbed(start, steps), above).decode()))
        return out

    both = _blocked(nodes, block).select(*_KEYS, "at", F.col("leaf").alias("digest"), "size", "doc_id", "tampered").unionByName(
        _brought(paths), allowMissingColumns=True)
    return _grouped(both, prove, "doc_id long, leaf string, subroot string, proof_sha256 string, folded_root string")
