"""Candidate edges among members of hash buckets, without listing a bucket's pairs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stewardry.session import written

#: Members in a block; a task holds two.
BLOCK = 512


def shared_buckets(members: DataFrame, key: list[str], label: str) -> tuple[DataFrame, DataFrame]:
    """Of `members` (key, node, family): the distinct pairs a, b of two-member buckets, and
    the members (key, node, family) of larger ones. Buckets whose members are of one family
    already are left out, and buckets of the same members count once."""
    of_members = [F.bit_xor(F.xxhash64(F.lit(k), "node")).alias(f"_m{k}") for k in (1, 2)]
    shared = members.groupBy(*key).agg(F.count("*").alias("_n"), F.min("node").alias("a"), F.max("node").alias("b"),
                                         (F.min("family") < F.max("family")).alias("_apart"), *of_members)
    shared = written(shared.where("_n > 1 AND _apart"), label)
    larger = shared.where("_n > 2").groupBy("_n", "_m1", "_m2").agg(F.min(F.struct(*key)).alias("bucket"))
    return shared.where("_n = 2").select("a", "b").distinct(), members.join(larger.select("bucket.*"), key)


def in_block_pairs(members: DataFrame, key: list[str], node: str, block: int = BLOCK) -> DataFrame:
    """`members` once for each pair of blocks of its group that it takes part in.

    Groups are told by `key`; adds `_i`, `_j` (the pair of blocks) and `_own` (the row's).
    """
    sizes = members.groupBy(*key).agg(F.ceil(F.count("*") / block).alias("_blocks"))
    own = F.pmod(F.xxhash64(F.lit(3), node), F.col("_blocks"))
    out = members.join(sizes.where("_blocks > 1"), key, "left").withColumn("_own", F.coalesce(own, F.lit(0).cast("long")))
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce(F.col("_blocks"), F.lit(1).cast("long")) - 1))
    out = out.withColumn("_other", other)
    return out.withColumns({"_i": F.least("_own", "_other"), "_j": F.greatest("_own", "_other")}).drop("_other", "_blocks")
