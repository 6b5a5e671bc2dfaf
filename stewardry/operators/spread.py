"""How data is laid out: small inputs over all cores, small join sides to all tasks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_SMALL_SHARE = 32 * 1024 * 1024
# Rows of names and numbers (at most some hundred bytes each) that are broadcast.
BROADCAST_ROWS = 200_000
# Times its estimate that a join side may take in memory: the planner goes by the size of
# compressed files and knows of no rows that are made on the way.
_UNFOLDED = 32


def spread_small(df: DataFrame) -> DataFrame:
    """`df` over as many partitions as there are cores, if it is small.

    Text work takes long per byte, and a small file is one partition and so one task. The
    planner's size estimate decides: up to 32 MiB per core the rows are dealt out anew,
    a larger input, which has enough partitions of its own, is left alone.
    """
    if df.isStreaming:
        return df
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if estimated_bytes(df) <= cores * _SMALL_SHARE else df


def estimated_bytes(df: DataFrame) -> int:
    """The planner's estimate; nothing runs for it."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def shuffled_if_large(df: DataFrame) -> DataFrame:
    """A join side that is broadcast, and so passes through the driver, only if it is certain
    to be small; else both sides are shuffled, and large partitions of one key are split."""
    conf = df.sparkSession._jsparkSession.sessionState().conf()
    return df.hint("merge") if estimated_bytes(df) * _UNFOLDED > conf.autoBroadcastJoinThreshold() else df


def join_hot(
    facts: DataFrame, owners: DataFrame, key: str, by: str | Column,
    limit: int = BROADCAST_ROWS, salts: int = 32, how: str = "inner",
) -> DataFrame:
    """Join of many rows with their few owners, where one key may hold most rows.

    The owners are counted as part of the query: up to `limit` they stay as they are. Beyond
    that the rows of a key are dealt over `salts` tasks by `by`, and every owner is there once
    per salt. Owners are broadcast only where all their copies are small. `how` is a
    join that keeps rows of `facts` alone or with an owner: inner, left, left_semi, left_anti.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"how must not be {how!r}")
    counted = owners.agg(F.count(F.lit(1))).scalar()
    n = F.when(counted <= limit, F.lit(1)).otherwise(F.lit(salts))
    salted = owners.withColumn("_salt", F.explode(F.sequence(F.lit(0), n - 1)))
    dealt = facts.withColumn("_salt", F.pmod(F.xxhash64(by), n).cast("int"))
    return dealt.join(shuffled_if_large(salted), [key, "_salt"], how).drop("_salt")
