"""Proportional stratified interleaving into shards.

Rows are shuffled by a seeded hash within their source and ranked there. A row's
fractional rank, (rank - 1/2) / rows of its source, says how far through its source it
stands; sorting all rows by it interleaves the sources in proportion, and cutting the
sorted sequence into equal runs gives shards that all hold the same mixture.

Neither rank is taken in one task: rows are ranked inside hash buckets of a source and
inside stretches of the fractional rank, and only the counts of those are summed up.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stewardry.session import written

#: Rows that a bucket holds on average; a bucket is the most that one window sorts.
ROWS_PER_BUCKET = 8192


def _bucket_bits(rows: int, per_bucket: int) -> int:
    return max(0, math.ceil(math.log2(max(1, rows) / per_bucket)))


def interleaved(
    rows: DataFrame, stratum: Column, tie_break: list[str], shards: int = 16, seed: int = 17,
    per_bucket: int = ROWS_PER_BUCKET,
) -> DataFrame:
    """`rows` with `shard` (0 to shards - 1) and `slot` (0, 1, ... within the shard).

    `rows` should be narrow: it is written to the shared folder and read twice. `stratum`
    is the source; nulls are a source of their own. `tie_break` names the columns that
    order rows whose shuffle hash is equal, the first of them is what is hashed; rows
    equal in all of them are interchangeable. Row counts of shards differ by one at most.
    An empty input gives no rows.
    """
    if shards < 1:
        raise ValueError("shards must be positive")
    key = F.xxhash64(F.lit(seed), F.col(tie_break[0]))
    base = rows.withColumns({"_stratum": F.coalesce(F.concat(F.lit("="), stratum.cast("string")), F.lit("")), "_key": key})
    base = written(base, "interleave")
    total = base.count()
    bits = _bucket_bits(total, per_bucket)
    # the top bits of the hash: buckets in the order of the shuffle
    bucket = F.shiftrightunsigned("_key", 64 - bits) if bits else F.lit(0).cast("long")
    base = base.withColumn("_bucket", bucket)

    counts = base.groupBy("_stratum", "_bucket").agg(F.count("*").alias("_rows"))
    of_stratum = Window.partitionBy("_stratum")
    counts = counts.select(
        "_stratum", "_bucket",
        (F.sum("_rows").over(of_stratum.orderBy("_bucket")) - F.col("_rows")).alias("_before"),
        F.sum("_rows").over(of_stratum).alias("_of"),
    )
    order = [F.col(c).asc_nulls_first() for c in tie_break]
    # top bits as unsigned, the rest of the key as it stands within the bucket
    within = Window.partitionBy("_stratum", "_bucket").orderBy(F.shiftrightunsigned("_key", 1), "_key", *order)
    ranked = base.withColumn("_rank", F.row_number().over(within)).join(counts, ["_stratum", "_bucket"])
    ranked = ranked.withColumn("_part", (F.col("_before") + F.col("_rank") - F.lit(0.5)) / F.col("_of"))
    ranked = written(
        ranked.withColumn("_stretch", F.floor(F.col("_part") * F.lit(float(1 << bits))))
        .drop("_before", "_rank", "_of", "_bucket"), "interleave-ranked",
    )

    # one row for each stretch, thousands of times fewer than rows
    stretches = ranked.groupBy("_stretch").agg(F.count("*").alias("_rows"))
    stretches = stretches.select(
        "_stretch", (F.sum("_rows").over(Window.orderBy("_stretch")) - F.col("_rows")).alias("_before"),
    )
    within = Window.partitionBy("_stretch").orderBy("_part", "_key", *order, "_stratum")
    placed = ranked.withColumn("_rank", F.row_number().over(within)).join(stretches, "_stretch")
    place = F.col("_before") + F.col("_rank") - 1
    size = F.lit(total)
    placed = placed.withColumn("_place", place).withColumn(
        "shard", F.expr(f"CAST(_place * {shards} DIV {max(1, total)} AS INT)")
    )
    start = F.expr(f"(CAST(shard AS BIGINT) * {total} + {shards - 1}) DIV {shards}")
    placed = placed.withColumn("slot", F.col("_place") - start)
    return placed.drop("_stratum", "_key", "_stretch", "_part", "_rank", "_before", "_place")


def sharded_documents(docs: DataFrame, shards: int = 16, seed: int = 17) -> DataFrame:
    """Every document's place: doc_id, size, text_crc32, law, shard, slot, grown_shard.

    `size` is the UTF-8 bytes of the text plus 1 (null text: 1), `text_crc32` that of the
    text's bytes (null: of none, 0). The law is `rows`: shards differ by one row at most.
    Repeated rows are placed one by one; null ids and sources are values like others;
    other columns do not matter.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        "doc_id", F.col("source").alias("_source"),
        (F.octet_length(text).cast("long") + 1).alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"),
    )
    out = interleaved(rows, F.col("_source"), ["doc_id", "text_crc32", "size"], shards, seed)
    return out.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
