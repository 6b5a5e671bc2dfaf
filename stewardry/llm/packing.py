"""Best-fit packing with certified bin counts.

Documents become token sequences, longer ones are cut, and the pieces are packed into
sequences of a fixed length. Pieces are dealt to partitions by hash; each partition is
packed by best-fit decreasing and gets a lower bound on its number of bins from
dual-feasible functions. Where the two are equal the packing is proven best; where there
is a gap, the partition's bins with room are opened and their pieces exchanged with those
of other such partitions, dealt anew to fewer partitions and packed again. A certified
partition gives up its loosest bin only, as the bounds of partitions round up each.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stewardry.llm.shared import give_back, kept_per_worker
from stewardry.llm.tokens import WordIds
from stewardry.session import written

CAPACITY = 4096
#: Closes a document.
END_ID = 1
#: Pieces a partition holds on average.
ROWS_PER_PARTITION = 50_000
#: Rounds of exchange at most; each deals what is left to fewer partitions.
ROUNDS = 6
TOKENIZER = "word_bpe_49k.json"

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
PLACED = PIECES + ", part long, bin long, offset long, again boolean, part_bins long, part_bound long"


def document_pieces(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32.

    `tokenizer` is the path of the tokenizer file on every worker; left out, the public
    word tokenizer that is installed there. A null text counts as empty and gives one
    piece with the closing id alone. Repeated rows are packed each.
    """
    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path = tokenizer
        if path is None:
            import public_tokenizers

            path = public_tokenizers.path(TOKENIZER)
        ids_of = kept_per_worker(f"word ids of {path}", lambda: WordIds(path))
        for batch in batches:
            rows: list[tuple] = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = np.append(ids_of.of_text(text.as_py()), END_ID).astype("<u4")
                for k, start in enumerate(range(0, len(ids), capacity)):
                    part = ids[start:start + capacity]
                    rows.append((doc_id, k, start, len(part), zlib.crc32(part.tobytes())))
            columns = list(zip(*rows, strict=True)) or [()] * 5
            types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types, strict=True)],
                ["doc_id", "piece", "start", "length", "ids_crc32"])
        give_back()

    return docs.select(F.col("doc_id").cast("long"), F.col("text")).mapInArrow(pieces, PIECES)


def bin_bound(lengths: np.ndarray, capacity: int) -> int:
    """Bins that any packing needs, by dual-feasible functions over the lengths.

    Two families: lengths over capacity - k count as a whole bin and those under k as
    nothing, for every k up to half; and lengths rounded to steps of 1/(k+1), for small k.
    """
    if not len(lengths):
        return 0
    count = np.bincount(lengths, minlength=capacity + 1).astype(np.int64)
    weight = count * np.arange(capacity + 1)
    # sums from a length up
    n_from, w_from = np.cumsum(count[::-1])[::-1], np.cumsum(weight[::-1])[::-1]
    k = np.arange(0, capacity // 2 + 1)
    large = np.where(k > 0, n_from[np.minimum(capacity - k + 1, capacity)], 0)
    middle = w_from[k] - np.where(k > 0, w_from[np.minimum(capacity - k + 1, capacity)], 0)
    best = int(np.max(-(-(large * capacity + middle) // capacity)))
    x = np.arange(capacity + 1)
    for steps in range(1, 33):
        scaled = x * (steps + 1)
        whole = scaled % capacity == 0
        # in units of capacity * steps: x itself on a step, else rounded down to one
        value = np.where(whole, x * steps, scaled // capacity * capacity)
        best = max(best, int(-(-int((count * value).sum()) // (capacity * steps))))
    return best


def best_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """bin and offset of each length, and the room left in each bin; best-fit decreasing.

    Open bins are stacked by the room they have; a number whose bits say which rooms occur
    finds the tightest one that fits.
    """
    order = np.argsort(-lengths, kind="stable")
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    stacks: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms, left = 0, []
    for i in order.tolist():
        need = int(lengths[i])
        fitting = rooms >> need
        if fitting:
            room = need + (fitting & -fitting).bit_length() - 1
            chosen = stacks[room].pop()
            if not stacks[room]:
                rooms &= ~(1 << room)
        else:
            room, chosen = capacity, len(left)
            left.append(capacity)
        bins[i], offsets[i] = chosen, capacity - room
        left[chosen] = room = room - need
        stacks[room].append(chosen)
        rooms |= 1 << room
    return bins, offsets, np.asarray(left, np.int64)


def _pack_partition(capacity: int):
    def pack(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["doc_id", "piece", "start"], kind="stable", na_position="first").reset_index(drop=True)
        lengths = rows["length"].to_numpy(np.int64)
        bins, offsets, left = best_fit(lengths, capacity)
        bound = bin_bound(lengths, capacity)
        again = left > 0
        if len(left) == bound:
            loosest = np.zeros(len(left), bool)
            loosest[np.argmax(left)] = True
            again &= loosest
        return rows.assign(bin=bins, offset=offsets, again=again[bins], part_bins=len(left), part_bound=bound)[
            [c.split()[0] for c in PLACED.split(", ")]]

    return pack


def placed_rounds(
    pieces: DataFrame, capacity: int = CAPACITY, rows_per_partition: int = ROWS_PER_PARTITION, rounds: int = ROUNDS,
) -> list[DataFrame]:
    """The written rounds: each piece with its part, bin and offset; `again` if it went on.

    `part_bins` and `part_bound` are the bins of its partition and the proven least number.
    """
    out: list[DataFrame] = []
    pool, parts = pieces, 1 << 62
    for k in range(rounds):
        n = pool.count()
        if n == 0 and out:
            break
        # what goes on is little; it meets in half as many partitions at most
        parts = max(1, min(-(-n // rows_per_partition), parts // 2))
        dealt = pool.withColumn("part", F.pmod(F.xxhash64(F.lit(k), "doc_id", "piece", "ids_crc32"), F.lit(parts)))
        placed = dealt.repartition(parts, "part").groupBy("part").applyInPandas(_pack_partition(capacity), PLACED)
        if parts == 1 or k == rounds - 1:
            placed = placed.withColumn("again", F.lit(False))
        out.append(written(placed, f"packed-{k}"))
        pool = out[-1].where("again").select(*pieces.columns)
        if parts == 1:
            break
    return out


def packed(
    docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY,
    rows_per_partition: int = ROWS_PER_PARTITION, rounds: int = ROUNDS,
) -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    Other columns of `docs` do not matter; no document, no rows. Ids that repeat or are
    null are packed like others.
    """
    pieces = written(document_pieces(docs, tokenizer, capacity), "pieces")
    results = [
        placed.where("NOT again").select(
            "doc_id", "piece", "start", "length", "ids_crc32",
            (F.shiftleft(F.lit(k).cast("long"), 58) + F.shiftleft("part", 24) + F.col("bin")).alias("sequence_id"), "offset",
        )
        for k, placed in enumerate(placed_rounds(pieces, capacity, rows_per_partition, rounds))
    ]
    return reduce(DataFrame.unionByName, results)
