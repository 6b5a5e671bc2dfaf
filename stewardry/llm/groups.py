"""Groups of rows inside Arrow batches, many small groups to a Python call."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame


def map_groups(rows: DataFrame, keys: list[str], order: list[str], work: Callable[[pa.Table], list[np.ndarray]], schema: str) -> DataFrame:
    """`work` on the rows of each group, sorted by `order`; it returns columns of longs.

    `keys` are long or int columns without nulls. A group is held in memory as a whole.
    """
    names = [c.split()[0] for c in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not len(batch):
                continue
            table = pa.Table.from_batches([*held, batch]).combine_chunks()
            edge = np.zeros(len(table) - 1, bool)
            for key in keys:
                k = table.column(key).to_numpy()
                edge |= k[1:] != k[:-1]
            cuts = [0, *(np.flatnonzero(edge) + 1).tolist()]
            yield packed([work(table.slice(lo, hi - lo)) for lo, hi in zip(cuts, cuts[1:], strict=False)])
            held = table.slice(cuts[-1]).to_batches()
        if held:
            yield packed([work(pa.Table.from_batches(held).combine_chunks())])

    def packed(found: list[list[np.ndarray]]) -> pa.RecordBatch:
        columns = [np.concatenate([np.asarray(f[i], np.int64) for f in found]) if found else np.zeros(0, np.int64) for i in range(len(names))]
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names)

    return rows.repartition(*keys).sortWithinPartitions(*keys, *order).mapInArrow(run, schema)


def runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """The rows of each run of equal keys, across batches; keys are never null.

    One run is held in memory as a whole.
    """
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not len(batch):
            continue
        table = pa.Table.from_batches([*held, batch]).combine_chunks()
        edge = np.zeros(len(table) - 1, bool)
        for key in keys:
            edge |= pc.not_equal(table[key][1:], table[key][:-1]).to_numpy()
        cuts = [0, *(np.flatnonzero(edge) + 1).tolist()]
        for lo, hi in zip(cuts, cuts[1:], strict=False):
            yield table.slice(lo, hi - lo)
        held = table.slice(cuts[-1]).to_batches()
    if held:
        yield pa.Table.from_batches(held).combine_chunks()
