"""Rows of vectors as fixed-width bytes, so that tasks handle them as matrices."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def clean_vectors(rows: DataFrame, id_column: str, vector_column: str, zero: bool = True) -> DataFrame:
    """node, dim, vector (little-endian doubles), a row for each given.

    The vector is null where the id is null, the vector is null or empty or has a null or
    non-finite component, or, if `zero` is not wanted, has no other component than zeros.
    """
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat = pc.cast(pc.list_flatten(batch.column(1)), pa.float64())
            row = pc.list_parent_indices(batch.column(1)).to_numpy(zero_copy_only=False)
            finite = np.isfinite(pc.fill_null(flat, float("nan")).to_numpy(zero_copy_only=False))
            sizes = np.bincount(row, minlength=len(batch))
            ok = (sizes > 0) & (np.bincount(row, weights=finite, minlength=len(batch)) == sizes)
            ok &= pc.is_valid(batch.column(0)).to_numpy(zero_copy_only=False)
            values = pc.fill_null(flat, 0.0).to_numpy(zero_copy_only=False).astype("<f8")
            if not zero:
                ok &= np.bincount(row, weights=values != 0, minlength=len(batch)) > 0
            ends = np.cumsum(sizes)
            found = [values[ends[i] - sizes[i]:ends[i]].tobytes() if ok[i] else None for i in range(len(batch))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes.astype(np.int64)), pa.array(found, pa.binary())], ["node", "dim", "vector"])

    picked = rows.select(F.col(id_column).cast("long"), F.col(vector_column).cast("array<double>"))
    return picked.mapInArrow(of, "node long, dim long, vector binary")


def matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Vectors of one length as rows of doubles."""
    parts = column.to_pylist()
    return np.frombuffer(b"".join(parts), "<f8").reshape(len(parts), -1)
