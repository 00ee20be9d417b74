"""Vectors as integers: reading list columns with numpy, and leaving out unusable rows."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import staged


def matrix_of(column: pa.Array) -> np.ndarray:
    """The vectors of a list column without nulls, one per row. All have one length."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    values = column.flatten().to_numpy(zero_copy_only=False)
    return values.reshape(len(column), -1) if len(column) else values.reshape(0, 0)


def _usable(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Rows that hold a vector of finite components, and these vectors."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    sizes = np.asarray(column.value_lengths().fill_null(0), np.int64)
    values = column.flatten().cast(pa.float64())
    bad = ~np.isfinite(values.to_numpy(zero_copy_only=False))  # nulls are read as NaN
    ends = np.cumsum(sizes)
    faults = np.concatenate([[0], np.cumsum(bad)])
    rows = np.flatnonzero((sizes > 0) & (faults[ends] == faults[ends - sizes]))
    if not len(rows):
        return rows, np.zeros((0, 0))
    if len(set(sizes[rows].tolist())) > 1:
        raise ValueError("Vectors must have one length")
    at = (ends - sizes)[rows, None] + np.arange(sizes[rows[0]])
    return rows, values.to_numpy(zero_copy_only=False)[at]


def integer_vectors(rows: DataFrame, scale: int, largest: int, label: str) -> DataFrame:
    """``row, vec_id, label, x``: rows with a usable vector; ``x`` is ``floor(scale * component)``.

    Written below the shared scratch folder, so ``row`` (unique) and the order of rows stay
    the same in every later pass. Rows go whose vector is null, empty, or holds a null or
    non-finite component. Vectors of several lengths, and integers of more than ``largest``
    in size, raise ValueError: sums of their products would not fit 64 bits.
    """

    def read(batches):
        for batch in batches:
            kept, vectors = _usable(batch.column("x"))
            if not len(kept):
                continue
            whole = np.floor(vectors * float(scale))
            if np.abs(whole).max() > largest:
                raise ValueError(f"Components times {scale} must lie within {largest}")
            flat = pa.array(whole.astype(np.int32).ravel())
            ends = np.arange(len(kept) + 1, dtype=np.int32) * whole.shape[1]
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c).take(pa.array(kept)) for c in ("vec_id", "label")),
                    pa.ListArray.from_arrays(pa.array(ends), flat),
                ],
                ["vec_id", "label", "x"],
            )

    narrow = rows.select("vec_id", F.expr(label).alias("label"), F.col("embedding").alias("x"))
    kinds = [f"{c} {narrow.schema[c].dataType.simpleString()}" for c in ("vec_id", "label")]
    integers = narrow.mapInArrow(read, ", ".join([*kinds, "x array<int>"]))
    return staged(integers.withColumn("row", F.monotonically_increasing_id()), "vectors")
