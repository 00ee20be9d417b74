"""Dense, ordered surrogate keys without a global sort in one task."""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_SLOT, _RANGE, _OFFSET = "_slot", "_range", "_offset"
_ROW_BITS = 33  # monotonically_increasing_id(): partition above, row number below


def number_rows(
    frame: DataFrame, key: str, order_by: list[Column], path: str, start: int = 1
) -> tuple[DataFrame, int]:
    """Number the rows ``start, start + 1, ...`` in ``order_by`` order as column ``key``.

    The frame is range-partitioned, sorted and written to ``path``. Each task numbers its
    own range; the offset of a range is the row count of those before it, joined from a
    frame with one row per range. The written copy is what makes the numbers stable: a
    recomputed range partitioning could draw its borders elsewhere. Range partitioning reads
    its input twice, so number before joining. ``order_by`` must be unique per row. Also
    returns the number of rows.
    """
    (
        frame.repartitionByRange(*order_by)
        .sortWithinPartitions(*order_by)
        .withColumn(_SLOT, F.monotonically_increasing_id())
        .write.mode("errorifexists")
        .parquet(path)
    )
    spark = frame.sparkSession
    staged = spark.read.parquet(path).withColumn(_RANGE, F.shiftright(_SLOT, _ROW_BITS))
    # One row per shuffle partition, read from a single narrow column.
    counts = sorted(
        (row[_RANGE], row["count"]) for row in staged.select(_RANGE).groupBy(_RANGE).count().collect()
    )
    begins = accumulate((n for _, n in counts), initial=start)
    offsets = spark.createDataFrame(
        [(part, begin) for (part, _), begin in zip(counts, begins)], f"{_RANGE} long, {_OFFSET} long"
    )
    row = F.col(_SLOT).bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    numbered = staged.join(F.broadcast(offsets), _RANGE).withColumn(key, F.col(_OFFSET) + row)
    return numbered.drop(_SLOT, _RANGE, _OFFSET), sum(n for _, n in counts)


def number_ranges(
    frame: DataFrame, key: str, order_by: list[Column], path: str, start: int = 1
) -> DataFrame:
    """:func:`number_rows` without the count."""
    return number_rows(frame, key, order_by, path, start)[0]
