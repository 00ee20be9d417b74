"""Broadcasts whose size is checked first."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A frame of a few narrow columns with this many rows fits every executor.
BROADCAST_ROWS = 200_000


def broadcast_within(frame: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Hint a broadcast if the frame has at most ``max_rows`` rows.

    Beyond that the frame is returned as it is, and Spark plans a shuffle join. The
    count stops at ``max_rows + 1`` rows.
    """
    if frame.limit(max_rows + 1).count() <= max_rows:
        return F.broadcast(frame)
    return frame
