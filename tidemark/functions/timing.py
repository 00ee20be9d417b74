"""Instants, local dates and elapsed days."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_instant(value: Column) -> Column:
    """ISO-8601 text (or any timestamp) as an instant, floored to the second."""
    return F.date_trunc("second", value.cast("timestamp"))


def local_date(instant: Column, zone: str) -> Column:
    """Calendar date of an instant in ``zone``; the session zone must be UTC."""
    return F.to_date(F.from_utc_timestamp(instant, zone))


def elapsed_days(later: Column, earlier: Column) -> Column:
    """Whole 24-hour periods between two instants, rounded down (may be negative)."""
    seconds = F.unix_seconds(later) - F.unix_seconds(earlier)
    return F.floor(seconds / F.lit(86400)).cast("bigint")
