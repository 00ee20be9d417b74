"""Snapshot fact and reviewer bridge."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.timing import local_date
from tidemark.operators.dimensions import reviewer_assignments
from tidemark.operators.keys import number_rows
from tidemark.operators.quality import duplicate_keys
from tidemark.schemas import (
    BRIDGE,
    DATE_ROLES,
    DIM_ISSUE,
    DIM_MILESTONE,
    DIM_STATE,
    DIM_STATUS,
    DIMENSIONS,
    FACT,
    DimensionSpec,
)

#: Natural order of snapshots: the order in which runs are loaded, then the issue.
SNAPSHOT_ORDER = ("extracted_at", "run_id", "issue_id")

#: Silver columns behind fact and bridge; texts of the issue are not among them.
_SNAPSHOT = (
    "run_id issue_id state status milestone reviewer created_at updated_at extracted_at "
    "is_assigned days_since_update submission_age_days"
).split()


def grain_violations(silver: DataFrame) -> DataFrame:
    """Submissions seen more than once in one extraction."""
    return duplicate_keys(silver, ["issue_id", "extracted_at"])


def lookup_key(rows: DataFrame, spec: DimensionSpec, dimension: DataFrame) -> DataFrame:
    """Add the surrogate key of ``spec`` by its natural key; unknown stays null.

    No hint: the dimension comes from stored parquet, so Spark knows its size and
    broadcasts it or, for an issue dimension as large as the fact, shuffles both.
    """
    mapping = dimension.select(spec.natural_key, spec.surrogate_key)
    return rows.join(mapping, spec.natural_key, "left")


def add_date_keys(rows: DataFrame, dim_date: DataFrame, zone: str) -> DataFrame:
    """``<role>_key`` for each timestamp: one calendar joined once per role."""
    for role in DATE_ROLES:
        calendar = dim_date.select(
            F.col("date").alias(f"{role}_date"), F.col("date_key").alias(f"{role}_key")
        )
        # At most one row per calendar day, whatever the size of the data.
        rows = (
            rows.withColumn(f"{role}_date", local_date(F.col(role), zone))
            .join(F.broadcast(calendar), f"{role}_date", "left")
            .drop(f"{role}_date")
        )
    return rows


def resolve_keys(silver: DataFrame, dimensions: Mapping[str, DataFrame], zone: str) -> DataFrame:
    """Silver rows with all dimension keys of the fact.

    Issues come last: if that join shuffles the rows, keys have replaced their texts by then.
    """

    def with_key(rows: DataFrame, spec: DimensionSpec) -> DataFrame:
        return lookup_key(rows, spec, dimensions[spec.table.name.removeprefix("gold.")])

    rows = silver
    for spec in (DIM_STATE, DIM_STATUS, DIM_MILESTONE):
        rows = with_key(rows, spec)
    return with_key(add_date_keys(rows, dimensions["dim_date"], zone), DIM_ISSUE)


def number_snapshots(silver: DataFrame, path: str, start: int) -> tuple[DataFrame, int]:
    """What fact and bridge need of the silver rows, each row with its snapshot key.

    Numbered before any dimension is joined, because numbering reads its input twice. Rows
    end up ordered by extraction, so each later write task sees few extractions. Also
    returns the number of rows.
    """
    order: list[Column] = [F.col(c) for c in SNAPSHOT_ORDER]
    return number_rows(silver.select(*_SNAPSHOT), "submission_snapshot_key", order, path, start)


def unresolved() -> Column:
    """A natural value found no key; only the status may be missing."""
    bad = F.col("status").isNotNull() & F.col("status_key").isNull()
    for column in FACT.required:
        if column.endswith("_key"):
            bad = bad | F.col(column).isNull()
    return bad


def _extracted_on() -> Column:
    return F.to_date("extracted_at").alias("extracted_on")


def fact_rows(resolved: DataFrame) -> DataFrame:
    """The fact columns and nothing else."""
    return resolved.withColumn("extracted_on", _extracted_on()).select(*FACT.columns)


def bridge_rows(numbered: DataFrame, dim_reviewer: DataFrame) -> DataFrame:
    """One row per snapshot and assigned reviewer."""
    assigned = reviewer_assignments(numbered, "submission_snapshot_key", "extracted_at")
    keyed = lookup_key(assigned, DIMENSIONS["dim_reviewer"], dim_reviewer)
    return keyed.withColumn("extracted_on", _extracted_on()).select(*BRIDGE.columns)
