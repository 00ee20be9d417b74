"""Reading the mart: as-of values, latest snapshot, current submission per builder."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.functions.timing import local_date
from tidemark.schemas import BRIDGE, DIMENSIONS, FACT, GOLD_LOADS, LOCAL_ZONE
from tidemark.sources.warehouse import Warehouse


@dataclass(frozen=True)
class Mart:
    """The gold tables of one published version."""

    fact: DataFrame
    bridge: DataFrame
    dim_issue: DataFrame
    dim_reviewer: DataFrame
    dim_state: DataFrame
    dim_status: DataFrame
    dim_milestone: DataFrame
    dim_date: DataFrame | None = None
    #: ``extracted_at`` of every loaded run. A load is never empty, so its maximum is
    #: that of the fact, found without reading the fact.
    loads: DataFrame | None = None
    zone: str = LOCAL_ZONE

    @classmethod
    def open(cls, warehouse: Warehouse, zone: str = LOCAL_ZONE) -> "Mart":
        dimensions = {name: spec.table.name for name, spec in DIMENSIONS.items()}
        tables = warehouse.read_all(
            FACT.name, BRIDGE.name, GOLD_LOADS.name, *dimensions.values()
        )
        return cls(
            fact=tables[FACT.name],
            bridge=tables[BRIDGE.name],
            loads=tables[GOLD_LOADS.name],
            zone=zone,
            **{name: tables[table] for name, table in dimensions.items()},
        )


def as_of(mart: Mart) -> DataFrame:
    """One row: time of the latest extraction and its local date."""
    times = mart.fact if mart.loads is None else mart.loads
    latest = times.agg(F.max("extracted_at").alias("extracted_at"))
    return latest.withColumn("as_of_date", local_date(F.col("extracted_at"), mart.zone))


def in_latest_extraction(mart: Mart, rows: DataFrame) -> Column:
    """Predicate on the partition column of the fact and the bridge."""
    return F.col("extracted_on") == as_of(mart).select(F.to_date("extracted_at")).scalar()


def latest_extraction(mart: Mart) -> DataFrame:
    """Fact rows of the latest extraction; reads one partition folder."""
    at = as_of(mart).select("extracted_at").scalar()
    rows = mart.fact.filter(F.col("extracted_at") == at)
    if "extracted_on" in mart.fact.columns:
        rows = rows.filter(in_latest_extraction(mart, rows))
    return rows


def latest_bridge(mart: Mart) -> DataFrame:
    """Bridge rows that can belong to the latest extraction."""
    if "extracted_on" in mart.bridge.columns:
        return mart.bridge.filter(in_latest_extraction(mart, mart.bridge))
    return mart.bridge


def expected_milestone(mart: Mart) -> DataFrame:
    """One row: earliest milestone still open on the as-of date, else the highest."""
    today = as_of(mart).select("as_of_date").scalar()
    number = F.col("milestone_number")
    open_number = F.when(F.col("deadline_date") >= F.col("today"), number)
    return (
        mart.dim_milestone.withColumn("today", today)
        .agg(F.coalesce(F.min(open_number), F.max(number)).alias("milestone_number"))
    )


def final_milestone(mart: Mart) -> DataFrame:
    """One row: the highest milestone number."""
    return mart.dim_milestone.agg(F.max("milestone_number").alias("milestone_number"))


def builder_submissions(mart: Mart) -> DataFrame:
    """Latest-extraction submissions of known builders with issue and milestone."""
    issues = mart.dim_issue.filter(F.col("issue_author").isNotNull()).select(
        "issue_key", "issue_url", F.col("issue_author").alias("builder")
    )
    milestones = mart.dim_milestone.select("milestone_key", "milestone", "milestone_number")
    return (
        latest_extraction(mart).join(issues, "issue_key").join(milestones, "milestone_key")
    )


def current_submissions(mart: Mart) -> DataFrame:
    """The furthest, most recent submission of each builder.

    ``= 1`` on the row number lets Spark keep one row per builder and task before the
    shuffle, so a builder with much of the data is spread over all tasks.
    """
    furthest_first = W.partitionBy("builder").orderBy(
        *(
            F.col(c).desc_nulls_last()
            for c in (
                "milestone_number",
                "updated_at",
                "created_at",
                "issue_key",
                "submission_snapshot_key",
            )
        )
    )
    ranked = builder_submissions(mart).withColumn(
        "place", F.row_number().over(furthest_first)
    )
    return ranked.filter(F.col("place") == 1).drop("place")


def with_labels(mart: Mart, rows: DataFrame) -> DataFrame:
    """Add state (must exist) and status (may be missing) of each snapshot."""
    states = mart.dim_state.select("state_key", F.col("state").alias("issue_state"))
    statuses = mart.dim_status.select("status_key", F.col("status").alias("raw_status"))
    return rows.join(states, "state_key").join(statuses, "status_key", "left")


def latest_assignments(mart: Mart) -> DataFrame:
    """``submission_snapshot_key, reviewer`` of the latest extraction."""
    return (
        latest_bridge(mart)
        .join(mart.dim_reviewer, "reviewer_key", "left")
        .select("submission_snapshot_key", "reviewer")
    )


def _name_columns() -> list[Column]:
    names = F.collect_set("reviewer")
    return [
        F.array_join(F.array_sort(names), ", ").alias("reviewer"),
        F.size(names).cast("bigint").alias("reviewer_count"),
    ]


def reviewer_names(assignments: DataFrame, key: str) -> DataFrame:
    """Per key: distinct reviewer names in order, comma separated, and their number.

    Names are made distinct before the shuffle; the text per key is the result itself.
    """
    return (
        assignments.filter(F.col("reviewer").isNotNull()).groupBy(key).agg(*_name_columns())
    )


def with_reviewer_names(rows: DataFrame, assignments: DataFrame) -> DataFrame:
    """Add names and number of each snapshot's reviewers, both null where it has none.

    Rows must differ in ``submission_snapshot_key``. They are joined before the names are
    gathered, so assignments of other snapshots are dropped as they are read.
    """
    named = assignments.filter(F.col("reviewer").isNotNull())
    gathered = rows.join(named, "submission_snapshot_key", "left").groupBy(*rows.columns)
    return gathered.agg(*_name_columns()).withColumns(
        {
            "reviewer": F.when(F.col("reviewer_count") > 0, F.col("reviewer")),
            "reviewer_count": F.nullif("reviewer_count", F.lit(0)),
        }
    )
