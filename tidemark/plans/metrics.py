"""The five metric datasets and their registry."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.functions.text import humanise
from tidemark.functions.timing import local_date
from tidemark.operators.decisions import is_on_track, is_unresolved, milestones_behind, next_step
from tidemark.operators.quality import validate_dataset
from tidemark.operators.snapshots import (
    Mart,
    builder_submissions,
    current_submissions,
    expected_milestone,
    final_milestone,
    latest_assignments,
    latest_extraction,
    with_labels,
    with_reviewer_names,
)


# --- Submission distribution ---------------------------------------------------


def submission_distribution(mart: Mart) -> DataFrame:
    """Submissions per milestone and status in the latest extraction, zeros included.

    The fact is counted first; only then is the grid of both dimensions laid out. The
    grid is the result itself, one row per milestone and status.
    """
    counts = (
        latest_extraction(mart)
        .filter(F.col("status_key").isNotNull())
        .groupBy("milestone_key", "status_key")
        .agg(F.count("*").alias("n"))
    )
    grid = mart.dim_milestone.crossJoin(mart.dim_status)
    return (
        grid.join(counts, ["milestone_key", "status_key"], "left")
        .select(
            "milestone",
            "status",
            F.coalesce("n", F.lit(0).cast("bigint")).alias("submission_count"),
            "milestone_number",
        )
        .orderBy(F.col("milestone_number").asc_nulls_last(), "status", "milestone")
        .drop("milestone_number")
    )


# --- Builder schedule ------------------------------------------------------------


def highest_milestones(mart: Mart) -> DataFrame:
    """Furthest milestone number of each builder in the latest extraction."""
    return builder_submissions(mart).groupBy("builder").agg(
        F.max("milestone_number").alias("milestone_number")
    )


def builder_positions(mart: Mart) -> DataFrame:
    """Each builder against the expected milestone."""
    placed = highest_milestones(mart).withColumn(
        "expected_milestone_number", expected_milestone(mart).scalar()
    )
    number, expected = F.col("milestone_number"), F.col("expected_milestone_number")
    return placed.withColumns(
        {
            "milestones_behind": milestones_behind(number, expected),
            "schedule_status": F.when(is_on_track(number, expected), "on_track").otherwise(
                "delayed"
            ),
        }
    )


def share_of_total(counts: DataFrame, count: str, share: str) -> DataFrame:
    """Percentage of the overall count per row, two decimals.

    The total is a scalar over the already grouped rows, not a window over the data.
    """
    total = counts.agg(F.sum(count).alias("total")).scalar()
    percent = F.lit(100.0) * F.col(count).cast("double") / F.nullif(total, F.lit(0)).cast("double")
    return counts.withColumn(share, F.round(percent, 2))


def builder_schedule(mart: Mart) -> DataFrame:
    """Number and share of builders on track and delayed; absent groups have no row."""
    counts = builder_positions(mart).groupBy("schedule_status").agg(
        F.count("*").alias("builder_count")
    )
    # At most two rows reach this window.
    total = F.sum("builder_count").over(W.partitionBy())
    percent = F.lit(100.0) * F.col("builder_count").cast("double") / total.cast("double")
    return counts.withColumn("builder_percentage", F.round(percent, 2)).orderBy(
        "schedule_status"
    )


# --- Progress trend ----------------------------------------------------------------


def builder_completion(mart: Mart) -> DataFrame:
    """Per extraction and builder: number of distinct passed milestones."""
    builders = mart.dim_issue.filter(F.col("issue_author").isNotNull()).select(
        "issue_key", F.col("issue_author").alias("builder")
    )
    passed = F.when(F.col("status") == schemas.STATUS_PASSED, F.col("milestone_key"))
    return (
        mart.fact.select("extracted_at", "issue_key", "status_key", "milestone_key")
        .join(mart.dim_status.select("status_key", "status"), "status_key", "left")
        .select("extracted_at", "issue_key", passed.alias("passed_key"))
        .join(builders, "issue_key")
        .groupBy("extracted_at", "builder")
        .agg(F.count_distinct("passed_key").alias("passed_milestones"))
    )


def progress_trend(mart: Mart) -> DataFrame:
    """Average completion over the builders observed in each extraction.

    Summed as integers: passed milestones over builders times milestones.
    """
    milestones = mart.dim_milestone.agg(F.count("*").alias("n")).scalar()
    totals = (
        builder_completion(mart)
        .groupBy("extracted_at")
        .agg(
            F.sum("passed_milestones").alias("passed"),
            F.count("*").alias("observed_builder_count"),
        )
        .withColumn("milestones", milestones)
    )
    possible = F.col("observed_builder_count") * F.col("milestones")
    percent = F.lit(100.0) * F.col("passed").cast("double") / F.nullif(
        possible, F.lit(0).cast("bigint")
    ).cast("double")
    return totals.select(
        "extracted_at",
        local_date(F.col("extracted_at"), mart.zone).alias("extraction_date"),
        F.round(percent, 2).alias("average_completion_percentage"),
        "observed_builder_count",
    ).orderBy("extracted_at")


# --- Interventions -----------------------------------------------------------------


def classified_submissions(mart: Mart) -> DataFrame:
    """Current submission per builder with schedule, reviewers and next step."""
    # Assignments meet the current submissions first, so that only theirs are gathered.
    current = with_reviewer_names(
        with_labels(mart, current_submissions(mart)), latest_assignments(mart)
    )
    number = F.col("milestone_number")
    step = next_step(
        F.col("raw_status"),
        F.col("issue_state"),
        F.col("reviewer_count"),
        number,
        F.col("final_number"),
    )
    return (
        current.withColumns(
            {
                "expected_number": expected_milestone(mart).scalar(),
                "final_number": final_milestone(mart).scalar(),
            }
        )
        .withColumn("step", step)
        .select(
            "builder",
            F.col("milestone").alias("current_milestone"),
            F.coalesce("raw_status", F.lit("Unknown")).alias("status"),
            F.when(is_on_track(number, F.col("expected_number")), "On track")
            .otherwise("Delayed")
            .alias("schedule_status"),
            F.coalesce("reviewer", F.lit(schemas.UNASSIGNED)).alias("reviewer"),
            "issue_state",
            "submission_age_days",
            "days_since_update",
            F.col("step.actor").alias("next_actor"),
            F.col("step.action").alias("next_action"),
            "issue_url",
            F.col("step.priority").alias("sort_priority"),
        )
    )


def interventions(mart: Mart) -> DataFrame:
    """One row per builder, most urgent first."""
    return (
        classified_submissions(mart)
        .orderBy("sort_priority", F.col("days_since_update").desc_nulls_last(), "builder")
        .drop("sort_priority")
    )


# --- Reviewer workload ---------------------------------------------------------------


def reviewer_workload(mart: Mart) -> DataFrame:
    """Unresolved current submissions per reviewer; one counts for each of its reviewers."""
    unresolved = with_labels(mart, current_submissions(mart)).filter(
        is_unresolved(F.col("issue_state"), F.col("raw_status"))
    )
    return (
        unresolved.select("submission_snapshot_key")
        .join(latest_assignments(mart), "submission_snapshot_key", "left")
        .select(
            "submission_snapshot_key",
            F.coalesce("reviewer", F.lit(schemas.UNASSIGNED)).alias("reviewer"),
        )
        .groupBy("reviewer")
        .agg(F.count_distinct("submission_snapshot_key").alias("unresolved_count"))
        .orderBy(F.col("unresolved_count").desc(), "reviewer")
    )


# --- Registry ---------------------------------------------------------------------


def _schedule_dataset(mart: Mart) -> DataFrame:
    return builder_schedule(mart).withColumn(
        "schedule_status", humanise(F.col("schedule_status"))
    )


def _progress_dataset(mart: Mart) -> DataFrame:
    return progress_trend(mart).withColumnRenamed(
        "average_completion_percentage", "completion_rate"
    )


METRICS: dict[str, Callable[[Mart], DataFrame]] = {
    "submission_status": submission_distribution,
    "builder_schedule": _schedule_dataset,
    "progress_trend": _progress_dataset,
    "interventions": interventions,
    "reviewer_workload": reviewer_workload,
}


def metric(mart: Mart, name: str) -> DataFrame:
    """A metric dataset by name, before validation."""
    if METRICS.get(name) is None:
        raise KeyError(f"No metric is defined for dataset: {name}")
    return METRICS[name](mart)


def validated_metric(mart: Mart, name: str) -> DataFrame:
    return validate_dataset(metric(mart, name), name)


def metric_frames(mart: Mart) -> dict[str, DataFrame]:
    """All metric datasets, before validation."""
    return {name: metric(mart, name) for name in schemas.DATASET_SCHEMAS}
