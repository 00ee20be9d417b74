"""Tables behind the presentation pages, computed from the metric datasets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.functions.text import normalise_term, slug

_SCHEDULE_CARDS = (("on track", "On track", "success"), ("delayed", "Delayed", "danger"))


#: Column for submissions of milestones that a pivot was not asked to list.
OTHER_MILESTONES = "other"


def status_pivot(
    distribution: DataFrame, milestones: Sequence[str] = schemas.DISPLAY_MILESTONES
) -> DataFrame:
    """One row per status, one zero-filled column per milestone, and one for all others.

    Statuses with a fixed place come first, the others follow by name. Milestones that are
    not listed, and null, are summed as ``other``, so each row adds up to its status.
    """
    shown = F.when(F.col("milestone").isin(*milestones), F.col("milestone"))
    columns = [*milestones, OTHER_MILESTONES]
    place = F.array_position(
        F.array(*(F.lit(s) for s in schemas.STATUS_DISPLAY_ORDER)), F.col("status")
    )
    unplaced = len(schemas.STATUS_DISPLAY_ORDER) + 1
    return (
        distribution.withColumn("milestone", F.coalesce(shown, F.lit(OTHER_MILESTONES)))
        .groupBy("status")
        .pivot("milestone", columns)
        .agg(F.sum("submission_count"))
        .na.fill(0, columns)
        .withColumn(
            "display_rank", F.when(place > 0, place).otherwise(unplaced).cast("bigint")
        )
        .orderBy("display_rank", "status")
    )


def progress_series(progress: DataFrame) -> DataFrame:
    """Completion by date with the upper end of the axis."""
    top = progress.agg(F.greatest(F.lit(100.0), F.max("completion_rate") + 10)).scalar()
    return (
        progress.select("extraction_date", "completion_rate")
        .withColumn("axis_max", top)
        .orderBy("extraction_date")
    )


def workload_series(workload: DataFrame) -> DataFrame:
    """Reviewers from least to most loaded; the unassigned bar stands out."""
    return workload.select(
        "reviewer",
        "unresolved_count",
        (F.col("reviewer") == schemas.UNASSIGNED).alias("is_highlighted"),
    ).orderBy("unresolved_count", "reviewer")


def schedule_kpis(schedule: DataFrame) -> DataFrame:
    """The two schedule cards, with zero for a group nobody is in."""
    spine = schedule.sparkSession.createDataFrame(
        [(i, *card) for i, card in enumerate(_SCHEDULE_CARDS, start=1)],
        "card_no int, card_key string, label string, tone string",
    )
    groups = schedule.select(
        F.lower("schedule_status").alias("card_key"), "builder_count", "builder_percentage"
    )
    rounded = F.bround("builder_percentage", 0).cast("bigint").cast("string")
    return (
        spine.join(groups, "card_key", "left")
        .select(
            F.col("card_no").cast("bigint").alias("card_no"),
            "label",
            F.coalesce("builder_count", F.lit(0).cast("bigint")).alias("value"),
            F.coalesce(
                F.concat(rounded, F.lit("% of builders")), F.lit("No builder data")
            ).alias("detail"),
            "tone",
        )
        .orderBy("card_no")
    )


def workload_kpis(workload: DataFrame) -> DataFrame:
    """One row: assignments in total, without reviewer, and number of named reviewers."""
    is_unassigned = F.col("reviewer") == schemas.UNASSIGNED
    zero = F.lit(0).cast("bigint")
    return workload.agg(
        F.coalesce(F.sum("unresolved_count"), zero).alias("unresolved_total"),
        F.coalesce(F.sum(F.when(is_unassigned, F.col("unresolved_count"))), zero).alias(
            "unassigned_count"
        ),
        F.count_if(~is_unassigned).alias("reviewer_count"),
    )


def facets(queue: DataFrame) -> DataFrame:
    """Filter choices of the queue, ``facet, choice``, with the row count of each."""
    choices = queue.select(
        F.explode(
            F.create_map(
                F.lit("status"), "status", F.lit("schedule_status"), "schedule_status"
            )
        ).alias("facet", "choice")
    )
    return (
        choices.groupBy("facet", "choice")
        .agg(F.count("*").alias("row_count"))
        .orderBy("facet", "choice")
    )


def queue_filter(
    queue: DataFrame,
    search: str | None = None,
    status: str | None = None,
    schedule: str | None = None,
) -> DataFrame:
    """Rows whose builder or reviewer contains the term and whose facets match."""
    term, wanted_status, wanted_schedule = map(normalise_term, (search, status, schedule))
    if term:
        searched = F.trim(F.lower(F.concat_ws(" ", "builder", "reviewer")))
        queue = queue.filter(F.contains(searched, F.lit(term)))
    if wanted_status:
        queue = queue.filter(F.lower(F.trim("status")) == wanted_status)
    if wanted_schedule:
        queue = queue.filter(F.lower(F.trim("schedule_status")) == wanted_schedule)
    return queue


def display_columns(queue: DataFrame) -> DataFrame:
    """The queue with its display forms."""
    return queue.withColumns(
        {
            "status_slug": slug(F.col("status")),
            "schedule_slug": slug(F.col("schedule_status")),
            "state_label": F.initcap(F.lower("issue_state")),
            "age_label": F.concat(F.col("submission_age_days").cast("string"), F.lit(" days")),
            "updated_label": F.concat(
                F.col("days_since_update").cast("string"), F.lit(" days ago")
            ),
        }
    )
