"""Dimension building and upsert over a silver batch of any number of runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.text import milestone_number
from tidemark.functions.timing import local_date
from tidemark.operators.keys import number_rows
from tidemark.schemas import (
    DATE_ROLES,
    DIM_DATE,
    DIM_ISSUE,
    DIM_MILESTONE,
    DIM_REVIEWER,
    DIM_STATE,
    DIM_STATUS,
    BoardRules,
    DimensionSpec,
)

#: When a member was first seen in the batch: orders new keys by extraction.
FIRST_SEEN = "first_seen"


def _extraction() -> Column:
    return F.struct("extracted_at", "run_id")


def _per_run(rows: DataFrame, *keys: str) -> DataFrame:
    """One row per run and key, ``extracted_at`` kept.

    A hash aggregate over plain columns: it shrinks the data before any shuffle, so a
    value in a third of all rows costs no more than a rare one. A minimum over a struct
    would sort every row first, and Catalyst drops a distinct below a minimum.
    """
    return rows.groupBy(*keys, "run_id").agg(F.min("extracted_at").alias("extracted_at"))


def seen_members(silver: DataFrame, zone: str) -> DataFrame:
    """``dimension, member, first_seen`` of all dimensions but issues, from one scan.

    Values of all these dimensions are unfolded and reduced together; members are text.
    """

    def member(spec: DimensionSpec, value: Column) -> Column:
        return F.struct(
            F.lit(spec.table.name).alias("dimension"), value.cast("string").alias("member")
        )

    single = [
        *(member(spec, F.col(spec.natural_key)) for spec in (DIM_STATE, DIM_STATUS, DIM_MILESTONE)),
        *(member(DIM_DATE, local_date(F.col(c), zone)) for c in DATE_ROLES),
    ]
    names = F.transform(F.col("reviewer"), lambda name: member(DIM_REVIEWER, name))
    values = F.concat(F.array(*single), F.coalesce(names, F.filter(F.array(*single), lambda _: F.lit(False))))
    rows = silver.select("extracted_at", "run_id", F.inline(values))
    per_run = _per_run(rows.filter(F.col("member").isNotNull()), "dimension", "member")
    return per_run.groupBy("dimension", "member").agg(F.min(_extraction()).alias(FIRST_SEEN))


def label_members(seen: DataFrame, spec: DimensionSpec) -> DataFrame:
    """Members of one dimension with their first extraction."""
    own = seen.filter(F.col("dimension") == spec.table.name)
    kind = spec.table.schema[spec.natural_key].dataType
    return own.select(F.col("member").cast(kind).alias(spec.natural_key), FIRST_SEEN)


def issue_members(silver: DataFrame) -> DataFrame:
    """Issues with the attributes of their latest extraction in the batch.

    An issue has at most one row per run, so there is little to combine before the
    shuffle; partitioning first saves the sort a map-side aggregate would need.
    """
    attributes = F.struct(*DIM_ISSUE.attributes)
    return (
        silver.filter(F.col("issue_id").isNotNull())
        .select("issue_id", *DIM_ISSUE.attributes, "extracted_at", "run_id")
        .repartition("issue_id")
        .groupBy("issue_id")
        .agg(
            F.max_by(attributes, _extraction()).alias("latest"),
            F.min(_extraction()).alias(FIRST_SEEN),
        )
        .select("issue_id", "latest.*", FIRST_SEEN)
    )


def reviewer_assignments(silver: DataFrame, *keys: str) -> DataFrame:
    """One row per assigned reviewer, repeated and missing names dropped."""
    names = F.array_distinct(F.filter("reviewer", lambda name: name.isNotNull()))
    return silver.select(*keys, F.explode(names).alias("reviewer"))


def configured_milestones(seen: DataFrame, rules: BoardRules) -> DataFrame:
    """``milestone, deadline_date`` as configured for the board."""
    return seen.sparkSession.createDataFrame(
        sorted(rules.deadlines.items()), "milestone string, deadline_date date"
    )


def milestone_members(seen: DataFrame, rules: BoardRules) -> DataFrame:
    """Configured and observed milestones with number and deadline.

    A configured milestone belongs to every extraction, hence to the first of the batch.
    """
    deadlines = configured_milestones(seen, rules)
    first_extraction = seen.agg(F.min(FIRST_SEEN).alias(FIRST_SEEN))
    configured = deadlines.select(
        "milestone", first_extraction.scalar().alias(FIRST_SEEN)
    )
    names = (
        label_members(seen, DIM_MILESTONE)
        .unionByName(configured)
        .groupBy("milestone")
        .agg(F.min(FIRST_SEEN).alias(FIRST_SEEN))
    )
    number = milestone_number(F.col("milestone"))
    # A name's own deadline first; otherwise it goes with the number, so "M02" shares the
    # deadline of "M2". Deadlines that contradict each other give an unknown name none.
    own = deadlines.withColumnRenamed("deadline_date", "own_deadline")
    by_number = deadlines.groupBy(number.alias("milestone_number")).agg(
        F.when(F.min("deadline_date") == F.max("deadline_date"), F.min("deadline_date")).alias(
            "number_deadline"
        )
    )
    deadline = F.coalesce("own_deadline", "number_deadline")
    return (
        names.withColumn("milestone_number", number)
        .join(F.broadcast(own), "milestone", "left")
        .join(F.broadcast(by_number), "milestone_number", "left")
        .select("milestone", "milestone_number", deadline.alias("deadline_date"), FIRST_SEEN)
    )


def date_members(seen: DataFrame) -> DataFrame:
    """Local dates of the three timestamps with their calendar attributes."""
    day = F.col("date")
    return label_members(seen, DIM_DATE).withColumns(
        {
            "year": F.year(day),
            "month": F.month(day),
            "month_name": F.date_format(day, "MMMM"),
            "day": F.dayofmonth(day),
            "day_name": F.date_format(day, "EEEE"),
        }
    )


def members(
    spec: DimensionSpec, silver: DataFrame, seen: DataFrame | None, rules: BoardRules
) -> DataFrame:
    """Members of any of the six dimensions: issues from the batch, others from those seen."""
    if spec is DIM_ISSUE:
        return issue_members(silver)
    if spec is DIM_MILESTONE:
        return milestone_members(seen, rules)
    if spec is DIM_DATE:
        return date_members(seen)
    if spec in (DIM_REVIEWER, DIM_STATE, DIM_STATUS):
        return label_members(seen, spec)
    raise ValueError(f"Unknown dimension: {spec.table.name}")


def member_order(spec: DimensionSpec) -> list[Column]:
    """Order in which new members get their keys; unique per member."""
    natural = [F.col(spec.natural_key)]
    if spec is DIM_MILESTONE:
        natural = [F.col("milestone_number").asc_nulls_last(), F.col("milestone")]
    return [F.col(FIRST_SEEN), *natural]


def merge_members(spec: DimensionSpec, existing: DataFrame, incoming: DataFrame) -> DataFrame:
    """Incoming members that are new (null key), or known with other updatable values.

    Known members keep their key and take the batch's value of the updatable columns,
    nulls included. Stored members that the batch leaves as they are don't appear.
    """
    key, natural = spec.surrogate_key, spec.natural_key
    old = existing.select(natural, key, F.struct(*spec.updates or [key]).alias("old"))
    other = F.lit(False)
    for column in spec.updates:
        other = other | ~F.col(column).eqNullSafe(F.col(f"old.{column}"))
    is_new = F.col(key).isNull()
    return (
        incoming.join(old, natural, "left")
        .filter(is_new | other)
        .select(key, natural, *spec.attributes, FIRST_SEEN, (~is_new).alias("is_update"))
    )


def upsert(
    spec: DimensionSpec, existing: DataFrame, incoming: DataFrame, path: str, start: int
) -> tuple[DataFrame, int]:
    """The rows that a batch adds to a dimension; new members get keys from ``start``.

    Also returns the number of keys given out. What is written is in proportion to the
    members that are new or changed, not to the dimension; only new ones are sorted.
    """
    columns = [*spec.table.columns, "is_update"]
    merged = merge_members(spec, existing, incoming)
    changed = []
    if spec.updates:
        # Kept, because it is read for the new and for the changed members.
        merged.write.parquet(f"{path}/merged")
        merged = existing.sparkSession.read.parquet(f"{path}/merged")
        changed.append(merged.filter("is_update").select(*columns))
        merged = merged.filter(~F.col("is_update"))
    fresh = merged.drop(spec.surrogate_key)
    rows, added = number_rows(
        fresh, spec.surrogate_key, member_order(spec), f"{path}/numbered", start
    )
    rows = rows.select(*columns)
    for more in changed:
        rows = rows.unionByName(more)
    return rows, added
