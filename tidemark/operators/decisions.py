"""Decision rules over one submission, as chained column expressions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark import schemas


def is_on_track(highest: Column, expected: Column) -> Column:
    """At most one milestone behind; unknown counts as not on track."""
    return F.coalesce(highest >= expected - 1, F.lit(False))


def milestones_behind(highest: Column, expected: Column) -> Column:
    return F.greatest(expected - highest, F.lit(0))


def is_unresolved(state: Column, status: Column) -> Column:
    """Open and not passed; a missing status is not passed."""
    return (F.upper(state) == "OPEN") & (
        status.isNull() | (status != schemas.STATUS_PASSED)
    )


@dataclass(frozen=True)
class Outcome:
    actor: str
    action: str
    priority: int


# What each situation asks for, in order of precedence.
VERIFY_STATUS = Outcome("Program admin", "Verify submission status", 0)
REOPEN = Outcome("Program admin", "Verify or reopen unresolved issue", 0)
ASSIGN = Outcome("Program admin", "Assign a reviewer", 1)
START_REVIEW = Outcome("Reviewer", "Start review", 1)
COMPLETE_REVIEW = Outcome("Reviewer", "Complete review", 1)
REVISE = Outcome("Builder", "Revise and resubmit", 1)
ADVANCE = Outcome("Builder", "Begin next milestone", 2)
DONE = Outcome("None", "Program complete", 3)


def next_step(
    status: Column, state: Column, reviewer_count: Column, number: Column, final: Column
) -> Column:
    """Struct ``actor, action, priority``: one table decides all three.

    The first matching row wins, so later rows may rely on the earlier ones.
    """
    has_reviewer = F.coalesce(reviewer_count, F.lit(0)) > 0
    table = [
        (status.isNull() | ~status.isin(*schemas.KNOWN_STATUSES), VERIFY_STATUS),
        ((F.upper(state) == "CLOSED") & (status != schemas.STATUS_PASSED), REOPEN),
        ((status == schemas.STATUS_UNCHECKED) & ~has_reviewer, ASSIGN),
        (status == schemas.STATUS_UNCHECKED, START_REVIEW),
        (status == schemas.STATUS_IN_REVIEW, COMPLETE_REVIEW),
        (status == schemas.STATUS_NEEDS_IMPROVEMENT, REVISE),
        (number < final, ADVANCE),
    ]

    def value(outcome: Outcome) -> Column:
        return F.struct(
            F.lit(outcome.actor).alias("actor"),
            F.lit(outcome.action).alias("action"),
            F.lit(outcome.priority).alias("priority"),
        )

    (condition, outcome), *rest = table
    decision = F.when(condition, value(outcome))
    for condition, outcome in rest:
        decision = decision.when(condition, value(outcome))
    return decision.otherwise(value(DONE))
