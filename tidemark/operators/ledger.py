"""The run ledger: which attempts exist, which runs still have to move on.

Everything here is a set operation over all runs at once. The ledger and the run lists
hold one row per attempt or run; pages and submissions are only ever filtered by them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.functions.text import redact
from tidemark.operators.joins import broadcast_within

ATTEMPT = ["run_id", "attempt_number"]


# --- Attempts ---------------------------------------------------------------------


def with_attempt_exists(incoming: DataFrame, attempts: DataFrame) -> DataFrame:
    """Mark incoming attempts that already have an outcome, failed ones included."""
    known = attempts.select(*ATTEMPT).distinct().withColumn("known", F.lit(True))
    return incoming.join(known, ATTEMPT, "left").select(
        *incoming.columns, F.coalesce("known", F.lit(False)).alias("attempt_exists")
    )


def new_attempts(incoming: DataFrame, attempts: DataFrame) -> DataFrame:
    """Incoming attempts without any recorded outcome.

    The pages of an attempt stay where they are: a shuffle would gather each run in one task.
    """
    return incoming.join(broadcast_within(attempts.select(*ATTEMPT)), ATTEMPT, "left_anti")


def success_rows(succeeded: DataFrame, started_at: Column, completed_at: Column) -> DataFrame:
    """Ledger rows for successful attempts, given one row per attempt."""
    return succeeded.select(
        *ATTEMPT,
        started_at.alias("started_at"),
        completed_at.alias("completed_at"),
        F.lit("succeeded").alias("attempt_status"),
        *(
            F.lit(None).cast("string").alias(c)
            for c in ("error_stage", "error_type", "error_message")
        ),
    )


def mismatched_attempts(extractions: DataFrame, attempts: DataFrame) -> DataFrame:
    """Extractions without a succeeded ledger row, and succeeded rows without extraction."""
    extracted = extractions.select(*ATTEMPT).distinct()
    succeeded = attempts.filter(F.col("attempt_status") == "succeeded").select(*ATTEMPT)
    return (
        extracted.join(succeeded, ATTEMPT, "left_anti")
        .withColumn("problem", F.lit("no succeeded attempt"))
        .unionByName(
            succeeded.join(extracted, ATTEMPT, "left_anti").withColumn(
                "problem", F.lit("no extraction")
            )
        )
    )


def failure_rows(
    failures: DataFrame, secrets: Sequence[str | None], max_length: int = schemas.MAX_ERROR_MESSAGE
) -> DataFrame:
    """Ledger rows of failed attempts with redacted, truncated messages.

    Missing diagnostics fail the job.
    """
    complete = (
        (F.coalesce("error_stage", F.lit("")) != "")
        & (F.coalesce("error_type", F.lit("")) != "")
        & F.col("error_message").isNotNull()
    )
    message = F.when(complete, redact(F.col("error_message"), secrets, max_length)).otherwise(
        F.raise_error(F.lit("A failed attempt requires failure diagnostics")).cast("string")
    )
    return failures.withColumns(
        {"attempt_status": F.lit("failed"), "error_message": message}
    ).select(*schemas.PIPELINE_ATTEMPTS.columns)


def appendable_failures(failures: DataFrame, attempts: DataFrame) -> DataFrame:
    """Failure rows not in the ledger yet; of several for an attempt, the first to complete.

    Ties go to the earlier start, then by stage, type and message; nulls come last.
    """
    rows = new_attempts(failures, attempts)
    order = []
    for column in ("completed_at", "started_at", "error_stage", "error_type", "error_message"):
        order += [F.col(column).isNull().alias(f"no_{column}"), F.col(column)]
    others = [c for c in rows.columns if c not in ATTEMPT]
    first = F.min_by(F.struct(*others), F.struct(*order))
    return rows.groupBy(*ATTEMPT).agg(first.alias("row")).select(
        *(c if c in ATTEMPT else F.col(f"row.{c}").alias(c) for c in rows.columns)
    )


# --- Selection --------------------------------------------------------------------


def restrict_to_runs(rows: DataFrame, runs: DataFrame) -> DataFrame:
    """Rows of the given runs. The run list is a ledger's; it prunes the partition folders."""
    return rows.join(broadcast_within(runs.select("run_id").distinct()), "run_id", "left_semi")


def canonical_attempts(stored: DataFrame, attempts: DataFrame) -> DataFrame:
    """Latest succeeded attempt of each run among the stored ones.

    ``stored`` is any frame naming stored attempts: the pages, or the ledger itself,
    which a warehouse publishes together with the pages.
    """
    keys = stored.select(*ATTEMPT).distinct()
    succeeded = attempts.filter(F.col("attempt_status") == "succeeded").select(*ATTEMPT)
    return (
        keys.join(succeeded, ATTEMPT, "left_semi")
        .groupBy("run_id")
        .agg(F.max("attempt_number").alias("attempt_number"))
    )


def pending_attempts(stored: DataFrame, attempts: DataFrame, silver: DataFrame) -> DataFrame:
    """Canonical attempts of the runs that have no silver rows (or silver ledger row)."""
    loaded = silver.select("run_id").distinct()
    return canonical_attempts(stored, attempts).join(loaded, "run_id", "left_anti")


def extractions_of(extractions: DataFrame, attempts: DataFrame) -> DataFrame:
    """All pages of the given attempts, at most one attempt per run."""
    return restrict_to_runs(extractions, attempts).join(
        broadcast_within(attempts), ATTEMPT, "left_semi"
    )


def extraction_lookup(extractions: DataFrame, run_id: str, attempt_number: int) -> DataFrame:
    """Pages of one attempt; the run is a partition folder of the stored table."""
    return extractions.filter(
        (F.col("run_id") == run_id) & (F.col("attempt_number") == attempt_number)
    )


def pending_runs(silver: DataFrame, gold_loads: DataFrame) -> DataFrame:
    """``run_id, extracted_at`` of the silver runs (or silver ledger) not loaded to gold."""
    return (
        silver.select("run_id", "extracted_at")
        .distinct()
        .join(gold_loads.select("run_id"), "run_id", "left_anti")
    )


def pending_silver(silver: DataFrame, runs: DataFrame) -> DataFrame:
    """Silver rows of the given runs, in the declared silver columns."""
    return restrict_to_runs(silver, runs).select(*schemas.SILVER.columns)


# --- Guards -----------------------------------------------------------------------


def extraction_times(rows: DataFrame) -> DataFrame:
    """Per run: number of distinct extraction times, a missing one counting as one."""
    return rows.groupBy("run_id").agg(
        (
            F.count_distinct("extracted_at")
            + F.max(F.col("extracted_at").isNull().cast("int"))
        ).alias("extraction_times")
    )


def mixed_extraction_runs(rows: DataFrame) -> DataFrame:
    """Runs whose rows do not share one single extraction time."""
    return extraction_times(rows).filter(F.col("extraction_times") != 1)


def gold_guards(rows: DataFrame, gold_loads: DataFrame) -> DataFrame:
    """Per run of a batch: why it may not be loaded to gold (null when it may)."""
    loaded = gold_loads.select("run_id").distinct().withColumn("loaded", F.lit(True))
    problem = (
        F.when(F.col("run_id").isNull(), "run_id missing")
        .when(F.col("extraction_times") != 1, "more than one extraction timestamp")
        .when(F.col("loaded"), "already loaded")
    )
    return (
        extraction_times(rows)
        .join(loaded, "run_id", "left")
        .select("run_id", "extraction_times", problem.alias("problem"))
    )


def runs_sharing_a_time(runs: DataFrame, loaded: DataFrame) -> DataFrame:
    """Runs, pending or loaded, whose extraction time a pending run shares with another.

    Only they can hold two snapshots of one submission at one time, since the rows of a
    run are unique per submission; usually there are none.
    """
    every = runs.select("run_id", "extracted_at", F.lit(True).alias("is_pending")).unionByName(
        loaded.select("run_id", "extracted_at", F.lit(False).alias("is_pending"))
    )
    shared = (
        every.groupBy("extracted_at")
        .agg(F.count("*").alias("n"), F.bool_or("is_pending").alias("concerns_pending"))
        .filter((F.col("n") > 1) & F.col("concerns_pending"))
    )
    return every.join(shared, "extracted_at", "left_semi").select("run_id", "extracted_at")


def load_rows(runs: DataFrame, load_id: str, *more: str | Column) -> DataFrame:
    """Silver or gold ledger rows for runs just loaded."""
    now = F.current_timestamp().alias("loaded_at")
    return runs.select("run_id", "extracted_at", now, F.lit(load_id).alias("load_id"), *more)
