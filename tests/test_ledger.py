from __future__ import annotations

import re
from datetime import timedelta

import pytest
from boards import bronze, node, page, silver, silver_row, utc
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.functions.text import redact
from tidemark.operators import ledger, quality
from tidemark.plans.jobs import Pipeline

NOW = utc("2026-08-05T00:00:00")


def failures(spark, *rows):
    return spark.createDataFrame(
        [(run, attempt, NOW, NOW, stage, kind, message) for run, attempt, stage, kind, message in rows],
        "run_id string, attempt_number int, started_at timestamp, completed_at timestamp, "
        "error_stage string, error_type string, error_message string",
    )


def prunes_runs(frame):
    plan = frame._jdf.queryExecution().executedPlan().toString()
    return re.search(r"PartitionFilters: \[[^\]]*run_id", plan) is not None


def ids(frame):
    return sorted((r["run_id"], r["attempt_number"]) for r in frame.collect())


def test_pending_runs_after_retries_failures_and_loads(spark, warehouse):
    pipeline = Pipeline(warehouse)
    for run, attempt in (("already-loaded", 1), ("retried", 1), ("retried", 2), ("pending", 1)):
        pipeline.store_extractions(bronze(spark, page(node("a")), run_id=run, attempt=attempt))
    pipeline.record_failures(failures(spark, ("failed", 1, "extraction", "Timeout", "slow")))
    pipeline.load_silver(silver(spark, silver_row(run_id="already-loaded")))

    pages = warehouse.read("bronze.raw_issue_extractions")
    attempts = warehouse.read("ops.pipeline_attempts")
    rows = warehouse.read("silver.issue_submissions")
    assert ids(ledger.canonical_attempts(pages, attempts)) == [
        ("already-loaded", 1),
        ("pending", 1),
        ("retried", 2),
    ]
    pending = ledger.pending_attempts(pages, attempts, rows)
    assert ids(pending) == [("pending", 1), ("retried", 2)]
    assert ids(ledger.extractions_of(pages, pending)) == [("pending", 1), ("retried", 2)]
    # The ledgers alone give the same answer without reading pages or silver.
    loads = warehouse.read("ops.silver_loads")
    assert ids(ledger.pending_attempts(attempts, attempts, loads)) == ids(pending)

    assert pipeline.catch_up_silver()
    assert sorted(r["run_id"] for r in warehouse.read("ops.silver_loads").collect()) == [
        "already-loaded",
        "pending",
        "retried",
    ]
    assert not pipeline.catch_up_silver()


def test_rows_are_restricted_to_runs(spark):
    rows = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], "run_id string, n int")
    wanted = spark.createDataFrame([("a",), ("c",)], "run_id string")
    assert {r["n"] for r in ledger.restrict_to_runs(rows, wanted).collect()} == {1, 3}


def test_pending_runs_are_pruned_when_planned(spark, warehouse):
    pipeline = Pipeline(warehouse)
    for n in (1, 2):
        pipeline.load_silver(silver(spark, silver_row(run_id=f"run-{n}")))
    rows = warehouse.read("silver.issue_submissions")
    loads = spark.createDataFrame([("run-1",)], "run_id string")
    pending = ledger.pending_silver(rows, ledger.pending_runs(rows, loads))
    assert prunes_runs(pending)
    assert [r["run_id"] for r in pending.collect()] == ["run-2"]


def test_any_outcome_blocks_its_attempt(spark, warehouse):
    pipeline = Pipeline(warehouse)
    pipeline.record_failures(failures(spark, ("r", 1, "extraction", "Timeout", "slow")))
    attempts = warehouse.read("ops.pipeline_attempts")
    incoming = spark.createDataFrame([("r", 1), ("r", 2)], "run_id string, attempt_number int")
    marked = {r["attempt_number"]: r["attempt_exists"] for r in ledger.with_attempt_exists(incoming, attempts).collect()}
    assert marked == {1: True, 2: False}
    assert ids(ledger.new_attempts(incoming, attempts)) == [("r", 2)]


def test_a_recorded_outcome_is_never_replaced(spark, warehouse):
    pipeline = Pipeline(warehouse)
    pipeline.store_extractions(bronze(spark, page(node("a")), run_id="r"))
    late = failures(spark, ("r", 1, "bronze_load", "IOError", "late"), ("s", 1, "extraction", "E", "m"), ("s", 1, "extraction", "E", "m"))
    pipeline.record_failures(late)
    rows = {r["run_id"]: r for r in warehouse.read("ops.pipeline_attempts").collect()}
    assert {k: r["attempt_status"] for k, r in rows.items()} == {"r": "succeeded", "s": "failed"}
    pipeline.store_extractions(bronze(spark, page(node("b")), run_id="r"))
    assert warehouse.read("bronze.raw_issue_extractions").count() == 1
    pages = warehouse.read("bronze.raw_issue_extractions")
    assert ledger.mismatched_attempts(pages, warehouse.read("ops.pipeline_attempts")).isEmpty()


@pytest.mark.parametrize("gap", [("", "E", "m"), ("extraction", None, "m"), ("extraction", "E", None)])
def test_failures_need_diagnostics(spark, gap):
    with pytest.raises(Exception, match="requires failure diagnostics"):
        ledger.failure_rows(failures(spark, ("r", 1, *gap)), []).collect()


def test_secrets_go_before_the_message_is_cut(spark):
    frame = spark.createDataFrame([("token abc123 and abc123",)], "m string")
    hidden = frame.select(redact(F.col("m"), ["abc123", None, ""], 14).alias("m")).first()["m"]
    assert hidden == "token [REDACTE"


def test_failed_and_succeeded_rows_pass_the_declared_checks(spark, warehouse):
    pipeline = Pipeline(warehouse)
    pipeline.store_extractions(bronze(spark, page(node("a"))))
    pipeline.record_failures(failures(spark, ("f", 1, "extraction", "E", "m")))
    checks = dict(schemas.PIPELINE_ATTEMPTS.checks)
    attempts = warehouse.read("ops.pipeline_attempts")
    assert quality.check_failures(attempts, checks).isEmpty()
    broken = attempts.withColumn("error_stage", F.lit("teleport"))
    assert {r["failed_check"] for r in quality.check_failures(broken, checks).collect()} == {
        "stage_domain",
        "diagnostics",
    }


def test_guards_per_run(spark):
    later = NOW + timedelta(days=1)
    rows = spark.createDataFrame(
        [("ok", NOW), ("ok", NOW), ("mixed", NOW), ("mixed", later), ("gap", NOW), ("gap", None), ("done", NOW)],
        "run_id string, extracted_at timestamp",
    )
    assert {r["run_id"] for r in ledger.mixed_extraction_runs(rows).collect()} == {"mixed", "gap"}
    loads = spark.createDataFrame([("done",)], "run_id string")
    problems = {r["run_id"]: r["problem"] for r in ledger.gold_guards(rows, loads).collect()}
    assert problems == {
        "ok": None,
        "mixed": "more than one extraction timestamp",
        "gap": "more than one extraction timestamp",
        "done": "already loaded",
    }


def test_lookup_reads_one_run_folder(spark, warehouse):
    pipeline = Pipeline(warehouse)
    for run in ("r1", "r2"):
        pipeline.store_extractions(bronze(spark, page(node("a")), run_id=run))
    found = ledger.extraction_lookup(warehouse.read("bronze.raw_issue_extractions"), "r2", 1)
    assert [r["run_id"] for r in found.collect()] == ["r2"]
    assert prunes_runs(found)


def test_first_failure_of_an_attempt_is_kept_whatever_the_order(spark):
    schema = (
        "run_id string, attempt_number int, started_at timestamp, completed_at timestamp, "
        "error_stage string, error_type string, error_message string"
    )
    rows = [
        ("r", 1, utc("2026-08-01T00:00:00"), utc("2026-08-01T02:00:00"), "extraction", "E", "late"),
        ("r", 1, utc("2026-08-01T00:00:00"), utc("2026-08-01T01:00:00"), "extraction", "E", "soon"),
        ("r", 1, utc("2026-08-01T00:00:00"), None, "bronze_load", "E", "never"),
    ]
    attempts = spark.createDataFrame([], "run_id string, attempt_number int")
    for order in (rows, rows[::-1]):
        kept = ledger.appendable_failures(spark.createDataFrame(order, schema), attempts).collect()
        assert [r["error_message"] for r in kept] == ["soon"]
