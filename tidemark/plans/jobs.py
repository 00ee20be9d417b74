"""End-to-end jobs over a warehouse: intake, silver, gold and metric datasets."""

from __future__ import annotations

import logging
import uuid
from collections.abc import Callable, Iterator, Mapping
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from datetime import datetime, timezone

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.functions.text import redact
from tidemark.operators import dimensions, facts, ledger, quality
from tidemark.operators.joins import broadcast_within
from tidemark.operators.silver import run_verdicts, standardise_times, to_silver
from tidemark.operators.snapshots import Mart
from tidemark.plans.metrics import metric_frames
from tidemark.schemas import BoardRules
from tidemark.session import prepare_mart, scratch_path
from tidemark.sources import folders, landing
from tidemark.sources.warehouse import Warehouse

logger = logging.getLogger(__name__)

#: Up to so many runs, a file of each from every task costs less than a shuffle of all rows by run.
FEW_RUNS = 4


class StageError(RuntimeError):
    """A pipeline stage failed; ``stage`` is one of the seven stage names."""

    def __init__(self, stage: str, cause: Exception):
        super().__init__(f"{stage}: {cause}")
        self.stage = stage


class Pipeline:
    """The medallion jobs. Each call ends with a ledger row, or leaves everything as it was."""

    def __init__(
        self,
        warehouse: Warehouse,
        rules: BoardRules = BoardRules(),
        secrets: tuple[str | None, ...] = (),
    ):
        self.warehouse = warehouse
        self.spark = prepare_mart(warehouse.spark)
        self.rules = rules
        self.secrets = secrets

    def _together(self, *tasks: Callable[[], object]) -> list:
        """Results of independent Spark jobs run at the same time; the first error is raised."""
        inherit = inheritable_thread_target(self.spark)
        with ThreadPoolExecutor(max_workers=len(tasks)) as pool:
            return [job.result() for job in [pool.submit(inherit(task)) for task in tasks]]

    # --- Stages ------------------------------------------------------------------

    @contextmanager
    def _stage(self, stage: str, runs: DataFrame | None = None) -> Iterator[None]:
        """Name the failing stage, log it for each of ``runs``, and re-raise."""
        try:
            yield
        except StageError:
            raise
        except Exception as error:
            row = (datetime.now(timezone.utc), stage, type(error).__name__, str(error))
            names = schemas.STAGE_FAILURES.schema.names[1:]
            try:
                of = self.spark.createDataFrame([(None,)], "run_id string") if runs is None else runs
                self._record_stage_failures(
                    of.select("run_id").distinct().select(
                        "run_id", *(F.lit(v).alias(c) for c, v in zip(names, row, strict=True))
                    )
                )
            except Exception:
                logger.exception("Could not store the failure of stage %s", stage)
            raise StageError(stage, error) from error

    def _record_stage_failures(self, failures: DataFrame) -> None:
        message = redact(F.col("error_message"), self.secrets, schemas.MAX_ERROR_MESSAGE)
        self.warehouse.write(
            schemas.STAGE_FAILURES.name, failures.withColumn("error_message", message)
        )

    def _without_failed(self, runs: DataFrame, failed: DataFrame) -> DataFrame:
        """The other runs. ``failed`` (``run_id, error_stage, problem``) goes to the log.

        If no other run is left, the first problem is raised; failed runs stay pending.
        """
        first = failed.orderBy("run_id").limit(1).collect()
        if not first:
            return runs
        self._record_stage_failures(
            failed.select(
                "run_id",
                F.current_timestamp().alias("failed_at"),
                "error_stage",
                F.lit("ValueError").alias("error_type"),
                F.col("problem").alias("error_message"),
            )
        )
        others = runs.join(failed.select("run_id"), "run_id", "left_anti")
        stage, cause = first[0]["error_stage"], ValueError(f"{first[0]['problem']} ({first[0]['run_id']})")
        if others.isEmpty():
            raise StageError(stage, cause)
        logger.warning("Runs were set aside; the first: %s: %s", stage, cause)
        return others

    def _require_none(self, violations: DataFrame, complaint: str) -> None:
        example = violations.limit(1).collect()
        if example:
            raise ValueError(f"{complaint}: {example[0].asDict(recursive=True)}")

    # --- Bronze --------------------------------------------------------------------

    def ingest(self, landed: DataFrame, owner_type: str = "organization") -> None:
        """Validate landed pages and store each attempt as succeeded or failed.

        ``landed``: ``run_id, attempt_number, extracted_at, page_no, request_cursor,
        body``. Attempts with any recorded outcome are skipped. One bad page fails its
        attempt, with the reason of the first bad page; its pages are not stored.
        """
        now = F.current_timestamp()
        attempts = self.warehouse.read(schemas.PIPELINE_ATTEMPTS.name)
        with self._stage("extraction"):
            fresh = ledger.new_attempts(landed, attempts)
            # Each body is parsed once; what is kept of it is a few short columns.
            checked = self._keep(landing.page_checks(fresh, owner_type).drop("body"))
            verdicts = self._keep(self._attempt_verdicts(checked))
        with self._stage("bronze_transform", verdicts):
            good = verdicts.filter(F.col("problem").isNull())
            failures = verdicts.filter(F.col("problem").isNotNull()).select(
                *ledger.ATTEMPT,
                F.col("extracted_at").alias("started_at"),
                now.alias("completed_at"),
                F.lit("extraction").alias("error_stage"),
                F.lit("ExtractionError").alias("error_type"),
                F.col("problem").alias("error_message"),
            )
            # One row per attempt; see new_attempts.
            chosen = broadcast_within(good.select(*ledger.ATTEMPT))
            accepted = fresh.join(chosen, ledger.ATTEMPT, "left_semi")
            pages = landing.to_bronze(accepted)
            outcomes = ledger.success_rows(good, F.col("extracted_at"), now).unionByName(
                ledger.failure_rows(failures, self.secrets)
            )
        with self._stage("bronze_load", verdicts):
            self.warehouse.write(schemas.RAW_EXTRACTIONS.name, pages)
            self.warehouse.write(schemas.PIPELINE_ATTEMPTS.name, outcomes)

    def _keep(self, frame: DataFrame) -> DataFrame:
        """Write an intermediate result to the shared scratch folder and read it back."""
        path = scratch_path(self.spark, "kept")
        frame.write.parquet(path)
        return self.spark.read.parquet(path)

    def _attempt_verdicts(self, checked: DataFrame) -> DataFrame:
        """Per attempt: the problem of its first bad page, or null.

        A page number that comes twice is reported first: the chain is not defined then.
        """
        chained = landing.cursor_chain(checked, ledger.ATTEMPT)
        problem = F.coalesce("reject_reason", "chain_problem")
        per_attempt = chained.groupBy(*ledger.ATTEMPT).agg(
            F.min("extracted_at").alias("extracted_at"),
            F.min_by(problem, F.when(problem.isNotNull(), F.col("page_no"))).alias("first_problem"),
            F.max_by("has_next", "page_no").alias("goes_on"),
            (F.count("page_no") > F.count_distinct("page_no")).alias("repeats"),
        )
        repeated = F.when(F.col("repeats"), "duplicate page")
        unfinished = F.when(F.col("goes_on"), "last page is missing")
        return per_attempt.select(
            *ledger.ATTEMPT,
            "extracted_at",
            F.coalesce(repeated, "first_problem", unfinished).alias("problem"),
        )

    def store_extractions(self, bronze: DataFrame, started_at: datetime | None = None) -> None:
        """Store bronze pages as succeeded attempts, e.g. from payload documents.

        Attempts that already have an outcome are skipped. A page number that comes twice
        in an attempt fails the job.
        """
        now = F.current_timestamp()
        begun = F.lit(started_at) if started_at else now
        name = schemas.RAW_EXTRACTIONS.name
        attempts = self.warehouse.read(schemas.PIPELINE_ATTEMPTS.name)
        with self._stage("bronze_load"):
            fresh = ledger.new_attempts(bronze, attempts)
            pages = self._keep(fresh.select(*schemas.RAW_EXTRACTIONS.unique[0]))
            self._require_none(
                quality.duplicate_keys(pages, pages.columns), f"{name} has a duplicate page"
            )
            self.warehouse.write(name, fresh)
            stored = pages.select(*ledger.ATTEMPT).distinct()
            self.warehouse.write(
                schemas.PIPELINE_ATTEMPTS.name, ledger.success_rows(stored, begun, now)
            )

    def record_failures(self, failures: DataFrame) -> None:
        """Store failed attempts; an attempt that has an outcome keeps it."""
        attempts = self.warehouse.read(schemas.PIPELINE_ATTEMPTS.name)
        rows = ledger.appendable_failures(
            ledger.failure_rows(failures, self.secrets), attempts
        )
        self.warehouse.write(schemas.PIPELINE_ATTEMPTS.name, rows)

    # --- Silver ----------------------------------------------------------------------

    def catch_up_silver(self) -> bool:
        """Turn the pages of all pending runs into silver. False if none is pending.

        All runs are decoded and written in one pass. Runs at fault go to
        ``ops.stage_failures`` and stay out of the ledger, so their rows do not count; the
        others are loaded. A run that yields no rows is recorded with none.
        """
        stored = self.warehouse.read_all(
            schemas.PIPELINE_ATTEMPTS.name, schemas.SILVER_LOADS.name
        )
        attempts, loads = stored.values()
        pending = ledger.pending_attempts(attempts, attempts, loads)
        if pending.isEmpty():
            logger.info("No pending runs to load into silver")
            return False
        pending = self._keep(pending)
        pages = self.warehouse.stored(schemas.RAW_EXTRACTIONS.name)
        chosen = ledger.extractions_of(pages, pending)
        unreadable, load_id = Observation(), self.warehouse.new_load()
        with self._stage("silver_transform", pending):
            rows = to_silver(chosen, self.rules, unreadable)
            several = pending.limit(FEW_RUNS + 1).count() > FEW_RUNS
            self.warehouse.write(schemas.SILVER.name, rows, load_id, several)
            failed = [
                (run, "silver_transform", "malformed pages") for run in unreadable.get.get("runs") or []
            ]
        with self._stage("silver_load", pending):
            kind = "run_id string, error_stage string, problem string"
            failed = self.spark.createDataFrame(failed, kind)
            verdicts = self._silver_verdicts(load_id, failed)
            unfit = verdicts.filter(F.col("problem").isNotNull()).select(
                "run_id", F.lit("silver_load").alias("error_stage"), "problem"
            )
            good = self._without_failed(pending, self._keep(failed.unionByName(unfit)))
            times = chosen.groupBy("run_id").agg(F.min("extracted_at").alias("extracted_at"))
            counted = good.join(verdicts.select("run_id", "row_count"), "run_id", "left")
            counted = counted.select("run_id", F.coalesce("row_count", F.lit(0)).alias("row_count"))
            self._record_silver(counted.join(times, "run_id"), load_id)
        return True

    def _silver_verdicts(self, load_id: str, failed: DataFrame | None = None) -> DataFrame:
        """Verdicts of the runs that a load has written, without those that failed before."""
        rows = self.warehouse.written(schemas.SILVER.name, load_id)
        if failed is not None:
            # At most one row per pending run; a shuffle would gather each run in one task.
            rows = rows.join(F.broadcast(failed.select("run_id")), "run_id", "left_anti")
        return self._keep(run_verdicts(rows))

    def _record_silver(self, runs: DataFrame, load_id: str) -> None:
        rows = ledger.load_rows(runs, load_id, "row_count")
        self.warehouse.write(schemas.SILVER_LOADS.name, rows)

    def load_silver(self, rows: DataFrame, several_runs: bool = True) -> None:
        """Add silver rows that pass the column, null and key checks, or none of them.

        Rows of a single run go into one folder as they are; those of several runs are
        gathered per run first, or every task would write a file to every folder.
        """
        spec, load_id = schemas.SILVER, self.warehouse.new_load()
        with self._stage("silver_load"):
            self.warehouse.write(spec.name, rows, load_id, several_runs)
            verdicts = self._silver_verdicts(load_id)
            for row in verdicts.filter(F.col("problem").isNotNull()).orderBy("run_id").limit(1).collect():
                raise ValueError(f"{row['problem']} ({row['run_id']})")
            known = self.warehouse.read(schemas.SILVER_LOADS.name)
            self._require_none(
                verdicts.join(known, "run_id", "left_semi"), f"{spec.name} already has the run"
            )
            self._record_silver(verdicts, load_id)

    # --- Gold ------------------------------------------------------------------------

    def catch_up_gold(self) -> bool:
        """Load all pending silver runs as one batch. False if none is pending.

        The batch equals loading run after run in extraction order: the latest
        extraction of an issue supplies its attributes, and keys are given out in the
        order in which runs, then members, appear. Runs that break a guard go to
        ``ops.stage_failures``, and the others are loaded; of runs that hold the same
        submission at the same time, none is.
        """
        stored = self.warehouse.read_all(
            schemas.SILVER.name, schemas.SILVER_LOADS.name, schemas.GOLD_LOADS.name
        )
        silver, silver_loads, gold_loads = stored.values()
        runs = ledger.pending_runs(silver_loads.filter("row_count > 0"), gold_loads)
        if runs.isEmpty():
            logger.info("No pending runs to load into gold")
            return False
        with self._stage("gold_transform"):
            failed = self._gold_problems(silver, runs, gold_loads)
        runs = self._without_failed(runs, failed)
        pending = standardise_times(ledger.pending_silver(silver, runs))
        load_id = self.warehouse.new_load()
        next_keys = self.write_gold(pending, load_id, runs)
        with self._stage("gold_load", runs):
            keys = F.create_map(*(F.lit(x) for pair in next_keys.items() for x in pair))
            # Last: from now on the rows of this load count.
            self.warehouse.write(
                schemas.GOLD_LOADS.name, ledger.load_rows(runs, load_id, keys.alias("next_keys"))
            )
        return True

    def _gold_problems(
        self, silver: DataFrame, runs: DataFrame, gold_loads: DataFrame
    ) -> DataFrame:
        """``run_id, error_stage, problem`` of the pending runs that break a guard.

        Rows are read only of runs that share their extraction time, usually none.
        """

        def problems(found: DataFrame, text: str) -> DataFrame:
            return found.select(
                "run_id", F.lit("gold_transform").alias("error_stage"), F.lit(text).alias("problem")
            )

        # Checked on the run list: a run has one ledger row per extraction time.
        mixed = problems(
            quality.duplicate_keys(runs, ["run_id"]),
            "Silver run contains multiple extraction timestamps",
        )
        shared = ledger.runs_sharing_a_time(runs, gold_loads)
        if shared.isEmpty():
            return mixed
        rows = ledger.restrict_to_runs(silver, shared)
        repeated = facts.grain_violations(rows).select("issue_id", "extracted_at")
        clashing = rows.join(repeated, ["issue_id", "extracted_at"], "left_semi")
        clashing = clashing.select("run_id").distinct().join(runs, "run_id", "left_semi")
        clashing = problems(
            clashing.join(mixed, "run_id", "left_anti"),
            "Gold submission snapshots must be unique by issue_id and extracted_at",
        )
        return mixed.unionByName(clashing)

    def write_gold(
        self, pending: DataFrame, load_id: str, runs: DataFrame | None = None
    ) -> dict[str, int]:
        """Write all gold rows of a load. They count once its ledger row is there."""
        path = scratch_path(self.spark, "fact")
        with self._stage("gold_transform", runs):
            numbered, next_keys = self._build_gold(pending, load_id, path)
        with self._stage("gold_load", runs):
            self._load_gold(numbered, load_id)
        folders.remove(self.spark, path)
        return next_keys

    def _build_gold(
        self, pending: DataFrame, load_id: str, path: str
    ) -> tuple[DataFrame, dict[str, int]]:
        """Number the snapshots and add to the dimensions; also the next keys of all tables."""
        next_keys, fact = self.warehouse.next_keys(), schemas.FACT.name
        given: dict[str, int] = {}

        def upsert(spec: schemas.DimensionSpec, seen: DataFrame | None) -> None:
            members = dimensions.members(spec, pending, seen, self.rules)
            start = next_keys.get(spec.table.name, 1)
            given[spec.table.name] = add_members(self.warehouse, spec, members, load_id, start)

        def upsert_small() -> None:
            seen = self._keep(dimensions.seen_members(pending, self.rules.zone))
            small = [s for s in schemas.DIMENSIONS.values() if s is not schemas.DIM_ISSUE]
            self._together(*(lambda spec=spec: upsert(spec, seen) for spec in small))

        def number() -> DataFrame:
            start = next_keys.get(fact, 1)
            numbered, count = facts.number_snapshots(pending, path, start)
            given[fact] = start + count
            return numbered

        numbered, *_ = self._together(
            number, lambda: upsert(schemas.DIM_ISSUE, None), upsert_small
        )
        return numbered, {**next_keys, **given}

    def _load_gold(self, numbered: DataFrame, load_id: str) -> None:
        """Write fact and bridge; a row whose key is not found fails the load."""
        current = {
            name: self.warehouse.read(spec.table.name, load_id)
            for name, spec in schemas.DIMENSIONS.items()
        }

        def write(name: str, rows: DataFrame, is_bad: Column, choose, complaint: str) -> None:
            lost = Observation()
            watched = rows.observe(lost, F.count_if(is_bad).alias("n"))
            self.warehouse.write(name, choose(watched), load_id)
            if lost.get.get("n"):
                raise ValueError(f"{complaint} ({lost.get['n']} rows)")

        resolved = facts.resolve_keys(numbered, current, self.rules.zone)
        assigned = facts.bridge_rows(numbered, current["dim_reviewer"])
        self._together(
            lambda: write(
                schemas.FACT.name,
                resolved,
                facts.unresolved(),
                facts.fact_rows,
                "Gold batch contains an unresolved dimension key",
            ),
            lambda: write(
                schemas.BRIDGE.name,
                assigned,
                F.col("reviewer_key").isNull(),
                lambda rows: rows,
                "Gold batch contains an unresolved reviewer key",
            ),
        )

    # --- Whole run and metrics -----------------------------------------------------------

    def run(
        self,
        landed: DataFrame,
        owner_type: str = "organization",
        taken_in: Callable[[], object] | None = None,
    ) -> Mart:
        """Landed pages to an up-to-date mart.

        ``taken_in`` is called once bronze holds the pages: they are not read again.
        """
        self.ingest(landed, owner_type)
        if taken_in is not None:
            taken_in()
        self.catch_up_silver()
        self.catch_up_gold()
        return Mart.open(self.warehouse, self.rules.zone)

    def build_datasets(self, folder: str) -> None:
        """Write the five metric datasets of the current mart below ``folder``."""
        write_datasets(metric_frames(Mart.open(self.warehouse, self.rules.zone)), folder)


def add_members(
    warehouse: Warehouse,
    spec: schemas.DimensionSpec,
    members: DataFrame,
    load_id: str,
    start: int,
) -> int:
    """Add a batch of members to a dimension as part of a load; the next unused key."""
    name = spec.table.name
    path = scratch_path(warehouse.spark, name)
    added, count = dimensions.upsert(spec, warehouse.read(name), members, path, start)
    warehouse.write(name, added, load_id)
    folders.remove(warehouse.spark, path)
    return start + count


def write_datasets(frames: Mapping[str, DataFrame], folder: str) -> None:
    """Write the five metric datasets, from the mart or from CSV.

    Each is computed once: it is validated while it is written to a hidden folder. The folders get their names after all of them have proved valid.
    """
    quality.require_all(frames)
    pending = f"{folder.rstrip('/')}/_pending-{uuid.uuid4().hex}"
    for name in schemas.DATASET_SCHEMAS:
        quality.write_validated(frames[name], name, f"{pending}/{name}")
    for name, frame in frames.items():
        if name in schemas.DATASET_SCHEMAS:
            folders.move(frame.sparkSession, f"{pending}/{name}", f"{folder.rstrip('/')}/{name}")
