from __future__ import annotations

from datetime import date
from pathlib import Path

import pytest
from boards import second_run, silver, silver_row, utc
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.operators import dimensions, facts, keys, ledger, quality
from tidemark.operators.snapshots import Mart
from tidemark.plans.jobs import Pipeline, StageError, add_members
from tidemark.sources.warehouse import Warehouse


def load(warehouse, spark, *rows):
    pipeline = Pipeline(warehouse)
    pipeline.load_silver(silver(spark, *rows))
    return pipeline.catch_up_gold()


def natural_keys(frame, spec):
    return {r[spec.natural_key]: r[spec.surrogate_key] for r in frame.collect()}


@pytest.fixture(scope="module")
def loaded(spark, tmp_path_factory):
    """One run with gaps: no reviewer, no status, no author, unknown milestones."""
    warehouse = Warehouse(spark, str(tmp_path_factory.mktemp("loaded")))
    load(
        warehouse,
        spark,
        silver_row(created_at=utc("2026-07-31T16:30:00")),
        silver_row("issue-2", reviewer=[], status=None, issue_author=None),
        silver_row("issue-7", milestone="M7", reviewer=[]),
        silver_row("issue-x", milestone="Mx", reviewer=[]),
    )
    return warehouse


def test_one_run_becomes_a_star(loaded):
    mart = Mart.open(loaded)
    fact = {r["submission_snapshot_key"]: r for r in mart.fact.collect()}
    assert set(fact) == {1, 2, 3, 4}
    assert mart.fact.columns == schemas.FACT.columns
    assert fact[2]["status_key"] is None and fact[1]["status_key"] == 1
    # Repeated reviewers only count once, and only the bridge is fanned out.
    assert mart.bridge.count() == 2
    assert natural_keys(mart.dim_reviewer, schemas.DIM_REVIEWER) == {"alice": 1, "bob": 2}
    authors = {r["issue_id"]: r["issue_author"] for r in mart.dim_issue.collect()}
    assert authors["issue-1"] == "builder" and authors["issue-2"] is None


@pytest.mark.parametrize("name", schemas.TABLES)
def test_stored_tables_keep_their_constraints(loaded, name):
    spec, rows = schemas.TABLES[name], loaded.read(name)
    for key in spec.unique:
        assert quality.duplicate_keys(rows, list(key)).isEmpty(), key
    assert quality.null_counts(rows, spec.required).filter("null_count > 0").isEmpty()
    for column, target in spec.references:
        parent, parent_key = target.rsplit(".", 1)
        assert quality.orphans(rows, loaded.read(parent), column, parent_key).isEmpty()


def test_milestones_are_seeded_with_deadlines_and_unknown_ones_kept(loaded):
    rows = {r["milestone"]: r for r in loaded.read("gold.dim_milestone").collect()}
    assert [rows[f"M{n}"]["milestone_key"] for n in range(8)] == list(range(1, 9))
    assert rows["M2"]["deadline_date"] == date(2026, 8, 2)
    assert (rows["M7"]["milestone_number"], rows["M7"]["deadline_date"]) == (7, None)
    assert (rows["Mx"]["milestone_key"], rows["Mx"]["milestone_number"]) == (9, None)


def test_dates_are_local_and_have_english_names(loaded):
    days = {r["date"]: r for r in loaded.read("gold.dim_date").collect()}
    first = days[date(2026, 8, 1)]
    assert (first["date_key"], first["month_name"], first["day_name"]) == (1, "August", "Saturday")
    fact = loaded.read("gold.fact_submission_snapshot")
    assert fact.filter("submission_snapshot_key = 1").first()["created_at_key"] == 1


def test_loaded_runs_are_not_pending(loaded):
    before = loaded.read(schemas.GOLD_LOADS.name).collect()
    assert not Pipeline(loaded).catch_up_gold()
    assert loaded.read(schemas.GOLD_LOADS.name).collect() == before


def test_tables_can_be_created_empty_and_only_once(spark, warehouse):
    warehouse.create_tables()
    for name, spec in schemas.TABLES.items():
        assert warehouse.read(name).schema.names == spec.columns
        assert warehouse.read(name).isEmpty()
    load(warehouse, spark, silver_row())
    warehouse.create_tables()
    assert warehouse.read(schemas.FACT.name).count() == 1


def test_a_second_run_keeps_keys_and_a_joint_load_gives_the_same_tables(spark, tmp_path):
    one = [silver_row("issue-1"), silver_row("issue-2", status="Passed", reviewer=["zoe"])]
    changed = second_run(one[0], issue_title="[M2] Renamed", issue_author=None, reviewer=["carol"])
    new = second_run(silver_row("issue-0"), milestone="M9", reviewer=["amy", "zoe"])
    apart, together = (Warehouse(spark, str(tmp_path / n)) for n in ("apart", "together"))
    load(apart, spark, *one)
    load(apart, spark, changed, new)
    mart = Mart.open(apart)
    issues = {r["issue_id"]: r for r in mart.dim_issue.collect()}
    assert (issues["issue-1"]["issue_key"], issues["issue-1"]["issue_title"]) == (1, "[M2] Renamed")
    assert issues["issue-1"]["issue_author"] is None  # a null overwrites as well
    assert issues["issue-0"]["issue_key"] == 3  # later keys are greater, whatever the name
    assert natural_keys(mart.dim_reviewer, schemas.DIM_REVIEWER) == {
        "alice": 1, "bob": 2, "zoe": 3, "amy": 4, "carol": 5,
    }
    assert {r["submission_snapshot_key"] for r in mart.fact.collect()} == {1, 2, 3, 4}
    assert sorted(r["run_id"] for r in mart.loads.collect()) == ["run-1", "run-2"]

    load(together, spark, *one, changed, new)
    gold = [d.table.name for d in schemas.DIMENSIONS.values()] + [schemas.FACT.name, schemas.BRIDGE.name]
    for name in gold:
        left, right = apart.read(name).collect(), together.read(name).collect()
        assert sorted(map(repr, left)) == sorted(map(repr, right)), name


def test_a_failed_load_leaves_every_table_as_it_was(spark, warehouse, monkeypatch):
    load(warehouse, spark, silver_row())
    pipeline = Pipeline(warehouse)
    pipeline.load_silver(silver(spark, second_run(silver_row(), issue_title="[M2] Lost")))

    def fail(*_):
        raise RuntimeError("bridge write failed")

    monkeypatch.setattr(facts, "bridge_rows", fail)
    with pytest.raises(StageError, match="gold_load: bridge write failed"):
        pipeline.catch_up_gold()
    monkeypatch.undo()
    assert warehouse.read("gold.dim_issue").first()["issue_title"].startswith("[M2] Example")
    assert warehouse.read("gold.fact_submission_snapshot").count() == 1
    assert warehouse.read("ops.gold_loads").count() == 1
    # The failed load has written members, which do not count.
    assert warehouse.stored("gold.dim_issue").count() == 2
    failure = warehouse.read("ops.stage_failures").first()
    assert (failure["run_id"], failure["error_stage"]) == ("run-2", "gold_load")
    assert pipeline.catch_up_gold()
    assert warehouse.read("gold.dim_issue").first()["issue_title"] == "[M2] Lost"
    assert warehouse.read("gold.dim_issue").count() == 1
    keys_ = {r["submission_snapshot_key"] for r in warehouse.read(schemas.FACT.name).collect()}
    assert keys_ == {1, 2}


def test_duplicate_grain_is_rejected(spark, warehouse):
    pipeline = Pipeline(warehouse)
    same_time = {"extracted_at": utc("2026-08-03T00:00:00")}
    pipeline.load_silver(silver(spark, silver_row(), second_run(silver_row(), **same_time)))
    with pytest.raises(StageError, match="unique by issue_id and extracted_at"):
        pipeline.catch_up_gold()


def test_unresolved_keys_are_found(spark):
    numbered = spark.createDataFrame(
        [(1, None, None, 1), (2, "Passed", None, 1), (3, "Passed", 5, None)],
        "submission_snapshot_key long, status string, status_key long, issue_key long",
    )
    rest = {c: F.lit(1) for c in ("state_key", "milestone_key", "created_at_key", "updated_at_key", "extracted_at_key")}
    bad = numbered.withColumns(rest).filter(facts.unresolved())
    assert {r["submission_snapshot_key"] for r in bad.collect()} == {2, 3}


def test_a_load_with_a_lost_member_fails(spark, warehouse, monkeypatch):
    pipeline = Pipeline(warehouse)
    pipeline.load_silver(silver(spark, silver_row()))
    monkeypatch.setattr(
        dimensions, "label_members", lambda seen, spec, real=dimensions.label_members: real(seen, spec).limit(0)
    )
    with pytest.raises(StageError, match="unresolved"):
        pipeline.catch_up_gold()
    assert warehouse.read(schemas.FACT.name).isEmpty() and warehouse.read(schemas.BRIDGE.name).isEmpty()


def test_keys_are_resolved_once_after_numbering(spark, warehouse, monkeypatch):
    """Numbering reads its input twice, so it must come before the dimension joins."""
    plans = []
    number = facts.number_rows
    monkeypatch.setattr(
        facts, "number_rows", lambda frame, *rest: plans.append(frame) or number(frame, *rest)
    )
    load(warehouse, spark, silver_row(), silver_row("issue-2"))
    (narrow,) = plans
    assert "issue_title" not in narrow.columns and "issue_key" not in narrow.columns


def test_small_dimensions_come_from_one_scan(spark, tmp_path):
    silver(spark, silver_row(), silver_row("b", state="CLOSED")).write.parquet(str(tmp_path / "s"))
    seen = dimensions.seen_members(spark.read.parquet(str(tmp_path / "s")), "Asia/Manila")
    assert seen._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    found = {(r["dimension"], r["member"]) for r in seen.collect()}
    assert found >= {("gold.dim_state", "OPEN"), ("gold.dim_state", "CLOSED"), ("gold.dim_reviewer", "bob")}
    assert len(found) == 2 + 1 + 1 + 2 + 3  # states, status, milestone, reviewers, days


def test_an_upsert_writes_what_changed(spark, warehouse):
    """Of 20,000 members a batch that changes 1 % writes about 1 % of the bytes."""
    spec = schemas.DIM_ISSUE
    rows = spark.range(20_000).select(
        F.concat(F.lit("i"), "id").alias("issue_id"),
        F.sha2(F.col("id").cast("string"), 256).alias("issue_title"),
        F.lit("u").alias("issue_url"),
        F.lit("a").alias("issue_author"),
        F.struct(F.lit(utc("2026-08-01T00:00:00")).alias("extracted_at"), F.lit("r").alias("run_id")).alias("first_seen"),
    )
    sizes = []
    for number, batch in enumerate((rows, rows.withColumn("issue_author", F.when(F.col("issue_id").substr(-2, 2) != "07", "a")))):
        load_id = warehouse.new_load()
        start = warehouse.next_keys().get(spec.table.name, 1)
        start = add_members(warehouse, spec, batch, load_id, start)
        keys_ = F.create_map(F.lit(spec.table.name), F.lit(start)).alias("next_keys")
        run = spark.range(1).select(F.lit(f"r{number}").alias("run_id"), F.current_timestamp().alias("extracted_at"))
        warehouse.write(schemas.GOLD_LOADS.name, ledger.load_rows(run, load_id, keys_))
        files = Path(warehouse.path(spec.table.name)).glob(f"load_id={load_id}/**/*.parquet")
        sizes.append(sum(f.stat().st_size for f in files))
    assert sizes[1] < 0.03 * sizes[0]
    current = warehouse.read(spec.table.name)
    assert current.count() == 20_000 and current.filter("issue_author IS NULL").count() == 199
    assert current.agg(F.max("issue_key")).first()[0] == 20_000


def test_numbering_by_ranges_equals_one_global_numbering(spark, tmp_path):
    rows = spark.range(0, 5000).select(
        F.concat(F.lit("k"), ((F.col("id") * 7919) % 5000).cast("string")).alias("name"),
        # one source holds most rows
        F.when(F.col("id") % 3 > 0, "hot").otherwise("rare").alias("source"),
    )
    order = [F.col("source"), F.col("name").desc()]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        ranged = keys.number_ranges(rows, "key", order, str(tmp_path / "n"), start=11)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert spark.read.parquet(str(tmp_path / "n")).select(
        F.shiftright("_slot", 33)
    ).distinct().count() > 1
    small = rows.withColumn("key", F.row_number().over(W.orderBy(*order)) + F.lit(10).cast("bigint"))
    assert ranged.exceptAll(small.select(*ranged.columns)).isEmpty()
    bounds = ranged.agg(F.min("key"), F.max("key"), F.count_distinct("key")).first()
    assert tuple(bounds) == (11, 5010, 5000)


def test_numbering_nothing(spark, tmp_path):
    rows = spark.createDataFrame([], "name string")
    assert keys.number_ranges(rows, "key", [F.col("name")], str(tmp_path / "n")).count() == 0


def test_new_members_are_numbered_after_the_old(spark, tmp_path):
    spec = schemas.DIM_STATE
    old = spark.createDataFrame([(4, "OPEN")], spec.table.schema)
    incoming = spark.createDataFrame(
        [("OPEN", (utc("2026-08-01T00:00:00"), "r")), ("a", (utc("2026-08-02T00:00:00"), "r")), ("b", (utc("2026-08-01T00:00:00"), "r"))],
        "state string, first_seen struct<extracted_at: timestamp, run_id: string>",
    )
    rows, added = dimensions.upsert(spec, old, incoming, str(tmp_path / "u"), 5)
    assert added == 2 and natural_keys(rows, spec) == {"b": 5, "a": 6}


def test_members_are_reduced_by_hashing_before_any_shuffle(spark):
    seen = dimensions.seen_members(silver(spark, silver_row()), "Asia/Manila")
    lines = seen._jdf.queryExecution().executedPlan().toString().splitlines()
    reduced = next(i for i, line in enumerate(lines) if "HashAggregate" in line and "partial_min(extracted_at" in line)
    assert not any("Sort" in line or "Exchange" in line for line in lines[reduced:])
