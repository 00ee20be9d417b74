from __future__ import annotations

import json

import pytest
from boards import bronze, node, page
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.operators.snapshots import Mart
from tidemark.plans.jobs import Pipeline, StageError, write_datasets
from tidemark.sources import csv_datasets
from tidemark.sources.warehouse import Warehouse
from tidemark.streaming.intake import store_new_documents

DOCUMENT = {
    "pages": [
        page(node("a", assignees=[{"login": "rex"}]), has_next=True, end_cursor="c"),
        page(node("b", author="bo", title="[M3] x", status="Passed")),
    ]
}


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """Two files taken in one after the other, then all the way to gold."""
    home = tmp_path_factory.mktemp("jobs")
    landing = home / "landing"
    landing.mkdir()
    pipeline = Pipeline(Warehouse(spark, str(home / "warehouse")))

    def take_in():
        store_new_documents(
            pipeline,
            str(landing),
            str(home / "checkpoint"),
            F.regexp_extract("source_file", r"(run-\d+)\.json$", 1),
            F.lit(1),
            F.lit("2026-08-05 00:00:00"),
        )

    for name in ("run-1", "run-2"):
        (landing / f"{name}.json").write_text(json.dumps(DOCUMENT), encoding="utf-8")
        take_in()
    take_in()
    return pipeline


def test_new_files_are_stored_once(stored):
    attempts = stored.warehouse.read(schemas.PIPELINE_ATTEMPTS.name).collect()
    assert sorted(r["run_id"] for r in attempts) == ["run-1", "run-2"]
    assert stored.warehouse.read(schemas.RAW_EXTRACTIONS.name).count() == 4


def test_datasets_from_gold_and_from_csv(spark, stored, tmp_path):
    # Both runs claim the same extraction time, which the snapshot grain forbids.
    assert stored.catch_up_silver()
    with pytest.raises(Exception, match="unique by issue_id and extracted_at"):
        stored.catch_up_gold()
    warehouse = stored.warehouse
    rows = warehouse.read(schemas.SILVER.name).filter("run_id = 'run-1'")
    single = Pipeline(Warehouse(spark, str(tmp_path / "single")))
    single.load_silver(rows)
    assert single.catch_up_gold()
    single.build_datasets(str(tmp_path / "datasets"))
    read = {n: spark.read.parquet(str(tmp_path / "datasets" / n)) for n in schemas.DATASET_SCHEMAS}
    assert {n: f.count() for n, f in read.items()} == {
        "submission_status": 14,
        "builder_schedule": 1,  # M2 and M3 are both on track in early August
        "progress_trend": 1,
        "interventions": 2,
        "reviewer_workload": 1,
    }
    assert Mart.open(single.warehouse).fact.count() == 2

    for name, frame in read.items():
        frame.toPandas().to_csv(tmp_path / f"{name}.csv", index=False)
    from_csv = csv_datasets.read_datasets(spark, str(tmp_path))
    write_datasets(from_csv, str(tmp_path / "again"))
    again = spark.read.parquet(str(tmp_path / "again" / "interventions"))
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, read["interventions"].collect()))
    assert "None" not in {r["reviewer"] for r in again.collect()}


def test_a_bad_run_is_set_aside_and_an_empty_one_recorded(spark, warehouse):
    pipeline = Pipeline(warehouse)
    pipeline.store_extractions(bronze(spark, page(node("a", assignees=[{"login": "rex"}])), run_id="good"))
    bad = bronze(spark, page(node("b")), run_id="bad", extracted_at="2026-08-06T00:00:00")
    pipeline.store_extractions(bad.withColumn("payload", F.lit("{oops")))
    untitled = page(node("z", title="no milestone"))
    pipeline.store_extractions(bronze(spark, untitled, run_id="empty", extracted_at="2026-08-07T00:00:00"))
    assert pipeline.catch_up_silver()
    loads = warehouse.read("ops.silver_loads").collect()
    assert {r["run_id"]: r["row_count"] for r in loads} == {"good": 1, "empty": 0}
    failure = warehouse.read("ops.stage_failures").first()
    assert (failure["run_id"], failure["error_stage"]) == ("bad", "silver_transform")
    with pytest.raises(StageError, match="silver_transform: malformed pages"):
        pipeline.catch_up_silver()
    assert pipeline.catch_up_gold() and not pipeline.catch_up_gold()
    assert warehouse.read("gold.fact_submission_snapshot").count() == 1


def test_a_page_stored_twice_is_rejected(spark, warehouse):
    pages = bronze(spark, page(node("a")))
    with pytest.raises(StageError, match="duplicate page"):
        Pipeline(warehouse).store_extractions(pages.unionByName(pages))
    assert warehouse.read("bronze.raw_issue_extractions").isEmpty()


def test_pages_are_not_gathered_by_run(spark, warehouse, tmp_path, monkeypatch):
    """Ledgers are joined to pages and rows without a shuffle by run, also the first time."""
    plans = []
    write = Warehouse.write

    def watch(self, name, frame, *more, **options):
        if name == schemas.RAW_EXTRACTIONS.name:
            plans.append(frame._jdf.queryExecution().executedPlan().toString())
        write(self, name, frame, *more, **options)

    monkeypatch.setattr(Warehouse, "write", watch)
    pipeline = Pipeline(warehouse)
    path = str(tmp_path / "landed")
    for run in ("run-1", "run-2"):
        pages = bronze(spark, page(node("a")), run_id=run).withColumnRenamed("payload", "body")
        pages.withColumn("request_cursor", F.lit(None).cast("string")).write.parquet(f"{path}/{run}")
        pipeline.ingest(spark.read.parquet(f"{path}/{run}"))
    pipeline.store_extractions(bronze(spark, page(node("b")), run_id="run-3"))
    assert len(plans) == 3
    for plan in plans:
        assert "Exchange hashpartitioning(run_id" not in plan and "SortMergeJoin" not in plan

    rows = warehouse.stored(schemas.SILVER.name)
    failed = spark.createDataFrame([("run-1",)], "run_id string")
    verdicts = []
    monkeypatch.setattr(pipeline, "_keep", lambda frame: verdicts.append(frame) or frame)
    monkeypatch.setattr(warehouse, "written", lambda name, load_id: spark.range(9).select(
        *(F.lit(None).cast(f.dataType).alias(f.name) for f in rows.schema if f.name != "run_id"),
        F.concat(F.lit("run-"), F.col("id").cast("string")).alias("run_id"),
    ))
    pipeline._silver_verdicts("load", failed)
    assert "BroadcastHashJoin [run_id" in verdicts[0]._jdf.queryExecution().executedPlan().toString()
