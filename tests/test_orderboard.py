from __future__ import annotations

from types import SimpleNamespace

from tidemark import schemas
from tidemark.registry import tables
from tidemark.sources import orderboard

FOLDER = "/root/testdata/sf0.001"


def test_faulty_pages_are_built_once(spark):
    """Its seven parts read stored pages, not the tables seven times."""
    pages = orderboard.faulty_pages(spark, FOLDER)
    plan = pages._jdf.queryExecution().optimizedPlan().toString()
    assert "l_shipdate" not in plan
    assert {r["run_id"] for r in pages.select("run_id").distinct().collect()} == {
        "run-1998", "run-2000", "run-2001", "run-twice", "run-untitled"
    }


def test_items_are_shuffled_once(spark):
    """By order; not first by order and supplier, and again by order."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "7")
    try:
        frame = orderboard.shipped_items(spark, FOLDER)
        plan = frame._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert plan.count("Exchange hashpartitioning(") == 1
    assert "Exchange hashpartitioning(l_orderkey" in plan


def test_snapshot_rows_are_written_where_they_are(spark, monkeypatch):
    """The board's three runs need no shuffle of all silver rows."""
    loads = []
    monkeypatch.setattr(tables, "_once", lambda spark, folder, kind, build: build(tables.Pipeline(None)))
    monkeypatch.setattr(
        tables, "Pipeline", lambda warehouse: SimpleNamespace(
            load_silver=lambda rows, several_runs=True: loads.append((rows.columns, several_runs)),
            catch_up_gold=lambda: loads.append("gold"),
        )
    )
    tables.snapshot_warehouse(spark, FOLDER)
    assert loads == [(schemas.SILVER.columns, False), "gold"]
