"""What the marts leave on disk and hold in memory: files, shuffles and batches of small boards."""

from __future__ import annotations

import time
from datetime import datetime
from pathlib import Path

import pytest
from boards import bronze, node, page
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.registry import queries, tables
from tidemark.session import prepare_mart, settings
from tidemark.sources import orderboard

DAY = datetime(1998, 2, 6)


@pytest.fixture(scope="module")
def board(spark, tmp_path_factory):
    """Orders on three pages: keys that are missing or come twice, items without order or supplier."""
    home = tmp_path_factory.mktemp("board")
    keys = [0, 1, 2, 99, 100, 250, 250, None, None]
    orders = [
        (key, None if key == 2 else i % 3, "OF"[i % 2], 1.0, DAY.replace(year=1996 + i % 5), "5-LOW")
        for i, key in enumerate(keys)
    ]
    items = [(key, i % 4, DAY.replace(year=1998 + i % 4)) for i, key in enumerate([*keys, 0, 0, 99, 700])]
    made = {
        "orders": (
            orders,
            "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
            "o_orderdate timestamp, o_orderpriority string",
        ),
        "lineitem": (items, "l_orderkey long, l_suppkey long, l_shipdate timestamp"),
        "customer": ([(0, "Ada"), (1, "Bo"), (1, "Bo")], "c_custkey long, c_name string"),
        "supplier": ([(0, "Rex"), (1, "Sue"), (3, None)], "s_suppkey long, s_name string"),
    }
    for name, (rows, schema) in made.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{home}/{name}.parquet")
    return str(home)


def _rows(frame):
    return sorted(tuple(map(str, row)) for row in frame.collect())


def _files(folder):
    return [f for f in Path(folder).rglob("part-*") if f.is_file()]


def test_pages_are_the_same_by_block(spark, board):
    pages = _rows(orderboard.board_pages(spark, board))
    assert len(pages) > 6
    assert _rows(orderboard.board_pages(spark, board, by_block=True)) == pages


def test_submissions_are_not_shuffled_for_pages(spark, board, tmp_path, monkeypatch):
    """Orders and items are, each once, by block; the third shuffle is that of the last page numbers."""
    read, plans = orderboard.table, []

    def table(spark, folder, name):
        rows = read(spark, folder, name)
        return F.broadcast(rows) if name in ("customer", "supplier") else rows

    class Pages:
        """Notes the plan at the time of writing."""

        sparkSession = spark

        def __init__(self, frame):
            self.frame = frame

        @property
        def write(self):
            plans.append(self.frame.select("*")._jdf.queryExecution().executedPlan().toString())
            return self.frame.write

    monkeypatch.setattr(orderboard, "table", table)
    monkeypatch.setattr(orderboard, "ORDERS_PER_TASK", 3)
    with settings(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        pages = Pages(orderboard.board_pages(spark, board, by_block=True))
        orderboard.store_pages(pages, str(tmp_path / "pages"))
    assert plans[0].count("Exchange hashpartitioning(") == 3
    assert plans[0].count("Exchange hashpartitioning(block") == 2
    assert spark.conf.get("spark.sql.requireAllClusterKeysForCoPartition") == "true"


def test_faulty_pages_are_stored_once(spark, board, tmp_path, monkeypatch):
    """Nothing but the faulty board itself is written, and it has the pages it always had."""
    staged = tmp_path / "faulty"
    monkeypatch.setattr(orderboard, "scratch_path", lambda spark, label: str(tmp_path / label))
    pages = orderboard.faulty_pages(spark, board, str(staged))
    assert [f.name for f in tmp_path.iterdir()] == ["faulty"]
    runs = orderboard.board_pages(spark, board).filter("page_no is not null").cache()
    found = pages.filter("page_no is not null").withColumn("day", F.to_date("extracted_at"))

    def of(frame, run):
        return _rows(frame.filter(F.col("run_id") == run).select("page_no", "request_cursor", "body"))

    whole = {run: of(runs, run) for run in ("run-1998", "run-2000", "run-2001")}
    assert all(whole.values())
    assert of(found, "run-1998") == whole["run-1998"]
    first = [row for row in whole["run-1998"] if row[0] == "1"]
    assert of(found, "run-twice") == sorted([*whole["run-1998"], *first])
    untitled = [(*row[:2], row[2].replace('"title":"[M', '"title":"(M')) for row in whole["run-1998"]]
    assert of(found, "run-untitled") == untitled
    days = found.filter("run_id = 'run-untitled'").select("day").distinct().collect()
    assert [str(r["day"]) for r in days] == ["1999-01-01"]
    attempts = {n: of(found.filter(F.col("attempt_number") == n), "run-2000") for n in (1, 2)}
    cut = [(*row[:2], row[2][:-1] if row[0] == "1" else row[2]) for row in whole["run-2000"]]
    assert attempts == {1: cut, 2: whole["run-2000"]}
    odd = [
        (*row[:2], row[2].replace('"assignees":{', '"assignees":{"nodes":5,"was":{').replace('},"labels"', '}},"labels"'))
        if row[0] == "2"
        else row
        for row in whole["run-2001"]
    ]
    assert of(found, "run-2001") == odd


def test_landed_pages_go_once_bronze_holds_them(spark, board, tmp_path, monkeypatch):
    read = orderboard.table

    def table(spark, folder, name):
        # An attempt has each page once and a run each order, so that there is something to load.
        rows = read(spark, folder, name).dropna("any")
        return rows if name == "lineitem" else rows.dropDuplicates([rows.columns[0]])

    monkeypatch.setattr(orderboard, "table", table)
    monkeypatch.setattr(tables, "scratch_path", lambda spark, label: str(tmp_path / label))
    for build, made in ((tables.landed_warehouse, "landed"), (tables.faulty_warehouse, "faulty")):
        warehouse = build(spark, board)
        assert not (tmp_path / made).exists()
        assert warehouse.read(schemas.RAW_EXTRACTIONS.name).count() > 3
        stored = _files(warehouse.path(schemas.RAW_EXTRACTIONS.name))
        assert stored and all(".zstd." in f.name for f in stored)


def test_a_load_leaves_no_numbered_copies(spark, warehouse, tmp_path, monkeypatch):
    """Fact and dimensions are in the mart then; what they were numbered from is gone."""
    from tidemark.plans import jobs

    monkeypatch.setattr(jobs, "scratch_path", lambda spark, label: f"{tmp_path}/{label}-{time.time_ns()}")
    pipeline = jobs.Pipeline(warehouse)
    pipeline.store_extractions(bronze(spark, page(node("a"))))
    assert pipeline.catch_up_silver() and pipeline.catch_up_gold()
    assert warehouse.read(schemas.FACT.name).count() == 1
    left = [f.name for f in tmp_path.iterdir() if f.name.startswith(("fact", "gold.dim"))]
    assert left == []


@pytest.mark.parametrize("runs, by_run", [(1, False), (3, False), (5, True)])
def test_silver_of_few_runs_is_not_shuffled_by_run(spark, warehouse, monkeypatch, runs, by_run):
    from tidemark.plans.jobs import Pipeline

    pipeline, spread = Pipeline(warehouse), []
    for run in range(runs):
        taken = f"2026-08-{run + 5:02d}T00:00:00"
        pipeline.store_extractions(bronze(spark, page(node("a")), run_id=f"run-{run}", extracted_at=taken))
    write = warehouse.write

    def watch(name, frame, load_id=None, spread_by_partition=False):
        if name == schemas.SILVER.name:
            spread.append(spread_by_partition)
        write(name, frame, load_id, spread_by_partition)

    monkeypatch.setattr(warehouse, "write", watch)
    assert pipeline.catch_up_silver()
    assert spread == [by_run]
    assert warehouse.read(schemas.SILVER.name).count() == runs


def test_payload_files_are_stored_compressed(spark, tmp_path, monkeypatch):
    pages = [page(*(node(f"{n}-{i}") for i in range(40)), has_next=True, end_cursor=f"c{n}") for n in range(30)]
    stored = bronze(spark, *pages, run_id="run-2000").unionByName(bronze(spark, *pages[:7], run_id="run-1998"))
    monkeypatch.setattr(queries, "PAGES_PER_FILE", 4)
    monkeypatch.setattr(queries, "_bronze", lambda spark, folder: stored)
    monkeypatch.setattr(queries, "scratch_path", lambda spark, label: str(tmp_path / label))
    found = [tuple(r) for r in queries.payload_files(spark, "").collect()]
    expected = [(run, n + 1, f"{n}-0") for run, count in (("run-1998", 7), ("run-2000", 30)) for n in range(count)]
    assert sorted(found) == expected
    text = stored.agg(F.sum(F.length("payload")).alias("n")).first()["n"]
    files = _files(tmp_path / "payload-files")
    assert len(files) == 10 and sum(f.stat().st_size for f in files) < text / 4


def _shuffle_files(spark):
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    files = disk.getAllFiles()
    names = (files.apply(i).getName() for i in range(files.size()))
    return {name for name in names if name.startswith("shuffle_")}


def test_shuffled_rows_go_with_their_job(spark):
    before = _shuffle_files(prepare_mart(spark))
    frame = spark.range(1000).repartition(7, "id")
    frame.write.format("noop").mode("overwrite").save()
    until = time.time() + 20
    while _shuffle_files(spark) - before and time.time() < until:
        time.sleep(0.2)
    assert not _shuffle_files(spark) - before
    # The same frame again: its rows are shuffled again.
    assert len(frame.collect()) == len(frame.collect()) == 1000


def test_a_task_decodes_few_pages_at_once(spark, tmp_path):
    """A reader's batch of a board's pages, of some 60 KB each, stays far below an executor's memory."""
    prepare_mart(spark)
    spark.range(3000).repartition(1).write.parquet(str(tmp_path / "pages"))
    frame = spark.read.parquet(str(tmp_path / "pages"))
    scan = frame._jdf.queryExecution().executedPlan().collectLeaves().apply(0)
    batches = scan.executeColumnar().toJavaRDD().count()
    assert 3000 / batches * 60_000 < 30e6
