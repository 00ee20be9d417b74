from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

from tidemark.functions.text import humanise
from tidemark.operators import quality
from tidemark.operators.joins import broadcast_within
from tidemark.session import scratch_root
from tidemark.sources import csv_datasets

WORKLOAD = "reviewer_workload"


def test_column_problems_are_reported_together(spark):
    frame = spark.range(1).select(F.col("id").alias("a"), F.col("id").alias("a"), F.col("id").alias("x"))
    with pytest.raises(ValueError, match=r"odd \(lacking \['b'\], beyond it \['a', 'x'\]\)"):
        quality.require_columns(frame, ["a", "b"], "odd")
    assert quality.require_columns(frame.select("x"), ["x"], "odd").columns == ["x"]


def test_contract_keeps_its_columns_in_order(spark):
    frame = spark.createDataFrame([(1, "extra", "al")], "unresolved_count long, note string, reviewer string")
    assert quality.validate_dataset(frame, WORKLOAD).columns == ["reviewer", "unresolved_count"]
    assert quality.validate_dataset(frame.limit(0), WORKLOAD).count() == 0


@pytest.mark.parametrize(
    "schema, row, error, text",
    [
        ("reviewer string", ("al",), ValueError, "lacks the columns unresolved_count"),
        ("reviewer string, unresolved_count string", ("al", "1"), TypeError, "unresolved_count .string. is no numeric"),
        ("reviewer string, unresolved_count long", ("al", None), ValueError, "unresolved_count has 1 bad"),
        ("reviewer string, unresolved_count long", (None, 1), ValueError, "reviewer has 1 bad"),
        ("reviewer long, unresolved_count long", (1, 1), TypeError, "reviewer .bigint. is no label"),
    ],
)
def test_contract_errors(spark, schema, row, error, text):
    with pytest.raises(error, match=text):
        quality.validate_dataset(spark.createDataFrame([row], schema), WORKLOAD)


def test_text_dates_must_parse(spark):
    contract, schema = "progress_trend", "extraction_date string, completion_rate double"
    good = spark.createDataFrame([("2026-08-01", 1.0), (None, 2.0)], schema)
    assert quality.validate_dataset(good, contract).schema["extraction_date"].dataType.typeName() == "timestamp"
    with pytest.raises(TypeError, match="extraction_date has 1 bad"):
        quality.validate_dataset(spark.createDataFrame([("soon", 1.0)], schema), contract)


def test_all_datasets_are_required():
    with pytest.raises(ValueError, match="No frame was given"):
        quality.validate_datasets({})


def test_checks_pass_on_null(spark):
    frame = spark.createDataFrame([(1,), (5,), (None,)], "n int")
    failed = quality.check_failures(frame, {"small": "n < 3", "positive": "n > 0"}).collect()
    assert [(r["n"], r["failed_check"]) for r in failed] == [(5, "small")]


def test_orphans_ignore_missing_keys(spark):
    child = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    parent = spark.createDataFrame([(1,)], "id int")
    assert [r["k"] for r in quality.orphans(child, parent, "k", "id").collect()] == [2]


def test_humanise(spark):
    row = spark.createDataFrame([("on_track",)], "s string").select(humanise(F.col("s"))).first()
    assert row[0] == "On track"


def test_broadcast_only_below_the_bound(spark):
    rows = spark.range(100)
    hinted = spark.range(10).join(broadcast_within(rows, 100), "id")
    plain = spark.range(10).join(broadcast_within(rows, 99), "id")
    assert "strategy=broadcast" in hinted._jdf.queryExecution().logical().toString()
    assert "strategy=broadcast" not in plain._jdf.queryExecution().logical().toString()


def test_scratch_folder_is_configured_or_local(spark):
    assert scratch_root(spark) == scratch_root(spark)


def write_csv(folder, name, text):
    (folder / f"{name}.csv").write_text(text, encoding="utf-8")


def test_csv_datasets(spark, tmp_path):
    write_csv(tmp_path, "progress_trend", "extraction_date,completion_rate\n2026-08-01,12.5\n")
    write_csv(tmp_path, "reviewer_workload", "reviewer,unresolved_count\n,3\nNone,1\n")
    trend = csv_datasets.read_dataset(spark, str(tmp_path), "progress_trend")
    assert tuple(trend.first()) == (date(2026, 8, 1), 12.5)
    workload = csv_datasets.read_dataset(spark, str(tmp_path), "reviewer_workload")
    assert {tuple(r) for r in workload.collect()} == {("Unassigned", 3), ("None", 1)}


def test_csv_errors(spark, tmp_path):
    write_csv(tmp_path, "reviewer_workload", "reviewer,unresolved_count\nal,many\n")
    with pytest.raises(Exception, match="MALFORMED|Malformed"):
        csv_datasets.read_dataset(spark, str(tmp_path), "reviewer_workload").collect()
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        csv_datasets.read_dataset(spark, str(tmp_path), "progress_trend")
    with pytest.raises(KeyError):
        csv_datasets.read_dataset(spark, str(tmp_path), "unknown")
