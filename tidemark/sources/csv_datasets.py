"""Metric datasets kept as CSV files, one per dataset."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.schemas import DATASET_SCHEMAS, UNASSIGNED

#: Datasets whose missing reviewer means that nobody is assigned.
_REVIEWED = ("interventions", "reviewer_workload")


def read_dataset(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """Read ``<folder>/<name>.csv`` with its declared types; a bad cell fails the job.

    Only an empty cell is null: the text ``None`` is a legal next actor.
    """
    if name not in DATASET_SCHEMAS:
        raise KeyError(f"Unknown dataset: {name}")
    frame = spark.read.csv(
        f"{folder}/{name}.csv",
        schema=DATASET_SCHEMAS[name],
        header=True,
        mode="FAILFAST",
        enforceSchema=False,
        dateFormat="yyyy-MM-dd",
    )
    if name in _REVIEWED:
        frame = frame.na.fill({"reviewer": UNASSIGNED})
    return frame


def read_datasets(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    return {name: read_dataset(spark, folder, name) for name in DATASET_SCHEMAS}
