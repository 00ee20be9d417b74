"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import SparkSession

#: Runtime SQL settings every plan in this package relies on.
RUNTIME_SETTINGS = {
    # local_date() reads wall-clock time off an instant and needs a fixed zone.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # A status, reviewer or builder may own a third of the rows.
    "spark.sql.adaptive.skewJoin.enabled": "true",
}

#: The mart's rows grow when they are decoded: shuffled rows to some ten times their size, stored
#: JSON to some thirty. With Spark's own sizes a task's memory would follow the data up to above 1 GB.
MART_SETTINGS = {
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
    "spark.sql.files.maxPartitionBytes": "8m",
    # A reader holds a batch decoded: 256 pages are some 15 MB of text, Spark's 4,096 above 200.
    "spark.sql.parquet.columnarReaderBatchSize": "256",
    # Else shuffled rows stay on disk until the driver happens to collect its garbage.
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
}

_own_scratch: str | None = None


def prepare_mart(spark: SparkSession) -> SparkSession:
    """:func:`prepare`, and sizes that keep tasks over pages and submissions small."""
    prepare(spark)
    for key, value in MART_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


@contextmanager
def arrow_batches(spark: SparkSession, size: int) -> Iterator[None]:
    """Jobs begun within hand Python tasks batches of at most ``size`` bytes."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(size))
    try:
        yield
    finally:
        spark.conf.set(key, before)


@contextmanager
def settings(spark: SparkSession, values: Mapping[str, str]) -> Iterator[None]:
    """Jobs begun within are planned with these runtime settings."""
    before = {key: spark.conf.get(key) for key in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def scratch_root(spark: SparkSession) -> str:
    """Folder shared by all executors, named by ``spark.checkpoint.dir``.

    Only a local session may go without that setting; it gets a temporary folder.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("Set spark.checkpoint.dir to a folder all executors can reach")
    global _own_scratch
    if _own_scratch is None:
        _own_scratch = tempfile.mkdtemp(prefix="tidemark-")
    return _own_scratch


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below :func:`scratch_root`; nothing is created yet."""
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"
