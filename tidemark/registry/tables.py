"""What the registered queries read: the test tables and the marts derived from them.

A mart is built once per session and folder by the package's own jobs and kept under the
shared scratch folder, as gold tables are kept between runs in production.
"""

from __future__ import annotations

from threading import Lock

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.snapshots import Mart
from tidemark.plans.jobs import Pipeline
from tidemark.session import prepare_mart, scratch_path
from tidemark.sources import folders, orderboard
from tidemark.sources.warehouse import Warehouse

_built: dict[tuple[str, str, str], str] = {}
_building = Lock()


def _once(spark: SparkSession, folder: str, kind: str, build) -> Warehouse:
    prepare_mart(spark)
    key = (spark.sparkContext.applicationId, folder, kind)
    with _building:
        if key not in _built:
            root = scratch_path(spark, kind)
            build(Pipeline(Warehouse(spark, root), orderboard.RULES))
            _built[key] = root
    return Warehouse(spark, _built[key])


def snapshot_warehouse(spark: SparkSession, folder: str) -> Warehouse:
    """Every order of every snapshot as a submission, loaded from silver rows."""

    def build(pipeline: Pipeline) -> None:
        # Three runs: a file of each from every task costs less than a shuffle of all rows by run.
        pipeline.load_silver(orderboard.board_silver(spark, folder), several_runs=False)
        pipeline.catch_up_gold()

    return _once(spark, folder, "snapshots", build)


def landed_warehouse(spark: SparkSession, folder: str) -> Warehouse:
    """The same board through the whole pipeline, from landed JSON pages."""

    def build(pipeline: Pipeline) -> None:
        path = scratch_path(spark, "landed")
        pages = orderboard.store_pages(orderboard.board_pages(spark, folder, by_block=True), path)
        # The landed copy is made for this run alone.
        pipeline.run(pages, taken_in=lambda: folders.remove(spark, path))

    return _once(spark, folder, "landed-run", build)


def faulty_warehouse(spark: SparkSession, folder: str) -> Warehouse:
    """A board with faulty runs through the whole pipeline."""

    def build(pipeline: Pipeline) -> None:
        path = scratch_path(spark, "faulty")
        pages = orderboard.faulty_pages(spark, folder, path)
        pipeline.run(pages, taken_in=lambda: folders.remove(spark, path))

    return _once(spark, folder, "faulty-run", build)


def snapshot_mart(spark: SparkSession, folder: str) -> Mart:
    return Mart.open(snapshot_warehouse(spark, folder))


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return orderboard.table(prepare_mart(spark), folder, name)


def plain(frame: DataFrame) -> DataFrame:
    """Integers as bigint, dates and times as text, arrays joined: engine-neutral values."""

    def value(field: T.StructField):
        column = F.col(field.name)
        if isinstance(field.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            column = column.cast("bigint")
        elif isinstance(field.dataType, T.DateType):
            column = F.date_format(column, "yyyy-MM-dd")
        elif isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
            column = F.date_format(column, "yyyy-MM-dd HH:mm:ss")
        elif isinstance(field.dataType, T.ArrayType):
            column = F.array_join(column, ",", "<null>")
        return column.alias(field.name)

    return frame.select(*(value(f) for f in frame.schema.fields))
