"""The stored tables: partitioned Parquet folders, and the ledgers that say which rows count.

Each table is one folder below ``root``. Rows are written first and their ledger row last, so
rows of a load that failed are never seen. One writer at a time.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.quality import require_columns
from tidemark.schemas import DIMENSIONS, TABLES, DimensionSpec, TableSpec
from tidemark.sources.folders import exists

_DIMENSION_OF = {spec.table.name: spec for spec in DIMENSIONS.values()}


class Warehouse:
    """Where the tables are, how they are written, and which of their rows count."""

    def __init__(self, spark: SparkSession, root: str, tables: dict[str, TableSpec] = TABLES):
        self.spark = spark
        self.root = root.rstrip("/")
        self.tables = tables

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def stored(self, name: str) -> DataFrame:
        """All rows in the table's folder, of failed loads too; empty if it has none yet."""
        spec = self.tables[name]
        schema = T.StructType([*spec.schema.fields, *spec.stored_with.fields])
        if not exists(self.spark, self.path(name)):
            # Known to be empty when a query is planned: no rows are shuffled to be joined with it.
            empty = self.spark.range(0).filter(F.lit(False))
            return empty.select(*(F.lit(None).cast(f.dataType).alias(f.name) for f in schema))
        return self.spark.read.schema(schema).parquet(self.path(name)).select(*schema.names)

    def counting(self, name: str, load_id: str | None = None) -> DataFrame:
        """Stored rows that their ledger names, and those of a load under way.

        The ledger has a row per run or attempt; it prunes partitions of the table.
        """
        spec = self.tables[name]
        rows = self.stored(name)
        if spec.ledger is None:
            return rows
        keys = self.stored(spec.ledger.table).filter(spec.ledger.condition)
        keys = keys.select(*spec.ledger.columns)
        if load_id is not None:
            keys = keys.unionByName(self.spark.range(1).select(F.lit(load_id).alias("load_id")))
        return rows.join(keys.distinct(), list(spec.ledger.columns), "left_semi")

    def read(self, name: str, load_id: str | None = None) -> DataFrame:
        """The table; ``load_id`` adds what that load has written so far."""
        rows = self.counting(name, load_id)
        if name in _DIMENSION_OF:
            return current_members(_DIMENSION_OF[name], rows)
        return rows.select(*self.tables[name].columns)

    def read_all(self, *names: str) -> dict[str, DataFrame]:
        return {name: self.read(name) for name in names}

    def written(self, name: str, load_id: str) -> DataFrame:
        """What one load has written to a table."""
        rows = self.stored(name).filter(F.col("load_id") == load_id)
        return rows.select(*self.tables[name].columns)

    def write(
        self,
        name: str,
        frame: DataFrame,
        load_id: str | None = None,
        spread_by_partition: bool = False,
    ) -> None:
        """Add rows, matching columns by name after an exact column check.

        Partitions that the rows belong to are written anew, so that repeating a write that
        failed leaves no row twice. ``spread_by_partition`` gathers the rows of a partition
        into few files first, splitting large ones; leave it off for rows in that order.
        """
        spec = self.tables[name]
        if load_id is not None:
            frame = frame.withColumn("load_id", F.lit(load_id))
        extra = [c for c in spec.stored_with.names]
        expected = [*spec.columns, *(c for c in extra if c not in spec.columns)]
        require_columns(frame, expected, f"DataFrame does not match {name} schema")
        kinds = {f.name: f.dataType for f in [*spec.schema.fields, *spec.stored_with.fields]}
        typed = frame.select(*(F.col(c).cast(kinds[c]).alias(c) for c in expected))
        folders = [*spec.partition_by, *extra]
        if not folders:
            # A ledger: one row per run or attempt, in one file that appears as a whole.
            typed.coalesce(1).write.mode("append").parquet(self.path(name))
            return
        if spread_by_partition:
            typed = typed.hint("rebalance", *spec.partition_by)
        (
            typed.write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(*folders)
            .parquet(self.path(name), compression=spec.codec)
        )

    def create_table(self, name: str) -> None:
        """An empty folder for a table that has none yet."""
        spec = self.tables[name]
        schema = T.StructType([*spec.schema.fields, *spec.stored_with.fields])
        # Nothing happens where the folder exists.
        writer = self.spark.createDataFrame([], schema).write.mode("ignore")
        writer.partitionBy(*spec.partition_by, *spec.stored_with.names).parquet(self.path(name))

    def create_tables(self) -> None:
        for name in self.tables:
            self.create_table(name)

    def new_load(self) -> str:
        """An id that no load has had, greater than those of earlier gold loads."""
        earlier = self.stored("ops.gold_loads").agg(F.max("load_id")).first()[0]
        number = int(earlier.split("-")[0]) + 1 if earlier else 1
        return f"{number:08d}-{uuid.uuid4().hex[:12]}"

    def next_keys(self) -> dict[str, int]:
        """First unused surrogate key by table; one small ledger is read."""
        given = self.stored("ops.gold_loads").select(F.explode("next_keys").alias("name", "key"))
        return {r["name"]: r["key"] for r in given.groupBy("name").agg(F.max("key").alias("key")).collect()}


def current_members(spec: DimensionSpec, rows: DataFrame) -> DataFrame:
    """Members with the attributes of the latest load that changed them.

    Only the changes are aggregated; mostly they are few, and Spark broadcasts them.
    """
    first = rows.filter(~F.col("is_update"))
    if not spec.updates:
        return first.select(*spec.table.columns)
    latest = (
        rows.filter("is_update")
        # Partitioned first: saves the sort that a map-side aggregate of structs would need.
        .repartition(spec.natural_key)
        .groupBy(spec.natural_key)
        .agg(F.max_by(F.struct(*spec.updates), F.col("load_id")).alias("latest"))
    )
    changed = F.col("latest").isNotNull()
    return first.join(latest, spec.natural_key, "left").select(
        *(
            F.when(changed, F.col(f"latest.{c}")).otherwise(F.col(c)).alias(c)
            if c in spec.updates
            else F.col(c)
            for c in spec.table.columns
        )
    )
