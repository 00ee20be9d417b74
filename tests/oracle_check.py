"""Compare registered queries with their SQL: ``python tests/oracle_check.py [folder] [name ...]``."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import duckdb
from pyspark.sql import SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS FROM '{folder}/{name}.parquet'")
    return connection


def _cell(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6)
    return value


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(
        (tuple(_cell(row[i]) for i in order) for row in rows),
        key=lambda row: tuple((v is None, str(v)) for v in row),
    )


SPARK_TO_SQL = {"string": "VARCHAR", "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "boolean": "BOOLEAN"}


def compare(spark: SparkSession, connection, folder: str, name: str) -> str | None:
    """None when the results agree, else what differs."""
    from __spark_entry__ import oracle_sql, queries

    frame = queries()[name](spark, folder)
    result = connection.execute(oracle_sql()[name])
    columns = [d[0] for d in result.description]
    if sorted(frame.columns) != sorted(columns):
        return f"columns {sorted(frame.columns)} != {sorted(columns)}"
    got_types = {f.name: SPARK_TO_SQL[f.dataType.simpleString()] for f in frame.schema.fields}
    want_types = {d[0]: str(d[1]) for d in result.description}
    if got_types != want_types:
        return f"types {set(got_types.items()) ^ set(want_types.items())}"
    expected = _rows(columns, result.fetchall())
    actual = _rows(frame.columns, [tuple(r) for r in frame.collect()])
    if len(actual) != len(expected):
        return f"{len(actual)} rows, expected {len(expected)}"
    different = [(a, e) for a, e in zip(actual, expected) if a != e]
    if different:
        return f"{len(different)} of {len(expected)} rows differ, e.g. {different[0]}"
    if not expected:
        return "no rows"
    return None


def main() -> int:
    from __spark_entry__ import oracle_sql, queries

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(queries())
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(folder)
    bad = 0
    for name in names:
        began = time.time()
        try:
            problem = compare(spark, connection, folder, name) if name in oracle_sql() else "no SQL"
        except Exception as error:  # noqa: BLE001 - report and go on
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        bad += problem is not None
        print(f"{'ok  ' if problem is None else 'BAD '} {name} {time.time() - began:.2f}s {problem or ''}", flush=True)
    print(f"{len(names) - bad} of {len(names)} agree")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
