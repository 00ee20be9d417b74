"""Constraint checks: each returns the violating rows or counts, never changes data."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.schemas import DATASET_SCHEMAS


def require_columns(frame: DataFrame, expected: Iterable[str], complaint: str) -> DataFrame:
    """The frame, if its columns are the expected ones in any order, each once."""
    wanted, actual = Counter(expected), Counter(frame.columns)
    if wanted != actual:
        lacks, surplus = sorted((wanted - actual).elements()), sorted((actual - wanted).elements())
        raise ValueError(f"{complaint} (lacking {lacks}, beyond it {surplus})")
    return frame


def duplicate_keys(frame: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key values that occur more than once, with their row count.

    Counts are combined before the shuffle, so one heavily repeated key is cheap.
    """
    counted = frame.groupBy(*keys).agg(F.count("*").alias("row_count"))
    return counted.filter(F.col("row_count") > 1)


def null_counts(frame: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per column with its number of nulls, from a single pass."""
    totals = frame.agg(*(F.count_if(F.col(c).isNull()).alias(c) for c in columns))
    return totals.unpivot([], list(columns), "column_name", "null_count")


def orphans(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Child rows whose key is set but absent from the parent."""
    known = parent.select(F.col(parent_key).alias(child_key))
    return child.filter(F.col(child_key).isNotNull()).join(known, child_key, "left_anti")


def orphan_counts(
    child: DataFrame, references: Sequence[tuple[str, DataFrame, str]]
) -> DataFrame:
    """``column_name, orphan_count`` for all references of a table, from one scan of it.

    A reference is a column, its parent frame and the parent's key, which must be unique.
    """
    rows = child.select(*(column for column, _, _ in references))
    for number, (column, parent, parent_key) in enumerate(references):
        known = parent.select(F.col(parent_key).alias(f"known_{number}"))
        rows = rows.join(known, F.col(column) == F.col(f"known_{number}"), "left")
    totals = rows.agg(
        *(
            F.count_if(F.col(column).isNotNull() & F.col(f"known_{number}").isNull()).alias(column)
            for number, (column, _, _) in enumerate(references)
        )
    )
    columns = [column for column, _, _ in references]
    return totals.unpivot([], columns, "column_name", "orphan_count")


def check_failures(frame: DataFrame, checks: Mapping[str, str]) -> DataFrame:
    """Rows that break a CHECK expression, one row per broken check.

    As in SQL, a check that evaluates to null passes.
    """
    broken = F.filter(
        F.array(
            *(
                F.when(~F.coalesce(F.expr(rule), F.lit(True)), F.lit(name))
                for name, rule in checks.items()
            )
        ),
        lambda name: name.isNotNull(),
    )
    return frame.withColumn("failed_check", F.explode(broken))


# --- Metric datasets --------------------------------------------------------------

#: How the type of a dataset's column in ``DATASET_SCHEMAS`` is checked: the role it plays,
#: and the types that are taken for it.
_ROLES = {
    T.LongType: ("numeric", (T.NumericType, T.BooleanType)),
    T.DoubleType: ("numeric", (T.NumericType, T.BooleanType)),
    T.DateType: ("date", (T.DateType, T.TimestampType, T.TimestampNTZType, T.StringType)),
    T.StringType: ("label", (T.StringType,)),
}


def _bad_cell(column: str, role: str, kind: T.DataType) -> Column:
    """Null in a number or label; text that is no date in a date column."""
    if role != "date":
        return F.col(column).isNull()
    if isinstance(kind, T.StringType):
        return F.col(column).isNotNull() & F.try_to_timestamp(F.col(column)).isNull()
    return F.lit(False)


def contract_violations(frame: DataFrame, schema: T.StructType) -> DataFrame:
    """``column_name, role, bad_count`` per column of a dataset schema, from one pass."""
    role = {f.name: _ROLES[type(f.dataType)][0] for f in schema}
    totals = frame.agg(
        *(F.count_if(_bad_cell(c, role[c], frame.schema[c].dataType)).alias(c) for c in role)
    )
    rows = totals.unpivot([], list(role), "column_name", "bad_count")
    names = F.create_map(*(F.lit(x) for pair in role.items() for x in pair))
    return rows.select("column_name", names[F.col("column_name")].alias("role"), "bad_count")


def _contract_columns(frame: DataFrame, name: str) -> DataFrame:
    """The columns of a dataset, if none is absent and all types fit."""
    schema = DATASET_SCHEMAS[name]
    absent = [f.name for f in schema if f.name not in frame.columns]
    if absent:
        raise ValueError(f"{name} lacks the columns {', '.join(absent)}")
    chosen = frame.select(*schema.names)
    unfit = [
        f"{f.name} ({chosen.schema[f.name].dataType.simpleString()}) is no {role} column"
        for f in schema
        for role, kinds in [_ROLES[type(f.dataType)]]
        if not isinstance(chosen.schema[f.name].dataType, kinds)
    ]
    if unfit:
        raise TypeError(f"{name}: {'; '.join(unfit)}")
    return chosen


def _require_cells(name: str, bad: Mapping[str, int]) -> None:
    """``bad``: number of bad cells by column."""
    found = {column: n for column, n in bad.items() if n}
    if found:
        schema = DATASET_SCHEMAS[name]
        dates_only = all(isinstance(schema[c].dataType, T.DateType) for c in found)
        cells = "; ".join(f"{column} has {n} bad cells" for column, n in found.items())
        raise (TypeError if dates_only else ValueError)(f"{name}: {cells}")


def _read_dates(chosen: DataFrame, name: str) -> DataFrame:
    texts = [
        f.name
        for f in DATASET_SCHEMAS[name]
        if isinstance(f.dataType, T.DateType) and isinstance(chosen.schema[f.name].dataType, T.StringType)
    ]
    return chosen.withColumns({c: F.to_timestamp(c) for c in texts}) if texts else chosen


def validate_dataset(frame: DataFrame, name: str) -> DataFrame:
    """The dataset's columns in their order; an error lists everything that is wrong.

    Further columns are dropped, and dates given as text become timestamps. Absent columns
    raise ``ValueError``, unfit types ``TypeError``; cells are looked at after that, where
    text that is no date counts as an unfit type.
    """
    chosen = _contract_columns(frame, name)
    # One row per column, whatever the size of the dataset.
    rows = contract_violations(chosen, DATASET_SCHEMAS[name]).collect()
    _require_cells(name, {row["column_name"]: row["bad_count"] for row in rows})
    return _read_dates(chosen, name)


def require_all(frames: Mapping[str, DataFrame]) -> None:
    absent = sorted(DATASET_SCHEMAS.keys() - frames.keys())
    if absent:
        raise ValueError(f"No frame was given for {', '.join(absent)}")


def validate_datasets(frames: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """All five metric datasets, validated; none may be left out."""
    require_all(frames)
    return {name: validate_dataset(frames[name], name) for name in DATASET_SCHEMAS}


def write_validated(frame: DataFrame, name: str, path: str) -> None:
    """Write a dataset and validate it in the same pass; an error leaves the files behind."""
    chosen = _contract_columns(frame, name)
    schema, found = DATASET_SCHEMAS[name], Observation()
    counts = [
        F.count_if(_bad_cell(f.name, _ROLES[type(f.dataType)][0], chosen.schema[f.name].dataType)).alias(f.name)
        for f in schema
    ]
    watched = chosen.observe(found, *counts)
    _read_dates(watched, name).write.mode("errorifexists").parquet(path)
    _require_cells(name, found.get)
