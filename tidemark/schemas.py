"""Table schemas, parameters and dataset contracts."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date

from pyspark.sql import types as T

# --- Fixed values -----------------------------------------------------------

LOCAL_ZONE = "Asia/Manila"

MILESTONE_DEADLINES = {
    "M0": date(2026, 6, 28),
    "M1": date(2026, 7, 19),
    "M2": date(2026, 8, 2),
    "M3": date(2026, 9, 13),
    "M4": date(2026, 10, 11),
    "M5": date(2026, 11, 8),
    "M6": date(2026, 12, 6),
}

STATUS_UNCHECKED = "Unchecked/Unassigned"
STATUS_IN_REVIEW = "In review"
STATUS_NEEDS_IMPROVEMENT = "Needs Improvement"
STATUS_PASSED = "Passed"
KNOWN_STATUSES = (
    STATUS_UNCHECKED,
    STATUS_IN_REVIEW,
    STATUS_NEEDS_IMPROVEMENT,
    STATUS_PASSED,
)

UNASSIGNED = "Unassigned"

PIPELINE_STAGES = (
    "extraction",
    "bronze_transform",
    "bronze_load",
    "silver_transform",
    "silver_load",
    "gold_transform",
    "gold_load",
)

OWNER_TYPES = ("organization", "user")

MAX_ERROR_MESSAGE = 2000

# Order in which a status chart lists the statuses it knows.
STATUS_DISPLAY_ORDER = (
    "Passed",
    "In review",
    "Needs Improvement",
    "Unchecked/Unassigned",
    "Accepted",
    "Needs changes",
    "Not submitted",
    "Unknown",
)

DISPLAY_MILESTONES = ("M0", "M1", "M2", "M3", "M4", "M5", "M6")


@dataclass(frozen=True)
class BoardRules:
    """Everything about one board that is configuration rather than data."""

    deadlines: dict[str, date] = field(default_factory=lambda: dict(MILESTONE_DEADLINES))
    excluded_authors: tuple[str, ...] = ()
    zone: str = LOCAL_ZONE


# --- Landed pages -----------------------------------------------------------

_named = T.StructType([T.StructField("name", T.StringType())])
_login = T.StructType([T.StructField("login", T.StringType())])


def _nodes(element: T.StructType) -> T.StructType:
    return T.StructType([T.StructField("nodes", T.ArrayType(element))])


CONTENT = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("title", T.StringType()),
        T.StructField("url", T.StringType()),
        T.StructField("author", _login),
        T.StructField("createdAt", T.StringType()),
        T.StructField("updatedAt", T.StringType()),
        T.StructField("state", T.StringType()),
        T.StructField("assignees", _nodes(_login)),
        T.StructField("labels", _nodes(_named)),
    ]
)

FIELD_VALUE = T.StructType(
    [T.StructField("name", T.StringType()), T.StructField("field", _named)]
)

NODE = T.StructType(
    [T.StructField("content", CONTENT), T.StructField("fieldValues", _nodes(FIELD_VALUE))]
)

_PAGE_INFO = T.StructType(
    [
        T.StructField("hasNextPage", T.BooleanType()),
        T.StructField("endCursor", T.StringType()),
    ]
)

_BOARD = T.StructType(
    [
        T.StructField(
            "projectV2",
            T.StructType(
                [
                    T.StructField(
                        "items",
                        T.StructType(
                            [
                                T.StructField("nodes", T.ArrayType(NODE)),
                                T.StructField("pageInfo", _PAGE_INFO),
                            ]
                        ),
                    )
                ]
            ),
        )
    ]
)

PAGE = T.StructType(
    [
        T.StructField(
            "data",
            T.StructType([T.StructField(owner, _BOARD) for owner in OWNER_TYPES]),
        )
    ]
)

LANDED_PAGES = T.StructType(
    [
        T.StructField("run_id", T.StringType(), False),
        T.StructField("attempt_number", T.IntegerType(), False),
        T.StructField("extracted_at", T.TimestampType(), False),
        T.StructField("page_no", T.LongType(), False),
        T.StructField("request_cursor", T.StringType()),
        T.StructField("body", T.StringType()),
    ]
)

#: Codec of stored pages, whose text is bulky and repetitive: half of what Spark's own leaves.
PAGES_CODEC = "zstd"

# --- Stored tables ----------------------------------------------------------


@dataclass(frozen=True)
class Ledger:
    """Which rows of a table count: those whose ``columns`` stand in the ledger ``table``."""

    table: str
    columns: tuple[str, ...]
    condition: str = "true"


@dataclass(frozen=True)
class TableSpec:
    """A stored table: schema, declared constraints and physical layout.

    ``stored_with`` names partition columns that the files have besides the schema. Without
    ``codec`` the session's own compresses the files.
    """

    name: str
    schema: T.StructType
    unique: tuple[tuple[str, ...], ...] = ()
    references: tuple[tuple[str, str], ...] = ()
    checks: tuple[tuple[str, str], ...] = ()
    partition_by: tuple[str, ...] = ()
    stored_with: T.StructType = field(default_factory=T.StructType)
    ledger: Ledger | None = None
    codec: str | None = None

    @property
    def columns(self) -> list[str]:
        return self.schema.names

    @property
    def required(self) -> list[str]:
        return [f.name for f in self.schema.fields if not f.nullable]


_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "long": T.LongType(),
    "ts": T.TimestampType(),
    "date": T.DateType(),
    "bool": T.BooleanType(),
    "strings": T.ArrayType(T.StringType()),
    "longs": T.MapType(T.StringType(), T.LongType()),
}


def _schema(text: str) -> T.StructType:
    """``"a:long b:string?"`` -> StructType; ``?`` marks a nullable column."""
    fields = []
    for item in text.split():
        name, kind = item.split(":")
        fields.append(T.StructField(name, _TYPES[kind.rstrip("?")], kind.endswith("?")))
    return T.StructType(fields)


#: The load that wrote a row; nothing counts before the load stands in its ledger.
_LOAD = _schema("load_id:string")
_GOLD_LEDGER = Ledger("ops.gold_loads", ("load_id",))

PIPELINE_ATTEMPTS = TableSpec(
    "ops.pipeline_attempts",
    _schema(
        "run_id:string attempt_number:int started_at:ts completed_at:ts "
        "attempt_status:string error_stage:string? error_type:string? error_message:string?"
    ),
    unique=(("run_id", "attempt_number"),),
    checks=(
        ("status_domain", "attempt_status IN ('succeeded', 'failed')"),
        (
            "stage_domain",
            "error_stage IS NULL OR error_stage IN ("
            + ", ".join(f"'{stage}'" for stage in PIPELINE_STAGES)
            + ")",
        ),
        (
            "diagnostics",
            "(attempt_status = 'succeeded' AND error_stage IS NULL"
            " AND error_type IS NULL AND error_message IS NULL)"
            " OR (attempt_status = 'failed' AND error_stage IS NOT NULL"
            " AND error_type IS NOT NULL AND error_message IS NOT NULL)",
        ),
    ),
)

# One row per page, not per run: a whole run in one string would have to pass
# through one task, and page_no keeps the order of the pages.
RAW_EXTRACTIONS = TableSpec(
    "bronze.raw_issue_extractions",
    _schema("run_id:string attempt_number:int extracted_at:ts page_no:long payload:string"),
    unique=(("run_id", "attempt_number", "page_no"),),
    partition_by=("run_id", "attempt_number"),
    ledger=Ledger(
        "ops.pipeline_attempts", ("run_id", "attempt_number"), "attempt_status = 'succeeded'"
    ),
    codec=PAGES_CODEC,
)

SILVER = TableSpec(
    "silver.issue_submissions",
    _schema(
        "issue_id:string issue_title:string issue_url:string issue_author:string? "
        "created_at:ts updated_at:ts state:string reviewer:strings milestone:string "
        "status:string? run_id:string extracted_at:ts is_assigned:bool "
        "days_since_update:long submission_age_days:long"
    ),
    unique=(("run_id", "issue_id"),),
    partition_by=("run_id",),
    stored_with=_LOAD,
    ledger=Ledger("ops.silver_loads", ("run_id", "load_id")),
)

# ``next_keys``: per table the first surrogate key that the load has not given out.
GOLD_LOADS = TableSpec(
    "ops.gold_loads",
    _schema("run_id:string extracted_at:ts loaded_at:ts load_id:string next_keys:longs"),
    unique=(("run_id",),),
)

# Written after the silver rows: names the runs in silver without reading them. A run may
# have no rows.
SILVER_LOADS = TableSpec(
    "ops.silver_loads",
    _schema("run_id:string extracted_at:ts loaded_at:ts load_id:string row_count:long"),
    unique=(("run_id",),),
)

# Failures after bronze cannot be told from the attempt row, which already says
# "succeeded"; they get a log of their own.
STAGE_FAILURES = TableSpec(
    "ops.stage_failures",
    _schema(
        "run_id:string? failed_at:ts error_stage:string error_type:string error_message:string"
    ),
)


@dataclass(frozen=True)
class DimensionSpec:
    """A dimension: table, natural key, and what a re-load may overwrite."""

    table: TableSpec
    surrogate_key: str
    natural_key: str
    updates: tuple[str, ...] = ()

    @property
    def attributes(self) -> list[str]:
        return [
            c for c in self.table.columns if c not in (self.surrogate_key, self.natural_key)
        ]


# A load adds new members, and a row with is_update for each known one that it changes.
_MEMBER = _schema("load_id:string is_update:bool")


def _dimension(name, surrogate_key, natural_key, columns, updates=()):
    table = TableSpec(
        f"gold.{name}",
        _schema(f"{surrogate_key}:long {columns}"),
        unique=((surrogate_key,), (natural_key,)),
        stored_with=_MEMBER,
        ledger=_GOLD_LEDGER,
    )
    return DimensionSpec(table, surrogate_key, natural_key, tuple(updates))


DIM_ISSUE = _dimension(
    "dim_issue",
    "issue_key",
    "issue_id",
    "issue_id:string issue_title:string issue_url:string issue_author:string?",
    updates=("issue_title", "issue_url", "issue_author"),
)
DIM_REVIEWER = _dimension("dim_reviewer", "reviewer_key", "reviewer", "reviewer:string")
DIM_STATE = _dimension("dim_state", "state_key", "state", "state:string")
DIM_STATUS = _dimension("dim_status", "status_key", "status", "status:string")
DIM_MILESTONE = _dimension(
    "dim_milestone",
    "milestone_key",
    "milestone",
    "milestone:string milestone_number:int? deadline_date:date?",
    updates=("milestone_number", "deadline_date"),
)
DIM_DATE = _dimension(
    "dim_date",
    "date_key",
    "date",
    "date:date year:int month:int month_name:string day:int day_name:string",
)

DIMENSIONS = {
    "dim_issue": DIM_ISSUE,
    "dim_reviewer": DIM_REVIEWER,
    "dim_state": DIM_STATE,
    "dim_status": DIM_STATUS,
    "dim_milestone": DIM_MILESTONE,
    "dim_date": DIM_DATE,
}

DATE_ROLES = ("created_at", "updated_at", "extracted_at")

# extracted_on repeats the UTC day of extracted_at as the partition column, so the
# latest-snapshot filter reads one folder of the fact and of the bridge.
FACT = TableSpec(
    "gold.fact_submission_snapshot",
    _schema(
        "submission_snapshot_key:long run_id:string issue_key:long state_key:long "
        "status_key:long? milestone_key:long created_at_key:long updated_at_key:long "
        "extracted_at_key:long created_at:ts updated_at:ts extracted_at:ts "
        "is_assigned:bool days_since_update:long submission_age_days:long extracted_on:date"
    ),
    unique=(("submission_snapshot_key",), ("issue_key", "extracted_at")),
    references=(
        ("issue_key", "gold.dim_issue.issue_key"),
        ("state_key", "gold.dim_state.state_key"),
        ("status_key", "gold.dim_status.status_key"),
        ("milestone_key", "gold.dim_milestone.milestone_key"),
        ("created_at_key", "gold.dim_date.date_key"),
        ("updated_at_key", "gold.dim_date.date_key"),
        ("extracted_at_key", "gold.dim_date.date_key"),
    ),
    partition_by=("extracted_on",),
    stored_with=_LOAD,
    ledger=_GOLD_LEDGER,
)

BRIDGE_COLUMNS = ("submission_snapshot_key", "reviewer_key")

BRIDGE = TableSpec(
    "gold.bridge_submission_reviewer",
    _schema("submission_snapshot_key:long reviewer_key:long extracted_on:date"),
    unique=(("submission_snapshot_key", "reviewer_key"),),
    references=(
        ("submission_snapshot_key", "gold.fact_submission_snapshot.submission_snapshot_key"),
        ("reviewer_key", "gold.dim_reviewer.reviewer_key"),
    ),
    partition_by=("extracted_on",),
    stored_with=_LOAD,
    ledger=_GOLD_LEDGER,
)

TABLES = {
    spec.name: spec
    for spec in (
        PIPELINE_ATTEMPTS,
        STAGE_FAILURES,
        RAW_EXTRACTIONS,
        SILVER,
        SILVER_LOADS,
        GOLD_LOADS,
        *(dimension.table for dimension in DIMENSIONS.values()),
        FACT,
        BRIDGE,
    )
}

# --- Metric dataset contracts -----------------------------------------------


#: Columns and types of each metric dataset, in order; also used to read them from CSV.
DATASET_SCHEMAS = {
    "submission_status": _schema("milestone:string? status:string? submission_count:long?"),
    "builder_schedule": T.StructType(
        [
            T.StructField("schedule_status", T.StringType()),
            T.StructField("builder_count", T.LongType()),
            T.StructField("builder_percentage", T.DoubleType()),
        ]
    ),
    "progress_trend": T.StructType(
        [
            T.StructField("extraction_date", T.DateType()),
            T.StructField("completion_rate", T.DoubleType()),
        ]
    ),
    "interventions": _schema(
        "builder:string? current_milestone:string? status:string? schedule_status:string? "
        "reviewer:string? issue_state:string? submission_age_days:long? "
        "days_since_update:long? next_actor:string? next_action:string? issue_url:string?"
    ),
    "reviewer_workload": _schema("reviewer:string? unresolved_count:long?"),
}
