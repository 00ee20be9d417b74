from __future__ import annotations

import random
from collections import Counter
from datetime import date, datetime, timedelta

import pytest
from boards import utc
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.operators import decisions
from tidemark.operators.snapshots import (
    Mart,
    as_of,
    current_submissions,
    expected_milestone,
    with_reviewer_names,
)
from tidemark.plans import metrics, views

LATEST = utc("2026-08-17T02:00:00")
EARLIER = utc("2026-08-10T02:00:00")
STATUSES = ("Unchecked/Unassigned", "In review", "Needs Improvement", "Passed", "Mystery")

# builder, milestone number, status, state, days since update
CURRENT = [
    ("unreviewed", 3, "Unchecked/Unassigned", "OPEN", 1),
    ("waiting", 3, "Unchecked/Unassigned", "OPEN", 2),
    ("reviewing", 3, "In review", "OPEN", 3),
    ("revising", 1, "Needs Improvement", "OPEN", 4),
    ("advancing", 4, "Passed", "CLOSED", 5),
    ("finished", 6, "Passed", "OPEN", 6),
    ("missing", 2, None, "OPEN", 7),
    ("mystery", 2, "Mystery", "OPEN", 9),
    ("reopen", 2, "In review", "closed", 8),
    (None, 6, "Passed", "OPEN", 1),
]
ASSIGNED = {"waiting": ["zeta", "alpha"], "reviewing": ["alpha"], "reopen": ["alpha"]}


def mart_of(spark, rows, assigned=(), milestones=7):
    """Rows ``(key, issue_key, builder, number, status, state, days, extracted_at)``."""
    statuses = {s: i for i, s in enumerate(STATUSES, start=1)}
    states = {"OPEN": 1, "CLOSED": 2, "closed": 3}
    reviewers = {"alpha": 1, "zeta": 2}
    fact = [
        (key, "run", issue, states[state], statuses.get(status), number + 1, 1, 1, 1, EARLIER, EARLIER,
         at, True, days, days, at.date())
        for key, issue, _, number, status, state, days, at in rows
    ]
    issues = {issue: builder for _, issue, builder, *_ in rows}
    deadlines = list(schemas.MILESTONE_DEADLINES.values())
    frame = lambda data, spec: spark.createDataFrame(data, spec.table.schema)
    return Mart(
        fact=spark.createDataFrame(fact, schemas.FACT.schema),
        bridge=spark.createDataFrame(
            [(key, reviewers[name], LATEST.date()) for key, name in assigned], schemas.BRIDGE.schema
        ),
        dim_issue=frame(
            [(i, f"id-{i}", "t", f"https://example.com/{i}", b) for i, b in issues.items()], schemas.DIM_ISSUE
        ),
        dim_reviewer=frame([(k, n) for n, k in reviewers.items()], schemas.DIM_REVIEWER),
        dim_state=frame([(k, n) for n, k in states.items()], schemas.DIM_STATE),
        dim_status=frame([(k, n) for n, k in statuses.items()], schemas.DIM_STATUS),
        dim_milestone=frame(
            [(n + 1, f"M{n}", n, deadlines[n] if n < 7 else None) for n in range(milestones)],
            schemas.DIM_MILESTONE,
        ),
    )


@pytest.fixture(scope="module")
def mart(spark):
    rows = [
        (i, 100 + i, builder, number, status, state, days, LATEST)
        for i, (builder, number, status, state, days) in enumerate(CURRENT, start=1)
    ]
    keys = {builder: key for key, _, builder, *_ in rows}
    # An older milestone of one builder, and one only seen in the earlier extraction.
    rows.append((20, 120, "advancing", 2, "In review", "OPEN", 1, LATEST))
    rows.append((21, 121, "gone", 6, "Passed", "OPEN", 1, EARLIER))
    assigned = [(keys[builder], name) for builder, names in ASSIGNED.items() for name in names]
    return mart_of(spark, rows, assigned)


@pytest.fixture(scope="module")
def queue(mart):
    return metrics.validated_metric(mart, "interventions").toPandas()


def test_as_of_and_expected_milestone(mart):
    row = as_of(mart).first()
    assert row["as_of_date"] == date(2026, 8, 17)
    assert row["extracted_at"] == datetime(2026, 8, 17, 2)
    assert expected_milestone(mart).first()["milestone_number"] == 3


def test_after_the_last_deadline_the_highest_milestone_is_expected(spark):
    rows = [(1, 1, "a", 0, "Passed", "OPEN", 1, LATEST + timedelta(days=900))]
    assert expected_milestone(mart_of(spark, rows)).first()["milestone_number"] == 6
    # An unconfigured milestone counts for the fallback although it has no deadline.
    assert expected_milestone(mart_of(spark, rows, milestones=8)).first()["milestone_number"] == 7


def test_every_decision(queue):
    steps = {r.builder: (r.next_actor, r.next_action) for r in queue.itertuples()}
    assert steps == {
        "unreviewed": ("Program admin", "Assign a reviewer"),
        "waiting": ("Reviewer", "Start review"),
        "reviewing": ("Reviewer", "Complete review"),
        "revising": ("Builder", "Revise and resubmit"),
        "advancing": ("Builder", "Begin next milestone"),
        "finished": ("None", "Program complete"),
        "missing": ("Program admin", "Verify submission status"),
        "mystery": ("Program admin", "Verify submission status"),
        "reopen": ("Program admin", "Verify or reopen unresolved issue"),
    }


def test_queue_order_labels_and_reviewers(queue):
    assert list(queue.builder) == [
        "mystery", "reopen", "missing", "revising", "reviewing", "waiting", "unreviewed", "advancing", "finished",
    ]
    by_builder = queue.set_index("builder")
    assert by_builder.reviewer["waiting"] == "alpha, zeta"
    assert by_builder.reviewer["missing"] == "Unassigned"
    assert by_builder.status["missing"] == "Unknown"
    assert by_builder.schedule_status["revising"] == "Delayed"
    assert by_builder.schedule_status["missing"] == "On track"
    assert by_builder.current_milestone["advancing"] == "M4"


def test_current_submission_tie_breaks(spark):
    rows = [
        (1, 7, "tie", 2, "Passed", "OPEN", 1, LATEST),
        (2, 9, "tie", 2, "In review", "OPEN", 1, LATEST),
        (3, 8, "tie", 2, "Mystery", "OPEN", 1, LATEST),
    ]
    assert current_submissions(mart_of(spark, rows)).first()["issue_key"] == 9


def test_one_builder_with_a_third_of_all_submissions(spark):
    rng = random.Random(7)
    rows = []
    for key in range(1, 1501):
        builder = "hot" if key % 3 == 0 else f"b{rng.randrange(40)}"
        rows.append((key, rng.randrange(10**6), builder, rng.randrange(7), rng.choice(STATUSES), "OPEN", 1, LATEST))
    rows = list({row[1]: row for row in rows}.values())
    assigned = [(row[0], name) for row in rows for name in ("alpha", "zeta") if rng.random() < 0.5]
    mart = mart_of(spark, rows, assigned)
    best = {}
    for row in rows:
        if row[2] not in best or (row[3], row[1]) > (best[row[2]][3], best[row[2]][1]):
            best[row[2]] = row
    found = {r["builder"]: r["submission_snapshot_key"] for r in current_submissions(mart).collect()}
    assert found == {builder: row[0] for builder, row in best.items()}

    expected = Counter()
    for row in best.values():
        if row[4] != "Passed":
            expected.update([n for k, n in assigned if k == row[0]] or ["Unassigned"])
    assert {r[0]: r[1] for r in metrics.reviewer_workload(mart).collect()} == dict(expected)


def test_workload_counts_a_submission_for_each_reviewer(mart):
    rows = [tuple(r) for r in metrics.validated_metric(mart, "reviewer_workload").collect()]
    assert rows == [("Unassigned", 4), ("alpha", 2), ("zeta", 1)]


def test_distribution_is_a_full_grid_in_order(mart):
    rows = metrics.validated_metric(mart, "submission_status").collect()
    assert len(rows) == 7 * 5
    assert [r["milestone"] for r in rows[::5]] == [f"M{n}" for n in range(7)]
    counts = {(r["milestone"], r["status"]): r["submission_count"] for r in rows}
    # Unknown authors count here, a missing status does not, nor does an earlier extraction.
    assert counts[("M6", "Passed")] == 2 and counts[("M2", "In review")] == 2
    assert counts[("M0", "Passed")] == 0 and sum(counts.values()) == 10


def test_schedule_shares(mart):
    rows = {r["schedule_status"]: tuple(r)[1:] for r in metrics.validated_metric(mart, "builder_schedule").collect()}
    assert rows == {"Delayed": (1, 11.11), "On track": (8, 88.89)}


def test_progress_per_extraction(mart):
    rows = metrics.progress_trend(mart).collect()
    assert [(r["extraction_date"], r["average_completion_percentage"], r["observed_builder_count"]) for r in rows] == [
        (date(2026, 8, 10), 14.29, 1),
        (date(2026, 8, 17), round(100 * 2 / (9 * 7), 2), 9),
    ]
    assert metrics.validated_metric(mart, "progress_trend").columns == ["extraction_date", "completion_rate"]


def test_progress_counts_a_milestone_once_and_survives_no_milestones(spark):
    rows = [(1, 1, "a", 0, "Passed", "OPEN", 1, LATEST), (2, 2, "a", 0, "Passed", "OPEN", 1, LATEST)]
    assert metrics.progress_trend(mart_of(spark, rows)).first()["average_completion_percentage"] == 14.29
    assert metrics.progress_trend(mart_of(spark, rows, milestones=0)).first()["average_completion_percentage"] is None


def test_empty_mart(spark):
    empty = mart_of(spark, [])
    assert metrics.interventions(empty).count() == 0
    assert metrics.builder_schedule(empty).count() == 0
    assert metrics.submission_distribution(empty).agg(F.sum("submission_count")).first()[0] == 0


def test_shares_add_up(spark):
    counts = spark.createDataFrame([("a", 1), ("b", 1), ("c", 1)], "k string, n long")
    total = metrics.share_of_total(counts, "n", "share").agg(F.sum("share")).first()[0]
    assert abs(total - 100) <= 0.02


def test_unknown_metric(mart):
    with pytest.raises(KeyError, match="nothing"):
        metrics.metric(mart, "nothing")


def test_milestones_behind_is_never_negative(spark):
    rows = spark.createDataFrame([(2, 5), (6, 5), (None, 5)], "h int, e int")
    behind = rows.select(decisions.milestones_behind(F.col("h"), F.col("e")).alias("b"))
    assert [r["b"] for r in behind.collect()] == [3, 0, 0]


# --- Presentation ---------------------------------------------------------------------------


def test_status_pivot_order_and_zeros(spark):
    data = [("M2", "Zebra", 4), ("M2", "In review", 3), ("M9", "In review", 8), ("M0", "Passed", 1)]
    table = views.status_pivot(spark.createDataFrame(data, "milestone string, status string, submission_count long"))
    rows = table.collect()
    assert [r["status"] for r in rows] == ["Passed", "In review", "Zebra"]
    assert [rows[1][f"M{n}"] for n in range(7)] == [0, 0, 3, 0, 0, 0, 0]
    assert [r["other"] for r in rows] == [0, 8, 0]


def test_progress_axis(spark):
    schema = "extraction_date date, completion_rate double"
    low = spark.createDataFrame([(date(2026, 8, 2), 20.0), (date(2026, 8, 1), 30.0)], schema)
    assert [tuple(r) for r in views.progress_series(low).collect()] == [
        (date(2026, 8, 1), 30.0, 100.0),
        (date(2026, 8, 2), 20.0, 100.0),
    ]
    high = spark.createDataFrame([(date(2026, 8, 2), 95.0)], schema)
    assert views.progress_series(high).first()["axis_max"] == 105.0


def test_schedule_cards(spark):
    schema = "schedule_status string, builder_count long, builder_percentage double"
    cards = views.schedule_kpis(spark.createDataFrame([("ON TRACK", 5, 62.5)], schema)).collect()
    assert [(c["label"], c["value"], c["detail"], c["tone"]) for c in cards] == [
        ("On track", 5, "62% of builders", "success"),
        ("Delayed", 0, "No builder data", "danger"),
    ]


def test_workload_tables(spark):
    schema = "reviewer string, unresolved_count long"
    rows = spark.createDataFrame([("bo", 2), ("Unassigned", 3), ("al", 2)], schema)
    assert [tuple(r) for r in views.workload_series(rows).collect()] == [
        ("al", 2, False), ("bo", 2, False), ("Unassigned", 3, True),
    ]
    assert tuple(views.workload_kpis(rows).first()) == (7, 3, 2)
    assert tuple(views.workload_kpis(rows.limit(0)).first()) == (0, 0, 0)


def test_queue_views(mart):
    data = metrics.metric(mart, "interventions")
    assert {r["builder"] for r in views.queue_filter(data, search=" ALPHA ").collect()} == {"waiting", "reviewing", "reopen"}
    assert {r["builder"] for r in views.queue_filter(data, "alpha", "in review", "On Track").collect()} == {"reviewing", "reopen"}
    assert views.queue_filter(data).count() == 9
    choices = [tuple(r) for r in views.facets(data).collect()]
    assert choices[:2] == [("schedule_status", "Delayed", 1), ("schedule_status", "On track", 8)]
    shown = {r["builder"]: r for r in views.display_columns(data).collect()}
    assert (shown["reopen"]["status_slug"], shown["reopen"]["state_label"]) == ("in-review", "Closed")
    assert shown["mystery"]["updated_label"] == "9 days ago"


def test_interventions_gather_names_of_current_submissions_only(spark, capsys):
    """Assignments are joined before they are aggregated."""
    rows = spark.createDataFrame([(1, "x"), (2, "y"), (3, None)], "submission_snapshot_key long, builder string")
    named = spark.createDataFrame(
        [(1, "b"), (1, "a"), (1, "b"), (3, None), (9, "z")], "submission_snapshot_key long, reviewer string"
    )
    found = with_reviewer_names(rows, named)
    assert sorted(map(tuple, found.collect())) == [(1, "x", "a, b", 2), (2, "y", None, None), (3, None, None, None)]
    found.explain("simple")
    plan = capsys.readouterr().out
    assert plan.index("Aggregate") < plan.index("Join")
