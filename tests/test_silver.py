from __future__ import annotations

import pytest
from boards import bronze, node, page

from tidemark import schemas
from tidemark.operators import silver
from tidemark.operators.silver import to_silver
from tidemark.plans.jobs import Pipeline, StageError
from tidemark.sources import landing


def rows_by_issue(frame):
    return {row["issue_id"]: row for row in frame.collect()}


def test_pages_are_read_together_and_typed(spark):
    pages = bronze(
        spark,
        page(node("a", author="ada", assignees=[{"login": "rex"}]), has_next=True, end_cursor="c"),
        page(node("b", author="bo", title="[M3] Ünïcode")),
    )
    result = to_silver(pages)
    assert result.columns == schemas.SILVER.columns
    rows = rows_by_issue(result)
    assert set(rows) == {"a", "b"}
    assert rows["a"]["reviewer"] == ["rex"] and rows["a"]["is_assigned"]
    assert rows["b"]["reviewer"] == [] and not rows["b"]["is_assigned"]
    assert rows["b"]["issue_title"] == "[M3] Ünïcode"
    assert (rows["a"]["days_since_update"], rows["a"]["submission_age_days"]) == (3, 4)


def test_newest_per_author_and_milestone_wins_across_pages(spark):
    pages = bronze(
        spark,
        page(node("old", created="2026-07-01T00:00:00Z"), node("other", title="[M1] x")),
        page(node("new", created="2026-07-20T00:00:00Z")),
    )
    assert set(rows_by_issue(to_silver(pages))) == {"new", "other"}


def test_unknown_authors_form_one_group_and_are_not_excluded(spark):
    pages = bronze(
        spark,
        page(
            node("n1", author=None, created="2026-07-01T00:00:00Z"),
            node("n2", author=None, created="2026-07-02T00:00:00Z"),
            node("gone", author="staff"),
        ),
    )
    rows = rows_by_issue(to_silver(pages, schemas.BoardRules(excluded_authors=("staff",))))
    assert set(rows) == {"n2"} and rows["n2"]["issue_author"] is None


def test_milestone_rules(spark):
    pages = bronze(
        spark,
        page(
            node("label", author="a", title="[M2] t", labels=[None, {"name": "bug"}, {"name": "M5"}, {"name": "M6"}]),
            node("title", author="b", title="[M4] t [M1]", labels=[{"name": "M2x"}]),
            node("not-first", author="c", title="About [M2]"),
            node("untitled", author="d", title=None, labels=[{"name": "M2"}]),
        ),
    )
    rows = rows_by_issue(to_silver(pages))
    assert {k: r["milestone"] for k, r in rows.items()} == {"label": "M5", "title": "M4"}


def test_status_is_the_first_status_field(spark):
    item = node("a")
    item["fieldValues"]["nodes"] = [
        {"name": "High", "field": {"name": "Priority"}},
        {"name": "Passed", "field": {"name": "Status"}},
        {"name": "In review", "field": {"name": "Status"}},
    ]
    none = node("b", author="bo")
    none["fieldValues"]["nodes"] = []
    rows = rows_by_issue(to_silver(bronze(spark, page(item, none))))
    assert (rows["a"]["status"], rows["b"]["status"]) == ("Passed", None)


def test_items_that_are_not_issues_and_empty_assignees(spark):
    draft = {"content": {}, "fieldValues": {"nodes": []}}
    pages = bronze(spark, page(draft, node("a", assignees=[None, {"login": None}])))
    rows = rows_by_issue(to_silver(pages))
    assert rows["a"]["reviewer"] == [None] and rows["a"]["is_assigned"]
    nodes = silver.unnest_nodes(landing.decode_pages(pages))
    assert silver.non_issue_counts(nodes).first()["non_issue_count"] == 1


def test_user_boards_are_read_too(spark):
    assert set(rows_by_issue(to_silver(bronze(spark, page(node("a"), owner="user"))))) == {"a"}


def test_times_are_floored_and_days_round_down(spark):
    pages = bronze(
        spark,
        page(node("a", created="2026-08-04T00:00:01.900Z", updated="2026-08-06T01:00:00+08:00")),
        extracted_at="2026-08-05T00:00:00.700000",
    )
    row = to_silver(pages).first()
    assert row["created_at"].microsecond == 0 and row["extracted_at"].microsecond == 0
    assert (row["days_since_update"], row["submission_age_days"]) == (-1, 0)


def test_several_runs_stay_apart(spark):
    both = bronze(spark, page(node("a"))).unionByName(
        bronze(spark, page(node("a")), run_id="run-2", extracted_at="2026-08-06T00:00:00")
    )
    ages = {(r["run_id"], r["submission_age_days"]) for r in to_silver(both).collect()}
    assert ages == {("run-1", 4), ("run-2", 5)}


def test_loading_rejects_wrong_columns(spark, warehouse):
    rows = to_silver(bronze(spark, page(node("a"))))
    wrong = rows.drop("status").withColumn("surprise", rows["state"])
    with pytest.raises(StageError, match=r"lacking \['status'\], beyond it \['surprise'\]"):
        Pipeline(warehouse).load_silver(wrong)
    assert warehouse.read("silver.issue_submissions").isEmpty()
    assert warehouse.read("ops.stage_failures").first()["error_stage"] == "silver_load"


def test_loading_rejects_duplicates_nulls_and_reloads(spark, warehouse):
    pipeline = Pipeline(warehouse)
    rows = to_silver(bronze(spark, page(node("a"))))
    with pytest.raises(StageError, match="duplicate keys"):
        pipeline.load_silver(rows.unionByName(rows))
    pipeline.load_silver(rows)
    with pytest.raises(StageError, match="already has the run"):
        pipeline.load_silver(rows)
    assert warehouse.read("silver.issue_submissions").count() == 1


def test_malformed_payloads_fail_or_are_set_aside(spark):
    good = bronze(spark, page(node("a")))
    bad = good.selectExpr("run_id", "attempt_number", "extracted_at", "page_no + 1 AS page_no", "'{oops' AS payload")
    both = good.unionByName(bad)
    with pytest.raises(Exception, match="MALFORMED_RECORD|Malformed"):
        landing.decode_pages(both).select("page").collect()
    decoded, rejected = landing.quarantine_pages(both)
    assert decoded.count() == 1
    assert [r["payload"] for r in rejected.collect()] == ["{oops"]


def test_exclusion_by_table_keeps_unknown_authors(spark):
    rows = spark.createDataFrame([("x", "a"), ("y", None), ("z", "b")], "id string, issue_author string")
    listed = spark.createDataFrame([("a",), (None,)], "name string")
    kept = silver.exclude_authors(rows, listed)
    assert {r["id"] for r in kept.collect()} == {"y", "z"}


def test_hot_group_is_cut_before_the_shuffle(spark):
    rows = to_silver(bronze(spark, page(node("a"))))
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2 and plan.count("Exchange hashpartitioning") == 1


def test_a_page_without_items_is_not_passed_over(spark):
    pages = bronze(spark, page(node("a")), {"data": {"organization": None}})
    with pytest.raises(Exception, match="no project items"):
        to_silver(pages).collect()
