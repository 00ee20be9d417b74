"""Small boards for the tests: nodes, pages, silver rows and a hand-made mart."""

from __future__ import annotations

import json
from datetime import datetime, timezone

from tidemark import schemas


def utc(text: str) -> datetime:
    return datetime.fromisoformat(text).replace(tzinfo=timezone.utc)


def node(
    issue_id,
    title="[M2] Example",
    author="ada",
    created="2026-08-01T00:00:00Z",
    updated="2026-08-02T00:00:00Z",
    state="OPEN",
    assignees=(),
    labels=(),
    status="In review",
):
    """One board item as the source would send it."""
    return {
        "content": {
            "id": issue_id,
            "title": title,
            "url": f"https://example.com/{issue_id}",
            "author": {"login": author} if author else None,
            "createdAt": created,
            "updatedAt": updated,
            "state": state,
            "assignees": {"nodes": list(assignees)},
            "labels": {"nodes": list(labels)},
        },
        "fieldValues": {
            "nodes": [{}, None, {"name": status, "field": {"name": "Status"}}]
        },
    }


def page(*nodes, owner="organization", has_next=False, end_cursor=None):
    items = {
        "nodes": list(nodes),
        "pageInfo": {"hasNextPage": has_next, "endCursor": end_cursor},
    }
    return {"data": {owner: {"projectV2": {"items": items}}}}


def bronze(spark, *pages, run_id="run-1", attempt=1, extracted_at="2026-08-05T00:00:00"):
    rows = [
        (run_id, attempt, utc(extracted_at), number, json.dumps(body, ensure_ascii=False))
        for number, body in enumerate(pages, start=1)
    ]
    return spark.createDataFrame(rows, schemas.RAW_EXTRACTIONS.schema)


def silver_row(issue_id="issue-1", **changes):
    row = {
        "issue_id": issue_id,
        "issue_title": "[M2] Example submission",
        "issue_url": f"https://example.com/{issue_id}",
        "issue_author": "builder",
        "created_at": utc("2026-08-01T00:00:00"),
        "updated_at": utc("2026-08-02T00:00:00"),
        "state": "OPEN",
        "reviewer": ["alice", "bob", "alice"],
        "milestone": "M2",
        "status": "In review",
        "run_id": "run-1",
        "extracted_at": utc("2026-08-03T00:00:00"),
        "is_assigned": True,
        "days_since_update": 1,
        "submission_age_days": 2,
    }
    row.update(changes)
    return row


def silver(spark, *rows):
    ordered = [tuple(row[c] for c in schemas.SILVER.columns) for row in rows]
    return spark.createDataFrame(ordered, schemas.SILVER.schema)


def second_run(row, **changes):
    return {**row, "run_id": "run-2", "extracted_at": utc("2026-08-10T00:00:00"), **changes}
