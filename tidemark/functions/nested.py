"""Look-ups inside the nested arrays of a landed node."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.text import LABEL_MILESTONE, titled_milestone


def reviewer_logins(assignees: Column) -> Column:
    """Logins in listed order. A present assignee without login stays as null."""
    return F.coalesce(
        F.transform(F.filter(assignees, lambda a: a.isNotNull()), lambda a: a["login"]),
        F.array().cast("array<string>"),
    )


def label_milestone(labels: Column) -> Column:
    """First label that is exactly ``M<digits>``, or null."""
    matching = F.filter(labels, lambda label: label["name"].rlike(LABEL_MILESTONE))
    return F.try_element_at(matching, F.lit(1))["name"]


def resolve_milestone(title: Column, labels: Column) -> Column:
    """Milestone of a submission: a label wins over the title."""
    return F.coalesce(label_milestone(labels), titled_milestone(title))


def field_value(values: Column, field_name: str) -> Column:
    """``name`` of the first field value whose field is called ``field_name``."""
    matching = F.filter(values, lambda v: v["field"]["name"] == F.lit(field_name))
    return F.try_element_at(matching, F.lit(1))["name"]
