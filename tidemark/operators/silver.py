"""Bronze pages to typed submissions: one row per submission and run."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.functions.nested import field_value, resolve_milestone, reviewer_logins
from tidemark.functions.text import has_milestone_prefix
from tidemark.functions.timing import elapsed_days, to_instant
from tidemark.schemas import BoardRules
from tidemark.sources.landing import checked_pages, decode_pages


def page_nodes() -> Column:
    """The board items of a decoded page; a board belongs to an organization or a user."""
    data = F.col("page.data")
    return F.coalesce(
        *(data[owner]["projectV2"]["items"]["nodes"] for owner in schemas.OWNER_TYPES)
    )


def unnest_nodes(decoded: DataFrame) -> DataFrame:
    """One row per board item.

    A page without items fails the job: leaving it out would lose submissions unseen.
    """
    complaint = F.raise_error(F.lit("Bronze page holds no project items"))
    nodes = F.coalesce(page_nodes(), complaint)
    return decoded.select("run_id", "extracted_at", F.explode(nodes).alias("node"))


def issues_only(nodes: DataFrame) -> DataFrame:
    """Board items that are issues; drafts and pull requests have no content id."""
    return nodes.filter(F.col("node.content.id").isNotNull())


def non_issue_counts(nodes: DataFrame) -> DataFrame:
    """Per run: board items left out by :func:`issues_only`."""
    return nodes.groupBy("run_id").agg(
        F.count_if(F.col("node.content.id").isNull()).alias("non_issue_count")
    )


def flatten_nodes(nodes: DataFrame) -> DataFrame:
    """The ten source attributes as columns, arrays still nested."""
    content = F.col("node.content")
    return nodes.select(
        "run_id",
        "extracted_at",
        content["id"].alias("issue_id"),
        content["title"].alias("issue_title"),
        content["url"].alias("issue_url"),
        content["author"]["login"].alias("issue_author"),
        content["createdAt"].alias("created_at"),
        content["updatedAt"].alias("updated_at"),
        content["state"].alias("state"),
        content["assignees"]["nodes"].alias("assignees"),
        content["labels"]["nodes"].alias("labels"),
        F.col("node.fieldValues.nodes").alias("field_values"),
    )


def resolve_attributes(flat: DataFrame) -> DataFrame:
    """Reviewer list, milestone and status out of the nested arrays."""
    return flat.withColumns(
        {
            "reviewer": reviewer_logins(F.col("assignees")),
            "milestone": resolve_milestone(F.col("issue_title"), F.col("labels")),
            "status": field_value(F.col("field_values"), "Status"),
        }
    ).drop("assignees", "labels", "field_values")


def not_excluded(author: Column, excluded: Sequence[str]) -> Column:
    """True unless the author is listed; an unknown author is kept."""
    return author.isNull() | ~author.isin(*excluded)


def exclude_authors(rows: DataFrame, excluded: DataFrame, column: str = "issue_author") -> DataFrame:
    """The same filter for an exclusion list kept as a table of any size."""
    names = excluded.select(F.col(excluded.columns[0]).alias(column))
    return rows.join(names, column, "left_anti").select(*rows.columns)


def standardise_times(rows: DataFrame) -> DataFrame:
    return rows.withColumns({c: to_instant(F.col(c)) for c in schemas.DATE_ROLES})


def add_measures(rows: DataFrame) -> DataFrame:
    """Assignment flag and whole days since update and creation."""
    return rows.withColumns(
        {
            "is_assigned": F.size("reviewer") > 0,
            "days_since_update": elapsed_days(F.col("extracted_at"), F.col("updated_at")),
            "submission_age_days": elapsed_days(F.col("extracted_at"), F.col("created_at")),
        }
    )


def keep_latest(rows: DataFrame) -> DataFrame:
    """Newest submission per run, author and milestone; unknown authors form one group.

    The ``= 1`` filter lets Spark cut each group to one row per task before the shuffle,
    so a group holding much of the data does not reach a single task.
    """
    newest_first = W.partitionBy("run_id", "issue_author", "milestone").orderBy(
        F.col("created_at").desc_nulls_last(),
        F.col("updated_at").desc_nulls_last(),
        F.col("issue_id").desc(),
    )
    return (
        rows.withColumn("recency", F.row_number().over(newest_first))
        .filter(F.col("recency") == 1)
        .drop("recency")
    )


def to_silver(
    bronze: DataFrame, rules: BoardRules = BoardRules(), unreadable: Observation | None = None
) -> DataFrame:
    """Bronze pages of any number of runs to silver rows, in one pass and one shuffle.

    A page that can't be read fails the job. With ``unreadable`` it is left out, and once
    the rows have been written the observation has the ``runs`` that hold such pages.
    """
    if unreadable is None:
        decoded = decode_pages(bronze)
    else:
        bad = F.col("is_malformed") | page_nodes().isNull()
        # At most one value per pending run.
        runs = F.collect_set(F.when(bad, F.col("run_id"))).alias("runs")
        decoded = checked_pages(bronze).withColumn("is_bad", bad).observe(unreadable, runs)
        decoded = decoded.filter(~F.col("is_bad"))
    rows = resolve_attributes(flatten_nodes(issues_only(unnest_nodes(decoded))))
    kept = rows.filter(
        not_excluded(F.col("issue_author"), rules.excluded_authors)
        & has_milestone_prefix(F.col("issue_title"))
    )
    # Measures last: what the shuffle does not need is not carried through it.
    return add_measures(keep_latest(standardise_times(kept))).select(*schemas.SILVER.columns)


def run_verdicts(rows: DataFrame) -> DataFrame:
    """Per run of silver rows: ``row_count, extracted_at``, and why it can't be loaded, or null.

    Counted per submission first, so that no run is gathered as a whole.
    """
    spec = schemas.SILVER
    nulls = F.greatest(*(F.col(c).isNull().cast("int") for c in spec.required))
    per_key = rows.groupBy(*spec.unique[0]).agg(
        F.count("*").alias("n"),
        F.max(nulls).alias("nulls"),
        F.min("extracted_at").alias("first"),
        F.max("extracted_at").alias("last"),
    )
    problem = (
        F.when(F.max("nulls") > 0, f"{spec.name} has nulls")
        .when(F.max("n") > 1, f"{spec.name} has duplicate keys")
        .when(F.min("first") < F.max("last"), "the run has several extraction times")
    )
    return per_key.groupBy("run_id").agg(
        F.min("first").alias("extracted_at"), F.sum("n").alias("row_count"), problem.alias("problem")
    )
