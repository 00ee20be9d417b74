"""The test tables read as a board: one order is one submission per snapshot.

``FIXTURES.md`` section 3 gives the mapping. An order exists in every snapshot taken on
or after its order date; its reviewers are the suppliers of the items shipped by then.
"""

from __future__ import annotations

from datetime import date, datetime, timezone
from math import ceil

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.operators.silver import add_measures
from tidemark.schemas import BoardRules
from tidemark.session import scratch_path, settings
from tidemark.sources.landing import compact_json

# Fixed values of the mapping.
SNAPSHOTS = (
    datetime(1998, 12, 31, 16, 30, tzinfo=timezone.utc),
    datetime(2000, 6, 30, 16, 30, tzinfo=timezone.utc),
    datetime(2001, 8, 2, 16, 30, tzinfo=timezone.utc),
)
STATUS_BY_PRIORITY = {
    "1-URGENT": schemas.STATUS_UNCHECKED,
    "2-HIGH": schemas.STATUS_IN_REVIEW,
    "3-MEDIUM": schemas.STATUS_NEEDS_IMPROVEMENT,
    "5-LOW": schemas.STATUS_PASSED,
}
FIRST_YEAR = 1995
PAGE_SIZE = 100
#: Some 30 MB of submissions, three snapshots of each order together.
ORDERS_PER_TASK = 25_000

RULES = BoardRules(
    deadlines={f"M{n}": date(FIRST_YEAR + n, 12, 31) for n in range(7)},
    excluded_authors=("Customer#000000007", "Customer#000000011"),
)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _snapshots_since(ordered_at: Column) -> Column:
    """The snapshots in which an order placed at this time exists."""
    taken = F.array(*(F.lit(at) for at in SNAPSHOTS))
    return F.filter(taken, lambda at: at >= ordered_at)


def _block(order_key: str) -> Column:
    """The block of order keys that makes a page."""
    return F.floor(F.col(order_key) / PAGE_SIZE)


def shipped_items(spark: SparkSession, folder: str, block_tasks: int | None = None) -> DataFrame:
    """Per order: each supplier with its first shipping date, and the last date per snapshot.

    Items are shuffled once, by order; everything after that, the join with the orders too,
    finds its rows in place. With ``block_tasks`` they are dealt to so many tasks by ``block``.
    """
    shipped = F.col("l_shipdate").cast("timestamp")
    last = {f"last_{i}": at for i, at in enumerate(SNAPSHOTS)}
    items = table(spark, folder, "lineitem").select("l_orderkey", "l_suppkey", "l_shipdate")
    place = ["block"] if block_tasks else []
    if block_tasks:
        items = items.withColumn("block", _block("l_orderkey")).repartition(block_tasks, "block")
    else:
        items = items.repartition("l_orderkey")
    per_supplier = (
        items.groupBy(*place, "l_orderkey", "l_suppkey")
        .agg(
            F.min(shipped).alias("first_shipped"),
            *(F.max(F.when(shipped <= F.lit(at), shipped)).alias(c) for c, at in last.items()),
        )
    )
    suppliers = table(spark, folder, "supplier").select("s_suppkey", "s_name")
    named = per_supplier.join(suppliers, F.col("l_suppkey") == F.col("s_suppkey"))
    return named.groupBy(*place, F.col("l_orderkey").alias("o_orderkey")).agg(
        F.collect_list(F.struct("s_name", "first_shipped")).alias("suppliers"),
        F.array(*(F.max(c) for c in last)).alias("last_shipped"),
    )


def board_submissions(
    spark: SparkSession, folder: str, block_tasks: int | None = None
) -> DataFrame:
    """Submissions in silver columns before measures, plus ``o_orderkey``.

    With ``block_tasks`` also ``block``: the orders of one block of keys are in one task then,
    and are dealt to so many tasks before they are joined with their items.
    """
    customers = table(spark, folder, "customer").select("c_custkey", "c_name")
    orders = table(spark, folder, "orders").withColumn(
        "created_at", F.col("o_orderdate").cast("timestamp")
    )
    items = shipped_items(spark, folder, block_tasks)
    is_customer = F.col("o_custkey") == F.col("c_custkey")
    place = ["block"] if block_tasks else []
    if block_tasks:
        # Customers first, while the rows are narrow: their join may shuffle by customer.
        orders = orders.join(customers, is_customer, "left").withColumn("block", _block("o_orderkey"))
        rows = orders.repartition(block_tasks, "block").join(items, ["block", "o_orderkey"], "left")
    else:
        rows = orders.join(items, "o_orderkey", "left").join(customers, is_customer, "left")
    # Orders are joined once and only then repeated per snapshot.
    rows = rows.withColumn("extracted_at", F.explode(_snapshots_since(F.col("created_at"))))
    known = F.create_map(*(F.lit(x) for pair in STATUS_BY_PRIORITY.items() for x in pair))
    mystery = F.when(F.col("o_orderkey") % 2 == 0, "Mystery")
    number = F.year("created_at") - FIRST_YEAR
    visible = F.filter("suppliers", lambda s: s["first_shipped"] <= F.col("extracted_at"))
    snapshot_no = F.array_position(
        F.array(*(F.lit(at) for at in SNAPSHOTS)), F.col("extracted_at")
    ).cast("int")
    last_shipped = F.element_at("last_shipped", snapshot_no)
    key = F.col("o_orderkey").cast("string")
    milestone = F.concat(F.lit("M"), number.cast("string"))
    return rows.select(
        *place,
        "o_orderkey",
        key.alias("issue_id"),
        F.concat(F.lit("["), milestone, F.lit("] order "), key).alias("issue_title"),
        F.concat(F.lit("https://example.test/"), key).alias("issue_url"),
        F.when(F.col("o_custkey") % 50 != 0, F.col("c_name")).alias("issue_author"),
        "created_at",
        F.greatest(F.col("created_at"), last_shipped).alias("updated_at"),
        F.when(F.col("o_orderstatus") == "F", "CLOSED").otherwise("OPEN").alias("state"),
        F.coalesce(
            F.array_sort(F.transform(visible, lambda s: s["s_name"])),
            F.array().cast("array<string>"),
        ).alias("reviewer"),
        milestone.alias("milestone"),
        F.coalesce(F.try_element_at(known, "o_orderpriority"), mystery).alias("status"),
        F.concat(F.lit("run-"), F.year("extracted_at").cast("string")).alias("run_id"),
        "extracted_at",
    )


def board_silver(spark: SparkSession, folder: str) -> DataFrame:
    """The submissions as silver rows, all kept."""
    return add_measures(board_submissions(spark, folder)).select(*schemas.SILVER.columns)


def board_pages(spark: SparkSession, folder: str, by_block: bool = False) -> DataFrame:
    """The same submissions as landed JSON pages of at most ``PAGE_SIZE`` items.

    ``run_id, attempt_number, extracted_at, page_no, request_cursor, body``. A page holds
    the orders of one block of keys, so that no run is ever gathered as a whole. With
    ``by_block``, for :func:`store_pages`, orders and items are shuffled by block, so that
    submissions, which are many times as large, are not.
    """
    tasks = None
    if by_block:
        # Shuffled bytes don't tell Spark how large the pages of a task get.
        tasks = max(1, ceil(table(spark, folder, "orders").count() / ORDERS_PER_TASK))
    iso = "yyyy-MM-dd'T'HH:mm:ss'Z'"
    text = F.lit(None).cast("string")
    node = F.struct(
        F.struct(
            F.col("issue_id").alias("id"),
            F.col("issue_title").alias("title"),
            F.col("issue_url").alias("url"),
            F.when(
                F.col("issue_author").isNotNull(), F.struct(F.col("issue_author").alias("login"))
            ).alias("author"),
            F.date_format("created_at", iso).alias("createdAt"),
            F.date_format("updated_at", iso).alias("updatedAt"),
            "state",
            F.struct(
                F.transform("reviewer", lambda name: F.struct(name.alias("login"))).alias("nodes")
            ).alias("assignees"),
            # Odd orders carry no milestone label and rely on their title.
            F.struct(
                F.when(
                    F.col("o_orderkey") % 2 == 0,
                    F.array(
                        F.struct(F.lit("board").alias("name")),
                        F.struct(F.col("milestone").alias("name")),
                    ),
                )
                .otherwise(F.array(F.struct(F.lit("board").alias("name"))))
                .alias("nodes")
            ).alias("labels"),
        ).alias("content"),
        F.struct(
            F.array(
                F.struct(text.alias("name"), F.struct(F.lit("Title").alias("name")).alias("field")),
                F.struct(
                    F.col("status").alias("name"),
                    F.struct(F.lit("Status").alias("name")).alias("field"),
                ),
            ).alias("nodes")
        ).alias("fieldValues"),
    )
    rows = board_submissions(spark, folder, tasks)
    pages = (
        (rows if by_block else rows.withColumn("block", _block("o_orderkey")))
        .groupBy("run_id", "extracted_at", "block")
        .agg(F.sort_array(F.collect_list(node)).alias("nodes"))
        .withColumn("page_no", F.col("block") + 1)
    )
    # One row per snapshot, of which there are three.
    last_pages = (
        table(spark, folder, "orders")
        .select(
            "o_orderkey",
            F.explode(_snapshots_since(F.col("o_orderdate").cast("timestamp"))).alias(
                "extracted_at"
            ),
        )
        .groupBy("extracted_at")
        .agg(F.max(_block("o_orderkey") + 1).alias("last_page"))
    )
    cursor = F.concat(F.lit("page-"), F.col("page_no").cast("string"))
    has_next = F.col("page_no") < F.col("last_page")
    items = F.struct(
        "nodes",
        F.struct(has_next.alias("hasNextPage"), cursor.alias("endCursor")).alias("pageInfo"),
    )
    board = F.struct(F.struct(items.alias("items")).alias("projectV2"))
    body = F.struct(F.struct(board.alias("organization")).alias("data"))
    return pages.join(F.broadcast(last_pages), "extracted_at").select(
        "run_id",
        F.lit(1).alias("attempt_number"),
        "extracted_at",
        "page_no",
        F.when(
            F.col("page_no") > 1,
            F.concat(F.lit("page-"), (F.col("page_no") - 1).cast("string")),
        ).alias("request_cursor"),
        compact_json(body).alias("body"),
    )


def user_board_pages(spark: SparkSession, folder: str) -> DataFrame:
    """The board as a user's, where every seventh order is still a draft without content."""
    pages = board_pages(spark, folder).withColumn(
        "page", F.from_json("body", schemas.PAGE, {"mode": "FAILFAST"})
    )
    items = F.col("page.data.organization.projectV2.items")
    nodes = F.transform(
        items["nodes"],
        lambda node: node.withField(
            "content", F.when(node["content"]["id"].cast("long") % 7 != 0, node["content"])
        ),
    )
    board = F.struct(
        F.struct(F.struct(nodes.alias("nodes"), items["pageInfo"].alias("pageInfo")).alias("items"))
        .alias("projectV2")
    )
    body = F.struct(F.struct(board.alias("user")).alias("data"))
    return pages.withColumn("body", compact_json(body)).drop("page")


def store_pages(pages: DataFrame, path: str) -> DataFrame:
    """The pages, written below ``path`` and read from there."""
    spark = pages.sparkSession
    # Orders and their items meet where both are dealt by block, not by block and order.
    with settings(spark, {"spark.sql.requireAllClusterKeysForCoPartition": "false"}):
        pages.write.option("compression", schemas.PAGES_CODEC).parquet(path)
    return spark.read.parquet(path)


def faulty_pages(spark: SparkSession, folder: str, path: str | None = None) -> DataFrame:
    """The board with runs that go wrong, each in its own way, besides one that does not.

    ``run-1998`` is whole. Of ``run-2000`` the first attempt has a cut page, the second is
    whole. ``run-2001`` passes the page checks, but on its even pages the assignees are a number.
    ``run-twice`` has page 1 twice, ``run-untitled`` no title that names a milestone.
    The pages are written to ``path``, because what reads them does so more than once.
    """
    pages = board_pages(spark, folder, by_block=True)
    cut = F.when(F.col("page_no") == 1, F.expr("left(body, length(body) - 1)")).otherwise(F.col("body"))
    number = F.replace(F.col("body"), F.lit('"assignees":{'), F.lit('"assignees":{"nodes":5,"was":{'))
    number = F.replace(number, F.lit('},"labels"'), F.lit('}},"labels"'))
    odd = F.when(F.col("page_no") % 2 == 0, number).otherwise(F.col("body"))
    untitled = F.replace(F.col("body"), F.lit('"title":"[M'), F.lit('"title":"(M'))
    later = F.col("extracted_at") + F.expr("INTERVAL 1 DAY")
    made = ("run_id", "attempt_number", "extracted_at", "body")

    def version(**changes: Column) -> Column:
        return F.struct(*(changes.get(c, F.col(c)).alias(c) for c in made))

    twice = version(run_id=F.lit("run-twice"))
    first = [version(), twice, version(run_id=F.lit("run-untitled"), body=untitled, extracted_at=later)]
    # All that becomes of a page is made at once, so that its text is stored no more than that.
    versions = (
        F.when((F.col("run_id") == "run-1998") & (F.col("page_no") == 1), F.array(*first, twice))
        .when(F.col("run_id") == "run-1998", F.array(*first))
        .when(
            F.col("run_id") == "run-2000",
            F.array(version(body=cut), version(attempt_number=F.lit(2))),
        )
        .when(F.col("run_id") == "run-2001", F.array(version(body=odd)))
    )
    others = [c for c in pages.columns if c not in made]
    parts = pages.select(*others, F.explode(versions).alias("version"))
    parts = parts.select(*(f"version.{c}" if c in made else c for c in pages.columns))
    return store_pages(parts, path or scratch_path(spark, "faulty"))
