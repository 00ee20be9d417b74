"""Landed board pages: scan, page checks, decoding.

A *landed page* is a row ``(run_id, attempt_number, extracted_at, page_no,
request_cursor, body)``; a *bronze page* has ``payload`` instead of cursor and body. Pages
are never concatenated per run: ``page_no`` carries the order, so that one large run
spreads over many tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import schemas
from tidemark.operators.joins import broadcast_within
from tidemark.session import scratch_path

CORRUPT = "_corrupt"


# --- Scan and persist form ---------------------------------------------------


def scan_payload_documents(
    spark: SparkSession,
    path: str,
    run_id: Column,
    attempt_number: Column,
    extracted_at: Column,
) -> DataFrame:
    """Read ``{"pages": [...]}`` documents, one file per run, as bronze pages.

    The three metadata columns may be literals or derived from ``source_file``.
    """
    files = spark.read.text(path, wholetext=True)
    return explode_documents(stamp_documents(files, run_id, attempt_number, extracted_at))


def stamp_documents(
    files: DataFrame, run_id: Column, attempt_number: Column, extracted_at: Column
) -> DataFrame:
    """Whole-text files, read at once or as a stream, with their run metadata."""
    documents = files.select(
        F.col("value").alias("document"),
        F.col("_metadata.file_path").alias("source_file"),
        F.col("_metadata.file_modification_time").alias("modified_at"),
    )
    return documents.withColumns(
        {
            "run_id": run_id,
            "attempt_number": attempt_number.cast("int"),
            "extracted_at": extracted_at.cast("timestamp"),
        }
    )


def explode_documents(documents: DataFrame, document: str = "document") -> DataFrame:
    """Split payload documents into bronze pages; each page keeps its own JSON text.

    A document that is not an object holding a ``pages`` list with at least one page
    fails the job.
    """
    parsed = F.from_json(F.col(document), "pages array<string>", {"mode": "PERMISSIVE"})
    complaint = F.raise_error(F.lit("Bronze payload must contain a 'pages' list"))
    pages = F.when(F.size(parsed["pages"]) > 0, parsed["pages"]).otherwise(
        complaint.cast("array<string>")
    )
    return documents.select(
        "run_id",
        "attempt_number",
        "extracted_at",
        F.posexplode(pages).alias("position", "payload"),
    ).select(
        "run_id",
        "attempt_number",
        "extracted_at",
        (F.col("position") + 1).cast("bigint").alias("page_no"),
        "payload",
    )


def scan_payload_lines(
    spark: SparkSession,
    path: str,
    run_id: Column,
    attempt_number: Column,
    extracted_at: Column,
) -> DataFrame:
    """As :func:`scan_payload_documents`, with a large file read by several tasks.

    Splits files whose pages stand on lines of their own, between a line ``{"pages":[`` and
    a line ``]}``, as :func:`payload_lines` lays them out. Files of any other form are put
    together again and parsed whole. Page numbers come from line counts by file block. These
    are taken at once, by a first reading; the second one needs no shuffle of the pages.
    """
    text = F.btrim("line")
    page = F.rtrim(text, F.lit(","))
    # Parsed as the only page of a document, which leaves the same text as the whole document.
    alone = F.from_json(
        F.concat(F.lit('{"pages":['), page, F.lit("]}")),
        f"pages array<string>, {CORRUPT} string",
        {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT},
    )
    whole_page = (
        page.startswith("{") & page.endswith("}") & alone[CORRUPT].isNull() & (F.size(alone["pages"]) == 1)
    )
    form = (
        F.when(F.regexp_like(text, F.lit(r'^\{\s*"pages"\s*:\s*\[$')), "head")
        .when(F.regexp_like(text, F.lit(r"^\]\s*\}$")), "foot")
        .when(whole_page & (F.length(text) == F.length(page) + 1), "more")
        .when(whole_page & (text == page), "page")
        .otherwise("odd")
    )
    lines = spark.read.text(path).select(
        F.col("value").alias("line"),
        F.col("_metadata.file_path").alias("source_file"),
        F.col("_metadata.file_modification_time").alias("modified_at"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("place"),
    )
    shapes = lines.select("source_file", "block", "place", form.alias("form"))
    blocks = shapes.groupBy("source_file", "block").agg(
        F.count("*").alias("n_lines"),
        F.min("place").alias("first_place"),
        F.max(F.when(F.col("form") == "page", F.col("place"))).alias("last_page"),
        F.min_by("form", "place").alias("first_form"),
        F.max_by("form", "place").alias("last_form"),
        *(F.count_if(F.col("form") == f).alias(f) for f in ("head", "foot", "page", "odd")),
    )
    before = W.partitionBy("source_file").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    blocks = blocks.withColumn("offset", F.coalesce(F.sum("n_lines").over(before), F.lit(0)))
    # One line for the start, one for the end, and between them pages, of which only the
    # last lacks its comma.
    last_page = F.col("offset") + F.col("last_page") - F.col("first_place")
    files = blocks.groupBy("source_file").agg(
        (
            (F.sum("head") == 1)
            & (F.sum("foot") == 1)
            & (F.sum("page") == 1)
            & (F.sum("odd") == 0)
            & (F.min_by("first_form", "block") == "head")
            & (F.max_by("last_form", "block") == "foot")
            & (F.max(last_page) == F.sum("n_lines") - 2)
        ).alias("by_line")
    )
    known = blocks.select("source_file", "block", "first_place", "offset").join(files, "source_file")
    # Written, so that its rows are counted before they are broadcast: one per file block.
    counts = scratch_path(spark, "payload-blocks")
    known.write.parquet(counts)
    known = broadcast_within(spark.read.schema(known.schema).parquet(counts))
    placed = lines.join(known, ["source_file", "block"]).withColumn(
        "line_no", F.col("offset") + F.col("place") - F.col("first_place")
    )
    stamps = {
        "run_id": run_id,
        "attempt_number": attempt_number.cast("int"),
        "extracted_at": extracted_at.cast("timestamp"),
    }
    split = (
        placed.filter(F.col("by_line") & form.isin("page", "more"))
        .withColumns(stamps)
        .select(*stamps, F.col("line_no").cast("bigint").alias("page_no"), alone["pages"][0].alias("payload"))
    )
    rest = (
        placed.filter(~F.col("by_line"))
        .groupBy("source_file", "modified_at")
        .agg(F.array_sort(F.collect_list(F.struct("line_no", "line"))).alias("lines"))
        .withColumn("document", F.array_join(F.col("lines.line"), "\n"))
        .withColumns(stamps)
    )
    return split.unionByName(explode_documents(rest))


def file_parts(pages: DataFrame, pages_per_file: int) -> tuple[DataFrame, DataFrame]:
    """Bronze pages dealt to files of bounded size, and the places of the files in their runs.

    ``run_id`` of the pages becomes ``<run>.<part>``, so that :func:`payload_lines` makes a
    document of each part; a document per run would pass a whole run through one task. The
    second frame has a row per file: ``run_id, part, pages_before``.
    """
    part = F.ceil(F.col("page_no") / pages_per_file).cast("bigint")
    earlier = W.partitionBy("run_id").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    counts = pages.groupBy("run_id", part.alias("part")).agg(F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(earlier), F.lit(0))
    parts = pages.withColumn("run_id", F.concat_ws(".", "run_id", part.cast("string")))
    return parts, counts.select("run_id", "part", before.alias("pages_before"))


def payload_lines(pages: DataFrame) -> DataFrame:
    """Bronze pages as lines ``run_id, page_no, value`` of payload documents, one per run.

    Written in the order of ``page_no``, the lines of a run are one JSON document that
    :func:`scan_payload_lines` can split.
    """
    # One row per document; a shuffle by run would gather each run in one task.
    last = broadcast_within(pages.groupBy("run_id").agg(F.max("page_no").alias("last_page")))
    comma = F.when(F.col("page_no") < F.col("last_page"), ",").otherwise("")
    body = pages.join(last, "run_id").select(
        "run_id", "page_no", F.concat("payload", comma).alias("value")
    )
    ends = last.select(
        "run_id",
        F.inline(
            F.array(
                F.struct(F.lit(0).cast("bigint").alias("page_no"), F.lit('{"pages":[').alias("value")),
                F.struct((F.col("last_page") + 1).alias("page_no"), F.lit("]}").alias("value")),
            )
        ),
    )
    return body.unionByName(ends)


def scan_landed_pages(spark: SparkSession, path: str) -> DataFrame:
    """Read landed pages stored as JSON lines."""
    return spark.read.schema(schemas.LANDED_PAGES).json(path, mode="FAILFAST")


def compact_json(value: Column) -> Column:
    """A struct as compact JSON text; nulls are written and non-ASCII text is kept."""
    return F.to_json(value, {"ignoreNullFields": "false"})


def to_bronze(pages: DataFrame) -> DataFrame:
    """Accepted landed pages as bronze pages; the body is kept as it came."""
    return pages.withColumnRenamed("body", "payload").select(*schemas.RAW_EXTRACTIONS.columns)


# --- Page checks ---------------------------------------------------------------


def _items(document: Column, owner_type: str, leaf: str, as_type: str) -> Column:
    return F.try_variant_get(document, f"$.data.{owner_type}.projectV2.items.{leaf}", as_type)


def invalid_cursor() -> Column:
    """More pages are promised, but the next cursor is missing, empty or the old one."""
    end = F.coalesce("end_cursor", F.lit(""))
    return F.col("has_next") & ((end == "") | end.eqNullSafe(F.col("request_cursor")))


def page_checks(pages: DataFrame, owner_type: str) -> DataFrame:
    """One row per page with the reason it must be rejected (null when accepted).

    Adds ``has_next`` and ``end_cursor`` for :func:`cursor_chain`. Checks run in
    this order: JSON, JSON object, reported errors, project items, node list, cursor.
    """
    if owner_type not in schemas.OWNER_TYPES:
        raise ValueError(
            "OWNER_TYPE must be one of: " + ", ".join(sorted(schemas.OWNER_TYPES))
        )
    document = F.col("document")
    errors = F.try_variant_get(document, "$.errors", "array<variant>")
    messages = F.array_join(
        F.transform(
            errors,
            lambda error: F.coalesce(
                F.try_variant_get(error, "$.message", "string"),
                F.try_variant_get(error, "$", "string"),
            ),
        ),
        "; ",
    )
    parsed = pages.withColumn("document", F.try_parse_json(F.col("body"))).withColumns(
        {
            "is_object": F.try_variant_get(document, "$", "map<string,variant>").isNotNull(),
            "error_count": F.coalesce(F.size(errors), F.lit(0)),
            "error_text": messages,
            "has_page_info": _items(
                document, owner_type, "pageInfo", "map<string,variant>"
            ).isNotNull(),
            "has_nodes": _items(document, owner_type, "nodes", "array<variant>").isNotNull(),
            "has_next": F.coalesce(
                _items(document, owner_type, "pageInfo.hasNextPage", "boolean"), F.lit(False)
            ),
            "end_cursor": _items(document, owner_type, "pageInfo.endCursor", "string"),
        }
    )
    reason = (
        F.when(document.isNull(), "non-JSON response")
        .when(~F.col("is_object"), "unexpected JSON response")
        .when(F.col("error_count") > 0, F.concat(F.lit("errors: "), F.col("error_text")))
        .when(~F.col("has_page_info"), "project items missing")
        .when(~F.col("has_nodes"), "project items not a list")
        .when(invalid_cursor(), "invalid pagination cursor")
    )
    return parsed.select(
        *pages.columns, "has_next", "end_cursor", reason.alias("reject_reason")
    )


def cursor_chain(checked: DataFrame, run_key: Sequence[str] = ("run_id",)) -> DataFrame:
    """Follow the cursors of each run from page to page.

    Needs the run key and ``page_no, request_cursor, has_next, end_cursor``. A page is
    matched with its predecessor by an equi-join on the run and page number; ordering a
    whole run in one window would put the largest run into a single task.
    """
    predecessor = checked.select(
        *run_key,
        (F.col("page_no") + 1).alias("page_no"),
        F.lit(True).alias("has_predecessor"),
        F.col("has_next").alias("previous_has_next"),
        F.col("end_cursor").alias("previous_end_cursor"),
    )
    first = F.col("page_no") == 1
    problem = (
        F.when(first & F.col("request_cursor").isNotNull(), "first page has a cursor")
        .when(~first & F.col("has_predecessor").isNull(), "previous page missing")
        .when(~first & ~F.col("previous_has_next"), "page after the last page")
        .when(
            ~first & ~F.col("request_cursor").eqNullSafe(F.col("previous_end_cursor")),
            "request cursor differs from previous end cursor",
        )
        .when(
            invalid_cursor(), "invalid pagination cursor"
        )
    )
    return checked.join(predecessor, [*run_key, "page_no"], "left").select(
        *checked.columns, problem.alias("chain_problem")
    )


def run_completeness(chained: DataFrame) -> DataFrame:
    """Per run: page count, chain breaks, and whether the chain was read to its end."""
    per_run = chained.groupBy("run_id").agg(
        F.count("*").alias("page_count"),
        F.count("chain_problem").alias("break_count"),
        F.max_by("has_next", "page_no").alias("goes_on"),
    )
    return per_run.select(
        "run_id",
        "page_count",
        "break_count",
        ((F.col("break_count") == 0) & ~F.col("goes_on")).alias("is_complete"),
    )


# --- Decode --------------------------------------------------------------------


def decode_pages(bronze: DataFrame) -> DataFrame:
    """Bronze pages with a typed ``page`` column; malformed JSON fails the job."""
    page = F.from_json("payload", schemas.PAGE, {"mode": "FAILFAST"})
    return bronze.withColumn("page", page)


def checked_pages(bronze: DataFrame) -> DataFrame:
    """Bronze pages with a typed ``page`` and ``is_malformed``: no JSON, or no such types."""
    tolerant = T.StructType([*schemas.PAGE.fields, T.StructField(CORRUPT, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    parsed = bronze.withColumn("page", F.from_json("payload", tolerant, options))
    is_bad = F.col("page").isNull() | F.col(f"page.{CORRUPT}").isNotNull()
    return parsed.select(
        *bronze.columns, F.col("page").dropFields(CORRUPT).alias("page"), is_bad.alias("is_malformed")
    )


def quarantine_pages(bronze: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(decoded, rejected)``: malformed payloads are set aside instead of failing."""
    checked = checked_pages(bronze)
    decoded = checked.filter(~F.col("is_malformed")).drop("is_malformed")
    return decoded, checked.filter("is_malformed").select(*bronze.columns)
