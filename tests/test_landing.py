from __future__ import annotations

import json

import pytest
from boards import node, page, utc
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.plans.jobs import Pipeline
from tidemark.sources import landing


def landed(spark, *bodies, run_id="run-1", attempt=1, cursors=None):
    cursors = cursors or [None] + [f"c{i}" for i in range(1, len(bodies))]
    rows = [
        (run_id, attempt, utc("2026-08-05T00:00:00"), number, cursor, body)
        for number, (cursor, body) in enumerate(zip(cursors, bodies), start=1)
    ]
    return spark.createDataFrame(rows, schemas.LANDED_PAGES)


def reasons(frame):
    return [r["reject_reason"] for r in frame.orderBy("page_no").collect()]


def test_payload_files_keep_page_text_and_order(spark, tmp_path):
    document = {"pages": [page(node("a", title="[M1] ünï")), page(node("b"))]}
    (tmp_path / "run-7.json").write_text(json.dumps(document, indent=2, ensure_ascii=False), encoding="utf-8")
    pages = landing.scan_payload_documents(
        spark,
        str(tmp_path),
        F.regexp_extract("source_file", r"(run-\d+)\.json$", 1),
        F.lit(1),
        F.lit("2026-08-05 00:00:00"),
    )
    rows = pages.orderBy("page_no").collect()
    assert [(r["run_id"], r["page_no"]) for r in rows] == [("run-7", 1), ("run-7", 2)]
    assert [json.loads(r["payload"]) for r in rows] == document["pages"]
    assert "ünï" in rows[0]["payload"] and ": " not in rows[0]["payload"]


@pytest.mark.parametrize("document", ['{"pages": {}}', "[]", '{"other": 1}', "nonsense", '{"pages": []}'])
def test_documents_without_pages_fail(spark, document):
    frame = spark.createDataFrame([("r", 1, None, document)], "run_id string, attempt_number int, extracted_at timestamp, document string")
    with pytest.raises(Exception, match="'pages' list"):
        landing.explode_documents(frame).collect()


def test_page_checks_name_the_first_problem(spark):
    bodies = [
        "<html>",
        "[1, 2]",
        "null",
        '{"errors": [{"message": "slow down"}, "twice"], "data": null}',
        '{"errors": [], "data": {"organization": null}}',
        '{"data": {"organization": {"projectV2": {"items": {"nodes": {}, "pageInfo": {}}}}}}',
        json.dumps(page(has_next=True, end_cursor="")),
        json.dumps(page(has_next=True, end_cursor="c7")),
        json.dumps(page(node("a"))),
    ]
    checked = landing.page_checks(landed(spark, *bodies), "organization")
    assert reasons(checked) == [
        "non-JSON response",
        "unexpected JSON response",
        "unexpected JSON response",
        "errors: slow down; twice",
        "project items missing",
        "project items not a list",
        "invalid pagination cursor",
        "invalid pagination cursor",
        None,
    ]


def test_owner_type_is_checked(spark):
    pages = landed(spark, json.dumps(page(owner="user")))
    assert reasons(landing.page_checks(pages, "user")) == [None]
    assert reasons(landing.page_checks(pages, "organization")) == ["project items missing"]
    with pytest.raises(ValueError, match="organization, user"):
        landing.page_checks(pages, "team")


def test_cursor_chain(spark):
    ok = [json.dumps(page(has_next=True, end_cursor="c1")), json.dumps(page())]
    checked = landing.page_checks(landed(spark, *ok), "organization")
    done = landing.run_completeness(landing.cursor_chain(checked)).first()
    assert (done["page_count"], done["break_count"], done["is_complete"]) == (2, 0, True)

    skipped = landing.page_checks(landed(spark, *ok, cursors=[None, "other"]), "organization")
    problems = [r["chain_problem"] for r in landing.cursor_chain(skipped).orderBy("page_no").collect()]
    assert problems == [None, "request cursor differs from previous end cursor"]

    cut = landing.page_checks(landed(spark, ok[0]), "organization")
    assert not landing.run_completeness(landing.cursor_chain(cut)).first()["is_complete"]


def test_ingest_records_success_and_failure_together(spark, warehouse):
    good = landed(spark, json.dumps(page(node("a"))))
    bad = landed(spark, "<html>", run_id="run-2")
    cut = landed(spark, json.dumps(page(has_next=True, end_cursor="c1")), run_id="run-3")
    pipeline = Pipeline(warehouse, secrets=("JSON",))
    pipeline.ingest(good.unionByName(bad).unionByName(cut))
    attempts = {r["run_id"]: r for r in warehouse.read("ops.pipeline_attempts").collect()}
    assert {k: r["attempt_status"] for k, r in attempts.items()} == {
        "run-1": "succeeded",
        "run-2": "failed",
        "run-3": "failed",
    }
    assert attempts["run-1"]["error_message"] is None
    assert attempts["run-2"]["error_message"] == "non-[REDACTED] response"
    assert attempts["run-3"]["error_message"] == "last page is missing"
    stored = warehouse.read("bronze.raw_issue_extractions").collect()
    assert [(r["run_id"], json.loads(r["payload"])) for r in stored] == [("run-1", page(node("a")))]

    # Every recorded outcome blocks its attempt, a failure too; a new attempt is free.
    pipeline.ingest(good.unionByName(landed(spark, json.dumps(page(node("b"))), run_id="run-2")))
    assert warehouse.read("ops.pipeline_attempts").count() == 3
    pipeline.ingest(landed(spark, json.dumps(page(node("b"))), run_id="run-2", attempt=2))
    assert warehouse.read("ops.pipeline_attempts").count() == 4


def test_landed_pages_are_read_from_json_lines(spark, tmp_path):
    pages = landed(spark, json.dumps(page(node("a"))))
    pages.write.json(str(tmp_path / "pages"))
    assert landing.scan_landed_pages(spark, str(tmp_path / "pages")).collect() == pages.collect()


def test_compact_json(spark):
    row = spark.createDataFrame([("é", None)], "a string, b string")
    text = row.select(landing.compact_json(F.struct("a", "b")).alias("j")).first()["j"]
    assert text == '{"a":"é","b":null}'


def stored_pages(spark, path):
    name = F.regexp_extract("source_file", r"([^/]+)\.json$", 1)
    found = landing.scan_payload_lines(spark, str(path), name, F.lit(1), F.lit("2026-01-01"))
    pages = {}
    for r in found.orderBy("run_id", "page_no").collect():
        pages.setdefault(r.run_id, []).append((r.page_no, r.payload))
    return found, pages


def test_large_payload_files_are_read_by_several_tasks(spark, tmp_path):
    pages = [f'{{"n":{i},"text":"{"é" * (i % 40)} , ]}} \\n"}}' for i in range(3000)]
    document = '{"pages":[\n' + ",\n".join(pages) + "\n]}\n"
    (tmp_path / "long.json").write_text(document)
    (tmp_path / "short.json").write_text('{"pages":[\n{"n":0}\n]}')
    size = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(size)
    spark.conf.set(size, "20000")
    try:
        found, stored = stored_pages(spark, tmp_path)
        tasks = [n for n in found.rdd.glom().map(len).collect() if n]
    finally:
        spark.conf.set(size, before)
    assert stored["long"] == list(enumerate(pages, 1)) and stored["short"] == [(1, '{"n":0}')]
    assert len(tasks) > 5


def test_payload_files_of_other_forms_are_parsed_whole(spark, tmp_path):
    forms = {
        "one_line": '{"pages":[{"n":0},{"n":1}]}',
        "indented": '{\n  "pages": [\n    {\n      "n": 0\n    },\n    {"n": 1}\n  ]\n}\n',
        "blank_lines": '{"pages":[\n\n{"n":0},\n{"n":1}\n]}',
        "two_on_a_line": '{"pages":[\n{"n":0},{"n":1}\n]}',
        "windows": '{"pages":[\r\n{"n":0},\r\n{"n":1}\r\n]}\r\n',
    }
    for name, document in forms.items():
        (tmp_path / f"{name}.json").write_bytes(document.encode())
    _, stored = stored_pages(spark, tmp_path)
    for name in forms:
        assert [(no, json.loads(payload)) for no, payload in stored[name]] == [(1, {"n": 0}), (2, {"n": 1})]


@pytest.mark.parametrize(
    "document", ['{"pages":[\n]}', '{"pages":[\n{"n":0}\n{"n":1}\n]}', '{"n":[\n{"n":0}\n]}', "[\n]"]
)
def test_payload_files_without_pages_fail(spark, tmp_path, document):
    (tmp_path / "bad.json").write_text(document)
    with pytest.raises(Exception, match="'pages' list"):
        stored_pages(spark, tmp_path)


def test_a_run_is_written_to_files_of_bounded_size(spark, tmp_path):
    """Pages keep their place in the run, also where page numbers have gaps."""
    numbers = [n for n in range(1, 24) if n != 7]
    rows = [("run-1.a", 1, utc("2026-08-05T00:00:00"), n, f'{{"n":{n}}}') for n in numbers]
    bronze = spark.createDataFrame(rows, schemas.RAW_EXTRACTIONS.schema)
    parts, places = landing.file_parts(bronze, 5)
    lines = landing.payload_lines(parts)
    plan = lines._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan
    lines = lines.repartition("run_id").sortWithinPartitions("run_id", "page_no")
    lines.select("run_id", "value").write.partitionBy("run_id").text(str(tmp_path / "files"))
    file = F.regexp_extract("source_file", "run_id=([^/]+)/", 1)
    found = landing.scan_payload_lines(spark, str(tmp_path / "files"), file, F.lit(1), F.lit("2026-01-01"))
    sizes = found.groupBy("run_id").count().orderBy("run_id").collect()
    assert [tuple(r) for r in sizes] == [("run-1.a.1", 5), ("run-1.a.2", 4), ("run-1.a.3", 5), ("run-1.a.4", 5), ("run-1.a.5", 3)]
    before = {f"{r['run_id']}.{r['part']}": r["pages_before"] for r in places.collect()}
    placed = {before[r["run_id"]] + r["page_no"]: json.loads(r["payload"])["n"] for r in found.collect()}
    assert placed == dict(enumerate(numbers, 1))
