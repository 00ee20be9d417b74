"""What the registered queries must return, as SQL over the same test tables."""

from __future__ import annotations

ORACLE: dict[str, str] = {}


def _day(expression: str) -> str:
    return f"strftime({expression}, '%Y-%m-%d')"


def _time(expression: str) -> str:
    return f"strftime({expression}, '%Y-%m-%d %H:%M:%S')"


def _local(expression: str) -> str:
    return f"CAST({expression} + INTERVAL 8 HOUR AS DATE)"


def _days(later: str, earlier: str) -> str:
    return f"CAST(floor((epoch({later}) - epoch({earlier})) / 86400) AS BIGINT)"


# --- The board: one order is one submission per snapshot ------------------------------------

_BOARD = f"""
snap AS (
    SELECT unnest([TIMESTAMP '1998-12-31 16:30:00', TIMESTAMP '2000-06-30 16:30:00',
                   TIMESTAMP '2001-08-02 16:30:00']) AS extracted_at
),
board AS (
    SELECT o.*, s.extracted_at FROM orders o JOIN snap s ON o.o_orderdate <= s.extracted_at
),
shipped AS (
    SELECT b.o_orderkey, b.extracted_at, max(l.l_shipdate) AS last_shipped,
           list(DISTINCT p.s_name ORDER BY p.s_name) AS reviewer
    FROM board b
    JOIN lineitem l ON l.l_orderkey = b.o_orderkey AND l.l_shipdate <= b.extracted_at
    JOIN supplier p ON p.s_suppkey = l.l_suppkey
    GROUP BY b.o_orderkey, b.extracted_at
),
submissions AS (
    SELECT b.o_orderkey,
           CAST(b.o_orderkey AS VARCHAR) AS issue_id,
           '[M' || (year(b.o_orderdate) - 1995) || '] order ' || b.o_orderkey AS issue_title,
           'https://example.test/' || b.o_orderkey AS issue_url,
           CASE WHEN b.o_custkey % 50 <> 0 THEN c.c_name END AS issue_author,
           b.o_orderdate AS created_at,
           greatest(b.o_orderdate, s.last_shipped) AS updated_at,
           CASE WHEN b.o_orderstatus = 'F' THEN 'CLOSED' ELSE 'OPEN' END AS state,
           coalesce(s.reviewer, []) AS reviewer,
           'M' || (year(b.o_orderdate) - 1995) AS milestone,
           CASE b.o_orderpriority
               WHEN '1-URGENT' THEN 'Unchecked/Unassigned'
               WHEN '2-HIGH' THEN 'In review'
               WHEN '3-MEDIUM' THEN 'Needs Improvement'
               WHEN '5-LOW' THEN 'Passed'
               ELSE CASE WHEN b.o_orderkey % 2 = 0 THEN 'Mystery' END
           END AS status,
           'run-' || year(b.extracted_at) AS run_id,
           b.extracted_at
    FROM board b
    LEFT JOIN shipped s USING (o_orderkey, extracted_at)
    LEFT JOIN customer c ON c.c_custkey = b.o_custkey
),
measured AS (
    SELECT *, len(reviewer) > 0 AS is_assigned,
           {_days('extracted_at', 'updated_at')} AS days_since_update,
           {_days('extracted_at', 'created_at')} AS submission_age_days
    FROM submissions
)"""

# Every submission is kept.
_SILVER = _BOARD + ",\nsilver AS (SELECT * FROM measured)"

# The pipeline drops listed authors and keeps the newest per author and milestone.
_PIPELINE_SILVER = (
    _BOARD
    + """,
silver AS (
    SELECT * FROM measured
    WHERE issue_author IS NULL
       OR issue_author NOT IN ('Customer#000000007', 'Customer#000000011')
    QUALIFY row_number() OVER (
        PARTITION BY run_id, issue_author, milestone
        ORDER BY created_at DESC, updated_at DESC, issue_id DESC) = 1
)"""
)

_STAR = f""",
dim_issue AS (
    SELECT row_number() OVER (ORDER BY min(extracted_at), issue_id) AS issue_key, issue_id,
           any_value(issue_title) AS issue_title, any_value(issue_url) AS issue_url,
           any_value(issue_author) AS issue_author
    FROM silver GROUP BY issue_id
),
assignments AS (
    SELECT DISTINCT run_id, extracted_at, issue_id, unnest(reviewer) AS reviewer FROM silver
),
dim_reviewer AS (
    SELECT row_number() OVER (ORDER BY min(extracted_at), reviewer) AS reviewer_key, reviewer
    FROM assignments GROUP BY reviewer
),
dim_state AS (
    SELECT row_number() OVER (ORDER BY min(extracted_at), state) AS state_key, state
    FROM silver GROUP BY state
),
dim_status AS (
    SELECT row_number() OVER (ORDER BY min(extracted_at), status) AS status_key, status
    FROM silver WHERE status IS NOT NULL GROUP BY status
),
milestone_names AS (
    SELECT milestone, min(extracted_at) AS first_seen FROM (
        SELECT milestone, extracted_at FROM silver
        UNION ALL
        SELECT 'M' || n, (SELECT min(extracted_at) FROM silver) FROM range(7) AS r(n)
    ) GROUP BY milestone
),
dim_milestone AS (
    SELECT row_number() OVER (ORDER BY first_seen, number NULLS LAST, milestone) AS milestone_key,
           milestone, number AS milestone_number,
           CASE WHEN number < 7 THEN make_date(1995 + number, 12, 31) END AS deadline_date
    FROM (SELECT *, CAST(substr(milestone, 2) AS INTEGER) AS number FROM milestone_names)
),
days AS (
    SELECT {_local('created_at')} AS date, extracted_at FROM silver
    UNION ALL SELECT {_local('updated_at')}, extracted_at FROM silver
    UNION ALL SELECT {_local('extracted_at')}, extracted_at FROM silver
),
dim_date AS (
    SELECT row_number() OVER (ORDER BY min(extracted_at), date) AS date_key, date
    FROM days GROUP BY date
),
fact AS (
    SELECT row_number() OVER (ORDER BY s.extracted_at, s.run_id, s.issue_id)
               AS submission_snapshot_key,
           s.*, i.issue_key, st.state_key, x.status_key, m.milestone_key, m.milestone_number,
           m.deadline_date
    FROM silver s
    JOIN dim_issue i USING (issue_id)
    JOIN dim_state st USING (state)
    JOIN dim_milestone m USING (milestone)
    LEFT JOIN dim_status x USING (status)
),
bridge AS (
    SELECT f.submission_snapshot_key, r.reviewer_key, a.reviewer
    FROM assignments a
    JOIN fact f ON f.run_id = a.run_id AND f.issue_id = a.issue_id
    JOIN dim_reviewer r ON r.reviewer = a.reviewer
)"""

_KNOWN = "['Unchecked/Unassigned', 'In review', 'Needs Improvement', 'Passed']"

_METRICS = f""",
latest AS (
    SELECT * FROM fact WHERE extracted_at = (SELECT max(extracted_at) FROM fact)
),
expected AS (
    SELECT coalesce(
        min(milestone_number) FILTER (
            WHERE deadline_date >= (SELECT {_local('max(extracted_at)')} FROM fact)),
        max(milestone_number)) AS expected, max(milestone_number) AS final
    FROM dim_milestone
),
current AS (
    SELECT * FROM latest WHERE issue_author IS NOT NULL
    QUALIFY row_number() OVER (
        PARTITION BY issue_author
        ORDER BY milestone_number DESC NULLS LAST, updated_at DESC, created_at DESC,
                 issue_key DESC, submission_snapshot_key DESC) = 1
),
names AS (
    SELECT submission_snapshot_key, string_agg(DISTINCT reviewer, ', ' ORDER BY reviewer) AS names,
           count(DISTINCT reviewer_key) AS n
    FROM bridge GROUP BY submission_snapshot_key
),
judged AS (
    SELECT c.*, n.names, e.expected,
           CASE WHEN c.status IS NULL OR NOT list_contains({_KNOWN}, c.status) THEN 1
                WHEN c.status <> 'Passed' AND upper(c.state) = 'CLOSED' THEN 2
                WHEN c.status = 'Passed' THEN if(c.milestone_number < e.final, 7, 8)
                WHEN c.status = 'Needs Improvement' THEN 6
                WHEN c.status = 'In review' THEN 5
                ELSE if(coalesce(n.n, 0) = 0, 3, 4) END AS situation
    FROM current c LEFT JOIN names n USING (submission_snapshot_key), expected e
),
steps(situation, next_actor, next_action, sort_priority) AS (
    VALUES (1, 'Program admin', 'Verify submission status', 0),
           (2, 'Program admin', 'Verify or reopen unresolved issue', 0),
           (3, 'Program admin', 'Assign a reviewer', 1),
           (4, 'Reviewer', 'Start review', 1),
           (5, 'Reviewer', 'Complete review', 1),
           (6, 'Builder', 'Revise and resubmit', 1),
           (7, 'Builder', 'Begin next milestone', 2),
           (8, 'None', 'Program complete', 3)
),
classified AS (
    SELECT issue_author AS builder, milestone AS current_milestone,
           coalesce(status, 'Unknown') AS status,
           if(milestone_number >= expected - 1, 'On track', 'Delayed') AS schedule_status,
           coalesce(names, 'Unassigned') AS reviewer, state AS issue_state,
           submission_age_days, days_since_update, issue_url,
           next_actor, next_action, sort_priority
    FROM judged JOIN steps USING (situation)
),
distribution AS (
    SELECT m.milestone, x.status, count(l.submission_snapshot_key) AS submission_count
    FROM dim_milestone m CROSS JOIN dim_status x
    LEFT JOIN latest l ON l.milestone_key = m.milestone_key AND l.status_key = x.status_key
    GROUP BY m.milestone, x.status
),
highest AS (
    SELECT issue_author AS builder, max(milestone_number) AS milestone_number
    FROM latest WHERE issue_author IS NOT NULL GROUP BY issue_author
),
positions AS (
    SELECT h.*, greatest(e.expected - h.milestone_number, 0) AS milestones_behind,
           CASE WHEN h.milestone_number >= e.expected - 1 THEN 'on_track' ELSE 'delayed' END
               AS schedule_status
    FROM highest h, expected e
),
schedule AS (
    SELECT CASE schedule_status WHEN 'on_track' THEN 'On track' ELSE 'Delayed' END
               AS schedule_status,
           count(*) AS builder_count,
           CAST(round(100.0 * count(*) / sum(count(*)) OVER (), 2) AS DOUBLE)
               AS builder_percentage
    FROM positions GROUP BY positions.schedule_status
),
completion AS (
    SELECT extracted_at, issue_author AS builder,
           count(DISTINCT milestone_key) FILTER (WHERE status = 'Passed') AS passed_milestones
    FROM fact WHERE issue_author IS NOT NULL GROUP BY extracted_at, issue_author
),
progress AS (
    SELECT extracted_at, {_local('extracted_at')} AS extraction_date,
           CAST(round(avg(passed_milestones * 1.0 / (SELECT count(*) FROM dim_milestone)) * 100, 2)
               AS DOUBLE) AS average_completion_percentage,
           count(*) AS observed_builder_count
    FROM completion GROUP BY extracted_at
),
workload AS (
    SELECT coalesce(b.reviewer, 'Unassigned') AS reviewer,
           count(DISTINCT c.submission_snapshot_key) AS unresolved_count
    FROM current c LEFT JOIN bridge b USING (submission_snapshot_key)
    WHERE upper(c.state) = 'OPEN' AND (c.status IS NULL OR c.status <> 'Passed')
    GROUP BY ALL
)"""

_SNAPSHOT_MART = "WITH " + _SILVER + _STAR + _METRICS + "\n"
_LANDED_MART = "WITH " + _PIPELINE_SILVER + _STAR + _METRICS + "\n"
_SNAPSHOT_SILVER = "WITH " + _SILVER + "\n"
_LANDED_SILVER = "WITH " + _PIPELINE_SILVER + "\n"

_SILVER_COLUMNS = f"""
    issue_id, issue_title, issue_url, issue_author, {_time('created_at')} AS created_at,
    {_time('updated_at')} AS updated_at, state, array_to_string(reviewer, ',') AS reviewer,
    milestone, status, run_id, {_time('extracted_at')} AS extracted_at, is_assigned,
    days_since_update, submission_age_days"""


def _mart(name: str, select: str) -> None:
    ORACLE[name] = _SNAPSHOT_MART + select


def _silver(name: str, select: str) -> None:
    ORACLE[name] = _SNAPSHOT_SILVER + select


# --- Metrics ------------------------------------------------------------------------------

_mart("submission_distribution", "SELECT * FROM distribution")
_mart("builder_schedule", "SELECT * FROM schedule")
_mart(
    "progress_trend",
    f"""SELECT {_time('extracted_at')} AS extracted_at, {_day('extraction_date')} AS extraction_date,
           average_completion_percentage, observed_builder_count FROM progress""",
)
_mart(
    "progress_dataset",
    f"""SELECT {_day('extraction_date')} AS extraction_date,
           average_completion_percentage AS completion_rate FROM progress""",
)
_INTERVENTIONS = """SELECT builder, current_milestone, status, schedule_status, reviewer, issue_state,
    submission_age_days, days_since_update, next_actor, next_action, issue_url FROM classified"""
_mart("interventions", _INTERVENTIONS)
_mart("csv_source", _INTERVENTIONS)
_mart("reviewer_workload", "SELECT * FROM workload")

# --- Building blocks ------------------------------------------------------------------------

_mart("latest_snapshot", "SELECT submission_snapshot_key, run_id, days_since_update FROM latest")
_mart(
    "as_of",
    f"""SELECT {_time('max(extracted_at)')} AS extracted_at,
           {_day(_local('max(extracted_at)'))} AS as_of_date FROM fact""",
)
_mart(
    "expected_milestone",
    "SELECT CAST(expected AS BIGINT) AS expected, CAST(final AS BIGINT) AS final FROM expected",
)
_mart(
    "current_submission",
    "SELECT issue_author AS builder, milestone, issue_url, submission_snapshot_key FROM current",
)
_mart(
    "highest_milestone",
    "SELECT builder, CAST(milestone_number AS BIGINT) AS milestone_number FROM highest",
)
_mart(
    "milestones_behind",
    """SELECT schedule_status, CAST(milestones_behind AS BIGINT) AS milestones_behind,
           count(*) AS builder_count FROM positions GROUP BY ALL""",
)
_mart("next_actor_counts", "SELECT next_actor, count(*) AS builder_count FROM classified GROUP BY ALL")
_mart("next_action_counts", "SELECT next_action, count(*) AS builder_count FROM classified GROUP BY ALL")
_mart(
    "sort_priority_counts",
    """SELECT CAST(sort_priority AS BIGINT) AS sort_priority, count(*) AS builder_count
       FROM classified GROUP BY ALL""",
)
_mart(
    "builder_completion",
    f"SELECT {_time('extracted_at')} AS extracted_at, builder, passed_milestones FROM completion",
)
ORACLE["reviewer_string_agg"] = """
SELECT l_orderkey, string_agg(DISTINCT s_name, ', ' ORDER BY s_name) AS reviewer,
       count(DISTINCT s_name) AS reviewer_count
FROM lineitem JOIN supplier ON s_suppkey = l_suppkey GROUP BY l_orderkey"""
ORACLE["share_of_total"] = """
SELECT event_type, count(*) AS event_count,
       CAST(round(100.0 * count(*) / sum(count(*)) OVER (), 2) AS DOUBLE) AS event_share
FROM events GROUP BY event_type"""

# --- Star schema ---------------------------------------------------------------------------------

_mart("dim_issue", "SELECT * FROM dim_issue")
_mart("dim_reviewer", "SELECT * FROM dim_reviewer")
_mart("dim_state", "SELECT * FROM dim_state")
_mart("dim_status", "SELECT * FROM dim_status")
_mart(
    "dim_milestone",
    f"""SELECT milestone_key, milestone, CAST(milestone_number AS BIGINT) AS milestone_number,
           {_day('deadline_date')} AS deadline_date FROM dim_milestone""",
)
_mart(
    "dim_date",
    f"""SELECT date_key, {_day('date')} AS date, year(date) AS year, month(date) AS month,
           monthname(date) AS month_name, day(date) AS day, dayname(date) AS day_name
       FROM dim_date""",
)
_mart(
    "fact_snapshot",
    f"""SELECT f.submission_snapshot_key, f.run_id, f.issue_key, f.state_key, f.status_key,
           f.milestone_key, c.date_key AS created_at_key, u.date_key AS updated_at_key,
           e.date_key AS extracted_at_key, {_time('f.created_at')} AS created_at,
           {_time('f.updated_at')} AS updated_at, {_time('f.extracted_at')} AS extracted_at,
           f.is_assigned, f.days_since_update, f.submission_age_days
       FROM fact f
       JOIN dim_date c ON c.date = {_local('f.created_at')}
       JOIN dim_date u ON u.date = {_local('f.updated_at')}
       JOIN dim_date e ON e.date = {_local('f.extracted_at')}""",
)
_mart("bridge_reviewer", "SELECT submission_snapshot_key, reviewer_key FROM bridge")
_mart(
    "date_role_keys",
    f"""SELECT submission_snapshot_key, {_day(_local('created_at'))} AS created_at_date,
           {_day(_local('updated_at'))} AS updated_at_date,
           {_day(_local('extracted_at'))} AS extracted_at_date FROM fact""",
)

_ISSUE_LOADS = (
    _SNAPSHOT_SILVER.rstrip()
    + f""",
offered AS (
    SELECT run_id, issue_id, issue_title || ' @ ' || {_day('updated_at')} AS issue_title, issue_url,
           CASE WHEN days_since_update <= 365 THEN issue_author END AS issue_author
    FROM silver
),
first_seen AS (
    SELECT issue_id, min(run_id) AS first_run,
           row_number() OVER (ORDER BY min(run_id), issue_id) AS issue_key
    FROM offered GROUP BY issue_id
),
loaded AS (
    SELECT CASE WHEN first_run = 'run-1998' THEN issue_key END AS old_key, issue_key,
           issue_id, issue_title, issue_url, issue_author
    FROM first_seen JOIN offered USING (issue_id) WHERE run_id = 'run-2001'
)
"""
)
ORACLE["dim_upsert_scd1"] = (
    _ISSUE_LOADS + "SELECT issue_key, issue_id, issue_title, issue_url, issue_author FROM loaded"
)
ORACLE["key_stability"] = (
    _ISSUE_LOADS
    + """SELECT count(*) FILTER (WHERE old_key = issue_key) AS kept,
       count(*) FILTER (WHERE old_key <> issue_key) AS changed,
       count(*) FILTER (WHERE old_key IS NULL) AS added, max(issue_key) AS greatest_key
FROM loaded"""
)
_silver(
    "dim_insert_only",
    """, seen AS (
    SELECT reviewer, min(run_id) AS first_run FROM (
        SELECT run_id, unnest(reviewer) AS reviewer FROM silver) GROUP BY reviewer)
SELECT row_number() OVER (ORDER BY first_run, reviewer) AS reviewer_key, reviewer FROM seen""",
)

# --- Nested pages and silver: straight from the flat tables ---------------------------------------

# The pages as text, written out; the reader must have kept every character.
_silver(
    "raw_payloads",
    """, texts AS (
    SELECT run_id, o_orderkey, o_orderkey // 100 + 1 AS page_no, issue_id,
           '{"content":{"id":"' || issue_id || '","title":"' || issue_title || '","url":"' || issue_url
           || '","author":' || coalesce('{"login":"' || issue_author || '"}', 'null')
           || ',"createdAt":"' || strftime(created_at, '%Y-%m-%dT%H:%M:%SZ')
           || '","updatedAt":"' || strftime(updated_at, '%Y-%m-%dT%H:%M:%SZ')
           || '","state":"' || state || '","assignees":{"nodes":['
           || array_to_string(list_transform(reviewer, lambda r: '{"login":"' || r || '"}'), ',')
           || ']},"labels":{"nodes":[{"name":"board"}'
           || CASE WHEN o_orderkey % 2 = 0 THEN ',{"name":"' || milestone || '"}' ELSE '' END
           || ']}},"fieldValues":{"nodes":[{"name":null,"field":{"name":"Title"}},{"name":'
           || coalesce('"' || status || '"', 'null') || ',"field":{"name":"Status"}}]}}' AS node
    FROM silver
), pages AS (
    SELECT run_id, page_no, string_agg(node, ',' ORDER BY issue_id) AS nodes FROM texts GROUP BY ALL
), bodies AS (
    SELECT run_id, page_no,
           '{"data":{"organization":{"projectV2":{"items":{"nodes":[' || nodes
           || '],"pageInfo":{"hasNextPage":'
           || CASE WHEN page_no < max(page_no) OVER (PARTITION BY run_id) THEN 'true' ELSE 'false' END
           || ',"endCursor":"page-' || page_no || '"}}}}}}' AS body
    FROM pages
)
SELECT run_id, page_no, length(body) AS text_length, md5(body) AS text_digest FROM bodies""",
)
_silver(
    "payload_documents",
    """SELECT run_id || '/' || ((page_no + 9) // 10) AS run_id,
           row_number() OVER (PARTITION BY run_id, (page_no + 9) // 10 ORDER BY page_no) AS page_no,
           first_issue_id
       FROM (SELECT run_id, o_orderkey // 100 + 1 AS page_no, min(issue_id) AS first_issue_id
             FROM silver GROUP BY ALL)""",
)
_silver(
    "payload_files",
    """SELECT run_id, row_number() OVER (PARTITION BY run_id ORDER BY page_no) AS page_no, first_issue_id
       FROM (SELECT run_id, o_orderkey // 100 + 1 AS page_no, min(issue_id) AS first_issue_id
             FROM silver GROUP BY ALL)""",
)
ORACLE["payload_quarantine"] = """
SELECT event_id, CASE WHEN event_type = 'error' THEN 'rejected' ELSE 'decoded' END AS outcome
FROM events"""
_silver(
    "bronze_lookup",
    """SELECT DISTINCT run_id, CAST(1 AS BIGINT) AS attempt_number, o_orderkey // 100 + 1 AS page_no
       FROM silver WHERE run_id = 'run-2000'""",
)
_silver("unnest_pages", "SELECT run_id, issue_id FROM silver")
_silver(
    "flatten_nodes",
    f"""SELECT run_id, {_time('extracted_at')} AS extracted_at, issue_id, issue_title, issue_url,
           issue_author, {_time('created_at')} AS created_at, {_time('updated_at')} AS updated_at,
           state FROM silver""",
)
_silver("non_issue_counts", "SELECT run_id, CAST(0 AS BIGINT) AS non_issue_count FROM silver GROUP BY run_id")
_silver("reviewer_list", "SELECT run_id, issue_id, array_to_string(reviewer, ',') AS reviewer FROM silver")
_silver(
    "milestone_resolve",
    """SELECT run_id, issue_id, CASE WHEN o_orderkey % 2 = 0 THEN milestone END AS label_milestone,
           milestone AS title_milestone, milestone FROM silver""",
)
_silver("status_lookup", "SELECT run_id, issue_id, status FROM silver")
_silver(
    "exclude_authors",
    """SELECT run_id, issue_id, issue_author FROM silver WHERE issue_author IS NULL
       OR issue_author NOT IN ('Customer#000000007', 'Customer#000000011')""",
)
_silver(
    "exclude_author_table",
    """SELECT run_id, issue_id, issue_author FROM silver s WHERE NOT EXISTS (
           SELECT 1 FROM customer c WHERE c.c_acctbal < 0 AND c.c_name = s.issue_author)""",
)
ORACLE["title_predicate"] = r"""
WITH titled AS (
    SELECT p_partkey,
           CASE WHEN p_size < 20 THEN '[M' || p_size || '] ' || p_name
                WHEN p_size < 30 THEN p_name || ' [M1]'
                WHEN p_size < 40 THEN '[Mx] ' || p_name END AS title
    FROM part)
SELECT p_partkey, coalesce(regexp_matches(title, '^\[M\d+\]'), false) AS is_kept,
       nullif(regexp_extract(title, '\[(M\d+)\]', 1), '') AS title_milestone
FROM titled"""
ORACLE["timestamp_floor"] = f"""
SELECT event_id, {_time("date_trunc('second', ts)")} AS floored, {_day(_local('ts'))} AS local_day
FROM events"""
ORACLE["elapsed_days"] = f"""
SELECT l_orderkey, l_partkey, l_suppkey, CAST(l_linenumber AS BIGINT) AS l_linenumber,
       {_days('o_orderdate', "l_shipdate + INTERVAL '16 hours 30 minutes'")} AS days
FROM lineitem JOIN orders ON o_orderkey = l_orderkey"""
_silver(
    "is_assigned",
    """SELECT run_id, issue_id, is_assigned, CAST(len(reviewer) AS BIGINT) AS reviewer_count
       FROM silver""",
)
_silver(
    "latest_per_author_milestone",
    """SELECT run_id, issue_author, milestone, issue_id FROM silver
       QUALIFY row_number() OVER (PARTITION BY run_id, issue_author, milestone
           ORDER BY created_at DESC, updated_at DESC, issue_id DESC) = 1""",
)

# --- Ledger -------------------------------------------------------------------------------------------

_EVENT_ATTEMPTS = """WITH attempts AS (
    SELECT 'u' || user_id AS run_id, event_id AS attempt_number, props AS payload, event_type,
           value, CASE WHEN event_type = 'error' THEN 'failed' ELSE 'succeeded' END AS status
    FROM events)
"""
ORACLE["attempt_exists"] = (
    _EVENT_ATTEMPTS
    + """SELECT run_id, attempt_number, event_type IN ('error', 'purchase') AS attempt_exists
FROM attempts"""
)
_CANONICAL = """SELECT run_id, attempt_number, payload FROM attempts WHERE status = 'succeeded'
QUALIFY row_number() OVER (PARTITION BY run_id ORDER BY attempt_number DESC) = 1"""
ORACLE["canonical_attempt"] = _EVENT_ATTEMPTS + _CANONICAL
ORACLE["pending_bronze"] = (
    _EVENT_ATTEMPTS
    + f"""SELECT * FROM ({_CANONICAL}) c WHERE NOT EXISTS (
    SELECT 1 FROM customer WHERE c_acctbal < 4000 AND 'u' || c_custkey = c.run_id)"""
)
_silver("pending_silver", f"SELECT {_SILVER_COLUMNS} FROM silver WHERE run_id <> 'run-2000'")
ORACLE["single_extraction_check"] = """
SELECT CAST(l_orderkey AS VARCHAR) AS run_id, count(DISTINCT l_shipdate) AS extraction_times
FROM lineitem GROUP BY l_orderkey HAVING count(DISTINCT l_shipdate) <> 1"""
ORACLE["gold_guards"] = """
SELECT CAST(l_orderkey AS VARCHAR) AS run_id, count(DISTINCT l_shipdate) AS extraction_times,
       CASE WHEN count(DISTINCT l_shipdate) <> 1 THEN 'more than one extraction timestamp'
            WHEN l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')
                THEN 'already loaded' END AS problem
FROM lineitem GROUP BY l_orderkey"""
ORACLE["redact_truncate"] = """
WITH redacted AS (
    SELECT doc_id, replace(replace(text, 'the', '[REDACTED]'), 'er', '[REDACTED]') AS message
    FROM documents)
SELECT doc_id, length(message) AS n_full, md5(message) AS full_digest,
       length(left(message, 2000)) AS n_kept, md5(left(message, 2000)) AS kept_digest
FROM redacted"""
ORACLE["failure_append"] = (
    _EVENT_ATTEMPTS
    + """SELECT run_id, attempt_number, 'failed' AS attempt_status,
       left('[REDACTED] failed: ' || payload, 24) AS error_message
FROM attempts WHERE status = 'failed' AND value <= 50"""
)
ORACLE["attempt_mismatches"] = (
    _EVENT_ATTEMPTS
    + """SELECT run_id, attempt_number, 'no succeeded attempt' AS problem FROM attempts
WHERE event_type IN ('click', 'error')
UNION ALL
SELECT run_id, attempt_number, 'no extraction' FROM attempts WHERE event_type = 'view'"""
)
_silver(
    "gold_load_ledger",
    f"SELECT DISTINCT run_id, {_time('extracted_at')} AS extracted_at FROM silver",
)

# --- Constraints -----------------------------------------------------------------------------------------

ORACLE["pk_violations"] = """
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, count(*) AS row_count
FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1"""
ORACLE["grain_check"] = f"""
SELECT CAST(l_partkey AS VARCHAR) AS issue_id, {_time('l_shipdate')} AS extracted_at,
       count(*) AS row_count
FROM lineitem GROUP BY l_partkey, l_shipdate HAVING count(*) > 1"""
_NULLABLE = (
    "issue_id issue_title issue_url issue_author created_at updated_at state reviewer milestone "
    "status run_id extracted_at is_assigned days_since_update submission_age_days"
).split()
_silver(
    "null_counts",
    "\nUNION ALL\n".join(
        f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS null_count FROM silver"
        for c in _NULLABLE
    ),
)
ORACLE["fk_violations"] = """
SELECT o_custkey, o_orderkey FROM orders
WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal >= 0)"""
ORACLE["check_violations"] = """
WITH rows AS (
    SELECT event_id,
           CASE WHEN event_type = 'view' THEN 'unknown' WHEN event_type = 'error' THEN 'failed'
                WHEN event_type <> 'signup' THEN 'succeeded' END AS status,
           CASE WHEN value > 50 THEN 'teleport'
                WHEN event_type = 'error' THEN 'extraction' END AS stage,
           CASE WHEN event_type = 'error' THEN 'ExtractionError' END AS kind,
           CASE WHEN event_type = 'error' THEN props END AS message
    FROM events)
SELECT event_id, 'status_domain' AS failed_check FROM rows WHERE status = 'unknown'
UNION ALL
SELECT event_id, 'stage_domain' FROM rows WHERE stage = 'teleport'
UNION ALL
SELECT event_id, 'diagnostics' FROM rows WHERE NOT coalesce(
    (status = 'succeeded' AND stage IS NULL AND kind IS NULL AND message IS NULL)
    OR (status = 'failed' AND stage IS NOT NULL AND kind IS NOT NULL AND message IS NOT NULL), true)"""
_mart(
    "foreign_keys_hold",
    "\nUNION ALL\n".join(
        f"SELECT '{name}' AS reference, count(*) AS orphan_count FROM {child} WHERE {key} IS NOT NULL"
        f" AND {key} NOT IN (SELECT {parent_key} FROM {parent})"
        for name, child, key, parent, parent_key in (
            ("gold.fact_submission_snapshot.issue_key", "fact", "issue_key", "dim_issue", "issue_key"),
            ("gold.fact_submission_snapshot.state_key", "fact", "state_key", "dim_state", "state_key"),
            ("gold.fact_submission_snapshot.status_key", "fact", "status_key", "dim_status", "status_key"),
            ("gold.fact_submission_snapshot.milestone_key", "fact", "milestone_key", "dim_milestone", "milestone_key"),
            ("gold.fact_submission_snapshot.created_at_key", "fact", _local("created_at"), "dim_date", "date"),
            ("gold.fact_submission_snapshot.updated_at_key", "fact", _local("updated_at"), "dim_date", "date"),
            ("gold.fact_submission_snapshot.extracted_at_key", "fact", _local("extracted_at"), "dim_date", "date"),
            ("gold.bridge_submission_reviewer.submission_snapshot_key", "bridge", "submission_snapshot_key", "fact", "submission_snapshot_key"),
            ("gold.bridge_submission_reviewer.reviewer_key", "bridge", "reviewer_key", "dim_reviewer", "reviewer_key"),
        )
    ),
)
_silver(
    "contract_validation",
    "\nUNION ALL\n".join(
        f"SELECT '{column}' AS column_name, '{role}' AS role, "
        f"count(*) FILTER (WHERE {bad}) AS bad_count FROM silver"
        for column, role, bad in (
            ("builder", "label", "issue_author IS NULL"),
            ("current_milestone", "label", "milestone IS NULL"),
            ("status", "label", "status IS NULL"),
            ("schedule_status", "label", "false"),
            ("reviewer", "label", "len(reviewer) = 0"),
            ("issue_state", "label", "state IS NULL"),
            ("submission_age_days", "numeric", "state <> 'OPEN'"),
            ("days_since_update", "numeric", "days_since_update IS NULL"),
            ("next_actor", "label", "false"),
            ("next_action", "label", "status IS NULL"),
            ("issue_url", "label", "issue_url IS NULL"),
        )
    ),
)

# --- Landed pages ---------------------------------------------------------------------------------------

ORACLE["page_validation"] = """
SELECT event_id AS page_no,
       CASE WHEN value > 60 THEN 'unexpected JSON response'
            WHEN event_type = 'click' THEN NULL
            WHEN event_type = 'view' THEN 'invalid pagination cursor'
            WHEN event_type = 'purchase' THEN 'project items not a list'
            WHEN event_type = 'signup' THEN 'non-JSON response'
            ELSE 'errors: limit ' || event_id || '; again' END AS reject_reason
FROM events"""
_CHAIN = """WITH pages AS (
    SELECT 'r' || (event_id // 500) AS run_id, event_id % 500 + 1 AS page_no,
           CASE WHEN event_type = 'purchase' THEN 'stale'
                WHEN event_id % 500 > 0 THEN 'c' || (event_id - 1) END AS request_cursor,
           event_type <> 'signup' AS has_next,
           CASE WHEN event_type = 'error' THEN '' ELSE 'c' || event_id END AS end_cursor
    FROM events),
followed AS (
    SELECT *, lag(page_no) OVER w AS previous, lag(has_next) OVER w AS previous_has_next,
           lag(end_cursor) OVER w AS previous_end
    FROM pages WINDOW w AS (PARTITION BY run_id ORDER BY page_no)),
chained AS (
    SELECT run_id, page_no, has_next,
           CASE WHEN page_no = 1 AND request_cursor IS NOT NULL THEN 'first page has a cursor'
                WHEN page_no > 1 AND previous IS DISTINCT FROM page_no - 1
                    THEN 'previous page missing'
                WHEN page_no > 1 AND NOT previous_has_next THEN 'page after the last page'
                WHEN page_no > 1 AND request_cursor IS DISTINCT FROM previous_end
                    THEN 'request cursor differs from previous end cursor'
                WHEN has_next AND (end_cursor = '' OR end_cursor = request_cursor)
                    THEN 'invalid pagination cursor' END AS chain_problem
    FROM followed)
"""
ORACLE["cursor_chain"] = _CHAIN + "SELECT run_id, page_no, chain_problem FROM chained"
ORACLE["run_completeness"] = (
    _CHAIN
    + """SELECT run_id, count(*) AS page_count, count(chain_problem) AS break_count,
       count(chain_problem) = 0 AND NOT arg_max(has_next, page_no) AS is_complete
FROM chained GROUP BY run_id"""
)

# --- Presentation ------------------------------------------------------------------------------------------

_DISPLAY_ORDER = """['Passed', 'In review', 'Needs Improvement', 'Unchecked/Unassigned', 'Accepted',
    'Needs changes', 'Not submitted', 'Unknown']"""
_mart(
    "status_pivot",
    "SELECT status, "
    + ", ".join(
        f"CAST(coalesce(sum(submission_count) FILTER (WHERE milestone = 'M{n}'), 0) AS BIGINT) AS \"M{n}\""
        for n in range(7)
    )
    + f""", CAST(coalesce(sum(submission_count) FILTER (
               WHERE coalesce(milestone NOT IN ('M0', 'M1', 'M2', 'M3', 'M4', 'M5', 'M6'), true)), 0)
             AS BIGINT) AS "other"
         , CAST(coalesce(nullif(list_position({_DISPLAY_ORDER}, status), 0), 9) AS BIGINT)
           AS display_rank
       FROM distribution GROUP BY status""",
)
_mart(
    "progress_series",
    f"""SELECT {_day('extraction_date')} AS extraction_date,
           average_completion_percentage AS completion_rate,
           (SELECT greatest(100.0, max(average_completion_percentage) + 10) FROM progress)::DOUBLE
               AS axis_max
       FROM progress""",
)
_mart(
    "workload_series",
    "SELECT reviewer, unresolved_count, reviewer = 'Unassigned' AS is_highlighted FROM workload",
)
_mart(
    "schedule_kpis",
    """SELECT CAST(v.n AS BIGINT) AS card_no, v.label, coalesce(s.builder_count, 0) AS value,
           coalesce(CAST(round_even(s.builder_percentage, 0) AS BIGINT) || '% of builders',
                    'No builder data') AS detail, v.tone
       FROM (VALUES (1, 'On track', 'success'), (2, 'Delayed', 'danger')) v(n, label, tone)
       LEFT JOIN schedule s ON lower(s.schedule_status) = lower(v.label)""",
)
_mart(
    "workload_kpis",
    """SELECT CAST(coalesce(sum(unresolved_count), 0) AS BIGINT) AS unresolved_total,
           CAST(coalesce(sum(unresolved_count) FILTER (WHERE reviewer = 'Unassigned'), 0) AS BIGINT)
               AS unassigned_count,
           count(*) FILTER (WHERE reviewer <> 'Unassigned') AS reviewer_count
       FROM workload""",
)
_mart(
    "facets",
    """SELECT 'status' AS facet, status AS choice, count(*) AS row_count
       FROM classified GROUP BY status
       UNION ALL
       SELECT 'schedule_status', schedule_status, count(*) FROM classified GROUP BY schedule_status""",
)
_mart(
    "queue_filter",
    """SELECT builder, reviewer, status FROM classified
       WHERE contains(lower(builder || ' ' || reviewer), 'supplier#000000003')
         AND lower(schedule_status) = 'on track'""",
)
_mart(
    "display_columns",
    """SELECT builder, replace(lower(status), ' ', '-') AS status_slug,
           replace(lower(schedule_status), ' ', '-') AS schedule_slug,
           upper(issue_state[1]) || lower(issue_state[2:]) AS state_label,
           submission_age_days || ' days' AS age_label,
           days_since_update || ' days ago' AS updated_label
       FROM classified""",
)

# --- Whole jobs ------------------------------------------------------------------------------------------------

_silver("publish_roundtrip", f"SELECT {_SILVER_COLUMNS} FROM silver")
ORACLE["catchup_silver"] = _LANDED_SILVER + f"SELECT {_SILVER_COLUMNS} FROM silver"
ORACLE["catchup_gold"] = (
    _LANDED_SILVER
    + """SELECT run_id, count(*) AS fact_count, CAST(sum(nullif(len(reviewer), 0)) AS BIGINT) AS bridge_count,
       CAST(sum(days_since_update) AS BIGINT) AS days_since_update,
       CAST(sum(submission_age_days) AS BIGINT) AS submission_age_days
FROM silver GROUP BY run_id"""
)
ORACLE["full_run"] = _LANDED_MART + "SELECT * FROM distribution"

# --- Boards with drafts and faults --------------------------------------------------------------------------

_silver(
    "user_board",
    """SELECT run_id, o_orderkey // 100 + 1 AS page_no, CAST(NULL AS VARCHAR) AS reject_reason,
           count(*) AS item_count, count(*) FILTER (WHERE o_orderkey % 7 = 0) AS draft_count
       FROM silver GROUP BY ALL""",
)
_silver(
    "user_board_drafts",
    """SELECT run_id, count(*) FILTER (WHERE o_orderkey % 7 = 0) AS non_issue_count,
           count(*) FILTER (WHERE o_orderkey % 7 <> 0) AS issue_count
       FROM silver GROUP BY run_id""",
)
ORACLE["faulty_attempts"] = """
SELECT run_id, CAST(number AS BIGINT) AS attempt_number, status AS attempt_status,
       CASE WHEN message IS NOT NULL THEN 'extraction' END AS error_stage, message AS error_message
FROM (VALUES ('run-1998', 1, 'succeeded', NULL), ('run-2000', 1, 'failed', 'non-JSON response'),
             ('run-2000', 2, 'succeeded', NULL), ('run-2001', 1, 'succeeded', NULL),
             ('run-twice', 1, 'failed', 'duplicate page'), ('run-untitled', 1, 'succeeded', NULL))
     AS t(run_id, number, status, message)
WHERE EXISTS (SELECT 1 FROM orders WHERE o_orderkey // 100 = 0)"""
ORACLE["faulty_runs"] = (
    _LANDED_SILVER
    + """SELECT run_id, count(*) AS row_count, count(*) AS fact_count,
       CAST(NULL AS VARCHAR) AS error_stage, CAST(NULL AS VARCHAR) AS error_message
FROM silver WHERE run_id <> 'run-2001' GROUP BY run_id
UNION ALL SELECT 'run-untitled', 0, NULL, NULL, NULL
UNION ALL SELECT 'run-2001', NULL, NULL, 'silver_transform', 'malformed pages'"""
)
ORACLE["failed_publish"] = (
    "WITH "
    + _SILVER.replace("SELECT * FROM measured", "SELECT * FROM measured WHERE run_id = 'run-1998'")
    + _STAR
    + "\n"
    + "\nUNION ALL\n".join(
        f"SELECT 'gold.{name}' AS table_name, count(*) AS row_count FROM {source}"
        for name, source in (
            *((d, d) for d in "dim_issue dim_reviewer dim_state dim_status dim_milestone dim_date".split()),
            ("fact_submission_snapshot", "fact"),
            ("bridge_submission_reviewer", "bridge"),
        )
    )
)
_mart(
    "dataset_build",
    "\nUNION ALL\n".join(
        f"SELECT '{name}' AS dataset, count(*) AS row_count FROM {source}"
        for name, source in (
            ("submission_status", "distribution"),
            ("builder_schedule", "schedule"),
            ("progress_trend", "progress"),
            ("interventions", "classified"),
            ("reviewer_workload", "workload"),
        )
    ),
)

_TABLE_NAMES = (
    "ops.pipeline_attempts",
    "ops.stage_failures",
    "bronze.raw_issue_extractions",
    "silver.issue_submissions",
    "ops.silver_loads",
    "ops.gold_loads",
    "gold.dim_issue",
    "gold.dim_reviewer",
    "gold.dim_state",
    "gold.dim_status",
    "gold.dim_milestone",
    "gold.dim_date",
    "gold.fact_submission_snapshot",
    "gold.bridge_submission_reviewer",
)
_silver(
    "create_tables",
    f"""SELECT table_name, CAST(0 AS BIGINT) AS rows_when_created, CASE table_name
               WHEN 'silver.issue_submissions' THEN (SELECT count(*) FROM silver)
               WHEN 'ops.silver_loads' THEN (SELECT count(DISTINCT run_id) FROM silver)
               WHEN '{_TABLE_NAMES[-2]}' THEN 0 END AS rows_when_loaded
        FROM (VALUES {", ".join(f"('{name}')" for name in _TABLE_NAMES)}) AS t(table_name)""",
)
_silver(
    "column_contract",
    """SELECT offer, CASE WHEN let_in THEN (SELECT count(*) FROM silver) ELSE 0 END AS rows_let_in
       FROM (VALUES ('as declared', true), ('in another order', true), ('without state', false),
                    ('with a column beyond it', false), ('with state twice', false),
                    ('renamed', false)) AS t(offer, let_in)""",
)
ORACLE["metric_registry"] = ORACLE["dataset_build"]
