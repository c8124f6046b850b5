"""Registered queries: policy admission, reconcile, validation, enqueue-by-policy and job tables."""

from __future__ import annotations


from pyspark.sql import functions as F

from .. import schemas as S
from ..operators import jobs as J
from ..operators import policy as P
from .queries import AS_OF, AS_OF_SQL
from .registry import register

# SQL form of the admission predicate over a table aliased f.
ALLOWED_SQL = """(EXISTS (SELECT 1 FROM policy_catalogs c WHERE upper(trim(c.catalog)) = upper(trim(f.catalog)))
  AND EXISTS (SELECT 1 FROM policy_states s WHERE upper(trim(s.state)) = upper(trim(f.state)))
  AND (EXISTS (SELECT 1 FROM policy_years y WHERE y.year = f.year)
       OR EXISTS (SELECT 1 FROM policy_months m WHERE m.year = f.year AND m.month = f.month)))"""

VIEWS_POLICY = ("files", "policy_catalogs", "policy_states", "policy_years", "policy_months")


@register("policy_admission", "JOIN-3,JOIN-4,ARR-1", f"""
SELECT f.id, {ALLOWED_SQL} AS allowed FROM files f""", VIEWS_POLICY)
def _admission(t):
    return P.policy_allows(t.files, P.Policy.from_tables(t)).select("id", "allowed")


@register("policy_admission_flags", "JOIN-3", f"""
SELECT f.id,
  EXISTS (SELECT 1 FROM policy_catalogs c WHERE upper(trim(c.catalog)) = upper(trim(f.catalog))) AS catalog_hit,
  EXISTS (SELECT 1 FROM policy_states s WHERE upper(trim(s.state)) = upper(trim(f.state))) AS state_hit,
  EXISTS (SELECT 1 FROM policy_years y WHERE y.year = f.year) AS year_hit,
  EXISTS (SELECT 1 FROM policy_months m WHERE m.year = f.year AND m.month = f.month) AS month_hit,
  {ALLOWED_SQL} AS allowed
FROM files f""", VIEWS_POLICY)
def _admission_flags(t):
    return P.with_policy_flags(t.files, P.Policy.from_tables(t)).select(
        "id", "catalog_hit", "state_hit", "year_hit", "month_hit", "allowed")


@register("policy_denied_count", "JOIN-5", f"""
SELECT count(*) AS denied FROM files f WHERE NOT {ALLOWED_SQL}""", VIEWS_POLICY)
def _denied(t):
    return P.denied(t.files, P.Policy.from_tables(t)).agg(F.count(F.lit(1)).alias("denied"))


@register("pending_ignored_counts", "AGG-6", """
SELECT count(*) FILTER (WHERE overall_status = 'pending') AS pending,
       count(*) FILTER (WHERE overall_status = 'ignored') AS ignored FROM files""")
def _pending_ignored(t):
    return P.pending_and_ignored_counts(t.files)


RECONCILE_SQL = f"""
WITH flagged AS (SELECT f.*, {ALLOWED_SQL} AS allowed FROM files f)
SELECT id,
  CASE WHEN overall_status IN ('pending','downloaded','csv_ready') AND NOT allowed THEN 'ignored'
       WHEN overall_status = 'ignored' AND allowed THEN 'pending' ELSE overall_status END AS overall_status,
  CASE WHEN (overall_status IN ('pending','downloaded','csv_ready') AND NOT allowed) OR (overall_status = 'ignored' AND allowed)
       THEN {AS_OF_SQL} ELSE updated_at END AS updated_at
FROM flagged"""


@register("reconcile_statuses", "UPD-1", RECONCILE_SQL, VIEWS_POLICY)
def _reconcile(t):
    return P.reconcile_statuses(t.files, P.Policy.from_tables(t), AS_OF).select("id", "overall_status", "updated_at")


@register("reconcile_counts", "UPD-1", f"""
WITH flagged AS (SELECT f.*, {ALLOWED_SQL} AS allowed FROM files f)
SELECT count(*) FILTER (WHERE overall_status IN ('pending','downloaded','csv_ready') AND NOT allowed) AS to_ignored,
       count(*) FILTER (WHERE overall_status = 'ignored' AND allowed) AS to_pending FROM flagged""", VIEWS_POLICY)
def _reconcile_counts(t):
    return P.reconcile_counts(t.files, P.Policy.from_tables(t))


KNOWN_CATALOGS_SQL = ", ".join(f"('{c}')" for c in S.KNOWN_CATALOGS)
KNOWN_STATES_SQL = ", ".join(f"('{c}')" for c in S.KNOWN_STATES)


@register("available_catalogs", "SET-1,STR-1", f"""
SELECT DISTINCT value FROM (
  SELECT upper(trim(catalog)) AS value FROM files
  UNION SELECT upper(trim(catalog)) FROM policy_catalogs
  UNION SELECT * FROM (VALUES {KNOWN_CATALOGS_SQL}) k(value)) t
WHERE value IS NOT NULL AND trim(value) <> ''""")
def _available_catalogs(t):
    return P.available_catalogs(t.files, P.Policy.from_tables(t))


@register("available_states", "SET-2", f"""
SELECT DISTINCT value FROM (
  SELECT upper(trim(state)) AS value FROM files
  UNION SELECT upper(trim(state)) FROM policy_states
  UNION SELECT * FROM (VALUES {KNOWN_STATES_SQL}) k(value)) t
WHERE value IS NOT NULL AND trim(value) <> ''""")
def _available_states(t):
    return P.available_states(t.files, P.Policy.from_tables(t))


@register("known_catalogs_not_in_files", "JOIN-17", f"""
SELECT value FROM (VALUES {KNOWN_CATALOGS_SQL}) k(value)
WHERE value NOT IN (SELECT upper(trim(catalog)) FROM files)""")
def _known_not_seen(t):
    return P.known_codes_not_seen(t.files, "catalog", S.KNOWN_CATALOGS)


def _proposed(t):
    """The fixture policy plus a year and a month-year that no file has (rejected) and a
    month absent from files in a year that is present (accepted)."""
    pol = P.Policy.from_tables(t)
    spark = t.spark
    extra_years = spark.createDataFrame([(2099,), (1997,)], "year int")
    extra_months = spark.createDataFrame([(2099, 1), (1997, 13), (1996, 2)], "year int, month int")
    extra_states = spark.createDataFrame([(" sp ",), ("XX",)], "state string")
    extra_cats = spark.createDataFrame([("rd",), ("ABC",)], "catalog string")
    return P.Policy(pol.catalogs.unionByName(extra_cats), pol.states.unionByName(extra_states),
                    pol.years.unionByName(extra_years), pol.months.unionByName(extra_months), pol.config)


PROPOSED_SQL = f"""
WITH yrs AS (SELECT DISTINCT year FROM files WHERE year >= 0 AND month BETWEEN 1 AND 12),
pc AS (SELECT catalog FROM policy_catalogs UNION ALL SELECT * FROM (VALUES ('rd'), ('ABC')) v(catalog)),
ps AS (SELECT state FROM policy_states UNION ALL SELECT * FROM (VALUES (' sp '), ('XX')) v(state)),
py AS (SELECT year FROM policy_years UNION ALL SELECT * FROM (VALUES (2099), (1997)) v(year)),
pm AS (SELECT year, month FROM policy_months UNION ALL SELECT * FROM (VALUES (2099, 1), (1997, 13), (1996, 2)) v(year, month))"""


@register("validate_policy_rejects", "SET-10", PROPOSED_SQL + f"""
SELECT 'catalog' AS level, catalog AS value, 'invalid catalog' AS reason FROM pc WHERE length(upper(trim(catalog))) <> 2
UNION ALL SELECT 'state', state, 'invalid state' FROM ps
  WHERE length(upper(trim(state))) <> 2 OR upper(trim(state)) NOT IN (SELECT * FROM (VALUES {KNOWN_STATES_SQL}) k(v))
UNION ALL SELECT 'year', cast(year AS varchar), CASE WHEN year < 0 OR year > 9999 THEN 'invalid year'
  ELSE 'year not in periods discovered from stored files' END FROM py
  WHERE year < 0 OR year > 9999 OR year NOT IN (SELECT year FROM yrs)
UNION ALL SELECT 'month', printf('%d-%02d', year, month), CASE WHEN year < 0 OR year > 9999 THEN 'invalid year'
  WHEN month < 1 OR month > 12 THEN 'invalid month' ELSE 'month year not in periods discovered from stored files' END FROM pm
  WHERE year < 0 OR year > 9999 OR month < 1 OR month > 12 OR year NOT IN (SELECT year FROM yrs)""", VIEWS_POLICY)
def _validate_rejects(t):
    rejects, _ = P.validate_policy(t.files, _proposed(t))
    return rejects


@register("validate_policy_accepted_months", "SET-10", PROPOSED_SQL + """
SELECT DISTINCT year, month FROM pm
WHERE year BETWEEN 0 AND 9999 AND month BETWEEN 1 AND 12 AND year IN (SELECT year FROM yrs)""", VIEWS_POLICY)
def _validate_accepted(t):
    _, accepted = P.validate_policy(t.files, _proposed(t))
    return accepted.months


ENQUEUE_SQL = f"""
WITH elig AS (SELECT f.id FROM files f WHERE f.overall_status = 'pending' AND {ALLOWED_SQL}),
q AS (SELECT * FROM job_queue),
merged AS (
  SELECT coalesce(q.id, e.id || ':download') AS id, coalesce(q.file_id, e.id) AS file_id, coalesce(q.stage, 'download') AS stage,
         e.id IS NOT NULL AND (q.id IS NULL OR q.status IN ('failed','done','pending')) AS reset, q.status, q.available_at, q.locked_at, q.attempts
  FROM q FULL OUTER JOIN elig e ON q.file_id = e.id AND q.stage = 'download')"""


@register("enqueue_by_policy_queue", "UPD-2,JOIN-11,JOIN-6,JOIN-10,JOIN-12", ENQUEUE_SQL + f"""
SELECT id, file_id, stage, CASE WHEN reset THEN 'pending' ELSE status END AS status,
       CASE WHEN reset THEN {AS_OF_SQL} ELSE available_at END AS available_at,
       CASE WHEN reset THEN NULL ELSE locked_at END AS locked_at,
       CASE WHEN reset THEN 0 ELSE attempts END AS attempts
FROM merged""", VIEWS_POLICY + ("job_queue",))
def _enqueue_queue(t):
    _, queue, _ = P.enqueue_pending_by_policy(t.files, t.file_stages, t.job_queue, P.Policy.from_tables(t), AS_OF)
    return queue


@register("enqueue_by_policy_counts", "UPD-2,JOIN-11", ENQUEUE_SQL + """
SELECT count(*) FILTER (WHERE reset) AS affected,
       count(*) FILTER (WHERE stage = 'download' AND file_id IN (SELECT id FROM elig) AND status = 'running') AS kept_running FROM merged""",
          VIEWS_POLICY + ("job_queue",))
def _enqueue_counts(t):
    _, _, counts = P.enqueue_pending_by_policy(t.files, t.file_stages, t.job_queue, P.Policy.from_tables(t), AS_OF)
    return counts


@register("enqueue_by_policy_stages", "UPD-2,JOIN-6,JOIN-10,JOIN-12", f"""
WITH elig AS (SELECT f.id FROM files f WHERE f.overall_status = 'pending' AND {ALLOWED_SQL}),
wanted AS (SELECT e.id AS file_id, s.stage FROM elig e CROSS JOIN (VALUES ('download'), ('csv_conversion'), ('parquet_conversion')) s(stage)),
added AS (SELECT w.file_id, w.stage, 'pending' AS status, 0 AS attempts, NULL::VARCHAR AS error_message, {AS_OF_SQL} AS updated_at
          FROM wanted w WHERE NOT EXISTS (SELECT 1 FROM file_stages fs WHERE fs.file_id = w.file_id AND fs.stage = w.stage)),
allr AS (SELECT file_id, stage, status, attempts, error_message, updated_at FROM file_stages UNION ALL SELECT * FROM added)
SELECT a.file_id, a.stage,
  CASE WHEN a.stage = 'download' AND a.file_id IN (SELECT id FROM elig) THEN 'pending' ELSE a.status END AS status,
  a.attempts,
  CASE WHEN a.stage = 'download' AND a.file_id IN (SELECT id FROM elig) THEN NULL ELSE a.error_message END AS error_message,
  CASE WHEN a.stage = 'download' AND a.file_id IN (SELECT id FROM elig) THEN {AS_OF_SQL} ELSE a.updated_at END AS updated_at
FROM allr a""", VIEWS_POLICY + ("file_stages",))
def _enqueue_stages(t):
    stages, _, _ = P.enqueue_pending_by_policy(t.files, t.file_stages, t.job_queue, P.Policy.from_tables(t), AS_OF)
    return stages.select("file_id", "stage", "status", "attempts", "error_message", "updated_at")


# ================================================================================ job tables


@register("queue_depth", "AGG-13", "SELECT stage, status, CAST(count(*) AS DOUBLE) AS depth FROM job_queue GROUP BY 1, 2")
def _depth(t):
    return J.depth(t.job_queue)


@register("due_jobs", "FLT-25,WIN-5", f"""
SELECT id, file_id, stage, status, available_at, locked_at, attempts, claim_rank FROM (
  SELECT *, row_number() OVER (PARTITION BY stage ORDER BY available_at ASC, id ASC) AS claim_rank
  FROM job_queue WHERE status = 'pending' AND available_at <= {AS_OF_SQL}) x WHERE claim_rank <= 5""")
def _due(t):
    return J.due_jobs(t.job_queue, AS_OF, 5)


@register("recover_stuck_jobs", "FLT-24,UPD-11,DATE-1", f"""
SELECT id, CASE WHEN status = 'running' AND locked_at < {AS_OF_SQL} - INTERVAL 30 MINUTE THEN 'pending' ELSE status END AS status,
       CASE WHEN status = 'running' AND locked_at < {AS_OF_SQL} - INTERVAL 30 MINUTE THEN {AS_OF_SQL} ELSE available_at END AS available_at,
       CASE WHEN status = 'running' AND locked_at < {AS_OF_SQL} - INTERVAL 30 MINUTE THEN NULL ELSE locked_at END AS locked_at
FROM job_queue""")
def _stuck(t):
    q, _ = J.recover_stuck(t.job_queue, AS_OF)
    return q.select("id", "status", "available_at", "locked_at")


@register("recover_stuck_count", "UPD-11", f"""
SELECT count(*) AS recovered FROM job_queue WHERE status = 'running' AND locked_at < {AS_OF_SQL} - INTERVAL 30 MINUTE""")
def _stuck_count(t):
    _, c = J.recover_stuck(t.job_queue, AS_OF)
    return c


@register("retry_plan", "UPD-10,MATH-1", """
SELECT id, file_id, stage, attempts, attempts >= 5 AS final, CASE WHEN attempts >= 5 THEN 'failed' ELSE 'pending' END AS queue_status,
       CASE WHEN attempts >= 5 THEN NULL ELSE least(30 * pow(2, attempts), 3600) END AS delay_seconds,
       CASE WHEN attempts >= 5 THEN NULL ELSE TIMESTAMP '1999-01-01 00:00:00' + to_seconds(CAST(least(30 * pow(2, attempts), 3600) AS BIGINT)) END AS retry_at
FROM job_queue WHERE status = 'failed'""")
def _retry_plan(t):
    fails = t.job_queue.where(F.col("status") == "failed").select(
        "id", "file_id", "stage", "attempts", F.lit("conversion failed").alias("error"))
    return J.plan_retries(fails, AS_OF, jitter=0.0).drop("error")


@register("retry_jitter", "MATH-1", """
SELECT id, attempts, true AS in_bounds FROM job_queue WHERE status = 'failed' AND attempts < 5""")
def _retry_jitter(t):
    """Each delay lies within a tenth of the delay without jitter."""
    fails = t.job_queue.where(F.col("status") == "failed").select("id", "file_id", "stage", "attempts", F.lit("x").alias("error"))
    with_jitter = J.plan_retries(fails, AS_OF).where(~F.col("final"))
    plain = J.backoff_seconds("attempts", "id", jitter=0.0)
    return with_jitter.select("id", "attempts", F.col("delay_seconds").between(plain * 0.9 - 0.001, plain * 1.1 + 0.001).alias("in_bounds"))


@register("job_duration_histogram", "AGG-26", """
WITH d AS (SELECT stage, duration_ms / 1000.0 AS v FROM stage_events WHERE event_type IN ('completed','failed') AND duration_ms IS NOT NULL),
b AS (SELECT * FROM (VALUES (1.0), (5.0), (15.0), (30.0), (60.0), (120.0), (300.0), (600.0), ('inf'::DOUBLE)) t(le))
SELECT s.stage, b.le, (SELECT count(*) FROM d WHERE d.stage = s.stage AND d.v <= b.le) AS cumulative_count
FROM (SELECT DISTINCT stage FROM d) s, b""")
def _histogram(t):
    return J.job_duration_histogram(t.stage_events)


@register("job_outcomes", "AGG-27", """
SELECT stage, CASE WHEN event_type = 'completed' THEN 'success' ELSE 'failure' END AS result, count(*) AS count
FROM stage_events WHERE event_type IN ('completed','failed') GROUP BY 1, 2""")
def _outcomes(t):
    return J.job_outcomes(t.stage_events)


@register("policy_selection_summary", "AGG-20", PROPOSED_SQL + f""",
ac AS (SELECT DISTINCT upper(trim(catalog)) AS v FROM pc WHERE length(upper(trim(catalog))) = 2),
ast AS (SELECT DISTINCT upper(trim(state)) AS v FROM ps
        WHERE length(upper(trim(state))) = 2 AND upper(trim(state)) IN (SELECT * FROM (VALUES {KNOWN_STATES_SQL}) k(v))),
ay AS (SELECT DISTINCT year FROM py WHERE year BETWEEN 0 AND 9999 AND year IN (SELECT year FROM yrs)),
am AS (SELECT DISTINCT year, month FROM pm WHERE year BETWEEN 0 AND 9999 AND month BETWEEN 1 AND 12 AND year IN (SELECT year FROM yrs)),
n AS (SELECT (SELECT count(*) FROM ac) AS catalog_count, (SELECT count(*) FROM ast) AS state_count,
             (SELECT count(*) FROM ay) + (SELECT count(*) FROM am) AS period_count)
SELECT catalog_count, state_count, period_count, catalog_count > 0 AND state_count > 0 AND period_count > 0 AS complete FROM n""",
          VIEWS_POLICY)
def _selection_summary(t):
    """AGG-20 over the policy accepted after validation against the files' periods."""
    _, accepted = P.validate_policy(t.files, _proposed(t))
    return P.selection_summary(accepted)
