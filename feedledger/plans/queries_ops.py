"""Registered queries: selection expansion, bulk actions, stage-event folds and audits."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from .. import schemas as S
from ..operators import actions as A
from ..operators import audit as AU
from ..operators import policy as P
from ..operators import selection as SEL
from ..operators import stages as ST
from .listspec import ListSpec
from .queries import AS_OF, AS_OF_SQL, EV_AS_OF
from .queries_policy import ALLOWED_SQL, VIEWS_POLICY
from .registry import register

SEL_YEAR = 2026  # "current year" of the selection screen

# ================================================================================= selection


def _selection_keys(t):
    """The fixture keys plus keys derived from the catalog: one year key per file year and one
    month key per file period."""
    per = t.files.select("year", "month").distinct()
    years = per.select(F.lit("year").alias("level"), SEL.year_key(F.lit("SIH"), "year").alias("value"))
    months = per.select(F.lit("month").alias("level"), SEL.month_key(F.lit("SIA"), "year", "month").alias("value"))
    return t.selection_keys.unionByName(years).unionByName(months)


SEL_KEYS_SQL = """
keys AS (SELECT level, value FROM selection_keys
         UNION ALL SELECT DISTINCT 'year', printf('SIH:%04d', year) FROM files
         UNION ALL SELECT DISTINCT 'month', printf('SIA:%04d:%02d', year, month) FROM files),
k AS (SELECT DISTINCT level, value FROM keys),
parts AS (SELECT level, value, string_split(value, ':') AS p FROM k),
c AS (SELECT level, value, len(p) AS n,
        CASE WHEN level = 'catalog' THEN value ELSE p[1] END AS catalog,
        CASE WHEN level <> 'catalog' AND regexp_matches(p[2], '^[+-]?[0-9]+$') THEN TRY_CAST(p[2] AS INTEGER) END AS year,
        CASE WHEN level = 'month' AND regexp_matches(p[3], '^[+-]?[0-9]+$') THEN TRY_CAST(p[3] AS INTEGER) END AS month
      FROM parts),
r AS (SELECT *, CASE
        WHEN level = 'catalog' AND catalog NOT IN ('SIH','SIA','CNES','SIM','SINASC','SINAN','PNI','ESUS_APS','CIHA') THEN 'unknown catalog'
        WHEN level = 'catalog' THEN NULL
        WHEN level = 'year' AND n <> 2 THEN 'invalid key format'
        WHEN level <> 'year' AND n <> 3 THEN 'invalid key format'
        WHEN year IS NULL THEN 'invalid year'
        WHEN level <> 'year' AND month IS NULL THEN 'invalid month'
        WHEN catalog NOT IN ('SIH','SIA','CNES','SIM','SINASC','SINAN','PNI','ESUS_APS','CIHA') THEN 'unknown catalog'
        WHEN NOT (year BETWEEN 0 AND 2026) THEN 'year out of range'
        WHEN level <> 'year' AND NOT (month BETWEEN 1 AND 12) THEN 'month out of range' END AS reason FROM c)"""


@register("selection_invalid", "SET-6,STR-7", f"WITH {SEL_KEYS_SQL} SELECT level, value, reason FROM r WHERE reason IS NOT NULL",
          ("selection_keys", "files"))
def _sel_invalid(t):
    return SEL.invalid_selections(_selection_keys(t), SEL_YEAR)


@register("selection_jobs", "SET-5,SET-7,SET-3", f"""WITH {SEL_KEYS_SQL},
ok AS (SELECT * FROM r WHERE reason IS NULL),
jobs AS (
  SELECT catalog, y AS year, m AS month FROM ok, range(0, 2027) ty(y), range(1, 13) tm(m) WHERE level = 'catalog'
  UNION ALL SELECT catalog, year, m FROM ok, range(1, 13) tm(m) WHERE level = 'year'
  UNION ALL SELECT catalog, year, month FROM ok WHERE level = 'month')
SELECT DISTINCT catalog, CAST(year AS INTEGER) AS year, CAST(month AS INTEGER) AS month,
       printf('%s:%04d:%02d', catalog, year, month) AS key FROM jobs""", ("selection_keys", "files"))
def _sel_jobs(t):
    return SEL.build_download_jobs(_selection_keys(t), SEL_YEAR).select(
        "catalog", F.col("year").cast("int").alias("year"), F.col("month").cast("int").alias("month"), "key")


@register("compact_periods", "SET-8,SET-4", """
WITH m AS (SELECT DISTINCT year, month FROM files WHERE month BETWEEN 1 AND 12),
full_years AS (SELECT year FROM m GROUP BY year HAVING count(DISTINCT month) = 12),
ys AS (SELECT year FROM policy_years UNION SELECT year FROM full_years)
SELECT 'year' AS kind, year, CAST(NULL AS INTEGER) AS month FROM ys
UNION ALL SELECT 'month', year, month FROM m WHERE year NOT IN (SELECT year FROM ys)""")
def _compact(t):
    ms = t.files.where(F.col("month").between(1, 12)).select("year", "month").distinct()
    years, months = SEL.compact_periods(t.policy_years, ms)
    return years.select(F.lit("year").alias("kind"), "year", F.lit(None).cast("int").alias("month")).unionByName(
        months.select(F.lit("month").alias("kind"), "year", "month"))


@register("remove_month_from_year", "SET-9", """
WITH ys AS (SELECT DISTINCT year FROM files WHERE month BETWEEN 1 AND 12),
ms AS (SELECT year, month FROM policy_months),
other AS (SELECT 1997 AS year, m AS month FROM range(1, 13) t(m) WHERE m <> 5 AND 1997 IN (SELECT year FROM ys))
SELECT 'year' AS kind, CAST(year AS BIGINT) AS year, CAST(NULL AS BIGINT) AS month FROM ys WHERE year <> 1997
UNION ALL SELECT DISTINCT 'month', year, month FROM (SELECT * FROM ms WHERE NOT (year = 1997 AND month = 5) UNION ALL SELECT * FROM other)""")
def _remove_month(t):
    # a selection of every year the catalog has, then month 5 of 1997 is unselected
    file_years = t.files.where(F.col("month").between(1, 12)).select("year").distinct()
    years, months = SEL.remove_month(file_years, t.policy_months, 1997, 5)
    return years.select(F.lit("year").alias("kind"), F.col("year").cast("long").alias("year"),
                        F.lit(None).cast("long").alias("month")).unionByName(
        months.select(F.lit("month").alias("kind"), F.col("year").cast("long").alias("year"),
                      F.col("month").cast("long").alias("month")))


# =================================================================================== actions

BATCH_SPEC = ListSpec(catalogs=("SP", "AD", "RJ"), period_from=(1997, 1), period_to=(1999, 12))
BATCH_TARGETS_SQL = f"""
targets AS (SELECT * FROM files WHERE catalog IN ('SP','AD','RJ') AND (year > 1997 OR (year = 1997 AND month >= 1))
            AND (year < 1999 OR (year = 1999 AND month <= 12))),
dec AS (SELECT f.*, CASE WHEN overall_status = 'purged' THEN 'blocked_purged' WHEN NOT {ALLOWED_SQL} THEN 'blocked_policy'
               ELSE 'eligible' END AS decision FROM targets f)"""


def _targets(t):
    return A.resolve_targets(t.files, spec=BATCH_SPEC)


@register("batch_targets", "JOIN-18,SORT-7,FLT-16", f"""WITH {BATCH_TARGETS_SQL}
SELECT id, filename FROM targets ORDER BY filename""", VIEWS_POLICY)
def _batch_targets(t):
    return _targets(t).select("id", "filename")


@register("batch_preview", "AGG-23", f"""WITH {BATCH_TARGETS_SQL}
SELECT 'csv_conversion' AS stage, count(*) AS total_matched, count(*) FILTER (WHERE decision = 'eligible') AS eligible,
       count(*) FILTER (WHERE decision = 'blocked_policy') AS blocked_by_policy,
       count(*) FILTER (WHERE decision = 'blocked_purged') AS blocked_purged FROM dec""", VIEWS_POLICY)
def _batch_preview(t):
    return A.preview(_targets(t), P.Policy.from_tables(t), "csv_conversion")


@register("batch_enqueue_outcome", "AGG-24", f"""WITH {BATCH_TARGETS_SQL}
SELECT count(*) FILTER (WHERE decision = 'eligible') AS enqueued, count(*) FILTER (WHERE decision = 'blocked_purged') AS skipped,
       count(*) FILTER (WHERE decision = 'blocked_policy') AS skipped_by_policy FROM dec""", VIEWS_POLICY)
def _batch_outcome(t):
    _, _, out = A.enqueue_batch(_targets(t), t.file_stages, t.job_queue, P.Policy.from_tables(t), "csv_conversion", AS_OF)
    return out


@register("batch_enqueue_queue", "AGG-24,JOIN-11", f"""WITH {BATCH_TARGETS_SQL},
e AS (SELECT id AS file_id FROM dec WHERE decision = 'eligible'),
m AS (SELECT q.*, e.file_id AS e_id FROM job_queue q FULL OUTER JOIN e ON q.file_id = e.file_id AND q.stage = 'csv_conversion'),
r AS (SELECT *, e_id IS NOT NULL AND (id IS NULL OR status IN ('failed','done','pending')) AS reset FROM m)
SELECT coalesce(id, e_id || ':csv_conversion') AS id, coalesce(file_id, e_id) AS file_id, coalesce(stage, 'csv_conversion') AS stage,
       CASE WHEN reset THEN 'pending' ELSE status END AS status, CASE WHEN reset THEN 0 ELSE attempts END AS attempts FROM r""",
          VIEWS_POLICY + ("job_queue",))
def _batch_queue(t):
    _, q, _ = A.enqueue_batch(_targets(t), t.file_stages, t.job_queue, P.Policy.from_tables(t), "csv_conversion", AS_OF)
    return q.select("id", "file_id", "stage", "status", "attempts")


@register("reprocess_failures_outcome", "AGG-25,JOIN-1", f"""
WITH m AS (SELECT f.* FROM files f JOIN file_stages s ON s.file_id = f.id
           WHERE s.status = 'failed' AND s.stage = 'download' AND s.updated_at >= TIMESTAMP '1998-01-01 00:00:00')
SELECT count(*) AS matched, count(*) FILTER (WHERE {ALLOWED_SQL}) AS enqueued FROM m f""", VIEWS_POLICY + ("file_stages",))
def _reprocess(t):
    _, _, out = A.reprocess_failures(t.files, t.file_stages, t.job_queue, P.Policy.from_tables(t), "download",
                                     dt.datetime(1998, 1, 1), AS_OF)
    return out


@register("action_gate", "FLT-28,JOIN-13,AGG-20", f"""
SELECT f.id, CASE WHEN NOT {ALLOWED_SQL} THEN 'policy denied' END AS blocked_reason FROM files f""", VIEWS_POLICY)
def _gate(t):
    return A.action_gate(t.files, P.Policy.from_tables(t), "parquet_conversion").select("id", "blocked_reason")


@register("purge_files", "UPD-7,SNK-4", """
WITH tg AS (SELECT id FROM files WHERE catalog = 'AQ' AND year = 1996 AND overall_status <> 'purged')
SELECT id, CASE WHEN id IN (SELECT id FROM tg) THEN 'purged' ELSE overall_status END AS overall_status,
       CASE WHEN id IN (SELECT id FROM tg) THEN NULL ELSE dbc_path END AS dbc_path,
       CASE WHEN id IN (SELECT id FROM tg) THEN NULL ELSE csv_path END AS csv_path,
       CASE WHEN id IN (SELECT id FROM tg) THEN NULL ELSE parquet_path END AS parquet_path FROM files""")
def _purge(t):
    targets = t.files.where((F.col("catalog") == "AQ") & (F.col("year") == 1996))
    files, _, _, _ = A.purge(t.files, t.file_stages, targets, AS_OF)
    return files.select("id", "overall_status", "dbc_path", "csv_path", "parquet_path")


@register("purge_stage_rows", "UPD-7", f"""
WITH tg AS (SELECT id FROM files WHERE catalog = 'AQ' AND year = 1996 AND overall_status <> 'purged')
SELECT file_id, stage, CASE WHEN file_id IN (SELECT id FROM tg) THEN 'purged' ELSE status END AS status,
       CASE WHEN file_id IN (SELECT id FROM tg) THEN {AS_OF_SQL} ELSE updated_at END AS updated_at FROM file_stages""")
def _purge_stages(t):
    targets = t.files.where((F.col("catalog") == "AQ") & (F.col("year") == 1996))
    _, stages, _, _ = A.purge(t.files, t.file_stages, targets, AS_OF)
    return stages.select("file_id", "stage", "status", "updated_at")


@register("purge_paths", "UPD-7", """
SELECT id, path FROM (SELECT id, unnest([dbc_path, csv_path, parquet_path]) AS path FROM files
                      WHERE catalog = 'AQ' AND year = 1996 AND overall_status <> 'purged') x WHERE path IS NOT NULL""")
def _purge_paths(t):
    targets = t.files.where((F.col("catalog") == "AQ") & (F.col("year") == 1996))
    _, _, _, paths = A.purge(t.files, t.file_stages, targets, AS_OF)
    return paths


@register("apply_file_changes", "UPD-5", """
SELECT f.id, coalesce(c.h, f.overall_status) AS overall_status FROM files f
LEFT JOIN (SELECT file_id, 'failed' AS h FROM stage_events WHERE event_type = 'failed' GROUP BY file_id) c ON c.file_id = f.id""")
def _file_changes(t):
    changes = t.stage_events.where(F.col("event_type") == "failed").select(F.col("file_id").alias("id")).distinct() \
        .withColumn("overall_status", F.lit("failed"))
    return A.apply_file_changes(t.files, changes, EV_AS_OF).select("id", "overall_status")


@register("enqueue_log_rows", "SNK-4,JSON-1", f"""
SELECT f.id AS file_id, 'download' AS stage, 'enqueued' AS event_type, 'enqueued by policy' AS message,
       '{{"filename":"' || f.filename || '","year":' || f.year || '}}' AS payload_json
FROM files f WHERE f.overall_status = 'pending' AND {ALLOWED_SQL}""", VIEWS_POLICY)
def _log_rows(t):
    elig = P.admitted(t.files.where(F.col("overall_status") == "pending"), P.Policy.from_tables(t))
    rows = A.log_rows(elig.withColumnRenamed("id", "file_id"), "download", "enqueued", "enqueued by policy", AS_OF,
                      F.struct("filename", "year"))
    return rows.select("file_id", "stage", "event_type", "message", "payload_json")


@register("audit_rows_latest", "SNK-5,SORT-6", """
SELECT action, stage, actor, details_json FROM (
  SELECT 'stage_' || event_type AS action, stage, CASE WHEN id % 2 = 0 THEN 'ui' ELSE 'worker' END AS actor,
         '{"file_id":"' || file_id || '"}' AS details_json, created_at, id FROM stage_events)
ORDER BY created_at DESC, id DESC LIMIT 50""")
def _audit_latest(t):
    ev = t.stage_events
    rows = ev.select(F.concat(F.lit("stage_"), "event_type").alias("action"), "stage",
                     F.coalesce(F.nullif(F.trim(F.when(F.col("id") % 2 == 1, F.lit("worker")).otherwise(F.lit(" "))), F.lit("")),
                                F.lit(S.DEFAULT_ACTOR)).alias("actor"),
                     F.to_json(F.struct("file_id")).alias("details_json"), "created_at", "id")
    return A.latest_audit(rows, 50).select("action", "stage", "actor", "details_json")


# ================================================================================ stage folds


@register("latest_stage_state", "WIN-8", """
SELECT file_id, stage, event_type AS last_event, created_at AS last_event_at FROM (
  SELECT *, row_number() OVER (PARTITION BY file_id, stage ORDER BY created_at DESC, id DESC) AS rn FROM stage_events
  WHERE event_type IN ('enqueued','retrying','started','completed','failed','purged')) x WHERE rn = 1""")
def _latest_state(t):
    return ST.latest_stage_state(t.stage_events).select("file_id", "stage", "last_event", "last_event_at")


@register("apply_stage_events", "UPD-6,UPD-9,STM-2", """
WITH last AS (SELECT file_id, stage, event_type, message, created_at FROM (
   SELECT *, row_number() OVER (PARTITION BY file_id, stage ORDER BY created_at DESC, id DESC) AS rn FROM stage_events
   WHERE event_type IN ('enqueued','retrying','started','completed','failed','purged')) x WHERE rn = 1),
starts AS (SELECT file_id, stage, count(*) AS n FROM stage_events WHERE event_type = 'started' GROUP BY 1, 2),
ev AS (SELECT l.*, coalesce(s.n, 0) AS n FROM last l LEFT JOIN starts s USING (file_id, stage))
SELECT coalesce(fs.file_id, ev.file_id) AS file_id, coalesce(fs.stage, ev.stage) AS stage,
       coalesce(CASE ev.event_type WHEN 'enqueued' THEN 'pending' WHEN 'retrying' THEN 'pending' WHEN 'started' THEN 'running'
                WHEN 'completed' THEN 'done' WHEN 'failed' THEN 'failed' WHEN 'purged' THEN 'purged' END, fs.status) AS status,
       CAST(coalesce(fs.attempts, 0) + coalesce(ev.n, 0) AS INTEGER) AS attempts,
       CASE WHEN ev.event_type = 'failed' THEN ev.message WHEN ev.event_type IS NOT NULL AND ev.event_type <> 'purged' THEN NULL
            ELSE fs.error_message END AS error_message,
       coalesce(ev.created_at, fs.updated_at) AS updated_at
FROM file_stages fs FULL OUTER JOIN ev ON fs.file_id = ev.file_id AND fs.stage = ev.stage""")
def _apply_events(t):
    return ST.apply_stage_events(t.file_stages, t.stage_events).select(
        "file_id", "stage", "status", "attempts", "error_message", "updated_at")


# ==================================================================================== audits


@register("status_transition_audit", "WIN-7", f"""
SELECT file_id, seq, status, prev_status,
       CASE WHEN prev_status IS NULL THEN true ELSE (prev_status, status) IN ({", ".join(
           f"('{a}', '{b}')" for a, tos in S.ALLOWED_TRANSITIONS.items() for b in tos)}) END AS valid
FROM (SELECT *, lag(status) OVER (PARTITION BY file_id ORDER BY changed_at, seq) AS prev_status FROM status_history) x""")
def _transitions(t):
    return AU.transition_audit(t.status_history).select("file_id", "seq", "status", "prev_status", "valid")


@register("invalid_transition_counts", "WIN-7", f"""
SELECT prev_status AS from_status, status AS to_status, count(*) AS count
FROM (SELECT *, lag(status) OVER (PARTITION BY file_id ORDER BY changed_at, seq) AS prev_status FROM status_history) x
WHERE prev_status IS NOT NULL AND (prev_status, status) NOT IN ({", ".join(
           f"('{a}', '{b}')" for a, tos in S.ALLOWED_TRANSITIONS.items() for b in tos)}) GROUP BY 1, 2""")
def _invalid_counts(t):
    return AU.invalid_transition_counts(AU.transition_audit(t.status_history))
