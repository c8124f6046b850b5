"""Registered queries: one or more per operator family of the survey inventory.

Spark side: operators over ``fixtures.Tables``. Oracle side: the same question in DuckDB SQL over
the derived views. Fixed parameters (as_of, filters) appear as literals in both.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from .. import schemas as S
from ..operators import catalog as C
from ..operators import stages as ST
from .listspec import ListSpec
from .registry import register

# Fixed parameters of the registered queries.
AS_OF = dt.datetime(1999, 1, 1)  # for order-dated tables
AS_OF_SQL = "TIMESTAMP '1999-01-01 00:00:00'"
EV_AS_OF = dt.datetime(2024, 1, 20)  # for event-dated tables
EV_AS_OF_SQL = "TIMESTAMP '2024-01-20 00:00:00'"
AS_OF_YEAR = 2026  # two-digit year pivot used when parsing names

FILE_COLS_SQL = (
    "id, filename, catalog, state, year, month, segment, ftp_dir, ftp_path, size_bytes, remote_timestamp, "
    "root_path, dbc_path, csv_path, parquet_path, overall_status, last_seen_at, updated_at, seq"
)

# ============================================================================ catalog (§2.2, §2.4)


@register("size_by_state", "AGG-2,MATH-2,STR-1", """
SELECT upper(trim(state)) AS key, count(*) AS count,
       CAST(coalesce(sum(size_bytes), 0) AS BIGINT) AS total_size_bytes,
       CAST(round(coalesce(avg(size_bytes), 0)) AS BIGINT) AS avg_size_bytes
FROM files GROUP BY 1""")
def _size_by_state(t):
    return C.size_by_state(t.files)


@register("size_by_catalog", "AGG-3", """
SELECT upper(trim(catalog)) AS key, count(*) AS count,
       CAST(coalesce(sum(size_bytes), 0) AS BIGINT) AS total_size_bytes,
       CAST(round(coalesce(avg(size_bytes), 0)) AS BIGINT) AS avg_size_bytes
FROM files GROUP BY 1""")
def _size_by_catalog(t):
    return C.size_by_catalog(t.files)


@register("status_counts", "AGG-1", "SELECT overall_status, count(*) AS count FROM files GROUP BY 1")
def _status_counts(t):
    return C.status_counts(t.files)


@register("count_by_state", "AGG-4", "SELECT upper(trim(state)) AS key, count(*) AS count FROM files GROUP BY 1")
def _count_by_state(t):
    return C.count_by(t.files, "state")


@register("count_by_catalog", "AGG-4", "SELECT upper(trim(catalog)) AS key, count(*) AS count FROM files GROUP BY 1")
def _count_by_catalog(t):
    return C.count_by(t.files, "catalog")


@register("counts_raw_state", "AGG-5", "SELECT state AS key, count(*) AS count FROM files GROUP BY 1")
def _counts_raw_state(t):
    return C.counts_raw(t.files, "state")


@register("counts_raw_catalog", "AGG-5", "SELECT catalog AS key, count(*) AS count FROM files GROUP BY 1")
def _counts_raw_catalog(t):
    return C.counts_raw(t.files, "catalog")


@register("facets", "AGG-17,FLT-19,FLT-20", """
SELECT DISTINCT 'catalog' AS facet, upper(trim(catalog)) AS value FROM files WHERE catalog IS NOT NULL AND trim(catalog) <> ''
UNION ALL SELECT DISTINCT 'state', upper(trim(state)) FROM files WHERE state IS NOT NULL AND trim(state) <> ''
UNION ALL SELECT DISTINCT 'status', lower(trim(overall_status)) FROM files WHERE overall_status IS NOT NULL AND trim(overall_status) <> ''
UNION ALL SELECT DISTINCT 'period', printf('%04d-%02d', year, month) FROM files WHERE month BETWEEN 1 AND 12""")
def _facets(t):
    return C.facets(t.files)


@register("available_periods", "AGG-18", "SELECT DISTINCT year, month FROM files WHERE month BETWEEN 1 AND 12")
def _available_periods(t):
    return C.available_periods(t.files)


# --- lists (FLT-1..16, SORT-1..4)

SPEC_DEFAULT = ListSpec()


@register("list_files_default", "FLT-1,SORT-1,SORT-4,PRJ-7", f"""
SELECT {FILE_COLS_SQL} FROM files
ORDER BY coalesce(remote_timestamp, last_seen_at) DESC NULLS FIRST, id ASC LIMIT 50""")
def _list_default(t):
    return C.list_files(t.files, SPEC_DEFAULT)


SPEC_PERIOD = ListSpec(catalogs=("SP", "RD", "AQ"), states=("SP", "RJ", "MG", "BA"), period_from=(1996, 6),
                       period_to=(2000, 3), has_segment=True, sort_by="year_month", sort_dir="asc",
                       limit=100, offset=7)


@register("list_files_period", "FLT-2,FLT-3,FLT-5,FLT-9,SORT-2,SORT-4", f"""
SELECT {FILE_COLS_SQL} FROM files
WHERE catalog IN ('SP','RD','AQ') AND state IN ('SP','RJ','MG','BA')
  AND (year > 1996 OR (year = 1996 AND month >= 6)) AND (year < 2000 OR (year = 2000 AND month <= 3))
  AND segment IS NOT NULL
ORDER BY year ASC NULLS LAST, month ASC NULLS LAST, id ASC LIMIT 100 OFFSET 7""")
def _list_period(t):
    return C.list_files(t.files, SPEC_PERIOD)


SPEC_GLOB = ListSpec(filename="sp*.dbc", statuses=("pending", "failed", "csv_ready", ""), ftp_dir="/pub/SP",
                     sort_by="segment", sort_dir="desc", limit=500)


@register("list_files_glob", "FLT-6,FLT-7,FLT-10,SORT-1,STR-5", f"""
SELECT {FILE_COLS_SQL} FROM files
WHERE ftp_dir = '/pub/SP' AND filename ILIKE 'sp%.dbc' ESCAPE '#' AND overall_status IN ('pending','failed','csv_ready')
ORDER BY segment DESC NULLS FIRST, id ASC LIMIT 500""")
def _list_glob(t):
    return C.list_files(t.files, SPEC_GLOB)


SPEC_SEGMENT = ListSpec(catalog="SP", state="", year=1997, month=None, segment=" c ", policy_match="", status="",
                        sort_by="overall_status", sort_dir="asc", limit=500)


@register("list_files_segment", "FLT-4,FLT-8,SORT-3", f"""
SELECT {FILE_COLS_SQL} FROM files
WHERE catalog = 'SP' AND year = 1997 AND segment = 'C'
ORDER BY CASE overall_status {' '.join(f"WHEN '{s}' THEN {i + 1}" for i, s in enumerate(S.OVERALL_STATUSES))} END ASC, id ASC
LIMIT 500""")
def _list_segment(t):
    return C.list_files(t.files, SPEC_SEGMENT)


SPEC_POLICY_MATCH = ListSpec(policy_match=" Pending ", statuses=("pending", "ignored"), state="SP",
                             sort_by="updated_at", sort_dir="asc", limit=200)


@register("list_files_policy_match", "FLT-11,FLT-10,FLT-3", f"""
SELECT {FILE_COLS_SQL} FROM files
WHERE state = 'SP' AND overall_status IN ('pending','ignored') AND overall_status = 'pending'
ORDER BY updated_at ASC NULLS LAST, id ASC LIMIT 200""")
def _list_policy_match(t):
    return C.list_files(t.files, SPEC_POLICY_MATCH)


SPEC_COMPLETED = ListSpec(pipeline_completed=True, month=3, sort_by="filename", sort_dir="asc", limit=500)


@register("list_files_completed", "FLT-12,JOIN-7,JOIN-2", f"""
SELECT {FILE_COLS_SQL} FROM files
WHERE month = 3 AND id IN (SELECT file_id FROM progress WHERE done_stages = 3)
ORDER BY filename ASC, id ASC LIMIT 500""")
def _list_completed(t):
    return C.list_files(t.files, SPEC_COMPLETED, t.file_stages)


@register("count_files_filtered", "AGG-19,FLT-1", """
SELECT count(*) AS total FROM files
WHERE catalog IN ('SP','RD','AQ') AND state IN ('SP','RJ','MG','BA')
  AND (year > 1996 OR (year = 1996 AND month >= 6)) AND (year < 2000 OR (year = 2000 AND month <= 3))
  AND segment IS NOT NULL""")
def _count_filtered(t):
    return C.count_files(t.files, SPEC_PERIOD)


@register("count_files_completed", "AGG-19,FLT-12", """
SELECT count(*) AS total FROM files JOIN progress ON file_id = id WHERE done_stages = 3""")
def _count_completed(t):
    return C.count_files(t.files, ListSpec(pipeline_completed=True), t.file_stages)


@register("get_file_by_id", "FLT-13", f"SELECT {FILE_COLS_SQL} FROM files WHERE id = 'f1'")
def _get_by_id(t):
    return C.get_by(t.files, "id", "f1")


@register("find_files_by_event_ids", "FLT-14", f"""
SELECT {FILE_COLS_SQL} FROM files WHERE id IN (SELECT file_id FROM stage_events)""")
def _find_by_ids(t):
    return C.find_by_ids(t.files, t.stage_events, id_col="file_id")


@register("find_files_by_pattern", "FLT-15,SORT-7", f"""
SELECT {FILE_COLS_SQL} FROM files WHERE filename ILIKE '%AQ#_%' ESCAPE '#' OR filename ILIKE 'AQ%1.DBC' ESCAPE '#'""")
def _find_by_pattern(t):
    # two globs: a contains-search with a literal '_' and an anchored one
    return C.find_by_pattern(t.files, "AQ_").unionByName(C.find_by_pattern(t.files, "AQ*1.DBC")).distinct()


SPEC_BATCH = ListSpec(catalogs=("SP", "PA"), period_from=(1998, 1), sort_by="")


@register("find_files_by_filters", "FLT-16,FLT-18", f"""
SELECT {FILE_COLS_SQL} FROM files
WHERE catalog IN ('SP','PA') AND (year > 1998 OR (year = 1998 AND month >= 1))
""")
def _find_by_filters(t):
    return C.find_by_filters(t.files, SPEC_BATCH)


@register("failed_since", "JOIN-1", f"""
SELECT {FILE_COLS_SQL.replace('updated_at, seq', 'f.updated_at, seq').replace('id, filename', 'f.id, filename')},
       s.updated_at AS failed_at
FROM files f JOIN file_stages s ON s.file_id = f.id
WHERE s.status = 'failed' AND s.stage = 'csv_conversion' AND s.updated_at >= TIMESTAMP '1998-06-01 00:00:00'""")
def _failed_since(t):
    return C.failed_since(t.files, t.file_stages, dt.datetime(1998, 6, 1), "csv_conversion")


# ============================================================================ stages (§2.4, §2.5)


@register("completion_consistency", "AGG-10,JOIN-2,PRJ-5", """
SELECT count(*) FILTER (WHERE done_stages = 3) AS pipeline_completed_count,
       count(*) FILTER (WHERE (done_stages = 3) <> (overall_status = 'parquet_ready')) AS status_stage_mismatch_count,
       count(*) FILTER (WHERE done_stages IS NULL) AS unknown_count
FROM files LEFT JOIN progress ON file_id = id""")
def _consistency(t):
    return ST.pipeline_consistency(t.files, t.file_stages, True, True, True, with_unknown=True)


@register("completion_consistency_csv_only", "AGG-10,PRJ-5", """
SELECT count(*) FILTER (WHERE done_before_last = 2) AS pipeline_completed_count,
       count(*) FILTER (WHERE (done_before_last = 2) <> (overall_status = 'csv_ready')) AS status_stage_mismatch_count
FROM files LEFT JOIN progress ON file_id = id""")
def _consistency_csv(t):
    return ST.pipeline_consistency(t.files, t.file_stages, True, True, False)


@register("top_failure_reasons", "AGG-7,SORT-5,STR-2", """
SELECT stage, coalesce(nullif(trim(error_message), ''), 'Unknown error') AS reason, count(*) AS total
FROM file_stages WHERE status = 'failed' GROUP BY 1, 2
ORDER BY total DESC, stage ASC, reason ASC LIMIT 10""")
def _top_failures(t):
    return ST.top_failure_reasons(t.file_stages, 10)


@register("stage_bottlenecks", "AGG-8,COND-1", """
SELECT stage, count(*) FILTER (WHERE status = 'pending') AS pending_count,
       count(*) FILTER (WHERE status = 'running') AS running_count,
       count(*) FILTER (WHERE status = 'failed') AS failed_count
FROM file_stages GROUP BY stage""")
def _bottlenecks(t):
    return ST.bottlenecks(t.file_stages)


@register("stage_done_counts", "AGG-9", """
SELECT count(*) FILTER (WHERE stage = 'download' AND status = 'done') AS download_done,
       count(*) FILTER (WHERE stage = 'csv_conversion' AND status = 'done') AS csv_done,
       count(*) FILTER (WHERE stage = 'parquet_conversion' AND status = 'done') AS parquet_done
FROM file_stages""")
def _done_counts(t):
    return ST.stage_done_counts(t.file_stages)


@register("failure_count_between", "AGG-11,DATE-1", """
SELECT count(*) AS failures FROM file_stages
WHERE status = 'failed' AND updated_at >= TIMESTAMP '1997-01-01 00:00:00' AND updated_at < TIMESTAMP '1998-01-01 00:00:00'""")
def _failure_between(t):
    return ST.failure_count_between(t.file_stages, dt.datetime(1997, 1, 1), dt.datetime(1998, 1, 1))


@register("pending_oldest_age", "AGG-12,DATE-2", f"""
SELECT coalesce(CAST(round(epoch({AS_OF_SQL}) - epoch(min(updated_at))) AS BIGINT), 0) AS oldest_pending_seconds
FROM file_stages WHERE status = 'pending'""")
def _pending_age(t):
    return ST.pending_oldest_age_seconds(t.file_stages, AS_OF)


@register("parquet_done_without_path", "JOIN-15", """
SELECT f.id, f.filename, f.overall_status, f.parquet_path, fs.status AS parquet_stage
FROM files f JOIN file_stages fs ON fs.file_id = f.id AND fs.stage = 'parquet_conversion'
WHERE fs.status = 'done' AND (f.parquet_path IS NULL OR trim(f.parquet_path) = '')""")
def _pq_without_path(t):
    return ST.parquet_done_without_path(t.files, t.file_stages)


@register("stages_of_file", "FLT-27,SORT-3", "SELECT file_id, stage, status, attempts, error_message, updated_at FROM file_stages WHERE file_id = 'f1'")
def _stages_of_file(t):
    return ST.stages_of_file(t.file_stages, "f1").select("file_id", "stage", "status", "attempts", "error_message", "updated_at")


@register("stage_run_block", "FLT-26", """
SELECT file_id, stage, CASE WHEN status = 'running' THEN 'stage is running' WHEN status = 'purged' THEN 'stage purged' END AS blocked_reason
FROM file_stages""")
def _run_block(t):
    return t.file_stages.select("file_id", "stage", ST.run_block_reason().alias("blocked_reason"))


@register("newest_logs_per_file", "WIN-4", """
SELECT id, file_id, stage, event_type, created_at FROM (
  SELECT *, row_number() OVER (PARTITION BY file_id ORDER BY created_at DESC, id DESC) AS rn FROM stage_events) x
WHERE rn <= 100""")
def _newest_logs(t):
    return ST.newest_logs(t.stage_events, 100).select("id", "file_id", "stage", "event_type", "created_at")


@register("newest_logs_one_file", "WIN-4,FLT-27", """
SELECT id, file_id, stage, event_type, created_at FROM stage_events WHERE file_id = 'f3'
ORDER BY created_at DESC, id DESC LIMIT 100""")
def _newest_logs_one(t):
    return ST.newest_logs(t.stage_events, 100, file_id="f3").select("id", "file_id", "stage", "event_type", "created_at")
