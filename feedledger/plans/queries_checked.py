"""Registered queries that call an operator and compare the columns it makes itself."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..functions import filters as FM
from ..functions import names as N
from ..functions import text as TX
from ..functions.glob import glob_to_ilike
from ..operators import actions as A
from ..operators import audit as AU
from ..operators import jobs as J
from ..operators import name_index as NI
from ..operators import policy as P
from ..operators import scan as SC
from ..operators import stages as ST
from ..session import ensure_checkpoint_dir
from .queries import AS_OF
from .registry import register


@register("audit_rows_written", "SNK-5", """
SELECT 'purge' AS action, 'download' AS stage, 'ui' AS actor, '{"file_id":"' || file_id || '","attempts":' || attempts || '}' AS details_json,
       TIMESTAMP '1999-01-01 00:00:00' AS created_at
FROM file_stages WHERE status = 'failed'""")
def _audit_rows(t):
    failed = t.file_stages.where(F.col("status") == "failed")
    return A.audit_row(failed, "purge", "download", "  ", F.struct("file_id", "attempts"), AS_OF)


@register("content_digests", "SNK-6,HASH-1", """
SELECT doc_id, sha256(coalesce(text, '')) AS digest, substr(sha256(coalesce(text, '')), 1, 8) AS short FROM documents""", ("documents",))
def _digests(t):
    body = F.coalesce("text", F.lit("")).cast("binary")
    return t.documents.select("doc_id", N.content_digest(body).alias("digest"), N.short_digest(body).alias("short"))


@register("files_with_config", "JOIN-13", """
SELECT id, true AS enable_download, false AS enable_csv, true AS enable_parquet, NULL AS download_dir, '/csv' AS csv_dir, NULL AS parquet_dir FROM files""")
def _with_config(t):
    pol = P.Policy.from_lists(t.spark, catalogs=["SP"], states=["SP"], years=[1997], enable_csv=False, csv_dir="/csv")
    out = P.with_config(t.files, pol).select("id", "enable_download", "enable_csv", "enable_parquet", "download_dir", "csv_dir", "parquet_dir")
    return out.withColumns({c: F.col(c).cast("string") for c in ("download_dir", "csv_dir", "parquet_dir")})


@register("stage_plan_toggles_off", "JOIN-13,UPD-8", """
WITH st AS (SELECT file_id, max(CASE WHEN stage = 'parquet_conversion' THEN status END) AS s FROM file_stages GROUP BY file_id)
SELECT f.id AS file_id, 'parquet_conversion' AS stage
FROM files f LEFT JOIN st ON st.file_id = f.id
WHERE f.catalog IN ('SP','RD') AND f.state IN ('SP','MG') AND f.year IN (1996, 1997) AND f.dbc_path IS NOT NULL AND trim(f.dbc_path) <> ''
  AND f.dbc_path IN (SELECT path FROM artifacts) AND coalesce(st.s, 'pending') NOT IN ('running', 'done', 'purged')""")
def _plan_toggles(t):
    pol = P.Policy.from_lists(t.spark, catalogs=["SP", "RD"], states=["SP", "MG"], years=[1996, 1997], enable_download=False, enable_csv=False)
    return SC.plan_stages(t.files, t.file_stages, pol, t.artifacts)


@register("known_codes_absent", "JOIN-17", """
SELECT 'catalog' AS kind, value FROM (VALUES ('AD'),('RD'),('AQ'),('AM'),('BI'),('PA'),('AR'),('ER'),('PS'),('AN')) k(value)""")
def _codes_absent(t):
    from .. import schemas as S

    seen = t.files.where(F.col("catalog").isin("SP", "RJ"))
    return P.known_codes_not_seen(seen, "catalog", S.KNOWN_CATALOGS).select(F.lit("catalog").alias("kind"), "value")


@register("policy_rows_as_stored", "JOIN-3,JOIN-4", """
SELECT id, (catalog IN ('SP', 'XXL') AND state IN ('SP', 'ZZ') AND (year IN (1997, 12345) OR (year = 1998 AND month IN (3, 13)))) AS allowed
FROM (SELECT id, catalog, state, year, month FROM files UNION ALL SELECT id || 'x', 'XXL', 'ZZ', 12345, 13 FROM files) f""")
def _as_stored(t):
    """Selection rows outside the known codes and periods admit the files that carry them."""
    pol = P.Policy.from_lists(t.spark, catalogs=[" sp", "xxl", "xxl"], states=["SP", "zz "], years=[1997, 12345], months=[(1998, 3), (1998, 13)])
    base = t.files.select("id", "catalog", "state", "year", "month")
    odd = t.files.select(F.concat("id", F.lit("x")).alias("id"), F.lit("XXL").alias("catalog"), F.lit("ZZ").alias("state"), F.lit(12345).alias("year"), F.lit(13).alias("month"))
    return P.policy_allows(base.unionByName(odd), pol).select("id", "allowed")


@register("state_size_ranges", "STR-11", """
WITH r AS (SELECT state, min(size_bytes)::DOUBLE * 100 AS lo, max(size_bytes)::DOUBLE * 100000 AS hi, count(*) AS n FROM files WHERE size_bytes IS NOT NULL GROUP BY state),
e AS (SELECT state, lo, hi, n, floor(ln(floor(lo + 0.5)) / ln(1024)) AS i, floor(ln(floor(hi + 0.5)) / ln(1024)) AS j FROM r)
SELECT state, CAST(floor(lo / pow(1024, i) + 0.5) AS BIGINT) || ' ' || (['B', 'KB', 'MB', 'GB', 'TB'])[CAST(i AS INTEGER) + 1] || ' a ' ||
       CAST(floor(hi / pow(1024, j) + 0.5) AS BIGINT) || ' ' || (['B', 'KB', 'MB', 'GB', 'TB'])[CAST(j AS INTEGER) + 1] AS label,
       CAST(floor(lo / pow(1024, i) + 0.5) AS BIGINT) || ' ' || (['B', 'KB', 'MB', 'GB', 'TB'])[CAST(i AS INTEGER) + 1] AS same,
       '0 B (' || replace(format('{:,}', n * 1000), ',', '.') || ' arquivos)' AS counted
FROM e""")
def _size_ranges(t):
    r = t.files.where(F.col("size_bytes").isNotNull()).groupBy("state").agg(
        (F.min("size_bytes").cast("double") * 100).alias("lo"), (F.max("size_bytes").cast("double") * 100000).alias("hi"), F.count(F.lit(1)).alias("n"))
    return r.select("state", TX.size_range_label("lo", "hi").alias("label"), TX.size_range_label("lo", "lo").alias("same"),
                    TX.size_and_count_label(F.lit(0), F.col("n") * 1000).alias("counted"))


FILTER_MAPS = ['{"done":true,"year":1998,"codes":[" sp","","rd "]}', '{"done":" YES ","year":"1998"}', '{"done":1,"year":1998.9,"codes":"SP"}',
               '{"done":2,"codes":[]}', '{"done":"no","year":null}', "broken", '{"done":1.0,"year":-3}']


@register("json_filter_maps", "JSON-2,STR-7", f"""
SELECT event_id AS id, event_id % 7 IN (0, 1, 2, 6) AS truthy, CASE event_id % 7 WHEN 0 THEN 1998 WHEN 2 THEN 1998 WHEN 6 THEN -3 END::BIGINT AS year,
       CASE event_id % 7 WHEN 0 THEN 'SP,RD' ELSE '' END AS codes FROM events""", ("events",))
def _filter_maps(t):
    m = F.get(F.array(*[F.lit(x) for x in FILTER_MAPS]), (F.col("event_id") % 7).cast("int"))
    return t.events.select(F.col("event_id").alias("id"), m.alias("m")).select(
        "id", FM.json_truthy("m", "done").alias("truthy"), FM.json_int("m", "year").alias("year"), F.concat_ws(",", FM.json_codes("m", "codes")).alias("codes"))


@register("ack_jobs", "UPD-9", """
SELECT q.id, CASE WHEN q.status = 'running' THEN 'done' ELSE q.status END AS status, CASE WHEN q.status = 'running' THEN 'done' ELSE fs.status END AS stage_status,
       CASE WHEN q.status = 'running' THEN TIMESTAMP '1999-01-01 00:00:00' END AS finished_at, CASE WHEN q.status <> 'running' THEN fs.error_message END AS error_message
FROM job_queue q JOIN file_stages fs ON q.id = fs.file_id || ':' || fs.stage""")
def _ack(t):
    q, s = J.ack(t.job_queue, t.file_stages, t.job_queue.where(F.col("status") == "running"), AS_OF)
    s = s.select("file_id", "stage", F.col("status").alias("stage_status"), "finished_at", "error_message")
    return q.join(s, ["file_id", "stage"]).select("id", "status", "stage_status", "finished_at", "error_message")


@register("apply_retry_plan", "UPD-10", """
SELECT q.id, CASE WHEN q.status <> 'failed' THEN q.status WHEN q.attempts >= 5 THEN 'failed' ELSE 'pending' END AS status,
       CASE WHEN q.status = 'failed' AND q.attempts < 5
            THEN TIMESTAMP '1999-01-01 00:00:00' + to_seconds(CAST(least(30 * pow(2, q.attempts), 3600) AS BIGINT)) ELSE q.available_at END AS available_at,
       CASE WHEN q.status = 'failed' THEN 'failed' ELSE s.status END AS stage_status,
       CASE WHEN q.status = 'failed' THEN 'no luck' ELSE s.error_message END AS error_message,
       CASE WHEN q.status = 'failed' AND q.attempts >= 5 THEN TIMESTAMP '1999-01-01 00:00:00' END AS finished_at
FROM job_queue q JOIN file_stages s ON q.id = s.file_id || ':' || s.stage""")
def _apply_retries(t):
    fails = t.job_queue.where(F.col("status") == "failed").select("id", "file_id", "stage", "attempts", F.lit("no luck").alias("error"))
    q, s = J.apply_retries(t.job_queue, t.file_stages, J.plan_retries(fails, AS_OF, jitter=0.0), AS_OF)
    s = s.select("file_id", "stage", F.col("status").alias("stage_status"), "error_message", "finished_at")
    return q.join(s, ["file_id", "stage"]).select("id", "status", "available_at", "stage_status", "error_message", "finished_at")


@register("previous_with_null_keys", "WIN-7", """
SELECT id, lag(id) OVER (PARTITION BY CASE WHEN event_type = 'started' THEN NULL ELSE file_id END ORDER BY created_at, id) AS prev_id FROM stage_events""")
def _previous_null(t):
    df = t.stage_events.select("id", "created_at", F.when(F.col("event_type") != "started", F.col("file_id")).alias("k"))
    return AU.ordered_previous(df, ["k"], ["created_at", "id"], ["id"]).select("id", "prev_id")


@register("purged_stage_of_file", "FLT-26", """
SELECT file_id, stage FROM file_stages WHERE status = 'purged'""")
def _purged(t):
    return t.file_stages.where(ST.run_block_reason() == "stage purged").select("file_id", "stage")


GLOBS = ("SP*01.DBC", "*AC9*", "rd", "*6*.dbc", "AQ_", "*")


@register("find_files_by_index", "FLT-7,FLT-15,STR-5", " UNION ALL ".join(
    f"SELECT '{g}' AS glob, id, filename FROM files WHERE filename ILIKE '{glob_to_ilike(g)}' ESCAPE '#'" for g in GLOBS))
def _by_index(t):
    """Each glob through the name range and the posting table."""
    path = f"{ensure_checkpoint_dir(t.spark).rstrip('/')}/feedledger-names-{uuid.uuid4().hex[:12]}"
    NI.write_postings(t.files, path)
    out = None
    for g in GLOBS:
        found = NI.find_by_glob(t.files, g, path).select(F.lit(g).alias("glob"), "id", "filename")
        out = found if out is None else out.union(found)
    return out
