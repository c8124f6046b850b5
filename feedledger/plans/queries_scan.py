"""Registered queries: name parsing, scan diff and merge, local sync, insights, labels and formats."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import schemas as S
from ..functions import names as N
from ..functions import text as TX
from ..operators import catalog as C
from ..operators import insights as I
from ..operators import policy as P
from ..operators import scan as SC
from ..operators import stages as ST
from .queries import AS_OF, AS_OF_SQL, AS_OF_YEAR
from .queries_policy import ALLOWED_SQL
from .registry import register

# DuckDB form of the name parser (same checks, same order as functions.names.parse_filename).
PARSE_SQL = f"""
l0 AS (SELECT *, upper(name) AS filename, regexp_extract(name, '(\\.[^./]*)$', 1) AS ext FROM listing),
l1 AS (SELECT *, upper(left(name, length(name) - length(ext))) AS base FROM l0),
l2 AS (SELECT *, strlen(base) AS blen, substr(base, 9, 1) AS lastc, substr(base, 1, 2) AS cat, substr(base, 3, 2) AS st,
              substr(base, 5, 2) AS yy, substr(base, 7, 2) AS mm FROM l1),
parsed AS (SELECT *, CASE WHEN lower(ext) <> '.dbc' THEN 'extension'
      WHEN blen NOT IN (8, 9) THEN 'length'
      WHEN blen = 9 AND NOT regexp_matches(lastc, '^[A-Za-z]$') THEN 'segment'
      WHEN NOT regexp_matches(cat, '^[A-Z]{{2}}$') THEN 'catalog'
      WHEN NOT regexp_matches(st, '^[A-Z]{{2}}$') THEN 'state'
      WHEN NOT regexp_matches(yy, '^[0-9]{{2}}$') THEN 'year'
      WHEN NOT regexp_matches(mm, '^[0-9]{{2}}$') THEN 'month'
      WHEN NOT (TRY_CAST(mm AS INTEGER) BETWEEN 1 AND 12) THEN 'month_range' END AS error FROM l2),
p AS (SELECT *, CASE WHEN error IS NULL THEN cat END AS p_catalog, CASE WHEN error IS NULL THEN st END AS p_state,
        CASE WHEN error IS NULL THEN CAST(CASE WHEN CAST(yy AS INTEGER) <= {AS_OF_YEAR % 100} THEN 2000 + CAST(yy AS INTEGER)
             ELSE 1900 + CAST(yy AS INTEGER) END AS INTEGER) END AS p_year,
        CASE WHEN error IS NULL THEN CAST(mm AS INTEGER) END AS p_month,
        CASE WHEN error IS NULL AND blen = 9 THEN lastc END AS p_segment FROM parsed)"""


@register("parse_listing_names", "PRJ-1,PRJ-2,FLT-22,STR-3,STR-4,STR-7,STR-9", f"""
WITH {PARSE_SQL}
SELECT seq, name, p_catalog AS catalog, p_state AS state, p_year AS year, p_month AS month, p_segment AS segment,
       error, lower(ext) = '.dbc' AS is_data FROM p""", ("listing",))
def _parse(t):
    l = N.with_parsed_name(t.listing, "name", AS_OF_YEAR, "_p")
    p = F.col("_p")
    return l.select("seq", "name", p.getField("catalog").alias("catalog"), p.getField("state").alias("state"),
                    p.getField("year").alias("year"), p.getField("month").alias("month"),
                    p.getField("segment").alias("segment"), p.getField("error").alias("error"),
                    N.has_data_extension("name").alias("is_data"))


CLASSIFY_SQL = f"""
WITH {PARSE_SQL},
j AS (SELECT p.*, f.id AS existing_id, f.size_bytes AS s_size, f.remote_timestamp AS s_ts, f.overall_status AS s_status
      FROM p LEFT JOIN files f ON f.ftp_dir = p.ftp_dir AND f.filename = p.filename),
c AS (SELECT *, CASE WHEN lower(ext) <> '.dbc' THEN 'other' WHEN error IS NOT NULL THEN 'unparsed'
             WHEN existing_id IS NULL THEN 'new'
             WHEN coalesce(s_size = size AND s_ts = mod_time, false) THEN 'unchanged' ELSE 'changed' END AS kind
      FROM j),
k AS (SELECT c.*, CASE WHEN error IS NULL THEN (
        EXISTS (SELECT 1 FROM policy_catalogs pc WHERE upper(trim(pc.catalog)) = c.p_catalog)
        AND EXISTS (SELECT 1 FROM policy_states ps WHERE upper(trim(ps.state)) = c.p_state)
        AND (EXISTS (SELECT 1 FROM policy_years py WHERE py.year = c.p_year)
             OR EXISTS (SELECT 1 FROM policy_months pm WHERE pm.year = c.p_year AND pm.month = c.p_month))) END AS allowed
      FROM c)"""
SCAN_VIEWS = ("listing", "files", "policy_catalogs", "policy_states", "policy_years", "policy_months")


def _classified(t):
    return SC.classify_listing(t.listing, t.files, P.Policy.from_tables(t), AS_OF_YEAR, order_col="seq")


@register("scan_diff_counts", "JOIN-8,FLT-23,AGG-14", CLASSIFY_SQL + """
SELECT count(*) FILTER (WHERE kind = 'new') AS new, count(*) FILTER (WHERE kind = 'changed') AS changed,
       count(*) FILTER (WHERE kind = 'unchanged') AS unchanged, count(*) FILTER (WHERE kind = 'unparsed') AS unparsed,
       count(*) FILTER (WHERE kind = 'other') AS other FROM k""", SCAN_VIEWS)
def _diff_counts(t):
    return SC.diff_counts(_classified(t))


@register("scan_classified", "JOIN-8,JOIN-3,PRJ-3,FLT-21", CLASSIFY_SQL + """
SELECT seq, filename, kind, existing_id, CASE WHEN kind = 'new' THEN 'pending' ELSE s_status END AS prev_status, allowed,
       kind IN ('new','changed','unchanged') AND NOT allowed
         AND (CASE WHEN kind = 'new' THEN 'pending' ELSE s_status END) IN ('pending','downloaded','csv_ready') AS to_ignore
FROM k""", SCAN_VIEWS)
def _classified_q(t):
    # an entry-level report: keep one row per listed entry (no collapsing of exact copies)
    c = SC.classify_listing(t.listing, t.files, P.Policy.from_tables(t), AS_OF_YEAR, order_col="seq", collapse=False)
    parsed = F.col("kind").isin("new", "changed", "unchanged")
    return c.select("seq", "filename", "kind", "existing_id", "prev_status", "allowed",
                    (parsed & ~F.col("allowed") & SC.should_move_to_ignored("prev_status")).alias("to_ignore"))


SUMMARY_SQL = CLASSIFY_SQL + """,
s AS (SELECT ftp_dir, count(*) FILTER (WHERE kind IN ('new','changed','unchanged')) AS found,
        count(*) FILTER (WHERE kind = 'new') AS new, count(*) FILTER (WHERE kind = 'changed') AS changed,
        count(*) FILTER (WHERE kind IN ('unparsed','unchanged')) AS skipped,
        count(*) FILTER (WHERE kind IN ('new','changed','unchanged') AND NOT allowed) AS skipped_by_policy
      FROM k GROUP BY ftp_dir)"""


@register("scan_summary_by_dir", "AGG-14,UPD-12", SUMMARY_SQL + " SELECT * FROM s", SCAN_VIEWS)
def _summary(t):
    return SC.scan_summary(_classified(t))


@register("scan_summary_legacy", "UPD-12,AGG-14", CLASSIFY_SQL + """
SELECT ftp_dir, count(*) FILTER (WHERE kind <> 'other') AS found FROM k GROUP BY ftp_dir""", SCAN_VIEWS)
def _summary_legacy(t):
    return SC.scan_summary(_classified(t), count_mode="legacy").select("ftp_dir", "found")


@register("scan_totals", "AGG-15", SUMMARY_SQL + """
SELECT CAST(sum(found) AS BIGINT) AS found, CAST(sum(new) AS BIGINT) AS new, CAST(sum(changed) AS BIGINT) AS changed,
       CAST(sum(skipped) AS BIGINT) AS skipped, CAST(sum(skipped_by_policy) AS BIGINT) AS skipped_by_policy FROM s""", SCAN_VIEWS)
def _totals(t):
    return SC.scan_totals(SC.scan_summary(_classified(t)))


@register("policy_skips_by_state", "AGG-16", CLASSIFY_SQL + """
SELECT p_state AS state, 'scanner_batch' AS source, count(*) AS skips FROM k
WHERE kind IN ('new','changed','unchanged') AND NOT allowed GROUP BY 1""", SCAN_VIEWS)
def _skips(t):
    return SC.policy_skips(_classified(t))


UPSERT_SQL = CLASSIFY_SQL + f""",
src AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY filename ORDER BY seq DESC) AS rn FROM k
                       WHERE kind IN ('new','changed')) x WHERE rn = 1),
m AS (SELECT f.id AS f_id, f.filename AS f_filename, f.ftp_path AS f_ftp_path, f.size_bytes AS f_size, f.remote_timestamp AS f_ts,
             f.segment AS f_segment, f.last_seen_at AS f_seen, f.overall_status AS f_status, src.*
      FROM files f FULL OUTER JOIN src ON f.filename = src.filename)"""


@register("upsert_listing", "JOIN-9,PRJ-3,UPD-3,HASH-1", UPSERT_SQL + f"""
SELECT coalesce(f_id, substr(sha256(filename), 1, 32)) AS id, coalesce(f_filename, filename) AS filename,
       CASE WHEN filename IS NOT NULL THEN remote_path ELSE f_ftp_path END AS ftp_path,
       CASE WHEN filename IS NOT NULL THEN size ELSE f_size END AS size_bytes,
       CASE WHEN filename IS NOT NULL THEN mod_time ELSE f_ts END AS remote_timestamp,
       CASE WHEN filename IS NOT NULL THEN p_segment ELSE f_segment END AS segment,
       CASE WHEN filename IS NOT NULL THEN {AS_OF_SQL} ELSE f_seen END AS last_seen_at,
       coalesce(f_status, 'pending') AS overall_status,
       CASE WHEN filename IS NOT NULL THEN f_id IS NULL END AS is_new
FROM m""", SCAN_VIEWS)
def _upsert(t):
    c = _classified(t)
    up = SC.upsert_files(t.files, SC.upsert_rows(c, "/data", "seq"), AS_OF)
    return up.select("id", "filename", "ftp_path", "size_bytes", "remote_timestamp", "segment", "last_seen_at",
                     "overall_status", "is_new")


MERGE_FILES_SQL = UPSERT_SQL + f""",
up AS (SELECT coalesce(f_id, substr(sha256(filename), 1, 32)) AS id, coalesce(f_filename, filename) AS filename,
              coalesce(f_status, 'pending') AS overall_status,
              CASE WHEN filename IS NOT NULL THEN {AS_OF_SQL} ELSE f_seen END AS last_seen_at FROM m),
touched AS (SELECT DISTINCT existing_id AS id FROM k WHERE kind = 'unchanged'),
deny AS (SELECT DISTINCT coalesce(existing_id, substr(sha256(filename), 1, 32)) AS id FROM k
         WHERE kind IN ('new','changed','unchanged') AND NOT allowed
           AND (CASE WHEN kind = 'new' THEN 'pending' ELSE s_status END) IN ('pending','downloaded','csv_ready'))
SELECT id, filename,
       CASE WHEN id IN (SELECT id FROM deny) AND overall_status IN ('pending','downloaded','csv_ready') THEN 'ignored'
            ELSE overall_status END AS overall_status,
       CASE WHEN id IN (SELECT id FROM touched) THEN {AS_OF_SQL} ELSE last_seen_at END AS last_seen_at
FROM up"""


@register("scan_merge_files", "UPD-14,UPD-3,UPD-4,JOIN-9", MERGE_FILES_SQL, SCAN_VIEWS)
def _merge_files(t):
    res = SC.merge_scan(t.files, t.file_stages, t.job_queue, t.listing, P.Policy.from_tables(t), AS_OF, AS_OF_YEAR,
                        order_col="seq")
    return res.files.select("id", "filename", "overall_status", "last_seen_at")


@register("scan_merge_plan", "UPD-14,UPD-8,JOIN-14", SUMMARY_SQL + """,
ent AS (SELECT ftp_dir, coalesce(existing_id, substr(sha256(filename), 1, 32)) AS id FROM k
        WHERE kind IN ('new','changed','unchanged') AND allowed),
tf AS (SELECT DISTINCT id FROM ent),
fd AS (SELECT tf.id, f.dbc_path FROM tf LEFT JOIN files f ON f.id = tf.id),
piv AS (SELECT file_id, max(CASE WHEN stage = 'download' THEN status END) AS d,
               max(CASE WHEN stage = 'csv_conversion' THEN status END) AS c,
               max(CASE WHEN stage = 'parquet_conversion' THEN status END) AS p FROM file_stages GROUP BY file_id),
jp AS (SELECT fd.id, coalesce(fd.dbc_path IS NOT NULL AND trim(fd.dbc_path) <> '' AND fd.dbc_path IN (SELECT path FROM artifacts), false) AS has,
             coalesce(piv.d, 'pending') AS d, coalesce(piv.c, 'pending') AS c, coalesce(piv.p, 'pending') AS p
      FROM fd LEFT JOIN piv ON piv.file_id = fd.id),
pl AS (SELECT id, (CASE WHEN NOT has AND d NOT IN ('running','done','purged') THEN 1 ELSE 0 END)
                + (CASE WHEN has AND c NOT IN ('running','done','purged') THEN 1 ELSE 0 END)
                + (CASE WHEN has AND p NOT IN ('running','done','purged') THEN 1 ELSE 0 END) AS n FROM jp),
enq AS (SELECT ent.ftp_dir, sum(pl.n) AS enqueued FROM ent JOIN pl USING (id) GROUP BY 1)
SELECT s.*, CAST(coalesce(enq.enqueued, 0) AS BIGINT) AS enqueued FROM s LEFT JOIN enq USING (ftp_dir)""",
          SCAN_VIEWS + ("file_stages", "artifacts"))
def _merge_plan(t):
    res = SC.merge_scan(t.files, t.file_stages, t.job_queue, t.listing, P.Policy.from_tables(t), AS_OF, AS_OF_YEAR,
                        artifacts=t.artifacts, order_col="seq")
    return res.summary


@register("stage_plan", "UPD-8,JOIN-14,JOIN-13", f"""
WITH adm AS (SELECT f.* FROM files f WHERE {ALLOWED_SQL}),
ex AS (SELECT a.id, a.dbc_path IS NOT NULL AND trim(a.dbc_path) <> '' AND a.dbc_path IN (SELECT path FROM artifacts) AS has_dbc FROM adm a),
piv AS (SELECT file_id, max(CASE WHEN stage = 'download' THEN status END) AS d, max(CASE WHEN stage = 'csv_conversion' THEN status END) AS c,
               max(CASE WHEN stage = 'parquet_conversion' THEN status END) AS p FROM file_stages GROUP BY file_id),
j AS (SELECT ex.id, ex.has_dbc, coalesce(piv.d, 'pending') AS d, coalesce(piv.c, 'pending') AS c, coalesce(piv.p, 'pending') AS p
      FROM ex LEFT JOIN piv ON piv.file_id = ex.id)
SELECT id AS file_id, 'download' AS stage FROM j WHERE NOT has_dbc AND d NOT IN ('running','done','purged')
UNION ALL SELECT id, 'csv_conversion' FROM j WHERE has_dbc AND c NOT IN ('running','done','purged')
UNION ALL SELECT id, 'parquet_conversion' FROM j WHERE has_dbc AND p NOT IN ('running','done','purged')""",
          ("files", "file_stages", "artifacts", "policy_catalogs", "policy_states", "policy_years", "policy_months"))
def _stage_plan(t):
    return SC.plan_stages(t.files, t.file_stages, P.Policy.from_tables(t), t.artifacts)


@register("artifact_flags", "JOIN-14", """
SELECT id, dbc_path IS NOT NULL AND trim(dbc_path) <> '' AND dbc_path IN (SELECT path FROM artifacts) AS dbc_exists,
       csv_path IS NOT NULL AND trim(csv_path) <> '' AND csv_path IN (SELECT path FROM artifacts) AS csv_exists,
       parquet_path IS NOT NULL AND trim(parquet_path) <> '' AND parquet_path IN (SELECT path FROM artifacts) AS parquet_exists
FROM files""")
def _artifact_flags(t):
    return SC.with_artifact_flags(t.files, t.artifacts).select("id", "dbc_exists", "csv_exists", "parquet_exists")


@register("canonical_paths", "SNK-3,STR-8,PRJ-4", """
SELECT id, '/data/' || catalog || '/' || state || '/' || printf('%04d', year) || '/' || printf('%02d', month) || '/'
       || regexp_replace(filename, '\\.[^./]*$', '') || '.csv' AS csv_path,
       coalesce(CASE WHEN trim(parquet_path) <> '' THEN parquet_path END, '/fallback') AS resolved_dir
FROM files""")
def _canonical(t):
    return t.files.select(
        "id", N.canonical_path("/data", "catalog", "state", "year", "month", "filename", ".csv").alias("csv_path"),
        P.resolve_directory("parquet_path", "/fallback").alias("resolved_dir"))


@register("segment_backfill", "SNK-8", """
SELECT id, CASE WHEN segment IS NULL AND length(upper(filename)) >= 9 AND regexp_matches(substr(upper(filename), 9, 1), '^[A-Z]$')
                THEN substr(upper(filename), 9, 1) ELSE segment END AS segment
FROM files""")
def _segment_backfill(t):
    return t.files.select("id", N.segment_backfill("filename", "segment").alias("segment"))


# ================================================================================= insights


@register("size_by_state_levels", "AGG-2,WIN-1,WIN-3,AGG-29", """
WITH b AS (SELECT upper(trim(state)) AS key, count(*) AS count, CAST(coalesce(sum(size_bytes), 0) AS BIGINT) AS total_size_bytes,
                  CAST(round(coalesce(avg(size_bytes), 0)) AS BIGINT) AS avg_size_bytes FROM files GROUP BY 1),
r AS (SELECT *, CAST(greatest(total_size_bytes, 0) AS DOUBLE) AS s FROM b),
w AS (SELECT *, rank() OVER (ORDER BY s) - 1 AS less, count(*) OVER (PARTITION BY s) AS eq, count(*) OVER () AS n,
             min(s) OVER () AS mn, max(s) OVER () AS mx, max(total_size_bytes) OVER () AS mt FROM r)
SELECT key, count, total_size_bytes, avg_size_bytes,
       CAST(CASE WHEN s <= 0 THEN 0 WHEN mx <= 0 THEN 0 WHEN mn = mx THEN 5
            ELSE least(5, CAST(floor((less + 0.5 * eq) / n * 6) AS INTEGER)) END AS INTEGER) AS level,
       (['Baixo','Baixo','Médio','Médio','Alto','Alto'])[CASE WHEN s <= 0 THEN 0 WHEN mx <= 0 THEN 0 WHEN mn = mx THEN 5
            ELSE least(5, CAST(floor((less + 0.5 * eq) / n * 6) AS INTEGER)) END + 1] AS level_label,
       greatest(5.0, CAST(total_size_bytes AS DOUBLE) / mt * 100.0) AS bar_pct
FROM w""")
def _size_levels(t):
    return I.with_bar_share(I.with_size_level(C.size_by_state(t.files)))


@register("size_by_catalog_bins", "WIN-2", """
WITH b AS (SELECT upper(trim(catalog)) AS key, CAST(coalesce(sum(size_bytes), 0) AS BIGINT) AS t FROM files GROUP BY 1),
i AS (SELECT greatest(t, 0) AS s, row_number() OVER (ORDER BY greatest(t, 0)) - 1 AS i, count(*) OVER () AS n FROM b),
bins AS (SELECT DISTINCT n, unnest(range(0, 6)) AS bin FROM i),
bb AS (SELECT bin, CAST(floor(bin * n / 6) AS INTEGER) AS lo_i, CAST(least(n - 1, ceil((bin + 1) * n / 6) - 1) AS INTEGER) AS hi_i FROM bins)
SELECT CAST(bb.bin AS INTEGER) AS bin, lo.s AS lo, hi.s AS hi FROM bb JOIN i lo ON lo.i = bb.lo_i JOIN i hi ON hi.i = bb.hi_i""")
def _bins(t):
    return I.sextile_bins(C.size_by_catalog(t.files))


@register("top_catalog_buckets", "SORT-8,AGG-3", """
SELECT upper(trim(catalog)) AS key, count(*) AS count, CAST(coalesce(sum(size_bytes), 0) AS BIGINT) AS total_size_bytes,
       CAST(round(coalesce(avg(size_bytes), 0)) AS BIGINT) AS avg_size_bytes
FROM files GROUP BY 1 ORDER BY total_size_bytes DESC, count DESC, key ASC LIMIT 12""")
def _top_buckets(t):
    return I.top_buckets(C.size_by_catalog(t.files), 12)


@register("dashboard_kpis", "AGG-28", """
SELECT count(*) AS total_files,
       count(*) FILTER (WHERE overall_status IN ('downloading','converting_csv','converting_parquet')) AS in_progress,
       count(*) FILTER (WHERE overall_status = 'failed') AS failed, count(*) FILTER (WHERE overall_status = 'pending') AS pending,
       count(*) FILTER (WHERE overall_status = 'ignored') AS ignored FROM files""")
def _kpis(t):
    return I.kpis(t.files)


@register("bucket_mismatch", "AGG-21,AGG-22", """
SELECT count(*) AS total_files,
  CAST((SELECT sum(c) FROM (SELECT count(*) AS c FROM files GROUP BY upper(trim(catalog)))) - count(*) AS BIGINT) AS by_catalog_total_mismatch,
  CAST((SELECT sum(c) FROM (SELECT count(*) AS c FROM files GROUP BY upper(trim(state)))) - count(*) AS BIGINT) AS by_state_total_mismatch
FROM files""")
def _mismatch(t):
    return I.bucket_mismatch(t.files)


@register("alerts", "WIN-6,AGG-11,AGG-12", f"""
WITH c AS (SELECT
  count(*) FILTER (WHERE status = 'failed' AND updated_at >= {AS_OF_SQL} - INTERVAL 1 HOUR AND updated_at < {AS_OF_SQL}) AS current,
  count(*) FILTER (WHERE status = 'failed' AND updated_at >= {AS_OF_SQL} - INTERVAL 2 HOUR AND updated_at < {AS_OF_SQL} - INTERVAL 1 HOUR) AS previous,
  coalesce(CAST(round(epoch({AS_OF_SQL}) - epoch(min(updated_at) FILTER (WHERE status = 'pending'))) AS BIGINT), 0) AS oldest
  FROM file_stages)
SELECT 'failure_spike' AS type, 'Aumento de falhas na ultima hora' AS message, current, previous, NULL::BIGINT AS oldest_pending_seconds
FROM c WHERE current > 2 * previous AND current > 10
UNION ALL SELECT 'queue_stalled', 'Fila com item pendente antigo', NULL, NULL, oldest FROM c WHERE oldest > 1800""")
def _alerts(t):
    return I.alerts(t.file_stages, AS_OF)


@register("failure_series", "WIN-6", """
WITH h AS (SELECT time_bucket(INTERVAL 1 HOUR, updated_at) AS hour, count(*) AS failures FROM file_stages WHERE status = 'failed' GROUP BY 1)
SELECT hour, failures, lag(failures) OVER (ORDER BY hour) AS previous,
       failures > 2 * coalesce(lag(failures) OVER (ORDER BY hour), 0) AND failures > 10 AS spike FROM h""")
def _failure_series(t):
    return I.failure_series(t.file_stages)


# ========================================================================= labels and formats


@register("state_labels", "JOIN-16,STR-10,STR-11", """
WITH b AS (SELECT upper(trim(state)) AS key, count(*) AS count, CAST(coalesce(sum(size_bytes), 0) AS BIGINT) AS total FROM files GROUP BY 1)
SELECT key, CASE key """ + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in S.STATE_NAMES.items()) + """
  ELSE CASE WHEN key = '' OR key IS NULL THEN 'UF desconhecida' ELSE 'UF desconhecida (' || key || ')' END END AS state_label,
  CASE WHEN total <= 0 THEN '0 B'
       ELSE printf(CASE WHEN total / pow(1024, u) >= 10 OR u = 0 THEN '%.0f' ELSE '%.1f' END, total / pow(1024, u)) || ' ' ||
            (['B','KB','MB','GB','TB'])[u + 1] END AS size_text
FROM (SELECT *, CASE WHEN total >= 1099511627776 THEN 4 WHEN total >= 1073741824 THEN 3 WHEN total >= 1048576 THEN 2
                     WHEN total >= 1024 THEN 1 ELSE 0 END AS u FROM b)""")
def _state_labels(t):
    b = C.size_by_state(t.files)
    return TX.with_state_label(b).select("key", "state_label", TX.format_bytes("total_size_bytes").alias("size_text"))


@register("catalog_labels", "JOIN-16", """
SELECT DISTINCT upper(trim(catalog)) AS key, upper(trim(catalog)) || ' - ' || CASE upper(trim(catalog)) """
          + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in S.CATALOG_NAMES.items())
          + " ELSE 'Catálogo não mapeado' END AS catalog_label FROM files")
def _catalog_labels(t):
    return TX.with_catalog_label(t.files.select(S.norm_code("catalog").alias("key")).distinct())


@register("status_labels", "JOIN-16", """
SELECT overall_status, count(*) AS count, CASE overall_status """
          + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in S.OVERALL_LABELS.items())
          + " ELSE replace(overall_status, '_', ' ') END AS status_label FROM files GROUP BY 1")
def _status_labels(t):
    return TX.with_status_label(C.status_counts(t.files))


@register("stage_status_labels", "JOIN-16", """
SELECT status, count(*) AS count, CASE status """
          + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in S.STAGE_STATUS_LABELS.items())
          + " ELSE status END AS status_label FROM file_stages GROUP BY 1")
def _stage_labels(t):
    return TX.with_status_label(t.file_stages.groupBy("status").agg(F.count(F.lit(1)).alias("count")),
                                col="status", stage=True)


@register("period_keys", "DATE-4,STR-8", """
SELECT DISTINCT year, month, printf('%d-%02d', year, month) AS period_key, printf('%02d/%d', month, year) AS period_label
FROM files WHERE month BETWEEN 1 AND 12""")
def _period_keys(t):
    return C.available_periods(t.files).select(
        "year", "month", TX.period_key("year", "month").alias("period_key"), TX.period_label("year", "month").alias("period_label"))


@register("date_formats", "DATE-3", """
SELECT id, strftime(updated_at, '%d/%m/%Y') AS d, strftime(updated_at, '%d/%m/%Y %H:%M') AS dt,
       strftime(updated_at, '%d/%m/%Y %H:%M:%S') AS dts, strftime(updated_at, '%H:%M:%S') AS t FROM stage_events
""".replace("updated_at", "created_at"))
def _date_formats(t):
    e = t.stage_events
    return e.select("id", TX.date_br("created_at", "date").alias("d"), TX.date_br("created_at", "datetime").alias("dt"),
                    TX.date_br("created_at", "seconds").alias("dts"), TX.date_br("created_at", "time").alias("t"))


@register("number_text", "STR-12", """
SELECT id, CASE WHEN v IS NULL THEN '' WHEN v = floor(v) AND abs(v) < 9e18 THEN CAST(CAST(v AS BIGINT) AS VARCHAR)
                ELSE CAST(v AS VARCHAR) END AS text
FROM (SELECT event_id AS id, CASE WHEN event_id % 5 = 0 THEN NULL ELSE value END AS v FROM events)""", ("events",))
def _number_text(t):
    e = t.events
    v = F.when(F.col("event_id") % 5 == 0, F.lit(None)).otherwise(F.col("value"))
    return e.select(F.col("event_id").alias("id"), TX.number_to_text(v).alias("text"))


@register("dashboard_buckets", "AGG-22,AGG-1,AGG-2,AGG-3", """
SELECT 'status' AS dim, overall_status AS key, count(*) AS count, CAST(coalesce(sum(size_bytes), 0) AS BIGINT) AS total_size_bytes,
       CAST(round(coalesce(avg(size_bytes), 0)) AS BIGINT) AS avg_size_bytes FROM files GROUP BY 2
UNION ALL SELECT 'catalog', upper(trim(catalog)), count(*), CAST(coalesce(sum(size_bytes), 0) AS BIGINT),
       CAST(round(coalesce(avg(size_bytes), 0)) AS BIGINT) FROM files GROUP BY 2
UNION ALL SELECT 'state', upper(trim(state)), count(*), CAST(coalesce(sum(size_bytes), 0) AS BIGINT),
       CAST(round(coalesce(avg(size_bytes), 0)) AS BIGINT) FROM files GROUP BY 2""")
def _dashboard_buckets(t):
    return I.dashboard_buckets(t.files)


@register("dashboard", "AGG-22,AGG-1,AGG-2,AGG-3,AGG-6,AGG-7,AGG-9,AGG-10,AGG-17,AGG-21,AGG-28", """
WITH flags AS (SELECT f.id, f.overall_status, bool_or(s.stage = 'download' AND s.status = 'done') AS d, bool_or(s.stage = 'csv_conversion' AND s.status = 'done') AS c,
                      bool_or(s.stage = 'parquet_conversion' AND s.status = 'done') AS p
               FROM files f LEFT JOIN file_stages s ON s.file_id = f.id GROUP BY 1, 2),
reasons AS (SELECT stage, coalesce(nullif(trim(error_message), ''), 'Unknown error') AS reason, count(*) AS n FROM file_stages WHERE status = 'failed'
            GROUP BY 1, 2 ORDER BY n DESC, stage, reason LIMIT 10)
SELECT 'status' AS result, overall_status AS key, count(*) AS value FROM files GROUP BY 2
UNION ALL SELECT 'catalog', upper(trim(catalog)), count(*) FROM files GROUP BY 2
UNION ALL SELECT 'catalog bytes', upper(trim(catalog)), coalesce(sum(size_bytes), 0)::BIGINT FROM files GROUP BY 2
UNION ALL SELECT 'state', upper(trim(state)), count(*) FROM files GROUP BY 2
UNION ALL SELECT 'state bytes', upper(trim(state)), coalesce(sum(size_bytes), 0)::BIGINT FROM files GROUP BY 2
UNION ALL SELECT 'reason', stage || ': ' || reason, n FROM reasons
UNION ALL SELECT 'pipeline', 'completed', count(*) FILTER (WHERE d AND c AND p) FROM flags
UNION ALL SELECT 'pipeline', 'mismatch', count(*) FILTER (WHERE ((d AND c AND p) AND overall_status <> 'parquet_ready') OR (NOT (d AND c AND p) AND overall_status = 'parquet_ready')) FROM flags
UNION ALL SELECT 'done', stage, count(*) FILTER (WHERE status = 'done') FROM file_stages GROUP BY 2
UNION ALL SELECT 'policy', 'pending', count(*) FILTER (WHERE overall_status = 'pending') FROM files
UNION ALL SELECT 'policy', 'ignored', count(*) FILTER (WHERE overall_status = 'ignored') FROM files
UNION ALL SELECT 'mismatch', 'catalog', 0
UNION ALL SELECT 'mismatch', 'state', 0
UNION ALL SELECT 'kpi', 'total_files', count(*) FROM files
UNION ALL SELECT 'kpi', 'in_progress', count(*) FILTER (WHERE overall_status IN ('downloading', 'converting_csv', 'converting_parquet')) FROM files
UNION ALL SELECT 'kpi', 'failed', count(*) FILTER (WHERE overall_status = 'failed') FROM files""")
def _dashboard(t):
    r = I.dashboard(t.files, t.file_stages, P.Policy.from_tables(t))
    parts = [r["status_counts"].select(F.lit("status").alias("result"), F.col("overall_status").alias("key"), F.col("count").alias("value"))]
    for c in ("catalog", "state"):
        parts += [r[f"by_{c}"].select(F.lit(c), "key", "count"), r[f"by_{c}"].select(F.lit(f"{c} bytes"), "key", "total_size_bytes")]
    parts.append(r["failure_reasons"].select(F.lit("reason"), F.concat("stage", F.lit(": "), "reason"), "total"))
    one = lambda result, name, key, column: r[result].select(F.lit(name), F.lit(key), F.col(column))
    parts += [one("pipeline", "pipeline", "completed", "pipeline_completed_count"), one("pipeline", "pipeline", "mismatch", "status_stage_mismatch_count")]
    parts += [one("stage_done_counts", "done", stage, column) for stage, column in I.DONE.items()]
    parts += [one("policy_counts", "policy", x, x) for x in ("pending", "ignored")] + [one("bucket_mismatch", "mismatch", x, f"by_{x}_total_mismatch") for x in ("catalog", "state")]
    parts += [one("kpis", "kpi", x, x) for x in ("total_files", "in_progress", "failed")]
    out = parts[0]
    for part in parts[1:]:
        out = out.union(part)
    return out
