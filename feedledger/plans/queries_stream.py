"""Registered queries: the streaming jobs, run over everything available on file streams that
Spark writes from the derived tables (several files, several micro-batches)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from .. import schemas as S
from ..operators import jobs as J
from ..operators import maintained as M
from ..operators import policy as P
from ..operators import scan as SC
from ..operators import stages as ST
from ..session import ensure_checkpoint_dir
from ..sources.bucketed import Catalog
from ..streaming import jobs as SJ
from ..streaming import keyed as K
from ..streaming import landing as L
from .queries import AS_OF, AS_OF_YEAR
from .queries_scan import CLASSIFY_SQL, MERGE_FILES_SQL, SCAN_VIEWS
from .registry import register

FILES_PER_BATCH = 2


def _scratch(spark, label):
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/feedledger-stream-{label}-{uuid.uuid4().hex[:12]}"


def _event_stream(t, label, extra=None):
    spark = t.spark
    d = _scratch(spark, label)
    ev = t.stage_events.withColumn("created_at", S.as_ts("created_at"))
    ev.repartition(6, "file_id").write.parquet(f"{d}/events/part=0")
    if extra is not None:
        extra(ev).repartition(3).write.parquet(f"{d}/events/part=1")
    return SJ.read_events(spark, f"{d}/events", max_files=FILES_PER_BATCH)


def _files_of(spark, folder):
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return sorted(str(st.getPath()) for st in fs.listStatus(path) if st.getPath().getName().startswith("part-"))


def _split_off(spark, folder, seen):
    """The part files of a folder in two groups: what a first and a second start of a stream find."""
    path = spark._jvm.org.apache.hadoop.fs.Path(seen)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(path)
    files = _files_of(spark, folder)
    return [files[: len(files) // 2], files[len(files) // 2:]]


def _move_in(spark, files, seen):
    for f in files:
        path = spark._jvm.org.apache.hadoop.fs.Path(f)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).rename(path, spark._jvm.org.apache.hadoop.fs.Path(seen))


@register("stream_stage_summary", "STM-2,WIN-8", """
WITH c AS (SELECT * FROM stage_events WHERE event_type IN ('enqueued','retrying','started','completed','failed','purged')),
last AS (SELECT file_id, stage, event_type, created_at FROM (
   SELECT *, row_number() OVER (PARTITION BY file_id, stage ORDER BY created_at DESC, id DESC) AS rn FROM c) x WHERE rn = 1),
n AS (SELECT file_id, stage, count(*) FILTER (WHERE event_type = 'started') AS starts FROM c GROUP BY 1, 2)
SELECT l.file_id, l.stage, CASE l.event_type WHEN 'enqueued' THEN 'pending' WHEN 'retrying' THEN 'pending' WHEN 'started' THEN 'running'
         WHEN 'completed' THEN 'done' WHEN 'failed' THEN 'failed' WHEN 'purged' THEN 'purged' END AS status,
       l.event_type AS last_event, l.created_at AS last_event_at, n.starts
FROM last l JOIN n USING (file_id, stage)""")
def _stream_summary(t):
    ev = _event_stream(t, "summary")
    return SJ.run_available_now(SJ.stage_state_summary(ev), "stage_summary_" + uuid.uuid4().hex[:8], "complete")


@register("stream_stage_state", "STM-2", """
WITH c AS (SELECT * FROM stage_events WHERE event_type IN ('enqueued','retrying','started','completed','failed','purged')),
last AS (SELECT file_id, stage, event_type, id FROM (
   SELECT *, row_number() OVER (PARTITION BY file_id, stage ORDER BY created_at DESC, id DESC) AS rn FROM c) x WHERE rn = 1),
n AS (SELECT file_id, stage, count(*) FILTER (WHERE event_type = 'started') AS starts FROM c GROUP BY 1, 2)
SELECT l.file_id, l.stage, l.event_type AS last_event, l.id AS last_event_id, n.starts
FROM last l JOIN n USING (file_id, stage)""")
def _stream_state(t):
    # the state starts from a batch summary of one part of the events; the stream brings the others
    ev = t.stage_events.withColumn("created_at", S.as_ts("created_at"))
    d = _scratch(t.spark, "state")
    before = F.pmod("id", F.lit(3)) == 0
    ev.where(~before).repartition(6, "file_id").write.parquet(f"{d}/events")
    K.start_stage_fold(t.spark, f"{d}/events", f"{d}/checkpoint", FILES_PER_BATCH, ST.latest_stage_state(ev.where(before)), 400 * 86_400).awaitTermination()
    return K.stage_summaries(t.spark, f"{d}/checkpoint").select("file_id", "stage", "last_event", "last_event_id", "starts")


@register("stream_failure_windows", "STM-3", """
SELECT time_bucket(INTERVAL 1 HOUR, created_at) AS hour, count(*) AS failures FROM stage_events
WHERE event_type = 'failed' GROUP BY 1""")
def _stream_failures(t):
    ev = _event_stream(t, "failures")
    return SJ.run_available_now(SJ.failure_windows(ev), "failure_windows_" + uuid.uuid4().hex[:8], "complete")


@register("stream_queue_depth", "STM-4,AGG-13", "SELECT stage, status, CAST(count(*) AS DOUBLE) AS depth FROM job_queue GROUP BY 1, 2")
def _stream_depth(t):
    spark = t.spark
    d = _scratch(spark, "queue")
    t.job_queue.repartition(5).write.parquet(d)
    rows = spark.readStream.schema(t.job_queue.schema).option("maxFilesPerTrigger", 1).parquet(d)
    return SJ.run_available_now(SJ.queue_depth_stream(rows), "queue_depth_" + uuid.uuid4().hex[:8], "complete")


@register("stream_dedupe_events", "STM-5", "SELECT id, file_id, event_type FROM stage_events")
def _stream_dedupe(t):
    ev = _event_stream(t, "dedupe", extra=lambda e: e.where(F.col("id") % 3 == 0))
    out = SJ.run_available_now(SJ.dedupe_events(ev, "30 days"), "dedupe_" + uuid.uuid4().hex[:8], "append")
    return out.select("id", "file_id", "event_type")


@register("stream_landing_merge", "STM-1,UPD-14", MERGE_FILES_SQL, SCAN_VIEWS)
def _stream_landing(t):
    spark, d = t.spark, _scratch(t.spark, "landing")
    listing = t.listing.select("ftp_dir", "name", "size", S.as_ts("mod_time").alias("mod_time"), "remote_path")
    each = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")) // 2)  # files of a start: written and read by as many tasks
    listing.repartition(2 * each, F.upper("name")).write.parquet(f"{d}/listing")
    catalog = Catalog(spark, f"{d}/state", groups=16)
    catalog.seed(SC.conform_files(t.files), ST.conform_stages(t.file_stages), J.conform_queue(t.job_queue))
    # two starts over the same state, a batch each: the first sees half the files, the second goes on with the others
    names = _split_off(spark, f"{d}/listing", f"{d}/seen")
    for part in names:
        _move_in(spark, part, f"{d}/seen")
        L.start_landing(spark, f"{d}/seen", f"{d}/state", lambda s: P.Policy.from_tables(t), lambda: AS_OF, AS_OF_YEAR, max_files=max(1, len(part)), groups=16).awaitTermination()
    return catalog.read("files").select("id", "filename", "overall_status", "last_seen_at")


@register("maintained_reports", "AGG-1,AGG-2,AGG-3,AGG-4,AGG-6,AGG-17,UPD-14", CLASSIFY_SQL + """,
src AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY filename ORDER BY remote_path DESC, size DESC) AS rn FROM k
                       WHERE kind IN ('new','changed')) x WHERE rn = 1),
deny AS (SELECT DISTINCT coalesce(existing_id, substr(sha256(filename), 1, 32)) AS id FROM k
         WHERE kind IN ('new','changed','unchanged') AND NOT allowed
           AND (CASE WHEN kind = 'new' THEN 'pending' ELSE s_status END) IN ('pending','downloaded','csv_ready')),
m AS (SELECT coalesce(f.id, substr(sha256(src.filename), 1, 32)) AS id, coalesce(f.catalog, src.p_catalog) AS catalog, coalesce(f.state, src.p_state) AS state,
             coalesce(f.year, src.p_year) AS year, coalesce(f.month, src.p_month) AS month, CASE WHEN src.filename IS NOT NULL THEN src.size ELSE f.size_bytes END AS size_bytes,
             coalesce(f.overall_status, 'pending') AS st
      FROM files f FULL OUTER JOIN src ON f.filename = src.filename),
z AS (SELECT catalog, state, year, month, size_bytes,
             CASE WHEN id IN (SELECT id FROM deny) AND st IN ('pending','downloaded','csv_ready') THEN 'ignored' ELSE st END AS st FROM m)
SELECT 'status' AS report, st AS key, count(*) AS count, NULL::BIGINT AS total_size_bytes, NULL::BIGINT AS avg_size_bytes FROM z GROUP BY st
UNION ALL SELECT 'state', upper(trim(state)), count(*), coalesce(sum(size_bytes), 0)::BIGINT, coalesce(round(avg(size_bytes)), 0)::BIGINT FROM z GROUP BY 2
UNION ALL SELECT 'catalog', upper(trim(catalog)), count(*), coalesce(sum(size_bytes), 0)::BIGINT, coalesce(round(avg(size_bytes)), 0)::BIGINT FROM z GROUP BY 2
UNION ALL SELECT 'pending', '', count(*) FILTER (WHERE st = 'pending'), NULL, NULL FROM z
UNION ALL SELECT 'ignored', '', count(*) FILTER (WHERE st = 'ignored'), NULL, NULL FROM z
UNION ALL SELECT DISTINCT 'facet state', upper(trim(state)), NULL::BIGINT, NULL::BIGINT, NULL::BIGINT FROM z
UNION ALL SELECT DISTINCT 'facet catalog', upper(trim(catalog)), NULL::BIGINT, NULL::BIGINT, NULL::BIGINT FROM z
UNION ALL SELECT DISTINCT 'facet status', lower(trim(st)), NULL::BIGINT, NULL::BIGINT, NULL::BIGINT FROM z
UNION ALL SELECT DISTINCT 'facet period', printf('%04d-%02d', year, month), NULL::BIGINT, NULL::BIGINT, NULL::BIGINT FROM z WHERE month BETWEEN 1 AND 12
""", SCAN_VIEWS)
def _maintained(t):
    """Three listings, each of some directories; the reports then come from the cells alone."""
    spark, root = t.spark, f"{_scratch(t.spark, 'cells')}/state"
    catalog = Catalog(spark, root, groups=16)
    catalog.seed(SC.conform_files(t.files), ST.conform_stages(t.file_stages), J.conform_queue(t.job_queue))
    listing = t.listing.select("ftp_dir", "name", "size", S.as_ts("mod_time").alias("mod_time"), "remote_path")
    for batch in range(3):
        L.merge_listing(catalog, listing.where(F.pmod(F.xxhash64("ftp_dir"), F.lit(3)) == batch), P.Policy.from_tables(t), AS_OF, AS_OF_YEAR, batch)
    cells, none = catalog.read("cells"), F.lit(None).cast("long")
    counts = M.pending_and_ignored_counts(cells)
    parts = [M.status_counts(cells).select(F.lit("status").alias("report"), F.col("overall_status").alias("key"), "count", none.alias("total_size_bytes"), none.alias("avg_size_bytes"))]
    parts += [M.size_by(cells, c).select(F.lit(c).alias("report"), "key", "count", "total_size_bytes", "avg_size_bytes") for c in ("state", "catalog")]
    parts += [counts.select(F.lit(c), F.lit(""), c, none, none) for c in ("pending", "ignored")]
    parts.append(M.facets(cells).select(F.concat(F.lit("facet "), "facet"), "value", none, none, none))
    out = parts[0]
    for part in parts[1:]:
        out = out.union(part)
    return out


@register("stream_stage_fold", "STM-2,UPD-6", """
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
            ELSE fs.error_message END AS error_message
FROM file_stages fs FULL OUTER JOIN ev ON fs.file_id = ev.file_id AND fs.stage = ev.stage""")
def _stream_fold(t):
    spark = t.spark
    d = _scratch(spark, "fold")
    ev = t.stage_events.withColumn("created_at", S.as_ts("created_at"))
    ev.repartition(6, "file_id").write.parquet(f"{d}/events")
    for part in _split_off(spark, f"{d}/events", f"{d}/seen"):
        _move_in(spark, part, f"{d}/seen")
        K.start_stage_fold(spark, f"{d}/seen", f"{d}/checkpoint", FILES_PER_BATCH).awaitTermination()
    return K.folded_stages(spark, f"{d}/checkpoint", ST.conform_stages(t.file_stages)).select("file_id", "stage", "status", "attempts", "error_message")


@register("stream_failure_alerts", "STM-3,WIN-6", """
WITH h AS (SELECT time_bucket(INTERVAL 1 HOUR, created_at) AS hour, count(*) AS failures FROM stage_events
           WHERE event_type = 'failed' GROUP BY 1),
l AS (SELECT hour, failures, lag(failures) OVER (ORDER BY hour) AS previous FROM h)
SELECT hour, failures, previous, failures > 2 * coalesce(previous, 0) AND failures > 10 AS spike FROM l""")
def _stream_alerts(t):
    spark = t.spark
    d = _scratch(spark, "alerts")
    ev = t.stage_events.withColumn("created_at", S.as_ts("created_at"))
    ev.repartition(6, "file_id").write.parquet(f"{d}/events")
    parts = _split_off(spark, f"{d}/events", f"{d}/seen")
    # a last event of another kind, far ahead, closes every hour
    ev.orderBy(F.desc("created_at")).limit(1).select(*(
        F.lit("progress").alias(c) if c == "event_type" else (F.col(c) + F.expr("INTERVAL 90 DAYS")).alias(c) if c == "created_at" else F.col(c) for c in ev.columns)
    ).write.parquet(f"{d}/last")
    # the event files each span the whole month, so the watermark delay covers it: no event is late
    for part in (*parts, _files_of(spark, f"{d}/last")):
        _move_in(spark, part, f"{d}/seen")
        K.start_hour_alerts(spark, f"{d}/seen", f"{d}/hours", f"{d}/checkpoint", delay="40 days", max_files=FILES_PER_BATCH).awaitTermination()
    return K.judged_hours(spark, f"{d}/hours").select("hour", "failures", "previous", "spike")
