"""Per-file stage state: completion flags, failure reports, bottlenecks, stage plans and folds.

``file_stages`` has one row per (file_id, stage). Everything that relates stages to files first
aggregates stages per file (partial + final hash aggregate) and only then joins to ``files``, so
the join sees at most one row per file and a file with many stage rows cannot skew it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import schemas as S


# ------------------------------------------------------------------------- completion (AGG-10)


def stage_flags(files: DataFrame, stages: DataFrame) -> DataFrame:
    """JOIN-2: per file, whether each stage is done. Files without stage rows get NULL flags."""
    per_file = stages.groupBy("file_id").agg(
        F.bool_or((F.col("stage") == "download") & (F.col("status") == "done")).alias("download_done"),
        F.bool_or((F.col("stage") == "csv_conversion") & (F.col("status") == "done")).alias("csv_done"),
        F.bool_or((F.col("stage") == "parquet_conversion") & (F.col("status") == "done")).alias("parquet_done"),
    )
    return (
        files.select("id", "overall_status")
        .join(per_file, files["id"] == per_file["file_id"], "left")
        .drop("file_id")
    )


def completed_expr(require_download: bool, require_csv: bool, require_parquet: bool) -> Column:
    """Three-valued completion: NULL (unknown) when a required stage has no rows at all."""
    return (
        (~F.lit(require_download) | F.col("download_done"))
        & (~F.lit(require_csv) | F.col("csv_done"))
        & (~F.lit(require_parquet) | F.col("parquet_done"))
    )


def pipeline_eval(files: DataFrame, stages: DataFrame, d: bool = True, c: bool = True, p: bool = True) -> DataFrame:
    return stage_flags(files, stages).withColumn("pipeline_completed", completed_expr(d, c, p))


def completed_file_ids(files: DataFrame, stages: DataFrame, d: bool = True, c: bool = True, p: bool = True) -> DataFrame:
    """FLT-12 subquery: ids whose pipeline is completed (true, not unknown)."""
    return pipeline_eval(files, stages, d, c, p).where(F.col("pipeline_completed")).select("id")


def expected_terminal_status(d: bool, c: bool, p: bool) -> str:
    """PRJ-5 (driver-side form)."""
    if p:
        return "parquet_ready"
    if c:
        return "csv_ready"
    if d:
        return "downloaded"
    return "pending"


def expected_terminal_status_col(d: Column, c: Column, p: Column) -> Column:
    """PRJ-5 as a column over toggle columns."""
    return (
        F.when(p, F.lit("parquet_ready")).when(c, F.lit("csv_ready")).when(d, F.lit("downloaded"))
        .otherwise(F.lit("pending"))
    )


def pipeline_consistency(files: DataFrame, stages: DataFrame, d: bool = True, c: bool = True, p: bool = True,
                         with_unknown: bool = False) -> DataFrame:
    """AGG-10: completed count and status/stage mismatch count in one pass.

    NULL completion counts as neither (no ``coalesce``): a file without stage rows is never a
    mismatch while any stage is required.
    """
    terminal = expected_terminal_status(d, c, p)
    done = F.col("pipeline_completed")
    status = F.col("overall_status")
    aggs = [
        F.count_if(done).alias("pipeline_completed_count"),
        F.count_if((done & (status != terminal)) | (~done & (status == terminal))).alias("status_stage_mismatch_count"),
    ]
    if with_unknown:
        aggs.append(F.count_if(done.isNull()).alias("unknown_count"))
    return pipeline_eval(files, stages, d, c, p).agg(*aggs)


# --------------------------------------------------------------------------- reports (AGG-7..12)


def failure_reason(c: str | Column = "error_message") -> Column:
    """STR-2: blank or missing message -> 'Unknown error'."""
    return F.coalesce(F.nullif(F.trim(S.col_of(c)), F.lit("")), F.lit(S.UNKNOWN_ERROR))


def top_failure_reasons(stages: DataFrame, limit: int = 10) -> DataFrame:
    """AGG-7 / SORT-5: most frequent (stage, cleaned reason) among failed stages.

    Stage is compared as text. A reason tie-break is added so the cut at ``limit`` is stable.
    """
    n = limit if limit > 0 else 10
    return (
        stages.where(F.col("status") == "failed")
        .groupBy(F.col("stage"), failure_reason().alias("reason"))
        .agg(F.count(F.lit(1)).alias("total"))
        .orderBy(F.col("total").desc(), F.col("stage").asc(), F.col("reason").asc())
        .limit(n)
    )


def bottlenecks(stages: DataFrame) -> DataFrame:
    """AGG-8: pending / running / failed counts per stage."""
    s = F.col("status")
    return (
        stages.groupBy("stage")
        .agg(
            F.count_if(s == "pending").alias("pending_count"),
            F.count_if(s == "running").alias("running_count"),
            F.count_if(s == "failed").alias("failed_count"),
        )
        .orderBy(F.col("pending_count").desc(), F.col("running_count").desc(), F.col("stage").asc())
    )


def stage_done_counts(stages: DataFrame) -> DataFrame:
    """AGG-9: one row with the three done counts."""
    done = F.col("status") == "done"
    return stages.agg(
        F.count_if((F.col("stage") == "download") & done).alias("download_done"),
        F.count_if((F.col("stage") == "csv_conversion") & done).alias("csv_done"),
        F.count_if((F.col("stage") == "parquet_conversion") & done).alias("parquet_done"),
    )


def failure_count_between(stages: DataFrame, start, end) -> DataFrame:
    """AGG-11: failed stages updated in [start, end)."""
    t = F.col("updated_at")
    return stages.where((F.col("status") == "failed") & (t >= S.ts_lit(start)) & (t < S.ts_lit(end))).agg(
        F.count(F.lit(1)).alias("failures")
    )


def age_seconds(as_of, ts: Column) -> Column:
    """DATE-2: whole seconds between ``ts`` and ``as_of`` (rounded like ``::bigint``)."""
    micros = F.unix_micros(S.ts_lit(as_of)) - F.unix_micros(S.as_ts(ts))
    return S.pg_bigint(micros / F.lit(1_000_000.0))


def pending_oldest_age_seconds(stages: DataFrame, as_of) -> DataFrame:
    """AGG-12: age of the oldest pending stage row in seconds, 0 when there is none."""
    oldest = stages.where(F.col("status") == "pending").agg(F.min("updated_at").alias("oldest"))
    return oldest.select(F.coalesce(age_seconds(as_of, F.col("oldest")), F.lit(0).cast("long")).alias("oldest_pending_seconds"))


def parquet_done_without_path(files: DataFrame, stages: DataFrame) -> DataFrame:
    """JOIN-15: parquet stage done while the file has no (or a blank) parquet path."""
    pq = stages.where((F.col("stage") == "parquet_conversion") & (F.col("status") == "done")).select(
        "file_id", F.col("status").alias("parquet_stage")
    )
    broken = files.where(F.col("parquet_path").isNull() | (F.trim(F.col("parquet_path")) == ""))
    return broken.join(pq, broken["id"] == pq["file_id"], "inner").select(
        "id", "filename", "overall_status", "parquet_path", "parquet_stage"
    )


# ---------------------------------------------------------------------- detail and runnability


def stages_of_file(stages: DataFrame, file_id: str) -> DataFrame:
    """FLT-27 / SORT-3: one file's stages in enum order."""
    return stages.where(F.col("file_id") == file_id).orderBy(S.enum_rank("stage", S.STAGES))


def stage_of_file(stages: DataFrame, file_id: str, stage: str) -> DataFrame:
    return stages.where((F.col("file_id") == file_id) & (F.col("stage") == stage))


def run_block_reason(status: str | Column = "status") -> Column:
    """FLT-26: why a stage may not run (NULL = runnable). No stage has a prerequisite."""
    s = S.col_of(status)
    return F.when(s == "running", F.lit("stage is running")).when(s == "purged", F.lit("stage purged"))


# --------------------------------------------------------------------- stage rows (JOIN-6/10)


def expand_stages(file_ids: DataFrame, id_col: str = "id") -> DataFrame:
    """JOIN-6: every file x the three stages, generated per row (no join)."""
    return file_ids.select(
        F.col(id_col).alias("file_id"), F.explode(F.array(*[F.lit(s) for s in S.STAGES])).alias("stage")
    )


def init_stages(stages: DataFrame, file_ids: DataFrame, as_of, id_col: str = "id") -> DataFrame:
    """JOIN-10: add pending rows for (file, stage) pairs that do not exist yet; keep the rest."""
    wanted = expand_stages(file_ids, id_col).distinct()
    missing = wanted.join(stages.select("file_id", "stage"), ["file_id", "stage"], "left_anti")
    new_rows = missing.select(
        "file_id", "stage",
        F.lit("pending").alias("status"),
        F.lit(0).alias("attempts"),
        F.lit(None).cast("timestamp").alias("started_at"),
        F.lit(None).cast("timestamp").alias("finished_at"),
        F.lit(None).cast("string").alias("error_message"),
        S.ts_lit(as_of).alias("updated_at"),
    )
    return conform_stages(stages).unionByName(new_rows)


def conform_stages(stages: DataFrame) -> DataFrame:
    """Bring a stage table to the full ``FILE_STAGES`` schema (missing columns as NULL)."""
    cols = []
    for f in S.FILE_STAGES.fields:
        if f.name in stages.columns:
            cols.append(F.col(f.name).cast(f.dataType).alias(f.name))
        else:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
    return stages.select(*cols)


# ------------------------------------------------------------------- event folds (UPD-6, WIN-8)

# Event type -> stage status it leaves behind ('progress' leaves it unchanged).
EVENT_STATUS = {
    "enqueued": "pending",
    "retrying": "pending",
    "started": "running",
    "completed": "done",
    "failed": "failed",
    "purged": "purged",
}


def event_status(event_type: str | Column = "event_type") -> Column:
    e = S.col_of(event_type)
    out = None
    for k, v in EVENT_STATUS.items():
        out = (F.when(e == k, F.lit(v)) if out is None else out.when(e == k, F.lit(v)))
    return out


def latest_stage_state(events: DataFrame) -> DataFrame:
    """WIN-8: current state per (file, stage) = the newest status-changing event.

    ``max_by`` over a (created_at, id) struct is a partial aggregate, so a hot (file, stage) key is
    reduced in every map task before the shuffle; ties on time are broken by event id.
    """
    changing = events.where(F.col("event_type").isin(list(EVENT_STATUS)))
    order_key = F.struct(S.as_ts("created_at").alias("t"), F.col("id").alias("i"))
    payload = F.struct(
        F.col("event_type").alias("event_type"),
        F.col("message").alias("message"),
        S.as_ts("created_at").alias("created_at"),
        F.col("id").alias("id"),
    )
    return _summary_columns(
        changing.groupBy("file_id", "stage").agg(
            F.max_by(payload, order_key).alias("last"),
            F.count_if(F.col("event_type") == "started").alias("starts"),
            F.max(F.when(F.col("event_type") == "started", S.as_ts("created_at"))).alias("last_started"),
        ))


def _summary_columns(agg: DataFrame) -> DataFrame:
    return agg.select(
        "file_id", "stage",
        event_status(F.col("last.event_type")).alias("status"),
        F.col("last.event_type").alias("last_event"),
        F.col("last.message").alias("last_message"),
        F.col("last.created_at").alias("last_event_at"),
        F.col("last.id").alias("last_event_id"),
        F.col("starts").cast("long").alias("starts"), "last_started",
    )


def merge_stage_summaries(a: DataFrame, b: DataFrame) -> DataFrame:
    """Combine two summaries of disjoint event sets (e.g. the running state and one micro-batch):
    the summary is associative, so folding batch by batch equals folding all events at once."""
    last = F.struct(F.col("last_event").alias("event_type"), F.col("last_message").alias("message"),
                    F.col("last_event_at").alias("created_at"), F.col("last_event_id").alias("id"))
    order = F.struct(F.col("last_event_at").alias("t"), F.col("last_event_id").alias("i"))
    cols = ["file_id", "stage", "last_event", "last_message", "last_event_at", "last_event_id", "starts", "last_started"]
    return _summary_columns(
        a.select(*cols).unionByName(b.select(*cols)).groupBy("file_id", "stage").agg(
            F.max_by(last, order).alias("last"), F.sum("starts").alias("starts"),
            F.max("last_started").alias("last_started")))


def apply_stage_events(stages: DataFrame, events: DataFrame) -> DataFrame:
    """UPD-6 / UPD-9: fold a batch of stage events into the stage table (pure function).

    started -> running (started_at set, error cleared, attempts + 1 per start);
    completed -> done (finished_at set, error cleared); failed -> failed (finished_at, message);
    enqueued/retrying -> pending (times and error cleared); purged -> purged. Pairs without
    stage rows are created.
    """
    return apply_stage_summary(stages, latest_stage_state(events))


def apply_stage_summary(stages: DataFrame, summary: DataFrame) -> DataFrame:
    """The write side of UPD-6: apply a per-(file, stage) event summary to the stage table."""
    cur = conform_stages(stages).alias("s")
    ev = summary.alias("e")
    j = cur.join(ev, (F.col("s.file_id") == F.col("e.file_id")) & (F.col("s.stage") == F.col("e.stage")), "full_outer")
    has_ev = F.col("e.status").isNotNull()
    new_status = F.coalesce(F.col("e.status"), F.col("s.status"))
    last = F.col("e.last_event")
    t = F.col("e.last_event_at")
    return j.select(
        F.coalesce(F.col("s.file_id"), F.col("e.file_id")).alias("file_id"),
        F.coalesce(F.col("s.stage"), F.col("e.stage")).alias("stage"),
        new_status.alias("status"),
        (F.coalesce(F.col("s.attempts"), F.lit(0)) + F.coalesce(F.col("e.starts"), F.lit(0))).cast("int").alias("attempts"),
        F.when(last == "started", t).when(last.isin("enqueued", "retrying"), F.lit(None))
        .otherwise(F.coalesce(F.col("s.started_at"), F.col("e.last_started"))).alias("started_at"),
        F.when(last.isin("completed", "failed"), t).when(last.isin("enqueued", "retrying", "started"), F.lit(None))
        .otherwise(F.col("s.finished_at")).alias("finished_at"),
        F.when(last == "failed", F.col("e.last_message")).when(has_ev & (last != "purged"), F.lit(None))
        .otherwise(F.col("s.error_message")).alias("error_message"),
        F.coalesce(t, F.col("s.updated_at")).alias("updated_at"),
    )


def purge_stages(stages: DataFrame, file_ids: DataFrame, as_of, id_col: str = "id") -> DataFrame:
    """UPD-7 (stage part): every stage of the given files becomes purged."""
    ids = file_ids.select(F.col(id_col).alias("_pid")).distinct().withColumn("_hit", F.lit(True))
    j = conform_stages(stages).join(ids, F.col("file_id") == F.col("_pid"), "left")
    hit = F.coalesce(F.col("_hit"), F.lit(False))
    return j.select(
        *[
            (F.when(hit, F.lit("purged")).otherwise(F.col("status")).alias("status") if c == "status"
             else F.when(hit, S.ts_lit(as_of)).otherwise(F.col("updated_at")).alias("updated_at")
             if c == "updated_at" else F.col(c))
            for c in S.FILE_STAGES.fieldNames()
        ]
    )


# ------------------------------------------------------------------------------- logs (WIN-4)


def newest_logs(logs: DataFrame, n: int = S.LOG_DEFAULT_LIMIT, file_id: str | None = None) -> DataFrame:
    """WIN-4: newest ``n`` log rows of one file, or of every file.

    For all files it is ``row_number() <= n`` per file, which Spark plans with a partial
    WindowGroupLimit before the shuffle, so a file with huge logs ships at most ``n`` rows per task.
    """
    order = [F.col("created_at").desc(), F.col("id").desc()]
    if file_id is not None:
        return logs.where(F.col("file_id") == file_id).orderBy(*order).limit(n if n > 0 else S.LOG_DEFAULT_LIMIT)
    w = Window.partitionBy("file_id").orderBy(*order)
    return logs.withColumn("rn", F.row_number().over(w)).where(F.col("rn") <= (n if n > 0 else S.LOG_DEFAULT_LIMIT))
