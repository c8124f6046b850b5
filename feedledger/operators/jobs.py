"""Job-table maintenance as batch joins: enqueue, claim order, ack, retry planning, stuck jobs,
depth and duration histograms. Nothing is locked or scheduled: each function returns the next
state of the table (and counts) for the caller to write.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import schemas as S
from . import stages as ST

QUEUE_COLUMNS = [f.name for f in S.JOB_QUEUE.fields]


def conform_queue(queue: DataFrame) -> DataFrame:
    cols = []
    for f in S.JOB_QUEUE.fields:
        if f.name in queue.columns:
            cols.append(F.col(f.name).cast(f.dataType).alias(f.name))
        else:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
    return queue.select(*cols)


def job_id(file_id: str | Column = "file_id", stage: str | Column = "stage") -> Column:
    """Deterministic job id: one job per (file, stage)."""
    return F.concat_ws(":", S.col_of(file_id), S.col_of(stage))


# ----------------------------------------------------------------------------- enqueue (JOIN-11)


def upsert_queue(queue: DataFrame, requests: DataFrame, as_of, available_at: str | None = None):
    """JOIN-11 / Enqueue / BulkEnqueue: insert pending jobs, or reset existing ones that are
    failed, done or pending (attempts -> 0, unlocked). Running jobs are left untouched.

    Returns (new_queue, counts) where counts has ``affected`` (inserted + reset) and ``kept_running``.
    """
    ts = S.ts_lit(as_of)
    req = requests.select(
        "file_id", "stage",
        (F.col(available_at).cast("timestamp") if available_at else ts).alias("_avail"),
    ).dropDuplicates(["file_id", "stage"])
    cur = conform_queue(queue).alias("q")
    r = req.alias("r")
    j = cur.join(r, (F.col("q.file_id") == F.col("r.file_id")) & (F.col("q.stage") == F.col("r.stage")), "full_outer")
    requested = F.col("r.file_id").isNotNull()
    existing = F.col("q.id").isNotNull()
    reset = requested & (~existing | F.col("q.status").isin("failed", "done", "pending"))
    fid = F.coalesce(F.col("q.file_id"), F.col("r.file_id"))
    stg = F.coalesce(F.col("q.stage"), F.col("r.stage"))
    out = j.select(
        F.coalesce(F.col("q.id"), job_id(fid, stg)).alias("id"),
        fid.alias("file_id"),
        stg.alias("stage"),
        F.when(reset, F.lit("pending")).otherwise(F.col("q.status")).alias("status"),
        F.when(reset, F.col("r._avail")).otherwise(F.col("q.available_at")).alias("available_at"),
        F.when(reset, F.lit(None).cast("timestamp")).otherwise(F.col("q.locked_at")).alias("locked_at"),
        F.when(reset, F.lit(0)).otherwise(F.col("q.attempts")).cast("int").alias("attempts"),
        reset.alias("_affected"),
        (requested & existing & (F.col("q.status") == "running")).alias("_kept"),
    )
    counts = out.agg(F.count_if("_affected").alias("affected"), F.count_if("_kept").alias("kept_running"))
    return out.drop("_affected", "_kept"), counts


# ------------------------------------------------------------------------ due / stuck (FLT-24/25)


def due_jobs(queue: DataFrame, as_of, per_stage: int = 1) -> DataFrame:
    """FLT-25 + WIN-5 (re-aimed): the next ``per_stage`` due jobs of every stage, oldest first.

    ``row_number() <= k`` is planned with a partial WindowGroupLimit before the shuffle, so a
    stage with most of the jobs sends only k rows per task.
    """
    due = queue.where((F.col("status") == "pending") & (F.col("available_at") <= S.ts_lit(as_of)))
    w = Window.partitionBy("stage").orderBy(F.col("available_at").asc(), F.col("id").asc())
    return due.withColumn("claim_rank", F.row_number().over(w).cast("long")).where(F.col("claim_rank") <= per_stage)


def is_stuck(as_of, timeout_seconds: int = S.STUCK_TIMEOUT_SECONDS) -> Column:
    """FLT-24: running and locked for longer than the timeout."""
    limit = S.ts_lit(as_of) - F.make_dt_interval(secs=F.lit(timeout_seconds))
    return (F.col("status") == "running") & (F.col("locked_at").cast("timestamp") < limit)


def recover_stuck(queue: DataFrame, as_of, timeout_seconds: int = S.STUCK_TIMEOUT_SECONDS):
    """UPD-11: stuck jobs back to pending, unlocked, available now. Returns (queue, counts)."""
    q = conform_queue(queue).withColumn("_stuck", is_stuck(as_of, timeout_seconds))
    ts = S.ts_lit(as_of)
    out = q.select(
        "id", "file_id", "stage",
        F.when(F.col("_stuck"), F.lit("pending")).otherwise(F.col("status")).alias("status"),
        F.when(F.col("_stuck"), ts).otherwise(F.col("available_at")).alias("available_at"),
        F.when(F.col("_stuck"), F.lit(None).cast("timestamp")).otherwise(F.col("locked_at")).alias("locked_at"),
        "attempts", "_stuck",
    )
    return out.drop("_stuck"), out.agg(F.count_if("_stuck").alias("recovered"))


# ---------------------------------------------------------------------------- ack / retry plans


def retry_unit(key: Column, attempt: Column) -> Column:
    """A repeatable uniform value in [0, 1) per (job, attempt), in place of a random draw."""
    return F.pmod(F.xxhash64(key, attempt), F.lit(1_000_000)).cast("double") / F.lit(1_000_000.0)


def backoff_seconds(attempt: str | Column, key: str | Column = "id",
                    base: float = S.RETRY_BASE_SECONDS, cap: float = S.RETRY_MAX_SECONDS,
                    jitter: float = S.RETRY_JITTER) -> Column:
    """MATH-1: min(base * 2^attempt, cap) with +/- jitter."""
    a = S.col_of(attempt)
    d = F.least(F.lit(float(base)) * F.pow(F.lit(2.0), a.cast("double")), F.lit(float(cap)))
    return d * (F.lit(1.0 - jitter) + F.lit(2.0 * jitter) * retry_unit(S.col_of(key), a))


def plan_retries(failures: DataFrame, as_of, max_attempts: int = S.MAX_STAGE_ATTEMPTS, jitter: float = S.RETRY_JITTER) -> DataFrame:
    """UPD-10 (re-aimed Nack): for failed job attempts decide final failure or the next retry time.

    ``failures`` has id, file_id, stage, attempts (already incremented at claim) and error.
    """
    ts = S.ts_lit(as_of)
    final = F.col("attempts") >= max_attempts
    delay = backoff_seconds("attempts", "id", jitter=jitter)
    return failures.select(
        "id", "file_id", "stage", "attempts", "error",
        final.alias("final"),
        F.when(final, F.lit("failed")).otherwise(F.lit("pending")).alias("queue_status"),
        F.when(final, F.lit(None).cast("double")).otherwise(F.round(delay, 3)).alias("delay_seconds"),
        F.when(final, F.lit(None).cast("timestamp"))
        .otherwise(ts + F.make_dt_interval(secs=F.round(delay, 3).cast("decimal(18,6)"))).alias("retry_at"),
    )


def apply_retries(queue: DataFrame, stages: DataFrame, plan: DataFrame, as_of):
    """Write a retry plan into both tables: queue row pending at retry_at (or failed), stage failed
    with the message (finished_at set only when final)."""
    ts = S.ts_lit(as_of)
    p = plan.select("id", "queue_status", "retry_at", "final", "error", F.col("file_id").alias("_fid"),
                    F.col("stage").alias("_stg"))
    q = conform_queue(queue).join(p.select("id", "queue_status", "retry_at", "final"), "id", "left")
    hit = F.col("queue_status").isNotNull()
    new_q = q.select(
        "id", "file_id", "stage",
        F.when(hit, F.col("queue_status")).otherwise(F.col("status")).alias("status"),
        F.when(hit & ~F.col("final"), F.col("retry_at")).otherwise(F.col("available_at")).alias("available_at"),
        F.when(hit & ~F.col("final"), F.lit(None).cast("timestamp")).otherwise(F.col("locked_at")).alias("locked_at"),
        "attempts",
    )
    s = ST.conform_stages(stages).join(
        p.select(F.col("_fid").alias("file_id"), F.col("_stg").alias("stage"), F.col("final").alias("_final"),
                 F.col("error").alias("_err")),
        ["file_id", "stage"], "left",
    )
    shit = F.col("_final").isNotNull()
    new_s = s.select(
        "file_id", "stage",
        F.when(shit, F.lit("failed")).otherwise(F.col("status")).alias("status"),
        "attempts", "started_at",
        F.when(shit & F.col("_final"), ts).otherwise(F.col("finished_at")).alias("finished_at"),
        F.when(shit, F.col("_err")).otherwise(F.col("error_message")).alias("error_message"),
        F.when(shit, ts).otherwise(F.col("updated_at")).alias("updated_at"),
    )
    return new_q, new_s


def ack(queue: DataFrame, stages: DataFrame, done: DataFrame, as_of):
    """UPD-9: acknowledged jobs -> queue done, stage done (finished now, error cleared)."""
    ts = S.ts_lit(as_of)
    d = done.select("id", "file_id", "stage").distinct()
    q = conform_queue(queue).join(d.select("id").withColumn("_ack", F.lit(True)), "id", "left")
    new_q = q.select(
        "id", "file_id", "stage",
        F.when(F.col("_ack"), F.lit("done")).otherwise(F.col("status")).alias("status"),
        "available_at", "locked_at", "attempts",
    )
    s = ST.conform_stages(stages).join(d.select("file_id", "stage").withColumn("_ack", F.lit(True)),
                                       ["file_id", "stage"], "left")
    a = F.coalesce(F.col("_ack"), F.lit(False))
    new_s = s.select(
        "file_id", "stage",
        F.when(a, F.lit("done")).otherwise(F.col("status")).alias("status"),
        "attempts", "started_at",
        F.when(a, ts).otherwise(F.col("finished_at")).alias("finished_at"),
        F.when(a, F.lit(None).cast("string")).otherwise(F.col("error_message")).alias("error_message"),
        F.when(a, ts).otherwise(F.col("updated_at")).alias("updated_at"),
    )
    return new_q, new_s


# ------------------------------------------------------------------------------- metrics (AGG-13, 26, 27)


def depth(queue: DataFrame) -> DataFrame:
    """AGG-13: jobs per (stage, status), as a double like the gauge."""
    return queue.groupBy("stage", "status").agg(F.count(F.lit(1)).cast("double").alias("depth"))


def bucket_index(value: Column, bounds: list[float]) -> Column:
    """Index of the first bound >= value (len(bounds) for +Inf)."""
    out = F.lit(len(bounds))
    for i in reversed(range(len(bounds))):
        out = F.when(value <= F.lit(float(bounds[i])), F.lit(i)).otherwise(out)
    return out


def histogram(df: DataFrame, group: list[str], value: str | Column, bounds: list[float]) -> DataFrame:
    """AGG-26: cumulative ``le`` buckets per group, plus +Inf, count and sum.

    Rows are binned with a ``when`` chain and counted per (group, bin) -- a partial aggregate --
    and only the small (group x bins) result is made cumulative; there is no row x bucket join.
    """
    v = S.col_of(value).cast("double")
    binned = df.where(v.isNotNull()).groupBy(*group, bucket_index(v, bounds).alias("_bin")).agg(
        F.count(F.lit(1)).alias("_n"), F.sum(v).alias("_s"))
    les = F.array(*[F.lit(float(b)) for b in bounds], F.lit(float("inf")))
    grid = binned.select(*group).distinct().select(
        *group, F.posexplode(les).alias("_bin", "le"))
    j = grid.join(binned, [*group, "_bin"], "left").fillna(0, subset=["_n"])
    w = Window.partitionBy(*group).orderBy("_bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return j.select(*group, "le", F.sum("_n").over(w).alias("cumulative_count"))


def job_duration_histogram(events: DataFrame, bounds: list[float] = S.JOB_DURATION_BUCKETS) -> DataFrame:
    """AGG-26 over finished jobs (completed or failed events with a duration in ms)."""
    done = events.where(F.col("event_type").isin("completed", "failed"))
    return histogram(done, ["stage"], F.col("duration_ms") / F.lit(1000.0), bounds)


def job_outcomes(events: DataFrame) -> DataFrame:
    """AGG-27: processed jobs per stage and result."""
    result = F.when(F.col("event_type") == "completed", F.lit("success")).otherwise(F.lit("failure"))
    return (events.where(F.col("event_type").isin("completed", "failed"))
            .groupBy("stage", result.alias("result")).agg(F.count(F.lit(1)).alias("count")))
