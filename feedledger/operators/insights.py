"""Dashboard insights: size levels, bar shares, KPIs, bucket checks and alerts (AGG-6, AGG-21/22,
AGG-28/29, PRJ-5, SORT-8, WIN-1..3, WIN-6).

Ranking windows here have no PARTITION BY on purpose: they run on the output of an aggregate
(one row per state or catalog, i.e. tens of rows), never on raw rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions import text as TX
from ..session import ensure_checkpoint_dir
from . import maintained as M
from . import policy as P
from . import stages as ST

SEXTILES = 6
DONE = {"download": "download_done", "csv_conversion": "csv_done", "parquet_conversion": "parquet_done"}


def with_size_level(buckets: DataFrame, size: str = "total_size_bytes") -> DataFrame:
    """WIN-1 + WIN-3: sextile level 0..5 of each bucket's size by mid-rank percentile.

    level = min(5, floor((less + eq/2) / n * 6)) with sizes clipped at 0; a size <= 0 is level 0,
    and when all sizes are equal and positive every level is 5.
    """
    s = F.greatest(F.coalesce(F.col(size), F.lit(0)), F.lit(0)).cast("double")
    b = buckets.withColumn("_s", s)
    whole = Window.partitionBy()
    by_rank = Window.orderBy("_s")
    b = (b.withColumn("_less", F.rank().over(by_rank) - 1)
         .withColumn("_eq", F.count(F.lit(1)).over(Window.partitionBy("_s")))
         .withColumn("_n", F.count(F.lit(1)).over(whole))
         .withColumn("_min", F.min("_s").over(whole))
         .withColumn("_max", F.max("_s").over(whole)))
    pr = (F.col("_less") + F.lit(0.5) * F.col("_eq")) / F.col("_n")
    level = (
        F.when(F.col("_s") <= 0, F.lit(0))
        .when(F.col("_max") <= 0, F.lit(0))
        .when(F.col("_min") == F.col("_max"), F.lit(5))
        .otherwise(F.least(F.lit(SEXTILES - 1), F.floor(pr * SEXTILES).cast("int")))
    )
    return (b.withColumn("level", level.cast("int")).withColumn("level_label", TX.level_label("level"))
            .drop("_s", "_less", "_eq", "_n", "_min", "_max"))


def sextile_bins(buckets: DataFrame, size: str = "total_size_bytes") -> DataFrame:
    """WIN-2: per bin b in 0..5 the [lo, hi] sizes: lo index floor(b*n/6), hi min(n-1, ceil((b+1)*n/6)-1)."""
    s = F.greatest(F.coalesce(F.col(size), F.lit(0)), F.lit(0)).cast("long")
    idx = buckets.select(s.alias("s")).withColumn("i", F.row_number().over(Window.orderBy("s")) - 1) \
        .withColumn("n", F.count(F.lit(1)).over(Window.partitionBy()))
    bins = idx.select("n").distinct().select("n", F.explode(F.sequence(F.lit(0), F.lit(SEXTILES - 1))).alias("bin"))
    bins = bins.withColumn("lo_i", F.floor(F.col("bin") * F.col("n") / SEXTILES).cast("int")).withColumn(
        "hi_i", F.least(F.col("n") - 1, (F.ceil((F.col("bin") + 1) * F.col("n") / SEXTILES) - 1).cast("int")))
    lo = idx.select(F.col("i").alias("lo_i"), F.col("s").alias("lo"))
    hi = idx.select(F.col("i").alias("hi_i"), F.col("s").alias("hi"))
    return bins.join(lo, "lo_i").join(hi, "hi_i").select("bin", "lo", "hi")


def with_bar_share(buckets: DataFrame, size: str = "total_size_bytes") -> DataFrame:
    """AGG-29: bar width = max(5, size / max size * 100) percent."""
    mx = F.max(size).over(Window.partitionBy())
    return buckets.withColumn("bar_pct", F.greatest(F.lit(5.0), F.try_divide(F.col(size).cast("double"), mx) * 100.0))


def top_buckets(buckets: DataFrame, n: int = 12) -> DataFrame:
    """SORT-8: the first ``n`` buckets in their report order (total desc, count desc, key asc)."""
    return buckets.orderBy(F.col("total_size_bytes").desc(), F.col("count").desc(), F.col("key").asc()).limit(n)


def kpis(files: DataFrame) -> DataFrame:
    """AGG-28: dashboard KPI sums from one pass over files."""
    st = F.col("overall_status")
    return files.agg(
        F.count(F.lit(1)).alias("total_files"),
        F.count_if(st.isin("downloading", "converting_csv", "converting_parquet")).alias("in_progress"),
        F.count_if(st == "failed").alias("failed"),
        F.count_if(st == "pending").alias("pending"),
        F.count_if(st == "ignored").alias("ignored"),
    )


def bucket_mismatch(files: DataFrame) -> DataFrame:
    """AGG-21: sum of bucket counts minus the status total, for catalog and state buckets."""
    buckets = dashboard_buckets(files)  # one scan
    row = buckets.agg(*[F.coalesce(F.sum(F.when(F.col("dim") == d, F.col("count"))), F.lit(0)).alias(n)
                        for d, n in (("status", "total"), ("catalog", "cat"), ("state", "st"))])
    return row.select(
        F.col("total").cast("long").alias("total_files"),
        (F.col("cat") - F.col("total")).cast("long").alias("by_catalog_total_mismatch"),
        (F.col("st") - F.col("total")).cast("long").alias("by_state_total_mismatch"),
    )


def alerts(stages: DataFrame, as_of, spike_min: int = 10, stall_seconds: int = 1800) -> DataFrame:
    """WIN-6: failure spike (last hour > 2x previous hour and > 10) and stalled queue (oldest
    pending > 30 min). One pass counts both hours; returns only the alerts that fire."""
    t = S.as_ts("updated_at")
    now = S.ts_lit(as_of)
    h1 = now - F.expr("INTERVAL 1 HOUR")
    h2 = now - F.expr("INTERVAL 2 HOURS")
    failed = F.col("status") == "failed"
    c = stages.agg(
        F.count_if(failed & (t >= h1) & (t < now)).alias("current"),
        F.count_if(failed & (t >= h2) & (t < h1)).alias("previous"),
        F.min(F.when(F.col("status") == "pending", t)).alias("_oldest"),
    ).withColumn("oldest_pending_seconds", F.coalesce(ST.age_seconds(as_of, F.col("_oldest")), F.lit(0).cast("long")))
    spike = c.where((F.col("current") > 2 * F.col("previous")) & (F.col("current") > spike_min)).select(
        F.lit("failure_spike").alias("type"), F.lit(S.ALERT_MESSAGES["failure_spike"]).alias("message"),
        "current", "previous", F.lit(None).cast("long").alias("oldest_pending_seconds"))
    stall = c.where(F.col("oldest_pending_seconds") > stall_seconds).select(
        F.lit("queue_stalled").alias("type"), F.lit(S.ALERT_MESSAGES["queue_stalled"]).alias("message"),
        F.lit(None).cast("long").alias("current"), F.lit(None).cast("long").alias("previous"), "oldest_pending_seconds")
    return spike.unionByName(stall)


def failure_series(stages: DataFrame, bucket: str = "1 hour") -> DataFrame:
    """WIN-6 series form: failures per hour with the previous hour via ``lag`` (one row per hour,
    so the unpartitioned window runs on the aggregated series only)."""
    per_hour = stages.where(F.col("status") == "failed").groupBy(
        F.window(S.as_ts("updated_at"), bucket).alias("w")).agg(F.count(F.lit(1)).alias("failures"))
    return per_hour.select(F.col("w.start").alias("hour"), "failures").withColumn(
        "previous", F.lag("failures").over(Window.orderBy("hour"))).withColumn(
        "spike", (F.col("failures") > 2 * F.coalesce("previous", F.lit(0))) & (F.col("failures") > 10))


STAGE_CELLS = ["stage", "status", "reason"]


@dataclass
class DashboardCells:
    """What the dashboard's results are small sums of: counts of files by status, catalog, state, period
    and done stages, and counts of stage rows by stage, status and failure reason."""

    files: DataFrame
    stages: DataFrame


def dashboard_cells(files: DataFrame, stages: DataFrame) -> DashboardCells:
    """One scan of either table: per file its stage rows come together once (they are a few), join the
    file, and both kinds of counts are summed up from there and checkpointed."""
    ensure_checkpoint_dir(files.sparkSession)
    failed = F.when(F.col("status") == "failed", ST.failure_reason())
    rows = stages.groupBy("file_id").agg(F.collect_list(F.struct("stage", "status", failed.alias("reason"))).alias("rows"))
    both = files.select("id", "overall_status", "catalog", "state", "year", "month", "size_bytes", F.lit(True).alias("known")).join(rows, files["id"] == rows["file_id"], "full_outer")
    flag = lambda stage: F.exists("rows", lambda r: (r["stage"] == stage) & (r["status"] == "done")).alias(f"{DONE[stage]}")
    flags = list(DONE.values())
    size = F.col("size_bytes")
    per_file = both.select(*M.KEYS, F.coalesce("known", F.lit(False)).alias("known"), *(flag(s) for s in DONE), F.when(F.col("known"), 1).otherwise(0).alias("files"),
                           F.when(size.isNotNull(), 1).otherwise(0).alias("sized"), F.coalesce(size, F.lit(0)).alias("bytes"), "rows")
    kinds = F.array(F.struct(F.lit("file").alias("kind"), F.lit(None).cast("string").alias("stage"), F.lit(None).cast("string").alias("status"), F.lit(None).cast("string").alias("reason")))
    tagged = F.transform(F.coalesce("rows", F.array().cast(both.schema["rows"].dataType)), lambda r: F.struct(F.lit("stage").alias("kind"), r["stage"].alias("stage"), r["status"].alias("status"), r["reason"].alias("reason")))
    each = per_file.withColumn("x", F.explode(F.concat(kinds, tagged))).select(*M.KEYS, "known", *flags, "files", "sized", "bytes", "x.*")
    own = F.col("kind") == "file"  # a stage row belongs to its kind, status and reason alone
    keys = [F.when(own, F.col(c)).alias(c) for c in (*M.KEYS, "known", *flags)]
    cells = each.groupBy("kind", *STAGE_CELLS, *keys).agg(
        *(F.sum(F.when(own, F.col(c))).cast("long").alias(c) for c in M.FIGURES), F.count(F.lit(1)).alias("rows")).checkpoint(eager=True)
    return DashboardCells(cells.where(own & F.col("known")).select(*M.KEYS, *flags, *M.FIGURES), cells.where(~own).select(*STAGE_CELLS, F.col("rows").alias("n")))


def dashboard(files: DataFrame, stages: DataFrame, policy: P.Policy | None = None, fail_limit: int = 10) -> dict:
    """AGG-22: the dashboard's named results, all from ``dashboard_cells``: files and stages are read
    once, whatever the number of results."""
    toggles = (True, True, True)
    if policy is not None and policy.config is not None:
        row = P.processing(policy).first()
        toggles = (bool(row["enable_download"]), bool(row["enable_csv"]), bool(row["enable_parquet"]))
    cells = dashboard_cells(files, stages)
    by_file, by_stage = cells.files, cells.stages
    count = lambda cond, name: F.coalesce(F.sum(F.when(cond, F.col("files"))), F.lit(0)).cast("long").alias(name)
    st, terminal = F.col("overall_status"), ST.expected_terminal_status(*toggles)
    done = ST.completed_expr(*toggles)
    total, in_stage = F.coalesce(F.sum("files"), F.lit(0)).cast("long"), lambda stage: F.coalesce(F.sum(F.when((F.col("stage") == stage) & (F.col("status") == "done"), F.col("n"))), F.lit(0)).cast("long")
    reasons = by_stage.where(F.col("status") == "failed").groupBy("stage", "reason").agg(F.sum("n").alias("total"))
    groups = {c: M.size_by(by_file, c) for c in ("catalog", "state")}
    sums = by_file.select(F.lit("total").alias("of"), F.col("files").alias("n"))  # the buckets' own sums against the total
    for c, buckets in groups.items():
        sums = sums.unionByName(buckets.select(F.lit(c).alias("of"), F.col("count").alias("n")))
    summed = lambda of: F.coalesce(F.sum(F.when(F.col("of") == of, F.col("n"))), F.lit(0)).cast("long")
    mismatch = sums.agg(summed("total").alias("total_files"), *((summed(c) - summed("total")).alias(f"by_{c}_total_mismatch") for c in groups))
    out = {
        "status_counts": M.status_counts(by_file),
        "by_catalog": with_bar_share(with_size_level(groups["catalog"])),
        "by_state": with_bar_share(with_size_level(groups["state"])),
        "failure_reasons": reasons.orderBy(F.col("total").desc(), F.col("stage").asc(), F.col("reason").asc()).limit(fail_limit if fail_limit > 0 else 10),
        "pipeline": by_file.agg(count(done, "pipeline_completed_count"), count((done & (st != terminal)) | (~done & (st == terminal)), "status_stage_mismatch_count")),
        "stage_done_counts": by_stage.agg(*(in_stage(s).alias(DONE[s]) for s in DONE)),
        "policy_counts": M.pending_and_ignored_counts(by_file),
        "bucket_mismatch": mismatch,
        "kpis": by_file.agg(total.alias("total_files"), count(st.isin("downloading", "converting_csv", "converting_parquet"), "in_progress"),
                            *(count(st == s, s) for s in ("failed", "pending", "ignored"))),
        "facets": M.facets(by_file),
        "expected_terminal_status": terminal,
    }
    if policy is not None:
        out["selection"] = P.selection_summary(policy)
    return out


def dashboard_buckets(files: DataFrame) -> DataFrame:
    """AGG-22 in one pass: the status, catalog and state bucket reports (count, total and rounded
    mean size) as one ``GROUPING SETS`` aggregate -- one scan and one shuffle instead of three.
    Rows carry ``dim`` in {status, catalog, state} and the bucket ``key``."""
    keyed = files.select(
        F.col("overall_status").alias("_status"), S.norm_code("catalog").alias("_catalog"),
        S.norm_code("state").alias("_state"), F.col("size_bytes"))
    total = F.sum("size_bytes")
    agg = keyed.groupingSets([["_status"], ["_catalog"], ["_state"]], "_status", "_catalog", "_state").agg(
        F.count(F.lit(1)).alias("count"),
        F.coalesce(total, F.lit(0)).cast("long").alias("total_size_bytes"),
        S.pg_bigint(F.coalesce(F.try_divide(total.cast("double"), F.count("size_bytes")), F.lit(0.0))).alias("avg_size_bytes"),
        F.grouping_id().alias("_gid"),
    )
    # grouping_id bits follow the column order (_status, _catalog, _state): 3 = status, 5 = catalog, 6 = state
    dim = F.when(F.col("_gid") == 3, F.lit("status")).when(F.col("_gid") == 5, F.lit("catalog")).otherwise(F.lit("state"))
    key = F.when(F.col("_gid") == 3, F.col("_status")).when(F.col("_gid") == 5, F.col("_catalog")).otherwise(F.col("_state"))
    return agg.select(dim.alias("dim"), key.alias("key"), "count", "total_size_bytes", "avg_size_bytes")
