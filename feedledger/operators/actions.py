"""Bulk actions over the catalog: target resolution, previews, enqueue outcomes, reprocessing,
purge, action gates, log and audit rows (JOIN-18, SORT-6/7, FLT-28, AGG-23..25, UPD-5, UPD-7,
SNK-4/5).

All per-file decisions of the pipeline's loops become columns of one DataFrame (``decide``), and
the outcome counters are a single conditional aggregate over it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas as S
from ..plans.listspec import ListSpec
from . import catalog as C
from . import jobs as J
from . import policy as P
from . import stages as ST


# ------------------------------------------------------------------------------ targets (JOIN-18)


def resolve_targets(files: DataFrame, ids: DataFrame | list[str] | None = None, pattern: str | None = None,
                    spec: ListSpec | None = None, stages: DataFrame | None = None,
                    max_rows: int | None = None) -> DataFrame:
    """JOIN-18 + SORT-7: ids, else a non-blank pattern, else filters (which must name a catalog or a
    period). All matches, in no order; with ``max_rows``, a display list sorted by filename."""
    if ids is not None and (not isinstance(ids, list) or ids):
        out = C.find_by_ids(files, ids)
    elif pattern is not None and pattern.strip():
        out = C.find_by_pattern(files, pattern)
    else:
        if spec is None or not spec.has_catalog_or_period():
            raise ValueError("filters must include catalog and/or period criteria")
        out = C.find_by_filters(files, spec, stages, max_rows)
    return out if max_rows is None else out.limit(max_rows).orderBy("filename")


# ------------------------------------------------------------------------ decisions (AGG-23/24)


def decide(targets: DataFrame, policy: P.Policy | None) -> DataFrame:
    """Per target: purged is tested first, then the policy. Adds ``decision`` in
    {'blocked_purged', 'blocked_policy', 'eligible'}."""
    t = targets if policy is None else P.policy_allows(targets, policy)
    allowed = F.lit(True) if policy is None else F.col("allowed")
    d = (F.when(F.col("overall_status") == "purged", F.lit("blocked_purged"))
         .when(~allowed, F.lit("blocked_policy")).otherwise(F.lit("eligible")))
    return t.withColumn("decision", d)


def preview(targets: DataFrame, policy: P.Policy | None, stage: str = "download") -> DataFrame:
    """AGG-23: matched, eligible, blocked by policy, blocked purged."""
    d = F.col("decision")
    return decide(targets, policy).agg(
        F.lit(stage).alias("stage"),
        F.count(F.lit(1)).alias("total_matched"),
        F.count_if(d == "eligible").alias("eligible"),
        F.count_if(d == "blocked_policy").alias("blocked_by_policy"),
        F.count_if(d == "blocked_purged").alias("blocked_purged"),
    )


def enqueue_batch(targets: DataFrame, stages: DataFrame, queue: DataFrame, policy: P.Policy | None, stage: str, as_of):
    """AGG-24: reset the stage and upsert a job for every eligible target.

    Returns (stages, queue, outcome) with enqueued / skipped / skipped_by_policy. Purged targets
    count as skipped; an enqueue that leaves a running job untouched still counts as enqueued,
    as in the pipeline.
    """
    d = decide(targets, policy)
    eligible = d.where(F.col("decision") == "eligible").select(F.col("id").alias("file_id"), F.lit(stage).alias("stage"))
    new_stages = P.reset_stage(stages, eligible, as_of)
    new_queue, _ = J.upsert_queue(queue, eligible, as_of)
    dec = F.col("decision")
    outcome = d.agg(
        F.count_if(dec == "eligible").alias("enqueued"),
        F.count_if(dec == "blocked_purged").alias("skipped"),
        F.count_if(dec == "blocked_policy").alias("skipped_by_policy"),
    )
    return new_stages, new_queue, outcome


def reprocess_failures(files: DataFrame, stages: DataFrame, queue: DataFrame, policy: P.Policy | None,
                       stage: str, since, as_of):
    """AGG-25: files whose ``stage`` failed since ``since`` (JOIN-1) that the policy admits are reset and re-enqueued. Returns (stages, queue, outcome: matched, enqueued)."""
    matched = C.failed_since(files, stages, since, stage)
    d = decide(matched, policy)
    ok = d.where(F.col("allowed") if policy is not None else F.lit(True))
    targets = ok.select(F.col("id").alias("file_id"), F.lit(stage).alias("stage"))
    new_stages = P.reset_stage(stages, targets, as_of)
    new_queue, _ = J.upsert_queue(queue, targets, as_of)
    allowed = F.col("allowed") if policy is not None else F.lit(True)
    outcome = d.agg(F.count(F.lit(1)).alias("matched"), F.count_if(allowed).alias("enqueued"))
    return new_stages, new_queue, outcome


# ------------------------------------------------------------------------------ gates (FLT-28)


def action_gate(files: DataFrame, policy: P.Policy, stage: str, downloads_paused: bool = False) -> DataFrame:
    """FLT-28: the first reason that blocks a single-file action, per file (NULL = allowed).

    Order: selection incomplete, downloads paused, stage disabled, policy denied.
    (Unknown files simply have no row.) The selection summary and config are one-row values
    read once on the driver and applied as literals.
    """
    summary = P.selection_summary(policy).first()
    cfg = P.processing(policy).first() if policy.config is not None else None
    enabled = True
    if cfg is not None:
        enabled = bool({"download": cfg["enable_download"], "csv_conversion": cfg["enable_csv"],
                        "parquet_conversion": cfg["enable_parquet"]}.get(stage, True))
    flagged = P.policy_allows(files, policy)
    reason = (
        F.when(F.lit(not bool(summary["complete"])), F.lit("policy selection incomplete"))
        .when(F.lit(downloads_paused and stage == "download"), F.lit("downloads paused"))
        .when(F.lit(not enabled), F.lit(f"stage {stage} disabled"))
        .when(~F.col("allowed"), F.lit("policy denied"))
    )
    return flagged.withColumn("blocked_reason", reason)


# -------------------------------------------------------------------------- updates (UPD-5/7)


def apply_file_changes(files: DataFrame, changes: DataFrame, as_of) -> DataFrame:
    """UPD-5 in batch form: ``changes`` has id plus any of overall_status, dbc_path, csv_path,
    parquet_path, local_hash; given (non-NULL) values replace the current ones."""
    cols = [c for c in ("overall_status", "dbc_path", "csv_path", "parquet_path", "local_hash") if c in changes.columns]
    ch = changes.select(F.col("id").alias("_cid"), *[F.col(c).alias(f"_n_{c}") for c in cols]).withColumn("_hit", F.lit(True))
    j = files.join(ch, files["id"] == ch["_cid"], "left")
    out = j
    for c in cols:
        out = out.withColumn(c, F.coalesce(F.col(f"_n_{c}"), F.col(c)))
    out = out.withColumn("updated_at", F.when(F.col("_hit"), S.ts_lit(as_of).cast(files.schema["updated_at"].dataType))
                         .otherwise(F.col("updated_at")))
    return out.drop("_cid", "_hit", *[f"_n_{c}" for c in cols])


def purge(files: DataFrame, stages: DataFrame, targets: DataFrame, as_of, id_col: str = "id"):
    """UPD-7: targets not yet purged become purged with paths cleared; all their stages purged;
    one 'purged' log row each; and the list of artifact paths to remove. Already purged files
    are a no-op. Returns (files, stages, logs, paths)."""
    t = targets.select(F.col(id_col).alias("_pid")).distinct()
    live = files.join(t, files["id"] == t["_pid"], "left_semi").where(F.col("overall_status") != "purged")
    hit = live.select(F.col("id").alias("_pid")).withColumn("_hit", F.lit(True))
    j = files.join(hit, files["id"] == hit["_pid"], "left")
    h = F.coalesce(F.col("_hit"), F.lit(False))
    ts = S.ts_lit(as_of).cast(files.schema["updated_at"].dataType)
    new_files = j.select(*[
        (F.when(h, F.lit("purged")).otherwise(F.col(c)).alias(c) if c == "overall_status" else
         F.when(h, F.lit(None).cast("string")).otherwise(F.col(c)).alias(c) if c in ("dbc_path", "csv_path", "parquet_path") else
         F.when(h, ts).otherwise(F.col(c)).alias(c) if c == "updated_at" else F.col(c))
        for c in files.columns
    ])
    new_stages = ST.purge_stages(stages, live.select("id"), as_of)
    logs = log_rows(live.select(F.col("id").alias("file_id")), "download", "purged", "file purged via API", as_of)
    paths = live.select("id", F.explode(F.array_compact(F.array("dbc_path", "csv_path", "parquet_path"))).alias("path"))
    return new_files, new_stages, logs, paths


# ------------------------------------------------------------------------- log rows (SNK-4/5)


def log_rows(df: DataFrame, stage: str | Column, event_type: str, message: str | Column, as_of,
             payload: Column | None = None) -> DataFrame:
    """SNK-4: log rows (file_id, stage, event_type, message, payload_json, created_at); the
    payload is serialised with ``to_json``. Ids are assigned by the writer."""
    st = stage if isinstance(stage, Column) else F.lit(stage)
    msg = message if isinstance(message, Column) else F.lit(message)
    return df.select(
        "file_id", st.alias("stage"), F.lit(event_type).alias("event_type"), msg.alias("message"),
        (F.to_json(payload) if payload is not None else F.lit(None).cast("string")).alias("payload_json"),
        S.ts_lit(as_of).alias("created_at"),
    )


def audit_row(df: DataFrame, action: str, stage: str | None, actor: str | None, details: Column, as_of) -> DataFrame:
    """SNK-5: one audit row per input row; blank actor -> 'ui'; details as JSON."""
    act = F.lit(actor).cast("string")
    return df.select(
        F.lit(action).alias("action"), F.lit(stage).cast("string").alias("stage"),
        F.coalesce(F.nullif(F.trim(act), F.lit("")), F.lit(S.DEFAULT_ACTOR)).alias("actor"),
        F.to_json(details).alias("details_json"), S.ts_lit(as_of).alias("created_at"),
    )


def latest_audit(audit: DataFrame, limit: int = S.AUDIT_DEFAULT_LIMIT) -> DataFrame:
    """SORT-6: newest audit rows (id breaks ties)."""
    return audit.orderBy(F.col("created_at").desc(), F.col("id").desc()).limit(limit if limit > 0 else S.AUDIT_DEFAULT_LIMIT)
