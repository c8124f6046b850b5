"""Directory listings against the file catalog: parse, diff, policy, upsert, touch, ignore, stage
plan and per-directory counters (SRC-1..3/6, PRJ-3, JOIN-8/9/14, FLT-21/23, UPD-3/4/8/12/13/14,
AGG-14..16, AGG-31).

The whole scan is one DataFrame pipeline: the listing is classified once (``classify_listing``)
into ``kind`` / ``allowed`` / parse columns, and every output -- upserts, touches, ignores, the
stage plan and the counters -- is derived from that one classified DataFrame. The diff is an
equi-join on (ftp_dir, filename); the policy test is four bounded broadcast joins.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions import names as N
from ..session import ensure_checkpoint_dir, ship_package
from . import jobs as J
from . import policy as P
from . import stages as ST

# Kinds of a listing entry.
KINDS = ["new", "changed", "unchanged", "unparsed", "other"]


# ------------------------------------------------------------------------------- listings (SRC)


def list_directories(spark: SparkSession, paths: list[str] | str, recursive: bool = False) -> DataFrame:
    """SRC-1/2/3: regular files of one or more directories as (ftp_dir, name, size, mod_time, remote_path).

    Tasks list the directories, a level of the tree in each round, and their entries are
    checkpointed: no list of files or directories passes through the driver, file bodies are never
    read, and the listing is that of the call. Hidden entries (Spark's rule) and empty files are left
    out, a missing directory is an error, a path that is a file is listed itself.
    """
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    many = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def entries(batches):
        import pandas as pd

        from ..sources import fsio

        for pdf in batches:
            for d in pdf["path"]:
                yield pd.DataFrame(fsio.entries(d), columns=["path", "is_dir", "size", "ms"]).astype({"size": "int64", "ms": "int64", "is_dir": "bool"})

    given = [re.sub("^file:/*", "/", p).rstrip("/") or "/" for p in ([paths] if isinstance(paths, str) else paths)]
    level = spark.createDataFrame([(p,) for p in given], "path string")
    found = None
    while True:
        # by number: adaptive execution would put all of these few bytes into one task
        own = level.repartition(many, "path").mapInPandas(entries, "path string, is_dir boolean, size long, ms long").checkpoint(eager=True)
        found = own if found is None else found.unionByName(own)
        level = own.where("is_dir").select("path")
        if not recursive or level.isEmpty():
            break
    path = F.col("path")
    return found.where(~F.col("is_dir")).select(
        F.regexp_extract(path, r"^(.*)/[^/]*$", 1).alias("ftp_dir"),
        F.regexp_extract(path, r"([^/]*)$", 1).alias("name"),
        F.col("size"),
        F.timestamp_millis("ms").alias("mod_time"),
        path.alias("remote_path"),
    )


def snapshot(files: DataFrame, ftp_dir: str | None = None) -> DataFrame:
    """SRC-6: the five-column projection used by the diff (one directory, or all)."""
    df = files if ftp_dir is None else files.where(F.col("ftp_dir") == ftp_dir)
    return df.select("id", "filename", "size_bytes", "remote_timestamp", "overall_status", "ftp_dir")


def is_unchanged(size_a: Column, ts_a: Column, size_b: Column, ts_b: Column) -> Column:
    """FLT-23: both size and timestamp known and equal."""
    return F.coalesce((size_a == size_b) & (ts_a == ts_b), F.lit(False))


def should_move_to_ignored(status: str | Column = "overall_status") -> Column:
    """FLT-21: statuses a policy denial may move to ignored."""
    return S.col_of(status).isin(S.RECONCILE_TO_IGNORED)


def collapse_copies(listing: DataFrame, order_col: str | None = None) -> DataFrame:
    """Pre-aggregate exact copies of a listing entry (same directory, name, size, time and path)
    into one row with a ``copies`` count (and the last ``order_col``), before any shuffle join.

    The partial aggregate runs map-side, so a name listed millions of times costs one row per task,
    not a hot join key. Every classification depends only on these columns, so counters weighted
    by ``copies`` equal the per-entry counts.
    """
    keys = ["ftp_dir", "name", "size", "mod_time", "remote_path"]
    aggs = [F.count(F.lit(1)).alias("copies")]
    if order_col:
        aggs.append(F.max(order_col).alias(order_col))
    return listing.groupBy(*keys).agg(*aggs)


def classify_listing(listing: DataFrame, files: DataFrame, policy: P.Policy | None, as_of_year: int,
                     order_col: str | None = None, collapse: bool = True) -> DataFrame:
    """JOIN-8 + PRJ-1 + JOIN-3: one row per listing entry (or per group of exact copies, with a
    ``copies`` count, when ``collapse``) with

    filename (upper), p.* (parsed name), kind (new / changed / unchanged / unparsed / other),
    existing_id, prev_status and allowed (NULL unless parsed).
    """
    if collapse:
        listing = collapse_copies(listing, order_col)
    elif "copies" not in listing.columns:
        listing = listing.withColumn("copies", F.lit(1).cast("long"))
    l = listing.withColumn("filename", F.upper("name")).withColumn("is_data", N.has_data_extension("name"))
    l = N.with_parsed_name(l, "name", as_of_year, "p")
    snap = snapshot(files).select(
        F.col("id").alias("existing_id"), F.col("filename").alias("_s_filename"),
        F.col("size_bytes").alias("_s_size"), F.col("remote_timestamp").alias("_s_ts"),
        F.col("overall_status").alias("prev_status"), F.col("ftp_dir").alias("_s_dir"),
    )
    j = l.join(snap, (l["ftp_dir"] == snap["_s_dir"]) & (l["filename"] == snap["_s_filename"]), "left")
    parsed = F.col("p.error").isNull()
    kind = (
        F.when(~F.col("is_data"), F.lit("other"))
        .when(~parsed, F.lit("unparsed"))
        .when(F.col("existing_id").isNull(), F.lit("new"))
        .when(is_unchanged(F.col("_s_size"), F.col("_s_ts"), F.col("size"), F.col("mod_time")), F.lit("unchanged"))
        .otherwise(F.lit("changed"))
    )
    out = j.withColumn("kind", kind).drop("_s_filename", "_s_size", "_s_ts", "_s_dir")
    out = out.withColumn("prev_status", F.when(F.col("kind") == "new", F.lit("pending")).otherwise(F.col("prev_status")))
    if policy is None:
        return out.withColumn("allowed", F.when(parsed, F.lit(True)))
    out = out.withColumn("_pc", F.col("p.catalog")).withColumn("_ps", F.col("p.state")) \
             .withColumn("_py", F.col("p.year")).withColumn("_pm", F.col("p.month"))
    out = P.policy_allows(out, policy, catalog="_pc", state="_ps", year="_py", month="_pm")
    return out.withColumn("allowed", F.when(parsed, F.col("allowed"))).drop("_pc", "_ps", "_py", "_pm")


def _weighted(cond: Column) -> Column:
    """Entries (copies included) satisfying ``cond``."""
    return F.coalesce(F.sum(F.when(cond, F.col("copies"))), F.lit(0)).cast("long")


def diff_counts(classified: DataFrame) -> DataFrame:
    """Counts of each kind over all entries (one row)."""
    k = F.col("kind")
    return classified.agg(*[_weighted(k == x).alias(x) for x in KINDS])


# ----------------------------------------------------------------------------- upsert (JOIN-9)


def conform_files(files: DataFrame) -> DataFrame:
    """Bring a files table to the full ``FILES`` schema (missing columns as NULL, extras dropped)."""
    cols = []
    for f in S.FILES.fields:
        if f.name in files.columns:
            cols.append(F.col(f.name).cast(f.dataType).alias(f.name))
        else:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
    return files.select(*cols)


def _upsert_struct(root: Column) -> Column:
    return F.struct(
        F.col("p.catalog").alias("catalog"), F.col("p.state").alias("state"),
        F.col("p.year").alias("year"), F.col("p.month").alias("month"),
        F.col("p.segment").alias("segment"),
        F.col("ftp_dir").alias("ftp_dir"), F.col("remote_path").alias("ftp_path"),
        F.col("size").cast("long").alias("size_bytes"),
        F.lit(None).cast("string").alias("remote_checksum"),
        F.col("mod_time").cast("timestamp").alias("remote_timestamp"),
        root.alias("root_path"),
    )


def _listing_order(order_col: str | None) -> Column:
    return F.struct(F.col(order_col), F.col("remote_path")) if order_col else F.struct(F.col("remote_path"), F.col("size"))


def upsert_rows(classified: DataFrame, root_path: str | Column, order_col: str | None = None) -> DataFrame:
    """PRJ-3: upsert rows for new and changed entries; duplicate names keep the last listed one."""
    src = classified.where(F.col("kind").isin("new", "changed"))
    root = root_path if isinstance(root_path, Column) else F.lit(root_path)
    # last listed wins: max_by is a partial aggregate, so a name listed many times is reduced
    # in every map task before the shuffle (a per-name window would put all copies in one task)
    return src.groupBy("filename").agg(F.max_by(_upsert_struct(root), _listing_order(order_col)).alias("_r")) \
        .select("filename", "_r.*")


def upsert_files(files: DataFrame, rows: DataFrame, as_of) -> DataFrame:
    """JOIN-9: insert new names, or update ftp_path / size / checksum / timestamp / segment and the
    seen/updated times of existing ones; everything else is kept. Adds ``is_new`` (NULL for rows
    the upsert did not touch)."""
    ts = S.ts_lit(as_of)
    cur = conform_files(files).alias("f")
    r = rows.alias("r")
    j = cur.join(r, F.col("f.filename") == F.col("r.filename"), "full_outer")
    # rows may also carry per-name flags only (``_upsert`` false): they change nothing here
    has_r = F.coalesce(F.col("r._upsert"), F.lit(False)) if "_upsert" in rows.columns else F.col("r.filename").isNotNull()
    is_new = F.col("f.id").isNull()
    j = j.where(F.col("f.id").isNotNull() | has_r)
    extra = [F.col(f"r.{c}").alias(c) for c in rows.columns if c.startswith("_") and c != "_upsert"]
    seg = F.when(F.trim(F.col("r.segment")) != "", F.col("r.segment"))

    def upd(name: str, new: Column) -> Column:
        return F.when(has_r, new).otherwise(F.col(f"f.{name}")).alias(name)

    def keep_or_new(name: str, new: Column) -> Column:
        return F.when(is_new, new).otherwise(F.col(f"f.{name}")).alias(name)

    return j.select(
        keep_or_new("id", N.file_id_for(F.col("r.filename"))),
        F.coalesce(F.col("f.filename"), F.col("r.filename")).alias("filename"),
        keep_or_new("catalog", F.col("r.catalog")),
        keep_or_new("state", F.col("r.state")),
        keep_or_new("year", F.col("r.year")),
        keep_or_new("month", F.col("r.month")),
        upd("segment", seg),
        keep_or_new("ftp_dir", F.col("r.ftp_dir")),
        upd("ftp_path", F.col("r.ftp_path")),
        upd("size_bytes", F.col("r.size_bytes")),
        upd("remote_checksum", F.col("r.remote_checksum")),
        upd("remote_timestamp", F.col("r.remote_timestamp")),
        F.col("f.local_hash").alias("local_hash"),
        keep_or_new("root_path", F.col("r.root_path")),
        F.col("f.dbc_path").alias("dbc_path"),
        F.col("f.csv_path").alias("csv_path"),
        F.col("f.parquet_path").alias("parquet_path"),
        keep_or_new("overall_status", F.lit("pending")),
        keep_or_new("created_at", ts),
        upd("updated_at", ts),
        upd("last_seen_at", ts),
        F.when(has_r, is_new).alias("is_new"),
        *extra,
    )


def touch_last_seen(files: DataFrame, ids: DataFrame, as_of, id_col: str = "id") -> DataFrame:
    """UPD-3: last_seen_at = as_of for the given ids (nothing else changes)."""
    hit = ids.select(F.col(id_col).alias("_tid")).distinct().withColumn("_touch", F.lit(True))
    j = files.join(hit, files["id"] == hit["_tid"], "left")
    ts = S.ts_lit(as_of).cast(files.schema["last_seen_at"].dataType)
    return j.withColumn("last_seen_at", F.when(F.col("_touch"), ts).otherwise(F.col("last_seen_at"))).drop("_tid", "_touch")


def bulk_ignore(files: DataFrame, ids: DataFrame, as_of, id_col: str = "id"):
    """UPD-4: ids -> ignored, but only while still pending / downloaded / csv_ready.
    Returns (files, counts) with the number of rows actually moved."""
    hit = ids.select(F.col(id_col).alias("_iid")).distinct().withColumn("_ign", F.lit(True))
    j = files.join(hit, files["id"] == hit["_iid"], "left")
    move = F.coalesce(F.col("_ign"), F.lit(False)) & should_move_to_ignored()
    out = j.withColumn("_moved", move).withColumn(
        "overall_status", F.when(F.col("_moved"), F.lit("ignored")).otherwise(F.col("overall_status"))
    ).withColumn("updated_at", F.when(F.col("_moved"), S.ts_lit(as_of).cast(files.schema["updated_at"].dataType))
                 .otherwise(F.col("updated_at")))
    counts = out.agg(F.count_if("_moved").alias("ignored"))
    return out.drop("_iid", "_ign", "_moved"), counts


# ------------------------------------------------------------------------- stage plan (UPD-8)


def config_values(policy: P.Policy | None) -> dict:
    """The one-row processing config as driver-side literals (one bounded row)."""
    if policy is None or policy.config is None:
        return {"enable_download": True, "enable_csv": True, "enable_parquet": True,
                "download_dir": None, "csv_dir": None, "parquet_dir": None}
    row = P.processing(policy).first()
    return row.asDict() if row is not None else config_values(None)


def with_artifact_flags(files: DataFrame, artifacts: DataFrame | None, path_col: str = "path",
                        key: str = "id") -> DataFrame:
    """JOIN-14: flag which recorded paths exist in an artifact listing (no per-row stat).

    The three path columns are unpivoted into (key, kind, path) rows, semi-joined once with the
    de-duplicated listing, folded back to one row of flags per key, and joined to ``files`` by key:
    the listing is shuffled once, not once per path column.
    """
    kinds = ("dbc", "csv", "parquet")
    if artifacts is None:
        out = files
        for k in kinds:
            c = F.col(f"{k}_path")
            out = out.withColumn(f"{k}_exists", c.isNotNull() & (F.trim(c) != ""))
        return out
    paths = files.select(key, F.explode(F.array(*[
        F.struct(F.lit(k).alias("kind"), F.col(f"{k}_path").alias("p")) for k in kinds])).alias("_x")) \
        .select(key, "_x.kind", "_x.p").where(F.col("p").isNotNull() & (F.trim("p") != ""))
    listing = artifacts.select(F.col(path_col).alias("p")).distinct()
    hits = paths.join(listing, "p", "left_semi")
    flags = hits.groupBy(key).agg(*[F.max(F.col("kind") == k).alias(f"_h_{k}") for k in kinds])
    out = files.join(flags, key, "left")
    for k in kinds:
        out = out.withColumn(f"{k}_exists", F.coalesce(F.col(f"_h_{k}"), F.lit(False))).drop(f"_h_{k}")
    return out


def stage_status_pivot(stages: DataFrame) -> DataFrame:
    """Per file, the status of each of the three stages (NULL when the row is missing)."""
    return stages.groupBy("file_id").agg(
        *[F.max(F.when(F.col("stage") == s, F.col("status"))).alias(f"{s}_status") for s in S.STAGES]
    )


def plan_stages(files: DataFrame, stages: DataFrame, policy: P.Policy | None, artifacts: DataFrame | None = None,
                refetch_changed: DataFrame | None = None) -> DataFrame:
    """UPD-8: (file_id, stage) jobs to enqueue for admitted files.

    download when enabled and the data file is absent; conversions when enabled and it is present;
    never for stages that are running, done or purged. Missing stage rows count as pending (they
    are created first). ``refetch_changed`` (ids) also re-downloads those files.
    """
    cfg = config_values(policy)
    f = files if policy is None else P.admitted(files, policy)
    f = with_artifact_flags(f.select("id", "dbc_path", "csv_path", "parquet_path"), artifacts)
    piv = stage_status_pivot(stages)
    j = f.join(piv, f["id"] == piv["file_id"], "left").drop("file_id")
    blocked = ["running", "done", "purged"]
    has = F.col("dbc_exists")
    refetch = F.lit(False)
    if refetch_changed is not None:
        r = refetch_changed.select(F.col("id").alias("_rid")).distinct().withColumn("_refetch", F.lit(True))
        j = j.join(r, j["id"] == r["_rid"], "left").drop("_rid")
        refetch = F.coalesce(F.col("_refetch"), F.lit(False))
    want = {
        "download": F.lit(bool(cfg["enable_download"])) & (~has | refetch),
        "csv_conversion": F.lit(bool(cfg["enable_csv"])) & has,
        "parquet_conversion": F.lit(bool(cfg["enable_parquet"])) & has,
    }
    arr = F.array(*[
        F.when(want[s] & ~F.coalesce(F.col(f"{s}_status"), F.lit("pending")).isin(blocked), F.lit(s))
        for s in S.STAGES
    ])
    return j.select(F.col("id").alias("file_id"), F.explode(F.array_compact(arr)).alias("stage"))


def apply_stage_plan(stages: DataFrame, queue: DataFrame, plan: DataFrame, planned_files: DataFrame, as_of):
    """Write a stage plan: create missing stage rows, reset planned stages, upsert planned jobs.
    Returns (stages, queue, counts)."""
    with_rows = ST.init_stages(stages, planned_files.select("id"), as_of)
    reset = P.reset_stage(with_rows, plan, as_of)
    new_queue, counts = J.upsert_queue(queue, plan, as_of)
    return reset, new_queue, counts


# ----------------------------------------------------------------------- counters (AGG-14..16)


def scan_summary(classified: DataFrame, planned: DataFrame | None = None, count_mode: str = "batch") -> DataFrame:
    """AGG-14: per directory found / new / changed / skipped / skipped_by_policy / enqueued.

    The counters overlap as in the pipeline: skipped = unparseable + unchanged, and
    skipped_by_policy counts parsed entries the policy denies whatever their kind. ``found`` counts
    parsed entries ("batch") or every data-file entry ("legacy").
    """
    k = F.col("kind")
    parsed = k.isin("new", "changed", "unchanged")
    found = parsed if count_mode == "batch" else k != "other"
    aggs = [
        _weighted(found).alias("found"),
        _weighted(k == "new").alias("new"),
        _weighted(k == "changed").alias("changed"),
        _weighted(k.isin("unparsed", "unchanged")).alias("skipped"),
        _weighted(parsed & ~F.col("allowed")).alias("skipped_by_policy"),
    ]
    out = classified.groupBy("ftp_dir").agg(*aggs)
    if planned is not None:
        weight = F.sum("n") if "n" in planned.columns else F.count(F.lit(1))
        enq = planned.groupBy("ftp_dir").agg(weight.alias("enqueued"))
        out = out.join(enq, "ftp_dir", "left").withColumn("enqueued", F.coalesce("enqueued", F.lit(0)).cast("long"))
    return out


def scan_totals(summary: DataFrame) -> DataFrame:
    """AGG-15: totals over directories."""
    cols = [c for c in summary.columns if c != "ftp_dir"]
    return summary.agg(*[F.sum(c).cast("long").alias(c) for c in cols])


def policy_skips(classified: DataFrame, source: str = "scanner_batch") -> DataFrame:
    """AGG-16: policy denials per state and source."""
    parsed = F.col("kind").isin("new", "changed", "unchanged")
    return classified.where(parsed & ~F.col("allowed")).groupBy(
        F.col("p.state").alias("state"), F.lit(source).alias("source")
    ).agg(F.sum("copies").cast("long").alias("skips"))


# ------------------------------------------------------------------------ full merge (UPD-14)


@dataclass
class ScanResult:
    classified: DataFrame
    files: DataFrame
    stages: DataFrame
    queue: DataFrame
    plan: DataFrame
    summary: DataFrame


def merge_scan(files: DataFrame, stages: DataFrame, queue: DataFrame, listing: DataFrame, policy: P.Policy | None,
               as_of, as_of_year: int, root_path: str = "/data", artifacts: DataFrame | None = None,
               order_col: str | None = None, count_mode: str = "batch", refetch_changed: bool = False,
               checkpoint: bool = False) -> ScanResult:
    """UPD-14: parse -> diff -> policy -> upsert -> touch -> ignore -> stage plan -> counters.

    Lazily composed; the classified listing is the one shared input of every output. With
    ``checkpoint`` it is materialised once in the cluster's checkpoint folder (lineage cut), so
    writing the files, stages, queue and summary does not re-read and re-join the listing, and a
    lost executor does not send the merge back to the listing. Write the outputs to fresh paths.
    """
    cfg = config_values(policy)
    root = P.resolve_directory(F.lit(cfg.get("download_dir")), F.lit(root_path)) if policy is not None else F.lit(root_path)
    c = classify_listing(listing, files, policy, as_of_year, order_col)
    if checkpoint:
        from ..session import ensure_checkpoint_dir

        ensure_checkpoint_dir(c.sparkSession)
        c = c.checkpoint(eager=True)
    # every per-name decision in one aggregate over the classified listing (partial, map-side):
    # the upsert row (last listed new/changed entry), touch (listed unchanged), ignore (denied
    # while pending/downloaded/csv_ready) and admit -- then one full outer join with the catalog
    parsed = F.col("kind").isin("new", "changed", "unchanged")
    upsert_entry = F.col("kind").isin("new", "changed")
    per_name = c.groupBy("filename").agg(
        F.max_by(_upsert_struct(root), F.when(upsert_entry, _listing_order(order_col))).alias("_r"),
        F.bool_or(F.col("kind") == "unchanged").alias("_touch"),
        F.bool_or(parsed & ~F.col("allowed") & should_move_to_ignored("prev_status")).alias("_deny"),
        F.bool_or(parsed & F.col("allowed")).alias("_admit"),
    )
    rows = per_name.select("filename", "_r.*", F.col("_r").isNotNull().alias("_upsert"), "_touch", "_deny", "_admit")
    up = upsert_files(files, rows, as_of)
    ts = S.ts_lit(as_of)
    touch = F.coalesce(F.col("_touch"), F.lit(False))
    moved = F.coalesce(F.col("_deny"), F.lit(False)) & should_move_to_ignored("overall_status")  # UPD-4 guard
    merged = (up.withColumn("last_seen_at", F.when(touch, ts).otherwise(F.col("last_seen_at")))  # UPD-3
              .withColumn("_moved", moved)
              .withColumn("overall_status", F.when(F.col("_moved"), F.lit("ignored")).otherwise(F.col("overall_status")))
              .withColumn("updated_at", F.when(F.col("_moved"), ts).otherwise(F.col("updated_at"))))
    if checkpoint:
        merged = merged.checkpoint(eager=True)
    new_files = merged.drop("_touch", "_deny", "_admit", "_moved")
    targets = merged.where(F.coalesce(F.col("_admit"), F.lit(False))).drop("_touch", "_deny", "_admit", "_moved")
    admitted_entries = c.where(parsed & F.col("allowed")).select("filename", "ftp_dir", "kind", "copies")
    refetch = (targets.join(admitted_entries.where(F.col("kind") == "changed").select("filename").distinct(), "filename",
                            "left_semi").select("id") if refetch_changed else None)
    plan = plan_stages(targets, stages, None, artifacts, refetch)
    new_stages, new_queue, _ = apply_stage_plan(stages, queue, plan, targets, as_of)
    # every admitted entry reconciles its file, so it counts that file's planned stages
    per_file = plan.groupBy("file_id").agg(F.count(F.lit(1)).alias("_n")).join(
        targets.select(F.col("id").alias("file_id"), "filename"), "file_id")
    planned_by_dir = admitted_entries.join(per_file, "filename").select(
        "ftp_dir", (F.col("copies") * F.col("_n")).alias("n"))
    summary = scan_summary(c, planned_by_dir, count_mode)
    return ScanResult(c, new_files, new_stages, new_queue, plan, summary)


# ------------------------------------------------------------------------ local sync (UPD-13)


def local_sync(files: DataFrame, stages: DataFrame, local: DataFrame, as_of, as_of_year: int,
               csv_root: str, parquet_root: str, download_root: str, artifacts: DataFrame | None = None,
               policy: P.Policy | None = None):
    """UPD-13 / AGG-31: register data files already on local storage.

    ``local`` is a listing (SRC-3) of the download root. Parsed names are upserted under
    ftp_dir 'local_policy'; canonical csv/parquet paths are checked against ``artifacts``;
    download is done, conversions done when their artifact exists; status is the best artifact.
    ``enqueued`` counts the stage jobs that the policy's plan (UPD-8) then asks for.
    Returns (files, stages, counters).
    """
    l = local.withColumn("is_data", N.has_data_extension("name")).where("is_data")
    l = N.with_parsed_name(l, "name", as_of_year, "p").withColumn("filename", F.upper("name"))
    # copies of a name: one is chosen for the row and its paths alike (newest, then path)
    ok = l.where(F.col("p.error").isNull()).groupBy("filename").agg(
        F.max_by(F.struct("p", "size", "mod_time", "remote_path"), F.struct("mod_time", "remote_path")).alias("x")).select("filename", "x.*")
    rows = ok.select(
        "filename", F.col("p.catalog").alias("catalog"), F.col("p.state").alias("state"),
        F.col("p.year").alias("year"), F.col("p.month").alias("month"), F.col("p.segment").alias("segment"),
        F.lit("local_policy").alias("ftp_dir"), F.col("remote_path").alias("ftp_path"),
        F.col("size").cast("long").alias("size_bytes"), F.lit(None).cast("string").alias("remote_checksum"),
        F.col("mod_time").cast("timestamp").alias("remote_timestamp"), F.lit(download_root).alias("root_path"),
    )
    up = upsert_files(files, rows, as_of)
    paths = ok.select(
        "filename", F.col("remote_path").alias("_dbc"),
        N.canonical_path(csv_root, "p.catalog", "p.state", "p.year", "p.month", "filename", ".csv").alias("_csv"),
        N.canonical_path(parquet_root, "p.catalog", "p.state", "p.year", "p.month", "filename", ".parquet").alias("_pq"),
    )
    flags = with_artifact_flags(
        paths.select("filename", F.col("_dbc").alias("dbc_path"), F.col("_csv").alias("csv_path"),
                     F.col("_pq").alias("parquet_path")), artifacts, key="filename")
    j = up.drop("is_new").join(flags.select(
        "filename", F.col("dbc_path").alias("_dbc"), F.col("csv_path").alias("_csv"), F.col("parquet_path").alias("_pq"),
        "csv_exists", "parquet_exists", F.lit(True).alias("_local")), "filename", "left")
    loc = F.coalesce(F.col("_local"), F.lit(False))
    ts = S.ts_lit(as_of)
    status = (F.when(F.col("parquet_exists"), F.lit("parquet_ready")).when(F.col("csv_exists"), F.lit("csv_ready"))
              .otherwise(F.lit("downloaded")))
    new_files = j.select(
        *[
            F.when(loc, F.col("_dbc")).otherwise(F.col("dbc_path")).alias("dbc_path") if c == "dbc_path" else
            F.when(loc, F.when(F.col("csv_exists"), F.col("_csv"))).otherwise(F.col("csv_path")).alias("csv_path")
            if c == "csv_path" else
            F.when(loc, F.when(F.col("parquet_exists"), F.col("_pq"))).otherwise(F.col("parquet_path")).alias("parquet_path")
            if c == "parquet_path" else
            F.when(loc, status).otherwise(F.col("overall_status")).alias("overall_status") if c == "overall_status" else
            F.when(loc, ts).otherwise(F.col("updated_at")).alias("updated_at") if c == "updated_at" else F.col(c)
            for c in S.FILES.fieldNames()
        ]
    )
    mapped = new_files.join(rows.select("filename"), "filename", "left_semi")
    st = ST.init_stages(stages, mapped.select("id"), as_of)
    done = mapped.select(
        F.col("id").alias("file_id"),
        F.array_compact(F.array(
            F.lit("download"),
            F.when(F.col("overall_status").isin("csv_ready", "parquet_ready"), F.lit("csv_conversion")),
            F.when(F.col("overall_status") == "parquet_ready", F.lit("parquet_conversion")),
        )).alias("_stages"),
    ).select("file_id", F.explode("_stages").alias("stage"))
    new_stages = ST.apply_stage_events(
        st, done.select("file_id", "stage", F.lit("completed").alias("event_type"), F.lit(None).cast("string").alias("message"),
                        ts.alias("created_at"), F.lit(0).cast("long").alias("id")))
    here = ok.select(F.col("remote_path").alias("path"))
    plan = plan_stages(mapped, new_stages, policy, here if artifacts is None else here.unionByName(artifacts.select("path")))
    good = F.col("p.error").isNull()
    counters = l.select(F.lit(1).alias("f"), good.cast("int").alias("m"), F.lit(0).alias("e")).unionByName(
        plan.select(F.lit(0).alias("f"), F.lit(0).alias("m"), F.lit(1).alias("e"))).agg(
        *(F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(n) for c, n in ((F.col("f"), "found"), (F.col("m"), "mapped"), (F.col("f") - F.col("m"), "ignored"),
                                                                         (F.col("m"), "completed"), (F.col("e"), "enqueued"))))
    return new_files, new_stages, counters
