"""Admission policy: catalogs x states x (years or (year, month)) plus processing toggles.

The four selection sets are dimension tables whose size is bounded by their domain: at most
676 two-letter catalogs, 27 states, 10,000 years and 120,000 (year, month) pairs. They are
reduced to that domain and de-duplicated before being broadcast, so the broadcast size is
bounded no matter how large ``files`` is, and the admission test is four broadcast hash joins
(map-side, no shuffle of ``files``).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas as S
from . import stages as ST

# Domain bounds used to prove the broadcast size.
MAX_YEAR = 9999
MAX_POLICY_MONTH_ROWS = (MAX_YEAR + 1) * 12


@dataclass
class Policy:
    catalogs: DataFrame  # catalog
    states: DataFrame  # state
    years: DataFrame  # year
    months: DataFrame  # year, month
    config: DataFrame | None = None  # one row: enable_download, enable_csv, enable_parquet, *_dir

    @classmethod
    def from_tables(cls, t) -> "Policy":
        return cls(t.policy_catalogs, t.policy_states, t.policy_years, t.policy_months, t.policy_config)

    @classmethod
    def from_lists(cls, spark: SparkSession, catalogs=(), states=(), years=(), months=(),
                   enable_download=True, enable_csv=True, enable_parquet=True,
                   download_dir=None, csv_dir=None, parquet_dir=None) -> "Policy":
        return cls(
            spark.createDataFrame([(c,) for c in catalogs], "catalog string"),
            spark.createDataFrame([(s,) for s in states], "state string"),
            spark.createDataFrame([(int(y),) for y in years], "year int"),
            spark.createDataFrame([(int(y), int(m)) for y, m in months], "year int, month int"),
            spark.createDataFrame(
                [(1, enable_download, enable_csv, enable_parquet, download_dir, csv_dir, parquet_dir)],
                "id int, enable_download boolean, enable_csv boolean, enable_parquet boolean, "
                "download_dir string, csv_dir string, parquet_dir string",
            ),
        )

    # The stored rows as they are, normalised like the files' codes and de-duplicated.
    def catalog_set(self) -> DataFrame:
        return self.catalogs.select(S.norm_code("catalog").alias("_p_catalog")).distinct()

    def state_set(self) -> DataFrame:
        return self.states.select(S.norm_code("state").alias("_p_state")).distinct()

    def year_set(self) -> DataFrame:
        return self.years.select(F.col("year").cast("int").alias("_p_year")).distinct()

    def month_set(self) -> DataFrame:
        return self.months.select(F.col("year").cast("int").alias("_p_myear"), F.col("month").cast("int").alias("_p_month")).distinct()


def _flag(df: DataFrame, dim: DataFrame, cond, flag: str) -> DataFrame:
    """Left join to a distinct dimension and keep only a hit flag (an existence join). The optimizer
    broadcasts the set while its size is below the threshold and shuffles beyond it."""
    hit = dim.withColumn(flag, F.lit(True))
    out = df.join(hit, cond(df, hit), "left")
    return out.drop(*[c for c in dim.columns])


def with_policy_flags(files: DataFrame, policy: Policy, catalog: str = "catalog", state: str = "state",
                      year: str = "year", month: str = "month") -> DataFrame:
    """JOIN-3: add ``allowed`` (never NULL) plus the four per-set hit flags.

    allowed = catalog selected AND state selected AND (year selected OR (year, month) selected).
    Any empty set denies everything, as in the pipeline.
    """
    df = files.withColumn("_n_catalog", S.norm_code(catalog)).withColumn("_n_state", S.norm_code(state))
    df = _flag(df, policy.catalog_set(), lambda a, b: a["_n_catalog"] == b["_p_catalog"], "catalog_hit")
    df = _flag(df, policy.state_set(), lambda a, b: a["_n_state"] == b["_p_state"], "state_hit")
    df = _flag(df, policy.year_set(), lambda a, b: a[year] == b["_p_year"], "year_hit")
    df = _flag(df, policy.month_set(), lambda a, b: (a[year] == b["_p_myear"]) & (a[month] == b["_p_month"]), "month_hit")
    c, s, y, m = (F.coalesce(F.col(x), F.lit(False)) for x in ("catalog_hit", "state_hit", "year_hit", "month_hit"))
    return (
        df.withColumn("allowed", c & s & (y | m))
        .drop("_n_catalog", "_n_state")
        .withColumn("catalog_hit", c).withColumn("state_hit", s).withColumn("year_hit", y).withColumn("month_hit", m)
    )


def policy_allows(files: DataFrame, policy: Policy, **cols) -> DataFrame:
    """JOIN-3/JOIN-4: ``files`` plus the ``allowed`` column (row form and set form are the same operator)."""
    return with_policy_flags(files, policy, **cols).drop("catalog_hit", "state_hit", "year_hit", "month_hit")


def admitted(files: DataFrame, policy: Policy) -> DataFrame:
    return policy_allows(files, policy).where(F.col("allowed")).drop("allowed")


def denied(files: DataFrame, policy: Policy) -> DataFrame:
    """JOIN-5: rows the policy does not admit."""
    return policy_allows(files, policy).where(~F.col("allowed")).drop("allowed")


def selection_summary(policy: Policy) -> DataFrame:
    """AGG-20: selected catalog, state and period row counts plus the completeness flag."""
    tagged = (policy.catalogs.select(F.lit("c").alias("_k"))
              .unionByName(policy.states.select(F.lit("s").alias("_k")))
              .unionByName(policy.years.select(F.lit("p").alias("_k")))
              .unionByName(policy.months.select(F.lit("p").alias("_k"))))
    out = tagged.agg(  # one aggregate over the four sets, no join
        F.count_if(F.col("_k") == "c").alias("catalog_count"),
        F.count_if(F.col("_k") == "s").alias("state_count"),
        F.count_if(F.col("_k") == "p").alias("period_count"),
    )
    return out.withColumn(
        "complete", (F.col("catalog_count") > 0) & (F.col("state_count") > 0) & (F.col("period_count") > 0)
    )


def processing(policy: Policy) -> DataFrame:
    """JOIN-13 source: the one-row config (toggles default to on when the config is missing)."""
    if policy.config is None:
        raise ValueError("policy has no config")
    return policy.config.select(
        F.coalesce("enable_download", F.lit(True)).alias("enable_download"),
        F.coalesce("enable_csv", F.lit(True)).alias("enable_csv"),
        F.coalesce("enable_parquet", F.lit(True)).alias("enable_parquet"),
        "download_dir", "csv_dir", "parquet_dir",
    ).limit(1)


def with_config(df: DataFrame, policy: Policy) -> DataFrame:
    """JOIN-13: attach the one-row config to every row. The single row is read once on the
    driver and added as literals, so the optimizer can fold the toggles into every predicate."""
    row = processing(policy).first()
    cfg = row.asDict() if row is not None else {
        "enable_download": True, "enable_csv": True, "enable_parquet": True,
        "download_dir": None, "csv_dir": None, "parquet_dir": None}
    out = df
    for k in ("enable_download", "enable_csv", "enable_parquet"):
        out = out.withColumn(k, F.lit(bool(cfg[k])))
    for k in ("download_dir", "csv_dir", "parquet_dir"):
        out = out.withColumn(k, F.lit(cfg[k]).cast("string"))
    return out


def resolve_directory(configured: str | Column, fallback: str | Column) -> Column:
    """PRJ-4: configured directory when non-blank, else the fallback."""
    c = S.col_of(configured)
    fb = fallback if isinstance(fallback, Column) else F.lit(fallback)
    return F.coalesce(F.when(F.trim(c) != "", c), fb)


# ----------------------------------------------------------------------- counts and reconcile


def pending_and_ignored_counts(files: DataFrame) -> DataFrame:
    """AGG-6."""
    st = F.col("overall_status")
    return files.agg(F.count_if(st == "pending").alias("pending"), F.count_if(st == "ignored").alias("ignored"))


def reconcile_flags(files: DataFrame, policy: Policy) -> DataFrame:
    st = F.col("overall_status")
    flagged = policy_allows(files, policy)
    return flagged.withColumn(
        "to_ignored", st.isin(S.RECONCILE_TO_IGNORED) & ~F.col("allowed")
    ).withColumn("to_pending", (st == "ignored") & F.col("allowed"))


def reconcile_statuses(files: DataFrame, policy: Policy, as_of) -> DataFrame:
    """UPD-1: the next ``files`` table. Denied {pending, downloaded, csv_ready} -> ignored;
    admitted ignored -> pending. The two conditions are disjoint, so one pass suffices."""
    f = reconcile_flags(files, policy)
    moved = F.col("to_ignored") | F.col("to_pending")
    out = f.withColumn(
        "overall_status",
        F.when(F.col("to_ignored"), F.lit("ignored")).when(F.col("to_pending"), F.lit("pending"))
        .otherwise(F.col("overall_status")),
    ).withColumn("updated_at", F.when(moved, S.ts_lit(as_of).cast(files.schema["updated_at"].dataType))
                 .otherwise(F.col("updated_at")))
    return out.drop("allowed", "to_ignored", "to_pending")


def reconcile_counts(files: DataFrame, policy: Policy) -> DataFrame:
    """UPD-1 counts: how many rows move each way."""
    f = reconcile_flags(files, policy)
    return f.agg(F.count_if("to_ignored").alias("to_ignored"), F.count_if("to_pending").alias("to_pending"))


# ------------------------------------------------------------------ available sets (SET-1/2)


def _available(spark: SparkSession, from_files: DataFrame, from_policy: DataFrame, known: list[str]) -> DataFrame:
    known_df = spark.createDataFrame([(k,) for k in known], "value string")
    return (
        from_files.unionByName(from_policy).unionByName(known_df)
        .where(F.col("value").isNotNull() & (F.trim("value") != ""))
        .distinct()
        .orderBy("value")
    )


def available_catalogs(files: DataFrame, policy: Policy) -> DataFrame:
    """SET-1: catalogs in files UNION selected UNION the 12 known ones."""
    spark = files.sparkSession
    return _available(spark, files.select(S.norm_code("catalog").alias("value")),
                      policy.catalogs.select(S.norm_code("catalog").alias("value")), S.KNOWN_CATALOGS)


def available_states(files: DataFrame, policy: Policy) -> DataFrame:
    """SET-2: states in files UNION selected UNION the 27 known ones."""
    spark = files.sparkSession
    return _available(spark, files.select(S.norm_code("state").alias("value")),
                      policy.states.select(S.norm_code("state").alias("value")), S.KNOWN_STATES)


def known_codes_not_seen(files: DataFrame, column: str, known: list[str]) -> DataFrame:
    """JOIN-17: known codes that do not occur in ``files``."""
    spark = files.sparkSession
    k = spark.createDataFrame([(c,) for c in known], "value string")
    seen = files.select(S.norm_code(column).alias("value")).distinct()
    return k.join(seen, "value", "left_anti")


# --------------------------------------------------------------- validation and replacement


def available_years(files: DataFrame) -> DataFrame:
    return files.where((F.col("year") >= 0) & F.col("month").between(1, 12)).select("year").distinct()


def validate_policy(files: DataFrame, proposed: Policy) -> tuple[DataFrame, Policy]:
    """SET-10: (rejects, accepted). Rejects carry level, value and reason; accepted sets are
    normalised and de-duplicated. Years and month-years must occur among the files' periods."""
    years_seen = available_years(files).withColumn("_seen", F.lit(True))

    cat = proposed.catalogs.select(F.col("catalog").alias("raw"), S.norm_code("catalog").alias("v"))
    cat_bad = cat.where(F.length("v") != 2).select(
        F.lit("catalog").alias("level"), F.col("raw").cast("string").alias("value"), F.lit("invalid catalog").alias("reason"))
    st = proposed.states.select(F.col("state").alias("raw"), S.norm_code("state").alias("v"))
    st_bad = st.where((F.length("v") != 2) | ~F.col("v").isin(S.KNOWN_STATES)).select(
        F.lit("state").alias("level"), F.col("raw").cast("string").alias("value"), F.lit("invalid state").alias("reason"))

    yr = proposed.years.select(F.col("year").cast("int").alias("year")).join(years_seen, "year", "left")
    yr_reason = (F.when(~F.col("year").between(0, MAX_YEAR), F.lit("invalid year"))
                 .when(F.col("_seen").isNull(), F.lit("year not in periods discovered from stored files")))
    yr_bad = yr.where(yr_reason.isNotNull()).select(
        F.lit("year").alias("level"), F.col("year").cast("string").alias("value"), yr_reason.alias("reason"))

    mo = proposed.months.select(F.col("year").cast("int").alias("year"), F.col("month").cast("int").alias("month")).join(
        years_seen, "year", "left")
    mo_reason = (F.when(~F.col("year").between(0, MAX_YEAR), F.lit("invalid year"))
                 .when(~F.col("month").between(1, 12), F.lit("invalid month"))
                 .when(F.col("_seen").isNull(), F.lit("month year not in periods discovered from stored files")))
    mo_bad = mo.where(mo_reason.isNotNull()).select(
        F.lit("month").alias("level"), F.format_string("%d-%02d", "year", "month").alias("value"), mo_reason.alias("reason"))

    rejects = cat_bad.unionByName(st_bad).unionByName(yr_bad).unionByName(mo_bad)
    accepted = Policy(
        cat.where(F.length("v") == 2).select(F.col("v").alias("catalog")).distinct(),
        st.where((F.length("v") == 2) & F.col("v").isin(S.KNOWN_STATES)).select(F.col("v").alias("state")).distinct(),
        yr.where(yr_reason.isNull()).select("year").distinct(),
        mo.where(mo_reason.isNull()).select("year", "month").distinct(),
        proposed.config,
    )
    return rejects, accepted


def seed_from_legacy(catalog_policy: DataFrame, active_periods: DataFrame, current: Policy) -> Policy:
    """SNK-7: seed the global sets from the per-catalog legacy tables, keeping existing rows."""
    enabled = catalog_policy.where(F.col("download_enabled")).select("catalog").distinct()
    months = (active_periods.join(enabled, "catalog", "inner").select("year", "month").distinct())
    new_c = enabled.join(current.catalogs.select("catalog"), "catalog", "left_anti")
    new_m = months.join(current.months.select("year", "month"), ["year", "month"], "left_anti")
    return Policy(current.catalogs.select("catalog").unionByName(new_c), current.states,
                  current.years, current.months.select("year", "month").unionByName(new_m), current.config)


# --------------------------------------------------------------------- enqueue by policy (UPD-2)


def enqueue_pending_by_policy(files: DataFrame, stages: DataFrame, queue: DataFrame, policy: Policy, as_of):
    """UPD-2: for admitted pending files add missing stage rows (JOIN-10), reset their download
    stage (JOIN-12) and upsert a pending download job (JOIN-11). The stage toggles are not read,
    as in the pipeline. Returns (stages, queue, enqueued_count DataFrame)."""
    from . import jobs as J

    eligible = admitted(files.where(F.col("overall_status") == "pending"), policy).select("id")
    with_rows = ST.init_stages(stages, eligible, as_of)
    reset = reset_stage(with_rows, eligible.select(F.col("id").alias("file_id"), F.lit("download").alias("stage")), as_of)
    requests = eligible.select(F.col("id").alias("file_id"), F.lit("download").alias("stage"))
    new_queue, counts = J.upsert_queue(queue, requests, as_of)
    return reset, new_queue, counts


def reset_stage(stages: DataFrame, targets: DataFrame, as_of) -> DataFrame:
    """JOIN-12 / ResetForRetry: (file_id, stage) targets go back to pending with times and error cleared."""
    hit = targets.select("file_id", "stage").distinct().withColumn("_hit", F.lit(True))
    j = ST.conform_stages(stages).join(hit, ["file_id", "stage"], "left")
    h = F.coalesce(F.col("_hit"), F.lit(False))
    ts = S.ts_lit(as_of)
    return j.select(
        "file_id", "stage",
        F.when(h, F.lit("pending")).otherwise(F.col("status")).alias("status"),
        "attempts",
        F.when(h, F.lit(None).cast("timestamp")).otherwise(F.col("started_at")).alias("started_at"),
        F.when(h, F.lit(None).cast("timestamp")).otherwise(F.col("finished_at")).alias("finished_at"),
        F.when(h, F.lit(None).cast("string")).otherwise(F.col("error_message")).alias("error_message"),
        F.when(h, ts).otherwise(F.col("updated_at")).alias("updated_at"),
    )


def policy_overview(files: DataFrame, policy: Policy) -> DataFrame:
    """SET-11: the whole policy as (section, value) rows: available and selected catalogs and
    states, available and selected periods, toggles and directories."""
    spark = files.sparkSession
    periods = files.where((F.col("year") >= 0) & F.col("month").between(1, 12)).select("year", "month").distinct()
    parts = [
        available_catalogs(files, policy).select(F.lit("available_catalog").alias("section"), "value"),
        available_states(files, policy).select(F.lit("available_state").alias("section"), "value"),
        periods.select(F.lit("available_period").alias("section"), F.format_string("%04d-%02d", "year", "month").alias("value")),
        policy.catalog_set().select(F.lit("selected_catalog").alias("section"), F.col("_p_catalog").alias("value")),
        policy.state_set().select(F.lit("selected_state").alias("section"), F.col("_p_state").alias("value")),
        policy.year_set().select(F.lit("selected_year").alias("section"), F.col("_p_year").cast("string").alias("value")),
        policy.month_set().select(F.lit("selected_month").alias("section"),
                                  F.format_string("%04d-%02d", "_p_myear", "_p_month").alias("value")),
    ]
    if policy.config is not None:
        cfg = processing(policy)
        parts.append(cfg.select(F.lit("processing").alias("section"), F.to_json(F.struct(
            "enable_download", "enable_csv", "enable_parquet", "download_dir", "csv_dir", "parquet_dir")).alias("value")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
