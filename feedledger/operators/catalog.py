"""Catalog queries over the ``files`` table: filtered lists, sorts, pages, counts, sizes, facets.

Every operator is a pure DataFrame -> DataFrame function. Filters are plain comparisons on raw
columns so Catalyst can push them into the Parquet scan; aggregates are hash aggregates with a
partial (map-side) step, so a key holding a third of all rows is pre-combined in every task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas as S
from ..plans.listspec import SORTABLE, ListSpec
from . import stages as ST
from .name_index import glob_condition

FILE_COLUMNS = [f.name for f in S.FILES.fields]


# ----------------------------------------------------------------------------------- filters


def period_at_least(year: int, month: int) -> Column:
    """FLT-5 lower bound, lexicographic on (year, month)."""
    return (F.col("year") > year) | ((F.col("year") == year) & (F.col("month") >= month))


def period_at_most(year: int, month: int) -> Column:
    """FLT-5 upper bound."""
    return (F.col("year") < year) | ((F.col("year") == year) & (F.col("month") <= month))


def spec_predicates(spec: ListSpec) -> list[Column]:
    """The ANDed predicates of FLT-1..11 (the pipeline-completed filter is a join, see below)."""
    p: list[Column] = []
    if spec.catalogs:
        p.append(F.col("catalog").isin(list(spec.catalogs)))  # FLT-2: list wins over single
    elif spec.catalog:
        p.append(F.col("catalog") == spec.catalog)
    if spec.states:
        p.append(F.col("state").isin(list(spec.states)))  # FLT-3
    elif spec.state:
        p.append(F.col("state") == spec.state)
    if spec.year is not None:
        p.append(F.col("year") == spec.year)  # FLT-4
    if spec.month is not None:
        p.append(F.col("month") == spec.month)
    if spec.period_from is not None:
        p.append(period_at_least(*spec.period_from))
    if spec.period_to is not None:
        p.append(period_at_most(*spec.period_to))
    if spec.ftp_dir:
        p.append(F.col("ftp_dir") == spec.ftp_dir)  # FLT-6
    if spec.filename:
        p.append(glob_condition("filename", spec.filename))  # FLT-7
    if spec.segment is not None and spec.segment.strip():
        seg = spec.segment.strip().upper()
        if len(seg) == 1:
            p.append(F.col("segment") == seg)  # FLT-8
    if spec.has_segment is not None:
        p.append(F.col("segment").isNotNull() if spec.has_segment else F.col("segment").isNull())  # FLT-9
    statuses = [s for s in spec.statuses if s]
    if statuses:
        p.append(F.col("overall_status").isin(statuses))  # FLT-10
    elif spec.status:
        p.append(F.col("overall_status") == spec.status)
    pm = spec.policy_match.strip().lower()
    if pm in ("pending", "ignored"):
        p.append(F.col("overall_status") == pm)  # FLT-11
    return p


def filter_files(files: DataFrame, spec: ListSpec, stages: DataFrame | None = None) -> DataFrame:
    """FLT-1: all predicates of ``spec`` ANDed; FLT-12 as a semi join on completed ids."""
    out = files
    for pred in spec_predicates(spec):
        out = out.where(pred)
    if spec.pipeline_completed:
        if stages is None:
            raise ValueError("pipeline_completed needs the stages table")
        done = ST.completed_file_ids(files, stages, *spec.require)
        out = out.join(done, on="id", how="left_semi")  # FLT-12 / JOIN-7
    return out


def sort_columns(spec: ListSpec) -> list[Column]:
    """SORT-1..3 with PostgreSQL null placement, then the ``id`` tie-break."""
    asc = spec.sort_dir in ("asc", "ASC")

    def direction(c: Column) -> Column:
        return S.pg_asc(c) if asc else S.pg_desc(c)

    if spec.sort_by == "year_month":
        keys = [direction(F.col("year")), direction(F.col("month"))]  # SORT-2
    elif spec.sort_by == "overall_status":
        keys = [direction(S.enum_rank("overall_status", S.OVERALL_STATUSES))]  # SORT-3
    elif spec.sort_by in SORTABLE:
        keys = [direction(F.col(spec.sort_by))]
    else:
        keys = [direction(display_timestamp())]
    return keys + [F.col("id").asc()]


def display_timestamp() -> Column:
    """PRJ-7: remote timestamp when known, else the last time the file was seen."""
    return F.coalesce(F.col("remote_timestamp"), F.col("last_seen_at"))


def page(df: DataFrame, spec: ListSpec) -> DataFrame:
    """SORT-4: ordered page; planned as a top-k (TakeOrderedAndProject), never a full sort."""
    limit = max(1, spec.limit)
    ordered = df.orderBy(*sort_columns(spec))
    if spec.offset:
        return ordered.limit(spec.offset + limit).offset(spec.offset)
    return ordered.limit(limit)


def list_files(files: DataFrame, spec: ListSpec, stages: DataFrame | None = None) -> DataFrame:
    """FLT-1 + SORT-1..4: one page of the filtered catalog."""
    return page(filter_files(files, spec, stages), spec)


def count_files(files: DataFrame, spec: ListSpec, stages: DataFrame | None = None) -> DataFrame:
    """AGG-19: total rows for a filter, as a one-row DataFrame."""
    return filter_files(files, spec, stages).agg(F.count(F.lit(1)).alias("total"))


def get_by(files: DataFrame, column: str, value) -> DataFrame:
    """FLT-13: point lookup; an empty result means not found."""
    return files.where(F.col(column) == value)


def find_by_ids(files: DataFrame, ids: DataFrame | list[str], id_col: str = "id") -> DataFrame:
    """FLT-14: unknown ids are silently absent. Small literal lists use IN, DataFrames a semi join."""
    if isinstance(ids, list):
        return files.where(F.col("id").isin(ids))
    return files.join(ids.select(F.col(id_col).alias("id")), on="id", how="left_semi")


def find_by_pattern(files: DataFrame, glob: str) -> DataFrame:
    """FLT-15: glob lookup, ordered by filename."""
    return files.where(glob_condition("filename", glob)).orderBy("filename")


def find_by_filters(files: DataFrame, spec: ListSpec, stages: DataFrame | None = None,
                    max_rows: int | None = None) -> DataFrame:
    """FLT-16: all files that match. ``max_rows`` is for display lists: the first rows in list order
    (one top-k, no paging loop)."""
    out = filter_files(files, spec, stages)
    return out if max_rows is None else out.orderBy(*sort_columns(spec)).limit(max_rows)


def failed_since(files: DataFrame, stages: DataFrame, since, stage: str,
                 max_rows: int | None = None) -> DataFrame:
    """JOIN-1: all files whose ``stage`` failed at or after ``since``. ``max_rows`` is for display
    lists: the newest failures, ties broken by file id."""
    failed = stages.where(
        (F.col("status") == "failed") & (F.col("stage") == stage) & (F.col("updated_at") >= S.ts_lit(since))
    ).select("file_id", F.col("updated_at").alias("failed_at"))
    joined = files.join(failed, files["id"] == failed["file_id"], "inner").drop("file_id")
    return joined if max_rows is None else joined.orderBy(S.pg_desc("failed_at"), F.col("id").asc()).limit(max_rows)


# ------------------------------------------------------------------------------ aggregations


def status_counts(files: DataFrame) -> DataFrame:
    """AGG-1: file count per overall status."""
    return files.groupBy("overall_status").agg(F.count(F.lit(1)).alias("count"))


def size_by(files: DataFrame, key: str, size: str = "size_bytes") -> DataFrame:
    """AGG-2/AGG-3: count, total and rounded mean size per normalised key.

    Order: total desc, count desc, key asc. The mean is sum/count of the non-null sizes, rounded
    half away from zero (PostgreSQL ``numeric::bigint``); the sum stays exact as a long.
    """
    total = F.sum(size)
    mean = F.try_divide(total.cast("double"), F.count(size))
    out = files.groupBy(S.norm_code(key).alias("key")).agg(
        F.count(F.lit(1)).alias("count"),
        F.coalesce(total, F.lit(0)).cast("long").alias("total_size_bytes"),
        S.pg_bigint(F.coalesce(mean, F.lit(0.0))).alias("avg_size_bytes"),
    )
    return out.orderBy(F.col("total_size_bytes").desc(), F.col("count").desc(), F.col("key").asc())


def size_by_state(files: DataFrame) -> DataFrame:
    return size_by(files, "state")


def size_by_catalog(files: DataFrame) -> DataFrame:
    return size_by(files, "catalog")


def count_by(files: DataFrame, column: str) -> DataFrame:
    """AGG-4: count per normalised catalog or state (only these two are accepted)."""
    if column not in ("catalog", "state"):
        raise ValueError(f"unsupported count column: {column}")
    return (
        files.groupBy(S.norm_code(column).alias("key"))
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy(F.col("count").desc(), F.col("key").asc())
    )


def counts_raw(files: DataFrame, column: str) -> DataFrame:
    """AGG-5: count per raw column value."""
    return (
        files.groupBy(F.col(column).alias("key"))
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy(F.col("count").desc(), F.col("key").asc())
    )


def distinct_codes(files: DataFrame, column: str, lower: bool = False) -> DataFrame:
    """AGG-17 part: distinct non-blank normalised values (FLT-19), ascending."""
    c = F.col(column)
    norm = F.lower(F.trim(c)) if lower else S.norm_code(c)
    return files.where(c.isNotNull() & (F.trim(c) != "")).select(norm.alias("value")).distinct().orderBy("value")


def available_periods(files: DataFrame) -> DataFrame:
    """AGG-18 / AGG-17 part: distinct valid (year, month), newest first (FLT-20)."""
    return (
        files.where(F.col("month").between(1, 12))
        .select("year", "month")
        .distinct()
        .orderBy(F.col("year").desc(), F.col("month").desc())
    )


def available_years(files: DataFrame) -> DataFrame:
    """AGG-18 part: distinct years with valid months, newest first."""
    return (
        files.where(F.col("month").between(1, 12) & (F.col("year") >= 0))
        .select("year").distinct().orderBy(F.col("year").desc())
    )


def facets(files: DataFrame) -> DataFrame:
    """AGG-17: all facets as (facet, value) rows from one scan: each row is unpivoted into its four
    facet values (invalid or blank ones as NULL), then one distinct (partial aggregate) over them."""

    def nonblank(c: str) -> Column:
        return F.col(c).isNotNull() & (F.trim(F.col(c)) != "")

    pairs = F.array(
        F.struct(F.lit("catalog").alias("facet"), F.when(nonblank("catalog"), S.norm_code("catalog")).alias("value")),
        F.struct(F.lit("state").alias("facet"), F.when(nonblank("state"), S.norm_code("state")).alias("value")),
        F.struct(F.lit("status").alias("facet"),
                 F.when(nonblank("overall_status"), F.lower(F.trim("overall_status"))).alias("value")),
        F.struct(F.lit("period").alias("facet"),
                 F.when(F.col("month").between(1, 12), F.format_string("%04d-%02d", "year", "month")).alias("value")),
    )
    return (files.select(F.inline(pairs)).where(F.col("value").isNotNull()).distinct()
            .orderBy("facet", "value"))
