"""Reports that are kept up to date by signed deltas instead of being recomputed (AGG-1..6, AGG-17).

All of them are sums over *cells*: one row per status, catalog, state and period with the number of
files, of known sizes, and the sizes' sum. A change of the catalog is a signed delta -- every changed
file takes its old row out of one cell and puts its new row into another -- and deltas fold into the
stored cells by addition. A value is present as long as a cell with a file holds it, which gives the
distinct values. The reports over cells give what the operators in ``catalog`` and ``policy`` give
over files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas as S
from . import catalog as C

KEYS = ["overall_status", "catalog", "state", "year", "month"]
FIGURES = ["files", "sized", "bytes"]
CELLS = T.StructType([*(S.FILES[k] for k in KEYS), *(T.StructField(f, T.LongType()) for f in FIGURES)])


def _added(rows: DataFrame, more: list[str]) -> DataFrame:
    return rows.groupBy(*KEYS, *more).agg(*(F.sum(f).cast("long").alias(f) for f in FIGURES))


def _rows(files: DataFrame, more: list[str], sign: int) -> DataFrame:
    size = F.col("size_bytes")
    return files.select(*KEYS, *more, F.lit(sign).cast("long").alias("files"), F.when(size.isNotNull(), sign).otherwise(0).cast("long").alias("sized"),
                        (F.coalesce(size, F.lit(0)) * sign).cast("long").alias("bytes"))


def cells(files: DataFrame, more: list[str] | None = None) -> DataFrame:
    """The cells of a whole table (``more``: further columns to keep apart)."""
    return _added(_rows(files, more or [], 1), more or [])


def signed_delta(old: DataFrame, new: DataFrame, more: list[str] | None = None) -> DataFrame:
    """What a change from ``old`` to ``new`` rows does to the cells. Rows that are in both cancel out
    before the shuffle, in every task that reads them, or after it."""
    change = _added(_rows(old, more or [], -1).unionByName(_rows(new, more or [], 1)), more or [])
    return change.where(" OR ".join(f"{f} <> 0" for f in FIGURES))


def folded(stored: DataFrame, delta: DataFrame, more: list[str] | None = None) -> DataFrame:
    """The stored cells after a delta; a cell without files goes."""
    columns = [*KEYS, *(more or []), *FIGURES]
    return _added(stored.select(*columns).unionByName(delta.select(*columns)), more or []).where("files <> 0")


# ----------------------------------------------------------------------------------- the reports


def status_counts(cells: DataFrame) -> DataFrame:
    """AGG-1."""
    return cells.groupBy("overall_status").agg(F.sum("files").alias("count"))


def size_by(cells: DataFrame, key: str) -> DataFrame:
    """AGG-2 / AGG-3."""
    mean = F.try_divide(F.sum("bytes").cast("double"), F.sum("sized"))
    out = cells.groupBy(S.norm_code(key).alias("key")).agg(F.sum("files").alias("count"), F.sum("bytes").alias("total_size_bytes"),
                                                           S.pg_bigint(F.coalesce(mean, F.lit(0.0))).alias("avg_size_bytes"))
    return out.orderBy(F.col("total_size_bytes").desc(), F.col("count").desc(), F.col("key").asc())


def count_by(cells: DataFrame, column: str) -> DataFrame:
    """AGG-4."""
    return cells.groupBy(S.norm_code(column).alias("key")).agg(F.sum("files").alias("count")).orderBy(F.col("count").desc(), F.col("key").asc())


def counts_raw(cells: DataFrame, column: str) -> DataFrame:
    """AGG-5."""
    return cells.groupBy(F.col(column).alias("key")).agg(F.sum("files").alias("count")).orderBy(F.col("count").desc(), F.col("key").asc())


def pending_and_ignored_counts(cells: DataFrame) -> DataFrame:
    """AGG-6."""
    held = lambda status: F.coalesce(F.sum(F.when(F.col("overall_status") == status, F.col("files"))), F.lit(0)).cast("long").alias(status)
    return cells.agg(held("pending"), held("ignored"))


def facets(cells: DataFrame) -> DataFrame:
    """AGG-17: the distinct values of the cells that hold a file."""
    return C.facets(cells.where("files > 0"))
