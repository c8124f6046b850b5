"""Audits: status-transition validity over a status history (WIN-7), the skew-safe ordered
"previous row" operator it rests on, and the two-dataset equivalence check (AGG-30).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas as S
from ..session import ensure_checkpoint_dir, ship_package

#: Buckets that two datasets are compared by; a bucket that differs is compared row by row.
COMPARE_BUCKETS = 4096
_PREVIOUS = "_previous_"


def _carry(batches: Iterator[pa.RecordBatch], keys: list[str], values: list[str], names: list[str]) -> Iterator[pa.RecordBatch]:
    """Each row with the values of the row before it in the partition (null: another key), the
    partition, and whether it is the partition's first or last row."""
    from pyspark import TaskContext

    pid, before, held = TaskContext.get().partitionId(), None, None

    def shifted(b: pa.RecordBatch, name: str) -> pa.Array:
        own = b.column(names.index(name))
        head = pa.nulls(1, own.type) if before is None else before.column(names.index(name)).slice(before.num_rows - 1)
        return pa.concat_arrays([head, own.slice(0, len(own) - 1)])

    def done(b: pa.RecordBatch, first: bool, last: bool) -> pa.RecordBatch:
        same = pa.array([True] * b.num_rows)
        for k in keys:
            mine, other = b.column(names.index(k)), shifted(b, k)
            equal = pc.fill_null(pc.equal(mine, other), False)
            if pa.types.is_floating(mine.type):
                equal = pc.or_(equal, pc.fill_null(pc.and_(pc.is_nan(mine), pc.is_nan(other)), False))
            same = pc.and_(same, pc.or_(equal, pc.and_(pc.is_null(mine), pc.is_null(other))))
        if first:
            same = pa.concat_arrays([pa.array([False]), same.slice(1)])
        mark = np.arange(b.num_rows)
        moved = []
        for v in values:
            other = shifted(b, v)
            moved.append(pc.if_else(same, other, pa.nulls(len(other), other.type)))
        return pa.RecordBatch.from_arrays([*b.columns, *moved, pa.array(np.full(b.num_rows, pid, np.int32)), pa.array((mark == 0) & first),
                                           pa.array((mark == b.num_rows - 1) & last)], [*names, *(f"{_PREVIOUS}{v}" for v in values), "_pid", "_first", "_last"])

    first = True
    for b in batches:
        if b.num_rows == 0:
            continue
        if held is not None:
            yield done(held, first, False)
            before, first = held, False
        held = b
    if held is not None:
        yield done(held, first, True)


def ordered_previous(df: DataFrame, keys: list[str], order: list[str], values: list[str],
                     partitions: int | None = None, prefix: str = "prev_") -> DataFrame:
    """``lag(values) OVER (PARTITION BY keys ORDER BY order)`` without a per-key window.

    A per-key window puts every row of a key into one task, so a key holding a third of all
    rows would run in a single task. Instead:

    1. range-partition on (keys, order) -- the sampled bounds split a hot key across tasks --
       and sort within partitions: the only shuffle of the rows;
    2. each partition is streamed once, Arrow batch by batch, and every row takes the values of the
       row before it, if that has the same keys (nulls are equal); the result is checkpointed to the
       cluster's checkpoint folder (reliable), which freezes the partitions and cuts lineage;
    3. only a partition's first row is still open: the last row of the nearest partition before it
       that has rows, one row per partition (broadcast, at most ``partitions`` rows), settles it.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    sort_cols, names = [*keys, *order], df.columns
    ranged = df.repartitionByRange(n, *sort_cols).sortWithinPartitions(*sort_cols)
    schema = T.StructType([*df.schema.fields, *(T.StructField(f"{_PREVIOUS}{v}", df.schema[v].dataType) for v in values)])
    schema = schema.add("_pid", "integer").add("_first", "boolean").add("_last", "boolean")
    carried = ranged.mapInArrow(lambda batches: _carry(batches, keys, values, names), schema).checkpoint(eager=True)
    nearest = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    ends = carried.where("_last").select("_pid", F.struct(*[F.col(k).alias(f"k{i}") for i, k in enumerate(keys)], *[F.col(v).alias(f"v{i}") for i, v in enumerate(values)]).alias("_e"))
    boundary = ends.select(F.col("_pid").alias("_bp"), F.last("_e").over(nearest).alias("_end"))
    out = carried.join(F.broadcast(boundary), F.col("_first") & (F.col("_pid") == F.col("_bp")), "left")
    same = F.col("_end").isNotNull()
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_end.k{i}"))
    settled = [F.when(F.col("_first"), F.when(same, F.col(f"_end.v{i}"))).otherwise(F.col(f"{_PREVIOUS}{v}")).alias(f"{prefix}{v}") for i, v in enumerate(values)]
    return out.select(*names, *settled)


def transition_table(spark) -> DataFrame:
    """The allowed (from, to) pairs, a bounded dimension (under 50 rows)."""
    rows = [(a, b) for a, tos in S.ALLOWED_TRANSITIONS.items() for b in tos]
    return spark.createDataFrame(rows, "from_status string, to_status string")


def transition_audit(history: DataFrame, key: str = "file_id", status: str = "status",
                     order: tuple[str, ...] = ("changed_at", "seq"), partitions: int | None = None) -> DataFrame:
    """WIN-7 (re-aimed): each status change with the previous status of the same file and whether
    the move is allowed. The first change of a file has no previous status and is valid."""
    h = ordered_previous(history, [key], list(order), [status], partitions)
    pairs = F.broadcast(transition_table(history.sparkSession).withColumn("_ok", F.lit(True)))
    j = h.join(pairs, (F.col(f"prev_{status}") == F.col("from_status")) & (F.col(status) == F.col("to_status")), "left")
    valid = F.when(F.col(f"prev_{status}").isNull(), F.lit(True)).otherwise(F.coalesce(F.col("_ok"), F.lit(False)))
    return j.withColumn("valid", valid).drop("from_status", "to_status", "_ok")


def invalid_transition_counts(audit: DataFrame, status: str = "status") -> DataFrame:
    """Counts of invalid moves per (from, to)."""
    return (audit.where(~F.col("valid")).groupBy(F.col(f"prev_{status}").alias("from_status"), F.col(status).alias("to_status"))
            .agg(F.count(F.lit(1)).alias("count")))


def _hash_pair(columns: list[str]) -> list[Column]:
    """A 128-bit hash in two halves. A null is told apart from a value and from the next column."""
    parts = [x for c in columns for x in (F.col(c), F.col(c).isNull())]
    return [F.xxhash64(*parts), F.xxhash64(F.lit(1), *parts)]


def row_hashes(df: DataFrame, columns: list[str], buckets: int = COMPARE_BUCKETS) -> DataFrame:
    """_b (hash bucket), _h, _g (128-bit row hash) of every row."""
    h, g = _hash_pair(columns)
    return df.select(h.alias("_h"), g.alias("_g")).select(F.pmod("_h", F.lit(buckets)).cast("int").alias("_b"), "_h", "_g")


def fingerprints(hashed: DataFrame) -> DataFrame:
    """Per bucket the number of rows, and the sum and the exclusive or of their hashes: equal for equal
    rows in any order, with any repeats."""
    half = lambda c, shift: F.sum(F.shiftrightunsigned(c, shift).bitwiseAND(F.lit(0xFFFFFFFF)))
    return hashed.groupBy("_b").agg(F.count(F.lit(1)).alias("n"), F.struct(
        *(half(c, shift).alias(f"s{c}{shift}") for c in ("_h", "_g") for shift in (0, 32)), F.bit_xor("_h").alias("x"), F.bit_xor("_g").alias("y")).alias("f"))


def unequal_buckets(a: DataFrame, b: DataFrame) -> DataFrame:
    """_b, rows_a, rows_b, equal of every bucket of two ``row_hashes`` frames."""
    x, y = fingerprints(a).alias("x"), fingerprints(b).alias("y")
    zero = F.lit(0).cast("long")
    return x.join(y, F.col("x._b") == F.col("y._b"), "full_outer").select(
        F.coalesce("x._b", "y._b").alias("_b"), F.coalesce("x.n", zero).alias("rows_a"), F.coalesce("y.n", zero).alias("rows_b"),
        F.coalesce((F.col("x.n") == F.col("y.n")) & (F.col("x.f") == F.col("y.f")), F.lit(False)).alias("equal"))


def distinct_values(sides: dict[str, DataFrame], columns: list[str]) -> DataFrame:
    """column, then per side the number of its distinct non-null values, from (column, 128-bit value
    hash) pairs: each value of a column is reduced in every task before the shuffle."""
    def pairs(df: DataFrame, side: str) -> DataFrame:
        each = []
        for i, c in enumerate(columns):
            h, g = _hash_pair([c])
            each.append(F.when(F.col(c).isNotNull(), F.struct(F.lit(i).alias("i"), h.alias("h"), g.alias("g"))))
        seen = (F.lit(s == side).cast("long").alias(f"in_{s}") for s in sides)
        return df.select(F.explode(F.array_compact(F.array(*each))).alias("p")).select("p.*", *seen)

    united = None
    for side, df in sides.items():
        united = pairs(df, side) if united is None else united.unionByName(pairs(df, side))
    values = united.groupBy("i", "h", "g").agg(*(F.max(f"in_{s}").alias(s) for s in sides))
    return values.groupBy("i").agg(*(F.sum(s).alias(s) for s in sides))


def compare_datasets(a: DataFrame, b: DataFrame, buckets: int = COMPARE_BUCKETS) -> DataFrame:
    """AGG-30 (re-aimed): row counts, rows only in a / only in b (multiset difference) and
    per-column distinct counts of both, as one summary row per column.

    Both sides are reduced to ``buckets`` order-free fingerprints of 128-bit row hashes. Equal
    datasets are told by them alone, and then have equal distinct counts. Otherwise only the rows of
    unequal buckets are shuffled, as hashes, and counted one by one; a bucket that a frequent row fills
    costs one row per task, as copies are added up first. No row reaches the driver.
    """
    spark, cols = a.sparkSession, a.columns
    ha, hb = row_hashes(a, cols, buckets), row_hashes(b, cols, buckets)
    told = unequal_buckets(ha, hb).collect()  # at most ``buckets`` rows
    rows_a, rows_b = sum(r["rows_a"] for r in told), sum(r["rows_b"] for r in told)
    differ = [r["_b"] for r in told if not r["equal"]]
    only_a, only_b = F.lit(0).cast("long"), F.lit(0).cast("long")
    counts = distinct_values({"a": a} | ({"b": b} if differ else {}), cols)
    columns = spark.createDataFrame(list(enumerate(cols)), "i int, column string")
    if differ:
        some = F.col("_b").isin(differ)
        zero = F.lit(0).cast("long")
        united = ha.where(some).select("_h", "_g", F.lit(1).cast("long").alias("d")).unionByName(hb.where(some).select("_h", "_g", F.lit(-1).cast("long").alias("d")))
        both = united.groupBy("_h", "_g").agg(F.sum("d").alias("d")).agg(
            F.coalesce(F.sum(F.greatest("d", zero)), zero).alias("only_in_a"), F.coalesce(F.sum(F.greatest(-F.col("d"), zero)), zero).alias("only_in_b"))
        only_a, only_b = (F.lit(n).cast("long") for n in both.first())  # one row
    found = columns.join(counts, "i", "left")
    distinct = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long")
    return found.select("column", F.lit(rows_a).cast("long").alias("rows_a"), F.lit(rows_b).cast("long").alias("rows_b"), only_a.alias("only_in_a"), only_b.alias("only_in_b"),
                        distinct("a").alias("distinct_a"), distinct("b" if differ else "a").alias("distinct_b"))
