"""Inline relations (SRC-7) and array-parameter relations (SRC-8)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def values_relation(spark: SparkSession, rows: list, schema: str) -> DataFrame:
    """SRC-7: a small VALUES relation."""
    return spark.createDataFrame(rows, schema)


def array_relation(df: DataFrame, keep: list[str], arrays: dict[str, str]) -> DataFrame:
    """SRC-8: unnest several equally long array columns in lock step (``unnest(a, b, c)``):
    ``inline(arrays_zip(...))`` keeps element i of every array on the same row."""
    zipped = F.arrays_zip(*[F.col(src).alias(out) for out, src in arrays.items()])
    return df.select(*keep, F.inline(zipped))
