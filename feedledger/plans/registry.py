"""Registry of named queries: a Spark builder and, where SQL can express it, a DuckDB oracle.

Each Spark builder takes ``(spark, sf_dir)`` and returns a DataFrame built from the operators;
each oracle is plain SQL over the driver's tables with the derived views inlined as CTEs.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import fixtures as FX


@dataclass(frozen=True)
class Query:
    name: str
    build: Callable[[SparkSession, str], DataFrame]
    oracle: str | None  # full SQL (views inlined) or None for rows-only checks
    ops: tuple[str, ...]  # SURVEY operator ids covered


REGISTRY: dict[str, Query] = {}


def ntz(df: DataFrame) -> DataFrame:
    """Report timestamps as timestamp_ntz (wall-clock UTC), the type of the supplied tables."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, T.TimestampType):
            cols.append(F.col(f.name).cast("timestamp_ntz").alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def register(name: str, ops: tuple[str, ...] | str, sql: str | None = None, views: tuple[str, ...] = ()):
    """Decorator: ``fn(t: fixtures.Tables) -> DataFrame``; ``sql`` is the oracle tail."""
    if isinstance(ops, str):
        ops = tuple(o.strip() for o in ops.split(","))

    def deco(fn: Callable[[FX.Tables], DataFrame]):
        def build(spark: SparkSession, sf_dir: str) -> DataFrame:
            from ..session import ship_package

            ship_package(spark)
            return ntz(fn(FX.tables(spark, sf_dir)))

        oracle = FX.with_views(sql, views or used_views(sql)) if sql is not None else None
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = Query(name, build, oracle, ops)
        return fn

    return deco


def used_views(sql: str) -> tuple[str, ...]:
    """Views referenced by an oracle tail (word match on view names)."""
    import re

    words = set(re.findall(r"[A-Za-z_]+", sql))
    return tuple(v for v in FX.VIEWS if v in words)


def load_all() -> dict[str, Query]:
    from . import queries, queries_checked, queries_convert, queries_ops, queries_policy, queries_misc, queries_scan, queries_stream  # noqa: F401

    return REGISTRY
