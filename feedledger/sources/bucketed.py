"""The catalog as Spark tables that are partitioned by a group of the file name and bucketed.

``files``, ``stages``, ``queue`` and ``cells`` (the counts behind the reports) share one partition
column: a hash of the leading characters of the name, its catalog and state. A directory's names
fall into few groups, so a listing reads and overwrites those partitions only, and within them the
join on the name needs no shuffle of ``files``.

A batch's new partitions are written to ``{root}/staged/batch=N`` first and then put into the tables
by dynamic partition overwrite. A batch that is interrupted in between is put in again from there, so
every batch takes effect once. The tables are external: another session finds them by their folder.
"""

from __future__ import annotations

import hashlib
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas as S
from ..operators import maintained as M

#: Leading characters of a name that its group depends on, groups of a catalog, and buckets of each.
PREFIX, GROUPS, BUCKETS = 4, 256, 8
#: Rows whose file is unknown.
ORPHANS = -1


def name_group(filename: str | Column, groups: int) -> Column:
    """The group of a file name (any case)."""
    name = F.col(filename) if isinstance(filename, str) else filename
    return F.pmod(F.xxhash64(F.substring(F.upper(name), 1, PREFIX)), F.lit(groups)).cast("int")


@contextmanager
def set_conf(spark: SparkSession, key: str, value: str):
    before = spark.conf.get(key)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.set(key, before)


class Catalog:
    TABLES = {"files": (S.FILES, "filename"), "stages": (S.FILE_STAGES, "file_id"), "queue": (S.JOB_QUEUE, "file_id"), "cells": (M.CELLS, None)}

    def __init__(self, spark: SparkSession, root: str, groups: int = GROUPS, buckets: int = BUCKETS):
        self.spark, self.root, self.groups, self.buckets = spark, root.rstrip("/"), groups, buckets
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.root).getFileSystem(spark._jsc.hadoopConfiguration())
        for name in self.TABLES:
            self._open(name)

    def table(self, name: str) -> str:
        return f"feedledger_{hashlib.md5(self.root.encode()).hexdigest()[:12]}_{name}"

    def _open(self, name: str) -> None:
        schema, key = self.TABLES[name]
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        by = f"CLUSTERED BY ({key}) SORTED BY ({key}) INTO {self.buckets} BUCKETS" if key else ""
        self._fs.mkdirs(self._path(f"{self.root}/{name}"))
        if not self.spark.catalog.tableExists(self.table(name)):
            self.spark.sql(f"CREATE TABLE {self.table(name)} ({columns}, g INT) USING parquet PARTITIONED BY (g) {by} LOCATION '{self.root}/{name}'")
            self.spark.sql(f"ALTER TABLE {self.table(name)} RECOVER PARTITIONS")

    def read(self, name: str, groups: list[int] | None = None) -> DataFrame:
        """The table, or the partitions of some groups; with its group column g."""
        self.spark.catalog.refreshTable(self.table(name))
        rows = self.spark.table(self.table(name))
        return rows if groups is None else rows.where(F.col("g").isin(groups))

    def replace(self, name: str, rows: DataFrame) -> None:
        """Put in the partitions of the groups that ``rows`` (with g) hold, for what was there."""
        schema, key = self.TABLES[name]
        laid = rows.select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields), "g")
        # one file a group and bucket, and as many tasks as there are pairs of them
        laid = laid.repartition("g", F.pmod(F.hash(key), F.lit(self.buckets))) if key else laid.repartition(self.buckets, "g")
        with set_conf(rows.sparkSession, "spark.sql.sources.partitionOverwriteMode", "dynamic"):  # a table insert reads the session's setting only
            laid.write.mode("overwrite").insertInto(self.table(name))

    def seed(self, files: DataFrame, stages: DataFrame, queue: DataFrame) -> None:
        """Load the tables as a whole."""
        own = files.withColumn("g", name_group("filename", self.groups))
        self.replace("files", own)
        ids = own.select(F.col("id").alias("_id"), "g")
        for name, rows in (("stages", stages), ("queue", queue)):
            self.replace(name, rows.join(ids, F.col("file_id") == F.col("_id"), "left").drop("_id").withColumn("g", F.coalesce("g", F.lit(ORPHANS))))
        self.replace("cells", M.cells(own, ["g"]))

    # ------------------------------------------------------------------ batches that take effect once

    def _mark(self, path: str) -> None:
        self._fs.create(self._path(path), True).close()

    def _has(self, path: str) -> bool:
        return self._fs.exists(self._path(path))

    def applied(self, batch: int) -> bool:
        return self._has(f"{self.root}/applied/{batch}")

    def staged(self, batch: int) -> bool:
        return self._has(f"{self.root}/staged/batch={batch}/_READY")

    def stage(self, batch: int, tables: dict[str, DataFrame], summary: DataFrame) -> None:
        """Write a batch's partitions and its counters beside the tables."""
        for name, rows in tables.items():
            rows.write.mode("overwrite").parquet(f"{self.root}/staged/batch={batch}/{name}")
        summary.write.mode("overwrite").parquet(f"{self.root}/summaries/batch={batch}")
        self._mark(f"{self.root}/staged/batch={batch}/_READY")

    def apply(self, batch: int) -> None:
        """Put a staged batch into the tables (again, after an interruption)."""
        for name in self.TABLES:
            self.replace(name, self.spark.read.parquet(f"{self.root}/staged/batch={batch}/{name}"))
        self._mark(f"{self.root}/applied/{batch}")
        self._fs.delete(self._path(f"{self.root}/staged/batch={batch}"), True)

    def summary(self, batch: int) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/summaries/batch={batch}")


def without_group(rows: DataFrame, schema: T.StructType) -> DataFrame:
    return rows.select(*schema.fieldNames())
