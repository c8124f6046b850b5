"""Glob lookup of file names without reading all of them (FLT-7, FLT-15).

A glob with a wildcard is anchored: its literal beginning bounds the names by a range that Parquet's
statistics answer (catalog names are stored in upper case). A literal inside the glob, or a search
without a wildcard, is looked up by its three-character parts in a posting table that is partitioned
by a hash of the part: the rarest parts of the glob are read and intersected, and what is left is
verified with the pattern itself. A glob without any part of three characters is answered by the scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.glob import matches_glob

SIZE = 3
#: Partitions of the posting table, and parts of a glob that are intersected.
SLOTS, PARTS = 64, 3
POSTINGS, COUNTS = "part string, id string, filename string, slot int", "slot int, part string, names long"


def prefix_bounds(glob: str) -> tuple[str, str | None] | None:
    """(least, end) of the upper-case names that an anchored glob can match; None without a bound. Only
    ASCII characters count, whose case has one form."""
    if "*" not in glob:
        return None
    prefix = glob[: glob.index("*")]
    keep = next((i for i, c in enumerate(prefix) if not c.isascii()), len(prefix))
    prefix = prefix[:keep].upper()
    return (prefix, prefix[:-1] + chr(ord(prefix[-1]) + 1)) if prefix else None


def glob_condition(column: str, glob: str) -> Column:
    """``matches_glob`` on a column of upper-case names, with the range that reaches the scan."""
    bounds = prefix_bounds(glob)
    exact = matches_glob(column, glob)
    return exact if bounds is None else (F.col(column) >= bounds[0]) & (F.col(column) < bounds[1]) & exact


def glob_parts(glob: str) -> list[str]:
    """The different three-character parts of a glob's literals, in upper case."""
    literals = [x.upper() for x in glob.split("*") if x.isascii()]
    return sorted({x[i: i + SIZE] for x in literals for i in range(len(x) - SIZE + 1)})


def _slot(part: Column) -> Column:
    return F.pmod(F.xxhash64(part), F.lit(SLOTS)).cast("int")


def postings(files: DataFrame) -> DataFrame:
    """slot, part, id, filename of every three-character part of every name, once a name."""
    upper = F.upper("filename")
    parts = F.array_distinct(F.transform(F.sequence(F.lit(1), F.greatest(F.length(upper) - (SIZE - 1), F.lit(1))), lambda i: F.substring(upper, i, F.lit(SIZE))))
    out = files.where(F.length("filename") >= SIZE).select("id", "filename", F.explode(parts).alias("part"))
    return out.select(_slot(F.col("part")).alias("slot"), "part", "id", "filename")


def write_postings(files: DataFrame, path: str) -> None:
    """Store the posting table and, beside it, how many names each part is in. A slot's rows are sorted
    by part; a frequent part is dealt over several files by id."""
    rows = postings(files)
    rows.repartition("slot", F.pmod(F.xxhash64("id"), F.lit(4))).sortWithinPartitions("slot", "part").write.mode("overwrite").partitionBy("slot").parquet(f"{path}/postings")
    rows.groupBy("slot", "part").agg(F.count(F.lit(1)).alias("names")).write.mode("overwrite").parquet(f"{path}/counts")


def rarest(spark: SparkSession, path: str, parts: list[str]) -> list[tuple[str, int]]:
    """(part, names) of a glob's parts, the rarest ``PARTS`` of them first; one without a name has 0."""
    known = {r["part"]: r["names"] for r in spark.read.schema(COUNTS).parquet(f"{path}/counts").where(F.col("part").isin(parts)).collect()}  # one row a part of the glob
    return sorted(((p, known.get(p, 0)) for p in parts), key=lambda x: (x[1], x[0]))[:PARTS]


def find_in_postings(spark: SparkSession, path: str, glob: str) -> DataFrame | None:
    """(id, filename) of the names that match, from the posting table; None if no literal has a part."""
    parts = glob_parts(glob)
    if not parts:
        return None
    chosen = [p for p, _ in rarest(spark, path, parts)]
    slots = [r[0] for r in spark.createDataFrame([(p,) for p in chosen], "part string").select(_slot(F.col("part"))).distinct().collect()]
    hits = spark.read.schema(POSTINGS).parquet(f"{path}/postings").where(F.col("slot").isin(slots) & F.col("part").isin(chosen))
    both = hits.groupBy("id", "filename").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") == len(chosen))
    return both.where(matches_glob("filename", glob)).select("id", "filename")


def find_by_glob(files: DataFrame, glob: str, path: str | None = None) -> DataFrame:
    """FLT-15: the files that match, through the name range, the posting table below ``path``, or both."""
    found = None if path is None else find_in_postings(files.sparkSession, path, glob)
    own = files.where(glob_condition("filename", glob))
    return own if found is None else own.join(found.select("id"), "id", "left_semi")
