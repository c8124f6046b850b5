"""Connected components by alternating large-star and small-star rounds.

Every round is two joins on a node with its least neighbour (partial minimum, so a hub is combined
before the shuffle; the join is one that adaptive execution can split); its edges are written to the
shared folder, so lineage stays short. No node or edge list reaches the driver, only two numbers a
round. An input of stars ends after one or two rounds, a path after about log2 of its length.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return both.join(low, "a").filter(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    low = down.groupBy("a").agg(F.min("b").alias("m"))
    return down.join(low, "a").select(F.explode(F.array(F.struct(F.col("a"), F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e")).select("e.*")


def _clean(edges: DataFrame, label: str) -> DataFrame:
    return C.stored(edges.filter(F.col("a") != F.col("b")).distinct(), label)


def components(edges: DataFrame) -> DataFrame:
    """(a, b) edges of long nodes, in any direction, repeated or looped -> (node, root): every node
    that has an edge to another, with the least node of its component (roots are left out)."""
    now = _clean(edges.select("a", "b"), "edges")
    state = None
    while True:
        now = _clean(_small_star(_large_star(now)), "edges")
        row = now.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")).first()
        if (row["n"], row["s"]) == state:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
        state = (row["n"], row["s"])
