"""Mixing sources to target weights by Pfair scheduling (native).

Documents of a source are shuffled by a hash and cut into blocks of ``BLOCK_DOCS``. A source of
weight w has a fluid share min(N, w v) of its N blocks, where v grows so that all shares together
are the slot; one that has run out leaves the later slots to the others. The slots are cut into
periods. At their ends every source has its share rounded down or up, the rounded-up ones being
those whose next block is due first (earliest deadline first over whole periods, in which the fluid
schedule proves a fit), so the rounding is under one block at any slot and does not add up. In a
period of U slots block k of a source with w slots is released at slot floor(k U / w) and due before
slot ceil((k + 1) U / w); earliest deadline first fills every slot, every block inside its window,
which is within one block of the period's line. So a source is always within two blocks of its
unrounded share, and nothing is dropped or repeated. A source that runs out ends a period.

The ends of the periods are one row of about the square root of the blocks steps; the periods are
drawn in parallel, each of about that many slots. Numbering a source's documents is done in hash
buckets with a small table of bucket offsets and slots, so a hot source is spread over many groups.

Cases: a null source is a source of its own; a source without a target weight gets one slot of
``PERIOD``, as does one whose weight is null, not finite or not positive; empty texts are documents like others;
repeated rows each get their place; an empty table gives an empty result; all columns pass through
(``names`` gives the new columns' names, which replace columns of that name).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import common as C

BLOCK_DOCS = 16
#: Slots a period has at least, about: a source without a weight has one of them.
PERIOD = 400
BUCKET_DOCS = 8192
#: A source's target weight is its number of documents to this power when no weights are given.
POWER = 0.5


def _source_key(c: Column) -> Column:
    return F.coalesce(F.concat(F.lit("s"), c.cast("string")), F.lit("-"))


def target_weights(docs: DataFrame, source_col: str = "source", power: float = POWER) -> DataFrame:
    """(source, weight): the number of documents to the power ``power``."""
    return docs.groupBy(F.col(source_col).alias("source")).agg(F.pow(F.count(F.lit(1)).cast("double"), F.lit(power)).alias("weight"))


def _pattern(v: Column) -> Column:
    """Earliest deadline first over one period: the source index of every slot."""
    total = C.let(v, lambda w: F.aggregate(w, F.lit(0).cast("long"), lambda a, x: a + x))

    def step(u: Column):
        def run(state: Column, t: Column) -> Column:
            # a source's next block: eligible from its release on, least deadline first, then least index
            due = F.transform(F.arrays_zip(v.alias("w"), state["had"].alias("c")), lambda x, i: F.when(
                (x["c"] < x["w"]) & (F.floor(x["c"] * u / x["w"]) <= t), F.ceil((x["c"] + 1) * u / x["w"]) * F.size(v) + i))
            return C.let(F.array_min(due), lambda best: C.let((best % F.size(v)).cast("int"), lambda pick: F.struct(
                F.transform(state["had"], lambda x, i: x + F.when(i == pick, 1).otherwise(0)).alias("had"),
                F.concat(state["out"], F.array(pick)).alias("out"))))
        return run

    return C.let(total, lambda u: F.aggregate(
        F.sequence(F.lit(0).cast("long"), u - 1),
        F.struct(F.transform(v, lambda x: x * 0).alias("had"), F.array().cast("array<int>").alias("out")),
        step(u))["out"])


def plan(sizes: DataFrame, weights: DataFrame, block_docs: int = BLOCK_DOCS, period: int = PERIOD) -> DataFrame:
    """(key, block, slot, release, deadline) of every block, for sources of (key, n)."""
    zero, long_zero = F.lit(0.0), F.lit(0).cast("long")
    add = lambda a, x: a + x
    w = weights.select(_source_key(F.col("source")).alias("key"), F.col("weight").cast("double").alias("weight")).groupBy("key").agg(F.max("weight").alias("weight"))
    known = sizes.join(w, "key", "left").withColumn("weight", F.when((F.col("weight") > 0) & (F.col("weight") < float("inf")) & ~F.isnan("weight"), F.col("weight")).otherwise(0.0))
    # one row: a mixture's sources are few (they are named in its target)
    one = known.agg(F.sort_array(F.collect_list(F.struct("key", "n", "weight"))).alias("s")).filter(F.size("s") > 0)
    one = one.withColumn("s", C.let(F.aggregate("s", zero, lambda a, x: a + x["weight"]), lambda all_: F.transform("s", lambda x: F.struct(
        x["key"].alias("key"), F.ceil(x["n"] / block_docs).cast("long").alias("n"),
        F.when(x["weight"] > 0, x["weight"] / all_ * period).otherwise(1.0).alias("w")))))
    one = C.stored(one.withColumn("s", F.transform("s", lambda x: x.withField("v", x["n"] / x["w"]))), "sources")
    # where sources run out: v, the slot t there, and the slots for each unit of v before it
    ends = F.transform(F.array_sort(F.array_distinct(F.transform("s", lambda x: x["v"]))), lambda v: F.struct(
        v.alias("v"), F.aggregate(F.transform("s", lambda x: F.when(x["v"] <= v, x["n"]).otherwise(x["w"] * v)), zero, add).alias("t"),
        F.aggregate(F.transform("s", lambda x: F.when(x["v"] >= v, x["w"]).otherwise(0.0)), zero, add).alias("rate")))
    one = C.stored(one.select("s", ends.alias("ends"), F.aggregate(F.transform("s", lambda x: x["n"]), long_zero, add).alias("b"),
                              F.aggregate(F.transform("s", lambda x: x["w"]), zero, add).alias("all")), "ends")
    length = F.greatest(F.round("all").cast("long"), F.ceil(F.sqrt("b")), F.lit(1).cast("long"))
    slack = lambda x: F.lit(1e-9) + x * 1e-12
    at = F.concat(F.transform("ends", lambda e: F.floor(e["t"] + slack(e["t"]))), F.transform("ends", lambda e: F.ceil(e["t"] - slack(e["t"]))),
                  C.let(length, lambda u: F.transform(F.sequence(long_zero, F.floor(F.col("b") / u)), lambda j: j * u)), F.array(F.col("b")))
    one = C.stored(one.withColumn("at", F.array_sort(F.array_distinct(F.transform(at, lambda t: F.least(t, F.col("b")))))), "periods")

    def step(state: Column, t: Column) -> Column:
        end = F.coalesce(F.get(F.filter("ends", lambda e: e["t"] >= t), F.lit(0)), F.element_at("ends", -1))
        shares = C.let(end, lambda e: C.let(e["v"] - F.greatest(e["t"] - t, zero) / e["rate"], lambda v: F.transform(
            "s", lambda x: F.when(x["v"] <= v, x["n"].cast("double")).otherwise(x["w"] * v))))
        bounds = F.transform(F.arrays_zip(F.col("s").alias("s"), state["had"].alias("had"), shares.alias("f")), lambda x, i: F.struct(
            F.greatest(x["had"], F.floor(x["f"] + slack(x["f"]))).alias("low"), F.ceil(x["f"] - slack(x["f"])).alias("high"),
            x["s"]["n"].alias("n"), x["s"]["w"].alias("w"), i.alias("i")))
        def chosen(b: Column) -> Column:
            due = F.array_sort(F.transform(F.filter(b, lambda x: x["low"] < x["n"]), lambda x: F.struct(
                (x["low"] >= x["high"]).alias("early"), ((x["low"] + 1) / x["w"]).alias("due"), x["i"].alias("i"))))
            more = (t - F.aggregate(F.transform(b, lambda x: x["low"]), long_zero, add)).cast("int")
            up = F.transform(F.slice(due, F.lit(1), F.greatest(more, F.lit(0))), lambda x: x["i"])
            return C.let(up, lambda own: F.transform(b, lambda x: x["low"] + F.when(F.array_contains(own, x["i"]), 1).otherwise(0)))
        return C.let(C.let(bounds, chosen), lambda had: F.struct(had.alias("had"), F.concat(state["out"], F.array(had)).alias("out")))

    none = F.transform("s", lambda x: long_zero)
    had = F.aggregate(F.slice("at", F.lit(2), F.size("at")), F.struct(none.alias("had"), F.array(none).alias("out")), step)["out"]
    had = C.stored(one.withColumn("had", had), "had")
    a, n = F.col("a"), sizes.sparkSession.sparkContext.defaultParallelism
    each = had.select("s", "had", F.posexplode("at").alias("a", "first"), "at").filter(a < F.size("at") - 1).select(
        "a", "first", (F.get("at", a + 1) - F.col("first")).alias("u"), F.transform("s", lambda x: x["key"]).alias("keys"), F.get("had", a).alias("had"),
        F.transform(F.arrays_zip(F.get("had", a).alias("x"), F.get("had", a + 1).alias("y")), lambda z: z["y"] - z["x"]).alias("v"))
    drawn = each.repartition(n, "a").withColumn("out", _pattern(F.col("v")))
    mine = drawn.select("first", "u", "out", "v", "had", F.posexplode("keys").alias("i", "key")).select(
        "key", "first", "u", F.get("v", F.col("i")).alias("own"), F.get("had", F.col("i")).alias("before"),
        F.filter(F.transform("out", lambda p, t: F.when(p == F.col("i"), t)), lambda t: t.isNotNull()).alias("pos")).filter(F.col("own") > 0)
    k = F.col("k")
    return mine.select("key", "first", "u", "own", "before", F.posexplode("pos").alias("k", "t")).select(
        "key", (F.col("before") + k).alias("block"), (F.col("first") + F.col("t")).alias("slot"),
        (F.col("first") + F.floor(k * F.col("u") / F.col("own"))).alias("release"), (F.col("first") + F.ceil((k + 1) * F.col("u") / F.col("own"))).alias("deadline"))


def mix(docs: DataFrame, weights: DataFrame | None = None, source_col: str = "source", id_col: str = "doc_id", block_docs: int = BLOCK_DOCS, period: int = PERIOD,
        names: tuple[str, ...] = ("block", "place", "slot", "release", "deadline")) -> DataFrame:
    """All columns of ``docs`` with ``names``: the block in its source, the place in the block, the
    block's slot, and its window (release <= slot < deadline)."""
    docs = docs.drop(*names)
    n = docs.count()
    weights = target_weights(docs, source_col) if weights is None else weights
    buckets = max(1, -(-n // BUCKET_DOCS))
    key, o, bucket, rn, block, place, before, count, first, slots = C.fresh(
        docs.columns, "m_key", "m_order", "m_bucket", "m_rn", "m_block", "m_place", "m_before", "m_n", "m_first", "m_slots")
    c = F.col
    keyed = docs.withColumns({key: _source_key(c(source_col)), o: F.xxhash64(c(id_col), *(c(x) for x in docs.columns if x == "text"))})
    keyed = keyed.withColumn(bucket, F.pmod(c(o), F.lit(buckets)))
    counts = keyed.groupBy(key, bucket).agg(F.count(F.lit(1)).alias(count))
    offsets = counts.select(key, bucket, F.coalesce(F.sum(count).over(
        Window.partitionBy(key).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias(before))
    sizes = counts.groupBy(c(key).alias("key")).agg(F.sum(count).alias("n"))
    schedule = C.stored(plan(sizes, weights, block_docs, period), "plan").withColumnRenamed("key", key)
    # the slots of a bucket's blocks, which follow each other
    blocks = offsets.join(counts, [key, bucket]).select(key, bucket, before, F.explode(F.sequence(
        F.floor(c(before) / block_docs), F.floor((c(before) + c(count) - 1) / block_docs))).alias("block"))
    offsets = blocks.join(schedule, [key, "block"]).groupBy(key, bucket, before).agg(
        F.min("block").alias(first), F.sort_array(F.collect_list(F.struct("block", "slot", "release", "deadline"))).alias(slots))
    placed = keyed.withColumn(rn, F.row_number().over(Window.partitionBy(key, bucket).orderBy(o, id_col))).join(offsets, [key, bucket])
    at = c(before) + c(rn) - 1
    placed = placed.withColumns({block: F.floor(at / block_docs).cast("long"), place: (at % block_docs).cast("int")})
    found = F.get(c(slots), (c(block) - c(first)).cast("int"))
    return placed.select(*(c(x) for x in docs.columns), c(block).alias(names[0]), c(place).alias(names[1]),
                         found["slot"].alias(names[2]), found["release"].alias(names[3]), found["deadline"].alias(names[4]))
