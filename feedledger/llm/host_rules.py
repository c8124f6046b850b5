"""Quality rules with host-level verdicts (native).

``document_stats`` measures each whole text in the row itself (no shuffle of words), ``host_rates``
aggregates rule failures per host and shrinks each host's rate toward an empirical beta prior
(method of moments over hosts), ``verdicts`` joins the host verdicts back to the documents.

Cases: a null or empty text has no word (all counts 0; it fails the base rule); repeated rows are
judged and counted one by one; a null host gets no host verdict (only the base rule applies); an
empty table gives an empty result; extra columns are ignored. A very long text stays one row; all
work on it is linear but for one sort of its windows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common as C

#: Base rule: fewer words than this, or more than this share (percent) of repeated words, fails.
MIN_WORDS = 50
MAX_REPEAT_PCT = 50
#: A host is rejected when the shrunk failure rate of one of its rules is above this.
MAX_HOST_RATE = 0.5
SYMBOLS = "#*$%&|<>"


def repeated_words(w: Column) -> Column:
    """Words inside 3-word windows that occur twice or more: windows sorted by (hash, position),
    neighbours with equal hash are repeats, and the positions they cover are counted once."""

    def covered(ws: Column) -> Column:
        windows = F.sort_array(F.transform(
            F.sequence(F.lit(0), F.size(ws) - 3),
            lambda i: F.struct(F.xxhash64(F.get(ws, i), F.get(ws, i + 1), F.get(ws, i + 2)).alias("h"), i.alias("i"))))
        return C.let(windows, lambda s: F.size(F.array_distinct(F.flatten(F.transform(
            F.filter(F.sequence(F.lit(0), F.size(s) - 1),
                     lambda k: (F.get(s, k)["h"] == F.get(s, k - 1)["h"]) | (F.get(s, k)["h"] == F.get(s, k + 1)["h"])),
            lambda k: C.let(F.get(s, k)["i"], lambda p: F.array(p, p + 1, p + 2)))))))

    return F.when(F.size(w) < 4, F.lit(0)).otherwise(covered(w))


def _text_stats(text: Column) -> Column:
    bare = F.translate(text, C.WS, "")
    lines = F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(C.WS)) != "")
    return C.let(C.words(text), lambda w: F.struct(
        F.size(w).cast("long").alias("n_words"),
        F.length(bare).cast("long").alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        C.let(lines, lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long")).alias("n_dup_lines"),
        C.let(lines, lambda x: F.size(x).cast("long")).alias("n_lines"),
        repeated_words(w).cast("long").alias("n_repeat_words")))


def document_stats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source") -> DataFrame:
    """One row per document: doc_id, host, counts and ``base_failed``."""
    out = docs.select(F.col(id_col).alias("doc_id"), F.col(host_col).alias("host"),
                      _text_stats(F.coalesce(F.col(text_col), F.lit(""))).alias("s")).select("doc_id", "host", "s.*")
    return out.withColumn("base_failed", (F.col("n_words") < MIN_WORDS)
                          | (100 * F.col("n_repeat_words") > MAX_REPEAT_PCT * F.col("n_words")))


def rule_failures() -> dict[str, Column]:
    """Rules whose failures are counted per host."""
    c = F.col
    return {
        "base": c("base_failed"),
        "symbols": 10 * c("n_symbols") > c("n_words"),
        "dup_lines": 10 * c("n_dup_lines") > 3 * c("n_lines"),
        "word_length": (c("word_chars") < 3 * c("n_words")) | (c("word_chars") > 10 * c("n_words")),
    }


def host_rates(stats: DataFrame) -> DataFrame:
    """host, n_docs and the shrunk failure rate of each rule (``rate_<rule>``).

    The prior of a rule has the mean m of all documents and the strength k = m(1-m)/v - 1, v being
    the variance of the hosts' rates weighted by documents; without variance (one host, or equal
    rates) k is 1. Counts are integers and sums of a few hosts, so the aggregate is partial and a
    hot host is combined before the shuffle.
    """
    rules = rule_failures()
    hosts = stats.filter(F.col("host").isNotNull()).groupBy("host").agg(
        F.count(F.lit(1)).alias("n_docs"), *(F.sum(c.cast("long")).alias(f"f_{r}") for r, c in rules.items()))
    prior = hosts.agg(
        F.sum("n_docs").alias("n"),
        *(F.sum(f"f_{r}").alias(f"s_{r}") for r in rules),
        *(F.sum(F.col(f"f_{r}") * F.col(f"f_{r}") / F.col("n_docs")).alias(f"q_{r}") for r in rules))
    cols = []
    for r in rules:
        m = F.col(f"s_{r}") / F.col("n")
        v = F.col(f"q_{r}") / F.col("n") - m * m
        k = F.when(v > 1e-9, F.greatest(m * (1 - m) / v - 1, F.lit(1e-3))).otherwise(F.lit(1.0))
        cols += [(m * k).alias(f"a_{r}"), k.alias(f"k_{r}")]
    prior = prior.select(F.lit(1).alias("one"), *cols)
    both = hosts.withColumn("one", F.lit(1)).join(F.broadcast(prior), "one")  # one row
    return both.select("host", "n_docs", *(
        ((F.col(f"f_{r}") + F.col(f"a_{r}")) / (F.col("n_docs") + F.col(f"k_{r}"))).alias(f"rate_{r}") for r in rules))


def verdicts(stats: DataFrame, max_rate: float = MAX_HOST_RATE) -> DataFrame:
    """Each row of ``stats`` with ``host_rate`` (its host's worst shrunk rate) and ``kept``."""
    worst = F.greatest(*(F.col(f"rate_{r}") for r in rule_failures()))
    hosts = host_rates(stats).select("host", worst.alias("host_rate"))
    return stats.join(hosts, "host", "left").withColumn(
        "kept", ~F.col("base_failed") & (F.coalesce(F.col("host_rate"), F.lit(0.0)) <= max_rate))


def apply_rules(docs: DataFrame) -> DataFrame:
    """``document_stats`` stored once (it is read by the host aggregate and the join), then ``verdicts``."""
    return verdicts(C.stored(document_stats(docs), "rules"))
