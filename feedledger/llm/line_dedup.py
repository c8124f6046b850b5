"""Line de-duplication that moves hashes and returns keep bitmaps (native).

Lines become (key hash, document, position) rows. The rows are range-partitioned by (hash, chunk of
the document id), sorted by document and position inside a partition, and streamed: per group the
first occurrence and the number of distinct documents. The chunk spreads one common line over many
ranges; a second small aggregate adds the chunks of a key. Dropped positions go back as one bitmap
per document (64-line words, words without a dropped line left out); the text is not shuffled until
a caller wants it rewritten.

Cases: a null or empty text is one empty line; lines whose key is shorter than ``min_chars`` always
stay; a line repeated in one document counts that document once; rows with the same id are one
document for counting, told apart by their text when rewritten; a null id is an id of its own; an
empty table gives an empty result; extra columns are ignored by ``drop_bitmaps``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import common as C

MIN_DOCS = 10
MIN_CHARS = 1
#: A key of more words than this is a long one, which may have a threshold of its own.
LONG_WORDS = 50
#: A key's rows are dealt over this many groups.
CHUNKS = 64


def line_key(line: Column) -> Column:
    return C.ascii_lower(F.btrim(line, F.lit(C.WS)))


def _text(c: str) -> Column:
    return F.coalesce(F.col(c), F.lit(""))


def _is_long(key: Column) -> Column:
    # so many words need twice as many characters at least; shorter keys are not split
    return F.when(F.length(key) > 2 * LONG_WORDS, F.size(C.words(key)) > LONG_WORDS).otherwise(False)


def line_rows(docs: DataFrame, min_chars: int = MIN_CHARS, id_col: str = "doc_id", text_col: str = "text", tell_long: bool = False) -> DataFrame:
    """(h, chunk, doc_id, th, pos): 128-bit key hash, chunk, id, hash of the text, line position; with
    ``tell_long`` also whether the key is a long one."""
    lines = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(_text(text_col)).alias("th"),
                        F.posexplode(F.transform(F.split(_text(text_col), "\n"), line_key)).alias("pos", "key"))
    return lines.filter(F.length("key") >= max(1, min_chars)).select(
        F.unhex(F.md5(F.col("key").cast("binary"))).alias("h"),
        F.pmod(F.xxhash64("doc_id"), F.lit(CHUNKS)).cast("int").alias("chunk"), "doc_id", "th", "pos",
        *([_is_long(F.col("key")).alias("long")] if tell_long else []))


def drop_bitmaps(docs: DataFrame, min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS, keep_first: bool = False,
                 id_col: str = "doc_id", text_col: str = "text", long_docs: int | None = None) -> DataFrame:
    """One row per document that loses a line: doc_id, th, n_dropped, bits = array of (word, bits),
    where bit b of word w stands for line 64 w + b. Every other line is kept.

    A key found in ``min_docs`` documents loses all its lines, or all but the first (by document,
    then position) with ``keep_first``. With ``long_docs`` a key of more than ``LONG_WORDS`` words
    does so from that many documents on.
    """
    extra = [] if long_docs is None else ["long"]
    rows = C.stored(line_rows(docs, min_chars, id_col, text_col, bool(extra)), "lines")
    least = F.lit(min_docs) if long_docs is None else F.when(F.col("long"), long_docs).otherwise(min_docs)
    ranged = rows.repartitionByRange("h", "chunk")
    by_doc = Window.partitionBy("h", "chunk").orderBy("doc_id", "th", "pos")
    seen = ranged.select("h", "chunk", "doc_id", "th", "pos", *extra, F.row_number().over(by_doc).alias("rn"),
                         F.lag("doc_id").over(by_doc).alias("before"))
    groups = seen.groupBy("h", "chunk").agg(
        F.sum(F.when((F.col("rn") == 1) | ~F.col("before").eqNullSafe(F.col("doc_id")), 1).otherwise(0)).alias("n"),
        F.min(F.struct("doc_id", "th", "pos")).alias("first"), *(F.max(x).alias(x) for x in extra))
    keys = groups.groupBy("h").agg(F.sum("n").alias("n_docs"), F.min("first").alias("first"), *(F.max(x).alias(x) for x in extra)).filter(F.col("n_docs") >= least)
    verdict = groups.select("h", "chunk").join(keys.select("h", "first"), "h")
    dropped = rows.join(verdict, ["h", "chunk"])
    if keep_first:
        dropped = dropped.filter(~F.struct("doc_id", "th", "pos").eqNullSafe(F.col("first")))
    words = dropped.groupBy("doc_id", "th", F.floor(F.col("pos") / 64).cast("int").alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, pos % 64)")).alias("bits"))
    return words.groupBy("doc_id", "th").agg(
        F.sum(F.bit_count("bits")).cast("long").alias("n_dropped"),
        F.sort_array(F.collect_list(F.struct("word", "bits"))).alias("bits"))


def positions(bits: Column) -> Column:
    """The line positions that a bitmap marks, ascending."""
    return F.flatten(F.transform(bits, lambda b: F.transform(
        F.filter(F.sequence(F.lit(0), F.lit(63)), lambda i: F.expr("0L") != b["bits"].bitwiseAND(_bit(i))),
        lambda i: b["word"] * 64 + i)))


def _bit(i: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), i)


def apply_bitmaps(docs: DataFrame, bitmaps: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  names: tuple[str, str] | None = None) -> DataFrame:
    """All columns of ``docs`` with the text rewritten where a line goes (a null text reads as empty),
    plus the number of lines and of dropped lines, named ``names`` (they replace columns of that name)."""
    n_lines, n_dropped = names or ("n_lines", "n_dropped")
    docs = docs.drop(n_lines, n_dropped)
    i, th, nd, bits = C.fresh(docs.columns, "b_id", "b_th", "b_dropped", "b_bits")
    b = bitmaps.select(F.col("doc_id").alias(i), F.col("th").alias(th), F.col("n_dropped").alias(nd), F.col("bits").alias(bits))
    joined = docs.join(b, F.col(id_col).eqNullSafe(F.col(i)) & (F.xxhash64(_text(text_col)) == F.col(th)), "left")
    kept = C.let(F.split(_text(text_col), "\n"), lambda lines: F.array_join(F.transform(
        F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), positions(F.col(bits))), lambda k: F.get(lines, k)), "\n"))
    rewritten = F.when(F.col(bits).isNull(), _text(text_col)).otherwise(kept)
    return joined.select(*(rewritten.alias(c) if c == text_col else F.col(c) for c in docs.columns),
                         F.size(F.split(_text(text_col), "\n")).cast("long").alias(n_lines),
                         F.coalesce(F.col(nd), F.lit(0)).cast("long").alias(n_dropped))


def dedup_lines(docs: DataFrame, names: tuple[str, str] | None = None, **how) -> DataFrame:
    return apply_bitmaps(docs, drop_bitmaps(docs, **how), names=names)
