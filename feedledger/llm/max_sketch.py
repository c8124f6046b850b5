"""Ranked lexical search with hashed max-sketches.

1. ``index``: every document becomes its number of terms n, its different terms' 64-bit hashes with
   their counts, and a sketch: ``len(ROWS)`` rows of 2^k coordinates (at least ``FOLD`` a row for each
   term, so the fill does not grow with the text), each the largest count of the terms that fold into
   it. An impact grows with the count, so the least of a term's coordinates bounds its impact.
2. ``Query`` blocks: the items' terms get their document frequencies from the index, and weights.
3. A task looks the terms of all of a block's items up in the sketches of a batch at once; weight
   times impact adds up to an upper bound of every document for every item. An item's documents are
   rescored exactly from their term counts in the order of descending bounds, until the bound falls
   below the item's k-th best score so far. Only a task's best k per item leave it; two ranked
   windows (first by part of the index, then whole) give the best k of all.

The index does not depend on the items. Items go to the tasks in blocks of ``BLOCK_TERMS`` terms (at
most one item more), which bounds what is broadcast, and what a document batch is compared with.

Cases: null and empty texts and texts of separators have no term, count for nothing and are never
found; an item without terms, or whose terms no document has, has no rows; repeated document rows
are ranked one by one, equal scores by ascending doc_id, null ids last; items with the same item_id
and text are one item, with different texts each has ranks of its own; a text of any length has one
sketch in proportion to its different terms; an empty table gives an empty result; extra columns
are ignored. Hashes are 64 bits wide: among a million item terms and 10^9 different terms of a corpus,
a chance match has probability below 10^-4.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common as C
from .suffix_decontam import _each
from .terms import word_lists, words

K = 50
FOLD = 4
#: One odd multiplier for each row of a sketch; the product's high bits are the coordinate.
ROWS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)
#: Documents whose sketches are looked up at once hold at most this many coordinates.
LOOKUP_CELLS = 4_000_000
BLOCK_TERMS = 200_000
#: Documents that are made into index rows at once.
AT_ONCE = 1000
#: The first ranked window's groups an item.
PARTS = 32
#: Counts from here on are one value in a sketch; its impact is the limit.
MANY, LIMIT = 255, 1_000_000


class Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        import xxhash

        h = xxhash.xxh3_64_intdigest(word)
        if len(word) <= 64 and len(self) < 500_000:
            self[word] = h
        return h


def impact(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return (1_000_000_000 * tf) // (1000 * tf + 20 * m)


def coordinates(h: np.ndarray, row: int, size: int) -> np.ndarray:
    return ((h * np.uint64(ROWS[row])) >> np.uint64(65 - size.bit_length())).astype(np.int64)


def sketch(h: np.ndarray, tf: np.ndarray) -> np.ndarray:
    """Rows of coordinatewise largest counts (as uint8, ``MANY`` for more)."""
    size = 1 << max(4, (FOLD * len(h) - 1).bit_length())
    out = np.zeros((len(ROWS), size), np.uint8)
    by_count = np.argsort(tf, kind="stable")  # of several counts for a coordinate the last, largest, stays
    h, tf = h[by_count], np.minimum(tf[by_count], MANY).astype(np.uint8)
    for row in range(len(ROWS)):
        out[row, coordinates(h, row, size)] = tf
    return out


def index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Stored: doc_id, n, sketch, h (ascending 64-bit hashes), tf (32-bit counts) of every document
    with a term."""
    slim = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("t"))
    schema = slim.drop("t").schema.add("n", "long").add("sketch", "binary").add("h", "binary").add("tf", "binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = Hashes()
        for b in (b.slice(at, AT_ONCE) for b in batches for at in range(0, b.num_rows, AT_ONCE)):
            kept, ns, cells, hashes, counts = [], [], [], [], []
            for k, x in enumerate(b.column(1)):
                found: Counter[bytes] = Counter()
                for part in word_lists(x.as_buffer().to_pybytes()):
                    found.update(part)
                if not found:
                    continue
                h = np.fromiter(map(cache.__getitem__, found), np.uint64, len(found))
                tf = np.fromiter(found.values(), np.uint32, len(found))
                order = np.argsort(h)
                h, tf = h[order], tf[order]
                kept.append(k), ns.append(int(tf.sum(dtype=np.int64)))
                cells.append(sketch(h, tf).tobytes()), hashes.append(h.tobytes()), counts.append(tf.tobytes())
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(kept, pa.int64())), pa.array(ns, pa.int64()), pa.array(cells, pa.binary()),
                                              pa.array(hashes, pa.binary()), pa.array(counts, pa.binary())], schema.names)

    return C.stored(slim.mapInArrow(run, schema), "sketches")


class Query:
    """A block of items: their different terms (ascending hashes), and each item's list of them."""

    def __init__(self, terms: np.ndarray, term: np.ndarray, first: np.ndarray, ids: list):
        self.terms, self.term, self.first, self.ids = terms, term, first, ids
        self.weight = np.zeros(len(terms), np.int64)


def query_blocks(items: DataFrame, item_col: str, text_col: str) -> Iterator[Query]:
    lists, ids, held, cache = [], [], 0, Hashes()

    def made() -> Query:
        sizes = [len(x) for x in lists]
        terms, term = np.unique(np.concatenate(lists) if lists else np.empty(0, np.uint64), return_inverse=True)
        return Query(terms, term.astype(np.int64), np.cumsum([0, *sizes]), list(ids))

    for row in items.select(F.col(item_col), F.coalesce(F.col(text_col), F.lit("")).cast("binary")).distinct().toLocalIterator():
        found = set(words(bytes(row[1])))
        if found:
            lists.append(np.fromiter(map(cache.__getitem__, found), np.uint64, len(found)))
            ids.append(row[0])
            held += len(found)
        if held >= BLOCK_TERMS:
            yield made()
            lists, ids, held = [], [], 0
    if lists:
        yield made()


def _rows_of(column: pa.Array, kind: type) -> tuple[np.ndarray, np.ndarray]:
    """All values of a binary column, and where each row begins."""
    wide = np.int64 if pa.types.is_large_binary(column.type) else np.int32
    offsets = np.frombuffer(column.buffers()[1], wide)[column.offset: column.offset + len(column) + 1].astype(np.int64)
    width = np.dtype(kind).itemsize
    data = column.buffers()[2]
    flat = np.frombuffer(data, kind, (offsets[-1] - offsets[0]) // width, offsets[0]) if data and len(column) else np.empty(0, kind)
    return flat, (offsets - offsets[0]) // width


def document_frequencies(indexed: DataFrame, sent: list) -> list[np.ndarray]:
    """For each block the number of documents that hold each of its terms."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df: dict[int, np.ndarray] = {}
        for b in batches:
            flat, _ = _rows_of(b.column(0), np.uint64)
            for k, q in enumerate(_each(sent)):
                at = np.minimum(np.searchsorted(q.terms, flat), len(q.terms) - 1)
                df[k] = df.get(k, 0) + np.bincount(at[q.terms[at] == flat], minlength=len(q.terms))
        for k, n in df.items():
            some = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(some), k), pa.int64()), pa.array(some), pa.array(n[some])], ["block", "term", "df"])

    counted = indexed.select("h").mapInArrow(run, "block long, term long, df long").groupBy("block", "term").agg(F.sum("df").alias("df"))
    out = [np.zeros(len(b.value.terms), np.int64) for b in sent]
    for row in counted.toLocalIterator():  # as many rows as the blocks have terms
        out[row[0]][row[1]] = row[2]
    return out


class Best:
    """The best k (score, doc_id) of one item so far."""

    def __init__(self, k: int):
        self.k, self.rows, self.least = k, [], 0

    def add(self, rows: list[tuple]) -> None:
        """(-score, id is null, id) rows, in any order."""
        self.rows = sorted(self.rows + rows)[: self.k]
        if len(self.rows) == self.k:
            self.least = -self.rows[-1][0]


def _bounds(cells: np.ndarray, m: np.ndarray, q: Query) -> np.ndarray:
    """Upper bounds, one row a document and one column an item, from the looked-up coordinates."""
    size = cells.shape[2]
    count = cells[:, 0].take(coordinates(q.terms, 0, size), axis=1)
    for row in range(1, len(ROWS)):
        np.minimum(count, cells[:, row].take(coordinates(q.terms, row, size), axis=1), out=count)
    doc, term = np.nonzero(count)
    tf = count[doc, term].astype(np.int64)
    worth = np.zeros(count.shape, np.int64)
    worth[doc, term] = np.where(tf == MANY, LIMIT, impact(tf, m[doc])) * q.weight[term]
    return np.add.reduceat(worth.take(q.term, axis=1), q.first[:-1], axis=1)


def _search(b: pa.RecordBatch, q: Query, best: list[Best], n_docs: int, length: int) -> None:
    n = b.column(1).to_numpy()
    m = 100 - 50 + (50 * n * n_docs) // length
    cells, cell_at = _rows_of(b.column(2), np.uint8)
    hashes, hash_at = _rows_of(b.column(3), np.uint64)
    counts, _ = _rows_of(b.column(4), np.uint32)
    ids = b.column(0).to_pylist()
    sizes = np.diff(cell_at)
    order = [q.terms[q.term[q.first[i]: q.first[i + 1]]] for i in range(len(q.ids))]
    weights = [q.weight[q.term[q.first[i]: q.first[i + 1]]] for i in range(len(q.ids))]
    for size in np.unique(sizes).tolist():
        members = np.flatnonzero(sizes == size)
        step = max(1, min(LOOKUP_CELLS // size, LOOKUP_CELLS // max(1, len(q.term))))
        for at in range(0, len(members), step):
            docs = members[at: at + step]
            looked_up = np.stack([cells[cell_at[d]: cell_at[d] + size] for d in docs]).reshape(len(docs), len(ROWS), -1)
            bounds = _bounds(looked_up, m[docs], q)
            for i, top in enumerate(best):
                some = np.flatnonzero((bounds[:, i] >= top.least) & (bounds[:, i] > 0))
                some = some[np.argsort(-bounds[some, i], kind="stable")]
                done = 0
                while done < len(some) and bounds[some[done], i] >= top.least:
                    found = []
                    for s in some[done: done + top.k].tolist():
                        if bounds[s, i] < top.least:
                            break
                        d = docs[s]
                        h, tf = hashes[hash_at[d]: hash_at[d + 1]], counts[hash_at[d]: hash_at[d + 1]]
                        spot = np.minimum(np.searchsorted(h, order[i]), len(h) - 1)
                        own = np.where(h[spot] == order[i], tf[spot], 0).astype(np.int64)
                        score = int((weights[i] * impact(own, m[d])).sum())
                        if score > 0:
                            found.append((-score, ids[d] is None, ids[d] if ids[d] is not None else 0))
                    top.add(found)
                    done += top.k


def top_documents(indexed: DataFrame, items: DataFrame, k: int = K, item_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """item_id, rank, doc_id, score of each item's best ``k`` documents of an ``index``."""
    spark = indexed.sparkSession
    id_type, item_type = indexed.schema["doc_id"].dataType, items.schema[item_col].dataType
    total = indexed.agg(F.count(F.lit(1)).alias("n"), F.sum("n").alias("l")).first()
    n_docs, length = total["n"], total["l"] or 0
    schema = T.StructType([T.StructField("item_no", T.LongType()), T.StructField("item_id", item_type), T.StructField("part", T.IntegerType()),
                           T.StructField("doc_id", id_type), T.StructField("score", T.LongType())])
    sent = [spark.sparkContext.broadcast(q) for q in query_blocks(items, item_col, text_col)] if n_docs else []
    if not sent:
        return spark.createDataFrame([], T.StructType([schema[1]]).add("rank", "integer").add(schema[3]).add(schema[4]))
    weighted, first_no = [], 0
    for b, df in zip(sent, document_frequencies(indexed, sent)):
        q = b.value
        q.weight = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * x + 1))) for x in df.tolist()], np.int64)
        q.no, first_no = first_no, first_no + len(q.ids)
        weighted.append(spark.sparkContext.broadcast(q))
        b.unpersist()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        from pyspark.sql.pandas.types import to_arrow_schema

        out, part = to_arrow_schema(schema), TaskContext.get().partitionId() % PARTS
        best: dict[int, list[Best]] = {}
        for b in batches:
            for j, q in enumerate(_each(weighted)):
                _search(b, q, best.setdefault(j, [Best(k) for _ in q.ids]), n_docs, length)
        for j, q in enumerate(_each(weighted)):
            for i, top in enumerate(best.get(j, [])):
                if top.rows:
                    s = len(top.rows)
                    yield pa.RecordBatch.from_arrays([pa.array([q.no + i] * s, pa.int64()), pa.array([q.ids[i]] * s, out.field(1).type), pa.array([part] * s, pa.int32()),
                                                      pa.array([None if r[1] else r[2] for r in top.rows], out.field(3).type), pa.array([-r[0] for r in top.rows], pa.int64())], schema=out)

    by_score = [F.desc("score"), F.asc_nulls_last("doc_id")]
    found = indexed.select("doc_id", "n", "sketch", "h", "tf").mapInArrow(run, schema)
    parts = found.withColumn("rn", F.row_number().over(Window.partitionBy("item_no", "part").orderBy(*by_score))).filter(F.col("rn") <= k).drop("rn")
    ranked = parts.withColumn("rank", F.row_number().over(Window.partitionBy("item_no").orderBy(*by_score))).filter(F.col("rank") <= k)
    return ranked.select("item_id", "rank", "doc_id", "score")
