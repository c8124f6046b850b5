"""Benchmark decontamination by suffix arrays over the training texts.

Every task lays its documents' words out as shards of at most ``SHARD_WORDS`` word numbers, sorts a
shard's suffixes (three words a key, then doubling, only what is still tied) and binary-searches the
suffixes of all test items in it, word by word and all at once. Neighbouring shards overlap by a
window less one word, so a document may be longer than a shard and nothing is lost at a cut.

``contamination`` marks the words of every occurrence of a window of ``WINDOW`` consecutive item
words (an item with fewer words is one window) and gives each document's hit count, its hit spans
and the items found in it; ``decontaminate`` removes those documents. ``longest_matches`` gives, for
every suffix of every item, its longest verbatim match in the whole corpus and where it is.

The test items go to the tasks in blocks of ``BLOCK_BYTES`` of text (at most one item more), which
bounds what is broadcast and held; a task works through the blocks one after the other. The training
texts are read once and never shuffled.

Cases: a null or empty text, or one of separators only, has no words and no hits; an item without
words finds nothing; items that repeat are one item per item_id, rows with a null item_id mark words
but are in no item list; repeated documents and documents with the same id or none are rows of their
own; a text of any length is cut into shards; an empty table (either one) gives no rows or no hits;
extra columns are ignored (``decontaminate`` returns them unchanged).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common as C
from .terms import word_lists, words

WINDOW = 10
SHARD_WORDS = 1_000_000
BLOCK_BYTES = 8 << 20
#: Occurrences looked at in one go, and words that a task remembers the numbers of.
AT_ONCE, REMEMBERED = 2_000_000, 1_000_000


class Numbers(dict):
    """Word -> number from 1 on; 0 stands for a document's end."""

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self) + 1
        return n


def suffix_array(a: np.ndarray, depth: int) -> np.ndarray:
    """The positions of ``a`` ordered by the ``depth`` (or more) numbers from each on; beyond the end
    there are zeros."""
    n = len(a)
    if n == 0:
        return np.empty(0, np.int64)
    bits = max(1, int(a.max()).bit_length())
    seen = min(depth, 63 // bits)
    key = a.astype(np.int64)
    for k in range(1, seen):
        key <<= bits
        key[: max(0, n - k)] |= a[k:]
    order = np.argsort(key)
    key = key[order]
    first = np.concatenate(([True], key[1:] != key[:-1]))
    place = np.maximum.accumulate(np.where(first, np.arange(n), 0))
    rank = np.empty(n + 1, np.int64)  # the place of the first suffix that ties with this one, from 1 on
    rank[order], rank[n] = place + 1, 0
    while seen < depth:
        last = np.concatenate((first[1:], [True]))
        tied = np.flatnonzero(~(first & last))
        if len(tied) == 0:
            break
        at = order[tied]
        key = rank[at] * (n + 2) + rank[np.minimum(at + seen, n)]
        by = np.argsort(key)
        at, key = at[by], key[by]
        order[tied] = at
        first[tied] = np.concatenate(([True], key[1:] != key[:-1]))
        place[tied] = np.maximum.accumulate(np.where(first[tied], tied, 0))
        rank[at] = place[tied] + 1
        seen *= 2
    return order


@dataclass
class Block:
    """Test items as numbers of their own word list."""

    words: list[bytes]
    flat: np.ndarray  # all items' words, one item after the other
    left: np.ndarray  # words from here to the item's end
    item: np.ndarray  # row of the item within the block
    start: np.ndarray  # place within the item
    ids: list  # item_id of each row

    @property
    def longest(self) -> int:
        return int(self.left.max(initial=1))


def blocks(items: DataFrame, item_col: str = "item_id", text_col: str = "text", size: int = BLOCK_BYTES) -> Iterator[Block]:
    """The items, fetched a partition at a time, in blocks of bounded size."""
    own: Numbers = Numbers()
    flat, left, item, start, ids, held = [], [], [], [], [], 0

    def made() -> Block:
        cat = lambda parts, kind: np.concatenate(parts).astype(kind) if parts else np.empty(0, kind)
        return Block(list(own), cat(flat, np.int64) - 1, cat(left, np.int64), cat(item, np.int64), cat(start, np.int64), list(ids))

    for row in items.select(F.col(item_col), F.coalesce(F.col(text_col), F.lit("")).cast("binary")).distinct().toLocalIterator():
        found = words(bytes(row[1]))
        n = len(found)
        if n:
            flat.append(np.fromiter(map(own.__getitem__, found), np.int64, n))
            left.append(np.arange(n, 0, -1)), start.append(np.arange(n)), item.append(np.full(n, len(ids)))
            ids.append(row[0])
            held += len(row[1])
        if held >= size:
            yield made()
            own = Numbers()
            flat, left, item, start, ids, held = [], [], [], [], [], 0
    yield made()


def search(a: np.ndarray, order: np.ndarray, asked: np.ndarray, left: np.ndarray, depth: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """Binary search of all suffixes ``asked[i : i + left[i]]``, one word more at each step: yields
    (words matched, suffixes, first, end), where ``order[first:end]`` are the places that match."""
    n = len(a)
    long = np.concatenate((a, np.zeros(depth, a.dtype)))
    who = np.flatnonzero(asked > 0)
    lo, hi = np.zeros(len(who), np.int64), np.full(len(who), n, np.int64)
    for d in range(depth):
        use = left[who] > d
        who, lo, hi = who[use], lo[use], hi[use]
        if len(who) == 0:
            return
        want = asked[who + d]

        def bound(least: np.ndarray) -> np.ndarray:
            x, y = lo.copy(), hi.copy()
            for _ in range(int((hi - lo).max()).bit_length()):
                mid = (x + y) >> 1
                less = (x < y) & (long[order[np.minimum(mid, n - 1)] + d] < least)
                x, y = np.where(less, mid + 1, x), np.where(less, y, np.minimum(mid, y))
            return x

        lo, hi = bound(want), bound(want + 1)
        use = lo < hi
        who, lo, hi = who[use], lo[use], hi[use]
        if len(who) == 0:
            return
        yield d + 1, who, lo, hi


class Texts:
    """The documents of one batch as word numbers, a zero after each."""

    def __init__(self, raw: pa.Array, numbers: Numbers):
        parts, sizes = [], []
        for x in raw:
            n = 0
            for found in word_lists(x.as_buffer().to_pybytes()):
                parts.append(np.fromiter(map(numbers.__getitem__, found), np.int32, len(found)))
                n += len(found)
            parts.append(np.zeros(1, np.int32))
            sizes.append(n)
        self.numbers = numbers
        self.flat = np.concatenate(parts) if parts else np.empty(0, np.int32)
        self.n_words = np.array(sizes, np.int64)
        self.start = np.cumsum(self.n_words + 1) - self.n_words - 1

    def doc_of(self, place: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.start, place, side="right") - 1

    def shards(self, overlap: int) -> Iterator[tuple[int, np.ndarray]]:
        size = max(SHARD_WORDS, 2 * overlap)
        for at in range(0, max(1, len(self.flat) - overlap), size - overlap):
            yield at, self.flat[at: at + size]

    def asked(self, block: Block) -> np.ndarray:
        """The block's words by this batch's numbers; -1 for a word that no document has."""
        own = np.array([self.numbers.get(w, -1) for w in block.words], np.int64)
        return own[block.flat] if len(block.flat) else block.flat


def _expand(lo: np.ndarray, hi: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row, place) of all places of the ranges, a bounded number at a time."""
    size = hi - lo
    at = 0
    while at < len(lo):
        end = max(at + 1, int(np.searchsorted(np.cumsum(size[at:]), AT_ONCE, side="right")) + at)
        if end == at + 1 and size[at] > AT_ONCE:
            for x in range(int(lo[at]), int(hi[at]), AT_ONCE):
                place = np.arange(x, min(x + AT_ONCE, int(hi[at])))
                yield np.full(len(place), at), place
        else:
            own = size[at:end]
            row = np.repeat(np.arange(at, end), own)
            yield row, np.arange(own.sum()) - np.repeat(np.cumsum(own) - own, own) + lo[row]
        at = end


def _found(texts: Texts, block: Block, window: int, hit: np.ndarray) -> np.ndarray:
    """Mark the hit words of all documents; return the distinct (document, item row) pairs."""
    wide = np.minimum(window, block.left + block.start)  # an item of fewer words is one window
    asked = texts.asked(block)
    depth, pairs = min(window, block.longest), []
    left = np.where(block.left >= wide, wide, 0)
    if not (asked > 0).any():
        return np.empty((0, 2), np.int64)
    for at, a in texts.shards(window - 1):
        order = suffix_array(a, depth)
        mark = np.zeros(len(a) + 1, np.int64)
        for d, who, lo, hi in search(a, order, asked, left, depth):
            full = left[who] == d
            if not full.any():
                continue
            ranges, of = np.unique(np.stack((lo[full], hi[full])), axis=1, return_inverse=True)
            owner = np.unique(np.stack((of.ravel(), block.item[who[full]])), axis=1)  # items of each different window
            begin = np.searchsorted(owner[0], np.arange(ranges.shape[1] + 1))
            for row, place in _expand(*ranges):
                here = order[place]
                np.add.at(mark, here, 1)
                np.add.at(mark, np.minimum(here + d, len(a)), -1)
                both = np.unique(row * len(texts.start) + texts.doc_of(here + at))
                row, doc = np.divmod(both, len(texts.start))
                n = begin[row + 1] - begin[row]
                k = np.repeat(begin[row] - np.cumsum(n) + n, n) + np.arange(n.sum())
                pairs.append(np.unique(np.stack((np.repeat(doc, n), owner[1][k]), axis=1), axis=0))
        hit[at: at + len(a)] |= np.cumsum(mark[:-1]) > 0
    return np.unique(np.concatenate(pairs), axis=0) if pairs else np.empty((0, 2), np.int64)


def _spans(hit: np.ndarray, texts: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, first word, words) of every run of hit words; a zero ends each document."""
    edge = np.diff(np.concatenate(([0], hit.astype(np.int8), [0])))
    first, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    doc = texts.doc_of(first)
    return doc, first - texts.start[doc], end - first


def _send(spark: SparkSession, items: DataFrame, item_col: str, text_col: str) -> list:
    return [spark.sparkContext.broadcast(b) for b in blocks(items, item_col, text_col)]


def _each(sent: list) -> Iterator[Block]:
    for b in sent:
        yield b.value
        if len(sent) > 1:
            b.__dict__.pop("_value", None)  # one block in memory at a time


def _slim(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text).alias("text_hash"), text.cast("binary").alias("t"))


def contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, text_hash, n_words, n_hit, items (distinct item ids, unordered),
    spans (array of start and length, in words)."""
    slim = _slim(docs, id_col, text_col)
    sent = _send(docs.sparkSession, items, item_col, item_text_col)
    schema = (slim.drop("t").schema.add("n_words", "long").add("n_hit", "long").add("items", T.ArrayType(items.schema[item_col].dataType))
              .add("spans", T.ArrayType(T.StructType().add("start", "long").add("length", "long"))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        numbers, out = Numbers(), to_arrow_schema(schema)
        for b in batches:
            if len(numbers) > REMEMBERED:
                numbers = Numbers()
            texts = Texts(b.column(2), numbers)
            hit, found = np.zeros(len(texts.flat), bool), [set() for _ in range(b.num_rows)]
            for block in _each(sent):
                for doc, item in _found(texts, block, window, hit).tolist():
                    if block.ids[item] is not None:
                        found[doc].add(block.ids[item])
            doc, first, size = _spans(hit, texts)
            n_hit = np.bincount(doc, weights=size, minlength=b.num_rows).astype(np.int64)
            runs = pa.StructArray.from_arrays([pa.array(first, pa.int64()), pa.array(size, pa.int64())], ["start", "length"])
            spans = pa.ListArray.from_arrays(pa.array(np.searchsorted(doc, np.arange(b.num_rows + 1)), pa.int32()), runs)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(texts.n_words), pa.array(n_hit), pa.array([list(x) for x in found], out.field("items").type),
                                              spans.cast(out.field("spans").type)], schema=out)

    return slim.mapInArrow(run, schema)


def decontaminate(docs: DataFrame, items: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text", **columns) -> DataFrame:
    """The rows of ``docs``, all columns, in which no window of any item occurs."""
    i, h = C.fresh(docs.columns, "hit_id", "hit_hash")
    bad = contamination(docs, items, window, id_col, text_col, **columns).filter("n_hit > 0").select(F.col("doc_id").alias(i), F.col("text_hash").alias(h)).distinct()
    return docs.join(bad, F.col(id_col).eqNullSafe(F.col(i)) & (F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))) == F.col(h)), "left_anti")


def longest_matches(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """For every suffix of every item with a word in the corpus: item_id, item_start, n_words (of the
    longest verbatim match of the suffix's beginning in any document), doc_id and doc_start (in words)
    of one such match."""
    slim = _slim(docs, id_col, text_col).drop("text_hash")
    sent = _send(docs.sparkSession, items, item_col, item_text_col)
    schema = T.StructType([T.StructField("item_id", items.schema[item_col].dataType)]).add("item_start", "long").add("n_words", "long")
    schema = schema.add("doc_id", docs.schema[id_col].dataType).add("doc_start", "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_type

        numbers, id_type = Numbers(), to_arrow_type(schema[0].dataType)
        for b in batches:
            if len(numbers) > REMEMBERED:
                numbers = Numbers()
            texts = Texts(b.column(1), numbers)
            for block in _each(sent):
                asked = texts.asked(block)
                best, where = np.zeros(len(asked), np.int64), np.zeros(len(asked), np.int64)
                if not (asked > 0).any():
                    continue
                for at, a in texts.shards(block.longest - 1):
                    order = suffix_array(a, block.longest)
                    for d, who, lo, hi in search(a, order, asked, block.left, block.longest):
                        use = d > best[who]
                        best[who[use]], where[who[use]] = d, order[lo[use]] + at
                got = np.flatnonzero(best)
                doc = texts.doc_of(where[got])
                yield pa.RecordBatch.from_arrays([pa.array([block.ids[k] for k in block.item[got]], id_type), pa.array(block.start[got]), pa.array(best[got]),
                                                  b.column(0).take(pa.array(doc)), pa.array(where[got] - texts.start[doc])], schema.names)

    longest = slim.mapInArrow(run, schema).groupBy("item_id", "item_start").agg(
        F.max("n_words").alias("n_words"), F.min_by(F.struct("doc_id", "doc_start"), F.struct(-F.col("n_words"), "doc_id", "doc_start")).alias("at"))
    return longest.select("item_id", "item_start", "n_words", "at.doc_id", "at.doc_start")
