"""Exact Jaccard self-join of word shingles by universe partition, as connected components.

1. ``signatures``: a text's set of 64-bit shingle hashes gets signatures for its size band. The
   universe is hashed into segments; two sets that differ in at most H shingles agree on a segment
   (pigeonhole). ``allocate`` weighs, per band, exact segments (one signature) against segments
   compared up to one shingle (all one-deletion neighbours, worth two exact ones), and spare
   segments, by the rows they cost and the chance matches they let through. A set leaves out as many
   exact segments as there are spare ones: those with the fewest shingles that are rare in a sample
   of the sets (empty ones, and such as a passage of many documents fills). As all sets leave out by
   the same order of contents, two sets lose no more common segments than one of them leaves out.
2. Sets that share a signature are starred to one of them, and the stars' components are the candidate
   groups: every linked pair lies inside one. A task reduces equal sets to one, packs its signatures
   as sorted differences with short class numbers, a range of signatures a row, and only those rows
   are shuffled. A range is streamed: what is kept are its different signatures, which the number of
   ranges bounds, so a signature that a third of all sets share costs time in proportion, not memory.
3. Each group is verified exactly, all pairs inside, in pairs of blocks so that a large group is
   spread over many tasks; a block pair returns a spanning forest of its links, not the links.
4. The forests' components, least doc_id each, are the answer. Equal sets are one class throughout.

Cases: a text without words has an empty set (n_shingles 0) and links with nothing, its
component_id is its own id; with fewer words than a shingle the whole sequence is the one shingle;
rows with a null id are returned with component_id null and join nothing; rows with the same id are
classed by their own texts, and the id stands for all of them; repeated rows are equal sets; an
empty table gives an empty result; extra columns are ignored. Sets and signatures are 64-bit hashes:
two different sets of one corpus of 10^9 texts share a class with probability below 3 %.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common as C
from .graph import components

WORDS = 3
#: Two sets link when WHOLE * intersection >= PART * union.
PART, WHOLE = 90, 100
#: Next band's smallest size is this many times as large.
BAND = 1 / 0.7
CACHE_WORDS = 1 << 18
#: What the allocation assumes: the part of a set's shingles that are frequent, the part of the sets that
#: a segment of frequent shingles meets, and how many bands hold most of the sets.
FREQUENT, MEETS, BANDS = 0.2, 0.02, 10
#: Shingles that this many of the sampled sets hold are frequent; so many at most are told apart. About
#: so many sets are sampled, and of a larger corpus one in so many, or what one sampled set holds would
#: be held by ever more others. No result depends on it, only the number of chance matches.
SEEN_IN, SAMPLED_SETS, SAMPLED_ONE_IN, FREQUENT_MOST = 3, 20_000, 24, 1_000_000
#: A larger candidate group is cut into blocks of about this many sets, and of this many shingles,
#: verified pair by pair: every set goes once to each of its group's blocks.
LARGEST_BLOCK = 2048
BLOCK_SHINGLES = 4_000_000
#: Of a block pair, about as many shingles as are compared at once.
COMPARED = 500_000
#: Bits of the broadcast bitmap that tells which documents may be in a candidate group (2 MB).
MARKS = 1 << 24
#: Signatures that a task packs at once, and that a range holds about at most.
PACKED, RANGE = 500_000, 2_000_000
#: Signatures of a range that are sorted at once, to be merged with the different ones kept so far.
STARRED = 500_000
#: A signature's bits that are compared inside a range.
SIGNATURE_BITS = 40

_M1, _M2, _M3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _M2
    x = (x ^ (x >> np.uint64(27))) * _M3
    return x ^ (x >> np.uint64(31))


class _WordHash(dict):
    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) >= CACHE_WORDS:
            self.clear()
        h = xxhash.xxh3_64_intdigest(word)
        if len(word) <= 64:
            self[word] = h
        return h


def shingles(text: bytes, cache: _WordHash, size: int) -> np.ndarray:
    """Ascending distinct shingle hashes of a text (UTF-8)."""
    words = text.lower().split()  # bytes: A-Z only, and the six separators
    h = np.fromiter(map(cache.__getitem__, words), np.uint64, len(words))
    if len(h) == 0:
        return h
    width = min(size, len(h))
    out = np.full(len(h) - width + 1, width, np.uint64)
    for k in range(width):
        out = _mix(out * _M1 + h[k: len(h) - width + 1 + k])
    return np.unique(out)


@functools.cache
def bands(largest: int) -> tuple[tuple[int, int], ...]:
    """(smallest, largest) sizes of the bands up to the one that holds ``largest``."""
    out, lo = [], 1
    while lo <= largest:
        hi = max(lo, math.ceil(lo * BAND) - 1)
        out.append((lo, hi))
        lo = hi + 1
    return tuple(out)


@functools.cache
def band_of(n: int) -> int:
    return next(k for k, (lo, hi) in enumerate(bands(2 * n + 2)) if lo <= n <= hi)


def _spares(h: int) -> list[int]:
    """Numbers of spare segments that are weighed for sets that differ in up to ``h`` shingles."""
    out = [0, 1, 2, 4, 8, 12, 16, 24, 32, 48, 64, 96, 128, 192, 256]
    while out[-1] < h:  # the weak segments of a long set are a part of all its segments
        out.append(2 * out[-2])
    return out


def _more_than(n: int, mean: float) -> float:
    """Probability that a Poisson variable exceeds ``n``; of long sums only the terms that count."""
    if mean <= 1e-12:
        return 0.0
    reach = 12 * math.sqrt(mean) + 30
    return max(0.0, 1 - sum(math.exp(-mean + k * math.log(mean) - math.lgamma(k + 1)) for k in range(max(0, int(mean - reach)), min(n, int(mean + reach)) + 1)))


@functools.cache
def allocate(hi: int, n_sets: int, part: int = PART, whole: int = WHOLE) -> tuple[int, int, int]:
    """(exact segments, one-deletion segments, spare) for pairs whose larger set has up to ``hi``.

    H = (|r| + |s|) (1 - t) / (1 + t) bounds the difference of a linked pair; exact + 2 * deletion
    = H + 1 + spare. Costs are signatures a set, plus the sets it is expected to meet for nothing: in
    exact segments without a rare shingle beyond the spare ones (a Poisson tail for the band's smaller
    sets), and in one-deletion segments of one rare shingle or none.
    """
    h = 2 * hi * (whole - part) // (whole + part)
    if h == 0:
        return 1, 0, 0
    best = None
    for spare in _spares(h):
        for deletion in {0, 1, 2, (h + 1) // 4, (h + 2) // 2}:
            exact = h + 1 + spare - 2 * deletion
            if exact < spare or exact + deletion < 1:
                continue
            m = exact + deletion
            z, rare = 0.85 * hi / m, 0.7 * (1 - FREQUENT) * hi / m
            weak = exact * math.exp(-rare)
            chance = _more_than(spare, weak) * max(1.0, math.sqrt(weak)) + deletion * (1 + rare) * math.exp(-rare)
            cost = exact + deletion * (z + 2) + n_sets * MEETS / BANDS * chance
            if best is None or cost < best[0]:
                best = (cost, exact, deletion, spare)
    return best[1:]


def signatures(s: np.ndarray, n_sets: int, part: int = PART, whole: int = WHOLE, frequent: np.ndarray | None = None) -> np.ndarray:
    """Signatures of a set: in its own band, and in the next one if a partner there is possible.
    ``frequent`` (ascending) are the shingles that do not make a segment strong."""
    n = len(s)
    if n == 0:
        return np.empty(0, np.uint64)
    own = band_of(n)
    lows = bands(2 * n + 2)
    out = []
    token, place = _mix(s + _M1), _mix(s ^ _M3) >> np.uint64(32)
    rare = np.ones(n, bool)
    if frequent is not None and len(frequent):
        rare = frequent[np.minimum(np.searchsorted(frequent, s), len(frequent) - 1)] != s
    for b in (own, own + 1):
        lo, hi = lows[b]
        if b > own and n * whole < part * lo:
            continue
        exact, deletion, spare = allocate(hi, n_sets, part, whole)
        m = exact + deletion
        seg = (place * np.uint64(m)) >> np.uint64(32)
        order = np.argsort(seg, kind="stable")
        seg, tok = seg[order], token[order]
        starts = np.flatnonzero(np.diff(seg, prepend=np.uint64(m)))
        sums, ids = np.add.reduceat(tok, starts), seg[starts]
        salt = _mix((np.arange(m, dtype=np.uint64) + np.uint64(1)) * _M1 + np.uint64((b + 1) * int(_M2) % 2**64))
        content = salt.copy()  # an empty segment's content is its number
        content[ids] ^= sums
        content = _mix(content)
        if spare:  # exact segments from the weakest on: few rare shingles, few shingles, then by content
            strong = np.bincount(seg[rare[order]].astype(np.int64), minlength=m)[deletion:]
            filled = np.bincount(seg.astype(np.int64), minlength=m)[deletion:]
            content[deletion:][np.lexsort((content[deletion:], filled, strong))[:spare]] = 0
        out.append(content[content != 0])
        if deletion:
            count = np.diff(np.append(starts, n))
            inside = seg < deletion
            rest = np.repeat(sums, count)[inside] - tok[inside]
            out.append(_mix(rest ^ salt[seg[inside]]))
    return np.unique(np.concatenate(out))


def class_of(s: np.ndarray) -> int:
    """Signed 64-bit class of a set."""
    return int(_mix(np.add.reduce(_mix(s * _M3 + _M2), keepdims=True) + np.uint64(len(s) * int(_M1) % 2**64)).view(np.int64)[0]) if len(s) else 0


def _forest(left: list[np.ndarray], right: list[np.ndarray] | None, part: int, whole: int) -> list[tuple[int, int]]:
    """A spanning forest of the links (positions in left + right); right None: inside left."""
    sets = left + (right or [])
    sizes = np.array([len(s) for s in sets], np.int64)
    a = len(left)
    inter = np.zeros((a, len(sets) - a if right is not None else a), np.float32)
    parts = max(1, -(-int(sizes.sum()) // COMPARED))  # the sets ascend: ranges of hashes, one at a time
    limits = np.arange(1, parts, dtype=np.uint64) * np.uint64(((1 << 64) - 1) // parts)
    cuts = np.array([[0, *np.searchsorted(s, limits).tolist(), len(s)] for s in sets])
    step = max(64, (1 << 22) // len(sets))
    for k in range(parts):
        low, high = cuts[:, k].tolist(), cuts[:, k + 1].tolist()
        _, token, count = np.unique(np.concatenate([s[i:j] for s, i, j in zip(sets, low, high)]), return_inverse=True, return_counts=True)
        owner = np.repeat(np.arange(len(sets)), cuts[:, k + 1] - cuts[:, k])
        shared = count > 1
        column = np.cumsum(shared) - 1
        use = shared[token]
        owner, token = owner[use], column[token[use]]
        n_columns = int(shared.sum())
        order = np.argsort(token, kind="stable")
        owner, token = owner[order], token[order]
        for at in range(0, n_columns, step):
            i, j = np.searchsorted(token, (at, at + step))
            m = np.zeros((len(sets), min(step, n_columns - at)), np.float32)
            m[owner[i:j], token[i:j] - at] = 1
            inter += m[:a] @ (m[a:] if right is not None else m).T
    others, first = (sizes[a:], a) if right is not None else (sizes, 0)
    parent = list(range(len(sets)))

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    out = []
    for x in range(a):
        both = inter[x].astype(np.int64)
        for y in np.flatnonzero(whole * both >= part * (sizes[x] + others - both)).tolist():
            p, q = find(x), find(y + first)
            if p != q:
                parent[max(p, q)] = min(p, q)
                out.append((x, y + first))
    return out


@functools.cache
def expected_signatures(n: int, n_sets: int, part: int = PART, whole: int = WHOLE) -> int:
    """About as many signatures as a set of ``n`` shingles gets."""
    if n == 0:
        return 0
    exact, deletion, _ = allocate(bands(2 * n + 2)[band_of(n)][1], n_sets, part, whole)
    return 2 * (exact + 2 * deletion) + n


def shingle_classes(docs: DataFrame, size: int = WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Stored rows doc_id, th (hash of the text), n (set size), v (class) and, of the sampled classes,
    some (their shingles) of every row."""
    every = max(1, min(docs.count() // SAMPLED_SETS, SAMPLED_ONE_IN))
    text = F.coalesce(F.col(text_col), F.lit(""))
    slim = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text).alias("th"), text.cast("binary").alias("t"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        C.release()
        cache = _WordHash()
        for b in batches:
            n, v, some = [], [], []
            for t in b.column(2):
                s = shingles(t.as_py(), cache, size)
                n.append(len(s)), v.append(class_of(s))
                some.append(s.view(np.int64) if v[-1] % every == 0 else None)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(n, pa.int64()), pa.array(v, pa.int64()), pa.array(some, pa.list_(pa.int64()))], ["doc_id", "th", "n", "v", "some"])

    return C.stored(slim.mapInArrow(run, slim.drop("t").schema.add("n", "long").add("v", "long").add("some", T.ArrayType(T.LongType()))), "classes")


def frequent_shingles(classes: DataFrame) -> np.ndarray:
    """Ascending shingles of several sampled classes, the most frequent if they are many."""
    held = classes.filter(F.col("some").isNotNull()).groupBy("v").agg(F.first("some").alias("some")).select(F.explode("some").alias("s"))
    found = held.groupBy("s").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= SEEN_IN).orderBy(F.desc("n"), "s").limit(FREQUENT_MOST).select("s")
    return np.sort(C.stored(found, "frequent").toPandas()["s"].to_numpy(np.int64).view(np.uint64))


def pack(sigs: np.ndarray, owner: np.ndarray, classes: np.ndarray, ranges: int) -> Iterator[tuple[int, bytes, bytes]]:
    """(range, signatures, classes) of signatures and the positions of their classes. A range's
    signatures are sorted and kept as 32-bit differences (a larger one passes over several)."""
    order = np.argsort(sigs)
    sigs, owner = sigs[order], owner[order]
    width = np.uint64((1 << 64) // ranges + 1 if ranges > 1 else (1 << 64) - 1)
    own = np.minimum(sigs // width, np.uint64(ranges - 1)).astype(np.int64)
    cuts = np.flatnonzero(np.diff(own, prepend=-1, append=ranges))
    shift = np.uint64(64 - SIGNATURE_BITS)
    scaled = ((sigs - own.astype(np.uint64) * width) * np.uint64(min(max(1, ranges - 1), 1 << (64 - SIGNATURE_BITS)))) >> shift
    for i, j in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
        steps = np.diff(scaled[i:j], prepend=np.uint64(0))
        over = np.flatnonzero(steps >> np.uint64(32))
        who = owner[i:j]
        if len(over):  # steps of 2^32 - 1 that carry no signature: class 2^32 - 1
            n = (steps[over] // np.uint64(0xFFFFFFFF)).astype(np.int64)
            steps[over] -= n.astype(np.uint64) * np.uint64(0xFFFFFFFF)
            steps, who = np.insert(steps, np.repeat(over, n), 0xFFFFFFFF), np.insert(who, np.repeat(over, n), 0xFFFFFFFF)
        names, place = np.unique(who[who != 0xFFFFFFFF], return_inverse=True)
        short = np.full(len(who), len(names), np.int64)
        short[who != 0xFFFFFFFF] = place
        kind = np.uint16 if len(names) < 1 << 16 else np.uint32
        head = np.array([len(names), np.dtype(kind).itemsize], np.int64).tobytes()
        yield int(own[i]), steps.astype(np.uint32).tobytes(), head + classes[names].astype(np.int64).tobytes() + short.astype(kind).tobytes()


def unpack(steps: bytes, who: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Signatures (in their range) and classes of one packed row."""
    n, width = np.frombuffer(who, np.int64, 2).tolist()
    names = np.append(np.frombuffer(who, np.int64, n, 16), 0)
    short = np.frombuffer(who, np.uint16 if width == 2 else np.uint32, -1, 16 + 8 * n)
    sig = np.cumsum(np.frombuffer(steps, np.uint32).astype(np.uint64))
    real = short < n
    return sig[real], names[short[real]]


def star(kept: tuple[np.ndarray, np.ndarray], more: list[tuple[np.ndarray, np.ndarray]]) -> tuple[tuple[np.ndarray, np.ndarray], np.ndarray]:
    """Signatures with one class each, after some more; and the (class, that class) pairs met."""
    if not more:
        return kept, np.empty((0, 2), np.int64)
    sig = np.concatenate([s for s, _ in more])
    v = np.concatenate([v for _, v in more])
    order = np.argsort(sig, kind="stable")
    sig, v = sig[order], v[order]
    first = np.diff(sig, prepend=~sig[:1] if len(sig) else 0) != 0
    top = v[np.maximum.accumulate(np.where(first, np.arange(len(sig)), 0))] if len(sig) else v
    at = np.searchsorted(kept[0], sig)
    if len(kept[0]):  # a signature kept before has its class already
        near = np.minimum(at, len(kept[0]) - 1)
        known = kept[0][near] == sig
        top[known] = kept[1][near[known]]
        first &= ~known
    use = v != top
    pairs = np.unique(np.stack((v[use], top[use]), axis=1), axis=0)
    return (np.insert(kept[0], at[first], sig[first]), np.insert(kept[1], at[first], v[first])), pairs


def candidate_edges(docs: DataFrame, classes: DataFrame, size: int, part: int, whole: int, id_col: str, text_col: str) -> DataFrame:
    """(a, b): pairs of classes that share a signature, a star for each signature."""
    n_sets = max(1, classes.count())
    by_size = classes.groupBy("n").agg(F.count(F.lit(1)).alias("sets"))
    total = 0
    for row in by_size.toLocalIterator():  # one row for each set size
        total += row["sets"] * expected_signatures(row["n"], n_sets, part, whole)
    ranges = max(1, -(-total // RANGE))
    frequent = classes.sparkSession.sparkContext.broadcast(frequent_shingles(classes))  # FREQUENT_MOST numbers at most
    slim = docs.filter(F.col(id_col).isNotNull() & F.col(text_col).isNotNull()).select(F.col(text_col).cast("binary").alias("t"))

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        C.release()
        cache, seen, names, sigs = _WordHash(), set(), [], []

        def flush() -> pa.RecordBatch:
            sizes = [len(s) for s in sigs]
            rows = list(pack(np.concatenate(sigs), np.repeat(np.arange(len(names)), sizes), np.array(names, np.int64), ranges))
            names.clear(), sigs.clear()
            return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.int64(), pa.binary(), pa.binary()))], ["r", "steps", "who"])

        held = 0
        for b in batches:
            for t in b.column(0):
                s = shingles(t.as_py(), cache, size)
                v = class_of(s)
                if len(s) == 0 or v in seen:
                    continue
                if len(seen) >= CACHE_WORDS:  # a copy that comes later is packed again
                    seen.clear()
                seen.add(v)
                names.append(v), sigs.append(signatures(s, n_sets, part, whole, frequent.value))
                held += len(sigs[-1])
                if held >= PACKED:
                    yield flush()
                    held = 0
        if sigs:
            yield flush()

    def starred(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        C.release()
        nothing = (np.empty(0, np.uint64), np.empty(0, np.int64))
        at, kept, more, held = None, nothing, [], 0

        def reduced() -> pa.RecordBatch:
            nonlocal kept, held
            kept, pairs = star(kept, more)
            more.clear()
            held = 0
            return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0], pa.int64()), pa.array(pairs[:, 1], pa.int64())], ["a", "b"])

        for b in batches:
            for r, steps, who in zip(b.column(0).to_pylist(), b.column(1), b.column(2)):
                if r != at:
                    if more:
                        yield reduced()
                    at, kept = r, nothing
                more.append(unpack(steps.as_py(), who.as_py()))
                held += len(more[-1][0])
                if held >= STARRED:
                    yield reduced()
        if more:
            yield reduced()

    rows = slim.mapInArrow(packed, "r long, steps binary, who binary")
    return rows.repartition(min(ranges, 100_000), "r").sortWithinPartitions("r").mapInArrow(starred, "a long, b long").distinct()


def _slot(doc_id: F.Column) -> F.Column:
    return F.pmod(F.xxhash64(doc_id), F.lit(MARKS)).cast("int")


def _word_and_bit(doc_id: F.Column) -> tuple[F.Column, F.Column]:
    slot = _slot(doc_id)
    return F.floor(slot / 64).cast("int"), F.call_function("shiftleft", F.lit(1).cast("long"), slot % 64)


def _words(ids: DataFrame) -> DataFrame:
    """(word, bits): the words with a bit of the bitmap (``MARKS`` bits) of the slots that the ids (_id) fall into."""
    word, bit = _word_and_bit(F.col("_id"))
    return ids.select(word.alias("word"), bit.alias("bit")).groupBy("word").agg(F.bit_or("bit").alias("bits"))


def with_mark(docs: DataFrame, ids: DataFrame, name: str, id_col: str = "doc_id") -> DataFrame:
    """``docs`` with a column that is false where the row's id is null or none of the ids (_id), and true
    where it is one of them (and by chance elsewhere). What is sent out is the bitmap, not the ids."""
    word, bit = _word_and_bit(F.col(id_col))
    w, b = C.fresh([*docs.columns, name], "word", "bits")
    found = docs.join(F.broadcast(_words(ids).select(F.col("word").alias(w), F.col("bits").alias(b))), word == F.col(w), "left")
    return found.withColumn(name, F.col(id_col).isNotNull() & (F.coalesce(F.col(b), F.lit(0)).bitwiseAND(bit) != 0)).drop(w, b)


def _marks(ids: DataFrame) -> np.ndarray:
    """That bitmap."""
    found = _words(ids).toPandas()
    out = np.zeros(MARKS // 64, np.uint64)
    out[found["word"].to_numpy(np.int64)] = found["bits"].to_numpy(np.int64).view(np.uint64)
    return out.view(np.uint8)


def _verified(docs: DataFrame, classes: DataFrame, groups: DataFrame, size: int, part: int, whole: int, id_col: str, text_col: str) -> DataFrame:
    """(a, b): a spanning forest of the links inside the candidate groups (node, root)."""
    member = groups.union(groups.select(F.col("root").alias("node"), "root").distinct())
    one = classes.filter(F.col("doc_id").isNotNull() & (F.col("n") > 0)).groupBy("v").agg(F.min("doc_id").alias("_id"), F.max("n").alias("n"))
    known = C.stored(one.join(member.withColumnRenamed("node", "v"), "v"), "members")
    sizes = known.groupBy("root").agg(F.greatest(F.ceil(F.count(F.lit(1)) / LARGEST_BLOCK), F.ceil(F.sum("n") / BLOCK_SHINGLES)).cast("int").alias("blocks"))
    need = C.stored(known.join(sizes, "root").select("_id", "v", "root", "blocks"), "need")
    wanted = docs.sparkSession.sparkContext.broadcast(_marks(need.select("_id")))
    slim = docs.select(F.col(id_col).alias("_id"), _slot(F.col(id_col)).alias("slot"), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("t"))

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        C.release()
        cache, marks = _WordHash(), np.unpackbits(wanted.value, bitorder="little")
        for b in batches:
            b = b.filter(pa.array(marks[b.column(1).to_numpy()] == 1)) if b.num_rows else b
            own = [shingles(x.as_py(), cache, size) for x in b.column(2)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([class_of(s) for s in own], pa.int64()), pa.array([s.tobytes() for s in own], pa.binary())], ["_id", "v", "s"])

    # most documents are in no candidate group: their sets are not made, and no text is shuffled
    made = slim.filter(F.col("_id").isNotNull()).mapInArrow(sets, T.StructType([slim.schema["_id"]]).add("v", "long").add("s", "binary"))
    made = made.join(need, ["_id", "v"]).select("v", "root", "blocks", "s")  # v: not another text of the same id
    block = F.pmod(F.xxhash64("v"), F.col("blocks")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    dealt = (made.withColumn("own", block).withColumn("other", other)
             .select("root", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "v", "s")
             .repartition("root", "i", "j").sortWithinPartitions("root", "i", "j", "v"))

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def links(key: tuple, rows: list[tuple]) -> list[tuple[int, int]]:
            seen = {r[1]: r for r in rows}  # a class once
            lists: tuple[list, list] = ([], [])
            for own, v, s in seen.values():
                lists[0 if own == key[1] else 1].append((v, np.frombuffer(s, np.uint64)))
            left, right = lists if key[1] != key[2] else (lists[0], None)
            if not left or right == [] or (right is None and len(left) < 2):
                return []
            names = [v for v, _ in left] + [v for v, _ in right or []]
            found = _forest([s for _, s in left], None if right is None else [s for _, s in right], part, whole)
            return [(names[x], names[y]) for x, y in found]

        C.release()
        key, rows, out = None, [], []
        for b in batches:
            root, i, j, own, v, s = (b.column(k) for k in range(6))
            for k, at in enumerate(zip(root.to_pylist(), i.to_pylist(), j.to_pylist())):
                if at != key:
                    if key is not None:
                        out += links(key, rows)
                    key, rows = at, []
                rows.append((own[k].as_py(), v[k].as_py(), s[k].as_py()))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.int64()), pa.array([x[1] for x in out], pa.int64())], ["a", "b"])
                out = []
        if key is not None and (out := links(key, rows)):
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.int64()), pa.array([x[1] for x in out], pa.int64())], ["a", "b"])

    return dealt.mapInArrow(verify, "a long, b long")


def join_components(docs: DataFrame, size: int = WORDS, part: int = PART, whole: int = WHOLE, id_col: str = "doc_id", text_col: str = "text",
                    with_hash: bool = False) -> DataFrame:
    """doc_id, n_shingles, component_id of every row; ``with_hash`` also text_hash (xxhash64 of the text)."""
    with C.small_batches(docs.sparkSession):  # all of these are stored
        classes = shingle_classes(docs, size, id_col, text_col)
        groups = components(candidate_edges(docs, classes, size, part, whole, id_col, text_col))
        linked = components(_verified(docs, classes, groups, size, part, whole, id_col, text_col))
    rows = classes.select("doc_id", "th", "n", "v")
    least = rows.filter(F.col("doc_id").isNotNull() & (F.col("n") > 0)).groupBy("v").agg(F.min("doc_id").alias("d"))
    rooted = least.join(linked.withColumnRenamed("node", "v"), "v", "left").withColumn("root", F.coalesce("root", "v"))
    names = rooted.groupBy("root").agg(F.min("d").alias("component_id"))
    of_class = rooted.select("v", "root").join(names, "root").select("v", "component_id")
    return rows.join(of_class, "v", "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("doc_id").isNull(), F.lit(None)).when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
        *([F.col("th").alias("text_hash")] if with_hash else []))
