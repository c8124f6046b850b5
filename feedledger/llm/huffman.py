"""Token ids in Huffman-coded block files.

``tokenize`` turns every text into ids with the tokenizers library and stores them compressed,
each task adding its id counts; ``write`` makes one canonical length-limited code from the global
counts (package-merge; at most vocabulary-size numbers on the driver), range-partitions the
documents by id and codes each partition as a sequence of independent blocks; ``read`` decodes the
files with one table look-up an id, all checkpoints of a segment side by side.

File format (a folder, written and committed by Spark's Parquet writer, so it can be on any store):
``codes`` has (id, length), from which the canonical code follows; ``blocks`` has a row per block:
shard, start_in_shard, doc_ids and n_tokens of its whole documents, and per segment of at most
``SEGMENT`` ids the number of ids, the bytes, and the bit offset of every ``STEP``-th id; payload.

Cases: null or empty text: only the end id; rows are ordered by id, then length, then content, so
repeated rows and ids have a defined place (null ids come first); a document longer than a segment
spans several segments of its block; an empty table gives an empty folder and an empty result;
extra columns are ignored.
"""

from __future__ import annotations

import gc
import re
import string
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common as C

#: Longest code; a decoding table has 2**MAX_BITS entries.
MAX_BITS = 20
SEGMENT = 1 << 18
STEP = 256
#: A block is closed when it holds this many ids.
BLOCK = 1 << 18
CACHE_WORDS = 250_000
#: Bytes of a text that is taken by itself.
LONG_TEXT = 4 << 20
#: Few ids as little-endian unsigned 32-bit integers.
_U32 = [struct.Struct(f"<{n}I").pack for n in range(9)]


# -- code ------------------------------------------------------------------------------------------
def code_lengths(counts: np.ndarray, max_bits: int = MAX_BITS) -> np.ndarray:
    """Optimal code lengths of at most ``max_bits`` for positive counts (package-merge)."""
    n = len(counts)
    if n < 2:
        return np.ones(n, np.int64)
    order = np.argsort(counts, kind="stable")
    leaves = counts[order].astype(np.int64)
    row, is_leaf = leaves, [np.ones(n, bool)]
    for _ in range(max_bits - 1):
        pairs = row[: len(row) // 2 * 2].reshape(-1, 2).sum(axis=1)
        both = np.concatenate([leaves, pairs])
        by = np.argsort(both, kind="stable")
        row = both[by]
        is_leaf.append(by < n)
    lengths, take = np.zeros(n, np.int64), 2 * n - 2
    for level in reversed(is_leaf):
        used = int(level[:take].sum())
        lengths[:used] += 1
        take = 2 * (take - used)
    out = np.empty(n, np.int64)
    out[order] = lengths
    return out


class Code:
    """The canonical code of (ids, lengths): codes ascend by length, then id."""

    def __init__(self, ids: np.ndarray, lengths: np.ndarray):
        by = np.lexsort((ids, lengths))
        self.ids, self.lengths = ids[by].astype(np.int64), lengths[by].astype(np.int64)
        self.bits = int(self.lengths.max()) if len(ids) else 1
        size = np.int64(1) << (self.bits - self.lengths)
        self.first = np.cumsum(size) - size  # as a number of ``bits`` bits

    def encoder(self) -> tuple[np.ndarray, np.ndarray]:
        n = int(self.ids.max()) + 1 if len(self.ids) else 0
        codes, lengths = np.zeros(n, np.uint64), np.zeros(n, np.int64)
        codes[self.ids] = (self.first >> (self.bits - self.lengths)).astype(np.uint64)
        lengths[self.ids] = self.lengths
        return codes, lengths

    def table(self) -> tuple[np.ndarray, np.ndarray]:
        size = np.int64(1) << (self.bits - self.lengths)
        rest = (1 << self.bits) - int(size.sum())
        return (np.append(np.repeat(self.ids, size), np.zeros(rest, np.int64)).astype(np.uint32),
                np.append(np.repeat(self.lengths, size), np.ones(rest, np.int64)).astype(np.int64))


def pack(ids: np.ndarray, encoder: tuple[np.ndarray, np.ndarray]) -> tuple[bytes, np.ndarray]:
    """Coded ids (most significant bit first, whole bytes) and the bit offset of every STEP-th id."""
    codes, lengths = encoder[0][ids], encoder[1][ids]
    ends = np.cumsum(lengths)
    offsets = ends - lengths
    total = int(ends[-1])
    word, room = offsets >> 6, 64 - (offsets & 63) - lengths
    over = room < 0
    head = np.where(over, codes >> np.maximum(-room, 0).astype(np.uint64), codes << np.maximum(room, 0).astype(np.uint64))
    out = np.zeros((total >> 6) + 2, np.uint64)
    starts = np.flatnonzero(np.diff(word, prepend=-1))
    out[word[starts]] = np.add.reduceat(head, starts)  # codes do not overlap: a sum is a union
    out[word[over] + 1] |= codes[over] << (64 + room[over]).astype(np.uint64)  # one code a word at most goes over
    return out.astype(">u8").tobytes()[: (total + 7) // 8], offsets[::STEP]


def unpack(raw: bytes, n: int, offsets: np.ndarray, table: tuple[np.ndarray, np.ndarray], bits: int) -> np.ndarray:
    """``n`` ids; all checkpoints advance together, one id a step."""
    b = np.frombuffer(raw + bytes(STEP * 4 + 8), np.uint8).astype(np.uint32)
    window = (b[:-3] << 24) | (b[1:-2] << 16) | (b[2:-1] << 8) | b[3:]
    symbol, length = table
    at, last = offsets.astype(np.int64), len(window) - 1
    out = np.empty((STEP, len(at)), np.uint32)
    mask = np.uint32((1 << bits) - 1)
    for k in range(STEP):
        v = (window[np.minimum(at >> 3, last)] >> (32 - bits - (at & 7)).astype(np.uint32)) & mask
        out[k] = symbol[v]
        at = at + length[v]
    return out.T.reshape(-1)[:n]


# -- ids -------------------------------------------------------------------------------------------
class Tokens:
    """Ids of texts through the tokenizers library, word by word.

    The tokenizer drops white space and works on each stretch between it alone, so a text's ids are
    those of its words in turn. Words are remembered in two bounded generations. A plain word (Latin
    letters, then closing marks) is one piece of letters and one of marks: each goes straight to the
    library's merge model; every other word takes the whole tokenizer, many in one call. The words of
    several texts are told apart together, and each different one is looked up once: those of ASCII letters
    and closing marks by their pieces alone, the others as words.
    """

    MARKS = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
    PLAIN = re.compile(r"([a-zß-öø-ÿ]+)([%s]*)" % re.escape(MARKS.decode())).fullmatch

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        self.whole = Tokenizer.from_file(path)
        self.model = self.whole.model
        shown = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.shown = {b: shown.pre_tokenize_str(chr(b))[0][0][-1] for b in range(33, 127)}
        for b in range(128, 256):  # the last byte of the two-byte letters, then their first bytes
            lead, tail = (0xC2 if b < 0xC0 else 0xC3), (b if b < 0xC0 else b - 0x40)
            s = shown.pre_tokenize_str(bytes([lead, tail]).decode())[0][0]
            self.shown[tail], self.shown[lead] = s[1], s[0]
        self.same = all(self.shown[b] == chr(b) for b in b"abcdefghijklmnopqrstuvwxyz" + self.MARKS)
        self.plain_ok = all(self._model_ids(w) == self.whole.encode(w, add_special_tokens=False).ids
                            for w in ("the", "a", "größe", "émenté", "ciónñ", ".", ",,", "!?", "über", "ÿß", self.MARKS.decode(), *map(chr, self.MARKS)))
        self.recent: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}
        self.pieces: dict[bytes, bytes] = {}
        self.older_pieces: dict[bytes, bytes] = {}

    def _model_ids(self, piece: str) -> list[int]:
        if not (self.same and piece.isascii()):  # ASCII letters and marks are shown as themselves
            piece = "".join([self.shown[b] for b in piece.encode()])
        return [t.id for t in self.model.tokenize(piece)]

    def _piece(self, piece: bytes) -> bytes:
        ids = self.pieces.get(piece)
        if ids is None:
            if len(self.pieces) >= CACHE_WORDS:
                self.older_pieces, self.pieces = self.pieces, {}
            ids = self.older_pieces.get(piece)
            if ids is None:
                found = self._model_ids(piece.decode())
                ids = _U32[len(found)](*found) if len(found) < len(_U32) else np.array(found, "<u4").tobytes()
            self.pieces[piece] = ids
        return ids

    def _whole(self, words: list[bytes]) -> Iterator[bytes]:
        """Ids of words, each by itself, through the whole tokenizer."""
        found = self.whole.encode([w.decode() for w in words], is_pretokenized=True, add_special_tokens=False)
        ids, cuts = np.array(found.ids, "<u4"), np.searchsorted(np.array(found.word_ids, np.int64), np.arange(len(words) + 1)).tolist()
        for i, j in zip(cuts, cuts[1:]):
            yield ids[i:j].tobytes()

    def _learn(self, new: list[bytes]) -> None:
        """Put words into the recent generation."""
        recent, older, piece, others = self.recent, self.older.get, self._piece, []
        marks = self.MARKS
        for word in new:
            ids = older(word)
            if ids is None:
                if not self.plain_ok or len(word) > 64:
                    others.append(word)
                    continue
                letters = word.rstrip(marks)
                if letters.isalpha():  # most words: ASCII letters, then marks or none
                    ids = piece(letters.lower())
                    if len(letters) < len(word):
                        ids += piece(word[len(letters):])
                elif plain := self.PLAIN(word.decode().lower()):
                    ids = piece(plain[1].encode())
                    if plain[2]:
                        ids += piece(plain[2].encode())
                else:
                    others.append(word)
                    continue
            recent[word] = ids
        if others:
            recent.update(zip(others, self._whole(others)))

    def _lowered(self, text: bytes) -> bytes:
        # the tokenizer lower-cases: done first for A-Z, unless a special token's string or a mark
        # that combines with a letter (U+0300 to U+036F, lead bytes CC and CD) may be in the text
        if b"<|" not in text and b"\xcc" not in text and b"\xcd" not in text:
            return text.lower()
        return text

    def _known(self, words: list[bytes]) -> list[bytes]:
        """The ids of different words."""
        if len(self.recent) >= CACHE_WORDS:
            self.older, self.recent = self.recent, {}
        recent = self.recent
        ids = list(map(recent.get, words))
        new = [i for i, x in enumerate(ids) if x is None]
        if new:
            self._learn([words[i] for i in new])
            for i in new:
                word = words[i]
                ids[i] = recent[word] if len(word) <= 64 else recent.pop(word)  # very long words are not remembered
        return ids

    def _pieces(self, column: pa.Array) -> pa.Array:
        """The ids of each piece of a column, every different one looked up once."""
        coded = column.dictionary_encode()
        names = coded.dictionary.view(pa.binary()).to_pylist()
        found = list(map(self.pieces.get, names))
        for i in [i for i, ids in enumerate(found) if ids is None]:
            found[i] = self._piece(names[i])
        return pa.array(found, pa.large_binary()).take(coded.indices)

    def _together(self, texts: list[bytes]) -> Iterator[bytes]:
        bounds, which, names = C.distinct_words(pa.array(texts, pa.binary()), lower=False)
        if not len(names):
            yield from [b""] * len(texts)
            return
        letters = pc.ascii_rtrim(names, characters=self.MARKS.decode())
        simple = pc.and_(pc.ascii_is_alpha(letters), pc.less_equal(pc.binary_length(names), 64)).to_numpy(zero_copy_only=False)
        if not self.plain_ok:
            simple[:] = False
        # ASCII letters, then marks or none: most words
        kept = pa.array(simple)
        head, tail = self._pieces(pc.ascii_lower(letters.filter(kept))), self._pieces(pc.ascii_ltrim(names.filter(kept), characters=string.ascii_letters))
        others = self._known(names.filter(pa.array(~simple)).view(pa.binary()).to_pylist())
        every = pa.concat_arrays([pc.binary_join_element_wise(head, tail, pa.scalar(b"", pa.large_binary())), pa.array(others, pa.large_binary())])
        place = np.empty(len(names), np.int64)
        place[simple], place[~simple] = np.arange(len(head)), np.arange(len(head), len(names))
        ids = every.take(pa.array(place[which]))
        at = np.frombuffer(ids.buffers()[1], np.int64)[ids.offset:][bounds].tolist()
        flat = memoryview(ids.buffers()[2] or b"")
        for i, j in zip(at, at[1:]):
            yield bytes(flat[i:j])

    def encode(self, text: bytes) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        return self.encode_all([text])[0]

    def encode_all(self, texts: list[bytes]) -> list[bytes]:
        """``encode`` of each; new words make many small objects but no cycles, so none are looked for."""
        was = gc.isenabled()
        gc.disable()
        try:
            out, held, size = [], [], 0
            for text in map(self._lowered, texts):
                if len(text) > LONG_TEXT:  # by itself, in parts that end between words
                    out += self._together(held)
                    words = text.split()
                    out.append(b"".join([ids for k in range(0, len(words), CACHE_WORDS) for ids in self._together([b" ".join(words[k: k + CACHE_WORDS])])]))
                    held, size = [], 0
                    continue
                held.append(text)
                size += len(text)
                if size >= C.SLICE_BYTES:
                    out += self._together(held)
                    held, size = [], 0
            out += self._together(held)
            return out
        finally:
            if was:
                gc.enable()


def tokens(path: str) -> Tokens:
    return C.kept(("words", path), lambda: Tokens(path))


def tokenize(docs: DataFrame, path: str, end_id: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Stored rows doc_id, n, ids (zstandard of little-endian unsigned 32-bit ids, end id included);
    and per task one row with n null whose ids are (id, count) pairs of unsigned 64-bit integers."""
    import zstandard

    slim = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("t"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, squeeze, end = tokens(path), zstandard.ZstdCompressor(level=1).compress, int(end_id).to_bytes(4, "little")
        total, kind = np.zeros(1, np.int64), None
        for b in batches:
            kind = b.schema.field(0).type
            for at in range(0, b.num_rows, 1024):
                ids = [x + end for x in own.encode_all([t.as_py() for t in b.column(1).slice(at, 1024)])]
                counts = np.bincount(np.frombuffer(b"".join(ids), "<u4"))
                total = np.pad(total, (0, max(0, len(counts) - len(total))))
                total[: len(counts)] += counts
                yield pa.RecordBatch.from_arrays([b.column(0).slice(at, 1024), pa.array([len(x) // 4 for x in ids], pa.int64()),
                                                  pa.array([squeeze(x) for x in ids], pa.binary())], ["doc_id", "n", "ids"])
        if kind is not None:
            seen = np.flatnonzero(total)
            pairs = np.column_stack([seen, total[seen]]).astype("<u8").tobytes()
            yield pa.RecordBatch.from_arrays([pa.nulls(1, kind), pa.nulls(1, pa.int64()), pa.array([squeeze(pairs)], pa.binary())], ["doc_id", "n", "ids"])

    return C.stored(slim.mapInArrow(run, slim.drop("t").schema.add("n", "long").add("ids", "binary")), "ids")


def global_counts(stored_ids: DataFrame) -> DataFrame:
    """(id, n) over all documents, from the tasks' counts."""
    import zstandard

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for raw in b.column(0):
                pairs = np.frombuffer(zstandard.decompress(raw.as_py()), "<u8").reshape(-1, 2).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["id", "n"])

    rows = stored_ids.filter(F.col("n").isNull()).select("ids").mapInArrow(run, "id long, n long")
    return rows.groupBy("id").agg(F.sum("n").alias("n"))


BLOCK_SCHEMA = ("shard int, start_in_shard long, doc_ids array<{id}>, n_tokens array<long>, seg_ids array<int>, "
                "seg_bytes array<int>, seg_steps array<int>, steps binary, payload binary")


def write(stored_ids: DataFrame, folder: str) -> None:
    """Code the documents of ``tokenize`` into the folder."""
    spark = stored_ids.sparkSession
    counts = sorted((r["id"], r["n"]) for r in global_counts(stored_ids).collect())  # vocabulary size at most
    ids, n = np.array([c[0] for c in counts], np.int64), np.array([c[1] for c in counts], np.int64)
    lengths = code_lengths(n, max(MAX_BITS, int(len(n)).bit_length()))
    spark.createDataFrame([(int(i), int(x)) for i, x in zip(ids, lengths)], "id long, length int").coalesce(1).write.parquet(f"{folder}/codes")
    shared = spark.sparkContext.broadcast((ids, lengths))
    rows = stored_ids.filter(F.col("n").isNotNull())
    keys = ["doc_id", "n", F.xxhash64("ids")]
    ordered = rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
    id_type = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard
        from pyspark import TaskContext

        encoder, shard = Code(*shared.value).encoder(), TaskContext.get().partitionId()
        names, held, parts, start = [], [], [], 0
        expand, kind = zstandard.ZstdDecompressor().decompress, None

        def block() -> pa.RecordBatch:
            flat = np.concatenate(parts)
            seg_ids, seg_bytes, seg_steps, steps, payload = [], [], [], [], []
            for at in range(0, len(flat), SEGMENT):
                own = flat[at: at + SEGMENT]
                raw, offsets = pack(own, encoder)
                seg_ids.append(len(own)), seg_bytes.append(len(raw)), seg_steps.append(len(offsets))
                steps.append(offsets.astype("<u4").tobytes()), payload.append(raw)
            cols = [pa.array([shard], pa.int32()), pa.array([start], pa.int64()), pa.array([names], pa.list_(kind)), pa.array([held], pa.list_(pa.int64())),
                    *(pa.array([x], pa.list_(pa.int32())) for x in (seg_ids, seg_bytes, seg_steps)),
                    pa.array([b"".join(steps)], pa.binary()), pa.array([b"".join(payload)], pa.binary())]
            return pa.RecordBatch.from_arrays(cols, ["shard", "start_in_shard", "doc_ids", "n_tokens", "seg_ids", "seg_bytes", "seg_steps", "steps", "payload"])

        for b in batches:
            kind = b.schema.field(0).type
            for doc, raw in zip(b.column(0).to_pylist(), b.column(2)):
                own = np.frombuffer(expand(raw.as_py()), "<u4")
                names.append(doc), held.append(len(own)), parts.append(own)
                if (size := sum(held)) >= BLOCK:
                    yield block()
                    names, held, parts, start = [], [], [], start + size
        if names:
            yield block()

    ordered.mapInArrow(run, BLOCK_SCHEMA.format(id=id_type)).write.option("compression", "none").parquet(f"{folder}/blocks")


def read(spark: SparkSession, folder: str, digest: bool = False) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens and ids array<int>; with ``digest``
    ids_crc32 (of the ids as little-endian unsigned 32-bit integers) in place of the ids."""
    blocks = spark.read.parquet(f"{folder}/blocks")
    codes = spark.read.parquet(f"{folder}/codes").collect()  # vocabulary size at most
    shared = spark.sparkContext.broadcast((np.array([r["id"] for r in codes], np.int64), np.array([r["length"] for r in codes], np.int64)))
    from pyspark.sql import Window

    sizes = blocks.select("shard", F.aggregate("n_tokens", F.lit(0).cast("long"), lambda a, x: a + x).alias("n")).groupBy("shard").agg(F.sum("n").alias("n"))
    before = sizes.select("shard", F.coalesce(F.sum("n").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("base"))
    placed = blocks.join(F.broadcast(before), "shard").withColumn("start", F.col("base") + F.col("start_in_shard"))  # a row for each file
    slim = placed.select("start", "doc_ids", "n_tokens", "seg_ids", "seg_bytes", "seg_steps", "steps", "payload")
    id_type = blocks.schema["doc_ids"].dataType.elementType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = Code(*shared.value)
        table = code.table()
        for b in batches:
            for k in range(b.num_rows):
                start, _, n_tokens, seg_ids, seg_bytes, seg_steps, steps, payload = (b.column(c)[k].as_py() for c in range(8))
                steps, at, done, parts = np.frombuffer(steps, "<u4"), 0, 0, []
                for n, size, m in zip(seg_ids, seg_bytes, seg_steps):
                    parts.append(unpack(payload[at: at + size], n, steps[done: done + m], table, code.bits))
                    at, done = at + size, done + m
                flat = np.concatenate(parts).astype("<u4")
                n = np.array(n_tokens, np.int64)
                ends = np.cumsum(n)
                own = [flat[e - x: e] for e, x in zip(ends, n)]
                last = pa.array([zlib.crc32(x.tobytes()) for x in own], pa.int64()) if digest else pa.array([x.astype(np.int32) for x in own], pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([b.column(1)[k].values, pa.array(start + ends - n), pa.array(n), last],
                                                 ["doc_id", "start", "n_tokens", "ids_crc32" if digest else "ids"])

    return slim.mapInArrow(run, f"doc_id {id_type}, start long, n_tokens long, " + ("ids_crc32 long" if digest else "ids array<int>"))


def write_corpus(docs: DataFrame, path: str, end_id: int, folder: str) -> None:
    write(tokenize(docs, path, end_id), folder)
