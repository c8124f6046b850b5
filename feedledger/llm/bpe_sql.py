"""Byte-level BPE by recursive SQL.

Spark deals the documents out; each task opens one in-memory DuckDB with the vocabulary and the
merge table (every split of a vocabulary entry into two entries, ranked by the entry's id). A text
is cut by the split pattern; the distinct pieces a task has not met yet are encoded together by one
recursive query over a row a piece, its tokens and the ranks of its neighbouring pairs: each round contracts the
leftmost pair of least rank in every piece and joins the two new pairs with the merge table; a piece without
a pair is at its fixpoint and leaves the recursion. Pieces of more than ``LONG_BYTES`` bytes, whose every round
would be kept, go through the same recursion over token-position rows keyed by (piece, position), which are changed
in place (the right row of a contracted pair becomes -1).
Decoding joins the ids with the vocabulary and concatenates in position order.

Memory is bounded: pieces go in chunks of ``CHUNK_BYTES``, decoding in chunks of ``CHUNK_IDS`` ids,
remembered pieces in two generations (``CACHE_PIECES``, or fewer where
the memory is shared; about 230 bytes a piece), and the database may not spill.

Cases: null or empty text gives no ids and decodes to no bytes; texts longer than a chunk are
decoded in parts; special tokens do not exist (their strings are ordinary text); repeated rows and
extra columns need no care (the functions return their own columns).
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common as C

CHUNK_BYTES = 200_000
#: Longest piece whose rounds are kept until the query ends.
LONG_BYTES = 64
CHUNK_IDS = 1_000_000
CACHE_PIECES = 900_000
MEMORY = "160MB"
#: Freed memory beyond this goes back to the system at once: beside the database stand the executor's heap and other workers.
FREED = "1MB"

ENCODE = """
WITH RECURSIVE t(piece, toks, ranks, best) AS (
    SELECT piece, toks, ranks, list_min(ranks) FROM start
    UNION ALL
    SELECT piece, toks, ranks, list_min(ranks) FROM (
        SELECT s.piece, s.toks[:s.spot - 1] || [s.best] || s.toks[s.spot + 2:] AS toks,
               s.ranks[:s.spot - 2] || [l.merged, r.merged] || s.ranks[s.spot + 2:] AS ranks
        FROM (SELECT *, list_position(ranks, best) AS spot FROM t WHERE best IS NOT NULL) s
        LEFT JOIN merges l ON l.lhs = s.toks[s.spot - 1] AND l.rhs = s.best
        LEFT JOIN merges r ON r.lhs = s.best AND r.rhs = s.toks[s.spot + 2]))
SELECT piece, toks[2:-2] AS ids FROM t WHERE best IS NULL
"""

ENCODE_LONG = """
WITH RECURSIVE t(piece, pos, tok) USING KEY (piece, pos) AS (
    SELECT piece, pos, tok FROM start
    UNION ALL
    SELECT piece, pos, CASE WHEN pos = spot THEN merged WHEN before = spot THEN -1 ELSE tok END
    FROM (
        SELECT p.piece, p.pos, p.tok, p.before, m.merged,
               min(m.merged::BIGINT * 4294967296 + p.pos) OVER (PARTITION BY p.piece) & 4294967295 AS spot
        FROM (SELECT *, lead(tok) OVER w AS following, lag(pos) OVER w AS before
              FROM t WHERE tok >= 0 WINDOW w AS (PARTITION BY piece ORDER BY pos)) p
        LEFT JOIN merges m ON p.tok = m.lhs AND p.following = m.rhs)
    WHERE spot IS NOT NULL)
SELECT piece, list(tok ORDER BY pos) AS ids FROM t WHERE tok >= 0 GROUP BY piece
"""

DECODE = "SELECT i.doc, string_agg(v.shown, '' ORDER BY i.pos) AS shown FROM ids i JOIN vocabulary v ON i.id = v.id GROUP BY i.doc"


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


class Codec:
    def __init__(self, ranks: dict[bytes, int], pattern: str, remembered: int = CACHE_PIECES):
        import duckdb
        import regex

        self.ranks, self.remembered = ranks, remembered
        self.split = regex.compile(pattern).findall
        self.recent: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.single = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        self.double = np.array([ranks.get(bytes([a, b]), -1) for a in range(256) for b in range(256)], np.int32)  # -1: no pair
        self.con = duckdb.connect(config={"threads": 1, "memory_limit": MEMORY, "temp_directory": "", "preserve_insertion_order": False})
        for part in ("allocator_flush_threshold", "allocator_bulk_deallocation_flush_threshold"):
            self.con.execute(f"SET {part} = '{FREED}'")
        lhs, rhs, merged = [], [], []
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                a, b = ranks.get(token[:cut]), ranks.get(token[cut:])
                if a is not None and b is not None:
                    lhs.append(a), rhs.append(b), merged.append(rank)
        # bytes are shown as the 256 first code points: a lone byte need not be a valid text
        self._table("merges", pa.table({"lhs": pa.array(lhs, pa.int32()), "rhs": pa.array(rhs, pa.int32()), "merged": pa.array(merged, pa.int32())}))
        self._table("vocabulary", pa.table({"id": pa.array(list(ranks.values()), pa.int32()), "shown": [t.decode("latin-1") for t in ranks]}))

    def _table(self, name: str, rows: pa.Table) -> None:
        self.con.register("loading", rows)
        self.con.execute(f"CREATE OR REPLACE TABLE {name} AS SELECT * FROM loading")
        self.con.unregister("loading")

    def _contract(self, pieces: list[bytes]) -> Iterator[tuple[int, bytes]]:
        sizes = np.array([len(p) for p in pieces])
        for chosen, start, query in ((sizes <= LONG_BYTES, self._lists, ENCODE), (sizes > LONG_BYTES, self._positions, ENCODE_LONG)):
            if chosen.any():
                own = np.flatnonzero(chosen)
                self._table("start", start(own, sizes[own], np.frombuffer(b"".join([pieces[i] for i in own.tolist()]), np.uint8)))
                found = self.con.sql(query).to_arrow_table()
                ids = found["ids"].combine_chunks()
                flat, at = ids.values.to_numpy().astype("<u4"), ids.offsets.to_numpy()
                for k, piece in enumerate(found["piece"].to_pylist()):
                    yield piece, flat[at[k]: at[k + 1]].tobytes()

    def _lists(self, own: np.ndarray, sizes: np.ndarray, raw: np.ndarray) -> pa.Table:
        """A row a piece: its tokens between two of -1, and the rank of each pair (null: none)."""

        def around(values: np.ndarray, lengths: np.ndarray) -> tuple[pa.Array, np.ndarray]:
            ends = np.append(0, np.cumsum(lengths + 2))
            out, inner = np.full(ends[-1], -1, np.int32), np.ones(ends[-1], bool)
            inner[ends[:-1]] = inner[ends[1:] - 1] = False
            out[inner] = values
            return pa.array(ends, pa.int32()), out

        pairs, within = self.double[raw[:-1].astype(np.int32) * 256 + raw[1:]], np.ones(len(raw) - 1, bool)
        within[np.cumsum(sizes)[:-1] - 1] = False  # not from one piece to the next
        at, toks = around(self.single[raw], sizes)
        bounds, ranks = around(pairs[within], sizes - 1)
        return pa.table({"piece": own.astype(np.int32), "toks": pa.ListArray.from_arrays(at, pa.array(toks)),
                         "ranks": pa.ListArray.from_arrays(bounds, pa.array(ranks, mask=ranks < 0))})

    def _positions(self, own: np.ndarray, sizes: np.ndarray, raw: np.ndarray) -> pa.Table:
        first = np.repeat(np.cumsum(sizes) - sizes, sizes)
        return pa.table({"piece": np.repeat(own.astype(np.int32), sizes), "pos": np.arange(len(raw), dtype=np.int64) - first, "tok": self.single[raw]})

    def learn(self, pieces: Iterable[str]) -> None:
        """Encode pieces that are not remembered."""
        if len(self.recent) >= self.remembered:
            self.older, self.recent = self.recent, {}
        names, todo, held = [], [], 0

        def flush() -> None:
            for k, ids in self._contract(todo):
                self.recent[names[k]] = ids
            names.clear(), todo.clear()

        for piece in pieces:
            if piece in self.recent:
                continue
            if piece in self.older:
                self.recent[piece] = self.older[piece]
                continue
            raw = piece.encode("utf-8", "surrogatepass")
            if (rank := self.ranks.get(raw)) is not None:
                self.recent[piece] = rank.to_bytes(4, "little")
                continue
            names.append(piece), todo.append(raw)
            held += len(raw)
            if held >= CHUNK_BYTES:
                flush()
                held = 0
        if todo:
            flush()

    def encode(self, texts: list[str]) -> Iterator[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        group, size = [], 0
        for i, text in enumerate(texts):
            own = self.split(text)
            group.append(own)
            size += len(own)
            if size >= CHUNK_IDS // 4 or i + 1 == len(texts):
                self.learn(set().union(*group))
                for pieces in group:
                    yield b"".join(map(self.recent.__getitem__, pieces))
                group, size = [], 0

    def decode(self, ids: list[bytes]) -> Iterator[list[bytes]]:
        """The bytes of each id sequence, in parts that follow each other."""
        doc, held, parts = [], 0, []
        for i, raw in enumerate(ids):
            arr = np.frombuffer(raw, "<u4")
            for cut in range(0, max(1, len(arr)), CHUNK_IDS):
                part = arr[cut: cut + CHUNK_IDS]
                doc.append(i), parts.append(part)
                held += len(part)
                if held >= CHUNK_IDS:
                    yield from self._aggregate(doc, parts)
                    doc, held, parts = [], 0, []
        if doc:
            yield from self._aggregate(doc, parts)

    def _aggregate(self, doc: list[int], parts: list[np.ndarray]) -> Iterator[tuple[int, bytes]]:
        sizes = [len(p) for p in parts]
        rows = pa.table({"doc": np.repeat(np.arange(len(parts), dtype=np.int32), sizes), "pos": np.arange(sum(sizes), dtype=np.int32),
                         "id": np.concatenate(parts).astype(np.int32)})
        self.con.register("ids", rows)
        found = dict(self.con.execute(DECODE).fetchall())
        self.con.unregister("ids")
        for k, i in enumerate(doc):
            yield i, found.get(k, "").encode("latin-1")


def codec(path: str, pattern: str, remembered: int = CACHE_PIECES) -> Codec:
    """One codec per worker process and vocabulary, until another operator's task runs there."""
    return C.kept(("bpe", path, pattern, remembered), lambda: Codec(load_ranks(path), pattern, remembered))


def _slim(docs: DataFrame, id_col: str, col: str) -> DataFrame:
    return docs.select(F.col(id_col).alias("doc_id"), F.col(col).alias("x"))


def encode(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, ids array<int> of every row."""
    slim = _slim(docs, id_col, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path, pattern)
        for b in batches:
            ids = [np.frombuffer(x, "<u4").astype(np.int32) for x in own.encode([t or "" for t in b.column(1).to_pylist()])]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "ids"])

    return slim.mapInArrow(run, slim.drop("x").schema.add("ids", T.ArrayType(T.IntegerType())))


def decode(encoded: DataFrame, path: str, pattern: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """doc_id, raw binary (the decoded bytes) of every row; a null id sequence decodes to no bytes."""
    slim = _slim(encoded, id_col, ids_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path, pattern)
        for b in batches:
            parts: list[list[bytes]] = [[] for _ in range(b.num_rows)]
            for i, raw in own.decode([np.array(x or [], "<u4").tobytes() for x in b.column(1).to_pylist()]):
                parts[i].append(raw)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([b"".join(p) for p in parts], pa.binary())], ["doc_id", "raw"])

    return slim.mapInArrow(run, slim.drop("x").schema.add("raw", "binary"))


def round_trip(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", carry: tuple[str, ...] = (), with_ids: bool = False,
               remembered: int = CACHE_PIECES) -> DataFrame:
    """Encode every text, decode the ids, and digest both: doc_id, the columns ``carry``, n_tokens,
    ids (array<int>, ``with_ids`` only), ids_sha256, decoded_sha256. One pass in one worker, so the
    decoder's ids and bytes do not travel."""
    slim = docs.select(F.col(text_col).alias("x"), F.col(id_col).alias("doc_id"), *carry)
    schema = T.StructType(slim.schema.fields[1:]).add("n_tokens", "long")
    if with_ids:
        schema = schema.add("ids", T.ArrayType(T.IntegerType()))
    schema = schema.add("ids_sha256", "string").add("decoded_sha256", "string")
    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path, pattern, remembered)
        for b in batches:
            for at in range(0, b.num_rows, 256):
                part = b.slice(at, 256)
                ids = list(own.encode([t or "" for t in part.column(0).to_pylist()]))
                back = [hashlib.sha256() for _ in ids]
                for i, raw in own.decode(ids):
                    back[i].update(raw)
                cols = [*part.columns[1:], pa.array([len(x) // 4 for x in ids], pa.int64())]
                if with_ids:
                    cols.append(pa.array([np.frombuffer(x, "<u4").astype(np.int32) for x in ids], pa.list_(pa.int32())))
                cols += [pa.array([hashlib.sha256(x).hexdigest() for x in ids], pa.string()), pa.array([h.hexdigest() for h in back], pa.string())]
                yield pa.RecordBatch.from_arrays(cols, names)

    return slim.mapInArrow(run, schema)
