"""Word-piece token counts by a linear longest-match automaton.

The vocabulary (word-initial pieces and continuation pieces) becomes two tries. Each node holds a
failure link to the node of the longest text that can still match after popping complete pieces,
and the number of pieces popped on the way, so a word is read once, left to right, without going
back and without building its pieces. An empty word-initial piece is the bare word start, which
leads on to the continuation pieces. With byte pieces a character that no piece starts at counts as
its UTF-8 bytes; without them a word that greedy longest match cannot cover counts as one unknown
piece.

Cases: null or empty text: 0 words, 0 tokens; very long words are read in linear time; repeated
rows and extra columns need no care (``count_tokens`` returns its own columns only).
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Words remembered by a worker before it starts anew.
CACHE_WORDS = 1 << 19
#: The mark that stands for the start of a word.
START = "▁"


def _n_bytes(ch: str) -> int:
    return len(ch.encode("utf-8", "replace"))


class Automaton:
    def __init__(self, initial: Iterable[str], continuation: Iterable[str], byte_pieces: bool = False):
        initial, self.byte_pieces = list(initial), byte_pieces
        self.next: list[dict[str, int]] = [{}, {}]  # 0: start of a word, 1: after a piece
        final = [False, False]
        for root, pieces in ((0, initial), (1, continuation)):
            for piece in pieces:
                at = root
                for ch in piece:
                    to = self.next[at].get(ch)
                    if to is None:
                        to = self.next[at][ch] = len(self.next)
                        self.next.append({})
                        final.append(False)
                    at = to
                final[at] |= at > 1
        self.fail = [-1] * len(self.next)
        self.pops = [0] * len(self.next)
        if "" in initial or byte_pieces:
            self.fail[0], self.pops[0] = 1, 1 if "" in initial else len(START.encode())
        level = [0, 1]
        while level:  # by length: a failure link leads to a shorter text
            after = []
            for u in level:
                for ch, v in self.next[u].items():
                    after.append(v)
                    if final[v]:
                        self.fail[v], self.pops[v] = 1, 1
                        continue
                    z, n = self.fail[u], self.pops[u]
                    while z >= 0 and ch not in self.next[z]:
                        n, z = n + self.pops[z], self.fail[z]
                    if z >= 0:
                        self.fail[v], self.pops[v] = self.next[z][ch], n
                    elif byte_pieces:
                        self.fail[v], self.pops[v] = 1, n + _n_bytes(ch)
            level = after

    def count(self, word: str) -> int:
        """Pieces of a word; -1 if it cannot be covered."""
        step, fail, pops = self.next, self.fail, self.pops
        at, n = 0, 0
        for ch in word:
            to = step[at].get(ch)
            while to is None:
                if at == 1 and self.byte_pieces:
                    n, to = n + _n_bytes(ch), 1
                    break
                n += pops[at]
                at = fail[at]
                if at < 0:
                    return -1
                to = step[at].get(ch)
            at = to
        while at != 1:
            n += pops[at]
            at = fail[at]
            if at < 0:
                return -1
        return n


def sentencepiece_vocabulary(path: str) -> tuple[list[str], list[str]]:
    """Word-initial pieces (without the word-start mark; the bare mark is the empty piece) and the
    pieces that can follow, which are all of a sentencepiece file but control and byte pieces."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = [model.id_to_piece(i) for i in range(model.get_piece_size())
              if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
    return [p[1:] for p in pieces if p.startswith(START)], pieces


def has_byte_pieces(path: str) -> bool:
    """Whether a sentencepiece file has a piece for each of the 256 bytes."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return sum(model.is_byte(i) for i in range(model.get_piece_size())) == 256


class _Counts(dict):
    """word bytes -> pieces (-1: unknown), bounded."""

    def __init__(self, automaton: Automaton):
        self.automaton = automaton

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        n = self.automaton.count(word.decode("utf-8", "replace"))
        if len(word) <= 64:
            self[word] = n
        return n


_CACHES: dict[str, _Counts] = {}


def counts_of(path: str) -> _Counts:
    if path not in _CACHES:
        _CACHES[path] = _Counts(Automaton(*sentencepiece_vocabulary(path), has_byte_pieces(path)))
    return _CACHES[path]


def count_tokens(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, n_tokens, n_unknown (words that count as one unknown piece) of every row."""
    slim = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("t"))
    schema = slim.drop("t").schema.add("n_words", "long").add("n_tokens", "long").add("n_unknown", "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = counts_of(vocabulary)
        for b in batches:
            n_words, n_tokens, n_unknown = [], [], []
            for t in b.column(1):
                own = [pieces[w] for w in t.as_py().split()]  # bytes.split() parts at the six separators
                unknown = own.count(-1)
                n_words.append(len(own))
                n_tokens.append(sum(own) + 2 * unknown)
                n_unknown.append(unknown)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n_words, pa.int64()), pa.array(n_tokens, pa.int64()), pa.array(n_unknown, pa.int64())],
                                             ["doc_id", "n_words", "n_tokens", "n_unknown"])

    return slim.mapInArrow(run, schema)
