"""Word pieces, byte-level BPE and Huffman files against brute force and the libraries."""

import heapq
import random
import zlib

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from feedledger.llm import bpe_sql, huffman, piece_counts
from feedledger.llm import common as C
from helpers import make, odd_rows, words

RANKS = P.path("byte_bpe_multi_50k.tiktoken")
WORDS = P.path("word_bpe_49k.json")
PIECES = P.path("piece_bpe_32k.model")


def greedy(word, initial, continuation):
    at, n = 0, 0
    while at < len(word):
        vocab = initial if at == 0 else continuation
        end = next((e for e in range(len(word), at, -1) if word[at:e] in vocab), None)
        if end is None:
            return -1
        at, n = end, n + 1
    return n


@settings(max_examples=200, deadline=None)
@given(st.sets(st.text("ab#", min_size=1, max_size=4), max_size=8), st.sets(st.text("ab#", min_size=1, max_size=4), max_size=8), st.lists(st.text("ab#c", min_size=1, max_size=12), max_size=12))
def test_automaton_is_greedy_longest_match(initial, continuation, ws):
    a = piece_counts.Automaton(initial, continuation)
    assert [a.count(w) for w in ws] == [greedy(w, initial, continuation) for w in ws]


def test_count_tokens(spark):
    _, pieces = _file_pieces()
    rows = odd_rows()
    got = sorted(map(tuple, piece_counts.count_tokens(make(spark, rows, clashes=True), PIECES).collect()), key=str)
    want = [(doc, len(words(text)), sum(whole_greedy(w, pieces) for w in words(text)), 0) for doc, text, *_ in rows]
    assert got == sorted(want, key=str)
    assert piece_counts.count_tokens(make(spark, []), PIECES).count() == 0


def whole_greedy(word, pieces):
    """Greedy longest match of the marked word over a file's whole vocabulary, byte pieces included."""
    marked, at, n, longest = "▁" + word, 0, 0, max(map(len, pieces))
    while at < len(marked):
        end = next((e for e in range(min(len(marked), at + longest), at, -1) if marked[at:e] in pieces), None)
        n, at = (n + 1, end) if end else (n + len(marked[at].encode()), at + 1)
    return n


def _file_pieces():
    import sentencepiece

    m = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    return m, {m.id_to_piece(i) for i in range(m.get_piece_size()) if not (m.is_control(i) or m.is_unknown(i) or m.is_byte(i))}


def test_count_tokens_over_the_whole_vocabulary(spark):
    model, pieces = _file_pieces()
    texts = ["1997 12 3.5% 2,000", "日本 日本語のテキスト 한국어 中文", "Ελλάδα Ñandú Ωmega Жук élan", "\U0001F600 x\U0001F9FFy \u0d05 ᚠᚢ", "a▁b ▁ ▁▁x", "日本語" * 3000]
    rows = [(i, t) for i, t in enumerate(texts)] + [(100 + i, r[1]) for i, r in enumerate(odd_rows())]
    got = {r["doc_id"]: r for r in piece_counts.count_tokens(make(spark, rows), PIECES).collect()}
    for doc, text in rows:
        ws = words(text)
        assert (got[doc]["n_words"], got[doc]["n_tokens"], got[doc]["n_unknown"]) == (len(ws), sum(whole_greedy(w, pieces) for w in ws), 0), text
    for word, n in (("1997", 5), ("日本", 3)):  # as the library
        assert whole_greedy(word, pieces) == n == len(model.encode(word))
    assert got[5]["n_tokens"] > 3000


@settings(max_examples=200, deadline=None)
@given(st.sets(st.text("ab▁", min_size=1, max_size=4), max_size=8), st.lists(st.text("ab▁é", min_size=1, max_size=12), max_size=12))
def test_automaton_with_byte_pieces(pieces, ws):
    pieces = pieces | {"▁"}
    a = piece_counts.Automaton([p[1:] for p in pieces if p[0] == "▁"], pieces, True)
    assert [a.count(w) for w in ws] == [whole_greedy(w, pieces) for w in ws]


def test_bpe_encodes_as_tiktoken_and_decodes(spark, monkeypatch):
    enc = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe_sql.load_ranks(RANKS), special_tokens={})
    rng = random.Random(3)
    rows = odd_rows() + [(900, "".join(rng.choice("abcé ") for _ in range(400))), (901, "a" * 300), (902, "日本語テキスト" * 20), (903, "\t\t \n x  y")]
    docs = make(spark, rows, clashes=True)
    encoded = C.stored(bpe_sql.encode(docs, RANKS, P.PATTERN), "t").collect()
    want = sorted((str(r[0]), enc.encode_ordinary(r[1] or "")) for r in rows)
    assert sorted((str(r["doc_id"]), r["ids"]) for r in encoded) == want
    back = bpe_sql.decode(bpe_sql.encode(docs, RANKS, P.PATTERN), RANKS, P.PATTERN).collect()
    assert sorted((str(r["doc_id"]), bytes(r["raw"])) for r in back) == sorted((str(r[0]), (r[1] or "").encode()) for r in rows)
    assert bpe_sql.round_trip(make(spark, []), RANKS, P.PATTERN).count() == 0


def test_bpe_parts(monkeypatch):
    """Small chunks: pieces and ids are worked on in many parts, and remembered pieces are dropped."""
    monkeypatch.setattr(bpe_sql, "CHUNK_BYTES", 40)
    monkeypatch.setattr(bpe_sql, "CHUNK_IDS", 16)
    monkeypatch.setattr(bpe_sql, "CACHE_PIECES", 10)
    ranks = bpe_sql.load_ranks(RANKS)
    enc = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    codec = bpe_sql.Codec(ranks, P.PATTERN)
    texts = [r[1] or "" for r in odd_rows() if len(r[1] or "") < 2000]
    ids = list(codec.encode(texts))
    assert [np.frombuffer(x, "<u4").tolist() for x in ids] == [enc.encode_ordinary(t) for t in texts]
    out = [b""] * len(texts)
    for i, raw in codec.decode(ids):
        out[i] += raw
    assert out == [t.encode() for t in texts]


def huffman_cost(counts):
    heap = sorted(counts)
    cost = 0
    while len(heap) > 1:
        a, b = heapq.heappop(heap), heapq.heappop(heap)
        cost += a + b
        heapq.heappush(heap, a + b)
    return cost


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 10**6), min_size=2, max_size=60), st.integers(0, 10**6))
def test_code_is_optimal_and_packs(counts, seed):
    c = np.array(counts)
    lengths = huffman.code_lengths(c, 32)
    assert (c * lengths).sum() == huffman_cost(counts)
    short = huffman.code_lengths(c, 6)
    assert short.max() <= 6 and sum(0.5 ** short) <= 1
    code = huffman.Code(np.arange(len(c)) * 3, short)
    ids = np.random.default_rng(seed).choice(code.ids, 700)
    raw, offsets = huffman.pack(ids, code.encoder())
    assert huffman.unpack(raw, len(ids), offsets, code.table(), code.bits).tolist() == ids.tolist()


def test_huffman_files(spark, monkeypatch):
    monkeypatch.setattr(huffman, "SEGMENT", 1000)
    whole = Tokenizer.from_file(WORDS)
    rows = odd_rows() + [(950, "J̌ X"), (951, "İstanbul ΣΑΣ ﬁ"), (952, "<|ENDOFTEXT|> a <|endoftext|>b")]
    folder = C.new_path(spark, "t")
    huffman.write_corpus(make(spark, rows, clashes=True), WORDS, 2, folder)
    got = huffman.read(spark, folder).collect()
    digests = huffman.read(spark, folder, digest=True).collect()
    ids = lambda t: whole.encode(t or "", add_special_tokens=False).ids + [2]
    assert sorted((str(r["doc_id"]), r["ids"]) for r in got) == sorted((str(r[0]), ids(r[1])) for r in rows)
    got.sort(key=lambda r: r["start"])
    assert [r["start"] for r in got] == np.cumsum([0, *(r["n_tokens"] for r in got)])[:-1].tolist()
    order = [r["doc_id"] for r in got]
    assert order[0] is None and order[1:] == sorted(order[1:])
    assert sorted(r["ids_crc32"] for r in digests) == sorted(zlib.crc32(np.array(ids(r[1]), "<u4").tobytes()) for r in rows)
    assert spark.read.parquet(f"{folder}/codes").count() == len({i for r in rows for i in ids(r[1])})


def test_huffman_empty(spark):
    folder = C.new_path(spark, "t")
    huffman.write_corpus(make(spark, []), WORDS, 2, folder)
    assert huffman.read(spark, folder, digest=True).count() == 0


@pytest.mark.parametrize("text", [r[1] or "" for r in odd_rows()][:13])
def test_words_encode_as_the_whole_text(text):
    t = huffman.tokens(WORDS)
    assert np.frombuffer(t.encode(text.encode()), "<u4").tolist() == t.whole.encode(text, add_special_tokens=False).ids


def test_plain_words_go_straight_to_the_merge_model(monkeypatch):
    """Letters of ASCII with marks or none take neither a pattern nor a table of shown bytes."""
    words_ = [w + m for w in ("the", "Straw", "q", "abcdefghij" * 6) for m in ("", ".", ",;", "!?:")]
    want = [huffman.Tokens(WORDS).whole.encode(w, add_special_tokens=False).ids for w in words_]
    t = huffman.Tokens(WORDS)

    def fails(*_):
        raise AssertionError

    monkeypatch.setattr(huffman.Tokens, "PLAIN", fails)
    t.shown = {}
    assert [np.frombuffer(x, "<u4").tolist() for x in t.encode_all([w.encode() for w in words_])] == want


def test_a_worker_keeps_the_latest_operators_state_only():
    first = C.kept(("a", 1), lambda: [1])
    assert C.kept(("a", 1), lambda: [2]) is first
    assert C.kept(("b", 1), lambda: [3]) == [3] and list(C._KEPT) == [("b", 1)]
    huffman.tokens(WORDS)
    assert list(C._KEPT) == [("words", WORDS)]
    C.release()
    assert not C._KEPT


def test_words_of_several_texts_are_encoded_together(monkeypatch):
    """The same ids as the library's, with one call of the whole tokenizer for all words that need it."""
    path = P.path("word_bpe_49k.json")
    own, lib = huffman.Tokens(path), Tokenizer.from_file(path)
    rng = random.Random(3)
    signs = "aAzZ'.,!?*$#<|>éÉß 07\u0661\u0301\t_-(stre\u3000漢"
    texts = ["", " \n", "end*** (x) don't 's 're' <|endoftext|> A<|endoftext|>b", "a" * 100 + "!!!", *("".join(rng.choices(signs, k=40)) for _ in range(400))]
    want = [np.array(e.ids, "<u4").tobytes() for e in lib.encode_batch(texts, add_special_tokens=False)]
    calls = []

    class Counted:
        def encode(self, *a, **b):
            calls.append(a)
            return lib.encode(*a, **b)

    own.whole = Counted()
    assert own.encode_all([t.encode() for t in texts]) == want
    assert len(calls) == 1
    monkeypatch.setattr(huffman, "CACHE_WORDS", 3)  # generations change, and long texts go in parts
    own = huffman.Tokens(path)
    for _ in range(2):
        assert own.encode_all([t.encode() for t in texts]) == want
    assert not [w for w in (*own.recent, *own.older) if len(w) > 64]


def test_codec_remembers_as_many_pieces_as_it_may():
    ranks = bpe_sql.load_ranks(P.path("byte_bpe_multi_50k.tiktoken"))
    own, enc = bpe_sql.Codec(ranks, P.PATTERN, remembered=20), tiktoken.Encoding("t", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = [" ".join(f"w{i % 7}x{k}y" for i in range(10)) for k in range(30)]
    for t in texts * 2:
        assert np.frombuffer(next(own.encode([t])), "<u4").tolist() == enc.encode_ordinary(t)
        assert len(own.recent) <= 60 and len(own.older) <= 60


def test_short_pieces_take_one_row_each_and_long_ones_a_row_a_token(monkeypatch):
    ranks = bpe_sql.load_ranks(RANKS)
    enc = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    n = bpe_sql.LONG_BYTES
    short = ["zqxv", "aaaaaaaaaaaaaaa", "ßöß", "q", "퟿\U0001f600x", "Abcdefghijklmnop" * (n // 16)]
    long = ["Abcdefghijklmnop" * (n // 16) + "q", "a" * 3 * n, "ö" * n]
    codec = bpe_sql.Codec(ranks, P.PATTERN)
    texts = [*short, *long, " ".join(short + long)]
    assert [np.frombuffer(x, "<u4").tolist() for x in codec.encode(texts)] == [enc.encode_ordinary(t) for t in texts]
    monkeypatch.setattr(bpe_sql, "ENCODE_LONG", "no query")
    codec = bpe_sql.Codec(ranks, P.PATTERN)
    assert [np.frombuffer(x, "<u4").tolist() for x in codec.encode(short)] == [enc.encode_ordinary(t) for t in short]


def test_repeated_words_of_plain_texts_are_looked_up_by_piece_once(monkeypatch):
    own = huffman.Tokens(WORDS)
    asked, find = [], huffman.Tokens._piece
    monkeypatch.setattr(huffman.Tokens, "_piece", lambda self, piece: asked.append(piece) or find(self, piece))
    texts = ["The end, the END. ", "the end! (the end)", " end.\n" * 300]
    assert [np.frombuffer(x, "<u4").tolist() for x in own.encode_all([t.encode() for t in texts])] == \
        [own.whole.encode(t, add_special_tokens=False).ids for t in texts]
    assert sorted(asked) == sorted({b"the", b"end", b",", b".", b"!", b")", b""})
    assert not {b"the", b"end", b"end."} & own.recent.keys()
