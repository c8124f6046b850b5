"""Suffix-array decontamination, max-sketch search and conversation repair against brute force and SQL."""

import hashlib
import heapq
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from feedledger.llm import common as C
from feedledger.llm import max_sketch, suffix_decontam, turn_dawg
from feedledger.llm import queries as Q
from helpers import SF, lower, make, odd_rows
from oracle_harness import compare, duck

WORD = re.compile("[0-9a-z\x80-\U0010ffff]+")
ITEMS = "item_id long, text string, window int, n int, doc_id long"


def terms(text):
    return WORD.findall(lower(text or ""))


def items_df(spark, rows):
    return spark.createDataFrame([(i, t, 1, 2, 3) for i, t in rows], ITEMS)


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", ["op11_suffix_decontam", "op12_max_sketch", "op13_turn_dawg"])
def test_query_against_sql(spark, con, name):
    query, sql = Q.QUERIES[name]
    problems, n, _ = compare(query(spark, SF), con, sql)
    assert not problems and n > 0


# ---- decontamination


def windows(ws, size):
    n = min(size, len(ws))
    return [tuple(ws[i: i + n]) for i in range(len(ws) - n + 1)] if n else []


def brute_contamination(docs, items, size):
    owners = {}
    for item, text in items:
        for w in windows(terms(text), size):
            owners.setdefault(w, set()).add(item)
    out = []
    for doc, text in docs:
        ws, hit, found = terms(text), set(), set()
        for w, ids in owners.items():
            for i in range(len(ws) - len(w) + 1):
                if tuple(ws[i: i + len(w)]) == w:
                    hit |= set(range(i, i + len(w)))
                    found |= ids
        runs = sorted(i for i in hit if i - 1 not in hit)
        spans = [(i, next(j for j in range(i, len(ws) + 1) if j not in hit) - i) for i in runs]
        out.append((doc, len(ws), len(hit), tuple(sorted(found - {None})), tuple(spans)))
    return out


def planted():
    rng = random.Random(3)
    word = lambda: rng.choice(["alpha", "Beta", "gamma", "delta", "élan", "42", "the", "of"])
    items = [(i, " ".join(word() for _ in range(25))) for i in range(6)]
    items += [(6, "alpha,  Beta! short one"), (7, "unique"), (8, None), (9, ""), (10, " .,;\n"), (3, "second text of the third item, seven eight nine ten eleven"), (None, "an item without any id")]
    docs = [(r[0], r[1]) for r in odd_rows()]
    for k, (_, text) in enumerate(items[:6]):
        part = text.split()
        docs += [(300 + k, "before " + " ".join(part[3:16]).upper() + " after"), (310 + k, " ".join(part[:9])), (320 + k, "\n".join(part * 2))]
    docs += [(400, "ALPHA beta.short-one and a unique{thing}"), (400, "nothing here"), (401, "an item without any id"), (402, "alpha " * 40), (None, "unique")]
    return docs, items


def got_contamination(df):
    return [(r.doc_id, r.n_words, r.n_hit, tuple(sorted(r["items"])), tuple(tuple(s) for s in r.spans)) for r in df.collect()]


def test_contamination_against_brute_force(spark, monkeypatch):
    docs, items = planted()
    want = sorted(brute_contamination(docs, items, 10), key=str)
    frame = make(spark, docs, clashes=True)
    assert sorted(got_contamination(suffix_decontam.contamination(frame, items_df(spark, items))), key=str) == want
    assert any(n for _, _, n, _, _ in want)
    sizes = [(12, 8 << 20), (37, 100)]  # shards of a few words, blocks of one item
    for shard, block in sizes:
        found = []
        monkeypatch.setattr(suffix_decontam, "SHARD_WORDS", shard)
        for b in suffix_decontam.blocks(items_df(spark, items), size=block):
            texts = suffix_decontam.Texts(pa_binary([t for _, t in docs]), suffix_decontam.Numbers())
            hit = np.zeros(len(texts.flat), bool)
            pairs = suffix_decontam._found(texts, b, 10, hit)
            found += [(int(d), b.ids[i]) for d, i in pairs]
        assert {(d, i) for d, i in found if i is not None} == {(d, i) for d, r in enumerate(brute_contamination(docs, items, 10)) for i in r[3]}


def pa_binary(texts):
    import pyarrow as pa

    return pa.array([(t or "").encode() for t in texts], pa.binary())


def test_decontaminate_keeps_columns_and_clean_rows(spark):
    docs, items = planted()
    frame = make(spark, docs, clashes=True)
    kept = suffix_decontam.decontaminate(frame, items_df(spark, items))
    assert kept.columns == frame.columns
    clean = [(d, t) for (d, t), r in zip(docs, brute_contamination(docs, items, 10)) if r[2] == 0]
    assert Counter((r.doc_id, r.text) for r in kept.collect()) == Counter(clean)
    assert (400, "nothing here") in clean


def test_contamination_of_empty_tables(spark):
    docs, items = planted()
    assert suffix_decontam.contamination(make(spark, []), items_df(spark, items)).count() == 0
    assert {r.n_hit for r in suffix_decontam.contamination(make(spark, docs), items_df(spark, [])).collect()} == {0}
    assert suffix_decontam.longest_matches(make(spark, docs), items_df(spark, [])).count() == 0


def test_longest_matches_against_brute_force(spark):
    docs, items = planted()
    docs, items = docs[-20:], items[:4]
    got = {(r.item_id, r.item_start): r for r in suffix_decontam.longest_matches(make(spark, docs), items_df(spark, items)).collect()}
    corpus = [(d, terms(t)) for d, t in docs]
    for item, text in items:
        ws = terms(text)
        for s in range(len(ws)):
            long = 0
            for _, own in corpus:
                for p in range(len(own)):
                    n = 0
                    while s + n < len(ws) and p + n < len(own) and ws[s + n] == own[p + n]:
                        n += 1
                    long = max(long, n)
            if not long:
                assert (item, s) not in got
                continue
            r = got[item, s]
            assert r.n_words == long
            assert any(d == r.doc_id and own[r.doc_start: r.doc_start + long] == ws[s: s + long] for d, own in corpus)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=60), st.integers(1, 12))
def test_suffix_array(numbers, depth):
    a = np.array(numbers, np.int32)
    order = suffix_decontam.suffix_array(a, depth).tolist()
    key = lambda i: (numbers[i:] + [0] * depth)[:depth]
    assert sorted(order) == list(range(len(a)))
    assert [key(i) for i in order] == sorted(key(i) for i in order)


# ---- ranked search


def brute_search(docs, items, k):
    own = [(d, Counter(terms(t))) for d, t in docs]
    own = [(d, c) for d, c in own if c]
    n_docs, total = len(own), sum(sum(c.values()) for _, c in own)
    df = Counter(t for _, c in own for t in c)
    out = []
    for item, text in sorted(set(items), key=str):
        q, rows = set(terms(text)), []
        for d, c in own:
            m = 50 + 50 * sum(c.values()) * n_docs // total
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (1000000000 * c[t] // (1000 * c[t] + 20 * m)) for t in q if t in c)
            if score > 0:
                rows.append((-score, d is None, d or 0, d))
        out += [(item, r, row[3], -row[0]) for r, row in enumerate(heapq.nsmallest(k, rows), 1)]
    return sorted(out, key=str)


@pytest.mark.parametrize("k, cells", [(50, 4_000_000), (3, 64)])
def test_search_against_brute_force(spark, monkeypatch, k, cells):
    docs, items = planted()
    items += [(3, "The same id, and other words: copy of a text"), (11, items[0][1]), (0, items[0][1])]
    monkeypatch.setattr(max_sketch, "LOOKUP_CELLS", cells)
    monkeypatch.setattr(max_sketch, "BLOCK_TERMS", 12)  # several blocks
    got = max_sketch.top_documents(max_sketch.index(make(spark, docs, clashes=True)), items_df(spark, items), k)
    assert sorted(map(tuple, got.collect()), key=str) == brute_search(docs, items, k)


def test_search_of_empty_tables(spark):
    docs, items = planted()
    for d, i in ((make(spark, []), items_df(spark, items)), (make(spark, docs), items_df(spark, [])), (make(spark, [(1, None), (2, " . ")]), items_df(spark, items))):
        out = max_sketch.top_documents(max_sketch.index(d), i)
        assert out.columns == ["item_id", "rank", "doc_id", "score"] and out.count() == 0


@settings(max_examples=50, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 40), st.integers(1, 400)), min_size=1, max_size=30, unique_by=lambda x: x[0]), st.integers(1, 3000))
def test_sketch_bounds_every_impact(counts, m):
    h = np.array([zlib.crc32(str(x).encode()) for x, _ in counts], np.uint64)
    tf = np.array([c for _, c in counts], np.uint32)
    cells = max_sketch.sketch(h, tf)
    q = max_sketch.Query(np.sort(h), np.arange(len(h)), np.arange(len(h) + 1), list(range(len(h))))
    q.weight = np.ones(len(h), np.int64)
    bounds = max_sketch._bounds(cells[None], np.array([m]), q)[0]
    exact = max_sketch.impact(tf[np.argsort(h)].astype(np.int64), np.int64(m))
    assert (bounds >= exact).all()


# ---- conversation repair


def cheapest(signature):
    """(cost, audit) by a search over all edits of the rows."""
    then = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (3, "u"): 2, (2, "a"): 3}
    heap, seen = [(0, "", 0, 0)], set()
    while heap:
        cost, audit, p, state = heapq.heappop(heap)
        if p == len(signature) and state in (0, 3):
            return cost, audit
        if (p, state) in seen:
            continue
        seen.add((p, state))
        for role in "ua":
            if (state, role) in then:
                heapq.heappush(heap, (cost + 3, audit + "I", p, then[state, role]))
        if p < len(signature):
            sign = signature[p]
            heapq.heappush(heap, (cost + 4, audit + "D", p + 1, state))
            if sign != "d":
                more = 3 if sign.isupper() else 0
                for role in "ua":
                    if (state, role) in then:
                        heapq.heappush(heap, (cost + 3 + more, audit + "R", p + 1, then[state, role]))
                if (state, sign.lower()) in then:
                    heapq.heappush(heap, (cost + more, audit + "K", p + 1, then[state, sign.lower()]))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text("dsuaoSUAO", max_size=9), min_size=1, max_size=6))
def test_audits_are_cheapest_and_least(signatures):
    known = turn_dawg.Suffixes()
    for s in signatures:
        assert known.audit(s) == cheapest(s)


def test_shared_endings_are_computed_once(monkeypatch):
    made, init = [], turn_dawg.Node.__init__
    monkeypatch.setattr(turn_dawg.Node, "__init__", lambda self, *a: (made.append(a), init(self, *a))[1])
    known, all_signs = turn_dawg.Suffixes(), ["".join(random.Random(i).choice("suaUd") for _ in range(6)) for i in range(500)]
    for s in sorted(all_signs, key=lambda s: s[::-1]):
        known.audit(s)
    assert len(made) == len({s[i:] for s in all_signs for i in range(len(s))})


def brute_repair(rows):
    """[(conv, turn, role, text)] -> conv -> the query's columns."""
    out, space = {}, "\x20\t\n\x0b\x0c\r"
    for conv in {r[0] for r in rows}:
        live = []
        for c, turn, role, text in rows:
            if c != conv:
                continue
            plain = lambda v: " " if v is None else str(v)
            kind, role, text = zlib.crc32(f"{plain(c)}:{plain(turn)}".encode()) % 20, plain(role), plain(text)
            text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
            role = "user" if kind == 4 else role
            live += [(turn, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
        live.sort(key=lambda r: (r[0] is not None, r[0] or 0, hashlib.md5(f"{len(r[1])}:{r[1]}{r[2]}".encode()).digest()))
        seen, signs, faults = set(), "", Counter()
        for _, role, text in live:
            body = text.strip(space)
            fault = "blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else ""
            seen.add((role, text))
            faults[fault] += 1
            base = role[:1] if role[:1] in ("s", "u", "a") else "o"
            signs += "d" if fault in ("blank", "duplicate") else base.upper() if fault else base
        turns = {t for t, _, _ in live if t is not None}
        cost, audit = cheapest(signs)
        fixed, at, state = [], 0, 0
        for edit in audit:
            role, text = ("", "") if edit == "I" else live[at][1:]
            at += edit != "I"
            if edit == "D":
                continue
            role = role if edit == "K" else "assistant" if state == 2 else "user"
            state = {"s": 1, "u": 2, "a": 3}[role[0]]
            fixed.append(f"{role}:{text}")
        initials = [r[1][:1] for r in live]
        illegal = sum(x + y not in ("su", "ua", "au") for x, y in zip(initials, initials[1:]))
        out[conv] = (max(turns) - min(turns) + 1 - len(turns) if turns else 0, faults["blank"], faults["duplicate"], faults["truncated"], illegal, cost, audit,
                     hashlib.sha256("\n".join(fixed).encode()).hexdigest(), fixed)
    return out


def conversations():
    rng = random.Random(11)
    rows = []
    for conv in [*range(300), None]:
        for turn in range(rng.randint(0 if conv else 1, 9)):
            rows.append((conv, rng.choice([turn, turn, turn, None, turn + 3]), rng.choice(["system", "user", "assistant", "user", "assistant", "tool", "", None, "unknown"]),
                         rng.choice(["Yes.", "No!", "cut off", " \t", "", None, f"Text {rng.random()}?", "größe …", "Wait. \n", "a\x85"])))
    rows += rows[:40]
    rows += [(1000, k, "user" if k % 2 == 0 else "assistant", f"long {k}.") for k in range(3000)]
    return rows


def conv_df(spark, rows):
    return spark.createDataFrame([(*r, 1, "x", True) for r in rows], "conv_id long, turn long, role string, text string, k int, audit string, live boolean")


def test_repair_against_brute_force(spark):
    rows = conversations()
    want = brute_repair(rows)
    damaged = turn_dawg.damage(conv_df(spark, rows))
    got = {r.conv_id: tuple(r)[1:] for r in turn_dawg.repair(damaged).collect()}
    assert got == {c: w[:-1] for c, w in want.items()}
    audited = C.stored(turn_dawg.audits(turn_dawg.signatures(turn_dawg.faults(damaged))), "audits")
    fixed = {}
    for r in sorted(turn_dawg.repaired_rows(damaged, audited).collect(), key=lambda r: r.position):
        fixed.setdefault(r.conv_id, []).append(f"{r.role}:{r.text}")
    assert fixed == {c: w[-1] for c, w in want.items() if w[-1]}


def test_repair_of_an_empty_table(spark):
    assert turn_dawg.repair(turn_dawg.damage(conv_df(spark, []))).count() == 0
