"""Near duplicates of a growing corpus: chance matches of long texts, shuffled texts, shuffle files."""

import random
import time
from collections import Counter

import numpy as np
import pytest

import corpus_pipeline
from feedledger.llm import common as C
from feedledger.llm import shingle_join
from helpers import SF, link_components, make
from test_models import _near_copies


def test_long_sets_meet_only_when_they_link():
    """A long set has more weak segments than 256, and leaves them out: sets that share nothing meet in none."""
    rng = np.random.default_rng(8)
    met = []
    for n in (9_000, 11_000, 14_000, 20_000):
        sets = [np.unique(rng.integers(0, 1 << 64, n + 40 * k, dtype=np.uint64)) for k in range(8)]
        sigs = [shingle_join.signatures(s, 1_000_000, 80) for s in sets]
        met += [(n, x, y) for x in range(8) for y in range(x) if len(np.intersect1d(sigs[x], sigs[y]))]
        for s, own in zip(sets, sigs):  # half of what a linked set may lack, and all of it
            for gone in (n // 10, n // 5):
                near = s[rng.permutation(len(s))[gone:]]
                assert len(np.intersect1d(own, shingle_join.signatures(np.sort(near), 1_000_000, 80)))
    assert met == []


@pytest.mark.parametrize("hi", [25, 331, 5774, 11785, 100189, 2482814])
def test_allocated_segments_hold_the_difference_of_a_linked_pair(hi):
    for part in (50, 80, 90):
        h = 2 * hi * (100 - part) // (100 + part)
        for n_sets in (10, 250_000, 10**9):
            exact, deletion, spare = shingle_join.allocate(hi, n_sets, part, 100)
            assert exact + 2 * deletion == h + 1 + spare and exact >= spare


def test_poisson_tail():
    for mean in (0.01, 0.7, 30.0, 900.0):
        draws = np.random.default_rng(1).poisson(mean, 200_000)
        for n in (0, int(mean), int(mean + 2 * mean**0.5), int(mean * 3) + 5):
            assert abs(shingle_join._more_than(n, mean) - (draws > n).mean()) < 0.006


def test_a_larger_corpus_has_a_larger_sample(spark, monkeypatch):
    monkeypatch.setattr(shingle_join, "SAMPLED_SETS", 2)
    rows = [(i, f"one {i} two {i * i} three") for i in range(500)]
    got = [(r["v"], r["some"] is not None) for r in shingle_join.shingle_classes(make(spark, rows)).collect()]
    assert all(some == (v % shingle_join.SAMPLED_ONE_IN == 0) for v, some in got)
    assert sum(some for _, some in got) >= 5


@pytest.mark.parametrize("marks", [64, 1 << 12, 1 << 24])
def test_marks_find_every_id(spark, monkeypatch, marks):
    monkeypatch.setattr(shingle_join, "MARKS", marks)
    docs = make(spark, [(i - 50, f"t{i}") for i in range(300)] + [(None, "x"), (7, "again")], clashes=True)
    ids = spark.createDataFrame([(i,) for i in range(-50, 40, 3)], "_id long")
    out = shingle_join.with_mark(docs, ids, "hit")
    assert out.columns == [*docs.columns, "hit"]
    got = [(r["doc_id"], r["hit"]) for r in out.collect()]
    assert len(got) == 302
    assert all(hit for i, hit in got if i is not None and i in range(-50, 40, 3))
    assert [hit for i, hit in got if i is None] == [False]
    if marks == 1 << 24:
        assert sum(hit for _, hit in got) < 40
    none = shingle_join.with_mark(docs, ids.filter("false"), "hit").collect()
    assert len(none) == 302 and not any(r["hit"] for r in none)


@pytest.mark.parametrize("marks", [64, 1 << 24])
def test_texts_of_untouched_documents_are_not_shuffled(spark, monkeypatch, marks):
    """However many keys are decided, the texts meet the bitmap first, and the rows are those of the rule."""
    monkeypatch.setattr(shingle_join, "MARKS", marks)
    rng = random.Random(3)
    rows = _near_copies(21) + [(500 + i, " ".join(rng.choice("abcdefgh") * 3 + str(rng.randrange(900)) for _ in range(30))) for i in range(150)]
    rows += [(500, rows[100][1]), (501, rows[99][1]), (501, rows[99][1]), (None, rows[0][1]), (None, rows[0][1]), (900, None), (900, ""), (900, "")]
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # the decided keys are too many
    try:
        out = corpus_pipeline.remove_near_duplicates(spark, make(spark, rows, clashes=True), SF)
        plan = out._jdf.queryExecution().executedPlan().toString()
        got = Counter((r["doc_id"], r["text"]) for r in out.collect())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "BroadcastHashJoin" in plan
    root = link_components([(k, t) for k, (_, t) in enumerate(rows)], 5, 80)
    least = {}
    for k, (d, t) in enumerate(rows):
        if d is not None:
            least[root[k]] = min(least.get(root[k], d), d)
    want = {(d, t) for k, (d, t) in enumerate(rows) if d is None or not (t or "").split() or least[root[k]] == d}
    assert set(got) == want
    assert got[(None, rows[0][1])] == 2 and all(n == 1 for (d, _), n in got.items() if d is not None)


def test_what_a_stored_table_shuffled_is_removed(spark):
    def files():
        return {x for x in spark._jsc.sc().env().blockManager().diskBlockManager().getAllFiles().mkString("\n").split("\n") if "shuffle_" in x}

    before = files()
    df = spark.range(5000).repartition(3, "id").groupBy("id").count()
    out = C.stored(df, "tidy")
    for _ in range(100):
        if not files() - before:
            break
        time.sleep(0.1)
    assert not files() - before
    assert out.count() == 5000 and df.count() == 5000
