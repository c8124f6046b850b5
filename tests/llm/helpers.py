"""Brute-force versions and small tables for the operators' tests."""

import random
import re

from pyspark.sql import types as T

SF = "/root/testdata/sf0.001"
DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
                     T.StructField("source", T.StringType()), T.StructField("n_chars", T.IntegerType())])
#: Names that the operators use inside.
CLASHES = ["h", "chunk", "th", "pos", "n", "v", "sigs", "n_lines", "n_dropped", "b_id", "block", "slot", "place", "m_key", "lang_pred", "score", "rejected",
           "text_before", "rn", "component_id", "n_tokens", "ids", "x", "t", "w", "rid", "host", "kept"]


def words(text):
    return [w for w in re.split("[\x20\x09-\x0d]+", text or "") if w]


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def make(spark, rows, clashes=False):
    """(doc_id, text[, lang, source]) rows as documents."""
    full = [(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "s0", len(r[1] or "")) for r in rows]
    df = spark.createDataFrame(full, DOCS)
    if clashes:
        from pyspark.sql import functions as F

        df = df.select("*", *(F.lit(1).alias(c) for c in CLASHES))
    return df


def odd_rows():
    """Null and empty columns, separators, repeated rows, marks, a long text and a long word."""
    rng = random.Random(5)
    sentence = lambda n: " ".join(rng.choice(["the", "cat", "Sat", "on", "mat.", "größe", "et", "élan", "niño", "a1", "!!"]) for _ in range(n))
    common = "A line that many documents share, all of it."
    rows = [(1, None, None, None), (2, "", "en", "s1"), (3, " \t\x0b\x0c\r ", "en", None), (4, "\n\n\n", None, "s1"), (5, "word", "de", "s2"), (None, "no id here", "en", "s1"),
            (6, "x" * 5000 + " tail", "fr", "s1"), (7, sentence(6000), "en", "s0"), (8, " A B\u0085 \U0001F600 é <|endoftext|> ### 12 34", "es", "s3"),
            (9, "same text twice", "en", "s1"), (9, "same text twice", "en", "s1"), (9, "same id, other text", "en", "s1"), (10, "  Same LINE  \nsame line\nother", "en", "s0")]
    rows += [(100 + i, f"{common}\n{sentence(30)}\n {common.upper()} \n", ("en", "de", "fr", "es")[i % 4], "s0") for i in range(14)]
    rows += [(200 + i, sentence(60) if i % 3 else "copy of a text " * 20, "en", f"s{i % 5}") for i in range(12)]
    return rows


def shingles(text, size):
    w = words(lower(text or ""))
    return frozenset(tuple(w[i: i + size]) for i in range(len(w) - size + 1)) if len(w) >= size else frozenset([tuple(w)] if w else [])


def link_components(rows, size, part, whole=100):
    """doc_id -> least id reachable, by comparing all pairs."""
    sets, parent = {}, {}
    for doc, text in rows:
        if doc is not None:
            sets.setdefault(doc, set()).add(shingles(text, size))
            parent[doc] = doc

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1:]:
            if any(x and y and whole * len(x & y) >= part * len(x | y) for x in sets[a] for y in sets[b]):
                p, q = find(a), find(b)
                parent[max(p, q)] = min(p, q)
    return {d: find(d) for d in ids}


def dedup_lines(rows, min_docs, keep_first=False):
    """[(doc_id, text)] -> [(lines, dropped, kept text)] in the order of the rows."""
    strip = "\x20\t\n\x0b\x0c\r"
    keys = [[lower(x.strip(strip)) for x in (t or "").split("\n")] for _, t in rows]
    seen = {}
    for (doc, _), ks in zip(rows, keys):
        for k in ks:
            if k:
                seen.setdefault(k, set()).add(doc)
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is not None, rows[i][0] or 0))
    first, out = {}, [None] * len(rows)
    for i in order:
        doc, text = rows[i]
        kept, dropped = [], 0
        for j, (line, k) in enumerate(zip((text or "").split("\n"), keys[i])):
            if k and len(seen[k]) >= min_docs and not (keep_first and first.setdefault(k, (doc, text, j)) == (doc, text, j)):
                dropped += 1
            else:
                kept.append(line)
        out[i] = (len(keys[i]), dropped, "\n".join(kept))
    return out
