"""Registered queries of the operators: whole tables, production parameters, contract columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ship_package
from . import common as C
from . import (bpe_sql, gru_lm, host_rules, huffman, impact_index, lang_id, line_dedup, max_sketch, pfair_mix, piece_counts, shingle_join, suffix_decontam,
               turn_dawg)


def vocabulary(name: str) -> str:
    """Place of a public tokenizer's file; it is the same on every machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_gru_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = C.documents(spark, sf_dir)
    held_out = C.remainder(F.col("doc_id"), 7) == 2
    out = gru_lm.fit_and_score(docs, ~held_out)
    return out.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op2_piece_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_counts.count_tokens(C.documents(spark, sf_dir), vocabulary("piece_bpe_32k.model"))


def op4_bpe_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return bpe_sql.round_trip(C.documents(spark, sf_dir), vocabulary("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


def op5_impact_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    vectors = impact_index.integer_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    return impact_index.top_k(C.stored(vectors, "vectors"), F.col("id") % impact_index.EVERY == 0)


OP5_SQL = """
WITH v AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS q FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
s AS (
  SELECT a.vec_id AS query_id, b.vec_id, sum(a.x * b.x)::BIGINT AS score
  FROM (SELECT vec_id, unnest(q) AS x, generate_subscripts(q, 1) AS d FROM v WHERE vec_id % 50 = 0) a
  JOIN (SELECT vec_id, unnest(q) AS x, generate_subscripts(q, 1) AS d FROM v) b ON a.d = b.d AND a.vec_id <> b.vec_id
  GROUP BY a.vec_id, b.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""


def op9_pfair_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pfair_mix.mix(C.documents(spark, sf_dir).select("doc_id", "source"))


def op6_shingle_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shingle_join.join_components(C.documents(spark, sf_dir))


def op7_huffman(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = C.new_path(spark, "huffman")
    huffman.write_corpus(C.documents(spark, sf_dir), vocabulary("word_bpe_49k.json"), 2, folder)
    return huffman.read(spark, folder, digest=True)


def op10_lang_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = C.documents(spark, sf_dir)
    held_out = lang_id.held_out(F.col("doc_id"))
    model = lang_id.sample(docs.filter(~held_out))
    out = lang_id.predict(docs.select("doc_id", "text"), model)
    return out.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "margin", "rejected")


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = C.documents(spark, sf_dir).select("doc_id", "text")
    out = line_dedup.dedup_lines(docs)
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


OP3_SQL = r"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents),
keyed AS (
  SELECT doc_id, pos, line,
         translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM lines),
common AS (SELECT k FROM keyed WHERE length(k) >= 1 GROUP BY k HAVING count(DISTINCT doc_id) >= 10)
SELECT doc_id, count(*) AS n_lines, count(c.k) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE c.k IS NULL), '')) AS kept_sha256
FROM keyed LEFT JOIN common c ON keyed.k = c.k
GROUP BY doc_id
"""


def op8_host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = host_rules.apply_rules(C.documents(spark, sf_dir).select("doc_id", "text", "source"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


OP8_SQL = r"""
WITH d AS (SELECT doc_id, source, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, source, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws FROM d),
g AS (
  SELECT doc_id, i, ws[i] || chr(10) || ws[i + 1] || chr(10) || ws[i + 2] AS gram
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 1)) AS i FROM w WHERE len(ws) >= 3)),
r AS (SELECT doc_id, gram FROM g GROUP BY doc_id, gram HAVING count(*) >= 2),
p AS (
  SELECT doc_id, count(DISTINCT place) AS n
  FROM (SELECT g.doc_id, unnest([g.i, g.i + 1, g.i + 2]) AS place FROM g JOIN r ON g.doc_id = r.doc_id AND g.gram = r.gram)
  GROUP BY doc_id),
s AS (
  SELECT w.doc_id, source, len(ws) AS n_words,
         length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) AS word_chars,
         length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
         len(list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]'))) AS n_lines,
         len(list_distinct(list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')))) AS n_different,
         coalesce(p.n, 0) AS n_repeat_words
  FROM w LEFT JOIN p ON w.doc_id = p.doc_id),
j AS (
  SELECT doc_id, source, n_words, word_chars, n_symbols, n_lines - n_different AS n_dup_lines, n_repeat_words, n_lines,
         (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed
  FROM s),
f AS (
  SELECT source, unnest(['base', 'symbols', 'dup_lines', 'word_length']) AS rule,
         unnest([base_failed, 10 * n_symbols > n_words, 10 * n_dup_lines > 3 * n_lines,
                 word_chars < 3 * n_words OR word_chars > 10 * n_words]) AS failed
  FROM j WHERE source IS NOT NULL),
h AS (SELECT source, rule, count(*)::DOUBLE AS n, count(*) FILTER (WHERE failed)::DOUBLE AS x FROM f GROUP BY source, rule),
m AS (SELECT rule, sum(x) / sum(n) AS mean, sum(x * x / n) / sum(n) - (sum(x) / sum(n)) * (sum(x) / sum(n)) AS v FROM h GROUP BY rule),
k AS (SELECT rule, mean, CASE WHEN v > 1e-9 THEN greatest(mean * (1 - mean) / v - 1, 1e-3) ELSE 1.0 END AS k FROM m),
bad AS (SELECT source FROM h JOIN k ON h.rule = k.rule GROUP BY source HAVING max((x + mean * k) / (n + k)) > 0.5)
SELECT j.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       (NOT base_failed AND bad.source IS NULL) AS kept
FROM j LEFT JOIN bad ON j.source = bad.source
"""


def op11_suffix_decontam(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = suffix_decontam.contamination(C.documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    names = F.array_sort(F.transform("items", lambda i: i.cast("string")))
    return out.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                      F.sha2(F.array_join(names, ",").cast("binary"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


OP11_SQL = r"""
WITH d AS (
  SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark),
bw AS (
  SELECT DISTINCT item_id, n, array_to_string(ws[i : i + n - 1], ' ') AS win
  FROM (SELECT item_id, ws, least(10, len(ws)) AS n, unnest(range(1, len(ws) - least(10, len(ws)) + 2)) AS i FROM b WHERE len(ws) > 0)),
sizes AS (SELECT DISTINCT n FROM bw),
dw AS (
  SELECT r, n, i, array_to_string(ws[i : i + n - 1], ' ') AS win
  FROM (SELECT r, ws, n, unnest(range(1, len(ws) - n + 2)) AS i FROM d, sizes WHERE len(ws) >= n)),
m AS (SELECT DISTINCT dw.r, dw.i, bw.n, bw.item_id FROM dw JOIN bw ON dw.n = bw.n AND dw.win = bw.win),
h AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS p FROM m) GROUP BY r),
k AS (SELECT r, count(*) AS n_items, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS names
      FROM (SELECT DISTINCT r, item_id FROM m WHERE item_id IS NOT NULL) GROUP BY r)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN h ON d.r = h.r LEFT JOIN k ON d.r = k.r
"""


def op12_max_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return max_sketch.top_documents(max_sketch.index(C.documents(spark, sf_dir)), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


OP12_SQL = r"""
WITH d AS (
  SELECT doc_id, r, lower_term AS term, count(*) AS tf FROM (
    SELECT doc_id, r, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS lower_term
    FROM (SELECT doc_id, text, row_number() OVER () AS r FROM documents WHERE text IS NOT NULL)) GROUP BY ALL),
n AS (SELECT doc_id, r, sum(tf)::BIGINT AS n FROM d GROUP BY ALL),
g AS (SELECT count(*)::BIGINT AS n_docs, sum(n)::BIGINT AS total FROM n),
q AS (
  SELECT DISTINCT item_id, text, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS term FROM benchmark),
df AS (SELECT term, count(*)::BIGINT AS df FROM d GROUP BY term),
w AS (SELECT df.term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS w FROM df, g),
s AS (
  SELECT q.item_id, q.text, d.doc_id, d.r,
         sum(w.w * ((1000000000 * d.tf)::BIGINT // (1000 * d.tf + 20 * (100 - 50 + ((50 * n.n * g.n_docs) // g.total)))::BIGINT))::BIGINT AS score
  FROM q JOIN w ON q.term = w.term JOIN d ON d.term = q.term JOIN n ON n.r = d.r, g
  GROUP BY ALL),
k AS (SELECT *, row_number() OVER (PARTITION BY item_id, text ORDER BY score DESC, doc_id NULLS LAST)::INTEGER AS rank FROM s WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM k WHERE rank <= 50
"""


def op13_turn_dawg(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return turn_dawg.repair(turn_dawg.damage(spark.read.parquet(f"{sf_dir}/conversations.parquet")))


OP13_SQL = r"""
WITH RECURSIVE conv AS (SELECT conv_id, row_number() OVER () AS c FROM (SELECT DISTINCT conv_id FROM conversations)),
source AS (
  SELECT c, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(CAST(conversations.conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS name
  FROM conversations JOIN conv ON conversations.conv_id IS NOT DISTINCT FROM conv.conv_id),
kinds AS (
  SELECT name, xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(string_split(name, ''),
           lambda x: list_prepend(ord(x)::BIGINT, [-1, -1, -1, -1, -1, -1, -1, -1]::BIGINT[])))),
           lambda a, e: CASE WHEN e >= 0 THEN xor(a, e) WHEN a % 2 = 1 THEN xor(a // 2, 3988292384::BIGINT) ELSE a // 2 END), 4294967295::BIGINT) % 20 AS kind
  FROM (SELECT DISTINCT name FROM source)),
damaged AS (
  SELECT c, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
         CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
         unnest(CASE kind WHEN 0 THEN [] WHEN 3 THEN [1, 2] ELSE [1] END) AS copy
  FROM source JOIN kinds USING (name)),
keyed AS (
  SELECT c, turn, role, text, substr(role, 1, 1) AS i, md5(length(role) || ':' || role || text) AS k,
         regexp_replace(text, '[\x20\x09-\x0D]+$', '') AS body
  FROM damaged),
told AS (SELECT *, row_number() OVER (PARTITION BY c, k ORDER BY turn NULLS FIRST) > 1 AS again FROM keyed),
faulty AS (
  SELECT c, turn, role, text, i,
         CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank' WHEN again THEN 'duplicate'
              WHEN right(body, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE 'none' END AS fault,
         row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, k, again) AS p,
         lag(i) OVER (PARTITION BY c ORDER BY turn NULLS FIRST, k, again) AS before
  FROM told),
counts AS (
  SELECT c, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (WHERE fault = 'blank') AS blank,
         count(*) FILTER (WHERE fault = 'duplicate') AS duplicate, count(*) FILTER (WHERE fault = 'truncated') AS truncated,
         count(*) FILTER (WHERE p > 1 AND before || i NOT IN ('su', 'ua', 'au')) AS illegal
  FROM faulty GROUP BY c),
walk AS (
  SELECT c, n + 1 AS p, {'c': 0, 'a': ''} AS f0, {'c': 6, 'a': 'II'} AS f1, {'c': 3, 'a': 'I'} AS f2, {'c': 0, 'a': ''} AS f3 FROM counts
  UNION ALL
  SELECT c, p,
         least(b0, {'c': 3 + x2.c, 'a': 'I' || x2.a}) AS f0, least(b1, {'c': 3 + x2.c, 'a': 'I' || x2.a}) AS f1, x2 AS f2,
         least(b3, {'c': 3 + b2.c, 'a': 'I' || b2.a}) AS f3
  FROM (
    SELECT c, p, b0, b1, b2, b3, least(b2, {'c': 3 + b3.c, 'a': 'I' || b3.a}) AS x2
    FROM (
      SELECT w.c, r.p,
        least({'c': 4 + f0.c, 'a': 'D' || f0.a},
              CASE WHEN m >= 0 AND i = 's' THEN {'c': m + f1.c, 'a': 'K' || f1.a} WHEN m >= 0 AND i = 'u' THEN {'c': m + f2.c, 'a': 'K' || f2.a} END,
              CASE WHEN m >= 0 THEN {'c': 3 + m + f2.c, 'a': 'R' || f2.a} END) AS b0,
        least({'c': 4 + f1.c, 'a': 'D' || f1.a}, CASE WHEN m >= 0 AND i = 'u' THEN {'c': m + f2.c, 'a': 'K' || f2.a} END,
              CASE WHEN m >= 0 THEN {'c': 3 + m + f2.c, 'a': 'R' || f2.a} END) AS b1,
        least({'c': 4 + f2.c, 'a': 'D' || f2.a}, CASE WHEN m >= 0 AND i = 'a' THEN {'c': m + f3.c, 'a': 'K' || f3.a} END,
              CASE WHEN m >= 0 THEN {'c': 3 + m + f3.c, 'a': 'R' || f3.a} END) AS b2,
        least({'c': 4 + f3.c, 'a': 'D' || f3.a}, CASE WHEN m >= 0 AND i = 'u' THEN {'c': m + f2.c, 'a': 'K' || f2.a} END,
              CASE WHEN m >= 0 THEN {'c': 3 + m + f2.c, 'a': 'R' || f2.a} END) AS b3
      FROM walk w JOIN (SELECT c, p, i, CASE fault WHEN 'blank' THEN -1 WHEN 'duplicate' THEN -1 WHEN 'truncated' THEN 3 ELSE 0 END AS m FROM faulty) r
        ON w.c = r.c AND r.p = w.p - 1))),
found AS (SELECT c, f0.c AS cost, f0.a AS audit FROM walk WHERE p = 1),
edits AS (SELECT c, e, substr(audit, e, 1) AS x FROM (SELECT c, audit, unnest(range(1, length(audit) + 1)) AS e FROM found)),
placed AS (
  SELECT c, e, x, count(*) FILTER (WHERE x <> 'I') OVER (PARTITION BY c ORDER BY e) AS p, count(*) FILTER (WHERE x <> 'D') OVER (PARTITION BY c ORDER BY e) AS o FROM edits),
shaped AS (
  SELECT placed.c, e, x, o, role, text, max(CASE WHEN x = 'K' AND o = 1 AND i = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY placed.c) AS lead_s
  FROM placed LEFT JOIN faulty ON placed.c = faulty.c AND placed.p = faulty.p AND x <> 'I'),
result AS (
  SELECT c, string_agg(CASE WHEN x = 'K' THEN role WHEN (o - lead_s) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || coalesce(text, ''), chr(10) ORDER BY e) AS t
  FROM shaped WHERE x <> 'D' GROUP BY c)
SELECT conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
       coalesce(illegal, 0) AS illegal, coalesce(cost, 0)::BIGINT AS cost, coalesce(audit, '') AS audit, sha256(coalesce(t, '')) AS repaired_sha256
FROM conv LEFT JOIN counts ON conv.c = counts.c LEFT JOIN found ON conv.c = found.c LEFT JOIN result ON conv.c = result.c
"""

#: name -> (query, DuckDB SQL or None)
QUERIES: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {
    "op1_gru_lm": (op1_gru_lm, None),
    "op2_piece_counts": (op2_piece_counts, None),
    "op4_bpe_sql": (op4_bpe_sql, None),
    "op6_shingle_join": (op6_shingle_join, None),
    "op5_impact_index": (op5_impact_index, OP5_SQL),
    "op9_pfair_mix": (op9_pfair_mix, None),
    "op7_huffman": (op7_huffman, None),
    "op10_lang_id": (op10_lang_id, None),
    "op3_line_dedup": (op3_line_dedup, OP3_SQL),
    "op8_host_rules": (op8_host_rules, OP8_SQL),
    "op11_suffix_decontam": (op11_suffix_decontam, OP11_SQL),
    "op12_max_sketch": (op12_max_sketch, OP12_SQL),
    "op13_turn_dawg": (op13_turn_dawg, OP13_SQL),
}
