"""Registered queries of the corpus operators: ``QUERIES`` (name -> callable)
and ``ORACLES`` (name -> DuckDB SQL, where SQL can express the result)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (chat_tree, embedding_dedup, html_extraction, license_scan, line_dedup, mixing, perplexity, prefix_trie,
               quality, sentencepiece_codec, simhash, spelling, substring_dedup)
from .common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash groups: 4-word shingles, at most 4 differing bits."""
    out = simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=4, max_bits=4)
    return out.select("doc_id", simhash.fp_hex("fp").alias("fingerprint"), "component_id")


@query
def op5_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Word budgets of 150 % of all sizes by source, at most 2 epochs."""
    plan = mixing.plan_mix(table(spark, sf_dir, "documents"), budget=1.5, max_epochs=2, weights=(3, 1, 2), seed=7)
    return plan.select("doc_id", "size", "source_size", F.round("target", 6).alias("target"), "taken")


ORACLES["op5_mix_sources"] = r"""
WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         1 - CAST(0.9 AS DOUBLE) * (length(coalesce(text, '')) - length(translate(coalesce(text, ''), '#*$%&|<>', '')))
             / greatest(length(coalesce(text, '')), 1) AS w,
         (CAST(('0x' || substr(md5('7:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 12)) AS BIGINT) + CAST(0.5 AS DOUBLE))
             / CAST(281474976710656 AS DOUBLE) AS u
  FROM documents),
k AS (SELECT *, -ln(u) / w AS key FROM d),
s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         CAST([3, 1, 2][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS DOUBLE) AS w
  FROM k GROUP BY source),
r AS (
  SELECT *, CAST(2 * source_size AS DOUBLE) AS stop,
         (CAST(1.5 AS DOUBLE) * sum(source_size) OVER ()
          - coalesce(sum(2 * source_size) OVER (ORDER BY 2 * source_size / w, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
         / sum(w) OVER (ORDER BY 2 * source_size / w, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM s),
t AS (
  SELECT source, source_size,
         least(stop, w * (SELECT level FROM r WHERE stop > w * level ORDER BY 2 * source_size / w, source LIMIT 1)) AS target
  FROM r),
e AS (
  SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS epochs FROM t),
p AS (
  SELECT k.doc_id, k.size, e.source_size, e.target, e.epochs,
         CAST(round(e.target - e.epochs * e.source_size) AS BIGINT) AS rest,
         CAST(coalesce(sum(k.size) OVER (PARTITION BY k.source ORDER BY k.key, k.doc_id
              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS ahead
  FROM k JOIN e ON k.source IS NOT DISTINCT FROM e.source)
SELECT doc_id, size, source_size, round(target, 6) AS target,
       CAST(epochs * size + greatest(0, least(size, rest - ahead)) AS BIGINT) AS taken
FROM p"""


@query
def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence phrases and templates of every document."""
    out = license_scan.scan(table(spark, sf_dir, "documents"))
    starts = F.transform("places", lambda p: p["start"])
    return out.select("doc_id", "n_words", F.size("places").cast("bigint").alias("n_base"),
                      F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
                      F.array_join("base_labels", ",").alias("base_labels"), F.array_join("labels", ",").alias("labels"),
                      F.round("score", 6).alias("score"))


def _phrase_rows(rows) -> str:
    quote = lambda words: "[" + ", ".join(f"'{w}'" for w in words.split()) + "]"
    return ", ".join(f"('{n}', {b}, {quote(t)}, {quote(p)}, {t.split().index(p.split()[0])})" for n, b, t, p in rows)


ORACLES["op9_license_scan"] = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
  FROM documents),
t(label, base, words, phrase, shift) AS (VALUES """ + _phrase_rows(
    [(n, 1, p, p) for n, p in license_scan.BASE] + [(n, 0, t, p) for n, t, p in license_scan.TEMPLATES]) + r"""),
w AS (SELECT rid, ws, unnest(ws) AS word, CAST(generate_subscripts(ws, 1) AS BIGINT) AS p FROM d),
m AS (
  SELECT w.rid, t.label, t.base, w.p - 1 - t.shift AS start,
         list_sum([CASE WHEN w.p - t.shift + o > 0 AND w.ws[w.p - t.shift + o] = t.words[o + 1] THEN 1 ELSE 0 END
                   FOR o IN range(len(t.words))]) / len(t.words) AS share
  FROM w JOIN t ON w.word = t.phrase[1]
  WHERE w.ws[w.p : w.p + len(t.phrase) - 1] = t.phrase),
g AS (
  SELECT rid, CAST(count(*) FILTER (base = 1) AS BIGINT) AS n_base, min(start) FILTER (base = 1) AS first_word,
         max(start) FILTER (base = 1) AS last_word,
         string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base = 1) AS base_labels,
         string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base = 1 OR share >= 0.5) AS labels,
         max(share) AS score
  FROM m GROUP BY rid)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
       coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, round(coalesce(score, 0), 6) AS score
FROM d LEFT JOIN g USING (rid)"""


@query
def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality scores of a regularised quadratic discriminant."""
    out = quality.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return out.select("doc_id", "held_out", "score", "predicted")


@query
def op7_perplexity_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base rules and perplexity bands by language."""
    out = perplexity.apply_rules(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                      "kept", F.round("nll", 6).alias("nll"))


@query
def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines that patience diff aligns with an earlier document go."""
    out = line_dedup.dedup_lines(table(spark, sf_dir, "documents"), report=True)
    return out.select("doc_id", "n_lines", "n_cut", F.sha2("text", 256).alias("kept_sha256"))


@query
def op10_sentencepiece_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every whole text, and whether they decode to the text."""
    docs = table(spark, sf_dir, "documents").withColumn("text_sha256", F.sha2(F.coalesce("text", F.lit("")), 256))
    encoded = sentencepiece_codec.encode(docs, keep=("text_sha256",))
    decoded = sentencepiece_codec.decode(encoded, keep=("doc_id", "n_tokens", "ids", "text_sha256"))
    return decoded.select("doc_id", "n_tokens", "ids",
                          (F.sha2("text", 256) == F.col("text_sha256")).alias("round_trip"))


@query
def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words covered by a 50-word window of an earlier document."""
    out = substring_dedup.repeated_spans(table(spark, sf_dir, "documents"), window=50)
    n = F.aggregate("spans", F.lit(0).cast("bigint"), lambda a, s: a + s["end"] - s["start"])
    return out.select("doc_id", "n_words", n.alias("n_removed"), "kept_sha256")


# Every window of every document, grouped as text.
ORACLES["op3_substring_dedup"] = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
p AS (SELECT doc_id, ws, unnest(range(1, len(ws) - 48)) AS i FROM d WHERE len(ws) >= 50),
h AS (SELECT doc_id, i, md5(array_to_string(ws[i : i + 49], ' ')) AS w FROM p),
f AS (SELECT w, min(doc_id) AS first FROM h GROUP BY w),
r AS (SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS k FROM h JOIN f USING (w) WHERE first < doc_id),
g AS (SELECT doc_id, list(k) AS gone FROM r GROUP BY doc_id)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(len(gone), 0) AS BIGINT) AS n_removed,
       sha256(array_to_string(CASE WHEN gone IS NULL THEN ws
              ELSE [ws[k] FOR k IN range(1, len(ws) + 1) IF NOT list_contains(gone, k)] END, ' ')) AS kept_sha256
FROM d LEFT JOIN g USING (doc_id)"""


@query
def op2_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors linked at cosine 0.9 or more."""
    return embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings"), threshold=0.9)


ORACLES["op2_embedding_dedup"] = r"""
WITH RECURSIVE n AS (
  SELECT vec_id, [CAST(x AS DOUBLE) FOR x IN embedding] AS v FROM embeddings
  WHERE embedding IS NOT NULL AND list_count(embedding) = len(embedding)
    AND list_bool_and([isfinite(x) FOR x IN embedding]) AND list_bool_or([x <> 0 FOR x IN embedding])),
e AS (SELECT a.vec_id AS a, b.vec_id AS b FROM n a JOIN n b ON a.vec_id <> b.vec_id
      WHERE list_cosine_similarity(a.v, b.v) >= 0.9),
r AS (SELECT vec_id AS a, vec_id AS b FROM embeddings UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a),
c AS (SELECT a, min(b) AS component_id FROM r GROUP BY a),
d AS (SELECT a, count(*) AS n FROM e GROUP BY a)
SELECT vec_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings LEFT JOIN d ON vec_id = d.a LEFT JOIN c ON vec_id = c.a"""


PROBE = "\\### Assistant: </turn> ok"


@query
def op4_chat_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations through the prefix tree and back."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.range(1).select(F.explode(F.array(*[
        F.struct(F.lit(-7).cast("bigint").alias("conv_id"), F.lit(i).cast("bigint").alias("turn"), F.lit(r).alias("role"),
                 F.lit(PROBE).alias("text")) for i, r in enumerate(("user", "assistant"))])).alias("t")).select("t.*")
    back = chat_tree.read_back(*chat_tree.format_tree(turns.unionByName(probe)))
    all_turns = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.array_join("loss_texts", "")
    return back.select("conv_id", F.size("turns").cast("bigint").alias("n_turns"),
                       F.sha2(all_turns, 256).alias("turns_sha256"), F.length(loss).cast("bigint").alias("loss_chars"),
                       F.sha2(loss, 256).alias("loss_sha256"), F.length("formatted").cast("bigint").alias("formatted_chars"))


ORACLES["op4_chat_tree"] = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT * FROM (VALUES (-7, 0, 'user', '\### Assistant: </turn> ok'),
                                  (-7, 1, 'assistant', '\### Assistant: </turn> ok')) v(conv_id, turn, role, text)),
e AS (SELECT *, length(text) + length(regexp_replace(text, '[^\\#<]', '', 'g'))
                + length(role) + length(regexp_replace(role, '[^\\#<:\n]', '', 'g')) + 14 AS chars FROM t)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(chars) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id"""


def _crc32_sql(strings: str) -> str:
    """CTEs (for WITH RECURSIVE) that give ``crc(s, crc)`` of the strings
    ``s`` of a query: the byte table by rule, then one byte a step."""
    return f"""
crc_table AS (
  SELECT range AS i, list_reduce([range, 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: xor(x >> 1, 3988292384 * (x & 1))) AS c
  FROM range(256)),
crc_in AS ({strings}),
crc_step AS (
  SELECT s, hex(encode(s)) AS hx, 0 AS k, CAST(4294967295 AS BIGINT) AS c FROM crc_in
  UNION ALL
  SELECT s, hx, k + 1, xor(p.c >> 8, t.c)
  FROM crc_step p JOIN crc_table t ON t.i = xor(p.c, CAST(('0x' || substr(hx, 2 * k + 1, 2)) AS BIGINT)) & 255
  WHERE 2 * k < length(hx)),
crc AS (SELECT s, xor(c, 4294967295) AS crc FROM crc_step WHERE 2 * k = length(hx))"""


@query
def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prefix trie of conversations that share first turns within a family."""
    turns, ids = prefix_trie.share_heads(prefix_trie.turn_digests(table(spark, sf_dir, "conversations")))
    return prefix_trie.prefix_trie(turns, ids).select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


ORACLES["op13_conversation_trie"] = "WITH RECURSIVE" + _crc32_sql(
    "SELECT DISTINCT CAST(conv_id AS VARCHAR) AS s FROM conversations WHERE conv_id IS NOT NULL") + r""",
ids AS (
  SELECT conv_id, conv_id - conv_id % 100 AS base, crc % 6 AS h
  FROM (SELECT DISTINCT conv_id FROM conversations WHERE conv_id IS NOT NULL) JOIN crc ON s = CAST(conv_id AS VARCHAR)),
t AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) - 1 AS pos,
         sha256(coalesce(role, '')) || sha256(coalesce(text, '')) AS k, length(coalesce(text, '')) AS size
  FROM conversations WHERE conv_id IS NOT NULL),
r AS (
  SELECT i.conv_id, 0 AS part, t.pos, t.k, t.size FROM ids i JOIN t ON t.conv_id = i.base AND t.pos < i.h
  UNION ALL
  SELECT i.conv_id, 1, t.pos, t.k, t.size FROM ids i JOIN t ON t.conv_id = i.conv_id AND t.pos >= i.h),
c AS (
  SELECT conv_id, coalesce(list(k ORDER BY part, pos) FILTER (k IS NOT NULL), []) AS ks,
         coalesce(list(size ORDER BY part, pos) FILTER (k IS NOT NULL), []) AS sizes
  FROM ids LEFT JOIN r USING (conv_id) GROUP BY conv_id),
p AS (
  SELECT conv_id, d, sha256(array_to_string(ks[1:d], '')) AS k,
         CASE WHEN d = 0 THEN '' ELSE sha256(array_to_string(ks[1:d-1], '')) END AS up, coalesce(sizes[d], 0) AS size,
         d = len(ks) AS tail
  FROM c, LATERAL (SELECT unnest(range(0, len(ks) + 1)) AS d)),
n AS (
  SELECT d, k, up, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(size) AS size,
         sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (tail), '')) AS ends_sha256
  FROM p GROUP BY d, k, up),
kids AS (SELECT d - 1 AS d, up AS k, count(*) AS n_children FROM n WHERE d > 0 GROUP BY 1, 2),
m AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM n LEFT JOIN kids USING (d, k)),
below AS (
  SELECT p.d, p.k, sum((m.n_convs - 1) * m.size) AS saved_tokens, count(*) FILTER (m.n_children = 0) AS n_leaves
  FROM m JOIN p ON p.conv_id = m.conv_id AND p.d <= m.d GROUP BY p.d, p.k)
SELECT m.conv_id, CAST(m.d AS BIGINT) AS depth, u.conv_id AS parent_conv_id, CAST(m.n_convs AS BIGINT) AS n_convs,
       CAST(m.n_children AS BIGINT) AS n_children, CAST(n_leaves AS BIGINT) AS n_leaves,
       CAST(saved_tokens AS BIGINT) AS saved_tokens, m.ends_sha256
FROM m JOIN below USING (d, k) LEFT JOIN n u ON u.d = m.d - 1 AND u.k = m.up"""


@query
def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words one edit apart, their commoner forms and the roots of those."""
    words = spelling.count_words(table(spark, sf_dir, "documents"), slip=97, min_length=5, min_count=3)
    return spelling.spelling_variants(words).select("word", "n", "n_near", "form", "form_n", "root")


ORACLES["op12_spelling_variants"] = "WITH RECURSIVE run AS (" + r"""
  SELECT id, run, count(*) AS n FROM (
    SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id,
           unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[a-z\x{00C0}-\x{00FF}]+')) AS run
    FROM documents) GROUP BY id, run),""" + _crc32_sql("SELECT DISTINCT id || ':' || run AS s FROM run") + r""",
v AS (
  SELECT word, CAST(sum(n) AS BIGINT) AS n FROM (
    SELECT CASE WHEN crc % 97 = 0 THEN substr(run, 1, crc % length(run)) || substr(run, crc % length(run) + 2) ELSE run END AS word, n
    FROM run JOIN crc ON s = id || ':' || run)
  WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3),
gap AS (
  SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest
  FROM v, LATERAL (SELECT unnest(range(1, length(word) + 1)) AS i)),
pair AS (
  SELECT a.word AS a, a.n AS na, b.word AS b, b.n AS nb FROM gap a JOIN gap b USING (i, rest) WHERE a.word <> b.word
  AND length(a.word) = length(b.word)
  UNION ALL
  SELECT DISTINCT gap.word, gap.n, v.word, v.n FROM gap JOIN v ON v.word = gap.rest
  UNION ALL
  SELECT DISTINCT v.word, v.n, gap.word, gap.n FROM gap JOIN v ON v.word = gap.rest),
near AS (
  SELECT a AS word, count(*) AS n_near, max(nb) AS best_n FROM pair GROUP BY a),
best AS (
  SELECT near.word, near.n_near, near.best_n, min(b) AS best
  FROM near JOIN pair ON a = near.word AND nb = best_n GROUP BY 1, 2, 3),
f AS (
  SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN best_n >= 2 * v.n THEN best END AS form,
         CASE WHEN best_n >= 2 * v.n THEN best_n END AS form_n
  FROM v LEFT JOIN best USING (word)),
way AS (
  SELECT word, word AS last, 0 AS k FROM f
  UNION ALL
  SELECT way.word, f.form, k + 1 FROM way JOIN f ON f.word = way.last WHERE f.form IS NOT NULL)
SELECT f.word, f.n, CAST(n_near AS BIGINT) AS n_near, form, CAST(form_n AS BIGINT) AS form_n, root
FROM f JOIN (SELECT word, arg_max(last, k) AS root FROM way GROUP BY word) USING (word)"""


@query
def op11_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page by the recurrent block labeller."""
    out = html_extraction.extract(table(spark, sf_dir, "pages"))
    return out.select("page_id", "url", "text", F.length("text").cast("bigint").alias("n_chars"))


# SQL cannot read markup in general; it can for the elements of the given pages.
ORACLES["op11_html_extraction"] = r"""
WITH a AS (
  SELECT page_id, url, list_transform(
    string_split_regex(regexp_replace(regexp_extract(coalesce(html, ''), '(?s)<article[^>]*>(.*?)(</article>|$)', 1),
                                      '</?b>|<br>', ' ', 'g'), '</?(p|h1)>'),
    lambda x: trim(regexp_replace(replace(replace(regexp_replace(regexp_replace(x, '&quot;?', '"', 'g'), '&amp;?', '&', 'g'),
                                                  '&lt;', '<'), '&gt;', '>'), '\s+', ' ', 'g'))) AS blocks
  FROM pages)
SELECT page_id, url, array_to_string(list_filter(blocks, lambda x: x <> ''), chr(10)) AS text,
       CAST(length(array_to_string(list_filter(blocks, lambda x: x <> ''), chr(10))) AS BIGINT) AS n_chars
FROM a"""
