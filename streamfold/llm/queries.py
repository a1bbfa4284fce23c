"""The registered queries of the corpus operators, and their SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from . import (automaton_dedup, conversation_trie, exact_dedup, fill_middle, html_extract, language_id, line_dedup,
               mixing, sentencepiece_codec, simhash, suffix_dedup, topk, url_filter)
from .common import table

# --- fixed values of the contracts ---
URL_RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"),
             ("org", "/fr/", "allow")]
PIECE_MODEL = "piece_bpe_32k.model"
TOP_K = 10
QUERY_EVERY = 100
# ---


def op1_exact_dedup(spark, sf_dir):
    got = exact_dedup.exact_groups(table(spark, sf_dir, "documents", "doc_id", "text"))
    return got.select(F.col("id").alias("doc_id"), F.col("keep").alias("keep_id"), F.col("size").alias("group_size"),
                      exact_dedup.is_kept().alias("kept"), F.lower(F.hex("d")).alias("text_sha256"))


def op2_line_dedup(spark, sf_dir):
    got = line_dedup.dedup_lines(table(spark, sf_dir, "documents", "doc_id", "text"), report=True)
    return got.select("doc_id", F.col("_sf_lines").alias("n_lines"), F.col("_sf_removed").alias("n_removed"),
                      F.col("_sf_runs").alias("n_runs"), F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def op3_suffix_dedup(spark, sf_dir):
    return suffix_dedup.dedup_substrings(table(spark, sf_dir, "documents", "doc_id", "text"), digests=True)


def op4_mixing(spark, sf_dir):
    return mixing.mix_report(table(spark, sf_dir, "documents", "doc_id", "text", "source"))


def op5_language_id(spark, sf_dir):
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "lang").withColumn("held_out", language_id.held_out())
    model = language_id.fit(docs.filter(~F.col("held_out")))
    return language_id.predict(docs, model, carry=("doc_id", "held_out"))


def op6_exact_top_k(spark, sf_dir):
    return topk.top_k(table(spark, sf_dir, "embeddings", "vec_id", "embedding"), F.col("id") % QUERY_EVERY == 0, TOP_K)


def op7_simhash(spark, sf_dir):
    got = simhash.near_duplicates(table(spark, sf_dir, "documents", "doc_id", "text"))
    return got.select(F.col("id").alias("doc_id"), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
                      F.col("component").alias("component_id"))


def op8_html_extraction(spark, sf_dir):
    return html_extract.extract(table(spark, sf_dir, "pages", "page_id", "url", "html"))


def op9_url_filters(spark, sf_dir):
    rules = spark.sql(f"SELECT * FROM VALUES {', '.join(map(str, URL_RULES))} AS rules(host, path, verdict)")
    return url_filter.judge(table(spark, sf_dir, "pages", "page_id", "url"), rules).drop("url")


def op10_sentencepiece(spark, sf_dir):
    return sentencepiece_codec.encode(table(spark, sf_dir, "documents", "doc_id", "text"),
                                      public_tokenizers.path(PIECE_MODEL), digests=True)


def op11_substring_dedup(spark, sf_dir):
    return automaton_dedup.dedup_passages(table(spark, sf_dir, "documents", "doc_id", "text"), digests=True)


def op12_conversation_trie(spark, sf_dir):
    return conversation_trie.conversation_trie(table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text"),
                                               rebuild=conversation_trie.with_shared_heads)


def op13_fill_in_middle(spark, sf_dir):
    return fill_middle.fill_in_middle(table(spark, sf_dir, "documents", "doc_id", "text"), digests=True)


QUERIES = {f.__name__: f for f in (op1_exact_dedup, op2_line_dedup, op3_suffix_dedup, op4_mixing, op5_language_id,
                                   op6_exact_top_k, op7_simhash, op8_html_extraction, op9_url_filters,
                                   op10_sentencepiece, op11_substring_dedup, op12_conversation_trie, op13_fill_in_middle)}

ORACLE_SQL = {}

ORACLE_SQL["op1_exact_dedup"] = r"""
WITH t AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents)
SELECT doc_id, min(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
       doc_id IS NOT DISTINCT FROM min(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256
FROM t"""

ORACLE_SQL["op2_line_dedup"] = r"""
WITH lines AS (
  SELECT doc_id, pos, line, trim(line, E' \t\r\x0b\x0c') AS s
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
               unnest(range(len(string_split(text, chr(10))))) AS pos
        FROM documents WHERE text <> '')),
content AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS k FROM lines WHERE s <> ''),
wins AS (
  SELECT * FROM (
    SELECT doc_id, k, s || chr(10) || lead(s, 1) OVER w || chr(10) || lead(s, 2) OVER w AS win
    FROM content WINDOW w AS (PARTITION BY doc_id ORDER BY k)) WHERE win IS NOT NULL),
later AS (
  SELECT doc_id, k FROM (
    SELECT doc_id, k, row_number() OVER (PARTITION BY win ORDER BY doc_id, k) AS nth FROM wins) WHERE nth > 1),
gone AS (SELECT DISTINCT doc_id, k + d AS k FROM later, (SELECT unnest([0, 1, 2]) AS d)),
marked AS (
  SELECT c.doc_id, c.pos, c.k, g.k IS NOT NULL AS drop_it FROM content c LEFT JOIN gone g USING (doc_id, k)),
around AS (
  SELECT l.doc_id, l.pos, l.line, m.drop_it,
         last_value(m.drop_it IGNORE NULLS) OVER (PARTITION BY l.doc_id ORDER BY l.pos
           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS before,
         first_value(m.drop_it IGNORE NULLS) OVER (PARTITION BY l.doc_id ORDER BY l.pos
           ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS after
  FROM lines l LEFT JOIN marked m USING (doc_id, pos)),
judged AS (
  SELECT doc_id, pos, line, coalesce(drop_it, before AND after, false) AS dropped FROM around),
edges AS (
  SELECT *, dropped AND NOT coalesce(lag(dropped) OVER (PARTITION BY doc_id ORDER BY pos), false) AS starts FROM judged),
per_doc AS (
  SELECT doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_removed, count(*) FILTER (starts) AS n_runs,
         coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT dropped), '') AS kept
  FROM edges GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_removed, 0) AS n_removed, coalesce(n_runs, 0) AS n_runs,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM documents d LEFT JOIN per_doc p USING (doc_id)"""

ORACLE_SQL["op6_exact_top_k"] = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         CAST(coalesce(list_sum(list_transform(list_zip(q.e, c.e), lambda p: p[1] * p[2])), 0) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id AND len(q.e) = len(c.e))
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
WHERE rank <= 10"""

ORACLE_SQL["op9_url_filters"] = r"""
WITH u AS (
  SELECT page_id, translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1),
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path
  FROM pages),
rules(rh, rp, rv) AS (VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'),
                             ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
ranked AS (
  SELECT u.*, (SELECT max(struct_pack(n := length(rh) + length(rp), r := rh || rp, v := rv)) FROM rules
               WHERE (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp)) AS best
  FROM u)
SELECT page_id, host, path, best.r AS rule, coalesce(best.v, 'allow') AS verdict FROM ranked"""


ORACLE_SQL["op11_substring_dedup"] = r"""
WITH words AS (
  SELECT doc_id, unnest(w) AS word, unnest(range(len(w))) AS pos
  FROM (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents)),
wins AS (
  SELECT doc_id, pos, word, string_agg(word, ' ') OVER w AS win, count(*) OVER w AS n
  FROM words WINDOW w AS (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN CURRENT ROW AND 12 FOLLOWING)),
firsts AS (SELECT win, min(doc_id) AS first FROM wins WHERE n = 13 GROUP BY win),
marked AS (
  SELECT w.doc_id, pos, word, n = 13 AND first < w.doc_id AS later FROM wins w LEFT JOIN firsts f USING (win)),
covered AS (
  SELECT doc_id, pos, word, max(CAST(later AS INTEGER)) OVER (PARTITION BY doc_id ORDER BY pos
           ROWS BETWEEN 12 PRECEDING AND CURRENT ROW) = 1 AS gone
  FROM marked),
per_doc AS (
  SELECT doc_id, count(*) AS n_words, count(*) FILTER (gone) AS n_removed,
         coalesce(string_agg(word, ' ' ORDER BY pos) FILTER (NOT gone), '') AS kept
  FROM covered GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM documents d LEFT JOIN per_doc p USING (doc_id)"""

ORACLE_SQL["op12_conversation_trie"] = """
WITH RECURSIVE tab(i, k, v) AS (
  SELECT i, 0, i FROM (SELECT unnest(range(256)) AS i)
  UNION ALL
  SELECT i, k + 1, CASE WHEN v % 2 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END FROM tab WHERE k < 8),
crc_table AS (SELECT list(v ORDER BY i) AS crcs FROM tab WHERE k = 8),
turns AS (
  SELECT conv_id, said, chars, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, said) AS pos
  FROM (SELECT conv_id, turn, length(coalesce(text, '')) AS chars,
               sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS said
        FROM conversations WHERE conv_id IS NOT NULL)),
heads AS (
  SELECT conv_id, xor(list_reduce(list_prepend(4294967295, list_transform(
           string_split(CAST(conv_id AS VARCHAR), ''), lambda s: CAST(ascii(s) AS BIGINT))),
           lambda c, b: xor(c >> 8, crcs[(xor(c, b) & 255) + 1])), 4294967295) % 6 AS h
  FROM (SELECT DISTINCT conv_id FROM turns), crc_table),
rebuilt AS (
  SELECT h.conv_id, t.said, t.chars, 0 AS part, t.pos FROM heads h JOIN turns t ON t.conv_id = h.conv_id - h.conv_id % 100 AND pos <= h
  UNION ALL SELECT h.conv_id, t.said, t.chars, 1, t.pos FROM heads h JOIN turns t USING (conv_id) WHERE pos > h),
paths AS (
  SELECT conv_id, chars, row_number() OVER w AS depth, sha256(string_agg(said, '') OVER w) AS k FROM rebuilt
  WINDOW w AS (PARTITION BY conv_id ORDER BY part, pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
  UNION ALL SELECT conv_id, 0, 0, '' FROM heads),
steps AS (
  SELECT *, lag(k) OVER (PARTITION BY conv_id ORDER BY depth) AS up,
         depth = max(depth) OVER (PARTITION BY conv_id) AS ending FROM paths),
nodes AS (
  SELECT k, any_value(up) AS up, any_value(depth) AS depth, any_value(chars) AS chars, min(conv_id) AS conv_id, count(*) AS n_convs,
         sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (ending), '')) AS ends_sha256
  FROM steps GROUP BY k),
kids AS (SELECT up AS k, count(*) AS n_children FROM nodes GROUP BY up),
full_nodes AS (
  SELECT n.*, coalesce(n_children, 0) AS n_children, (n_convs - 1) * chars AS saved FROM nodes n LEFT JOIN kids USING (k)),
sums AS (
  SELECT p.k, count(*) FILTER (n.n_children = 0) AS n_leaves, sum(n.saved) AS saved_tokens
  FROM full_nodes n JOIN paths p ON p.conv_id = n.conv_id AND p.depth <= n.depth GROUP BY p.k)
SELECT n.conv_id, n.depth, u.conv_id AS parent_conv_id, n.n_convs, n.n_children, s.n_leaves,
       CAST(s.saved_tokens AS BIGINT) AS saved_tokens, n.ends_sha256
FROM full_nodes n JOIN sums s USING (k) LEFT JOIN nodes u ON u.k = n.up"""

ORACLE_SQL["op13_fill_in_middle"] = r"""
WITH t AS (
  SELECT doc_id, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS tok,
         sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h
  FROM documents),
d AS (
  SELECT doc_id, t, tok, len(tok) AS n,
         CAST('0x' || h[1:8] AS BIGINT) % (len(tok) + 1) AS a, CAST('0x' || h[9:16] AS BIGINT) % (len(tok) + 1) AS b,
         CAST('0x' || h[17:24] AS BIGINT) % 100 AS c, CAST('0x' || h[25:32] AS BIGINT) % 100 AS s
  FROM t),
p AS (
  SELECT doc_id, t, n, array_to_string(tok[:least(a, b)], '') AS pre,
         array_to_string(tok[least(a, b) + 1:greatest(a, b)], '') AS mid,
         array_to_string(tok[greatest(a, b) + 1:], '') AS suf,
         CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR c >= 50 THEN 'plain'
              WHEN s < 80 THEN 'spm' ELSE 'psm' END AS form
  FROM d)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(pre) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(mid) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
              ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM p"""
