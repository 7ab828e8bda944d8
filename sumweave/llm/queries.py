"""One query per operator, over its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from sumweave.llm import (byte_bpe, decontaminate, fill_in_middle, hamming_ann, html_render, license_scan, ngram_join, phrases, quality,
                          substring_dedup, token_huffman, toxicity, url_filter)
from sumweave.llm.registry import ORACLE, QUERIES, query, table
from sumweave.session import scratch_path

__all__ = ["ORACLE", "QUERIES"]

#: The rules of the url query.
URL_RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
             ("net", "/es/", "block"), ("net", "/fr/", "block")]

URL_SQL = r"""
WITH cut AS (
  SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages
), named AS (
  SELECT page_id, rest, regexp_extract(rest, '^[^/?#]*') AS raw FROM cut
), parsed AS (
  SELECT row_number() OVER () AS n, page_id,
         translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path FROM named
), rules(r_host, r_path, action) AS (
  VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
         ('net', '/es/', 'block'), ('net', '/fr/', 'block')
), best AS (
  SELECT n, arg_max(r_host || r_path, length(r_host || r_path)) AS rule, arg_max(action, length(r_host || r_path)) AS action
  FROM parsed JOIN rules ON (host = r_host OR ends_with(host, '.' || r_host)) AND starts_with(path, r_path) GROUP BY n
)
SELECT page_id, host, path, rule, coalesce(action, 'allow') AS verdict FROM parsed LEFT JOIN best USING (n)
"""


REPEATS_SQL = r"""
WITH w AS (
  SELECT row_number() OVER () AS r, doc_id,
         list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents
), win AS (
  SELECT r, s, array_to_string(ws[s:s + 34], ' ') AS g FROM w, unnest(range(1, len(ws) - 33)) AS t(s)
), rep AS (
  SELECT r, list(DISTINCT p) AS gone FROM (
    SELECT r, unnest(range(s, s + 35)) AS p FROM win WHERE g IN (SELECT g FROM win GROUP BY g HAVING count(*) > 1)) GROUP BY r
)
SELECT doc_id, len(ws) AS n_words, coalesce(len(gone), 0) AS n_removed,
       sha256(array_to_string(list_filter(ws, lambda x, i: NOT list_contains(coalesce(gone, []), i)), ' ')) AS kept_sha256
FROM w LEFT JOIN rep USING (r)
"""

SIMILAR_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents
), g AS (
  SELECT DISTINCT doc_id, array_to_string(ws[s:s + 4], ' ') AS g FROM w, unnest(range(1, greatest(len(ws) - 3, 2))) AS t(s) WHERE len(ws) > 0
), n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY 1),
o AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS o FROM g a JOIN g b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
e AS (SELECT a, b FROM o JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * o >= 80 * (x.n + y.n - o)),
reach AS (SELECT doc_id, doc_id AS c FROM w UNION SELECT e.a, c FROM reach JOIN e ON e.b = reach.doc_id WHERE c < e.a)
SELECT w.doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(c) AS component_id
FROM w LEFT JOIN n USING (doc_id) JOIN reach USING (doc_id) GROUP BY 1
"""

DECONTAMINATE_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, list_filter(string_split_regex(translate(coalesce(text, ''),
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS ws FROM documents
), i AS (
  SELECT item_id, list_filter(string_split_regex(translate(coalesce(text, ''),
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS ws FROM benchmark
), iw AS (
  SELECT DISTINCT item_id, least(len(ws), 13) AS m, array_to_string(ws[s:s + 12], ' ') AS g
  FROM i, unnest(range(1, greatest(len(ws) - 11, 2))) AS t(s) WHERE len(ws) > 0
), dw AS (
  SELECT r, s, m, array_to_string(ws[s:s + m - 1], ' ') AS g
  FROM d, (SELECT DISTINCT m FROM iw), unnest(range(1, len(ws) - m + 2)) AS t(s)
), hit AS (SELECT r, s, m, item_id FROM dw JOIN iw USING (m, g)),
p AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(s, s + m)) AS p FROM hit) GROUP BY r),
q AS (SELECT r, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids FROM hit GROUP BY r)
SELECT doc_id, len(ws) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(ws) AS contaminated
FROM d LEFT JOIN p USING (r) LEFT JOIN q USING (r)
"""


MIDDLE_SQL = r"""
WITH t AS (
  SELECT row_number() OVER () AS i, doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS ws,
         sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents
), h AS (
  SELECT i, doc_id, text, ws, len(ws) AS n, ('0x' || substr(h, 1, 8))::BIGINT % (len(ws) + 1) AS x,
         ('0x' || substr(h, 9, 8))::BIGINT % (len(ws) + 1) AS y, ('0x' || substr(h, 17, 8))::BIGINT % 100 AS h3,
         ('0x' || substr(h, 25, 8))::BIGINT % 100 AS h4 FROM t
), c AS (
  SELECT doc_id, n, text, CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 >= 90 THEN 'plain'
         WHEN h4 < 20 THEN 'spm' ELSE 'psm' END AS form, coalesce(array_to_string(ws[1:least(x, y)], ''), '') AS p,
         coalesce(array_to_string(ws[least(x, y) + 1:greatest(x, y)], ''), '') AS m, coalesce(array_to_string(ws[greatest(x, y) + 1:], ''), '') AS s FROM h
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END)
       AS output_sha256, sha256(text) AS restored_sha256 FROM c
"""

PHRASES_SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents
), words AS (
  SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda x: x <> '') AS ws FROM pieces
), pos AS (SELECT lang, ws, unnest(range(1, len(ws) + 1)) AS s FROM words
), win AS (SELECT lang, s, len(ws) - s + 1 AS rest, ws[s:s + 3] AS w FROM pos
), grams AS (SELECT lang, w, unnest(range(1, least(rest, 4) + 1)) AS m FROM win
), f AS (
  SELECT lang, m, array_to_string(w[:m], ' ') AS phrase, count(*) AS n FROM grams GROUP BY ALL
), total AS (SELECT lang, sum(n)::BIGINT AS n FROM f WHERE m = 1 GROUP BY lang),
c AS (SELECT lang, m, phrase, string_split(phrase, ' ') AS ws, n AS a FROM f WHERE m >= 2 AND n >= 30),
c1 AS (SELECT *, unnest(range(1, m)) AS k FROM c),
k AS (SELECT *, array_to_string(ws[:k], ' ') AS x, array_to_string(ws[k + 1:], ' ') AS y FROM c1),
cut AS (
  SELECT k.lang, k.phrase, k.a, f1.n AS l, f2.n AS r, ((2000000::HUGEINT * k.a) // (f1.n + f2.n))::BIGINT AS score
  FROM k JOIN f f1 ON f1.lang = k.lang AND f1.phrase = x JOIN f f2 ON f2.lang = k.lang AND f2.phrase = y
  QUALIFY row_number() OVER (PARTITION BY k.lang, k.phrase ORDER BY score, k) = 1
), part AS (
  SELECT lang, array_to_string(ws[s:s + j - 1], ' ') AS phrase, max(a) AS more
  FROM (SELECT *, unnest(range(1, m - j + 2)) AS s FROM (SELECT *, unnest(range(2, m)) AS j FROM c)) GROUP BY ALL
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, total.n AS n, score
FROM cut LEFT JOIN part USING (lang, phrase) JOIN total USING (lang)
WHERE more IS NULL OR 100 * more::HUGEINT < 80 * a::HUGEINT QUALIFY rank <= 2000
"""


@query("op1_substring_dedup", REPEATS_SQL)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.digests(substring_dedup.remove_repeats(spark, table(spark, sf_dir, "documents")))


@query("op3_ngram_join", SIMILAR_SQL)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.similar_documents(spark, table(spark, sf_dir, "documents"))


@query("op5_url_filter", URL_SQL)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages"), url_filter.rules_frame(spark, URL_RULES))


@query("op6_decontaminate", DECONTAMINATE_SQL)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.report(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op7_toxicity")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.judged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op8_byte_bpe")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.digests(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"),
                            public_tokenizers.PATTERN)


@query("op9_token_huffman")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_huffman.through_files(spark, table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), 1,
                                       scratch_path(spark, "tokens"))


@query("op10_hamming_ann")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hamming_ann.search(spark, table(spark, sf_dir, "embeddings"))


@query("op4_html_render")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_render.extract(table(spark, sf_dir, "pages"))


@query("op2_license_scan")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(spark, table(spark, sf_dir, "documents"))


@query("op11_quality")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op12_fill_in_middle", MIDDLE_SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_in_middle.digests(table(spark, sf_dir, "documents"))


@query("op13_phrases", PHRASES_SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.mine(table(spark, sf_dir, "documents"))
