"""Queries and SQL of the training-data operators."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from arcloom.llm import (
    decontaminate,
    exact_dedup,
    html_extract,
    jaccard_join,
    language_id,
    maxent_lm,
    sentencepiece_codec,
    token_files,
    toxicity,
    url_filter,
)
from arcloom.llm.text import documents

QUERIES: dict = {}
ORACLE_SQL: dict = {}


def op4_exact_dedup(spark, sf_dir):
    return exact_dedup.exact_groups(documents(spark, sf_dir, "doc_id", "text"))


QUERIES["op4_exact_dedup"] = op4_exact_dedup
ORACLE_SQL["op4_exact_dedup"] = r"""
WITH t AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
  FROM documents)
SELECT doc_id, min(doc_id) OVER (PARTITION BY text_sha256) AS keep_id,
       count(*) OVER (PARTITION BY text_sha256) AS group_size,
       doc_id = min(doc_id) OVER (PARTITION BY text_sha256) AS kept, text_sha256
FROM t
"""


def op8_token_files(spark, sf_dir):
    docs = documents(spark, sf_dir, "doc_id", "text")
    return token_files.digest_documents(docs, public_tokenizers.path("word_bpe_49k.json"), 2)


QUERIES["op8_token_files"] = op8_token_files


def op10_sentencepiece(spark, sf_dir):
    docs = documents(spark, sf_dir, "doc_id", "text")
    return sentencepiece_codec.digest_documents(docs, public_tokenizers.path("piece_bpe_32k.model"))


QUERIES["op10_sentencepiece"] = op10_sentencepiece


def op6_decontaminate(spark, sf_dir):
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text")
    return decontaminate.judge(decontaminate.find_hits(documents(spark, sf_dir, "doc_id", "text"), items))


QUERIES["op6_decontaminate"] = op6_decontaminate
ORACLE_SQL["op6_decontaminate"] = r"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
  FROM documents),
i AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
  FROM benchmark),
iw AS (
  SELECT DISTINCT item_id, least(10, len(ws)) AS m, array_to_string(ws[p:p + least(10, len(ws)) - 1], ' ') AS win
  FROM (SELECT item_id, ws, unnest(range(1, greatest(len(ws) - 9, 1) + 1)) AS p FROM i WHERE len(ws) > 0)),
dw AS (
  SELECT doc_id, p, m, array_to_string(ws[p:p + m - 1], ' ') AS win
  FROM (SELECT doc_id, ws, m, unnest(range(1, len(ws) - m + 2)) AS p
        FROM w, (SELECT DISTINCT m FROM iw) WHERE len(ws) >= m)),
hit AS (SELECT doc_id, p, dw.m, item_id FROM dw JOIN iw ON dw.m = iw.m AND dw.win = iw.win),
hw AS (SELECT doc_id, count(DISTINCT x) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + m)) AS x FROM hit) GROUP BY 1),
hi AS (SELECT doc_id, count(DISTINCT item_id) AS n_items,
              array_to_string(list_sort(list(DISTINCT CAST(item_id AS VARCHAR))), ',') AS s FROM hit GROUP BY 1)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(s, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM w LEFT JOIN hw USING (doc_id) LEFT JOIN hi USING (doc_id)
"""


def op3_jaccard_join(spark, sf_dir):
    return jaccard_join.linked_components(documents(spark, sf_dir, "doc_id", "text"))


QUERIES["op3_jaccard_join"] = op3_jaccard_join
ORACLE_SQL["op3_jaccard_join"] = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws
  FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(ws[p:p + 3], ' ') AS sh
  FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 3, 1) + 1)) AS p FROM w WHERE len(ws) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
c AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS o FROM s x JOIN s y ON x.sh = y.sh AND x.doc_id <> y.doc_id GROUP BY 1, 2),
e AS (SELECT a, b FROM c JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * o >= 85 * (na.n + nb.n - o)),
r AS (SELECT doc_id, doc_id AS m FROM documents UNION SELECT r.doc_id, e.b FROM r JOIN e ON r.m = e.a)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, min(r.m) AS component_id
FROM documents d LEFT JOIN n USING (doc_id) JOIN r USING (doc_id) GROUP BY 1, 2
"""


def op1_language_id(spark, sf_dir):
    docs = documents(spark, sf_dir, "doc_id", "text", "lang")
    model = language_id.train(docs.where(language_id.fold(F.col("doc_id"), 4) != 2))
    held_out = (language_id.fold(F.col("doc_id"), 4) == 2).alias("held_out")
    return language_id.label(docs, model).select("doc_id", held_out, "lang_pred", "score")


QUERIES["op1_language_id"] = op1_language_id


def op9_url_filter(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    return url_filter.judge(pages).select("page_id", "host", "path", "rule", "verdict")


def _spread_sql(name: str, shares: str, seeds: str) -> str:
    """The rounds of `url_filter.spread` as common table expressions."""
    d, digits = url_filter.DAMPING, url_filter.DIGITS
    out = [f"{name}0 AS MATERIALIZED (SELECT host, round(weight, {digits}) AS score FROM {seeds})",
           f"{name}s AS (SELECT sum(score) AS total FROM {name}0)"]
    for i in range(url_filter.ROUNDS):
        out.append(f"""{name}{i + 1} AS MATERIALIZED (
  SELECT host, round(sum(score), {digits}) AS score FROM (
    SELECT dst AS host, {d} * score * share AS score FROM {name}{i} JOIN {shares} ON host = src
    UNION ALL
    SELECT host, score * ((1 - {d}) + {d} * (
      SELECT coalesce(sum(score), 0.0) FROM {name}{i} WHERE host NOT IN (SELECT src FROM {shares})) / (SELECT total FROM {name}s)) FROM {name}0)
  GROUP BY host)""")
    return ",\n".join(out)


def _rules_sql() -> tuple[str, str]:
    rule = verdict = "CAST(NULL AS VARCHAR)"
    for what, host, path in sorted(url_filter.RULES, key=lambda r: len(r[1] + r[2])):
        fits = f"(host = '{host}' OR host LIKE '%.{host}') AND starts_with(path, '{path}')"
        rule = f"CASE WHEN {fits} THEN '{host}{path}' ELSE {rule} END"
        verdict = f"CASE WHEN {fits} THEN '{what}' ELSE {verdict} END"
    return rule, verdict


QUERIES["op9_url_filter"] = op9_url_filter
_HOST = ("translate(regexp_extract(substr({0}, strpos({0}, '://') + 3), '^[^/?#]*'), "
         "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")
ORACLE_SQL["op9_url_filter"] = rf"""
WITH u AS (
  SELECT page_id, coalesce(html, '') AS html,
         CASE WHEN coalesce(strpos(url, '://'), 0) = 0 THEN '' ELSE {_HOST.format("url")} END AS host,
         CASE WHEN coalesce(strpos(url, '://'), 0) = 0 THEN ''
              ELSE regexp_extract(substr(url, strpos(url, '://') + 3), '^[^/?#]*([^?#]*)', 1) END AS path
  FROM pages),
r AS (SELECT page_id, html, host, path, {_rules_sql()[0]} AS rule, {_rules_sql()[1]} AS by_rule FROM u),
h AS (SELECT host, count(*) AS pages, count(*) FILTER (WHERE by_rule = 'allow') AS good,
             count(*) FILTER (WHERE by_rule = 'block') AS bad FROM r WHERE host <> '' GROUP BY host),
a AS (SELECT sum(pages) AS pages, greatest(sum(good), 1) AS good, greatest(sum(bad), 1) AS bad FROM h),
l AS (SELECT host AS src, unnest(regexp_extract_all(html,
        '(?i)<a\b[^>]*?\bhref\s*=\s*["'']?\s*((?:https?:)?//[^"''\s>]+)', 1)) AS link FROM r WHERE host <> ''),
e AS (SELECT src, dst, count(*) AS links FROM (
        SELECT src, {_HOST.format("CASE WHEN starts_with(link, '//') THEN 'http:' || link ELSE link END")} AS dst FROM l)
      WHERE dst <> '' AND dst <> src GROUP BY 1, 2),
sf AS (SELECT src, dst, links / sum(links) OVER (PARTITION BY src) AS share FROM e),
sb AS (SELECT dst AS src, src AS dst, links / sum(links) OVER (PARTITION BY dst) AS share FROM e),
good AS (SELECT host, CAST(good AS DOUBLE) AS weight FROM h WHERE good > 0),
bad AS (SELECT host, CAST(bad AS DOUBLE) AS weight FROM h WHERE bad > 0),
{_spread_sql("t", "sf", "good")},
{_spread_sql("d", "sb", "bad")},
te AS (SELECT * FROM t{url_filter.ROUNDS} WHERE EXISTS (SELECT 1 FROM e) UNION ALL SELECT * FROM t0 WHERE NOT EXISTS (SELECT 1 FROM e)),
de AS (SELECT * FROM d{url_filter.ROUNDS} WHERE EXISTS (SELECT 1 FROM e) UNION ALL SELECT * FROM d0 WHERE NOT EXISTS (SELECT 1 FROM e))
SELECT page_id, r.host, path, rule, coalesce(by_rule, CASE WHEN coalesce(de.score, 0) / a.bad
       > {url_filter.THRESHOLD} * (coalesce(te.score, 0) / a.good + coalesce(h.pages, 0) / a.pages) THEN 'block' ELSE 'allow' END) AS verdict
FROM r LEFT JOIN te ON te.host = r.host LEFT JOIN de ON de.host = r.host LEFT JOIN h ON h.host = r.host CROSS JOIN a
"""


def op2_html_extract(spark, sf_dir):
    return html_extract.extract_pages(spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html"))


QUERIES["op2_html_extract"] = op2_html_extract


def op7_toxicity(spark, sf_dir):
    docs = documents(spark, sf_dir, "doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    models = toxicity.train(docs, labels.where(language_id.fold(F.col("doc_id"), 5) != 0))
    held_out = (language_id.fold(F.col("doc_id"), 5) == 0).alias("held_out")
    return toxicity.score(docs, models).select("doc_id", held_out, "score", "predicted")


QUERIES["op7_toxicity"] = op7_toxicity


def op5_maxent_lm(spark, sf_dir):
    docs = documents(spark, sf_dir, "doc_id", "text")
    train = docs.where(language_id.fold(F.col("doc_id"), 10) != 0)
    held_out = (language_id.fold(F.col("doc_id"), 10) == 0).alias("held_out")
    return maxent_lm.score_documents(train, docs).select(
        "doc_id", held_out, "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )


QUERIES["op5_maxent_lm"] = op5_maxent_lm
