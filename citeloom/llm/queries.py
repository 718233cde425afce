"""The queries of this subpackage, with production parameters over whole tables, and their SQL where SQL can say it."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citeloom.llm import bytepairs
from citeloom.llm.common import table
from citeloom.llm.divergence import divergence
from citeloom.llm.filters import filter_audit
from citeloom.llm.jaccard import jaccard_components
from citeloom.llm.lines import dedup_lines
from citeloom.llm.mixing import placed
from citeloom.llm.pii import pii_report
from citeloom.llm.quality import quality_report
from citeloom.llm.sentencepieces import encode
from citeloom.llm.sharding import shard_documents
from citeloom.llm.suffixes import dedup_substrings
from citeloom.llm.topk import top_k
from citeloom.llm.urls import filter_urls, fit, labelled_urls

#: Where the public tokenizers are, and the pseudonyms' key: parameters of the deployment.
TOKENIZERS = os.environ.get("TOKENIZERS_DIR", "/opt/tokenizers")
PII_KEY = os.environ.get("PII_KEY", "example key")
#: Slots of these sources in a mix; every other source has one of its own.
WEIGHTS = {"src0": 5, "src1": 3, "src2": 3, "src3": 2, "src4": 2}


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(table(spark, sf_dir, "documents"), 24)


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return placed(table(spark, sf_dir, "documents"), WEIGHTS)


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_urls(table(spark, sf_dir, "pages"), fit(labelled_urls(spark)))


def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"), 3, (90, 100))


def op5_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op6_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode(table(spark, sf_dir, "documents"), f"{TOKENIZERS}/piece_bpe_32k.model")


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = dedup_lines(table(spark, sf_dir, "documents"))
    spans = F.array_join(F.transform("removed", lambda x: F.concat_ws("-", x["start"].cast("string"), x["end"].cast("string"))), ",")
    return found.select("doc_id", "text", "n_units", "n_removed", spans.alias("removed_spans"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_report(table(spark, sf_dir, "documents"))


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_substrings(table(spark, sf_dir, "documents"))


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii_report(table(spark, sf_dir, "documents"), PII_KEY)


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence(table(spark, sf_dir, "documents"))


def op13_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = f"{TOKENIZERS}/byte_bpe_50k.tiktoken"
    ids = bytepairs.encode(table(spark, sf_dir, "documents"), ranks, back=True)
    listed = F.array_join(F.col("ids").cast("array<string>"), " ")
    return ids.select("doc_id", "n_tokens", F.sha2(listed.cast("binary"), 256).alias("ids_sha256"), F.sha2("bytes", 256).alias("decoded_sha256"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_sharding, op2_mixing, op3_url_filter, op4_jaccard_join, op5_exact_topk, op6_sentencepiece, op7_line_dedup, op8_quality, op9_suffix_dedup, op10_pii, op11_filter_audit, op12_source_divergence, op13_byte_bpe, pipeline)
}

ORACLES: dict[str, str] = {
    "op4_jaccard_join": r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
), grams AS (
  SELECT doc_id, unnest(CASE WHEN len(w) >= 3 THEN list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS g FROM words
), sets AS (SELECT DISTINCT doc_id, g FROM grams),
sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM sets a JOIN sets b ON a.g = b.g AND a.doc_id <> b.doc_id
  JOIN sizes x ON x.doc_id = a.doc_id JOIN sizes y ON y.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id, x.n, y.n HAVING 100 * count(*) >= 90 * (x.n + y.n - count(*))
), reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b)
SELECT d.doc_id, coalesce(s.n, 0)::BIGINT AS n_shingles, (SELECT min(b) FROM reach WHERE a = d.doc_id) AS component_id
FROM documents d LEFT JOIN sizes s USING (doc_id)""",
    "op5_exact_topk": """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.e, c.e)::BIGINT AS score FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0
)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 5""",
    "op7_line_dedup": r"""
WITH parts AS (
  SELECT doc_id, unnest(string_split(regexp_replace(text, '([.!?][\x20\x09-\x0D]+|\n)', '\1' || chr(57344), 'g'), chr(57344))) AS part,
    generate_subscripts(string_split(regexp_replace(text, '([.!?][\x20\x09-\x0D]+|\n)', '\1' || chr(57344), 'g'), chr(57344)), 1) AS i
  FROM documents WHERE text IS NOT NULL
), placed AS (
  SELECT doc_id, i, part, trim(lower(regexp_replace(part, '[\x20\x09-\x0D]+', ' ', 'g'))) AS u, coalesce(sum(length(part)) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start FROM parts
), units AS (SELECT *, row_number() OVER (PARTITION BY u ORDER BY doc_id, i) > 1 AS again FROM placed WHERE u <> ''),
islands AS (SELECT *, sum(CASE WHEN again THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY i) AS island FROM units),
runs AS (
  SELECT doc_id, min(i) AS lo, max(i) AS hi, count(*) AS n, min(start) AS a, max(start + length(part)) AS b FROM islands WHERE again
  GROUP BY doc_id, island HAVING sum(len(string_split(u, ' '))) >= 20
), spans AS (SELECT doc_id, sum(n)::BIGINT AS n, string_agg(a || '-' || b, ',' ORDER BY a) AS spans FROM runs GROUP BY doc_id),
kept AS (
  SELECT p.doc_id, string_agg(p.part, '' ORDER BY p.i) AS text FROM placed p WHERE NOT EXISTS (SELECT 1 FROM runs r WHERE r.doc_id = p.doc_id AND p.i BETWEEN r.lo AND r.hi) GROUP BY p.doc_id
), counts AS (SELECT doc_id, count(*) AS n FROM units GROUP BY doc_id)
SELECT d.doc_id, CASE WHEN d.text IS NOT NULL THEN coalesce(k.text, '') END AS text, coalesce(c.n, 0)::BIGINT AS n_units, coalesce(s.n, 0)::BIGINT AS n_removed, coalesce(s.spans, '') AS removed_spans
FROM documents d LEFT JOIN kept k USING (doc_id) LEFT JOIN counts c USING (doc_id) LEFT JOIN spans s USING (doc_id)""",
    "op11_filter_audit": r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, coalesce(source, '') AS part FROM documents),
w AS (SELECT doc_id, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w FROM d),
l AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels GROUP BY doc_id),
f AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
    CASE WHEN len(w) < 200 THEN 'A' ELSE '' END || CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 'B' ELSE '' END
    || CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 2 * length(text) THEN 'C' ELSE '' END || CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 'D' ELSE '' END
    || CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY text) THEN 'E' ELSE '' END AS failed
  FROM d JOIN w USING (doc_id) LEFT JOIN l USING (doc_id)
), g AS (SELECT part, failed, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM f GROUP BY part, failed),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
orders AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5
), steps AS (SELECT filter_order, s AS step, filter_order[s] AS own, filter_order[1:s - 1] AS before FROM orders, (SELECT unnest([1, 2, 3, 4, 5]) AS s)),
told AS (
  SELECT part, filter_order, step, own, n, good, toxic, failed, contains(failed, own) AS fails,
    len(list_intersect(string_split(failed, ''), string_split(before, ''))) > 0 AND failed <> '' AND before <> '' AS gone FROM g, steps
), sums AS (
  SELECT part, filter_order, step, own, sum(CASE WHEN NOT fails AND NOT gone THEN n ELSE 0 END)::BIGINT AS kept, sum(CASE WHEN fails AND NOT gone THEN n ELSE 0 END)::BIGINT AS removed,
    sum(CASE WHEN fails AND gone THEN n ELSE 0 END)::BIGINT AS redundant, sum(CASE WHEN failed = own THEN n ELSE 0 END)::BIGINT AS unique_fails,
    sum(CASE WHEN fails AND NOT gone THEN good ELSE 0 END)::BIGINT AS good_lost, sum(CASE WHEN fails AND NOT gone THEN toxic ELSE 0 END)::BIGINT AS toxic_lost
  FROM told GROUP BY part, filter_order, step, own
)
SELECT part, filter_order, step::INTEGER AS step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, sum(removed) OVER (PARTITION BY part, own)::BIGINT AS shapley FROM sums""",
    "op12_source_divergence": r"""
WITH d AS (
  SELECT row_number() OVER () AS row, coalesce(lang, '') AS lang, coalesce(source, '') AS source, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents
), t AS (SELECT row, lang, source, unnest(regexp_extract_all(text, '[a-z\x{80}-\x{10FFFF}]+')) AS term FROM d),
kept AS (SELECT lang, term FROM t GROUP BY lang, term HAVING count(DISTINCT row) >= 30),
size AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
groups AS (SELECT DISTINCT lang, source FROM d),
n AS (SELECT lang, source, term, count(*) AS n FROM t JOIN kept USING (lang, term) GROUP BY lang, source, term),
whole AS (SELECT g.lang, g.source, k.term, coalesce(n.n, 0) AS n FROM groups g JOIN kept k ON k.lang = g.lang LEFT JOIN n ON n.lang = g.lang AND n.source = g.source AND n.term = k.term),
total AS (SELECT lang, source, sum(n) AS total FROM whole GROUP BY lang, source),
p AS (SELECT w.lang, w.source, w.term, w.n, 1 + (1000000000::HUGEINT * (w.n + 5)) // (s.total + 5 * z.v) AS p FROM whole w JOIN total s USING (lang, source) JOIN size z USING (lang)),
q AS (
  SELECT lang, term, 1 + (1000000000::HUGEINT * (sum(n) + 5)) // ((SELECT sum(total) FROM total x WHERE x.lang = whole.lang) + 5 * (SELECT v FROM size z WHERE z.lang = whole.lang)) AS q
  FROM whole GROUP BY lang, term
), f AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
both_parts AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(f.value, 0)::BIGINT AS value FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source
  UNION ALL SELECT p.lang, p.source, 'term', p.term, (p.p - q.q)::BIGINT FROM p JOIN q USING (lang, term) WHERE p.n > 0 AND p.p > q.q
), ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM both_parts)
SELECT lang, source, part, item, value, rank::INTEGER AS rank FROM ranked WHERE part = 'pair' OR rank <= 50""",
}
