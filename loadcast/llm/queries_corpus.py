"""Queries on whole corpora: importance resampling, languages and the interaction of filters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from loadcast.llm import filter_audit, importance, lang_codes
from loadcast.llm.common import query, table

#: Shapley sums by counting: over all orders a filter is the first of k failing ones in 120 / k of them.
AUDIT_SQL = """
WITH lab AS (
  SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
  FROM labels GROUP BY doc_id
), d AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS ws
  FROM documents
), f AS (
  SELECT d.part, coalesce(lab.good, 0) AS good, coalesce(lab.toxic, 0) AS toxic,
         [len(ws) < 200,
          100 * len(list_distinct(ws)) < 50 * len(ws),
          100 * len(regexp_replace(text, '[^A-Z]', '', 'g')) > 2 * length(text),
          regexp_matches(text, '[#$%&*|]'),
          coalesce(d.doc_id > min(d.doc_id) OVER (PARTITION BY text), false)] AS fails
  FROM d LEFT JOIN lab ON lab.doc_id = d.doc_id
), c AS (
  SELECT part, fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM f GROUP BY part, fails
), l AS (
  SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS c
), o AS (
  SELECT a.c || b.c || x.c || y.c || z.c AS filter_order FROM l a, l b, l x, l y, l z
  WHERE len(list_distinct([a.c, b.c, x.c, y.c, z.c])) = 5
), s AS (
  SELECT filter_order, step, ascii(filter_order[step]) - 64 AS own,
         [ascii(q) - 64 for q in string_split(filter_order[1:step - 1], '') if q <> ''] AS done
  FROM (SELECT filter_order, unnest([1, 2, 3, 4, 5]) AS step FROM o)
), j AS (
  SELECT c.*, s.*, c.fails[s.own] AS failing, len([q for q in done if c.fails[q]]) > 0 AS gone,
         len([q for q in c.fails if q]) AS bits
  FROM c, s
)
SELECT part, filter_order, step,
       sum(CASE WHEN NOT failing AND NOT gone THEN n ELSE 0 END)::BIGINT AS kept,
       sum(CASE WHEN failing AND NOT gone THEN n ELSE 0 END)::BIGINT AS removed,
       sum(CASE WHEN failing AND gone THEN n ELSE 0 END)::BIGINT AS redundant,
       sum(CASE WHEN failing AND bits = 1 THEN n ELSE 0 END)::BIGINT AS unique_fails,
       sum(CASE WHEN failing AND NOT gone THEN good ELSE 0 END)::BIGINT AS good_lost,
       sum(CASE WHEN failing AND NOT gone THEN toxic ELSE 0 END)::BIGINT AS toxic_lost,
       sum(CASE WHEN failing THEN n * (120 // bits) ELSE 0 END)::BIGINT AS shapley
FROM j GROUP BY part, filter_order, step
"""


@query("op13_filter_audit", AUDIT_SQL)
def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts per source, order of five filters and step, from a stream over all documents."""
    return filter_audit.filter_interactions(spark, f"{sf_dir}/documents.parquet", table(spark, sf_dir, "labels"))


#: CRC-32 bit by bit over the bytes of every distinct word.
IMPORTANCE_SQL = """
WITH x AS (
  SELECT 0 AS target, row_number() OVER () AS r, doc_id, text FROM documents
  UNION ALL SELECT 1, row_number() OVER (), NULL, text FROM benchmark
), w AS (
  SELECT target, r, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                              '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word
  FROM x
), tab AS (
  SELECT list(c ORDER BY k) AS t
  FROM (SELECT k, list_reduce(list_prepend(k, [1::BIGINT, 1, 1, 1, 1, 1, 1, 1]),
                              lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c
        FROM (SELECT unnest(range(256)) AS k))
), v AS (
  SELECT word, hex(encode(word)) AS h FROM (SELECT DISTINCT word FROM w)
), b AS (
  SELECT word, xor(list_reduce(list_prepend(4294967295, [('0x' || h[2 * i - 1:2 * i])::BIGINT FOR i IN range(1, len(h) // 2 + 1)]),
                               lambda c, y: xor(c >> 8, t[(xor(c, y) & 255) + 1])), 4294967295) % 10000 AS bucket
  FROM v, tab
), n AS (
  SELECT bucket, (sum(1) FILTER (WHERE target = 0))::DOUBLE AS s, (sum(1) FILTER (WHERE target = 1))::DOUBLE AS t
  FROM w JOIN b USING (word) GROUP BY bucket
), g AS (
  SELECT bucket, floor(1000 * ln((coalesce(t, 0) + 1) * ((SELECT coalesce(sum(s), 0) FROM n) + 10000)
                                 / ((coalesce(s, 0) + 1) * ((SELECT coalesce(sum(t), 0) FROM n) + 10000)))) AS gain
  FROM n
), d AS (
  SELECT r, count(*) AS n_features, floor(sum(gain) / count(*))::BIGINT AS weight
  FROM w JOIN b USING (word) JOIN g USING (bucket) WHERE target = 0 GROUP BY r
), c AS (
  SELECT x.doc_id, coalesce(d.n_features, 0) AS n_features, coalesce(d.weight, 0) AS weight,
         coalesce(d.weight, 0) + floor(-1000 * ln(-ln((('0x' || sha256('2024:' || coalesce(x.doc_id::VARCHAR, ''))[1:8])::BIGINT + 0.5::DOUBLE)
                                                      / 4294967296::DOUBLE)))::BIGINT AS score
  FROM x LEFT JOIN d USING (r) WHERE x.target = 0
), k AS (
  SELECT *, CASE WHEN n_features >= 20 THEN row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id) END AS place
  FROM c
)
SELECT doc_id, n_features::BIGINT AS n_features, weight, score,
       CASE WHEN place <= (SELECT count(*) FROM k WHERE place IS NOT NULL) * 10 // 100 THEN place END AS rank
FROM k
"""


@query("op11_importance_resample", IMPORTANCE_SQL)
def op11_importance_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weight, score and rank of every document, a tenth drawn towards the words of `benchmark`."""
    docs, target = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return importance.resampled(docs.select("doc_id", "text"), target)


@query("op12_language_codes")
def op12_language_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document by the nearest codeword, and whether another one is near."""
    docs = lang_codes.identified(table(spark, sf_dir, "documents").select("doc_id", "text", "lang"))
    return docs.select("doc_id", "held_out", "lang_pred", "score", "ambiguous")
