"""Queries of the operators on `documents`."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loadcast.llm import fingerprints, mixing, near_text, pieces, quality, secrets
from loadcast.llm.common import query, table
from loadcast.session import materialize


@query("op2_mix_sources")
def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words the mix takes of every document, with its source's size and target."""
    sizes = mixing.sized(table(spark, sf_dir, "documents"), mixing.MixOptions())
    rows = materialize(sizes.withColumn("row_no", F.monotonically_increasing_id()), "sizes")
    return mixing.taken_words(rows).select("doc_id", "size", "source_size", "target", "taken")


@query("op6_fingerprints")
def op6_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all texts and edited texts."""
    return fingerprints.fingerprint_edits(table(spark, sf_dir, "documents"), materialize)


#: Every pair of texts that share a shingle is counted; components by spreading the smallest id over the links.
NEAR_SQL = """
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\\x20\\x09-\\x0D]+') AS ws
  FROM documents
), s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) >= 5 THEN [array_to_string(ws[i:i + 4], ' ') for i in range(1, len(ws) - 3)]
                                      WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END) AS sh
  FROM w
), n AS (
  SELECT d.doc_id, count(s.sh) AS n FROM documents d LEFT JOIN s USING (doc_id) GROUP BY d.doc_id
), links AS (
  SELECT a.doc_id AS x, b.doc_id AS y
  FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id <> b.doc_id
  JOIN n na ON na.doc_id = a.doc_id JOIN n nb ON nb.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id, na.n, nb.n
  HAVING 100 * count(*) >= 85 * (na.n + nb.n - count(*))
), reach(doc_id, seen) AS (
  SELECT doc_id, doc_id FROM documents
  UNION
  SELECT r.doc_id, l.y FROM reach r JOIN links l ON l.x = r.seen
)
SELECT n.doc_id, n.n AS n_shingles, min(r.seen) AS component_id, n.doc_id = min(r.seen) AS kept
FROM n JOIN reach r ON r.doc_id = n.doc_id GROUP BY n.doc_id, n.n
"""


@query("op7_minhash_near_dedup", NEAR_SQL)
def op7_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shingle counts and near-duplicate components of all documents."""
    return near_text.near_duplicates(table(spark, sf_dir, "documents"))


@query("op4_sentencepiece")
def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Piece ids of all texts and whether they decode to the text."""
    return pieces.encoded_documents(table(spark, sf_dir, "documents"))


@query("op5_quality")
def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = quality.scored_documents(docs, table(spark, sf_dir, "labels"))
    return scored.select("doc_id", "held_out", "score", "predicted")


@query("op8_secrets")
def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document."""
    return secrets.scanned_documents(table(spark, sf_dir, "documents").select("doc_id", "text"))
