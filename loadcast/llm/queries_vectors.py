"""Query of the operator on `embeddings`."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from loadcast.llm import near_vectors
from loadcast.llm.common import query, ready_workers, table

VECTOR_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
), links AS (
  SELECT a.vec_id AS x, b.vec_id AS y FROM v a JOIN v b ON a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.e, b.e) >= 0.9
), reach(vec_id, seen) AS (
  SELECT vec_id, vec_id FROM v
  UNION
  SELECT r.vec_id, l.y FROM reach r JOIN links l ON l.x = r.seen
), n AS (
  SELECT x, count(*) AS n FROM links GROUP BY x
)
SELECT r.vec_id, coalesce(max(n.n), 0) AS n_links, min(r.seen) AS component_id, r.vec_id = min(r.seen) AS kept
FROM reach r LEFT JOIN n ON n.x = r.vec_id GROUP BY r.vec_id
"""


@query("op10_embedding_near_dedup", VECTOR_SQL)
def op10_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Direct links and components of all vectors."""
    ready_workers(spark)
    return near_vectors.near_vectors(table(spark, sf_dir, "embeddings"))
