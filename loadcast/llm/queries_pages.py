"""Queries of the operators on `pages`."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loadcast.llm import html_text, url_rules, warc
from loadcast.llm.common import query, table

#: SHA-1 in base 32: ten hexadecimal digits are eight characters of five bits.
WARC_SQL = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS h, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS hex FROM pages
), g AS (
  SELECT hex, min(page_id) AS first FROM p GROUP BY hex
)
SELECT page_id, payload_bytes,
  array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    ((('0x' || substr(p.hex, 10 * (k // 8) + 1, 10))::BIGINT >> (35 - 5 * (k % 8))) & 31)::INT + 1, 1) for k in range(32)], '')
    AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first THEN first END AS refers_to
FROM p JOIN g ON g.hex = p.hex
"""


@query("op9_warc", WARC_SQL)
def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write all pages as WARC archives and read every record back through the index."""
    folder, index = warc.write_archives(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    records = warc.read_records(folder, index, payloads=False)
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query("op1_html_extract")
def op1_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return html_text.extracted_pages(table(spark, sf_dir, "pages"))


#: Listed rules (fixed values of the task).
RULES = [
    ("allow", "org/"),
    ("block", "example.org/es/"),
    ("block", "example.org/en/1"),
    ("allow", "com/fr/"),
    ("block", "com/de/"),
]


@query("op3_url_filter")
def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict of every page's URL. The number in a URL's path names the document that the page shows, and so its label."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    _, path = url_rules.host_and_path(F.col("url"))
    number = F.expr("try_cast(regexp_extract(path, '([0-9]+)(/|[.][a-z]+)?$', 1) as bigint)").alias("doc_id")
    shown = pages.withColumn("path", path).select("url", number)
    labels = (
        table(spark, sf_dir, "labels")
        .where("quality in (0, 1) or toxic in (0, 1)")
        .join(shown.where("url is not null and doc_id is not null").distinct(), "doc_id")
        .select("url", F.when((F.col("quality") == 0) | (F.col("toxic") == 1), "block").otherwise("allow").alias("verdict"))
    )
    return url_rules.judged_pages(pages, RULES, labels)
