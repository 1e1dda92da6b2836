"""Document fingerprints: bottom-k sketches of word-shingle hashes, in built-in functions only.

A sketch is the sorted array of the `k` smallest distinct 64-bit hashes of a text's shingles (five words, A-Z
lower-cased). The sketch of a union is the `k` smallest of the two sketches together, so parts merge in any order.

Cases: null text counts as empty; a text without words has an empty sketch, which equals other empty ones (resemblance
and containment 1) and resembles nothing else (0); with fewer than five words the whole sequence is one shingle. Repeated
rows keep a row each.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from loadcast.llm.common import ascii_lower, shingle_hashes, words

K = 128
WIDTH = 5


def sketch(text: Column, k: int = K, width: int = WIDTH) -> Column:
    return F.slice(shingle_hashes(words(ascii_lower(text)), width), 1, k)


def merge(a: Column, b: Column, k: int = K) -> Column:
    """The sketch of the union of what two sketches stand for."""
    return F.slice(F.sort_array(F.array_union(a, b)), 1, k)


def merge_rows(df: DataFrame, keys: list[str], column: str, k: int = K) -> DataFrame:
    """Merge the sketches of all rows of a key; no buffer holds more than `k` hashes of a key and task.

    Equal hashes collapse before they move, and the rank limit keeps `k` per key and task ahead of the shuffle.
    """
    one = df.select(*keys, F.explode(column).alias("_hash")).distinct()
    rank = F.row_number().over(W.partitionBy(*keys).orderBy("_hash"))
    kept = one.withColumn("_rank", rank).where(F.col("_rank") <= k)
    return kept.groupBy(*keys).agg(F.sort_array(F.collect_list("_hash")).alias(column))


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Estimated Jaccard similarity: the share of the union's sketch that both sketches hold."""
    union = merge(a, b, k)
    common = F.size(F.array_intersect(union, F.array_intersect(a, b)))
    return F.when(F.size(union) == 0, F.lit(1.0)).otherwise(common / F.size(union))


def distinct_shingles(s: Column, k: int = K) -> Column:
    """Estimated number of distinct shingles: exact below `k`, else from how densely the k smallest hashes lie."""
    span = (F.element_at(s, -1).cast("double") + F.lit(2.0**63)) / F.lit(2.0**64)
    return F.when(F.size(s) < k, F.size(s).cast("double")).otherwise((k - 1) / span)


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of `a`'s shingles that `b` holds too."""
    shared = resemblance(a, b, k) * distinct_shingles(merge(a, b, k), k)
    own = distinct_shingles(a, k)
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(F.least(F.lit(1.0), shared / own))


def as_text(s: Column) -> Column:
    """Sixteen hexadecimal digits for each hash."""
    return F.lower(F.concat_ws("", F.transform(s, lambda x: F.lpad(F.hex(x), 16, "0"))))


def with_next(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows with key `k`, and for each key the one that follows it: (k, next_k, n) with `n`, the most code points
    a row of that key may borrow from the next.

    Ids are put in order without one task seeing them all: range-partitioned, in order inside each range, and the ends
    of the ranges (one row each) tell which id follows across ranges. A null id comes before all others.
    """
    k = F.coalesce(F.col("doc_id"), F.lit(-(1 << 63)))
    rows = docs.select(k.alias("k"), F.col("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    ids = docs.select(k.alias("k"), F.coalesce(F.char_length("text"), F.lit(0)).alias("n")).groupBy("k").agg(F.max("n").alias("n"))
    ranged = ids.repartitionByRange(F.col("k")).withColumn("part", F.spark_partition_id())
    return rows, ranged


def edited_texts(docs: DataFrame, store) -> DataFrame:
    """Each row of `docs` (doc_id, text) with its text, `n_chars`, `edited`, its next row's text's sketch `next_sketch`.

    edited: the last floor(n_chars / 4) code points are replaced by the first as many of the next document by id (after
    the last: the first). Repeated ids share a place in the order; of several texts the one with the smallest hash is
    what the id before them borrows from. `store` writes a narrow table once (`materialize`).
    """
    rows, ranged = with_next(docs)
    ranged = store(ranged, "ids")
    inside = ranged.withColumn("next_k", F.lead("k").over(W.partitionBy("part").orderBy("k")))
    # One row per range: the first id of the next range follows its last id; the first of all follows the last.
    ends = ranged.groupBy("part").agg(F.min("k").alias("first"))
    order = W.partitionBy(F.lit(0)).orderBy("part")
    ends = ends.select(
        "part",
        F.coalesce(
            F.lead("first").over(order),
            F.min("first").over(order.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)),
        ).alias("wrap"),
    )
    follows = inside.join(ends, "part").select(
        F.col("k").alias("prev_k"), F.coalesce("next_k", "wrap").alias("k"), F.floor(F.col("n") / 4).alias("need")
    )
    given = (
        rows.join(follows, "k")
        .select(
            "prev_k",
            F.xxhash64("doc_id", "text").alias("h"),  # the same columns as below, so that one shuffle of the texts serves both
            F.struct(
                F.expr("left(text, cast(need as int))").alias("prefix"), sketch(F.col("text")).alias("sketch")
            ).alias("given"),
        )
        .groupBy("prev_k")
        .agg(F.min_by("given", "h").alias("given"))
    )
    n = F.char_length("text")
    quarter = F.floor(n / 4).cast("int")
    return (
        rows.join(given, F.col("k") == F.col("prev_k"), "left")
        .withColumn("n_chars", n.cast("long"))
        .withColumn(
            "edited",
            F.concat(
                F.substring("text", F.lit(1), n - quarter),
                F.coalesce(F.substring("given.prefix", F.lit(1), quarter), F.lit("")),
            ),
        )
        .select("doc_id", "text", "n_chars", "edited", F.col("given.sketch").alias("next_sketch"))
    )


def fingerprint_edits(docs: DataFrame, store) -> DataFrame:
    """Fingerprints of every text and its edited text, and their likeness to each other and to the next text's."""
    e = edited_texts(docs, store)
    e = e.select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        sketch(F.col("text")).alias("own"),
        sketch(F.col("edited")).alias("other"),
        "next_sketch",
    )
    return e.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        as_text(F.col("own")).alias("fingerprint"),
        as_text(F.col("other")).alias("edited_fingerprint"),
        resemblance(F.col("own"), F.col("other")).alias("near_edited"),
        resemblance(F.col("own"), F.col("next_sketch")).alias("near_next"),
        distinct_shingles(F.col("own")).alias("n_shingles"),
    )
