"""Importance resampling of documents towards a target distribution of hashed word runs.

Features of a text are its runs of 1 to `most` consecutive words; a feature's bucket is the CRC-32 of its bytes modulo
`buckets`. The source counts of all documents and the target counts of all benchmark texts give every bucket a gain, a
document's weight is the mean gain of its features, and a Gumbel draw from the document's id makes the highest scores a
sample without replacement, of which `percent` percent are drawn.

Texts are read a batch at a time: the texts of an Arrow batch are joined with a sentinel byte that no word holds, one pass
of a regular expression finds all words, `searchsorted` on the texts' offsets tells whose they are, and runs that cross a
text's end are masked before they are counted. Words come in pieces of bounded size, so a very long text needs no list of
all its words.

What is collected is bounded by the number of buckets. Scores are whole numbers between about -50,000 and 80,000, so the
count per score, from which the cut and all ranks follow, is bounded too, whatever the number of documents. Ranks are counted
above a score and numbered inside it by id; rows that agree in id and score are one row with a count until the end.

Cases: a null or empty text and one without words has no features, weight 0 and is never drawn, like any text under
`least_words` words; a null id draws as the empty string and comes before other ids in ties; rows of equal id and score are
ranked in any order; without documents there are no rows, without target texts every bucket's gain is what the formula says
for counts of zero; other columns do not matter.
"""

from __future__ import annotations

import itertools
import math
import re
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loadcast.llm.common import ready_workers
from loadcast.session import materialize


@dataclass(frozen=True)
class ResampleOptions:
    #: Words of the longest run.
    most: int = 1
    buckets: int = 10_000
    #: Only documents of so many words are drawn, `percent` percent of them.
    least_words: int = 20
    percent: int = 10
    seed: str = "2024"


#: A word in lower-cased UTF-8: digits, letters a-z and all bytes of characters beyond ASCII. The sentinel is none of them.
WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
SENTINEL = b"\n"
#: Words that are held at once.
AT_ONCE = 500_000


def word_pieces(texts: list[str | None], most: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Buckets' hashes of all features of `texts` and the position of the text each comes from, a bounded piece at a time."""
    rows = [(t or "").encode("utf-8", "surrogatepass").lower() for t in texts]
    ends = np.cumsum([len(r) + 1 for r in rows])
    found = WORD.finditer(SENTINEL.join(rows))
    hashes: dict[bytes, int] = {}
    carried: list[tuple[int, bytes]] = []  # the last words of the piece before, with which runs may go on
    while piece := [(m.start(), m[0]) for m in itertools.islice(found, AT_ONCE)]:
        every = carried + piece
        old = len(carried)
        doc = np.searchsorted(ends, np.fromiter((s for s, _ in every), np.int64, len(every)), side="right")
        words = [w for _, w in every]
        if len(hashes) > AT_ONCE:
            hashes.clear()
        for w in set(words):
            if w not in hashes:
                hashes[w] = zlib.crc32(w)
        one = np.fromiter((hashes[w] for w in words), np.int64, len(words))
        yield one[old:], doc[old:]
        run = one.tolist()
        for n in range(2, most + 1):
            # Runs that end at each word of this piece; those that begin in another text do not count.
            run = [zlib.crc32(b" " + w, h) for h, w in zip(run, words[n - 1 :], strict=False)]
            first = max(0, old - n + 1)
            whole = doc[: len(run)][first:] == doc[n - 1 :][first:]
            yield np.array(run[first:], dtype=np.int64)[whole], doc[n - 1 :][first:][whole]
        carried = every[max(0, len(every) - most + 1) :] if most > 1 else []


def bucket_counts(texts: DataFrame, options: ResampleOptions) -> DataFrame:
    """Features per bucket over the column `text`: every task adds up its own rows first."""
    ready_workers(texts.sparkSession)
    most, buckets = options.most, options.buckets

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            for hashes, _ in word_pieces(batch.column(0).to_pylist(), most):
                total += np.bincount(hashes % buckets, minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(total[some], pa.int64())], ["bucket", "n"])

    parts = texts.select("text").mapInArrow(work, "bucket long, n long")
    return parts.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(source: dict[int, int], target: dict[int, int], buckets: int) -> np.ndarray:
    """Whole thousandths of the logarithm of a bucket's smoothed share in the target over that in the source."""
    s_all, t_all = sum(source.values()), sum(target.values())
    return np.array(
        [
            math.floor(
                1000 * math.log(float(target.get(b, 0) + 1) * (s_all + buckets) / (float(source.get(b, 0) + 1) * (t_all + buckets)))
            )
            for b in range(buckets)
        ],
        dtype=np.int64,
    )


def weigher(gain: np.ndarray, options: ResampleOptions) -> Callable[[Column], Column]:
    """A column function: words, features and weight of a text."""
    most, buckets = options.most, options.buckets

    def work(column: pa.Array) -> pa.Array:
        texts = column.to_pylist()
        k = len(texts)
        words, n, total = (np.zeros(k, dtype=np.int64) for _ in range(3))
        for nth, (hashes, doc) in enumerate(word_pieces(texts, most)):
            own = np.bincount(doc, minlength=k)
            n += own
            words += own if nth % most == 0 else 0
            # Sums of whole numbers, split so that doubles hold them exactly.
            value = gain[hashes % buckets]
            high = np.bincount(doc, weights=(value >> 10).astype(np.float64), minlength=k).astype(np.int64)
            low = np.bincount(doc, weights=(value & 1023).astype(np.float64), minlength=k).astype(np.int64)
            total += (high << 10) + low
        weight = np.where(n > 0, total // np.maximum(n, 1), 0)
        return pa.StructArray.from_arrays(
            [pa.array(words, pa.int64()), pa.array(n, pa.int64()), pa.array(weight, pa.int64())], ["words", "n_features", "weight"]
        )

    return F.arrow_udf(work, "words long, n_features long, weight long")


def gumbel(doc_id: Column, seed: str) -> Column:
    """Whole thousandths of a Gumbel draw that depends on the id alone."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(key, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")


def weighed(docs: DataFrame, target: DataFrame, options: ResampleOptions = ResampleOptions()) -> DataFrame:
    """doc_id, words, n_features, weight and score of every row of `docs`, towards the column `text` of `target`."""
    ready_workers(docs.sparkSession)
    counted = [
        {r.bucket: r.n for r in bucket_counts(df, options).collect()} for df in (docs, target)
    ]  # at most `buckets` rows each
    weigh = weigher(gains(*counted, options.buckets), options)
    rows = docs.select("doc_id", weigh(F.col("text")).alias("w")).select("doc_id", "w.*")
    return rows.withColumn("score", F.col("weight") + gumbel(F.col("doc_id"), options.seed))


def drawn(rows: DataFrame, options: ResampleOptions = ResampleOptions()) -> DataFrame:
    """`rows` of `weighed` with their rank, null for those that are not drawn. Read several times: hand over a written table."""
    able = F.col("words") >= options.least_words
    per_score = rows.where(able).groupBy("score").agg(F.count(F.lit(1)).alias("n"))
    # As many rows as there are scores: one task and a broadcast hold them.
    down = Window.partitionBy(F.lit(0)).orderBy(F.col("score").desc())
    whole = Window.partitionBy(F.lit(0))
    steps = per_score.select(
        F.col("score").alias("of_score"),
        (F.sum("n").over(down) - F.col("n")).alias("above"),
        F.floor(F.sum("n").over(whole) * options.percent / 100).cast("long").alias("draw"),
    ).where("above < draw")
    near = rows.join(F.broadcast(steps), able & (F.col("score") == F.col("of_score")), "left")
    kept = ["doc_id", "n_features", "weight", "score"]
    out = near.where("above is null").select(*kept, F.lit(None).cast("long").alias("rank"))
    same = near.where("above is not null").groupBy(*kept, "above", "draw").agg(F.count(F.lit(1)).alias("n"))
    order = Window.partitionBy("score").orderBy(F.col("doc_id").asc_nulls_first(), "n_features", "weight")
    last = same.withColumn("last", F.col("above") + F.sum("n").over(order))
    placed = last.select(*kept, "draw", F.explode(F.expr("sequence(last - n + 1, last)")).alias("place"))
    return out.unionByName(
        placed.select(*kept, F.when(F.col("place") <= F.col("draw"), F.col("place")).alias("rank"))
    )


def resampled(docs: DataFrame, target: DataFrame, options: ResampleOptions = ResampleOptions()) -> DataFrame:
    """Every document's features, weight, score and rank in the sample."""
    return drawn(materialize(weighed(docs, target, options), "importance"), options)
