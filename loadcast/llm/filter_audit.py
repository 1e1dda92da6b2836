"""Audit of how filters interact: every order of five filters over a stream of documents.

All files of a folder are processed as available-now micro-batches. Four filters look at a text alone and give a mask of
bits; the fifth (E) asks whether a smaller id has the same text, which only the whole table answers. Keyed state holds
for every text the smallest id seen so far, the parts of its rows and its labels. A new smallest id retracts the masks that
were counted for the former one (a row with -1) and counts them again with the bit of E (a row with +1). The changes of a
micro-batch are summed per part and mask and written under the batch's number, so that a batch that runs twice counts once.
The sum over the batches is one row of counters per (part, mask); from those 32 masks the 120 orders follow by arithmetic.

Rows of one text are first merged inside their map task: only the smallest id of the task goes to the text's state, rows
above it are certain failures of E and go to the counters under salted keys. A text that fills a third of the table thus
sends at most one row per task and part to its key.

State is kept by slices of texts' digests, some hundred texts each, whose number grows with the input: a call for each text
costs two milliseconds, one for a slice hardly more. An entry is 38 bytes (16 of the digest). The session's state store
is used; where state outgrows the executors' heap, name RocksDB in `spark.sql.streaming.stateStore.providerClass`.

Bits of a mask: A under `min_words` words; B fewer than `distinct_percent` percent distinct words; C more than
`capital_percent` percent capitals A-Z; D one of `#$%&*|`; E as above.

Cases: a null text is an empty one (it fails A; 0 of 0 words or characters fail neither B nor C), and null and empty texts are
identical to each other; a null part counts as the empty string; rows of one id with one text are not copies of each other
(only a smaller id counts); a null id is neither smaller nor larger than another, its rows never fail E and never make
others fail; of several labels for an id one with quality 1 makes it good and one with toxic 1 makes it toxic; labels of
absent documents and null labels count nothing; an empty folder gives no rows; columns beside the four that are read do not matter.
"""

from __future__ import annotations

import itertools
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from loadcast.llm.common import ready_workers, words
from loadcast.session import plan_bytes, scratch_folder

FILTERS = "ABCDE"
E_BIT = 16


@dataclass(frozen=True)
class AuditOptions:
    min_words: int = 200
    distinct_percent: int = 50
    capital_percent: int = 2
    #: Micro-batches that the files are dealt to; a batch is never smaller than `least_batch` bytes.
    batches: int = 4
    least_batch: int = 16 << 20
    #: Texts that a map task holds while it merges its rows; beyond that they go on to their state and the task starts anew.
    texts_at_once: int = 100_000
    #: Input bytes behind one slice of texts, the unit of state.
    slice_bytes: int = 512 << 10


def text_mask(text: Column, options: AuditOptions) -> Column:
    """Bits of the filters A to D."""

    def bits(w: Column) -> Column:
        few = (F.size(w) < options.min_words).cast("int")
        alike = (100 * F.size(F.array_distinct(w)) < options.distinct_percent * F.size(w)).cast("int")
        return few + 2 * alike

    n = F.length(text)
    capitals = n - F.length(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))
    loud = (100 * capitals > options.capital_percent * n).cast("int")
    marks = text.rlike("[#$%&*|]").cast("int")
    # The lambda binds the array of words, so that it is built once.
    return F.get(F.transform(F.array(words(text)), bits), 0) + 4 * loud + 8 * marks


#: What goes to a slice: rows of a text (its digest, an id), or rows that are counted as they are under a salt ("+").
SEEN = "slice string, digest binary, id long, part string, mask int, good int, toxic int, n long"
SEEN_ARROW = pa.schema(
    [
        ("slice", pa.string()), ("digest", pa.binary()), ("id", pa.int64()), ("part", pa.string()),
        ("mask", pa.int32()), ("good", pa.int32()), ("toxic", pa.int32()), ("n", pa.int64()),
    ]
)
#: State of a slice: for each of its texts the rows of the smallest id, packed, and the names of their parts.
STATE = "parts array<string>, texts binary"
ENTRY = np.dtype(
    [("text", "S16"), ("id", "<i8"), ("part", "<i4"), ("mask", "i1"), ("good", "i1"), ("toxic", "i1"), ("n", "<i8")]
)
CHANGE = "part string, mask int, n long, good long, toxic long"


def merged_rows(batches: Iterator[pa.RecordBatch], most: int, slices: int) -> Iterator[pa.RecordBatch]:
    """Rows of one text in a task: those of the smallest id under the text's slice, the others as sums under salts."""
    least: dict[bytes, list] = {}
    sums: dict[tuple, int] = {}

    def add(part: str, mask: int, good: int, toxic: int, n: int) -> None:
        sums[part, mask, good, toxic] = sums.get((part, mask, good, toxic), 0) + n

    def flush() -> pa.RecordBatch:
        rows = [
            (str(int.from_bytes(k[:8], "little") % slices), k, i, p, m, g, t, n)
            for k, (i, m, g, t, parts) in least.items()
            for p, n in parts.items()
        ]
        rows += [(f"+{zlib.crc32(repr(k).encode()) % 1024}", b"", 0, *k, n) for k, n in sums.items()]
        least.clear()
        sums.clear()
        return pa.RecordBatch.from_arrays(
            [pa.array([r[k] for r in rows], f.type) for k, f in enumerate(SEEN_ARROW)], schema=SEEN_ARROW
        )

    for batch in batches:
        for key, i, part, mask, good, toxic in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if i is None:
                add(part, mask, good, toxic, 1)
                continue
            had = least.get(key)
            if had is None:
                least[key] = [i, mask, good, toxic, {part: 1}]
            elif i == had[0]:
                had[4][part] = had[4].get(part, 0) + 1
            elif i < had[0]:
                for p, n in had[4].items():
                    add(p, mask | E_BIT, had[2], had[3], n)
                least[key] = [i, mask, good, toxic, {part: 1}]
            else:
                add(part, mask | E_BIT, good, toxic, 1)
            if len(least) + len(sums) >= most:
                yield flush()
    yield flush()


def summed(parts: np.ndarray, rows: np.ndarray, mask: np.ndarray, n: np.ndarray) -> pd.DataFrame:
    out = pd.DataFrame({"part": parts[rows["part"]], "mask": mask, "n": n, "good": n * rows["good"], "toxic": n * rows["toxic"]})
    out = out.groupby(["part", "mask"], as_index=False, sort=False).sum()
    return out[(out[["n", "good", "toxic"]] != 0).any(axis=1)]


def changes(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """What the rows of one slice change in the counters; retracts what smaller ids take back."""
    frame = pd.concat(list(frames), ignore_index=True)
    seen = np.zeros(0, dtype=ENTRY)
    parts: list[str] = []
    if state.exists:
        names, packed = state.get
        parts, seen = list(names), np.frombuffer(packed, dtype=ENTRY)
    names, place = np.unique(frame["part"].to_numpy(dtype=object), return_inverse=True)
    at = {p: k for k, p in enumerate(parts)}
    for p in names:
        at.setdefault(p, len(at))
    fresh = np.zeros(len(frame), dtype=ENTRY)
    fresh["part"] = np.array([at[p] for p in names], dtype=np.int32)[place]
    for c in ("id", "mask", "good", "toxic", "n"):
        fresh[c] = frame[c].to_numpy()
    every = np.array(list(at), dtype=object)
    if key[0].startswith("+"):
        yield summed(every, fresh, fresh["mask"].astype(np.int32), fresh["n"])
        return
    fresh["text"] = np.frombuffer(b"".join(frame["digest"]), dtype="S16")
    rows = np.concatenate([seen, fresh])
    # Rows of a text stand together, smallest ids first; those above the first id of their text fail E.
    rows_at = np.lexsort((rows["part"], rows["id"], rows["text"]))
    rows, old = rows[rows_at], rows_at < len(seen)
    new_text = np.append(True, rows["text"][1:] != rows["text"][:-1])
    first = np.flatnonzero(new_text)[np.cumsum(new_text) - 1]
    fails = rows["id"] != rows["id"][first]
    mask = rows["mask"].astype(np.int32)
    counted = pd.concat(
        [
            summed(every, rows[old & fails], mask[old & fails], -rows["n"][old & fails]),
            summed(every, rows[fails], mask[fails] | E_BIT, rows["n"][fails]),
            summed(every, rows[~old & ~fails], mask[~old & ~fails], rows["n"][~old & ~fails]),
        ]
    )
    kept = rows[~fails]
    new = np.append(True, (kept["text"][1:] != kept["text"][:-1]) | (kept["part"][1:] != kept["part"][:-1]))[: len(kept)]
    total = np.add.reduceat(kept["n"], np.flatnonzero(new)) if len(kept) else kept["n"]
    kept = kept[new]
    kept["n"] = total
    used, kept["part"] = np.unique(kept["part"], return_inverse=True)
    state.update((every[used].tolist(), kept.tobytes()))
    yield counted


def _labels(labels: DataFrame) -> DataFrame:
    """One row per labelled id."""
    return labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("string").alias("label_id")).agg(
        F.max(F.coalesce((F.col("quality") == 1).cast("int"), F.lit(0))).alias("good"),
        F.max(F.coalesce((F.col("toxic") == 1).cast("int"), F.lit(0))).alias("toxic"),
    )


def count_masks(
    spark: SparkSession, path: str, labels: DataFrame, options: AuditOptions = AuditOptions(), part: str = "source"
) -> DataFrame:
    """Documents per (part, mask), with how many of them are good and toxic: the sum of all micro-batches' changes.

    `path` is a Parquet file or a folder of them with doc_id, text and the column named `part`.
    """
    ready_workers(spark)
    table = spark.read.parquet(path)
    home = f"{scratch_folder(spark)}/{uuid.uuid4().hex}/filter_audit"
    size = max(options.least_batch, -(-(plan_bytes(table) or 0) // options.batches))
    # A pattern that matches just this path: streams take a single file only as a match.
    place = path.rstrip("/")
    files = spark.readStream.schema(table.select("doc_id", "text", part).schema).option("maxBytesPerTrigger", size)
    stream = files.parquet(f"{place[:-1]}[{place[-1]}]")
    text = F.coalesce(F.col("text"), F.lit(""))
    marked = stream.select(
        F.substring(F.unhex(F.sha2(text, 256)), 1, 16).alias("digest"),
        F.col("doc_id").cast("long").alias("id"),
        F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"),
        text_mask(text, options).alias("mask"),
    )
    # Null ids get a text of their own each, which equals no label's id: they never meet in one task.
    marked = marked.withColumn("label_id", F.coalesce(F.col("id").cast("string"), F.concat(F.lit("-"), F.hex("digest"))))
    rows = marked.join(_labels(labels), "label_id", "left").select(
        "digest", "id", "part", "mask", F.coalesce("good", F.lit(0)).alias("good"), F.coalesce("toxic", F.lit(0)).alias("toxic")
    )
    most, slices = options.texts_at_once, max(1, -(-(plan_bytes(table) or 0) // options.slice_bytes))

    def merge(batches):
        return merged_rows(batches, most, slices)

    deltas = (
        rows.mapInArrow(merge, SEEN)
        .groupBy("slice")
        .applyInPandasWithState(changes, CHANGE, STATE, "append", GroupStateTimeout.NoTimeout)
    )

    def keep(batch: DataFrame, number: int) -> None:
        sums = batch.groupBy("part", "mask").agg(F.sum("n").alias("n"), F.sum("good").alias("good"), F.sum("toxic").alias("toxic"))
        sums.write.mode("overwrite").parquet(f"{home}/changes/batch={number}")

    writer = deltas.writeStream.outputMode("append").foreachBatch(keep).trigger(availableNow=True)
    writer.option("checkpointLocation", f"{home}/checkpoint").start().awaitTermination()
    # A folder without rows has no batch: the schema is given and an empty change makes the folder exist.
    spark.createDataFrame([], CHANGE).write.mode("append").parquet(f"{home}/changes/batch=-1")
    seen = spark.read.schema(CHANGE).parquet(f"{home}/changes")
    sums = seen.groupBy("part", "mask").agg(*(F.sum(c).alias(c) for c in ("n", "good", "toxic")))
    return sums.where("n <> 0")


def audit_orders(counts: DataFrame) -> DataFrame:
    """One row per part, order and step from the counters of `count_masks`."""
    masks = range(32)
    tables = counts.groupBy("part").agg(
        *(
            F.array(*(F.coalesce(F.sum(F.when(F.col("mask") == m, F.col(c))), F.lit(0)) for m in masks)).alias(c)
            for c in ("n", "good", "toxic")
        )
    )
    steps = [
        ("".join(order), k + 1, 1 << FILTERS.index(f), sum(1 << FILTERS.index(x) for x in order[:k]))
        for order in itertools.permutations(FILTERS)
        for k, f in enumerate(order)
    ]
    literal = ", ".join(f"named_struct('filter_order', '{o}', 'step', {k}, 'bit', {b}, 'done', {d})" for o, k, b, d in steps)

    def total(column: str, condition: str) -> Column:
        held = f"filter(sequence(0, 31), m -> {condition})"
        return F.expr(f"aggregate({held}, 0L, (a, m) -> a + {column}[m])")

    here = "(m & s.bit) <> 0 and (m & s.done) = 0"
    shapley = F.expr(
        "aggregate(filter(sequence(0, 31), m -> (m & s.bit) <> 0), 0L, (a, m) -> a + n[m] * (120 div bit_count(m)))"
    )
    return tables.withColumn("s", F.explode(F.expr(f"array({literal})"))).select(
        "part",
        "s.filter_order",
        "s.step",
        total("n", "(m & (s.bit | s.done)) = 0").alias("kept"),
        total("n", here).alias("removed"),
        total("n", "(m & s.bit) <> 0 and (m & s.done) <> 0").alias("redundant"),
        total("n", "m = s.bit").alias("unique_fails"),
        total("good", here).alias("good_lost"),
        total("toxic", here).alias("toxic_lost"),
        shapley.alias("shapley"),
    )


def filter_interactions(
    spark: SparkSession, path: str, labels: DataFrame, options: AuditOptions = AuditOptions(), part: str = "source"
) -> DataFrame:
    """The audit of the documents at `path`: counts per part, order of the filters and step."""
    return audit_orders(count_masks(spark, path, labels, options, part))
