"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree.

Every row has a seeded hash; its leading bits name one of `BLOCKS` blocks of its source, so a source's blocks in order are
its rows in random order. A source gets a word target. It is met by whole passes over the source and one partial pass that
takes the blocks up to the one in which the target falls, and in that block the rows up to a cut, found from block totals
and from the rows of that block only. The blocks all sources give (repeats counted) are dealt to the output shards by
halving the shards again and again: each half's number of blocks of each source is drawn from the multivariate
hypergeometric distribution. A shard then draws its own, disjoint stretch of each source's permuted block list, and is
shuffled locally.

Only one row per source (totals, cut) meets on the driver; `max_sources` bounds it and more sources are an error.

Cases: null or empty text counts 0 words and is taken 0 words; a null source is a source of its own, last in order; null
ids and repeated rows are mixed like any row, equal rows alike; an empty table gives an empty mix.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from loadcast.llm.common import NOT_SPACE
from loadcast.session import materialize

BLOCK_BITS = 12
BLOCKS = 1 << BLOCK_BITS


@dataclass(frozen=True)
class MixOptions:
    """weights repeat over the sources in code-point order; no source is taken more than `repeats` times its size."""

    weights: tuple[float, ...] = (5.0, 2.0, 1.0)
    repeats: int = 3
    shards: int = 32
    seed: int = 20_261
    max_sources: int = 1_000_000


def row_hash(seed: int) -> Column:
    """63 random-looking bits of a row; equal rows share them."""
    return F.xxhash64(F.lit(seed), F.col("source"), F.col("doc_id"), F.col("text")).bitwiseAND(F.lit((1 << 63) - 1))


def sized(docs: DataFrame, options: MixOptions) -> DataFrame:
    """doc_id, source, number of words and hash of each row: all that the plan of a mix needs."""
    return docs.select(
        "doc_id",
        F.col("source").cast("string").alias("source"),
        F.coalesce(F.regexp_count("text", F.lit(NOT_SPACE + "+")), F.lit(0)).cast("long").alias("size"),
        row_hash(options.seed).alias("h"),
    )


def word_targets(sizes: list[int], options: MixOptions) -> list[float]:
    """Shares of the total by weight, each at most `repeats` times its source; the excess goes to the others by weight."""
    total, target = float(sum(sizes)), [0.0] * len(sizes)
    weight = [options.weights[i % len(options.weights)] for i in range(len(sizes))]
    most = [float(options.repeats * s) for s in sizes]
    # Sources reach their limit in the order of limit per weight.
    rest, left = total, math.fsum(weight)
    for i in sorted(range(len(sizes)), key=lambda i: most[i] / weight[i]):
        target[i] = min(most[i], rest * weight[i] / left) if left > 0 else 0.0
        rest, left = rest - target[i], left - weight[i]
    return target


def split_blocks(quota: np.ndarray, shards: int, rng: np.random.Generator) -> np.ndarray:
    """Number of blocks per shard (rows) and source (columns); columns add up to `quota`, shards differ by one at most."""
    if shards == 1:
        return quota[None, :]
    left = shards // 2
    take = int(quota.sum()) * left // shards
    part = np.zeros_like(quota)
    open_, need = int(quota.sum()), take
    for i, n in enumerate(quota.tolist()):  # one hypergeometric marginal after another
        part[i] = n if need >= open_ else int(rng.hypergeometric(n, open_ - n, need)) if need and n else 0
        open_, need = open_ - n, need - int(part[i])
    return np.vstack([split_blocks(part, left, rng), split_blocks(quota - part, shards - left, rng)])


PLAN = T.StructType(
    [
        T.StructField("source", T.StringType()),
        T.StructField("source_size", T.LongType()),
        T.StructField("target", T.DoubleType()),
        T.StructField("passes", T.LongType()),
        T.StructField("cut", T.LongType()),
        T.StructField("ends", T.ArrayType(T.LongType())),
    ]
)


def plan_mix(rows: DataFrame, options: MixOptions) -> DataFrame:
    """One row per source: its size, target, whole passes, the hash up to which the partial pass takes rows (-1: none) and
    the slots of its permuted block list at which each shard's stretch ends. `rows` is from `sized`."""
    spark = rows.sparkSession
    block = F.shiftright("h", 63 - BLOCK_BITS).alias("block")
    totals = rows.groupBy("source", block).agg(F.sum("size").alias("size"))
    by_source = totals.groupBy("source").agg(F.sum("size").alias("size")).limit(options.max_sources + 1).collect()
    if len(by_source) > options.max_sources:
        raise ValueError(f"more than {options.max_sources} sources; raise MixOptions.max_sources")
    by_source.sort(key=lambda r: (r.source is None, (r.source or "").encode()))
    names, sizes = [r.source for r in by_source], [r["size"] for r in by_source]
    targets = word_targets(sizes, options)
    passes = [min(options.repeats, int(t // s)) if s else 0 for t, s in zip(targets, sizes, strict=True)]
    open_ = [t - p * s for t, p, s in zip(targets, passes, sizes, strict=True)]
    want = spark.createDataFrame(
        list(zip(names, [float(x) for x in open_], strict=True)), "source string, open double"
    )
    before = F.sum("size").over(W.partitionBy("source").orderBy("block")) - F.col("size")
    partial = (
        totals.withColumn("before", before)
        .withColumnRenamed("source", "s")
        .join(want, F.col("s").eqNullSafe(F.col("source")))
        .where((F.col("before") < F.col("open")) & (F.col("open") <= F.col("before") + F.col("size")))
        .select("source", F.col("block").alias("cut_block"), (F.col("open") - F.col("before")).alias("g"))
    )
    here = rows.select(F.col("source").alias("s"), "size", "h", block).join(
        partial, F.col("s").eqNullSafe(F.col("source")) & (F.col("block") == F.col("cut_block"))
    )
    same = here.groupBy("source", "g", "cut_block", "h").agg(F.sum("size").alias("size"))
    upto = F.sum("size").over(W.partitionBy("source").orderBy("h"))
    cuts = {
        r.source: (r.cut_block, r.cut)
        for r in same.withColumn("upto", upto)
        .groupBy("source", "cut_block")
        .agg(F.max(F.when(F.col("upto") - F.col("size") / 2 <= F.col("g"), F.col("h"))).alias("cut"))
        .collect()
    }
    width, quota, cut = 1 << (63 - BLOCK_BITS), [], []
    for name, p in zip(names, passes, strict=True):
        b, c = cuts.get(name, (None, None))
        cut.append(-1 if b is None else b * width - 1 if c is None else c)
        quota.append(p * BLOCKS + (0 if b is None else b + 1))
    rng = np.random.default_rng(options.seed)
    ends = np.cumsum(split_blocks(np.array(quota, dtype=np.int64), options.shards, rng), axis=0) if names else np.zeros((0, 0))
    plan = [
        (names[i], sizes[i], targets[i], passes[i], cut[i], [int(x) for x in ends[:, i]]) for i in range(len(names))
    ]
    return spark.createDataFrame(plan, PLAN)


def with_plan(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """Rows with their source's plan and `copies`, how often the mix takes them."""
    plan = plan.withColumnRenamed("source", "plan_source")
    joined = rows.join(plan, F.col("source").eqNullSafe(F.col("plan_source"))).drop("plan_source")
    return joined.withColumn("copies", F.col("passes") + (F.col("h") <= F.col("cut")).cast("long"))


def assign_shards(taken: DataFrame, options: MixOptions) -> DataFrame:
    """One row per copy with its `shard` and its random `place` there. `taken` is from `with_plan`."""
    block = F.shiftright("h", 63 - BLOCK_BITS)
    # Another permutation of the blocks in each whole pass: an odd factor is invertible modulo a power of two.
    slot = F.when(
        F.col("pass") < F.col("passes"),
        F.col("pass") * BLOCKS + F.pmod(block * (F.col("pass") * 2 + 1637) + F.col("pass") * 977, F.lit(BLOCKS)),
    ).otherwise(F.col("pass") * BLOCKS + block)
    return (
        taken.where("copies > 0")
        .withColumn("pass", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)))
        .withColumn("slot", slot)
        .withColumn("shard", F.size(F.filter("ends", lambda e: e <= F.col("slot"))))
        .withColumn("place", F.xxhash64(F.lit(options.seed + 1), "shard", "pass", "h"))
        .drop("slot")
    )


def taken_words(rows: DataFrame, options: MixOptions = MixOptions()) -> DataFrame:
    """`rows` (of `sized`, written once, each with a `row_no` of its own) with source_size, target and `taken`.

    The plan's blocks are dealt to the shards and every copy is drawn as the mix draws it, but without its text; `taken` is
    the sum of a row's words over the shards that hold it.
    """
    planned = with_plan(rows, plan_mix(rows.drop("row_no"), options))
    drawn = assign_shards(planned, options).groupBy("row_no").agg(F.sum("size").alias("taken"))
    kept = planned.select(*rows.columns, "source_size", "target").join(drawn, "row_no", "left")
    return kept.withColumn("taken", F.coalesce("taken", F.lit(0).cast("long")))


def mixed_documents(docs: DataFrame, options: MixOptions = MixOptions()) -> DataFrame:
    """The mixed corpus with the columns of `docs`: a row for every copy, by shard and in random order within a shard."""
    plan = plan_mix(materialize(sized(docs, options), "sizes"), options)  # words are counted once
    rows = docs.select(
        F.struct("*").alias("row"), F.col("source").cast("string").alias("source"), row_hash(options.seed).alias("h")
    )
    joined = with_plan(rows, plan)
    out = assign_shards(joined, options)
    # Ranges of (shard, place): as many tasks as the session's shuffle partitions, however few shards there are, and the
    # files of a shard one after another are its random order.
    return out.repartitionByRange("shard", "place").sortWithinPartitions("shard", "place").select("row.*")
