"""Near-duplicate vectors: cross-polytope hashing after fast Hadamard rotations, multiprobe buckets, verified pairs.

1. Equal vectors form a class; one of each class goes on, with the number of its rows as weight.
2. A hash function rotates a vector (three rounds of random signs and a fast Hadamard transform) and names the coordinate
   of largest size and its sign: the nearest corner of a cross-polytope. A table joins several functions; a vector enters
   the bucket of its corners and, for each function, the bucket with that function's second corner.
   The number of functions grows with the logarithm of the number of vectors, so that buckets of unrelated vectors stay
   at about one member; the number of tables follows from the wanted recall.
3. Buckets of one member are dropped before any vector moves, buckets with the same members collapse to one, and long
   buckets are split into blocks that meet in pairs.
4. In a block all pairs are compared in double precision. A pair that meets in several buckets counts in the first of
   them only, so that direct links are counted exactly; the block gives one row per vector (links, part), never pairs.

Cases: null, empty and zero vectors and those with null or non-finite components link with nothing (0 links, their own
component); vectors of different length never link; rows without an id link with nothing, have no component and are kept;
a repeated id is one node of the components and its rows count as vectors of their own; an empty table gives an empty
result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadcast.llm.graph import connected_components
from loadcast.llm.groups import Parts, in_blocks, sorted_groups
from loadcast.llm.near_text import _overlaps
from loadcast.session import materialize

#: Rows of a block.
BLOCK_ROWS = 1024
#: Chance that one function (with its second corner) brings two vectors at cosine 0.9 together, measured; bound below.
MEET = 0.67


@dataclass(frozen=True)
class Cosine:
    limit: float = 0.9
    miss: float = 0.004
    seed: int = 11


def hadamard(x: np.ndarray) -> np.ndarray:
    """Walsh-Hadamard transform of the rows; their length is a power of two."""
    m, d = x.shape
    h = 1
    while h < d:
        x = x.reshape(m, d // (2 * h), 2, h)
        x = np.stack([x[:, :, 0] + x[:, :, 1], x[:, :, 0] - x[:, :, 1]], axis=2).reshape(m, d)
        h *= 2
    return x


def corners(x: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """First and second nearest corner of the rotated rows."""
    for _ in range(3):
        x = hadamard(x * rng.choice([-1.0, 1.0], x.shape[1]))
    size = np.abs(x)
    best = size.argmax(axis=1)
    rows = np.arange(len(x))
    size[rows, best] = -1
    pair = np.stack([best, size.argmax(axis=1)], axis=1) if x.shape[1] > 1 else np.stack([best, best], axis=1)
    return 2 * pair + (np.take_along_axis(x, pair, 1) < 0)


def _mix(h: np.ndarray, v: np.ndarray | int) -> np.ndarray:
    """A 64-bit hash of a hash and further integers."""
    h = (h ^ np.asarray(v, dtype=np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def buckets(x: np.ndarray, functions: int, tables: int, seed: int) -> np.ndarray:
    """Hashed names of the buckets each row enters: own and one per function, for each table."""
    m, d = x.shape
    wide = np.zeros((m, 1 << max(0, math.ceil(math.log2(d)))))
    wide[:, :d] = x
    out = np.zeros((m, tables * (1 + functions)), dtype=np.int64)
    for t in range(tables):
        codes = [corners(wide, np.random.default_rng([seed, d, t, f])) for f in range(functions)]
        for probe in range(1 + functions):
            h = _mix(np.full(m, np.uint64(d)), t + 1)
            for f in range(functions):
                h = _mix(h, codes[f][:, 1 if probe == f + 1 else 0])
            out[:, t * (1 + functions) + probe] = h.view(np.int64)
    return out


def _unit(values: np.ndarray) -> np.ndarray:
    x = values.astype(np.float64)
    x = x / np.abs(x).max(axis=1)[:, None]
    return x / np.sqrt((x * x).sum(axis=1))[:, None]


def _enter(functions: int, tables: int, seed: int):
    schema = pa.schema([("rep", pa.int64()), ("h1", pa.int64()), ("list", pa.list_(pa.int64()))])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = batch.column("v")
            lengths = np.diff(v.offsets.to_numpy())
            flat, ends = v.values.to_numpy(zero_copy_only=False), v.offsets.to_numpy()
            for d in np.unique(lengths).tolist():
                at = np.flatnonzero(lengths == d)
                x = _unit(flat[ends[at][:, None] + np.arange(d)])
                names = buckets(x, functions, tables, seed)
                width = names.shape[1]
                lists = pa.ListArray.from_arrays(np.arange(0, len(at) * width + 1, width, dtype=np.int32), names.ravel())
                take = pa.array(at)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("rep").take(take), batch.column("h1").take(take), lists], schema=schema
                )

    return work


def _block_links(limit: float):
    schema = pa.schema([("rep", pa.int64()), ("h1", pa.int64()), ("links", pa.int64()), ("root", pa.int64())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in sorted_groups(batches, ["list", "i", "j"]):
            v = group.column("v").combine_chunks()
            ends = v.offsets.to_numpy()
            flat, size = v.values.to_numpy(zero_copy_only=False), np.diff(ends)
            x = np.zeros((len(group), size.max()))
            x[np.arange(size.max()) < size[:, None]] = flat[ends[0] : ends[-1]]
            x = _unit(x)
            near = (x @ x.T >= limit) & (size[:, None] == size[None, :])
            np.fill_diagonal(near, False)
            i, j = group.column("i")[0].as_py(), group.column("j")[0].as_py()
            if i != j:
                side = group.column("part").to_numpy() == i
                near &= side[:, None] != side[None, :]
            if not near.any():
                continue
            own = group.column("list")[0].as_py()
            lists = group.column("lists").combine_chunks()
            at, ids = lists.offsets.to_numpy(), lists.values.to_numpy()
            earlier = [a[a < own] for a in (ids[at[r] : at[r + 1]] for r in range(len(group)))]
            if sum(map(len, earlier)):
                near &= _overlaps(earlier) == 0  # else the pair counts in an earlier bucket
            weight = group.column("w").to_numpy()
            parts = Parts(len(group))
            parts.join_pairs(*np.nonzero(np.triu(near)))
            some = near.any(axis=1)
            rep = group.column("rep").to_numpy()
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(rep[some]),
                    pa.array(group.column("h1").to_numpy()[some]),
                    pa.array((near @ weight)[some].astype(np.int64)),
                    pa.array(rep[parts.label][some]),
                ],
                schema=schema,
            )

    return work


def plan_index(n: int, dimension: int, miss: float) -> tuple[int, int]:
    """Functions per table and tables for `n` vectors."""
    corners_ = 2 << max(0, math.ceil(math.log2(max(2, dimension))))
    functions = max(1, math.ceil(math.log(4 * max(2, n)) / math.log(corners_)))
    return functions, math.ceil(math.log(miss) / math.log(1 - MEET**functions))


def near_vectors(vectors: DataFrame, cosine: Cosine = Cosine()) -> DataFrame:
    """vec_id, n_links, component_id and kept of every row of `vectors` (vec_id, embedding)."""
    key = ["h1", "h2"]
    finite = F.forall("embedding", lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    usable = F.col("vec_id").isNotNull() & F.coalesce(finite & F.exists("embedding", lambda x: x != 0), F.lit(False))
    rows = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.when(usable, F.xxhash64("embedding")).alias("h1"),
        F.when(usable, F.xxhash64(F.lit(7), "embedding")).alias("h2"),
        F.when(usable, F.col("embedding")).alias("v"),
    )
    classes = materialize(
        rows.where("h1 is not null")
        .groupBy(*key)
        .agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("w"), F.first("v").alias("v")),
        "classes",
    )
    shape = classes.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("v")).alias("d")).first()
    functions, tables = plan_index(shape["n"], shape["d"] or 1, cosine.miss)
    entered = materialize(
        classes.select("rep", "h1", "v")
        .mapInArrow(_enter(functions, tables, cosine.seed), "rep long, h1 long, list array<long>")
        .select("rep", "h1", F.explode(F.array_distinct("list")).alias("list")),
        "entered",
    )
    sizes = (
        entered.groupBy("list")
        .agg(
            F.count(F.lit(1)).alias("members"),
            F.bit_xor(F.xxhash64("rep", "h1")).alias("x1"),
            F.bit_xor(F.xxhash64(F.lit(5), "rep", "h1")).alias("x2"),
        )
        .where("members > 1")
        .groupBy("members", "x1", "x2")
        .agg(F.min("list").alias("list"))
        .select("list", "members")
    )
    members = materialize(entered.join(sizes, "list"), "members")
    in_lists = members.groupBy("rep", "h1").agg(F.collect_list("list").alias("lists"))  # at most tables * (1 + functions)
    heavy = classes.select("rep", "h1", "w", "v").join(in_lists, ["rep", "h1"])
    met = (
        in_blocks(members, "list", "rep", F.ceil(F.col("members") / BLOCK_ROWS))
        .select("list", "i", "j", "part", "rep", "h1")
        .join(heavy, ["rep", "h1"])
        .repartition("list", "i", "j")
        .sortWithinPartitions("list", "i", "j", "rep")
    )
    found = materialize(
        met.mapInArrow(_block_links(cosine.limit), "rep long, h1 long, links long, root long"), "found"
    )
    links = found.groupBy("rep", "h1").agg(F.sum("links").alias("links"))
    light = rows.drop("v")
    reps = light.join(classes.select(*key, "rep"), key).select("vec_id", "rep").distinct()
    first = reps.groupBy("vec_id").agg(F.min("rep").alias("b"))
    several = reps.join(first, "vec_id").select(F.col("rep").alias("a"), "b")
    parts = connected_components(found.select(F.col("rep").alias("a"), F.col("root").alias("b")).union(several))
    of_class = (
        classes.select(*key, "rep", "w")
        .join(links, ["rep", "h1"], "left")
        .join(parts, F.col("rep") == F.col("node"), "left")
        .select(
            *key,
            (F.coalesce("links", F.lit(0)) + F.col("w") - 1).alias("n"),
            F.coalesce("component", "rep").alias("class_component"),
        )
    )
    component = F.when(F.col("vec_id").isNotNull(), F.coalesce("class_component", "vec_id"))
    return light.join(of_class, key, "left").select(
        "vec_id",
        F.coalesce("n", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"),
    )
