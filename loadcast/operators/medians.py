"""Exact grouped medians from counts: no group is ever held in one task, at any size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Buckets in which a power of two is divided; a bucket is a relative band of 2^-16.
_OCTAVE_PARTS = 65_536


def grouped_medians(df: DataFrame, levels: list[list[str]], value: str, scope: list[str] | None = None) -> DataFrame:
    """Exact interpolated median per group for several grouping levels.

    Result: `level` (position in `levels`), the scope columns, all level columns (NULL where a level does not use
    them), `n` and `median`. NULL is an ordinary key value; rows without a value are left out; infinities and NaN are
    the outermost values.

    Equal values of the finest keys collapse to a count first, and everything below works on these counts: one pass sums
    them for all levels and value buckets, running sums tell which buckets hold the middle ranks, and only the values of
    those buckets, found for all levels in one join, are put in order. The ranks are neighbours, so what lies between two
    such buckets of a group is empty and one running sum serves both.
    """
    scope = scope or []
    keys = list(dict.fromkeys(c for level in levels for c in level))
    rows = df.filter(F.col(value).isNotNull()).select(*scope, *keys, F.col(value).cast("double").alias("_v"))
    cells = rows.groupBy(*scope, *keys, "_v").agg(F.count(F.lit(1)).alias("_n")).withColumn("_b", _bucket(F.col("_v")))
    every = _by_level(cells, scope, keys, levels)
    group = ["level", *scope, *keys]
    upto = W.partitionBy(*group).orderBy("_b").rowsBetween(W.unboundedPreceding, 0)
    buckets = every.groupBy(*group, "_b").agg(F.sum("_n").alias("_in")).withColumns(
        {"_upto": F.sum("_in").over(upto), "_size": F.sum("_in").over(W.partitionBy(*group))}
    )
    before = F.col("_upto") - F.col("_in")
    hits = buckets.withColumn("_before", before).filter(_holds(before, F.col("_upto"), 1) | _holds(before, F.col("_upto"), 2))
    on = [*group, "_b"]
    hits = hits.select(*[F.col(c).alias(f"_k_{c}") for c in on], "_size", "_before")
    inside = every.join(hits, F.expr(" and ".join(f"{c} <=> _k_{c}" for c in on)))
    order = W.partitionBy(*group).orderBy("_v").rangeBetween(W.unboundedPreceding, 0)
    end = F.min("_before").over(W.partitionBy(*group)) + F.sum("_n").over(order)
    ranked = inside.select(*group, "_size", "_v", end.alias("_end"))
    middle = [F.min(F.when(F.col("_end") >= _rank(which), F.col("_v"))) for which in (1, 2)]
    return ranked.groupBy(*group).agg(F.max("_size").alias("n"), ((middle[0] + middle[1]) / 2).alias("median"))


def _rank(which: int) -> Column:
    """The lower (1) or upper (2) middle rank."""
    return F.floor((F.col("_size") + which) / 2)


def _holds(before: Column, upto: Column, which: int) -> Column:
    """Whether a middle rank lies after `before` and not after `upto`."""
    return (before < _rank(which)) & (_rank(which) <= upto)


def _by_level(cells: DataFrame, scope: list[str], keys: list[str], levels: list[list[str]]) -> DataFrame:
    """Every cell once per level, keys that the level does not use being NULL."""
    variants = []
    for number, level in enumerate(levels):
        held = [f"'{k}', {k if k in level else f'nullif({k}, {k})'}" for k in keys]
        variants.append(f"named_struct({', '.join([f"'level', {number}", *held])})")
    return cells.select(F.expr(f"inline(array({', '.join(variants)}))"), *scope, "_b", "_v", "_n")


def _bucket(v: Column) -> Column:
    """Order-preserving bucket: sign, power of two and its part; infinities and NaN lie outside all others."""
    size = F.when(F.abs(v) < float("inf"), F.abs(v)).otherwise(F.lit(1.0))
    power = F.floor(F.log2(F.when(size > 0, size).otherwise(F.lit(1.0)))).cast("double")
    step = F.floor(size / F.pow(F.lit(2.0), power) * _OCTAVE_PARTS)
    code = ((power + 1100) * (2 * _OCTAVE_PARTS) + step).cast("long")
    outside = F.lit(1 << 40)
    code = F.when(F.isnan(v), outside + 1).when(F.abs(v) == float("inf"), outside).otherwise(code)
    return F.when(v == 0, F.lit(0).cast("long")).when(v > 0, code).otherwise(-code)
