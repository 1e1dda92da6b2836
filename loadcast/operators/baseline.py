"""Baseline for rows without lags: medians from ever wider groups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadcast.functions.rowwise import clip
from loadcast.operators.medians import grouped_medians
from loadcast.session import few_rows, materialize

LEVELS = [
    ["client", "direction", "hour"],
    ["branch_code", "direction", "hour"],
    ["direction", "hour"],
    ["direction"],
    [],
]
LEVEL_NAMES = ["client_direction_hour", "branch_direction_hour", "direction_hour", "direction", "global"]


def fallback_medians(
    train: DataFrame, scope: list[str] | None = None, levels: list[list[str]] = LEVELS
) -> DataFrame:
    """Medians of `actual` at every fallback level (long form, see `grouped_medians`)."""
    return grouped_medians(train, levels, "actual", scope)


def fill_baseline(
    rows: DataFrame,
    medians: DataFrame,
    scope: list[str] | None = None,
    levels: list[list[str]] = LEVELS,
    out: str = "baseline_filled",
) -> DataFrame:
    """`baseline`, else the first median found from the narrowest level outwards, else 0; never below 0.

    A genuine 0 is a value. The levels are resolved per distinct key combination first, and the result is written. Where it
    is small, the rows are read once and look their median up. Otherwise only rows without a baseline are joined and all
    others pass straight through, so the wide table is not shuffled for the few that need help.
    """
    scope = scope or []
    keys = list(dict.fromkeys([*scope, *(c for level in levels for c in level)]))
    # Combinations of all rows: without the filter on the baseline, the optimizer drops what computes it from this branch.
    found = _resolve(rows.select(*keys).distinct(), medians, scope, keys, levels)
    found = materialize(found.select(*[F.col(k).alias(f"_k_{k}") for k in keys], "_found"), "fallbacks")
    used = [*[f"_k_{k}" for k in keys], "_found"]
    if few_rows(found):
        value = clip(F.coalesce(F.col("baseline"), F.col("_found"), F.lit(0.0)), low=0.0)
        return rows.join(F.broadcast(found), _same(keys), "left").withColumn(out, value).drop(*used)
    kept = rows.filter(F.col("baseline").isNotNull()).withColumn(out, clip(F.col("baseline"), low=0.0))
    need = rows.filter(F.col("baseline").isNull())
    filled = need.join(found, _same(keys), "left").drop(*used[:-1])
    value = clip(F.coalesce(F.col("_found"), F.lit(0.0)), low=0.0)
    return kept.unionByName(filled.withColumn(out, value).drop("_found"))


def _same(keys: list[str]) -> Column:
    return F.expr(" and ".join(f"{k} <=> _k_{k}" for k in keys))


def _resolve(combos: DataFrame, medians: DataFrame, scope: list[str], keys: list[str], levels) -> DataFrame:
    """Median of the narrowest level that has one, per key combination. Keys a level ignores are NULL on both sides."""
    variants = []
    for number, level in enumerate(levels):
        values = [f"'_v_{k}', {k if k in scope or k in level else f'nullif({k}, {k})'}" for k in keys]
        variants.append(f"named_struct('_level', {number}, {', '.join(values)})")
    wanted = combos.select(*keys, F.expr(f"inline(array({', '.join(variants)}))"))
    side = medians.selectExpr("level as _m_level", *[f"{k} as _m_{k}" for k in keys], "median as _median")
    match = F.expr(" and ".join(["_level = _m_level", *[f"_v_{k} <=> _m_{k}" for k in keys]]))
    return wanted.join(side, match).groupBy(*keys).agg(F.min_by("_median", "_level").alias("_found"))
