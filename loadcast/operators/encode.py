"""Target encoding of categories and the numeric input matrix."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadcast.session import materialize

FOLDS = 5
ALL_ROWS = -1


def row_fold(row_key: list[str], seed: int = 42, folds: int = FOLDS) -> Column:
    return F.pmod(F.xxhash64(*[F.col(c) for c in row_key], F.lit(seed)), F.lit(folds)).cast("int")


def _shrunk(n: Column, s: Column, q: Column, all_n: Column, all_s: Column, all_q: Column) -> Column:
    """Category mean pulled towards the overall mean by the ratio of the variances (empirical Bayes)."""
    all_n, some = F.nullif(all_n, F.lit(0.0)), F.nullif(n, F.lit(0.0))
    overall = all_s / all_n
    overall_var = F.greatest(all_q / all_n - overall * overall, F.lit(0.0))
    spread = F.greatest(q - s * s / some, F.lit(0.0))
    weight = overall_var * some / F.nullif(overall_var * some + spread / some, F.lit(0.0))
    return F.coalesce(weight * (s / some) + (1 - weight) * overall, overall)


def target_cells(df: DataFrame, categories: list[str], target: str, fold: Column) -> DataFrame:
    """Count, sum and sum of squares per (category combination, fold): the only pass over the rows."""
    y = F.col(target)
    return df.groupBy(*categories, fold.alias("fold")).agg(
        F.count(y).alias("n"), F.sum(y).alias("s"), F.sum(y * y).alias("q")
    )


def _category_totals(cells: DataFrame, categories: list[str], folds: int) -> DataFrame:
    """Long per-fold encodings: feature, value, fold, enc. `fold` ALL_ROWS is the encoding from all rows; every other
    fold's encoding comes from the rows outside that fold. Categories unseen outside a fold take the overall mean."""
    long = cells.select(
        "fold",
        "n",
        "s",
        "q",
        F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).alias("value")) for c in categories])).alias("t"),
    ).select("fold", "n", "s", "q", "t.*")
    sums = ["n", "s", "q"]
    per_value = long.groupBy("feature", "value").agg(*_sums_outside(sums, folds, ""))
    overall = cells.agg(*_sums_outside(sums, folds, "all_"))
    # `overall` is a single row.
    joined = per_value.join(F.broadcast(overall))
    variants = F.array(
        *[
            F.struct(
                F.lit(k).alias("fold"),
                _shrunk(*[F.col(f"{prefix}{c}_{k}") for prefix in ("", "all_") for c in sums]).alias("enc"),
            )
            for k in [ALL_ROWS, *range(folds)]
        ]
    )
    return joined.select("feature", "value", F.inline(variants))


def _sums_outside(sums: list[str], folds: int, prefix: str) -> list[Column]:
    """Each sum over all rows and over the rows outside every fold."""
    everything = [F.expr(f"cast(sum({c}) as double) as `{prefix}{c}_{ALL_ROWS}`") for c in sums]
    return everything + [
        F.expr(f"cast(sum(if(fold = {k}, 0, {c})) as double) as `{prefix}{c}_{k}`") for k in range(folds) for c in sums
    ]


def encoding_table(cells: DataFrame, categories: list[str], folds: int = FOLDS) -> DataFrame:
    return _category_totals(cells, categories, folds)


def overall_mean(cells: DataFrame) -> DataFrame:
    return cells.agg((F.sum("s") / F.sum("n")).alias("mean"))


def apply_encoding(
    df: DataFrame,
    encodings: DataFrame,
    categories: list[str],
    default: float | Column,
    fold: Column | None = None,
    scope: list[str] | None = None,
    combos: DataFrame | None = None,
) -> DataFrame:
    """Adds `<category>_enc`. Without `fold` the all-rows encodings apply, with it the out-of-fold ones.

    `scope` names columns of both frames that must agree too, such as the number of a model; `default` may depend on them.

    Encodings are looked up once per distinct category combination (as many as there are series), all categories in
    one join, and the wide rows are joined a single time. What was looked up is written first: Spark then knows its size
    and, where it is small, sends it to the wide rows instead of shuffling and sorting those. `combos` may name the
    combinations (`fold` as their last column) where they are known already.
    """
    tag = "_fold"
    keyed = df.withColumn(tag, F.lit(ALL_ROWS) if fold is None else fold)
    scope = scope or []
    keys = [*scope, *categories, tag]
    other = default if isinstance(default, Column) else F.lit(float(default))
    combos = (keyed.select(*keys) if combos is None else combos.select(*keys[:-1], F.col("fold").alias(tag))).distinct()
    pairs = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).alias("value")) for c in categories])
    wanted = combos.select(*keys, F.inline(pairs))
    side = encodings.select(*scope, "feature", "value", F.col("fold").alias(tag), "enc")
    found = wanted.join(side, [*scope, "feature", "value", tag], "left")
    table = found.groupBy(*keys).agg(
        *[
            F.coalesce(F.max(F.when(F.col("feature") == c, F.col("enc"))), other).alias(f"{c}_enc")
            for c in categories
        ]
    )
    return keyed.join(materialize(table, "lookup"), keys, "left").drop(tag)


def crossfit_encode(
    df: DataFrame, category: str, target: str, fold: Column, folds: int = FOLDS, out: str = "encoded"
) -> DataFrame:
    """Out-of-fold encoding of one category: no row sees its own fold's targets."""
    cells = target_cells(df, [category], target, fold)
    table = encoding_table(cells, [category], folds).filter("fold >= 0")
    side = table.select(F.col("value").alias(category), F.col("fold").alias("_fold"), F.col("enc").alias(out))
    return df.withColumn("_fold", fold).join(side, [category, "_fold"], "left").drop("_fold")


def impute_with_indicator(df: DataFrame, columns: list[str]) -> DataFrame:
    """0 for missing plus a 0/1 column that says so. For model input only, never stored data."""
    return df.withColumns(
        {
            **{f"{c}_missing": F.col(c).isNull().cast("double") for c in columns},
            **{c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in columns},
        }
    )


def _input_columns(categories: list[str], numeric: list[str]) -> list[str]:
    return [f"cast({c} as double)" for c in [*[f"{c}_enc" for c in categories], *numeric]]


def model_inputs(categories: list[str], numeric: list[str]) -> list[str]:
    """Model inputs of a row as SQL: encoded categories and numeric features with NULL → 0, then one missing flag per
    numeric feature."""
    filled = [f"coalesce({c}, 0D)" for c in _input_columns(categories, numeric)]
    return [*filled, *[f"double({c} is null)" for c in numeric]]


def model_matrix(categories: list[str], numeric: list[str]) -> Column:
    return F.expr("array(" + ", ".join(model_inputs(categories, numeric)) + ")")
