"""Residual correction: boosted trees on actual minus baseline, with permutation importance."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import partial, reduce

from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import GBTRegressionModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from loadcast.config import ForecastConfig
from loadcast.operators import encode as E
from loadcast.operators.boosting import BoostOptions, fit_median_trees, on_used_inputs
from loadcast.operators.features import FeatureSpec
from loadcast.operators.medians import grouped_medians
from loadcast.session import materialize

ROW_KEY = ["source_sheet", "source_row"]
#: Trees of the leaf-limited kind: splits by gain up to so many leaves, no deeper than this, of so many rows at least.
MAX_LEAVES, LEAF_LIMIT_DEPTH, MIN_LEAF_ROWS = 31, 6, 30


@dataclass
class ResidualModel:
    trees: GBTRegressionModel
    encodings: DataFrame
    default: float
    scale: float
    spec: FeatureSpec

    def encode(self, df: DataFrame) -> DataFrame:
        return E.apply_encoding(df, self.encodings, self.spec.categorical, self.default)

    def predict(self, df: DataFrame, out: str = "correction") -> DataFrame:
        trees, used = on_used_inputs(self.trees)
        inputs = E.model_inputs(self.spec.categorical, self.spec.numeric)
        matrix = F.expr("array(" + ", ".join(inputs[k] for k in used) + ")")
        helper = [f"{c}_enc" for c in self.spec.categorical]
        return self.score(self.encode(df), matrix, out, trees).drop(*helper)

    def score(self, df: DataFrame, matrix: Column, out: str, trees: GBTRegressionModel | None = None) -> DataFrame:
        scored = (trees or self.trees).transform(df.withColumn("features", array_to_vector(matrix)))
        return scored.withColumn(out, F.col("prediction") * F.lit(self.scale)).drop("features", "prediction")


def usable_rows(df: DataFrame) -> DataFrame:
    """Rows with an actual and a lag baseline of their own; the target is the signed difference, never a logarithm."""
    usable = df.filter(F.col("actual").isNotNull() & F.col("baseline").isNotNull())
    return usable.withColumn("residual_target", F.col("actual") - F.col("baseline"))


def held_out_from(by_hour: list[tuple[int | None, int]]) -> int | None:
    """The hour from which rows decide when to stop: the newest hours that hold a tenth of the rows, never all of them.

    None if no hour can be held out (all rows share one).
    """
    hours = sorted(((h, n) for h, n in by_hour if h is not None), reverse=True)
    total, held, chosen = sum(n for _, n in by_hour), 0, None
    for h, n in hours:
        held += n
        if held == total:
            break
        chosen = h
        if 10 * held >= total:
            break
    return chosen


def fit_residual(train: DataFrame, spec: FeatureSpec, config: ForecastConfig) -> ResidualModel:
    """Fit on all usable rows of `train`.

    The target is divided by its median absolute size, so that tolerances mean the same in any unit. The newest tenth of
    the rows decides when to stop.
    """
    usable = usable_rows(train)
    fold = E.row_fold(ROW_KEY, config.seed)
    cells = materialize(E.target_cells(usable, spec.categorical, "residual_target", fold), "target_cells")
    hour = F.floor(F.unix_seconds("model_utc") / 3600)
    # One row per hour of history, so the split is exact and its counts stay small.
    by_hour = [(r.h, r.n) for r in usable.groupBy(hour.alias("h")).agg(F.count(F.lit(1)).alias("n")).collect()]
    rows, first_held = sum(n for _, n in by_hour), held_out_from(by_hour)
    middle = grouped_medians(usable.select(F.abs("residual_target").alias("size")), [[]], "size").first()
    if rows < config.min_train_rows:
        raise ValueError("too few rows with a lag baseline to learn a correction")
    mean = E.overall_mean(cells).first()[0]
    encodings = materialize(E.encoding_table(cells, spec.categorical), "encodings")
    scale = float(middle["median"]) if middle and middle["median"] else 1.0
    encoded = E.apply_encoding(usable, encodings, spec.categorical, mean, fold, combos=cells)
    matrix = encoded.select(
        E.model_matrix(spec.categorical, spec.numeric).alias("features"),
        (F.col("residual_target") / F.lit(scale)).alias("label"),
        F.coalesce(hour >= F.lit(first_held), F.lit(False)).alias("held_out"),
    )
    leafy = config.backend == "leaf_limited"
    trees = fit_median_trees(
        matrix,
        BoostOptions(
            max_iter=config.max_iter,
            step_size=config.step_size,
            max_depth=LEAF_LIMIT_DEPTH if leafy else config.tree_depth,
            max_leaves=MAX_LEAVES if leafy else None,
            min_leaf_rows=MIN_LEAF_ROWS if leafy else 1,
            seed=config.seed,
        ),
    )
    return ResidualModel(trees, encodings, float(mean), scale, spec)


def _reading(model: ResidualModel, inputs: list[str]) -> tuple[list[int], Callable[..., DataFrame]]:
    """Places of the inputs that a model reads and its scoring over these alone; all of them for models without trees."""
    if not isinstance(model, ResidualModel):
        return list(range(len(inputs))), model.score
    trees, used = on_used_inputs(model.trees, model.encodings.sparkSession)
    return used, partial(model.score, trees=trees)


def _with_donors(sample: DataFrame, buckets: int, seed: int, repeat: int) -> DataFrame:
    """Every row with the inputs of another one, `_other`: the rows of a bucket in one order meet those in a random order.

    A row takes its place in both orders and stands in the bucket twice, as receiver and as donor; sorted by place, the
    donor follows its receiver. So the rows are shuffled once and never joined.
    """
    bucket = W.partitionBy("_b")
    dealt = sample.withColumn("_b", F.pmod(F.xxhash64("_h", F.lit(seed - 1 - repeat)), F.lit(buckets)))
    own = F.row_number().over(bucket.orderBy("_h", *ROW_KEY))
    drawn = F.row_number().over(bucket.orderBy(F.xxhash64("_h", F.lit(seed + repeat)), *ROW_KEY))
    placed = dealt.select("_b", "_inputs", "residual_target", own.alias("_own"), drawn.alias("_drawn"))
    twice = F.expr("inline(array(struct(_own as _place, false as _donor), struct(_drawn as _place, true as _donor)))")
    other = F.lead("_inputs").over(bucket.orderBy("_place", "_donor"))
    met = placed.select("_b", "_inputs", "residual_target", twice).withColumn("_other", other)
    return met.where("not _donor").select(F.lit(repeat).alias("_repeat"), "_inputs", "_other", "residual_target")


def permutation_importance(
    model: ResidualModel, test: DataFrame, repeats: int = 2, seed: int = 42, bucket_rows: int = 2_000
) -> DataFrame:
    """Rise of the MAE when one input is shuffled: feature, importance, spread over repeats.

    All test rows count. They are dealt to random buckets of about `bucket_rows` and shuffled inside them, so that no
    task orders all rows. All repeats and all features that some tree reads are scored as one DataFrame; whatever stands
    in another feature, the forecasts and so their error are the same. Without rows the values are NULL.
    """
    spec, names = model.spec, model.spec.all
    inputs = E.model_inputs(spec.categorical, spec.numeric)
    used, score = _reading(model, inputs)
    # A numeric feature is two inputs, its value and whether it is missing; both are swapped together.
    owner = [k if k < len(names) else k - len(names) + len(spec.categorical) for k in used]
    matrix = F.expr("array(" + ", ".join(inputs[k] for k in used) + ")")
    narrow = model.encode(usable_rows(test)).select(
        matrix.alias("_inputs"), "residual_target", *ROW_KEY, F.xxhash64(*ROW_KEY).alias("_h")
    )
    sample = materialize(narrow, "importance")
    buckets = max(1, sample.count() // bucket_rows)
    miss = F.avg(F.abs(F.col("correction") - F.col("residual_target")))
    plain = score(sample.select("_inputs", "residual_target"), F.col("_inputs"), "correction").agg(miss).first()[0]
    read = sorted(set(owner)) if plain is not None else []
    # 0, but NaN like everything else where the error itself is no finite number.
    none = F.lit(plain).cast("double") - F.lit(plain).cast("double")
    rest = [F.lit(x) for k, x in enumerate(names) if k not in read]
    unread = sample.sparkSession.range(1, numPartitions=1).select(F.explode(F.array(*rest).cast("array<string>")).alias("feature"))
    unread = unread.select("feature", none.alias("importance"), none.alias("spread"))
    if not read:
        return unread
    shuffled = reduce(DataFrame.unionByName, [_with_donors(sample, buckets, seed, r) for r in range(repeats)])
    variants = shuffled.select("*", F.explode(F.array(*[F.lit(k) for k in read])).alias("_f"))
    swapped = F.expr("array(" + ", ".join(f"if(_f = {f}, _other[{k}], _inputs[{k}])" for k, f in enumerate(owner)) + ")")
    scored = score(variants, swapped, "correction").groupBy("_f", "_repeat").agg(miss.alias("mae"))
    feature = F.get(F.array(*[F.lit(x) for x in names]), F.col("_f")).alias("feature")
    rise = F.col("mae") - F.lit(plain).cast("double")
    found = scored.groupBy(feature).agg(F.avg(rise).alias("importance"), F.stddev_pop(rise).alias("spread"))
    return found.unionByName(unread)


def importance_summary(per_fold: DataFrame) -> DataFrame:
    """Mean and spread across folds per (direction, feature), most important first."""
    return (
        per_fold.groupBy("direction", "feature")
        .agg(
            F.avg("importance").alias("importance"),
            F.stddev_samp("importance").alias("spread_over_folds"),
            F.countDistinct(F.when(F.col("importance").isNotNull(), F.col("fold"))).alias("n_folds"),
        )
        .orderBy("direction", F.desc("importance"))
    )
