"""Many fitted corrections in one pass: every row names its model by number."""

from __future__ import annotations

from functools import reduce
from typing import Any

from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadcast.operators import encode as E
from loadcast.operators.boosting import joined_trees, on_used_inputs, same_steps
from loadcast.operators.residual import ResidualModel


def predict_each(df: DataFrame, models: list[Any], which: str, out: str = "correction") -> DataFrame:
    """`out` by the model whose place in `models` stands in the whole-number column `which`; 0 where that is NULL.

    Trees on the same inputs are joined to one ensemble and their encodings to one table, so the rows are read and encoded
    once however many models there are. Any other models score a slice of the rows each.
    """
    if not models:
        return df.withColumn(out, F.lit(0.0))
    trees = all(isinstance(m, ResidualModel) and m.spec == models[0].spec for m in models)
    if trees and same_steps([m.trees for m in models]):
        return _together(df, models, which, out)
    slices = [m.predict(df.where(F.col(which) == k), out) for k, m in enumerate(models)]
    return reduce(DataFrame.unionByName, slices, df.where(F.col(which).isNull()).withColumn(out, F.lit(0.0)))


def _together(df: DataFrame, models: list[ResidualModel], which: str, out: str) -> DataFrame:
    spec = models[0].spec
    numbered = [m.encodings.withColumn(which, F.lit(k)) for k, m in enumerate(models)]
    encodings = reduce(DataFrame.unionByName, numbered)

    def by_model(values: list[float]) -> Column:
        return F.get(F.array(*[F.lit(float(v)) for v in values]), F.col(which))

    encoded = E.apply_encoding(df, encodings, spec.categorical, by_model([m.default for m in models]), scope=[which])
    inputs = [*E.model_inputs(spec.categorical, spec.numeric), f"double(coalesce({which}, 0))"]
    ensemble, used = on_used_inputs(joined_trees(df.sparkSession, [m.trees for m in models]))
    matrix = F.expr("array(" + ", ".join(inputs[k] for k in used) + ")")
    scored = ensemble.transform(encoded.withColumn("features", array_to_vector(matrix)))
    value = F.coalesce(F.col("prediction") * by_model([m.scale for m in models]), F.lit(0.0))
    return scored.withColumn(out, value).drop("features", "prediction", *[f"{c}_enc" for c in spec.categorical])
