"""Boosted trees for the absolute error whose leaves are medians and which grow by the best split first.

Spark's trees choose the splits, on the signs of the residuals. A split depends only on the rows of its node, so growing the
best split first up to a number of leaves is the same as fitting the whole tree to its greatest depth and keeping the splits
in the order of a queue by gain. Each kept leaf then gets the exact median of its rows' residuals instead of the mean of
their signs, so a tree moves a forecast by as much as the rows ask for, and the target's unit does not matter.

The result is an ordinary GBTRegressionModel: it scores as one expression, and is saved and loaded like any other.
"""

from __future__ import annotations

import heapq
import itertools
from dataclasses import dataclass
from typing import Any

from pyspark.ml.linalg import VectorUDT
from pyspark.ml.regression import DecisionTreeRegressionModel, DecisionTreeRegressor, GBTRegressionModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from loadcast.operators.medians import grouped_medians
from loadcast.session import materialize


@dataclass(frozen=True)
class BoostOptions:
    #: At least one.
    max_iter: int = 220
    step_size: float = 0.06
    max_depth: int = 8
    #: Leaves of a tree; None keeps all that the depth allows.
    max_leaves: int | None = 31
    min_leaf_rows: int = 30
    #: Fitting ends when the held-out error has not fallen by this share for `patience` trees.
    tolerance: float = 1e-4
    patience: int = 3
    seed: int = 42
    memory_mb: int = 1024
    #: The rows' forecasts are written after so many trees, so that no lineage grows longer.
    write_every: int = 10


def best_first(root: Any, max_leaves: int | None) -> set[int]:
    """Positions (root 1, children 2p and 2p+1) of the splits that a queue by gain keeps; `root` is a node of Spark's tree."""

    def entry(node: Any, place: int):
        if node.subtreeDepth() == 0:
            return None
        return (-node.gain() * node.impurityStats().count(), place, node)

    queue, kept = [e for e in [entry(root, 1)] if e], set()
    while queue and (max_leaves is None or len(kept) + 1 < max_leaves):
        _, place, node = heapq.heappop(queue)
        kept.add(place)
        for child, at in ((node.leftChild(), 2 * place), (node.rightChild(), 2 * place + 1)):
            if e := entry(child, at):
                heapq.heappush(queue, e)
    return kept


def _pruned(spark: SparkSession, node: Any, kept: set[int], values: Any, place: int = 1) -> Any:
    """The tree of the kept splits, its leaves holding what `values` yields from left to right."""
    trees = spark.sparkContext._jvm.org.apache.spark.ml.tree
    if place not in kept:
        return trees.LeafNode(float(next(values)), node.impurity(), node.impurityStats())
    left = _pruned(spark, node.leftChild(), kept, values, 2 * place)
    right = _pruned(spark, node.rightChild(), kept, values, 2 * place + 1)
    return trees.InternalNode(node.prediction(), node.impurity(), node.gain(), left, right, node.split(), node.impurityStats())


def _tree(spark: SparkSession, uid: str, root: Any, features: int) -> DecisionTreeRegressionModel:
    java = spark.sparkContext._jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel(uid, root, features)
    return DecisionTreeRegressionModel(java)


def _ensemble(spark: SparkSession, trees: list[DecisionTreeRegressionModel], weights: list[float]) -> GBTRegressionModel:
    context = spark.sparkContext
    kind = context._jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel
    array = context._gateway.new_array(kind, len(trees))
    for k, t in enumerate(trees):
        array[k] = t._java_obj
    numbers = context._gateway.new_array(context._jvm.double, len(weights))
    for k, w in enumerate(weights):
        numbers[k] = float(w)
    java = context._jvm.org.apache.spark.ml.regression.GBTRegressionModel(f"median_leaves_{trees[-1].uid}", array, numbers)
    return GBTRegressionModel(java)


def leaf_medians(rows: DataFrame) -> dict[int, float]:
    """Exact interpolated median of `residual` per `leaf` (whole numbers from 0, as many as a tree has).

    A sketch per leaf brackets the middle, one more pass counts what lies below and orders the distinct values inside,
    some ten-thousandths of the rows. Where the middle lies outside the bracket, all levels of `grouped_medians` decide.
    """
    near = F.percentile_approx("residual", [0.4997, 0.5003], 20_000).alias("near")
    found = {r.leaf: (r.near, r.n) for r in rows.groupBy("leaf").agg(near, F.count(F.lit(1)).alias("n")).collect()}
    if not found:
        return {}
    last = max(found)
    low, high, n = (F.get(F.array(*[F.lit(f(found.get(k, ([0.0, 0.0], 0)))) for k in range(last + 1)]), F.col("leaf")) for f in (
        lambda x: float(x[0][0]), lambda x: float(x[0][1]), lambda x: int(x[1])
    ))
    value = F.when(F.col("residual") >= low, F.col("residual")).otherwise(F.lit(float("-inf")))
    cells = rows.where(F.col("residual") <= high).groupBy("leaf", value.alias("v")).agg(F.count(F.lit(1)).alias("c"))
    upto = F.sum("c").over(W.partitionBy("leaf").orderBy("v"))
    cells = cells.withColumn("upto", upto)
    first, second = (F.min(F.when(F.col("upto") >= F.floor((n + k) / 2), F.col("v"))).alias(f"m{k}") for k in (1, 2))
    middle = {r.leaf: (r.m1, r.m2) for r in cells.groupBy("leaf").agg(first, second).collect()}
    if all(k in middle and None not in middle[k] and middle[k][0] != float("-inf") for k in found):
        return {k: (a + b) / 2 for k, (a, b) in middle.items()}
    return {r.leaf: r.median for r in grouped_medians(rows, [["leaf"]], "residual").collect()}


def _written_rows(matrix: DataFrame) -> DataFrame:
    """The rows with their inputs as vectors, written once.

    Arrays become vectors by being stored the way vectors are, so no function has to turn every row's inputs into objects.
    """
    if isinstance(matrix.schema["features"].dataType, VectorUDT):
        return materialize(matrix, "boost_rows")
    dense = "named_struct('type', 1Y, 'size', cast(null as int), 'indices', cast(null as array<int>), 'values', features)"
    stored = matrix.withColumn("features", F.expr(dense))
    kinds = StructType([StructField("features", VectorUDT()), *stored.schema.fields[1:]])
    return materialize(stored, "boost_rows", schema=kinds)


def fit_median_trees(matrix: DataFrame, options: BoostOptions = BoostOptions()) -> GBTRegressionModel:
    """Trees from `matrix` (features as vector or array, label, held_out): the first is the labels' median, the others correct it step by step.

    Rows with `held_out` decide when to stop and are in no fit; without any, all trees are grown. The trees up to the least
    held-out error are kept.
    """
    spark = matrix.sparkSession
    learn = ~F.col("held_out")
    rows = _written_rows(matrix.select("features", "label", "held_out"))
    middle = grouped_medians(rows.where(learn).select("label"), [[]], "label").first()
    start = float(middle["median"]) if middle else 0.0
    rows = rows.withColumn("f", F.lit(start))
    trees: list[DecisionTreeRegressionModel] = []
    best, best_at, held = None, 0, rows.where("held_out").limit(1).count() > 0
    for number in range(options.max_iter):
        residual = F.col("label") - F.col("f")
        signs = rows.where(learn).select("features", F.signum(residual).alias("sign"))
        whole = DecisionTreeRegressor(
            featuresCol="features",
            labelCol="sign",
            maxDepth=options.max_depth,
            minInstancesPerNode=options.min_leaf_rows,
            seed=options.seed + number,
            maxMemoryInMB=options.memory_mb,
        ).fit(signs)
        root, features = whole._call_java("rootNode"), whole.numFeatures
        kept = best_first(root, options.max_leaves)
        uid = f"tree_{number}"
        shape = _tree(spark, uid, _pruned(spark, root, kept, itertools.count()), features)
        # What follows needs a row's leaf and none of its inputs, so the inputs are read once for all of it.
        placed = shape.setPredictionCol("leaf").transform(rows)
        placed = placed.select(F.col("leaf").cast("int").alias("leaf"), "label", "held_out", "f")
        placed = materialize(placed, "leaves")
        medians = leaf_medians(placed.where(learn).select("leaf", residual.alias("residual")))
        values = [float(medians.get(k, 0.0)) for k in range(len(kept) + 1)]
        tree = _tree(spark, uid, _pruned(spark, root, kept, iter(values)), features)
        moved = tree.setPredictionCol("move").transform(rows)
        rows_now = moved.select("features", "label", "held_out", (F.col("f") + options.step_size * F.col("move")).alias("f"))
        # In between, the few newest trees are added up anew: that is less work than keeping all inputs of all rows again.
        if (number + 1) % options.write_every == 0:
            rows_now = materialize(rows_now, "boost_rows")
        trees.append(tree)
        if held:
            reached = F.col("f") + options.step_size * F.get(F.array(*[F.lit(v) for v in values]), F.col("leaf"))
            error = placed.where("held_out").agg(F.avg(F.abs(F.col("label") - reached))).first()[0]
            if best is None or error < best * (1 - options.tolerance):
                best, best_at = error, len(trees)
        else:
            best_at = len(trees)
        rows = rows_now
        if held and len(trees) - best_at >= options.patience:
            break
    stats = trees[0]._call_java("rootNode").impurityStats()
    leaf = spark.sparkContext._jvm.org.apache.spark.ml.tree.LeafNode(start, 0.0, stats)
    first = _tree(spark, "start", leaf, trees[0].numFeatures)
    kept_trees = trees[:best_at]
    return _ensemble(spark, [first, *kept_trees], [1.0, *[options.step_size] * len(kept_trees)])


def on_used_inputs(model: GBTRegressionModel, spark: SparkSession | None = None) -> tuple[GBTRegressionModel, list[int]]:
    """The same trees over fewer inputs, and the places of those that some split reads (the first one if none does).

    Whoever scores rows has to read and pass on these alone.
    """
    # A thread of its own has no active session.
    spark = spark or SparkSession.getActiveSession()
    nodes = spark.sparkContext._jvm.org.apache.spark.ml.tree
    roots = [t._call_java("rootNode") for t in model.trees]

    def read(node: Any) -> set[int]:
        if node.subtreeDepth() == 0:
            return set()
        return {node.split().featureIndex()} | read(node.leftChild()) | read(node.rightChild())

    used = sorted(set().union(*map(read, roots))) or [0]
    place = {feature: k for k, feature in enumerate(used)}

    def moved(node: Any) -> Any:
        if node.subtreeDepth() == 0:
            return node
        split = nodes.ContinuousSplit(place[node.split().featureIndex()], node.split().threshold())
        halves = moved(node.leftChild()), moved(node.rightChild())
        return nodes.InternalNode(node.prediction(), node.impurity(), node.gain(), *halves, split, node.impurityStats())

    trees = [_tree(spark, f"used_{k}", moved(root), len(used)) for k, root in enumerate(roots)]
    return _ensemble(spark, trees, list(model.treeWeights)), used


def same_steps(models: list[GBTRegressionModel]) -> bool:
    """Whether trees at the same place weigh the same in all models, however many trees each has."""
    weights = [list(m.treeWeights) for m in models]
    longest = max(weights, key=len)
    return all(w == longest[: len(w)] for w in weights)


def joined_trees(spark: SparkSession, models: list[GBTRegressionModel]) -> GBTRegressionModel:
    """One ensemble for all models: the feature after their own tells by number which of them scores a row.

    Tree k splits on that number down to the k-th tree of the model, so a row passes log2(models) more nodes a tree; models
    with fewer trees add 0 there. The models must weigh their trees alike (`same_steps`).
    """
    if not same_steps(models):
        raise ValueError("the models weigh their trees differently")
    nodes = spark.sparkContext._jvm.org.apache.spark.ml.tree
    roots = [[t._call_java("rootNode") for t in m.trees] for m in models]
    features = models[0].trees[0].numFeatures
    stats = roots[0][0].impurityStats()

    def choose(place: int, first: int, end: int) -> Any:
        if end - first == 1:
            own = roots[first]
            return own[place] if place < len(own) else nodes.LeafNode(0.0, 0.0, stats)
        middle = (first + end) // 2
        split = nodes.ContinuousSplit(features, middle - 0.5)
        halves = choose(place, first, middle), choose(place, middle, end)
        return nodes.InternalNode(0.0, 0.0, 0.0, *halves, split, stats)

    longest = max(range(len(models)), key=lambda k: len(roots[k]))
    trees = [_tree(spark, f"joined_{k}", choose(k, 0, len(models)), features + 1) for k in range(len(roots[longest]))]
    return _ensemble(spark, trees, list(models[longest].treeWeights))
