"""Median leaves and best-first growth."""

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressionModel, GBTRegressor
from pyspark.sql import functions as F

from loadcast.operators import boosting as B


def sample(spark, seed, n=1500, unit=1000.0):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 4))
    y = unit * (np.sin(2 * x[:, 0]) + x[:, 1] * (x[:, 2] > 0) + 0.3 * rng.standard_t(2, n))
    rows = [(k, x[k].tolist(), float(y[k]), k >= n * 4 // 5) for k in range(n)]
    df = spark.createDataFrame(rows, "id int, x array<double>, label double, held_out boolean")
    return df.select("id", array_to_vector("x").alias("features"), "label", "held_out").cache()


def error(model, df):
    return model.transform(df.where("held_out")).agg(F.avg(F.abs(F.col("label") - F.col("prediction")))).first()[0]


def test_leaves_are_medians_as_numpy_computes_them(spark, folder):
    df = sample(spark, 1)
    options = B.BoostOptions(max_iter=4, step_size=0.3, max_leaves=9, min_leaf_rows=20, patience=9, tolerance=-1.0)
    model = B.fit_median_trees(df, options)
    assert model.getNumTrees == 5 and list(model.treeWeights) == [1.0, 0.3, 0.3, 0.3, 0.3]
    rows = df
    for k, t in enumerate(model.trees):
        t = t.setPredictionCol(f"p{k}")
        rows = (t.setLeafCol(f"leaf{k}") if k else t).transform(rows)
    got = rows.toPandas()
    learn = ~got.held_out
    assert (got.p0 == np.median(got.label[learn])).all()
    f = got.p0.copy()
    for k in range(1, 5):
        residual, leaf = got.label - f, got[f"leaf{k}"]
        assert 2 <= leaf.nunique() <= 9
        want = residual[learn].groupby(leaf[learn]).median()
        assert np.allclose(got[f"p{k}"], leaf.map(want), rtol=1e-12)
        assert leaf[learn].value_counts().min() >= 20
        f += 0.3 * got[f"p{k}"]
    assert np.allclose(model.transform(df).orderBy("id").toPandas().prediction, f.to_numpy()[np.argsort(got.id)])
    model.save(f"{folder}/model")
    assert error(GBTRegressionModel.load(f"{folder}/model"), df) == pytest.approx(error(model, df))


def test_growth_takes_the_best_split_first(spark):
    df = sample(spark, 2)
    whole = DecisionTreeRegressor(labelCol="label", maxDepth=6, minInstancesPerNode=10).fit(df)
    gains = {}

    def walk(node, place):
        if node.subtreeDepth():
            gains[place] = node.gain() * node.impurityStats().count()
            walk(node.leftChild(), 2 * place)
            walk(node.rightChild(), 2 * place + 1)

    walk(whole._call_java("rootNode"), 1)
    for leaves in (1, 2, 5, 12, None):
        kept = B.best_first(whole._call_java("rootNode"), leaves)
        assert len(kept) == (len(gains) if leaves is None else min(leaves - 1, len(gains)))
        open_, order = {1}, set()
        for _ in kept:  # plain greedy choice among all open splits
            best = max((p for p in open_ if p in gains), key=gains.get)
            open_ |= {2 * best, 2 * best + 1}
            open_.remove(best)
            order.add(best)
        assert kept == order


def test_error_is_no_worse_than_plain_boosting(spark):
    # Steps large enough that eight trees take up most of the signal: plain boosting's first tree counts in full.
    for seed in (3, 4, 5):
        df = sample(spark, seed)
        ours = B.fit_median_trees(df, B.BoostOptions(max_iter=8, step_size=0.4, patience=8, seed=seed))
        scale = df.approxQuantile("label", [0.75], 0.0)[0]
        unit = df.withColumn("label", F.col("label") / scale)
        plain = GBTRegressor(lossType="absolute", maxIter=8, stepSize=0.4, maxDepth=5, minInstancesPerNode=30, seed=seed).fit(unit.where("not held_out"))
        assert error(ours, df) <= scale * error(plain, unit)


def test_leaf_medians_with_ties_and_single_rows(spark):
    rng = np.random.default_rng(7)
    rows = [(0, float(v)) for v in rng.normal(size=301)] + [(1, 5.0)] + [(3, float(v)) for v in [2.0] * 50 + [1.0, 9.0] * 20] + [(4, 1.0), (4, 2.0)]
    df = spark.createDataFrame(rows, "leaf int, residual double").repartition(3)
    want = {k: float(np.median([v for q, v in rows if q == k])) for k in (0, 1, 3, 4)}
    assert B.leaf_medians(df) == want
    assert B.leaf_medians(df.limit(0)) == {}


def test_rows_without_a_held_out_part_use_all_trees(spark):
    df = sample(spark, 6, n=300).withColumn("held_out", F.lit(False))
    assert B.fit_median_trees(df, B.BoostOptions(max_iter=3, write_every=2)).getNumTrees == 4
    flat = df.withColumn("label", F.lit(2.5))
    model = B.fit_median_trees(flat, B.BoostOptions(max_iter=2))
    assert {r.prediction for r in model.transform(flat).collect()} == {2.5}


def test_joined_trees_score_as_each_model_does(spark):
    """Models of unlike numbers of trees; the extra last feature names the model."""
    frames = [sample(spark, k, n=600) for k in (3, 4, 5)]
    models = [
        B.fit_median_trees(df, B.BoostOptions(max_iter=k + 1, step_size=0.3, max_leaves=5, min_leaf_rows=15, patience=9, tolerance=-1.0))
        for k, df in enumerate(frames)
    ]
    assert [m.getNumTrees for m in models] == [2, 3, 4] and B.same_steps(models)
    both = B.joined_trees(spark, models)
    assert both.getNumTrees == 4
    x = sample(spark, 6, n=400)
    for k, m in enumerate(models):
        want = m.transform(x).select("id", F.col("prediction").alias("want"))
        wide = x.withColumn("features", array_to_vector(F.concat(vector_to_array("features"), F.array(F.lit(float(k))))))
        got = both.transform(wide).join(want, "id")
        assert got.count() == 400 and got.where(F.abs(F.col("prediction") - F.col("want")) > 1e-9).count() == 0
    other = B.fit_median_trees(frames[0], B.BoostOptions(max_iter=1, step_size=0.1, max_leaves=3, tolerance=-1.0))
    assert not B.same_steps([models[0], other])
    with pytest.raises(ValueError):
        B.joined_trees(spark, [models[0], other])


def test_array_inputs_are_stored_as_vectors(spark):
    rows = [([float(k % 7), float(k % 3)], float(k % 5), False) for k in range(200)]
    arrays = spark.createDataFrame(rows, "features array<double>, label double, held_out boolean")
    vectors = arrays.withColumn("features", array_to_vector("features"))
    options = B.BoostOptions(max_iter=2, step_size=0.5, max_depth=2, min_leaf_rows=1)
    one, other = B.fit_median_trees(arrays, options), B.fit_median_trees(vectors, options)
    assert [t.toDebugString.split("\n", 1)[1:] for t in one.trees] == [t.toDebugString.split("\n", 1)[1:] for t in other.trees]


def test_leaf_medians_and_errors_read_no_inputs(spark, monkeypatch):
    """Per tree the inputs are read once for the leaves; medians come from the leaves alone."""
    plans, real = [], B.leaf_medians
    monkeypatch.setattr(B, "leaf_medians", lambda rows: plans.append(rows._jdf.queryExecution().optimizedPlan().toString()) or real(rows))
    rows = [([float(k % 7), float(k % 3)], float(k % 5), k > 150) for k in range(200)]
    df = spark.createDataFrame(rows, "features array<double>, label double, held_out boolean")
    B.fit_median_trees(df, B.BoostOptions(max_iter=2, step_size=0.5, max_depth=2, min_leaf_rows=1))
    assert len(plans) == 2 and not [p for p in plans if "features" in p]


def test_trees_on_the_inputs_they_read(spark):
    """A score has to pass on only the inputs that some split reads, and stays the same."""
    rows = [([0.0, float(k % 7), 1.0, float(k % 3), 2.0], float(k % 7 + k % 3), False) for k in range(200)]
    df = spark.createDataFrame(rows, "features array<double>, label double, held_out boolean")
    model = B.fit_median_trees(df, B.BoostOptions(max_iter=3, step_size=0.5, max_depth=2, min_leaf_rows=1))
    small, used = B.on_used_inputs(model)
    assert set(used) <= {1, 3} and small.trees[0].numFeatures == len(used)
    picked = F.array(*[F.get("features", F.lit(k)) for k in used])
    whole = model.transform(df.select(array_to_vector("features").alias("features")))
    part = small.transform(df.select(array_to_vector(picked).alias("features")))
    assert [r[0] for r in whole.select("prediction").collect()] == [r[0] for r in part.select("prediction").collect()]


def test_trees_without_a_split_keep_one_input(spark):
    df = spark.createDataFrame([([1.0, 2.0], 3.0, False)] * 5, "features array<double>, label double, held_out boolean")
    small, used = B.on_used_inputs(B.fit_median_trees(df, B.BoostOptions(max_iter=1, min_leaf_rows=1)))
    assert used == [0]
    assert small.transform(df.select(array_to_vector(F.slice("features", 1, 1)).alias("features"))).first().prediction == 3.0
