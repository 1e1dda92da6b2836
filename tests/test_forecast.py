"""End to end: enrichment, backtest, final models, package."""

import dataclasses

import numpy as np
import pytest
from pyspark.sql import functions as F

from fixtures import mapping, plant
from loadcast import names as N
from loadcast.config import ForecastConfig
from loadcast.operators import splits as S
from loadcast.operators.baseline import fallback_medians, fill_baseline
from loadcast.operators.features import build_features
from loadcast.operators.model_set import predict_each
from loadcast.operators.residual import fit_residual
from loadcast.plans.forecast import SET_LEVELS, run_forecast
from loadcast.plans.package import build_package, load_package, save_package, score_package
from loadcast.plans.prepare import join_prepared, prepare_energy
from loadcast.session import materialize

CONFIG = ForecastConfig(
    validation_days=3,
    n_splits=1,
    min_train_rows=100,
    max_train_rows=50_000,
    max_iter=6,
    step_size=0.3,
    compute_importance=False,
    score_full_history=False,
)


@pytest.fixture(scope="module")
def joined(spark):
    raw, weather = plant(spark, 20)
    energy, _ = prepare_energy(raw, mapping(spark), CONFIG)
    return materialize(join_prepared(energy, weather, CONFIG)[0], "joined")


@pytest.fixture(scope="module")
def run(spark, joined):
    last = joined.agg(F.max("model_utc").cast("timestamp_ntz")).first()[0]
    is_last = F.col("model_utc") == F.lit(str(last)).cast("timestamp")
    gap = (F.col("trade_date") == "2025-01-01") & (F.col("trade_hour") == 7) & (F.col("client") == "CLIENT_0_1")
    dry = {f: F.when(~is_last, F.col(f)) for f in N.WEATHER_FEATURES}
    changed = joined.withColumns(
        {
            **dry,
            "actual": F.when(~is_last & ~gap, F.col("actual")),
            "weather_matched": F.col("weather_matched") & ~is_last,
            "weather_available": F.when(is_last, 0.0).otherwise(F.col("weather_available")),
            "weather_status": F.when(is_last, N.W_MISSING).otherwise(F.col("weather_status")),
        }
    )
    return run_forecast(changed, CONFIG), is_last, gap


def test_every_energy_row_is_matched_once(joined):
    assert joined.count() == 20 * 24 * 4 * 2 * 2
    assert joined.filter(~F.col("weather_matched")).count() == 0
    assert joined.select("lead_hours").distinct().collect()[0][0] == 30.0


def test_end_to_end(run):
    result, is_last, gap = run
    p = result.predictions
    assert p.count() == 7680
    oof = p.filter(F.col("prediction_status") == N.P_OOF)
    assert oof.count() > 0
    rows = {(r.model, r.scope, r.value): r for r in result.metrics.collect()}
    assert rows[(N.M_HYBRID, "GLOBAL", "ALL")].n == rows[(N.M_LAG, "GLOBAL", "ALL")].n == oof.count()
    assert {"WEATHER", "MACRO_CLIENT", "POINT", "DIRECTION"} <= {k[1] for k in rows}
    future = p.filter(is_last)
    assert [r[0] for r in future.select("prediction_status").distinct().collect()] == [N.P_FUTURE]
    assert future.filter(~F.col("without_weather") | F.col("strategy").isNull() | F.col("forecast").isNull()).count() == 0
    assert future.filter(~F.col("blend_alpha").between(0, 1)).count() == 0
    history = p.filter(F.col("actual").isNotNull())
    assert history.filter(F.col("full_model").isNotNull() | F.col("full_model_in_sample")).count() == 0
    assert {r[0] for r in p.filter(gap).select("prediction_status").collect()} == {N.P_GAP}
    for d, a in result.models.items():
        usable = history.filter((F.col("direction") == d) & (F.col("actual") >= 0) & F.col("model_utc").isNotNull())
        assert a.history_rows == usable.count()
        assert a.train_rows == usable.filter(F.col("baseline").isNotNull()).count() > 0
        assert 0.0 <= a.alpha <= 1.0


def test_package_round_trip_and_scoring(spark, run, joined, folder):
    result, is_last, _ = run
    package = build_package(result, CONFIG, mapping(spark))
    save_package(package, folder + "/package")
    loaded = load_package(spark, folder + "/package")
    assert loaded.config == CONFIG and loaded.spec == result.spec
    assert loaded.facts["input_rows"] == 7680 and loaded.cutoff == package.cutoff
    assert set(loaded.models) == set(N.DIRECTIONS)
    assert loaded.tables["history_tail"].count() == package.facts["history_tail_rows"]
    assert {r[0] for r in loaded.tables["profiles"].select("level").distinct().collect()} == {0, 1, 2, 3, 4}
    dry = joined.filter(is_last).withColumns(
        {
            **{f: F.lit(None).cast("double") for f in N.WEATHER_FEATURES},
            "actual": F.lit(None).cast("double"),
            "weather_matched": F.lit(False),
            "weather_available": F.lit(0.0),
        }
    )
    scored = score_package(loaded, joined.filter(~is_last).unionByName(dry))
    assert scored.count() == 16
    keys = ["source_sheet", "source_row"]
    both = scored.select(*keys, F.col("forecast").alias("again")).join(result.predictions.select(*keys, "forecast"), keys)
    assert both.filter(F.abs(F.col("again") - F.col("forecast")) > 1e-6).count() == 0 and both.count() == 16


def test_package_rejects_bad_state(spark, run):
    result, _, _ = run
    package = build_package(result, CONFIG, mapping(spark))
    for change in (
        {"version": 99},
        {"models": {N.IMPORT: result.models[N.IMPORT]}},
        {"models": {d: dataclasses.replace(a, alpha=0.5, model=None) for d, a in result.models.items()}},
        {"models": {d: dataclasses.replace(a, alpha=1.5) for d, a in result.models.items()}},
        {"models": {d: dataclasses.replace(a, train_rows=10, history_rows=1) for d, a in result.models.items()}},
        {"facts": {}},
        {"facts": {"forecast_must_be_after_utc": "2025-01-01T00:00:00"}},
        {"tables": {**package.tables, "history_tail": package.tables["history_tail"].drop("client")}},
        {"tables": {**package.tables, "history_tail": package.tables["history_tail"].limit(0)}},
        {"tables": {**package.tables, "mapping": package.tables["mapping"].drop("point")}},
    ):
        with pytest.raises(ValueError):
            dataclasses.replace(package, **change).validate()


class KnownCorrection:
    """Predicts a column that was put beside the features."""

    def predict(self, df, out):
        return df.withColumn(out, F.coalesce(F.col("known"), F.lit(0.0)))


def test_test_window_actuals_do_not_move_the_fold_alpha(spark):
    config = ForecastConfig(
        validation_days=2,
        n_splits=1,
        calibration_days=2,
        min_calibration_rows=1,
        min_improvement=0.0,
        grid_steps=5,
        min_train_rows=50,
        compute_importance=False,
    )
    raw, weather = plant(spark, 10)
    energy, _ = prepare_energy(raw, mapping(spark), config)
    joined = join_prepared(energy, weather, config)[0]
    lagged = build_features(joined)[0].select(
        "source_row", (F.col("actual") - F.col("baseline")).alias("known"), F.col("baseline").alias("_b")
    )
    base = materialize(joined.join(lagged, "source_row"), "leak")
    outer = F.col("model_utc") >= F.lit("2025-01-09 00:00:00").cast("timestamp")
    moved = base.withColumn("actual", F.when(outer, F.col("_b")).otherwise(F.col("actual")))
    fits = []

    def fit(train, spec, cfg):
        fits.append(1)
        return KnownCorrection()

    first = run_forecast(base.drop("_b"), config, fit=fit)
    assert len(fits) == 4
    second = run_forecast(moved.drop("_b"), config, fit=fit)
    alphas = [{(d["fold"], d["direction"]): d["blend_alpha"] for d in r.decisions} for r in (first, second)]
    assert alphas[0] == alphas[1] and all(a > 0 for a in alphas[0].values())


def test_importance_covers_every_feature(spark, joined):
    config = dataclasses.replace(CONFIG, compute_importance=True, max_iter=2)
    result = run_forecast(joined, config)
    rows = result.importance.collect()
    assert {r.feature for r in rows} == set(result.spec.all) and {r.direction for r in rows} == set(N.DIRECTIONS)
    assert any(r.importance > 0 for r in rows)


def test_without_any_actual_nothing_is_forecast(joined):
    empty = joined.withColumn("actual", F.lit(None).cast("double"))
    result = run_forecast(empty, CONFIG)
    assert result.cutoff is None and result.decisions == [] and result.metrics.count() == 0
    status = [r[0] for r in result.predictions.select("prediction_status").distinct().collect()]
    assert status == [N.P_GAP] and result.predictions.count() == 7680
    assert {a.calibration_reason for a in result.models.values()} == {N.R_FEW_FINAL}


def test_short_history_falls_back_to_the_baseline(joined):
    """Too few rows with lags before the calibration window: plain baseline, alpha 0."""
    short = joined.filter(F.col("trade_date") <= "2025-01-12")
    result = run_forecast(short, dataclasses.replace(CONFIG, min_train_rows=400, calibration_days=7))
    assert {d["calibration_reason"] for d in result.decisions} == {N.R_FEW_FIT}
    oof = result.predictions.filter(F.col("prediction_status") == N.P_OOF)
    assert oof.count() > 0
    assert oof.filter((F.col("strategy") != N.S_BASELINE) | (F.col("forecast") != F.col("baseline_backtest"))).count() == 0


def test_one_pass_scores_what_every_fold_model_scores_alone(spark, joined):
    """Overlapping calibration windows: a row is scored once per use, by the model and medians of that use."""
    config = dataclasses.replace(CONFIG, n_splits=2, validation_days=2, calibration_days=4, min_train_rows=20, max_iter=3)
    table = materialize(build_features(joined)[0], "features", ["direction"])
    spec = build_features(joined)[1]
    folds = S.expanding_splits(S.forecast_cutoff(table), 2, 2)
    medians = fallback_medians(S.training_sets(table, folds, 4), ["set_id"], SET_LEVELS)
    medians = materialize(medians, "medians")
    models, pairs = [], []
    for f in folds:
        for d in N.DIRECTIONS:
            fit = table.filter((F.col("direction") == d) & S.trainable() & (S.calibration_part(f.start, 4) == "FIT"))
            pairs.append((f, d, len(models), True))
            models.append(fit_residual(fit, spec, config))
    # One pair without a model.
    pairs[1] = (pairs[1][0], pairs[1][1], None, False)
    uses = S.scoring_roles(table, pairs, 4)
    scans = [line for line in uses._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Relation" in line]
    assert len(scans) == 1
    uses = materialize(uses, "uses", ["role", "direction"])
    filled = fill_baseline(uses, medians, ["set_id"], SET_LEVELS, out="base")
    got = predict_each(filled, models, "model").select("source_row", "role", "fold", "direction", "base", "correction")
    want = None
    for k, (f, d, number, calibrated) in enumerate(pairs):
        test = (F.col("model_utc") >= S.instant(f.start)) & (F.col("model_utc") < S.instant(f.end))
        for role, inside in (("TEST", test), ("CAL", S.calibration_part(f.start, 4) == "CALIBRATION")):
            if role == "CAL" and not calibrated:
                continue
            rows = table.filter((F.col("direction") == d) & S.trainable() & inside).withColumn("set_id", F.lit(f"{role}_{f.number}"))
            rows = fill_baseline(rows, medians, ["set_id"], SET_LEVELS, out="base")
            rows = rows.withColumn("correction", F.lit(0.0)) if number is None else models[number].predict(rows)
            rows = rows.select("source_row", F.lit(role).alias("role"), F.lit(f.number).alias("fold"), "direction", "base", "correction")
            want = rows if want is None else want.unionByName(rows)
    keys = ["source_row", "role", "fold", "direction"]
    a, b = (df.toPandas().sort_values(keys).reset_index(drop=True) for df in (got, want))
    assert len(a) == len(b) > 0 and (a[keys] == b[keys]).all().all()
    assert np.allclose(a[["base", "correction"]], b[["base", "correction"]], rtol=1e-9, atol=1e-9)
    assert a.correction.abs().max() > 0 and (a.groupby("source_row").size() > 1).any()


def test_models_of_other_kinds_score_their_slices(spark):
    class Plus:
        def __init__(self, step):
            self.step = step

        def predict(self, df, out):
            return df.withColumn(out, F.col("x") + self.step)

    df = spark.createDataFrame([(1.0, 0), (1.0, 1), (1.0, None), (None, 1)], "x double, m int")
    got = [tuple(r) for r in predict_each(df, [Plus(1), Plus(10)], "m").orderBy("m", "x").collect()]
    assert got == [(1.0, None, 0.0), (1.0, 0, 2.0), (None, 1, None), (1.0, 1, 11.0)]
    assert {r.correction for r in predict_each(df, [], "m").collect()} == {0.0}
