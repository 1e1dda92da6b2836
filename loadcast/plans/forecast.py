"""Backtest, final models and future forecast over an enriched energy table."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field, replace
from functools import partial
from typing import Any

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loadcast import names as N
from loadcast.config import ForecastConfig
from loadcast.functions.rowwise import blend
from loadcast.operators import splits as S
from loadcast.operators.baseline import LEVELS, fallback_medians, fill_baseline
from loadcast.operators.blend import select_alpha
from loadcast.operators.features import FeatureSpec, build_features
from loadcast.operators.metrics import add_errors, all_metrics
from loadcast.operators.model_set import predict_each
from loadcast.operators.residual import (
    ROW_KEY,
    fit_residual,
    importance_summary,
    permutation_importance,
    usable_rows,
)
from loadcast.session import materialize, require_utc
from loadcast.sources.limits import newest_rows

# Training sets never mix directions, so the widest fallback inside a set is the direction itself.
SET_LEVELS = LEVELS[:4]

_OOF_COLUMNS = {
    "fold": "int",
    "correction": "double",
    "baseline_backtest": "double",
    "residual_actual": "double",
    "raw_candidate": "double",
    "forecast": "double",
    "blend_alpha": "double",
    "strategy": "string",
    "calibration_n": "long",
    "calibration_improvement": "double",
    "calibration_reason": "string",
}
_DECISION = "fold int, direction string, blend_alpha double, calibration_n long, calibration_improvement double, calibration_reason string"


@dataclass
class DirectionArtifact:
    model: Any
    alpha: float
    calibration_n: int
    calibration_improvement: float
    calibration_reason: str
    train_rows: int = 0
    history_rows: int = 0
    train_start_utc: str | None = None
    train_end_utc: str | None = None
    target: str = "residual_to_D3_D14"


@dataclass
class ForecastResult:
    predictions: DataFrame
    metrics: DataFrame
    importance: DataFrame | None
    models: dict[str, DirectionArtifact]
    spec: FeatureSpec
    cutoff: dt.datetime | None
    decisions: list[dict[str, Any]] = field(default_factory=list)


def _union(frames: list[DataFrame]) -> DataFrame | None:
    out = None
    for frame in frames:
        out = frame if out is None else out.unionByName(frame)
    return out


def _corrected(model: Any, df: DataFrame, out: str) -> DataFrame:
    return df.withColumn(out, F.lit(0.0)) if model is None else model.predict(df, out)


def _is(direction: str) -> Column:
    return F.col("direction") == direction


def _decision(alpha: float, n: int, improvement: float, reason: str) -> dict[str, Any]:
    return {
        "blend_alpha": float(alpha),
        "calibration_n": int(n),
        "calibration_improvement": float(improvement),
        "calibration_reason": reason,
    }


def _in_threads(spark: SparkSession, jobs: dict[Any, Callable[[], Any]], workers: int) -> dict[Any, Any]:
    """Independent model fits submitted side by side; Spark's scheduler shares the cluster between them."""
    if workers <= 1 or len(jobs) <= 1:
        return {key: job() for key, job in jobs.items()}
    with ThreadPoolExecutor(workers) as pool:
        futures = {key: pool.submit(inheritable_thread_target(spark)(job)) for key, job in jobs.items()}
        return {key: future.result() for key, future in futures.items()}


def _capped_fit(rows: DataFrame, usable: int, config: ForecastConfig) -> tuple[DataFrame, int]:
    """Newest rows within the training cap, and how many of them are usable."""
    if config.max_train_rows is None:
        return rows, usable
    capped = newest_rows(rows, config.max_train_rows, ROW_KEY)
    return capped, usable_rows(capped).count()


def run_forecast(
    joined: DataFrame,
    config: ForecastConfig = ForecastConfig(),
    history: DataFrame | None = None,
    fit: Callable[[DataFrame, FeatureSpec, ForecastConfig], Any] = fit_residual,
) -> ForecastResult:
    """Backtest on expanding windows, learn one final model per direction, forecast the future rows.

    `history` may name narrower rows with the same series keys, hours and actuals (all hours of `joined` included) for
    the lags. The feature table is written once, split by direction, and every later step reads the slices it needs. Medians,
    the scores of all fold models on their test and calibration rows, and calibration run for all folds in one job each;
    only model fits, those of the folds and the final ones, are submitted side by side. The predictions are not written:
    who reads them once computes the columns in use, who reads them often writes them (`with_predictions`).
    """
    config.validate()
    require_utc(joined.sparkSession)
    features, spec = build_features(joined, config.lag_days, history)
    table = materialize(features, "features", ["direction"])
    cutoff = S.forecast_cutoff(table)
    folds = S.expanding_splits(cutoff, config.n_splits, config.validation_days)
    known = table.filter(F.col("direction").isin(N.DIRECTIONS))
    medians = materialize(
        fallback_medians(S.training_sets(known, folds, config.calibration_days), ["set_id"], SET_LEVELS), "medians"
    )
    history = table.filter(S.trainable() & F.col("model_utc").isNotNull())
    stats = {r.direction: r for r in training_range(history).collect()}
    counts, active, jobs = _fold_fits(table, folds, spec, config, fit)
    facts, final_jobs = _final_fits(history, stats, spec, config, fit)
    # No fit waits for another; the final ones are the longest and start first.
    fitted = _in_threads(table.sparkSession, {**final_jobs, **jobs}, config.parallel_fits)
    fold_models = {key: fitted[key] for key in jobs}
    oof, decisions = _backtest(table, medians, active, counts, fold_models, config)
    models = _final_models(oof, facts, {d: fitted[d] for d in final_jobs}, config)
    predictions = _assemble(table, oof, medians, folds, decisions, models, cutoff, config)
    importance = _importance(oof, fold_models, config) if config.compute_importance else None
    return ForecastResult(predictions, _oof_metrics(predictions), importance, models, spec, cutoff, decisions)


def with_predictions(result: ForecastResult, predictions: DataFrame) -> ForecastResult:
    """The same result over predictions that were written."""
    return replace(result, predictions=predictions, metrics=_oof_metrics(predictions))


def _oof_metrics(predictions: DataFrame) -> DataFrame:
    return all_metrics(predictions.filter(F.col("prediction_status") == N.P_OOF))


def _fold_fits(table, folds, spec, config, fit):
    """Row counts, the (fold, direction) pairs that take part, and the fits that they need."""
    active, jobs = [], {}
    if not folds:
        return {}, active, jobs
    counts = {(r.direction, r.fold): r for r in S.fold_counts(table, folds, config.calibration_days).collect()}
    for f in folds:
        for d in N.DIRECTIONS:
            c = counts.get((d, f.number))
            if c is None or c.history < config.min_train_rows or c.test == 0:
                continue
            active.append((f, d))
            part = S.calibration_part(f.start, config.calibration_days)
            rows = table.filter(_is(d) & S.trainable() & (part == "FIT"))
            train, usable = _capped_fit(rows, c.usable_fit, config)
            if usable >= config.min_train_rows:
                jobs[(f.number, d)] = lambda train=train: fit(train, spec, config)
    return counts, active, jobs


def _backtest(table, medians, active, counts, models, config):
    """Out-of-fold rows with their forecast and the decision taken per (fold, direction)."""
    if not active:
        return None, []
    # All uses of all rows in one scan of the feature table; a row names its fold's model by number.
    number = {key: k for k, key in enumerate(models)}
    pairs = [
        (f, d, number.get((f.number, d)), (f.number, d) in models and counts[(d, f.number)].calibration > 0) for f, d in active
    ]
    uses = S.scoring_roles(table, pairs, config.calibration_days)
    filled = fill_baseline(uses, medians, ["set_id"], SET_LEVELS, out="baseline_backtest")
    scored = predict_each(filled, list(models.values()), "model").drop("set_id", "model")
    scored = materialize(scored, "scored", ["role", "direction"])
    chosen = {}
    if any(calibrated for *_, calibrated in pairs):
        picked = select_alpha(
            scored.filter(F.col("role") == "CAL"),
            ["fold", "direction"],
            config.min_calibration_rows,
            config.min_improvement,
            config.grid_steps,
            baseline="baseline_backtest",
        )
        chosen = {(r.fold, r.direction): r for r in picked.collect()}

    decisions = []
    for f, d in active:
        key = (f.number, d)
        if key not in models:
            verdict = _decision(0.0, 0, 0.0, N.R_FEW_FIT)
        elif counts[(d, f.number)].calibration == 0:
            verdict = _decision(0.0, 0, 0.0, N.R_NO_CALIBRATION)
        elif key not in chosen:
            verdict = _decision(0.0, 0, 0.0, N.R_FEW_CALIBRATION)
        else:
            r = chosen[key]
            verdict = _decision(r.alpha, r.n, r.improvement, r.reason)
        decisions.append({"fold": f.number, "direction": d, **verdict})
    oof = scored.filter(F.col("role") == "TEST").drop("role")
    oof = oof.join(F.broadcast(_decision_frame(table, decisions)), ["fold", "direction"], "left")
    base, corr = F.col("baseline_backtest"), F.col("correction")
    oof = oof.withColumns(
        {
            "residual_actual": F.col("actual") - base,
            "raw_candidate": blend(base, corr, 1.0),
            "forecast": blend(base, corr, F.col("blend_alpha")),
            "strategy": F.when(F.col("blend_alpha") > 0, N.S_HYBRID).otherwise(N.S_BASELINE),
        }
    )
    return oof, decisions


def _decision_frame(table: DataFrame, decisions: list[dict[str, Any]]) -> DataFrame:
    """One row per (fold, direction): at most twice the configured number of folds."""
    rows = [F.struct(*[F.lit(d[c]).cast(t).alias(c) for c, t in map(str.split, _DECISION.split(", "))]) for d in decisions]
    return table.sparkSession.range(1, numPartitions=1).select(F.inline(F.array(*rows)))


def _final_fits(history, stats, spec, config, fit):
    """What is known of each direction's training rows, and the fits on all usable history."""
    facts, jobs = {}, {}
    for d in N.DIRECTIONS:
        s = stats.get(d)
        train, usable = history.filter(_is(d)), s.usable if s else 0
        train_start, train_end = (s.first_utc, s.last_utc) if s else (None, None)
        if s and config.max_train_rows is not None:
            train, usable = _capped_fit(train, usable, config)
            train_start, train_end = training_range(train).select("first_utc", "last_utc").first() or (None, None)
        enough = usable >= config.min_train_rows
        if enough:
            jobs[d] = lambda train=train: fit(train, spec, config)
        facts[d] = {
            "train_rows": int(usable) if enough else 0,
            "history_rows": int(s.history) if s else 0,
            "train_start_utc": str(train_start) if enough else None,
            "train_end_utc": str(train_end) if enough else None,
        }
    return facts, jobs


def _final_models(oof, facts, models, config) -> dict[str, DirectionArtifact]:
    """One model per direction on all usable history; alpha from the pooled out-of-fold rows."""
    pooled = {}
    if oof is not None:
        picked = select_alpha(
            oof,
            ["direction"],
            config.min_calibration_rows,
            config.min_improvement,
            config.grid_steps,
            baseline="baseline_backtest",
        )
        pooled = {r.direction: r for r in picked.collect()}
    artifacts = {}
    for d in N.DIRECTIONS:
        r = pooled.get(d)
        if r is not None:
            alpha, n, gain, reason = r.alpha, r.n, r.improvement, r.reason
        else:
            alpha, n, gain, reason = 0.0, 0, 0.0, N.R_NO_OOF
        if d not in models:
            alpha, gain, reason = 0.0, 0.0, N.R_FEW_FINAL
        artifacts[d] = DirectionArtifact(
            model=models.get(d),
            alpha=float(alpha),
            calibration_n=int(n),
            calibration_improvement=float(gain),
            calibration_reason=reason,
            **facts[d],
        )
    return artifacts


def training_range(history: DataFrame) -> DataFrame:
    """Per direction: history rows, usable rows and their first and last UTC hour."""
    natural = F.col("baseline").isNotNull()
    utc = F.when(natural, F.col("model_utc"))
    return history.groupBy("direction").agg(
        F.count(F.lit(1)).alias("history"),
        F.count_if(natural).alias("usable"),
        F.min(utc).cast("timestamp_ntz").alias("first_utc"),
        F.max(utc).cast("timestamp_ntz").alias("last_utc"),
    )


def _assemble(table, oof, medians, folds, decisions, models, cutoff, config) -> DataFrame:
    """Every input row exactly once, with out-of-fold values on test rows and final values on future rows."""
    rest = table
    if oof is not None:
        scored_fold = S.fold_number(folds)
        pairs = [(F.col("direction") == x["direction"]) & (scored_fold == x["fold"]) for x in decisions]
        tested = F.lit(False)
        for p in pairs:
            tested = tested | p
        rest = table.filter(~F.coalesce(S.trainable() & tested, F.lit(False)))
    rest = rest.withColumns({c: F.lit(None).cast(t) for c, t in _OOF_COLUMNS.items()})
    rows = rest if oof is None else oof.withColumn("fold", F.col("fold").cast("int")).unionByName(rest)
    before = S.prediction_status(cutoff)
    status = F.when(F.col("fold").isNotNull(), N.P_OOF).otherwise(before)
    rows = rows.withColumn("prediction_status", status)

    future = F.col("prediction_status") == N.P_AWAITING
    wanted = F.col("model_utc").isNotNull() & F.col("direction").isin(N.DIRECTIONS)
    if not config.score_full_history:
        wanted = wanted & future
    parts = []
    for d in N.DIRECTIONS:
        part = rows.filter(wanted & _is(d)).withColumn("set_id", F.lit("FINAL"))
        part = fill_baseline(part, medians, ["set_id"], SET_LEVELS, out="baseline_full").drop("set_id")
        a = models[d]
        part = _corrected(a.model, part, "full_correction").withColumns(
            {
                "f_alpha": F.lit(a.alpha),
                "f_n": F.lit(a.calibration_n).cast("long"),
                "f_gain": F.lit(a.calibration_improvement),
                "f_reason": F.lit(a.calibration_reason),
            }
        )
        parts.append(part)
    scored = _union(parts)
    base, corr = F.col("baseline_full"), F.col("full_correction")
    full = blend(base, corr, F.col("f_alpha"))

    def for_future(value: Column, other: str) -> Column:
        return F.when(future, value).otherwise(F.col(other))

    scored = scored.withColumn("full_model", full).withColumns(
        {
            "baseline_backtest": for_future(base, "baseline_backtest"),
            "correction": for_future(corr, "correction"),
            "raw_candidate": for_future(blend(base, corr, 1.0), "raw_candidate"),
            "forecast": for_future(F.col("full_model"), "forecast"),
            "blend_alpha": for_future(F.col("f_alpha"), "blend_alpha"),
            "strategy": for_future(
                F.when(F.col("f_alpha") > 0, N.S_HYBRID_FINAL).otherwise(N.S_BASELINE_FINAL), "strategy"
            ),
            "calibration_n": for_future(F.col("f_n"), "calibration_n"),
            "calibration_improvement": for_future(F.col("f_gain"), "calibration_improvement"),
            "calibration_reason": for_future(F.col("f_reason"), "calibration_reason"),
            "without_weather": future & ~F.coalesce(F.col("weather_matched"), F.lit(False)),
            "prediction_status": F.when(future, N.P_FUTURE).otherwise(F.col("prediction_status")),
        }
    )
    scored = scored.drop("f_alpha", "f_n", "f_gain", "f_reason", "baseline_full", "full_correction")
    others = rows.filter(~F.coalesce(wanted, F.lit(False))).withColumns(
        {"full_model": F.lit(None).cast("double"), "without_weather": F.lit(False)}
    )
    out = add_errors(scored.unionByName(others))
    moment = S.instant(cutoff) if cutoff is not None else F.lit(None).cast("timestamp")
    return out.withColumns(
        {
            "full_model_in_sample": F.col("actual").isNotNull() & F.col("full_model").isNotNull(),
            "forecast_cutoff_utc": moment,
        }
    )


def _importance(oof, fold_models, config) -> DataFrame | None:
    if not fold_models:
        return None

    def measured(fold: int, direction: str, model: Any) -> DataFrame:
        rows = oof.filter(_is(direction) & (F.col("fold") == fold))
        one = permutation_importance(model, rows, seed=config.seed)
        return one.withColumns({"direction": F.lit(direction), "fold": F.lit(fold)})

    jobs = {(f, d): partial(measured, f, d, model) for (f, d), model in fold_models.items()}
    return importance_summary(_union(list(_in_threads(oof.sparkSession, jobs, config.parallel_fits).values())))
