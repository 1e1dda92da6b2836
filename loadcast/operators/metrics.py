"""Forecast errors by scope, macro-client average, headline indicators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadcast import names as N

METRICS = ["n", "mae", "rmse", "bias", "wape", "smape"]
SCOPES = {"GLOBAL": None, "DIRECTION": "direction", "POINT": "point", "WEATHER": "weather_status"}
PREDICTORS = {N.M_HYBRID: "forecast", N.M_RAW: "raw_candidate", N.M_LAG: "baseline_backtest"}
_CELL = ["client", "direction", "point", "weather_status"]
_SUMS = ["n", "ae", "se", "e", "y", "s"]


def _error_sums(predictor: str, prefix: str) -> list[Column]:
    """Sums over rows where actual and prediction are both finite numbers (NaN sorts above infinity, so it fails too)."""
    y, p = "actual", predictor
    ok = f"abs({y}) < double('inf') and abs({p}) < double('inf')"
    terms = {
        "ae": f"abs({p} - {y})",
        "se": f"({p} - {y}) * ({p} - {y})",
        "e": f"{p} - {y}",
        "y": f"abs({y})",
        "s": f"if(abs({y}) + abs({p}) > 0, 2 * abs({p} - {y}) / (abs({y}) + abs({p})), 0D)",
    }
    sums = [F.expr(f"sum(if({ok}, {t}, null)) as {prefix}{name}") for name, t in terms.items()]
    return [F.expr(f"count_if({ok}) as {prefix}n"), *sums]


def error_cells(df: DataFrame, predictors: dict[str, str] = PREDICTORS) -> DataFrame:
    """Error sums per (client, direction, point, weather status) and predictor.

    All metrics are ratios of these sums, so this is the only pass over the rows; every report below works on cells.
    """
    for name in _CELL:
        if name not in df.columns:
            df = df.withColumn(name, F.lit(None).cast("string"))
    sums = [c for i, p in enumerate(predictors.values()) for c in _error_sums(p, f"_{i}_")]
    wide = df.groupBy(*_CELL).agg(*sums)
    per_model = F.array(
        *[
            F.struct(F.lit(model).alias("model"), *[F.col(f"_{i}_{s}").alias(s) for s in _SUMS])
            for i, model in enumerate(predictors)
        ]
    )
    return wide.select(*_CELL, F.inline(per_model))


def _totals() -> list[Column]:
    return [F.sum(s).alias(s) for s in _SUMS]


def _ratios() -> dict[str, Column]:
    n = F.nullif(F.col("n"), F.lit(0))
    return {
        "mae": F.col("ae") / n,
        "rmse": F.sqrt(F.col("se") / n),
        "bias": F.col("e") / n,
        "wape": F.when(F.col("y") > 0, F.col("ae") / F.col("y")),
        "smape": F.col("s") / n,
    }


def metrics_by_scope(cells: DataFrame, scopes: dict[str, str | None] = SCOPES) -> DataFrame:
    """model, scope, value, n, mae, rmse, bias, wape, smape for the whole and per direction, point, weather status."""
    labels = F.array(
        *[
            F.struct(
                F.lit(scope).alias("scope"),
                (F.lit("ALL") if column is None else F.coalesce(F.col(column), F.lit("<NA>"))).alias("value"),
            )
            for scope, column in scopes.items()
        ]
    )
    long = cells.select("model", *_SUMS, F.inline(labels))
    return long.groupBy("model", "scope", "value").agg(*_totals()).select(
        "model", "scope", "value", "n", *[c.alias(k) for k, c in _ratios().items()]
    )


def macro_client_metrics(cells: DataFrame) -> DataFrame:
    """Metrics per (client, direction), then their plain mean; groups without a usable pair do not count."""
    per_client = cells.groupBy("model", "client", "direction").agg(*_totals()).filter("n > 0")
    per_client = per_client.select("model", "n", *[c.alias(k) for k, c in _ratios().items()])
    return per_client.groupBy("model").agg(
        F.lit("MACRO_CLIENT").alias("scope"),
        F.lit("mean over clients").alias("value"),
        F.sum("n").alias("n"),
        *[F.avg(k).alias(k) for k in METRICS[1:]],
    )


def all_metrics(df: DataFrame, predictors: dict[str, str] = PREDICTORS) -> DataFrame:
    cells = error_cells(df, predictors)
    return metrics_by_scope(cells).unionByName(macro_client_metrics(cells))


def add_errors(df: DataFrame) -> DataFrame:
    error = F.col("forecast") - F.col("actual")
    return df.withColumns({"error": error, "abs_error": F.abs(error)})


def kpi_summary(predictions: DataFrame, metrics: DataFrame, trained: list[str]) -> DataFrame:
    """Fifteen headline indicators as section, indicator, value (text form), note-free."""
    status, weather = F.col("prediction_status"), F.col("weather_status")
    matched = F.coalesce(F.col("weather_matched"), F.lit(False))
    in_scope = weather.isin(N.W_MATCHED, N.W_MISSING)
    counts = predictions.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count("actual").alias("with_actual"),
        F.count_if(status == N.P_OOF).alias("oof"),
        F.count_if(status == N.P_FUTURE).alias("future"),
        F.count_if(F.coalesce(F.col("without_weather"), F.lit(False))).alias("future_dry"),
        F.count_if(weather == N.W_BEFORE).alias("before"),
        F.avg(F.when(in_scope, (weather == N.W_MATCHED).cast("double"))).alias("share_after"),
        F.coalesce(F.avg(matched.cast("double")), F.lit(0.0)).alias("share_all"),
        F.count_if(matched & (F.col("feature_count") < len(N.WEATHER_FEATURES))).alias("partial"),
    )
    headline = metrics.filter("scope = 'GLOBAL' and value = 'ALL'").agg(
        *[
            F.max(F.when(F.col("model") == model, F.col(metric))).alias(f"{metric}_{name}")
            for model, name in ((N.M_HYBRID, "hybrid"), (N.M_LAG, "lag"))
            for metric in ("mae", "wape")
        ]
    )
    # Two one-row frames become one row: stacked, then the only non-NULL value per column.
    both = counts.unionByName(headline, allowMissingColumns=True)
    row = both.agg(*[F.max(c).alias(c) for c in both.columns]).withColumn(
        "gain", F.when(F.col("mae_lag") != 0, (F.col("mae_lag") - F.col("mae_hybrid")) / F.col("mae_lag"))
    )
    items = [
        ("data", "all_rows", F.col("rows")),
        ("data", "rows_with_actual", F.col("with_actual")),
        ("evaluation", "oof_rows", F.col("oof")),
        ("forecast", "future_rows", F.col("future")),
        ("forecast", "future_without_weather", F.col("future_dry")),
        ("quality", "rows_before_weather_start", F.col("before")),
        ("quality", "match_share_after_start", F.col("share_after")),
        ("quality", "match_share_all_rows", F.col("share_all")),
        ("quality", "matched_with_null_features", F.col("partial")),
        ("hybrid", "trained_directions", F.lit(", ".join(sorted(trained)) or "none")),
        ("hybrid", "mae_hybrid", F.col("mae_hybrid")),
        ("baseline", "mae_lag_mean", F.col("mae_lag")),
        ("hybrid", "mae_improvement", F.col("gain")),
        ("hybrid", "wape_hybrid", F.col("wape_hybrid")),
        ("baseline", "wape_lag_mean", F.col("wape_lag")),
    ]
    cells = [x for section, name, c in items for x in (F.lit(section), F.lit(name), c.cast("string"))]
    return row.select(F.stack(F.lit(len(items)), *cells).alias("section", "indicator", "value"))
