"""Medians, folds, calibration, blending, metrics, backtest and scoring."""

from __future__ import annotations

import datetime as dt
from dataclasses import replace

from pyspark.sql import functions as F

from catalog import views as V
from catalog.feature_queries import HIST_SQL, STATS_SQL, lagged
from catalog.registry import query, r6
from catalog.weather_queries import ENRICHED_SQL, enriched
from loadcast import names as N
from loadcast.config import ForecastConfig
from loadcast.functions.rowwise import blend
from loadcast.operators import blend as B
from loadcast.operators import metrics as M
from loadcast.operators import splits as S
from loadcast.operators.baseline import fallback_medians, fill_baseline
from loadcast.operators.residual import importance_summary, usable_rows
from loadcast.plans.forecast import run_forecast, training_range
from loadcast.plans.package import build_package, history_tail, score_package
from loadcast.session import materialize
from loadcast.sources.limits import newest_rows


def _with_hour(spark, sf):
    return V.energy(spark, sf).withColumn("hour", F.hour("valid_local"))


_MEDIAN_SQL = f"""
  WITH e AS (SELECT *, CAST(hour(valid_local) AS INTEGER) AS "hour" FROM ({V.ENERGY_SQL}))
  SELECT 0 AS level, client, direction, "hour", CAST(NULL AS VARCHAR) AS branch_code, count(*) AS n, round(median(actual) + 3.3e-8, 6) AS median
    FROM e GROUP BY client, direction, "hour"
  UNION ALL SELECT 1, NULL, direction, "hour", branch_code, count(*), round(median(actual) + 3.3e-8, 6) FROM e GROUP BY branch_code, direction, "hour"
  UNION ALL SELECT 2, NULL, direction, "hour", NULL, count(*), round(median(actual) + 3.3e-8, 6) FROM e GROUP BY direction, "hour"
  UNION ALL SELECT 3, NULL, direction, NULL, NULL, count(*), round(median(actual) + 3.3e-8, 6) FROM e GROUP BY direction
  UNION ALL SELECT 4, NULL, NULL, NULL, NULL, count(*), round(median(actual) + 3.3e-8, 6) FROM e"""


@query("fallback_medians", _MEDIAN_SQL)
def medians(spark, sf):
    return fallback_medians(_with_hour(spark, sf)).withColumn("median", r6("median"))


def _hot(df):
    """A third of all rows in one client, branch and hour."""
    hot = F.col("source_row") % 3 == 0
    pick = lambda c, v: F.when(hot, F.lit(v)).otherwise(F.col(c))
    return df.withColumns({"client": pick("client", "HOT"), "branch_code": pick("branch_code", "HOT"), "hour": pick("hour", 12)})


_HOT_MEDIAN_SQL = _MEDIAN_SQL.replace(
    'SELECT *, CAST(hour(valid_local) AS INTEGER) AS "hour" FROM',
    """SELECT * REPLACE (CASE WHEN source_row % 3 = 0 THEN 'HOT' ELSE client END AS client,
                          CASE WHEN source_row % 3 = 0 THEN 'HOT' ELSE branch_code END AS branch_code),
              CASE WHEN source_row % 3 = 0 THEN 12 ELSE CAST(hour(valid_local) AS INTEGER) END AS "hour" FROM""",
)


@query("fallback_medians_hot_groups", _HOT_MEDIAN_SQL)
def medians_hot(spark, sf):
    """The same medians where a third of all rows falls into one group of each level."""
    return fallback_medians(_hot(_with_hour(spark, sf))).withColumn("median", r6("median"))


_TRAIN = "valid_local < TIMESTAMP '2024-01-21'"


@query(
    "baseline_fallback",
    f"""WITH {HIST_SQL}, s AS (SELECT *, CAST(hour(valid_local) AS INTEGER) AS h FROM ({STATS_SQL})),
          tr AS (SELECT * FROM s WHERE {_TRAIN}),
          m0 AS (SELECT client, direction, h, median(actual) AS m FROM tr GROUP BY ALL),
          m1 AS (SELECT branch_code, direction, h, median(actual) AS m FROM tr GROUP BY ALL),
          m2 AS (SELECT direction, h, median(actual) AS m FROM tr GROUP BY ALL),
          m3 AS (SELECT direction, median(actual) AS m FROM tr GROUP BY ALL),
          m4 AS (SELECT median(actual) AS m FROM tr)
        SELECT source_row, round(greatest(coalesce(baseline, m0.m, m1.m, m2.m, m3.m, m4.m, 0), 0) + 3.3e-8, 6) AS baseline_filled
        FROM s LEFT JOIN m0 USING (client, direction, h) LEFT JOIN m1 USING (branch_code, direction, h)
          LEFT JOIN m2 USING (direction, h) LEFT JOIN m3 USING (direction), m4""",
)
def baseline_fallback(spark, sf):
    rows = lagged(spark, sf).withColumn("hour", F.hour("valid_local"))
    train = _with_hour(spark, sf).filter(F.col("valid_local") < F.lit("2024-01-21").cast("timestamp_ntz"))
    return fill_baseline(rows, fallback_medians(train)).select("source_row", r6("baseline_filled").alias("baseline_filled"))


def _timed(spark, sf):
    return V.energy(spark, sf).withColumn("model_utc", F.col("valid_local").cast("timestamp"))


@query(
    "expanding_splits",
    """WITH c AS (SELECT date_trunc('day', max(date_trunc('hour', ts))) + INTERVAL 1 DAY AS e FROM events)
       SELECT CAST(k AS INTEGER) AS fold, CAST(e - to_days(CAST((3 - k) * 5 AS INTEGER)) AS TIMESTAMP) AS end_utc,
              CAST(e - to_days(CAST((4 - k) * 5 AS INTEGER)) AS TIMESTAMP) AS start_utc
       FROM c, range(1, 4) r(k)""",
)
def expanding_splits(spark, sf):
    folds = S.expanding_splits(S.forecast_cutoff(_timed(spark, sf)), 3, 5)
    rows = [(f.number, f.start, f.end) for f in folds]
    return spark.createDataFrame(rows, "fold int, start_utc timestamp_ntz, end_utc timestamp_ntz")


_FOLD_SQL = """
  folds AS (SELECT k AS fold, e - to_days(CAST((3 - k) * 5 AS INTEGER)) AS hi, e - to_days(CAST((4 - k) * 5 AS INTEGER)) AS lo
    FROM (SELECT date_trunc('day', max(date_trunc('hour', ts))) + INTERVAL 1 DAY AS e FROM events), range(1, 4) r(k))"""


@query(
    "fold_assignment",
    f"""WITH {_FOLD_SQL} SELECT source_row, CAST(fold AS INTEGER) AS fold FROM ({V.ENERGY_SQL}) e
        LEFT JOIN folds f ON e.valid_local >= f.lo AND e.valid_local < f.hi""",
)
def fold_assignment(spark, sf):
    df = _timed(spark, sf)
    folds = S.expanding_splits(S.forecast_cutoff(df), 3, 5)
    return df.select("source_row", S.fold_number(folds).alias("fold"))


@query(
    "fold_counts",
    f"""WITH {_FOLD_SQL}, {HIST_SQL}, s AS (SELECT * FROM ({STATS_SQL}) WHERE actual >= 0)
        SELECT direction, CAST(fold AS INTEGER) AS fold, count(*) FILTER (valid_local < lo) AS history,
          count(*) FILTER (valid_local < lo - INTERVAL 3 DAY) AS fit,
          count(*) FILTER (valid_local < lo - INTERVAL 3 DAY AND baseline IS NOT NULL) AS usable_fit,
          count(*) FILTER (valid_local >= lo - INTERVAL 3 DAY AND valid_local < lo) AS calibration,
          count(*) FILTER (valid_local >= lo AND valid_local < hi) AS test
        FROM s, folds GROUP BY direction, fold""",
)
def fold_counts(spark, sf):
    df = lagged(spark, sf).withColumn("model_utc", F.col("valid_local").cast("timestamp"))
    folds = S.expanding_splits(S.forecast_cutoff(_timed(spark, sf)), 3, 5)
    return S.fold_counts(df, folds, 3)


@query(
    "calibration_split",
    f"""SELECT source_row, CASE WHEN valid_local < TIMESTAMP '2024-01-16' THEN 'FIT'
          WHEN valid_local < TIMESTAMP '2024-01-21' THEN 'CALIBRATION' END AS part FROM ({V.ENERGY_SQL})""",
)
def calibration_split(spark, sf):
    return _timed(spark, sf).select("source_row", S.calibration_part(dt.datetime(2024, 1, 21), 5).alias("part"))


_CORRECTION_SQL = "(source_row % 21 - 10) * actual / 40 + (actual - baseline) * 0.3"
_GRID_SQL = f"""
  WITH {HIST_SQL}, s AS (SELECT *, {_CORRECTION_SQL} AS correction FROM ({STATS_SQL}) WHERE baseline IS NOT NULL),
  grid AS (SELECT direction, i / CAST(20 AS DOUBLE) AS alpha, count(*) AS n, avg(abs(greatest(baseline, 0) - actual)) AS baseline_mae,
             avg(abs(greatest(baseline + i / CAST(20 AS DOUBLE) * correction, 0) - actual)) AS mae
           FROM s, range(21) r(i) GROUP BY direction, i)"""


def _with_correction(spark, sf):
    row = F.col("source_row")
    correction = (row % 21 - 10) * F.col("actual") / 40 + (F.col("actual") - F.col("baseline")) * 0.3
    return lagged(spark, sf).withColumn("correction", correction)


@query(
    "alpha_grid",
    f"{_GRID_SQL} SELECT direction, n, round(baseline_mae + 3.3e-8, 6) AS baseline_mae, round(alpha + 3.3e-8, 6) AS alpha, round(mae + 3.3e-8, 6) AS mae FROM grid",
)
def alpha_grid(spark, sf):
    out = B.alpha_grid(_with_correction(spark, sf), ["direction"])
    return out.select("direction", "n", *[r6(c).alias(c) for c in ("baseline_mae", "alpha", "mae")])


@query(
    "alpha_select",
    f"""{_GRID_SQL}, best AS (SELECT direction, n, baseline_mae, mae, alpha,
            row_number() OVER (PARTITION BY direction ORDER BY mae, alpha) AS rn FROM grid),
          d AS (SELECT *, (baseline_mae - mae) / baseline_mae AS gain, CASE WHEN n < 200 THEN 'TOO_FEW_CALIBRATION'
                  WHEN baseline_mae <= 0 THEN 'BASELINE_PERFECT_OR_INVALID'
                  WHEN alpha <= 0 OR (baseline_mae - mae) / baseline_mae < 0.02 THEN 'NO_CONFIRMED_GAIN'
                  ELSE 'HYBRID_CHOSEN' END AS reason FROM best WHERE rn = 1)
        SELECT direction, n, reason, CASE WHEN reason = 'HYBRID_CHOSEN' THEN alpha ELSE 0 END AS alpha,
          round(CASE WHEN reason <> 'TOO_FEW_CALIBRATION' THEN baseline_mae END + 3.3e-8, 6) AS baseline_mae,
          round(CASE WHEN reason = 'HYBRID_CHOSEN' THEN mae WHEN reason <> 'TOO_FEW_CALIBRATION' THEN baseline_mae END + 3.3e-8, 6) AS hybrid_mae,
          round(CASE WHEN reason IN ('TOO_FEW_CALIBRATION', 'BASELINE_PERFECT_OR_INVALID') THEN 0
                ELSE greatest(gain, 0) END + 3.3e-8, 6) AS improvement FROM d""",
)
def alpha_select(spark, sf):
    out = B.select_alpha(_with_correction(spark, sf), ["direction"])
    return out.select(
        "direction", "n", "reason", "alpha", *[r6(c).alias(c) for c in ("baseline_mae", "hybrid_mae", "improvement")]
    )


@query(
    "blend_forecast",
    f"""WITH {HIST_SQL}, s AS (SELECT *, {_CORRECTION_SQL} AS correction FROM ({STATS_SQL})),
          p AS (SELECT *, CASE WHEN baseline + 0.5 * correction < 0 THEN 0 ELSE baseline + 0.5 * correction END AS f FROM s)
        SELECT source_row, round(f + 3.3e-8, 6) AS forecast, round(f - actual + 3.3e-8, 6) AS error, round(abs(f - actual) + 3.3e-8, 6) AS abs_error FROM p""",
)
def blend_forecast(spark, sf):
    df = _with_correction(spark, sf)
    out = M.add_errors(df.withColumn("forecast", blend(F.col("baseline"), F.col("correction"), 0.5)))
    return out.select("source_row", *[r6(c).alias(c) for c in ("forecast", "error", "abs_error")])


_PREDICTED_SQL = f"""
  WITH {HIST_SQL}, s AS (SELECT *, {_CORRECTION_SQL} AS correction FROM ({STATS_SQL})),
  st AS (SELECT source_row, weather_status FROM ({ENRICHED_SQL})),
  p AS (SELECT s.*, st.weather_status, CASE WHEN baseline + 0.5 * correction < 0 THEN 0 ELSE baseline + 0.5 * correction END AS f_hybrid,
          CASE WHEN baseline + correction < 0 THEN 0 ELSE baseline + correction END AS f_raw FROM s JOIN st USING (source_row)),
  u AS (SELECT 'HYBRID' AS model, f_hybrid AS f, p.* FROM p UNION ALL SELECT 'RAW_CORRECTION', f_raw, p.* FROM p
        UNION ALL SELECT 'LAG_MEAN', baseline, p.* FROM p),
  e AS (SELECT *, f - actual AS err FROM u WHERE f IS NOT NULL AND actual IS NOT NULL)"""
_METRIC_SQL = """count(*) AS n, avg(abs(err)) AS mae, sqrt(avg(err * err)) AS rmse, avg(err) AS bias,
  CASE WHEN sum(abs(actual)) > 0 THEN sum(abs(err)) / sum(abs(actual)) END AS wape,
  avg(CASE WHEN abs(f) + abs(actual) > 0 THEN 2 * abs(err) / (abs(f) + abs(actual)) ELSE 0 END) AS smape"""
_ROUNDED = ", ".join(f"round({m} + 3.3e-8, 6) AS {m}" for m in M.METRICS[1:])


def _predicted(spark, sf):
    df = _with_correction(spark, sf).join(
        enriched(spark, sf).select("source_row", "weather_status"), "source_row"
    )
    base, corr = F.col("baseline"), F.col("correction")
    return df.withColumns(
        {"forecast": blend(base, corr, 0.5), "raw_candidate": blend(base, corr, 1.0), "baseline_backtest": base}
    )


def _rounded(df):
    return df.select("model", "scope", "value", "n", *[r6(m).alias(m) for m in M.METRICS[1:]])


@query(
    "metrics_by_scope",
    f"""{_PREDICTED_SQL}, g AS (
          SELECT model, CASE grouping(direction, point, weather_status) WHEN 7 THEN 'GLOBAL' WHEN 3 THEN 'DIRECTION'
                   WHEN 5 THEN 'POINT' ELSE 'WEATHER' END AS scope,
                 coalesce(direction, point, weather_status, 'ALL') AS value, {_METRIC_SQL}
          FROM e GROUP BY GROUPING SETS ((model), (model, direction), (model, point), (model, weather_status)))
        SELECT model, scope, value, n, {_ROUNDED} FROM g""",
)
def metrics_by_scope(spark, sf):
    return _rounded(M.metrics_by_scope(M.error_cells(_predicted(spark, sf))))


@query(
    "metrics_macro",
    f"""{_PREDICTED_SQL}, c AS (SELECT model, client, direction, {_METRIC_SQL} FROM e GROUP BY ALL)
        SELECT model, 'MACRO_CLIENT' AS scope, 'mean over clients' AS value, CAST(sum(n) AS BIGINT) AS n,
          {', '.join(f'round(avg({m}) + 3.3e-8, 6) AS {m}' for m in M.METRICS[1:])} FROM c GROUP BY model""",
)
def metrics_macro(spark, sf):
    return _rounded(M.macro_client_metrics(M.error_cells(_predicted(spark, sf))))


def _gappy(df):
    """Actuals missing on every tenth row and on the last two days; some rows without direction or time."""
    row = F.col("source_row")
    late = F.col("valid_local") >= F.lit("2024-01-29").cast("timestamp_ntz")
    return df.withColumns(
        {
            "actual": F.when(~late & (row % 10 != 3), F.col("actual")),
            "direction": F.when(row % 31 != 0, F.col("direction")),
            "model_utc": F.when(row % 29 != 0, F.col("valid_local")).cast("timestamp"),
        }
    )


_GAPPY_SQL = f"""
  SELECT * EXCLUDE (actual, direction), CASE WHEN valid_local < TIMESTAMP '2024-01-29' AND source_row % 10 <> 3 THEN actual END AS actual,
    CASE WHEN source_row % 31 <> 0 THEN direction END AS direction, CASE WHEN source_row % 29 <> 0 THEN valid_local END AS model_utc
  FROM ({V.ENERGY_SQL})"""


@query(
    "prediction_status",
    f"""WITH g AS ({_GAPPY_SQL}), c AS (SELECT max(model_utc) FILTER (actual IS NOT NULL) AS cutoff FROM g)
        SELECT source_row, CASE WHEN direction IS NULL THEN 'NO_DIRECTION' WHEN model_utc IS NULL THEN 'NO_UTC'
          WHEN actual IS NULL AND model_utc > cutoff THEN 'AWAITING_FINAL' WHEN actual IS NULL THEN 'HISTORICAL_GAP'
          ELSE 'WARMUP' END AS prediction_status FROM g, c""",
)
def prediction_status(spark, sf):
    df = _gappy(V.energy(spark, sf))
    return df.select("source_row", S.prediction_status(S.forecast_cutoff(df)).alias("prediction_status"))


@query(
    "training_range",
    f"""WITH {HIST_SQL}, s AS (SELECT * FROM ({STATS_SQL}) WHERE actual >= 0)
        SELECT direction, count(*) AS history, count(baseline) AS usable,
          min(valid_local) FILTER (baseline IS NOT NULL) AS first_utc, max(valid_local) FILTER (baseline IS NOT NULL) AS last_utc
        FROM s GROUP BY direction""",
)
def training_range_query(spark, sf):
    df = lagged(spark, sf).withColumn("model_utc", F.col("valid_local").cast("timestamp"))
    return training_range(df.filter(S.trainable()))


@query(
    "train_cap",
    f"""SELECT source_row, valid_local, actual FROM ({V.ENERGY_SQL})
        ORDER BY valid_local DESC, source_sheet DESC, source_row DESC LIMIT 700""",
)
def train_cap(spark, sf):
    out = newest_rows(_timed(spark, sf), 700, ["source_sheet", "source_row"])
    return out.select("source_row", "valid_local", "actual")


@query(
    "train_cap_wide",
    """SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem
       ORDER BY l_shipdate DESC, l_orderkey DESC, l_linenumber DESC, l_partkey DESC, l_suppkey DESC, l_extendedprice DESC LIMIT 25000""",
)
def train_cap_wide(spark, sf):
    """A limit above the sorted-limit bound: counts per time, then only the straddling time is refined."""
    rows = spark.read.parquet(f"{sf}/lineitem.parquet").withColumn("model_utc", F.col("l_shipdate").cast("timestamp"))
    ties = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]
    return newest_rows(rows, 25_000, ties).select("l_orderkey", "l_linenumber", "l_partkey")


@query(
    "history_tail",
    f"""WITH g AS ({_GAPPY_SQL}), c AS (SELECT max(model_utc) FILTER (actual IS NOT NULL) AS cutoff FROM g)
        SELECT client, trade_date, trade_hour, actual, valid_local FROM g, c
        WHERE actual IS NOT NULL AND model_utc >= cutoff - INTERVAL 21 DAY""",
)
def history_tail_query(spark, sf):
    df = _gappy(V.energy(spark, sf))
    tail = history_tail(df, S.forecast_cutoff(df), tuple(range(3, 15)))
    return tail.select("client", "trade_date", "trade_hour", "actual", "valid_local")


@query(
    "kpi_counts",
    f"""WITH j AS ({ENRICHED_SQL}), k AS (SELECT *, CASE WHEN source_row % 4 = 0 THEN 'OOF' WHEN source_row % 4 = 1 THEN 'FUTURE'
                 ELSE 'WARMUP' END AS st FROM j)
        SELECT count(*) AS all_rows, count(actual) AS rows_with_actual, count(*) FILTER (st = 'OOF') AS oof_rows,
          count(*) FILTER (st = 'FUTURE') AS future_rows,
          count(*) FILTER (st = 'FUTURE' AND NOT weather_matched) AS future_without_weather,
          count(*) FILTER (weather_status = 'BEFORE_START') AS rows_before_weather_start,
          count(*) FILTER (weather_matched AND feature_count < 10) AS matched_with_null_features,
          round(avg(CASE WHEN weather_status IN ('MATCHED', 'MISSING_IN_RANGE') THEN CAST(weather_status = 'MATCHED' AS DOUBLE) END) + 3.3e-8, 6)
            AS match_share_after_start,
          round(avg(CAST(weather_matched AS DOUBLE)) + 3.3e-8, 6) AS match_share_all_rows FROM k""",
)
def kpi_counts(spark, sf):
    row = F.col("source_row")
    df = enriched(spark, sf).withColumn(
        "prediction_status", F.when(row % 4 == 0, N.P_OOF).when(row % 4 == 1, N.P_FUTURE).otherwise(N.P_WARMUP)
    )
    df = df.withColumn("without_weather", (row % 4 == 1) & ~F.col("weather_matched"))
    none = M.all_metrics(_predicted(spark, sf))
    long = M.kpi_summary(df, none, N.DIRECTIONS)
    counts = [
        "all_rows", "rows_with_actual", "oof_rows", "future_rows", "future_without_weather", "rows_before_weather_start",
        "matched_with_null_features",
    ]
    shares = ["match_share_after_start", "match_share_all_rows"]
    value = F.col("value").try_cast("double")
    pick = {c: F.max(F.when(F.col("indicator") == c, value)) for c in [*counts, *shares]}
    return long.agg(*[pick[c].cast("long").alias(c) for c in counts], *[r6(pick[c]).alias(c) for c in shares])


@query(
    "importance_summary",
    """SELECT direction, feature, round(avg(importance) + 3.3e-8, 6) AS importance, round(stddev_samp(importance) + 3.3e-8, 6) AS spread_over_folds,
         count(DISTINCT fold) AS n_folds
       FROM (SELECT event_type AS direction, 'f' || (user_id % 5) AS feature, value AS importance, event_id % 3 AS fold FROM events)
       GROUP BY 1, 2""",
)
def importance_summary_query(spark, sf):
    df = spark.read.parquet(f"{sf}/events.parquet").select(
        F.col("event_type").alias("direction"),
        F.concat(F.lit("f"), (F.col("user_id") % 5).cast("string")).alias("feature"),
        F.col("value").alias("importance"),
        (F.col("event_id") % 3).alias("fold"),
    )
    out = importance_summary(df)
    return out.withColumns({"importance": r6("importance"), "spread_over_folds": r6("spread_over_folds")})


@query(
    "lag_baseline_report",
    f"""WITH {HIST_SQL}, s AS (SELECT *, baseline AS f FROM ({STATS_SQL})), w AS (SELECT point, w_valid_local FROM ({V.LATEST_SQL})),
          j AS (SELECT s.*, f - actual AS err, CASE WHEN w.point IS NOT NULL THEN 'MATCHED' ELSE 'MISSING_IN_RANGE' END AS weather_status
                FROM s LEFT JOIN w ON s.point = w.point AND s.valid_local = w.w_valid_local),
          e AS (SELECT * FROM j WHERE f IS NOT NULL),
          g AS (SELECT 'LAG_MEAN' AS model, CASE grouping(direction, point, weather_status) WHEN 7 THEN 'GLOBAL' WHEN 3 THEN 'DIRECTION'
                   WHEN 5 THEN 'POINT' ELSE 'WEATHER' END AS scope,
                 coalesce(direction, point, weather_status, 'ALL') AS value, {_METRIC_SQL}
                FROM e GROUP BY GROUPING SETS ((), (direction), (point), (weather_status)))
        SELECT model, scope, value, n, {_ROUNDED} FROM g""",
)
def lag_baseline_report(spark, sf):
    """How good is the mean of D-3..D-14, by direction, point and weather match, with forecasts known 24 h ahead?"""
    from loadcast.operators import enrich as J
    from loadcast.operators.lags import add_lag_statistics, add_lags
    from loadcast.operators.vintage import normalize_weather

    energy = V.energy(spark, sf)
    joined = J.enrich(energy, normalize_weather(V.forecasts(spark, sf)), J.VALID_TIME, weather_start=None)
    lagged_rows = add_lag_statistics(add_lags(joined, history=energy))
    return _rounded(M.metrics_by_scope(M.error_cells(lagged_rows, {N.M_LAG: "baseline"})))


def _small_config() -> ForecastConfig:
    """Windows that fit the month of `events`; few shallow trees keep a fit short. All rows are used at every size."""
    return ForecastConfig(
        validation_days=5,
        n_splits=2,
        calibration_days=4,
        min_train_rows=20,
        min_calibration_rows=10,
        min_improvement=0.0,
        max_iter=3,
        step_size=0.3,
        backend="depth_limited",
        tree_depth=3,
        parallel_fits=4,
        weather_start=None,
    )


def _future(df):
    late = F.col("valid_local") >= F.lit("2024-01-29").cast("timestamp_ntz")
    return df.withColumn("actual", F.when(~late, F.col("actual")))


def _run(spark, sf, importance=False, n_splits=2):
    joined = materialize(_future(enriched(spark, sf)), "joined")
    config = replace(_small_config(), compute_importance=importance, n_splits=n_splits)
    return run_forecast(joined, config), joined, config


@query("residual_forecast")
def residual_forecast(spark, sf):
    """Backtest, final models and future forecast for every row."""
    result, _, _ = _run(spark, sf)
    return result.predictions.select(
        "source_row", "direction", "prediction_status", "fold", "strategy", "blend_alpha", "baseline_backtest",
        "correction", "forecast", "full_model",
    )


@query("permutation_importance")
def permutation_importance_query(spark, sf):
    result, _, _ = _run(spark, sf, importance=True)
    return result.importance


@query("package_score")
def package_score(spark, sf):
    """Freeze a package and score the hours after its cutoff from it."""
    result, joined, config = _run(spark, sf, n_splits=1)
    mapping = V.energy(spark, sf).select("branch_code", "point").distinct()
    package = build_package(result, config, mapping)
    scored = score_package(package, joined)
    return scored.select("source_row", "direction", "prediction_status", "blend_alpha", "baseline_backtest", "forecast")


class HourShift:
    """A correction that SQL can learn as well: the mean residual of every hour of the day."""

    def __init__(self, train):
        rows = usable_rows(train).groupBy("hour").agg(F.avg("residual_target").alias("_shift"))
        self.shifts = materialize(rows, "shifts")

    def predict(self, df, out="correction"):
        found = df.join(self.shifts, "hour", "left")
        return found.withColumn(out, F.coalesce(F.col("_shift"), F.lit(0.0))).drop("_shift")


_LATE_SQL = f"""SELECT * REPLACE (CASE WHEN source_row % 19 <> 0 AND valid_local < TIMESTAMP '2024-01-29' THEN actual END AS actual)
  FROM ({V.ENERGY_SQL})"""


def _medians_by_set(number: int, keys: str) -> str:
    return f"m{number} AS (SELECT set_id, {keys}, median(actual) AS v{number} FROM tr GROUP BY ALL)"


def _decided(name: str, rows: str, keys: str) -> str:
    """SQL of the weight per key: least error on the grid, none without a gain."""
    return f"""
  {name}_grid AS (SELECT {keys}, i / CAST(20 AS DOUBLE) AS alpha, count(*) AS n, avg(abs(base - actual)) AS base_mae,
      avg(abs(greatest(base + i / CAST(20 AS DOUBLE) * corr, 0) - actual)) AS mae FROM {rows}, range(21) r(i) GROUP BY {keys}, i),
  {name}_best AS (SELECT *, (base_mae - mae) / base_mae AS gain,
      CASE WHEN n < 10 THEN 'TOO_FEW_CALIBRATION' WHEN base_mae <= 0 THEN 'BASELINE_PERFECT_OR_INVALID'
           WHEN alpha <= 0 OR (base_mae - mae) / base_mae < 0 THEN 'NO_CONFIRMED_GAIN' ELSE 'HYBRID_CHOSEN' END AS reason
    FROM (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY mae, alpha) AS rn FROM {name}_grid) WHERE rn = 1),
  {name} AS (SELECT {keys}, n, reason, CASE WHEN reason = 'HYBRID_CHOSEN' THEN alpha ELSE 0 END AS alpha,
      CASE WHEN reason IN ('TOO_FEW_CALIBRATION', 'BASELINE_PERFECT_OR_INVALID') THEN 0 ELSE greatest(gain, 0) END AS gain
    FROM {name}_best)"""


#: Two folds of five days, four days of calibration, as in `_small_config`; every step of the backtest as a plain table.
_BACKTEST_SQL = f"""
  WITH {HIST_SQL.replace(V.ENERGY_SQL, _LATE_SQL)},
  s AS (SELECT *, CASE WHEN source_row % 19 <> 0 THEN valid_local - INTERVAL 1 HOUR END AS utc,
          CASE WHEN source_row % 19 <> 0 THEN hour(valid_local) END AS h FROM ({STATS_SQL.replace(V.ENERGY_SQL, _LATE_SQL)})),
  t AS (SELECT * FROM s WHERE actual >= 0),
  c AS (SELECT max(utc) AS cutoff FROM s WHERE actual IS NOT NULL),
  folds AS (SELECT k AS fold, e - to_days(CAST((3 - k) * 5 AS INTEGER)) AS lo, e - to_days(CAST((2 - k) * 5 AS INTEGER)) AS hi
    FROM (SELECT date_trunc('day', cutoff) + INTERVAL 1 DAY AS e FROM c), range(1, 3) r(k)),
  bounds AS (SELECT 'TEST_' || fold AS set_id, lo AS bound FROM folds UNION ALL SELECT 'CAL_' || fold, lo - INTERVAL 4 DAY FROM folds
    UNION ALL SELECT 'FINAL', TIMESTAMP '9999-01-01'),
  tr AS (SELECT t.*, set_id FROM t JOIN bounds ON utc < bound),
  {_medians_by_set(0, "client, direction, h")}, {_medians_by_set(1, "branch_code, direction, h")},
  {_medians_by_set(2, "direction, h")}, {_medians_by_set(3, "direction")},
  shift AS (SELECT fold, direction, h, avg(actual - baseline) AS d FROM t JOIN folds ON utc < lo - INTERVAL 4 DAY
    WHERE baseline IS NOT NULL GROUP BY ALL
    UNION ALL SELECT 0, direction, h, avg(actual - baseline) FROM t WHERE baseline IS NOT NULL AND utc IS NOT NULL GROUP BY ALL),
  uses AS (SELECT s.*, 'TEST' AS role, fold, 'TEST_' || fold AS set_id FROM s JOIN folds ON utc >= lo AND utc < hi AND actual >= 0
    UNION ALL SELECT s.*, 'CAL', fold, 'CAL_' || fold FROM s JOIN folds ON utc >= lo - INTERVAL 4 DAY AND utc < lo AND actual >= 0
    UNION ALL SELECT s.*, 'FUTURE', 0, 'FINAL' FROM s, c WHERE actual IS NULL AND utc > cutoff),
  filled AS (SELECT u.*, greatest(coalesce(baseline, v0, v1, v2, v3, 0), 0) AS base, coalesce(d, 0) AS corr FROM uses u
    LEFT JOIN m0 USING (set_id, client, direction, h) LEFT JOIN m1 USING (set_id, branch_code, direction, h)
    LEFT JOIN m2 USING (set_id, direction, h) LEFT JOIN m3 USING (set_id, direction) LEFT JOIN shift USING (fold, direction, h)),
  cal AS (SELECT * FROM filled WHERE role = 'CAL'), oof AS (SELECT * FROM filled WHERE role = 'TEST'),
  {_decided("decision", "cal", "fold, direction")}, {_decided("final", "oof", "direction")}"""


def _plain_backtest(spark, sf):
    joined = materialize(_future(enriched(spark, sf)), "joined")
    config = replace(_small_config(), compute_importance=False)
    return run_forecast(joined, config, fit=lambda train, spec, config: HourShift(train))


@query(
    "backtest_decisions",
    f"""{_BACKTEST_SQL} SELECT CAST(fold AS INTEGER) AS fold, direction, alpha AS blend_alpha, n AS calibration_n,
          round(gain + 3.3e-8, 6) AS calibration_improvement, reason AS calibration_reason FROM decision
        UNION ALL SELECT 0, direction, alpha, n, round(gain + 3.3e-8, 6), reason FROM final""",
)
def backtest_decisions(spark, sf):
    """What every fold decides from its calibration window, and (fold 0) the final weights from all out-of-fold rows."""
    result = _plain_backtest(spark, sf)
    rows = [(x["fold"], x["direction"], x["blend_alpha"], x["calibration_n"], x["calibration_improvement"], x["calibration_reason"]) for x in result.decisions]
    rows += [(0, d, a.alpha, a.calibration_n, a.calibration_improvement, a.calibration_reason) for d, a in result.models.items()]
    out = spark.createDataFrame(
        rows, "fold int, direction string, blend_alpha double, calibration_n long, calibration_improvement double, calibration_reason string"
    )
    return out.withColumn("calibration_improvement", r6("calibration_improvement"))


@query(
    "backtest_rows",
    f"""{_BACKTEST_SQL}, scored AS (
          SELECT o.source_row, 'OOF' AS st, CAST(o.fold AS INTEGER) AS fold, base, corr, alpha, n, reason, actual,
            CASE WHEN alpha > 0 THEN '{N.S_HYBRID}' ELSE '{N.S_BASELINE}' END AS strategy FROM oof o JOIN decision USING (fold, direction)
          UNION ALL SELECT f.source_row, 'FUTURE', NULL, base, corr, alpha, n, reason, NULL,
            CASE WHEN alpha > 0 THEN '{N.S_HYBRID_FINAL}' ELSE '{N.S_BASELINE_FINAL}' END
          FROM filled f JOIN final USING (direction) WHERE role = 'FUTURE')
        SELECT s.source_row, coalesce(st, CASE WHEN utc IS NULL THEN '{N.P_NO_UTC}' WHEN s.actual IS NULL THEN '{N.P_GAP}' ELSE '{N.P_WARMUP}' END)
            AS prediction_status, fold, strategy, alpha AS blend_alpha, n AS calibration_n, reason AS calibration_reason,
          round(base + 3.3e-8, 6) AS baseline_backtest, round(corr + 3.3e-8, 6) AS correction,
          round(scored.actual - base + 3.3e-8, 6) AS residual_actual, round(raw + 3.3e-8, 6) AS raw_candidate,
          round(blended + 3.3e-8, 6) AS forecast, round(blended - scored.actual + 3.3e-8, 6) AS error, cutoff AS forecast_cutoff_utc
        FROM s LEFT JOIN (SELECT *, greatest(base + corr, 0) AS raw, greatest(base + alpha * corr, 0) AS blended FROM scored) scored
          USING (source_row), c""",
)
def backtest_rows(spark, sf):
    """Every row of a run with its final status, fold, decision, forecast and audit columns."""
    out = _plain_backtest(spark, sf).predictions
    plain = ["source_row", "prediction_status", "fold", "strategy", "blend_alpha", "calibration_n", "calibration_reason"]
    rounded = ["baseline_backtest", "correction", "residual_actual", "raw_candidate", "forecast", "error"]
    cutoff = F.col("forecast_cutoff_utc").cast("timestamp_ntz").alias("forecast_cutoff_utc")
    return out.select(*plain, *[r6(c).alias(c) for c in rounded], cutoff)
