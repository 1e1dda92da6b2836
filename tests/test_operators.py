"""Joins, windows, aggregates and decisions against known values."""

import datetime as dt

import pandas as pd
import pytest
from dateutil.easter import easter
from pyspark.sql import functions as F

from fixtures import energy_raw
from loadcast import names as N
from loadcast.config import ForecastConfig, fast_profile, full_training_profile
from loadcast.operators import blend as B
from loadcast.operators import calendar_dim as C
from loadcast.operators import encode as E
from loadcast.operators import energy as EN
from loadcast.operators import enrich as J
from loadcast.operators import metrics as M
from loadcast.operators import splits as S
from loadcast.operators import vintage as V
from loadcast.operators.baseline import fallback_medians, fill_baseline
from loadcast.operators.features import FeatureSpec, feature_spec
from loadcast.operators.lags import add_lag_statistics, add_lags
from loadcast.operators.medians import grouped_medians
from loadcast.operators.residual import held_out_from
from loadcast.operators.residual import _with_donors, fit_residual, permutation_importance, usable_rows

BIA = [("BIA", "Białystok", "active")]
MAP = "branch_code string, point string, status string"


def daily(spark, n, extra=()):
    rows = [("BIA", "G", "K", "IMPORT", "4", dt.date(2025, 1, 1) + dt.timedelta(i), 8, float(i + 1)) for i in range(n)]
    names = "branch_code string, group_name string, client string, direction string, kind string, trade_date date, trade_hour int, actual double"
    return spark.createDataFrame([*rows, *extra], names)


def test_lags_same_hour_day_3_to_14(spark):
    out = add_lag_statistics(add_lags(daily(spark, 15)))
    assert "lag_24h" not in out.columns and "lag_48h" not in out.columns
    last = out.orderBy(F.desc("trade_date")).first()
    assert [last[f"lag_{24 * k}h"] for k in range(3, 15)] == [float(15 - k) for k in range(3, 15)]
    assert last.lag_mean_3_14d == last.baseline == 6.5 and last.lag_count == 12.0
    assert last.lag_std_3_14d == pytest.approx(3.6055512755)
    assert last.lag_trend == 7.5 and last.lag_7d_vs_mean == 1.5
    first = out.orderBy("trade_date").first()
    assert first.baseline is None and first.lag_count == 0.0 and first.lag_std_3_14d is None


def test_lags_average_repeats_and_leave_gaps_null(spark):
    twice = ("BIA", "G", "K", "IMPORT", "4", dt.date(2025, 1, 1), 8, 3.0)
    no_key = ("BIA", "G", "K", "IMPORT", "4", None, 8, 99.0)
    future = ("BIA", "G", "K", "IMPORT", "4", dt.date(2025, 1, 6), 8, None)
    out = {r.trade_date: r for r in add_lags(daily(spark, 3, [twice, no_key, future]), (3, 4, 5, 7)).collect()}
    row = out[dt.date(2025, 1, 6)]
    assert (row.lag_72h, row.lag_96h, row.lag_120h, row.lag_168h) == (3.0, 2.0, 2.0, None)
    assert out[None].lag_72h is None
    with pytest.raises(ValueError):
        add_lags(daily(spark, 3), (3, 3))
    with pytest.raises(ValueError):
        add_lags(daily(spark, 3), ())


def test_vintage_respects_lead(spark):
    raw = spark.sql(
        """select 'Lublin' punkt, timestamp_ntz'2025-01-03 12:00:00' dataGodzinaCET,
           timestamp_ntz'2025-01-03 12:00:00' - make_dt_interval(0, h) czasDanychZrodlaCET, t temperatura
           from values (30, 1.0D), (12, 99.0D), (40, 5.0D) v(h, t)"""
    )
    rows = V.normalize_weather(raw, 24).collect()
    assert len(rows) == 1 and rows[0].temperature == 1.0 and rows[0].lead_hours == 30.0
    assert V.normalize_weather(raw, 30).first().temperature == 1.0
    assert V.normalize_weather(raw, already_vintaged=True).first().temperature == 99.0


def test_vintage_tie_takes_the_last_row(spark):
    raw = spark.sql(
        """select 'L' point, timestamp_ntz'2025-01-03 12:00:00' valid_local, timestamp_ntz'2025-01-01' issue_local,
           o src_order, cast(o as double) temperature from values (1), (3), (2) v(o)"""
    )
    assert V.normalize_weather(raw).first().temperature == 3.0


def test_weather_needs_issue_time_and_point(spark):
    raw = spark.sql("select 'L' point, timestamp_ntz'2025-01-03' valid_local")
    with pytest.raises(ValueError):
        V.normalize_weather(raw)
    assert V.normalize_weather(raw, already_vintaged=True).count() == 1
    with pytest.raises(ValueError):
        V.normalize_weather(raw.drop("point"), already_vintaged=True)


def test_status_before_start_and_null_features(spark):
    raw = energy_raw(
        spark,
        [
            ("Dane_01", 2, "BIA", 1, "K", "czynne pobranie", "2024-09-30", 1, 10),
            ("Dane_01", 3, "BIA", 1, "K", "czynne pobranie", "2024-10-02", 1, 11),
            ("Dane_01", 4, "XYZ", 1, "K", "czynne pobranie", "2024-09-30", 1, 12),
            ("Dane_01", 5, "BIA", 1, "K", "czynne pobranie", "bad", 1, 12),
            ("Dane_01", 6, "BIA", 1, "K", "czynne pobranie", "2024-10-05", 1, 12),
        ],
    )
    energy = EN.normalize_energy(raw, spark.createDataFrame(BIA, MAP))
    weather = spark.sql(
        """select 'Białystok' punkt, timestamp_ntz'2024-10-02 00:00:00' dataGodzinaCET,
           timestamp_ntz'2024-09-30 18:00:00' czasDanychZrodlaCET, cast(null as double) temperatura"""
    )
    out = J.enrich(energy, V.normalize_weather(weather), J.VALID_TIME)
    rows = {r.source_row: r for r in out.collect()}
    assert [rows[k].weather_status for k in (2, 3, 4, 5, 6)] == [N.W_BEFORE, N.W_MATCHED, N.W_NO_MAP, N.W_NO_TIME, N.W_MISSING]
    assert rows[3].weather_available == 1.0 and rows[3].temperature is None and rows[3].feature_count == 0
    counts = {r.check: r["count"] for r in J.join_quality(out, J.VALID_TIME).collect()}
    assert counts["weather_before_start"] == 1 and counts["weather_empty_record"] == 1 and len(counts) == 18


def test_repeated_hour_gets_two_instants(spark):
    raw = energy_raw(
        spark,
        [
            ("Dane_01", 2, "BIA", 1, "K", "czynne pobranie", "2025-10-26", 3, 10),
            ("Dane_01", 3, "BIA", 1, "K", "czynne pobranie", "2025-10-26", 25, 11),
        ],
    )
    energy = EN.normalize_energy(raw, spark.createDataFrame(BIA, MAP))
    weather = spark.sql(
        """select 'Białystok' punkt, '2025-10-26' dataCET, h godzinaHandlowa25, timestamp_ntz'2025-10-26 02:00:00' dataGodzinaCET,
           u dataGodzinaUTC, timestamp_ntz'2025-10-24 20:00:00' czasDanychZrodlaCET, t temperatura
           from values (3, '2025-10-26T00:00:00Z', 5.0D), (25, '2025-10-26T01:00:00Z', 6.0D) v(h, u, t)"""
    )
    typed, explicit = V.type_weather(weather)
    mode = J.choose_join_mode(energy, typed, explicit)
    assert mode == J.TRADE_KEY
    out = J.enrich(energy, V.normalize_weather(weather), mode)
    assert out.count() == 2 and out.select("model_utc").distinct().count() == 2
    assert out.filter(~F.col("weather_matched")).count() == 0
    assert out.select("valid_local").distinct().count() == 1


def test_direction_rules_and_quality(spark):
    raw = energy_raw(
        spark,
        [
            ("D", 2, "BIA", 1, "K", "czynne pobranie", "2025-01-01", 1, 1),
            ("D", 3, "BIA", 1, "K", "czynne oddanie", "2025-01-01", 25, -1),
            ("D", 4, "zzz", -1, "K", "", "2025-01-01", 1, ""),
            ("D", 5, "", "", "K", "inne", "2025-01-01", 1, "1,5"),
        ],
    )
    out = EN.normalize_energy(raw, spark.createDataFrame(BIA, MAP))
    rows = {r.source_row: r for r in out.collect()}
    assert [(rows[k].direction, rows[k].direction_source) for k in (2, 3, 4, 5)] == [
        (N.IMPORT, N.SRC_TEXT),
        (N.EXPORT, N.SRC_TEXT),
        (N.EXPORT, N.SRC_SIGN),
        (None, N.SRC_NONE),
    ]
    q = {r.check: (r["count"], r.details) for r in EN.energy_quality(out).collect()}
    assert q["energy_rows"][0] == 4 and q["direction_mismatch"][0] == 1 and q["hour_25_or_invalid"][0] == 1
    assert [tuple(r) for r in EN.unknown_branches(out).collect()] == [("zzz", 1)]
    assert q["unknown_branch"][0] == 1 and q["missing_branch"][0] == 1 and q["negative_actual"][0] == 1


def test_easter_and_clock_change(spark):
    years = spark.range(1583, 2500).select(F.col("id").cast("int").alias("y"))
    got = years.select("y", C.easter_sunday(F.col("y")).alias("e")).collect()
    assert all(r.e == easter(r.y) for r in got)
    days = spark.sql("select explode(sequence(date'2025-01-01', date'2025-12-31')) d")
    flags = days.select("d", C.is_holiday(F.col("d")).alias("h"), C.is_clock_change(F.col("d")).alias("c"))
    assert flags.filter("h = 1").count() == 13
    assert [str(r.d) for r in flags.filter("c = 1").orderBy("d").collect()] == ["2025-03-30", "2025-10-26"]
    assert spark.sql("select cast(null as date) d").select(C.is_holiday(F.col("d"))).first()[0] == 0.0


FALLBACK_TRAIN = [
    ("BIA", "K1", "IMPORT", 8, 10.0),
    ("BIA", "K1", "IMPORT", 8, 20.0),
    ("BIA", "K2", "IMPORT", 8, 30.0),
    ("LUB", "K3", "IMPORT", 8, 50.0),
    ("LUB", "K4", "EXPORT", 9, 100.0),
]
FALLBACK_TEST = [
    (0, 0.0, "BIA", "NEW", "IMPORT", 8),
    (1, None, "BIA", "K1", "IMPORT", 8),
    (2, None, "BIA", "NEW", "IMPORT", 8),
    (3, None, "XYZ", "NEW", "IMPORT", 8),
    (4, None, "XYZ", "NEW", "EXPORT", 7),
    (5, None, "XYZ", "NEW", None, 7),
]


def test_fallback_baseline(spark):
    train = spark.createDataFrame(FALLBACK_TRAIN, "branch_code string, client string, direction string, hour int, actual double")
    test = spark.createDataFrame(FALLBACK_TEST, "i int, baseline double, branch_code string, client string, direction string, hour int")
    out = fill_baseline(test, fallback_medians(train))
    got = [r.baseline_filled for r in out.orderBy("i").collect()]
    assert got == [0.0, 15.0, 20.0, 25.0, 100.0, 30.0]
    empty = fill_baseline(test, fallback_medians(train.limit(0)))
    assert [r.baseline_filled for r in empty.orderBy("i").collect()] == [0.0] * 6


def test_medians_of_infinite_values(spark):
    values = [float("-inf"), 1.0, 2.0, float("inf"), float("inf"), float("inf"), -3.0]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    assert grouped_medians(df, [[]], "v").first()["median"] == 2.0
    assert grouped_medians(df.union(df.limit(0)).filter("v > 1"), [[]], "v").first()["median"] == float("inf")


def test_hold_out_is_never_empty_or_everything():
    assert held_out_from([(1, 100), (2, 100), (3, 100), (4, 100)]) == 4
    assert held_out_from([(1, 95), (2, 3), (3, 2)]) == 2
    assert held_out_from([(h, 1) for h in range(100)]) == 90
    assert held_out_from([(7, 50)]) is None and held_out_from([]) is None


def test_large_group_medians_equal_pandas(spark):
    """One group holds most rows; signs, zeros, repeats and very different magnitudes."""
    df = spark.range(6000).select(
        F.when(F.col("id") % 3 != 0, F.lit("hot")).when(F.col("id") % 9 != 0, "warm").alias("g"),
        F.when(F.col("id") % 7 == 0, 0.0)
        .otherwise(F.expr("(hash(id) % 100000) * pow(10, id % 9 - 6)"))
        .cast("double")
        .alias("v"),
    )
    got = grouped_medians(df, [["g"], []], "v").toPandas()
    pdf = df.toPandas()
    want = {g: x.v.median() for g, x in pdf.groupby("g", dropna=False)}
    for r in got[got.level == 0].itertuples():
        key = r.g if isinstance(r.g, str) else next(k for k in want if pd.isna(k))
        assert r.median == want[key]
    assert got[got.level == 1]["median"].iloc[0] == pdf.v.median()


def decide(spark, rows, **kwargs):
    df = spark.createDataFrame(rows, "actual double, baseline double, correction double").withColumn("k", F.lit(1))
    return B.select_alpha(df, ["k"], **kwargs).first()


def test_alpha_finds_the_optimum(spark):
    r = decide(spark, [(12.0, 10.0, 4.0), (8.0, 10.0, -4.0)] * 2, min_rows=1, min_improvement=0.0, grid_steps=5)
    assert (r.alpha, r.n, r.hybrid_mae, r.improvement, r.reason) == (0.5, 4, 0.0, 1.0, N.R_CHOSEN)


def test_alpha_zero_when_worse_or_tied(spark):
    rows = [(100.0, 101.0, 50.0), (120.0, 119.0, -50.0), (80.0, 81.0, 50.0)]
    for data in (rows, [(9.0, 10.0, 0.0), (11.0, 10.0, 0.0)]):
        r = decide(spark, data, min_rows=1, min_improvement=0.0, grid_steps=5)
        assert r.alpha == 0.0 and r.hybrid_mae == r.baseline_mae and r.reason == N.R_NO_GAIN


def test_alpha_needs_confirmed_gain_and_rows(spark):
    rows = [(10.0, 9.0, 0.1), (10.0, 11.0, -0.1)]
    r = decide(spark, rows, min_rows=1, min_improvement=0.20, grid_steps=11)
    assert r.alpha == 0.0 and r.improvement == pytest.approx(0.10) and r.reason == N.R_NO_GAIN
    r = decide(spark, rows, min_rows=3)
    assert r.reason == N.R_FEW_CALIBRATION and r.baseline_mae is None and r.n == 2
    r = decide(spark, [(10.0, 10.0, 1.0)], min_rows=1)
    assert r.reason == N.R_PERFECT and r.alpha == 0.0 and r.improvement == 0.0
    r = decide(spark, [(12.0, 10.0, 4.0), (1.0, None, 1.0), (float("nan"), 1.0, 1.0)], min_rows=1)
    assert r.n == 1


def test_splits_and_calibration(spark):
    folds = S.expanding_splits(dt.datetime(2025, 1, 31, 22), 3, 7)
    assert [f.start.day for f in folds] == [11, 18, 25] and folds[-1].end == dt.datetime(2025, 2, 1)
    assert S.expanding_splits(None, 3, 7) == []
    times = ["2025-01-07 23:59:59", "2025-01-08 00:00:00", "2025-01-09 23:59:59", "2025-01-10 00:00:00", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(times)], "i int, t string").withColumn("model_utc", F.col("t").cast("timestamp"))
    got = [r[0] for r in df.orderBy("i").select(S.calibration_part(dt.datetime(2025, 1, 10), 2)).collect()]
    assert got == ["FIT", "CALIBRATION", "CALIBRATION", None, None]


def test_residual_target_is_signed(spark):
    df = spark.createDataFrame([(8.0, 10.0), (25.0, 20.0), (27.0, 30.0), (99.0, None)], "actual double, baseline double")
    assert [r.residual_target for r in usable_rows(df).collect()] == [-2.0, 5.0, -3.0]


def test_metrics_ignore_unusable_pairs(spark):
    rows = [("a", "IMPORT", 10.0, 12.0), ("a", "IMPORT", 0.0, 0.0), ("b", "EXPORT", float("nan"), 1.0), ("b", "EXPORT", 4.0, None)]
    df = spark.createDataFrame(rows, "client string, direction string, actual double, forecast double")
    cells = M.error_cells(df, {"M": "forecast"})
    r = M.metrics_by_scope(cells, {"GLOBAL": None}).first()
    assert (r.n, r.mae, r.bias, r.wape) == (2, 1.0, 1.0, 0.2)
    assert r.rmse == pytest.approx(2**0.5) and r.smape == pytest.approx(2 * 2 / 22 / 2)
    macro = M.macro_client_metrics(cells).first()
    assert macro.n == 2 and macro.mae == 1.0


def test_crossfit_never_uses_the_own_fold(spark):
    df = spark.range(100).selectExpr("id", "'c' || (id % 2) c", "id % 5 f", "double(id) y")
    a = E.crossfit_encode(df, "c", "y", F.col("f").cast("int"))
    b = E.crossfit_encode(df.withColumn("y", F.when(F.col("f") == 0, 1e6).otherwise(F.col("y"))), "c", "y", F.col("f").cast("int"))
    both = a.filter("f = 0").select("id", "encoded").join(b.filter("f = 0").select("id", F.col("encoded").alias("e2")), "id")
    assert both.filter("abs(encoded - e2) > 1e-9").count() == 0 and both.count() == 20


def test_trees_learn_a_signed_correction(spark):
    """A weather effect the lags cannot see; one category holds most rows; unseen categories are accepted."""
    spec = feature_spec()
    df = spark.range(4000).select(
        F.lit("D").alias("source_sheet"),
        F.col("id").alias("source_row"),
        (F.lit("2025-01-01").cast("timestamp") + F.make_dt_interval(F.lit(0), F.col("id").cast("int"))).alias("model_utc"),
        *[F.when(F.col("id") % 3 != 0, "hot").otherwise("x").alias(c) for c in spec.categorical],
        *[
            (F.pmod(F.xxhash64("id"), F.lit(200)) / 10.0 if c == "temperature" else F.lit(None)).cast("double").alias(c)
            for c in spec.numeric
        ],
    )
    df = df.withColumn("baseline", F.lit(1000.0)).withColumn(
        "actual", F.when(F.col("temperature") > 10, 1300.0).otherwise(600.0)
    )
    config = ForecastConfig(max_iter=8, step_size=0.5, backend="depth_limited", tree_depth=3)
    model = fit_residual(df, spec, config)
    unseen = df.withColumn("client", F.lit("new"))
    for frame in (df, unseen):
        mae = model.predict(frame, "c").select(F.avg(F.abs(F.col("baseline") + F.col("c") - F.col("actual")))).first()[0]
        assert mae < 120
    with pytest.raises(ValueError):
        fit_residual(df, spec, ForecastConfig(min_train_rows=5000))


def test_configuration():
    config = ForecastConfig().validate()
    assert config.max_input_rows is None and config.max_train_rows is None
    fast = fast_profile().validate()
    assert (fast.max_input_rows, fast.max_train_rows) == (None, 100_000)
    assert fast_profile(ForecastConfig(max_input_rows=5_000)).max_input_rows == 5_000
    full = full_training_profile().validate()
    assert (full.n_splits, full.max_iter, full.tree_depth, full.max_train_rows) == (1, 180, 6, None)
    for bad in (
        {"n_splits": 0},
        {"min_train_rows": 500, "max_train_rows": 100},
        {"min_improvement": -0.01},
        {"min_improvement": 1.0},
        {"grid_steps": 1},
        {"row_selection": "middle"},
        {"backend": "other"},
        {"lag_days": (3, 3)},
    ):
        with pytest.raises(ValueError):
            ForecastConfig(**bad).validate()


class FirstNumber:
    """A correction that is its numeric input."""

    def __init__(self):
        self.spec = FeatureSpec(["c"], ["x"])

    def encode(self, df):
        return df.withColumn("c_enc", F.lit(0.0))

    def score(self, df, matrix, out):
        return df.withColumn(out, F.get(matrix, F.lit(1)))


def test_importance_sends_no_rows_through_the_driver(spark):
    rows = spark.range(400).select(
        F.lit("s").alias("source_sheet"), F.col("id").alias("source_row"), F.lit("a").alias("c"), F.col("id").cast("double").alias("x"),
        F.col("id").cast("double").alias("actual"), F.lit(0.0).alias("baseline"),
    )
    got = permutation_importance(FirstNumber(), rows, bucket_rows=50)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "[_b" in plan and not [x for x in plan.splitlines() if "BroadcastHashJoin" in x and "[_b" in x]
    found = {r.feature: r.importance for r in got.collect()}
    assert found["c"] == 0 and 90 < found["x"] < 180  # a third of the range, for rows of any place


def _residual_rows(spark, n=600):
    """Rows whose target follows `x` and the category; `z` tells nothing, `x` is sometimes missing, every fifth key comes twice."""
    rows = []
    for k in range(n):
        x = None if k % 11 == 0 else float(k * 7919 % 101)
        actual = (40.0 if x is None else x) + 10.0 * (k % 3)
        rows.append(("s", k - k % 5 % 2, "abc"[k % 3], x, 1.0, actual, 0.0, dt.datetime(2025, 1, 1) + dt.timedelta(hours=k)))
    names = "source_sheet string, source_row int, c string, x double, z double, actual double, baseline double, model_utc timestamp"
    return spark.createDataFrame(rows, names)


def _plain_importance(model, rows, repeats, seed, buckets):
    """The rise of the error, one swapped column after the other, rows put in order in Python."""
    keyed = rows.withColumn("h", F.xxhash64("source_sheet", "source_row"))
    draws = [F.struct(F.pmod(F.xxhash64("h", F.lit(seed - 1 - r)), F.lit(buckets)), F.xxhash64("h", F.lit(seed + r))) for r in range(repeats)]
    found = keyed.withColumn("draws", F.array(*draws)).collect()
    tagged = [("", 0, r.c, r.x, r.z, r.actual) for r in found]
    for repeat in range(repeats):
        bucket = lambda r: r.draws[repeat][0]  # noqa: B023, E731
        for b in {bucket(r) for r in found}:
            inside = [r for r in found if bucket(r) == b]
            own = sorted(inside, key=lambda r: (r.h, r.source_row))
            drawn = sorted(inside, key=lambda r: (r.draws[repeat][1], r.source_row))  # noqa: B023
            for feature in ("c", "x", "z"):
                for r, o in zip(own, drawn, strict=True):
                    swapped = [o[f] if f == feature else r[f] for f in ("c", "x", "z")]
                    tagged.append((feature, repeat, *swapped, r.actual))
    frame = rows.sparkSession.createDataFrame(tagged, "feature string, repeat int, c string, x double, z double, actual double")
    error = F.avg(F.abs(F.col("correction") - F.col("actual")))
    errors = {(r.feature, r.repeat): r.e for r in model.predict(frame).groupBy("feature", "repeat").agg(error.alias("e")).collect()}
    return {f: [errors[(f, k)] - errors[("", 0)] for k in range(repeats)] for f in ("c", "x", "z")}


def test_importance_swaps_what_trees_read_without_a_join(spark):
    rows = _residual_rows(spark).dropDuplicates(["source_sheet", "source_row"])
    spec = FeatureSpec(["c"], ["x", "z"])
    config = ForecastConfig(min_train_rows=20, max_iter=8, step_size=0.5, backend="depth_limited", tree_depth=3)
    model = fit_residual(rows, spec, config)
    got = permutation_importance(model, rows, bucket_rows=100)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and plan.count("hashpartitioning(_b") == 2
    want = _plain_importance(model, rows, 2, 42, rows.count() // 100)
    found = {r.feature: (r.importance, r.spread) for r in got.collect()}
    assert set(found) == {"c", "x", "z"} and found["z"] == (0.0, 0.0)
    assert found["c"][0] > 1 and found["x"][0] > 10
    for f, rises in want.items():
        assert found[f] == pytest.approx((sum(rises) / 2, abs(rises[0] - rises[1]) / 2), abs=1e-9)


def test_importance_of_repeated_keys_and_of_no_rows(spark):
    """Repeated keys are rows like any other; without rows every feature is NULL, and NaN where the error itself is."""
    rows = _residual_rows(spark)
    spec = FeatureSpec(["c"], ["x", "z"])
    model = fit_residual(rows, spec, ForecastConfig(min_train_rows=20, max_iter=2, backend="depth_limited", tree_depth=2))
    count = lambda df: {r.feature: r.importance for r in permutation_importance(model, df, bucket_rows=100).collect()}
    twice = count(rows)
    assert twice["x"] > 0 and twice["z"] == 0
    assert count(rows.where("false")) == {"c": None, "x": None, "z": None}
    odd = count(rows.withColumn("actual", F.when(F.col("source_row") < 2, F.lit(float("nan"))).otherwise(F.col("actual"))))
    assert len(odd) == 3 and all(v != v for v in odd.values())


def test_donors_are_the_rows_of_the_bucket(spark):
    """Every row of a bucket gives its inputs to one row of it, whatever the keys."""
    rows = spark.range(500).select(
        F.array(F.col("id").cast("double")).alias("_inputs"), (F.col("id") * 1.0).alias("residual_target"), F.lit("s").alias("source_sheet"),
        F.when(F.col("id") % 3 > 0, F.col("id") % 50).alias("source_row"),
    )
    rows = rows.withColumn("_h", F.xxhash64("source_sheet", "source_row"))
    met = _with_donors(rows, 7, 42, 1).collect()
    assert sorted(r._inputs[0] for r in met) == sorted(r._other[0] for r in met) == [float(k) for k in range(500)]
    assert all(r._inputs[0] == r.residual_target and r._repeat == 1 for r in met)
    dealt = rows.select(F.col("_inputs")[0], F.pmod(F.xxhash64("_h", F.lit(40)), F.lit(7))).collect()
    bucket = {x: b for x, b in dealt}
    assert all(bucket[r._inputs[0]] == bucket[r._other[0]] for r in met) and any(r._inputs != r._other for r in met)


def _shuffles(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def test_wide_rows_look_small_tables_up_without_a_shuffle(spark):
    """Encodings and medians of a few categories are sent to the rows; the rows themselves stay where they are."""
    rows = spark.createDataFrame([("a", k, 1.0 * k, float(k) if k % 2 else None) for k in range(20)], "c string, hour int, actual double, baseline double")
    rows = rows.withColumns({"client": F.col("c"), "direction": F.col("c"), "branch_code": F.col("c")})
    fold = E.row_fold(["hour"])
    cells = E.target_cells(rows, ["c"], "actual", fold)
    table = E.encoding_table(cells, ["c"])
    scanned, known = E.apply_encoding(rows, table, ["c"], 0.0, fold), E.apply_encoding(rows, table, ["c"], 0.0, fold, combos=cells)
    assert _shuffles(scanned) == _shuffles(known) == 0
    assert sorted(scanned.collect()) == sorted(known.collect()) and known.where("c_enc is null").count() == 0
    filled = fill_baseline(rows, fallback_medians(rows))
    assert _shuffles(filled) == 0
    assert {r.hour: r.baseline_filled for r in filled.collect()} == {k: float(k) for k in range(20)}


def test_baselines_where_the_medians_are_many(spark, monkeypatch):
    """Beyond the bound for sending them, the other way gives the same rows."""
    rows = spark.createDataFrame([("a", k % 3, 1.0 * k, float(-k) if k % 2 else None) for k in range(30)], "client string, hour int, actual double, baseline double")
    rows = rows.withColumns({"direction": F.col("client"), "branch_code": F.lit(None).cast("string")})
    sent = fill_baseline(rows, fallback_medians(rows)).collect()
    monkeypatch.setattr("loadcast.operators.baseline.few_rows", lambda df: False)
    joined = fill_baseline(rows, fallback_medians(rows)).collect()
    key = lambda r: (r.actual, r.baseline_filled)
    assert sorted(map(key, sent)) == sorted(map(key, joined))
