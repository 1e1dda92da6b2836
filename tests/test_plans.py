"""Plan shapes that keep the operators cheap at scale, and a hot series against brute force."""

import datetime as dt

from pyspark.sql import functions as F

from loadcast.operators import enrich as J
from loadcast.operators import metrics as M
from loadcast.operators import splits as S
from loadcast.operators.encode import model_matrix
from loadcast.operators.features import feature_spec
from loadcast.operators.lags import add_lag_statistics, add_lags
from loadcast.operators.vintage import normalize_weather
from loadcast.session import bounded_broadcast
from loadcast.sources.warehouse import warehouse_extract


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def hot_energy(spark):
    """Half of the rows belong to one series, and a tenth of all to a single hour of it."""
    i = F.col("id")
    hot = i % 2 == 0
    return spark.range(4000).select(
        F.when(hot, "B0").otherwise(F.concat(F.lit("B"), (i % 5).cast("string"))).alias("branch_code"),
        F.lit("G").alias("group_name"),
        F.when(i % 11 != 0, F.lit("K")).alias("client"),
        F.lit("IMPORT").alias("direction"),
        F.lit("4").alias("kind"),
        F.when(i % 10 == 0, F.lit("2025-01-09")).otherwise(
            F.date_add(F.lit("2025-01-01").cast("date"), (i % 29).cast("int")).cast("string")
        ).cast("date").alias("trade_date"),
        F.when(i % 10 == 0, F.lit(8)).otherwise((i % 24).cast("int") + 1).alias("trade_hour"),
        F.when(i % 7 != 0, (i % 97).cast("double")).alias("actual"),
        i.alias("source_row"),
    )


def test_hot_series_lags_equal_brute_force(spark):
    df = hot_energy(spark)
    got = {r.source_row: r for r in add_lags(df).collect()}
    rows = df.collect()
    assert len(got) == len(rows)
    cells = {}
    for r in rows:
        if r.actual is not None:
            cells.setdefault((r.branch_code, r.client, r.trade_date, r.trade_hour), []).append(r.actual)
    for r in rows:
        for k in range(3, 15):
            past = cells.get((r.branch_code, r.client, r.trade_date - dt.timedelta(k), r.trade_hour))
            value = got[r.source_row][f"lag_{24 * k}h"]
            assert (value is None) == (past is None)
            assert past is None or abs(value - sum(past) / len(past)) < 1e-9


def test_lags_use_one_window_over_preaggregated_cells(spark):
    text = plan(add_lags(hot_energy(spark)))
    assert text.count("Window [") == 1
    window = text[text.index("Window [") :]
    assert "partial_avg" in window


def test_lag_statistics_and_matrix_are_generated_code(spark):
    spec = feature_spec()
    df = add_lag_statistics(add_lags(hot_energy(spark)))
    missing = [c for c in [*spec.numeric, *[f"{c}_enc" for c in spec.categorical]] if c not in df.columns]
    df = df.withColumns({c: F.lit(1.0) for c in missing}).select(model_matrix(spec.categorical, spec.numeric))
    assert "lambda" not in plan(df).lower()


def weather(spark):
    return spark.range(1000).select(
        F.concat(F.lit("P"), (F.col("id") % 3).cast("string")).alias("point"),
        F.expr("timestamp_ntz'2025-01-03 12:00:00' + make_dt_interval(0, cast(id div 1000 as int))").alias("valid_local"),
        (F.lit("2025-01-02 12:00:00").cast("timestamp_ntz") - F.make_dt_interval(F.lit(0), (F.col("id") % 50).cast("int"))).alias("issue_local"),
        F.col("id").cast("double").alias("temperature"),
    )


def test_vintage_is_limited_before_the_shuffle(spark):
    text = plan(normalize_weather(weather(spark)))
    partial = text.index("1, Partial")
    assert text.index("1, Final") < text.index("Exchange hashpartitioning") < partial
    out = normalize_weather(weather(spark)).collect()
    assert sorted(r.point for r in out) == ["P0", "P1", "P2"] and all(r.lead_hours == 24.0 for r in out)


def test_warehouse_filters_reach_the_scan(spark, folder):
    spark.range(10).select(
        F.lit("Lublin").alias("punkt"), F.lit("2025-01-03").cast("date").alias("dataCET"), F.lit(1).alias("godzinaHandlowa25"),
        F.lit("2025-01-03").cast("timestamp_ntz").alias("dataGodzinaCET"), F.lit("2025-01-03").cast("timestamp").alias("dataGodzinaUTC"),
        F.lit("2025-01-01").cast("timestamp").alias("czasDanychZrodlaUTC"), F.col("id").alias("execId"), F.lit("o").alias("wlasciciel"),
        F.lit("k").alias("typ"), F.lit(1).alias("czyOstatniNaCzasDanych"), F.lit(1.0).alias("temperatura"), F.lit("x").alias("unused"),
    ).write.parquet(f"{folder}/view")
    out = warehouse_extract(spark.read.parquet(f"{folder}/view"), "2025-01-01", "2025-02-01", 24, "o", "k").select("point", "temperature")
    spark.conf.set("spark.sql.maxMetadataStringLength", "5000")
    text = plan(out)
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    scan = text[text.index("PushedFilters") :]
    pushed = scan[: scan.index("ReadSchema")]
    for part in ("In(punkt", "EqualTo(wlasciciel,o)", "EqualTo(typ,k)", "GreaterThanOrEqual(dataGodzinaCET", "LessThan(dataGodzinaCET", "IsNotNull(czasDanychZrodlaUTC)"):
        assert part in pushed
    assert "unused" not in scan
    assert out.count() == 1


def test_metrics_read_the_rows_once(spark):
    df = hot_energy(spark).withColumn("forecast", F.col("actual") + 1).withColumn("point", F.lit("P"))
    text = plan(M.metrics_by_scope(M.error_cells(df, {"M": "forecast"})))
    assert text.count("Range (") == 1


def test_broadcast_only_below_the_bound(spark):
    left, right = hot_energy(spark), spark.range(50).select(F.col("id").alias("source_row"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "BroadcastHashJoin" in plan(left.join(bounded_broadcast(right, 50), "source_row"))
        assert "BroadcastHashJoin" not in plan(left.join(bounded_broadcast(right, 49), "source_row"))
        joined = J.join_weather(
            left.withColumns({"point_key": F.lower("branch_code"), "valid_local": F.col("trade_date").cast("timestamp_ntz")}),
            normalize_weather(weather(spark)),
            J.VALID_TIME,
        )
        assert "Broadcast" not in plan(joined) and joined.count() == 4000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_windows_are_told_by_generated_code(spark):
    """A lambda is evaluated outside of generated code, for every row and use."""
    i = F.col("id")
    direction = F.when(i % 3 == 0, "IMPORT").when(i % 3 == 1, "EXPORT").alias("direction")
    rows = spark.range(2000).select(direction, F.lit(1.0).alias("actual"), F.timestamp_seconds(i * 3600).alias("model_utc"))
    folds = S.expanding_splits(dt.datetime(1970, 3, 1), 2, 3)
    uses = S.scoring_roles(rows, [(f, d, k, True) for k, f in enumerate(folds) for d in ("IMPORT", "EXPORT")], 4)
    sets = S.training_sets(rows, folds, 4)
    assert "lambda" not in plan(uses).lower() and "lambda" not in plan(sets).lower()
    # Six days are tested; the calibration windows of four days before them overlap by one. A third has no direction.
    assert {(r.role, r["count"]) for r in uses.groupBy("role").count().collect()} == {("TEST", 96), ("CAL", 128)}
    assert [r.set_id for r in sets.select("set_id").distinct().orderBy("set_id").collect()] == ["CAL_1", "CAL_2", "FINAL", "TEST_1", "TEST_2"]
