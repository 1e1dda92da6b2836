"""Scalar expressions: tokens, numbers, times, lag statistics, weather shapes."""

import datetime as dt
import math

from pyspark.sql import functions as F

from loadcast import names as N
from loadcast.functions import rowwise as R
from loadcast.functions import text as T
from loadcast.functions import times as X


def one(spark, expr, **values):
    df = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()])
    return df.select(expr.alias("x")).first()[0]


def column(spark, values, expr, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, a {kind}")
    return [r[0] for r in df.orderBy("i").select(expr(F.col("a"))).collect()]


def test_token(spark):
    got = column(spark, ["Łódź", " łodz ", "Skarżysko-Kamienna", "dataGodzina_CET", "éa", None, "—", "²"], T.token)
    assert got == ["lodz", "lodz", "skarzyskokamienna", "datagodzinacet", "ea", None, "", "2"]
    assert T.py_token("Czas danych źródła (CET)") == "czasdanychzrodlacet"


def test_clean_text(spark):
    got = column(spark, ["  a   b\t", "", "nan", "None", "<NA>", None, "NaN"], T.clean_text)
    assert got == ["a b", None, None, None, None, None, "NaN"]


def test_number(spark):
    got = column(spark, ["1 234,5", "-1 000", "1.5d", "x", "", None, "nan", "1e3", ".5", "7."], T.number)
    assert got == [1234.5, -1000.0, None, None, None, None, None, 1000.0, 0.5, 7.0]
    typed = column(spark, [1.0, float("nan"), None], lambda c: T.number(c, "double"), "double")
    assert typed == [1.0, None, None]


def test_first_int(spark):
    assert column(spark, ["8", "8.0", "H25", "x", None], T.first_int) == [8, 8, 25, None, None]


def test_dates(spark):
    texts = ["2025-01-05", "05.01.2025", "2025-01-05 13:00:00", "2025/01/05", "soon", None]
    day = dt.date(2025, 1, 5)
    assert column(spark, texts, T.to_day) == [day, day, day, day, None, None]
    instants = column(spark, ["2025-10-26T02:00:00+02:00", "2025-10-26 00:00:00"], lambda c: T.to_instant(c).cast("string"))
    assert instants == ["2025-10-26 00:00:00"] * 2


def test_valid_time(spark):
    df = spark.createDataFrame([(1,), (24,), (25,), (0,), (None,)], "h int")
    got = [r[0] for r in df.select(X.valid_time(F.lit("2025-01-01").cast("date"), F.col("h"))).collect()]
    assert got == [dt.datetime(2025, 1, 1, 0), dt.datetime(2025, 1, 1, 23), None, None, None]


def test_strict_utc_drops_repeated_and_skipped_hours(spark):
    local = ["2025-01-01 12:00:00", "2025-07-01 12:00:00", "2025-10-26 02:30:00", "2025-03-30 02:30:00", "2025-10-26 03:00:00"]
    got = column(spark, local, lambda c: X.strict_to_utc(c.cast("timestamp_ntz"), "Europe/Warsaw").cast("string"))
    assert got == ["2025-01-01 11:00:00", "2025-07-01 10:00:00", None, None, "2025-10-26 02:00:00"]


def test_lead_by_minute_counts_boundaries(spark):
    df = spark.sql("select timestamp'2025-01-01 00:00:59' a, timestamp'2025-01-01 01:00:00' b")
    assert str(df.select(X.lead_hours_by_minute(F.col("b"), F.col("a"))).first()[0]) == "1.00"


def test_clip_and_blend_keep_null(spark):
    assert column(spark, [-1.0, None, 50.0], lambda c: R.clip(c, 0, 40), "double") == [0.0, None, 40.0]
    df = spark.createDataFrame([(10.0, -4.0), (2.0, -10.0), (None, 1.0)], "b double, c double")
    assert [r[0] for r in df.select(R.blend(F.col("b"), F.col("c"), 0.5)).collect()] == [8.0, 0.0, None]


def test_weather_shapes_keep_null(spark):
    df = spark.range(1).select(*[F.lit(None).cast("double").alias(f) for f in N.WEATHER_FEATURES])
    row = df.withColumns(R.weather_features()).first()
    assert all(row[k] is None for k in R.weather_features())
    values = {"temperature": 10.0, "wind_speed": 50.0, "wind_dir": -90.0, "cloud": 80.0, "rad_total": 100.0, "precip": -1.0}
    full = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()])
    row = full.withColumns(R.weather_features()).first()
    assert (row.heating_degrees, row.cooling_degrees, row.wind_speed_2, row.wind_speed_3) == (8.0, 0.0, 1600.0, 64000.0)
    assert math.isclose(row.wind_dir_sin, -1.0) and row.cloud_fraction == 0.8 and row.precip_log1p == 0.0
    assert math.isclose(row.rad_after_cloud, 20.0)


def test_series_key_marks_missing(spark):
    df = spark.createDataFrame([(" BIA ", None, "K", "IMPORT", "4")], ", ".join(f"{c} string" for c in N.SERIES_COLUMNS))
    assert df.select(R.series_key()).first()[0] == "BIA|__MISSING__|K|IMPORT|4"
