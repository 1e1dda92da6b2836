"""Feature table: lags, calendar, weather shapes, filled categories."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadcast import names as N
from loadcast.functions.rowwise import (
    calendar_features,
    cyclic_features,
    lag_mean_name,
    lag_name,
    weather_features,
)
from loadcast.operators.calendar_dim import add_special_days
from loadcast.operators.lags import DEFAULT_LAGS, add_lag_statistics, add_lags


@dataclass(frozen=True)
class FeatureSpec:
    categorical: list[str]
    numeric: list[str]

    @property
    def all(self) -> list[str]:
        return [*self.categorical, *self.numeric]


def feature_spec(lag_days: tuple[int, ...] = DEFAULT_LAGS) -> FeatureSpec:
    numeric = [
        *N.WEATHER_FEATURES,
        "weather_available",
        "lead_hours",
        "hour",
        "weekday",
        "month",
        "weekend",
        "is_holiday",
        "is_clock_change",
        "hour_sin",
        "hour_cos",
        "weekday_sin",
        "weekday_cos",
        "year_sin",
        "year_cos",
        "heating_degrees",
        "cooling_degrees",
        "wind_dir_sin",
        "wind_dir_cos",
        "wind_speed_2",
        "wind_speed_3",
        "cloud_fraction",
        "rad_after_cloud",
        "precip_log1p",
        *[lag_name(d) for d in lag_days],
        lag_mean_name(lag_days),
        "lag_count",
        "lag_std_3_14d",
        "lag_trend",
        "lag_7d_vs_mean",
    ]
    return FeatureSpec(categorical=list(N.CATEGORICAL), numeric=numeric)


def fill_availability(df: DataFrame) -> DataFrame:
    """`weather_available` as 0/1, from the match flag when the column is absent, never NULL."""
    if "weather_available" in df.columns:
        flag = F.col("weather_available").cast("double")
    elif "weather_matched" in df.columns:
        flag = F.col("weather_matched").cast("double")
    else:
        flag = F.lit(0.0)
    return df.withColumn("weather_available", F.coalesce(flag, F.lit(0.0)))


def add_row_features(df: DataFrame) -> DataFrame:
    """Everything that needs no other row: calendar, cyclic, special days, weather shapes."""
    df = df.withColumns(calendar_features(F.col("valid_local")))
    df = df.withColumns(cyclic_features(F.col("hour"), F.col("weekday"), F.col("day_of_year")))
    return add_special_days(df).withColumns(weather_features())


def fill_categories(df: DataFrame) -> DataFrame:
    """Missing categories become a category of their own."""
    filled = {c: F.coalesce(F.col(c).cast("string"), F.lit(N.MISSING)) for c in N.CATEGORICAL}
    return df.withColumns(filled)


def build_features(
    df: DataFrame, lag_days: tuple[int, ...] = DEFAULT_LAGS, history: DataFrame | None = None
) -> tuple[DataFrame, FeatureSpec]:
    df = add_lag_statistics(add_lags(fill_availability(df), lag_days, history), lag_days)
    return fill_categories(add_row_features(df)), feature_spec(lag_days)
