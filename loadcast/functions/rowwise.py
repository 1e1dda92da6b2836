"""Row-level feature expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from loadcast import names as N


def clip(c: Column, low: float | None = None, high: float | None = None) -> Column:
    """Clip that keeps NULL as NULL."""
    out = c
    if low is not None:
        out = F.when(out < low, F.lit(float(low))).otherwise(out)
    if high is not None:
        out = F.when(out > high, F.lit(float(high))).otherwise(out)
    return out


def blend(baseline: Column, correction: Column, alpha: Column | float) -> Column:
    alpha = F.lit(float(alpha)) if isinstance(alpha, (int, float)) else alpha
    return clip(baseline + alpha * correction, low=0.0)


def series_key(columns: list[str] | None = None) -> Column:
    parts = [F.trim(F.coalesce(F.col(c).cast("string"), F.lit(N.MISSING))) for c in columns or N.SERIES_COLUMNS]
    return F.concat_ws("|", *parts)


def lag_name(day: int) -> str:
    return f"lag_{24 * int(day)}h"


def lag_mean_name(lag_days: tuple[int, ...]) -> str:
    return f"lag_mean_{min(lag_days)}_{max(lag_days)}d"


def _count_sql(columns: list[str]) -> str:
    return "(" + " + ".join(f"int({c} is not null)" for c in columns) + ")"


def _mean_sql(columns: list[str]) -> str:
    total = " + ".join(f"coalesce({c}, 0D)" for c in columns)
    return f"(({total}) / nullif({_count_sql(columns)}, 0))"


def lag_statistics(lag_days: tuple[int, ...]) -> list[dict[str, Column]]:
    """Mean, count, spread, short-vs-long trend and D-7 deviation over the lag columns of a row.

    Plain arithmetic in two steps (the second uses the mean of the first), so the whole stays in generated code.
    """
    lags = [lag_name(d) for d in lag_days]
    recent = [lag_name(d) for d in lag_days if 3 <= d <= 6]
    older = [lag_name(d) for d in lag_days if 10 <= d <= 14]
    trend = f"{_mean_sql(recent)} - {_mean_sql(older)}" if recent and older else "cast(null as double)"
    mean = lag_mean_name(lag_days)
    squares = " + ".join(f"if({c} is null, 0D, ({c} - {mean}) * ({c} - {mean}))" for c in lags)
    week = f"{lag_name(7)} - {mean}" if 7 in lag_days else "cast(null as double)"
    first = {mean: _mean_sql(lags), "lag_count": f"double({_count_sql(lags)})", "lag_trend": trend}
    second = {
        "lag_std_3_14d": f"if(lag_count > 1, sqrt(({squares}) / nullif(lag_count - 1, 0)), null)",
        "lag_7d_vs_mean": week,
        "baseline": mean,
    }
    return [{k: F.expr(v) for k, v in step.items()} for step in (first, second)]


def calendar_features(valid_local: Column) -> dict[str, Column]:
    return {
        "hour": F.hour(valid_local),
        "weekday": F.weekday(valid_local),
        "month": F.month(valid_local),
        "day_of_year": F.dayofyear(valid_local),
        "weekend": F.coalesce((F.weekday(valid_local) >= 5).cast("double"), F.lit(0.0)),
    }


def cyclic_features(hour: Column, weekday: Column, day_of_year: Column) -> dict[str, Column]:
    def turn(c: Column, period: float) -> Column:
        return c * F.lit(2 * math.pi) / F.lit(period)

    return {
        "hour_sin": F.sin(turn(hour, 24.0)),
        "hour_cos": F.cos(turn(hour, 24.0)),
        "weekday_sin": F.sin(turn(weekday, 7.0)),
        "weekday_cos": F.cos(turn(weekday, 7.0)),
        "year_sin": F.sin(turn(day_of_year, 365.25)),
        "year_cos": F.cos(turn(day_of_year, 365.25)),
    }


def weather_features() -> dict[str, Column]:
    temperature, wind, direction = F.col("temperature"), F.col("wind_speed"), F.col("wind_dir")
    cloud, radiation, precip = F.col("cloud"), F.col("rad_total"), F.col("precip")
    angle = F.radians(F.pmod(direction, F.lit(360.0)))
    calm = clip(wind, 0.0, 40.0)
    fraction = F.when(F.abs(cloud) <= 1.5, cloud).otherwise(cloud / 100.0)
    return {
        "heating_degrees": clip(18.0 - temperature, low=0.0),
        "cooling_degrees": clip(temperature - 22.0, low=0.0),
        "wind_dir_sin": F.sin(angle),
        "wind_dir_cos": F.cos(angle),
        "wind_speed_2": calm * calm,
        "wind_speed_3": calm * calm * calm,
        "cloud_fraction": fraction,
        "rad_after_cloud": radiation * (1.0 - clip(fraction, 0.0, 1.0)),
        "precip_log1p": F.log1p(clip(precip, low=0.0)),
    }


def feature_count() -> Column:
    return F.expr(" + ".join(f"int({name} is not null)" for name in N.WEATHER_FEATURES))
