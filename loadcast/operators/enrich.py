"""Energy with weather: many-to-one left join, time fill, status, quality counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadcast import names as N
from loadcast.functions.rowwise import feature_count
from loadcast.functions.times import strict_to_utc

TRADE_KEY, VALID_TIME = "trade_key", "valid_time"


def choose_join_mode(energy: DataFrame, weather: DataFrame, explicit: bool) -> str:
    """Trade key only if the weather source has one and both sides carry a date and an hour somewhere."""
    if not explicit:
        return VALID_TIME
    sides = [(weather, "w_trade_date"), (weather, "w_trade_hour"), (energy, "trade_date"), (energy, "trade_hour")]
    usable = all(not df.filter(F.col(c).isNotNull()).select(c).isEmpty() for df, c in sides)
    return TRADE_KEY if usable else VALID_TIME


def join_weather(energy: DataFrame, weather: DataFrame, mode: str) -> DataFrame:
    """Left join that keeps every energy row once; `weather` must be unique per key (see `latest_vintage`).

    No broadcast hint: the planner broadcasts a small weather side by itself, and otherwise AQE splits a delivery hour
    that holds very many energy rows. NULL keys never match.
    """
    if mode == TRADE_KEY:
        left, right = ["point_key", "trade_date", "trade_hour"], ["point_key", "w_trade_date", "w_trade_hour"]
    else:
        left, right = ["point_key", "valid_local"], ["point_key", "w_valid_local"]
    w = weather.drop("point", "src_order", "explicit_key", "exec_id").withColumn("_matched", F.lit(True))
    w = w.withColumnRenamed("point_key", "_w_point_key")
    right = ["_w_point_key" if c == "point_key" else c for c in right]
    condition = [energy[a] == w[b] for a, b in zip(left, right)]
    joined = energy.join(w, condition, "left").drop("_w_point_key")
    matched = F.coalesce(F.col("_matched"), F.lit(False))
    return joined.withColumns(
        {"weather_matched": matched, "weather_available": matched.cast("double"), "feature_count": feature_count()}
    ).drop("_matched")


def fill_times(df: DataFrame, zone: str) -> DataFrame:
    """Delivery hour from the weather row where the trade hour has no wall clock (hour 25), then the UTC instant."""
    local = F.coalesce(F.col("valid_local"), F.col("w_valid_local"))
    return df.withColumn("valid_local", local).withColumn(
        "model_utc", F.coalesce(F.col("w_valid_utc"), strict_to_utc(F.col("valid_local"), zone))
    )


def weather_status(weather_start: str | None) -> Column:
    """Key and mapping faults come first so that an expected gap cannot hide them."""
    status = F.when(F.col("point").isNull(), N.W_NO_MAP).when(F.col("model_utc").isNull(), N.W_NO_TIME)
    if weather_start is not None:
        status = status.when(F.col("trade_date") < F.lit(weather_start).cast("date"), N.W_BEFORE)
    return status.when(F.col("weather_matched"), N.W_MATCHED).otherwise(N.W_MISSING)


def enrich(
    energy: DataFrame,
    weather: DataFrame,
    mode: str,
    zone: str = "Europe/Warsaw",
    weather_start: str | None = "2024-10-01",
) -> DataFrame:
    joined = fill_times(join_weather(energy, weather, mode), zone)
    return joined.withColumn("weather_status", weather_status(weather_start))


def duplicate_keys(weather: DataFrame, key: list[str]) -> DataFrame:
    """Keys that would break the many-to-one rule."""
    return weather.groupBy(*key).agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1")


def join_quality(df: DataFrame, mode: str, weather_start: str | None = "2024-10-01") -> DataFrame:
    """Check/count/details rows over enriched energy, in one pass."""
    matched = F.col("weather_matched")

    def status(code: str) -> Column:
        return F.count_if(F.col("weather_status") == code)

    checks = [
        ("join_mode", F.count(F.lit(1)), mode),
        ("weather_matched", F.count_if(matched), ""),
        ("weather_before_start", status(N.W_BEFORE), weather_start or "no bound"),
        ("weather_missing_in_range", status(N.W_MISSING), "no record for a valid point and time"),
        ("weather_no_mapping", status(N.W_NO_MAP), "branch has no weather point"),
        ("weather_no_time_key", status(N.W_NO_TIME), "invalid or ambiguous date or hour"),
        (
            "weather_partial_record",
            F.count_if(matched & (F.col("feature_count") < len(N.WEATHER_FEATURES))),
            "matched, at least one feature is NULL",
        ),
        ("weather_empty_record", F.count_if(matched & (F.col("feature_count") == 0)), "matched, all features are NULL"),
        *[
            (f"weather_null_{f}", F.count_if(matched & F.col(f).isNull()), "NULL kept; row neither dropped nor zeroed")
            for f in N.WEATHER_FEATURES
        ],
    ]
    stats = df.agg(*[c.alias(name) for name, c, _ in checks])
    cells = [x for name, _, details in checks for x in (F.lit(name), F.col(name), F.lit(details))]
    return stats.select(F.stack(F.lit(len(checks)), *cells).alias("check", "count", "details"))
