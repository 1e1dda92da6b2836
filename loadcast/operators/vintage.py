"""As-of selection: the newest forecast that was already known."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from loadcast import names as N
from loadcast.functions import text as T
from loadcast.functions.times import eligible_vintage, lead_hours
from loadcast.sources.scan import rename_by_alias


def newest_per_key(df: DataFrame, key: list[str], order: list[Column]) -> DataFrame:
    """First row per key in `order`.

    `row_number() = 1` is planned with a partial group limit before the shuffle: every map task sends at most one row
    per key, so a key that holds most of the rows does not load one reducer.
    """
    window = W.partitionBy(*key).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(window)).filter("_rn = 1").drop("_rn")


def type_weather(raw: DataFrame, already_vintaged: bool = False) -> tuple[DataFrame, bool]:
    """Canonical names and types; the flag tells whether the source carries its own trade key."""
    df = rename_by_alias(raw, N.WEATHER_ALIASES)
    have = set(df.columns)
    for needed in ("point", "w_valid_local"):
        if needed not in have:
            raise ValueError(f"weather lacks {needed!r}; headers are {raw.columns}")
    if not already_vintaged and not {"issue_local"} & have:
        raise ValueError("weather lacks the issue time; without it a backtest could see the future")
    explicit = {"w_trade_date", "w_trade_hour"} <= have

    types = dict(df.dtypes)

    def typed(name: str, make, kind: str) -> Column:
        return (make(F.col(name), types[name]) if name in have else F.lit(None).cast(kind)).alias(name)

    local = T.to_local(F.col("w_valid_local"), types["w_valid_local"])
    columns = [
        T.clean_text(F.col("point")).alias("point"),
        typed("exec_id", lambda c, _: c, "string"),
        local.alias("w_valid_local"),
        typed("w_valid_utc", T.to_instant, "timestamp"),
        typed("issue_local", T.to_local, "timestamp_ntz"),
        typed("issue_utc", T.to_instant, "timestamp"),
        typed("w_trade_date", T.to_day, "date") if "w_trade_date" in have else local.cast("date").alias("w_trade_date"),
        typed("w_trade_hour", T.first_int, "int") if "w_trade_hour" in have else (F.hour(local) + 1).alias("w_trade_hour"),
        *[typed(f, T.number, "double") for f in N.WEATHER_FEATURES],
        (F.col("src_order") if "src_order" in have else F.xxhash64(*sorted(df.columns))).alias("src_order"),
    ]
    df = df.select(*columns).withColumn("point_key", T.token(F.col("point")))
    return df.filter(F.col("w_valid_local").isNotNull() & (F.col("point_key") != "")), explicit


def latest_vintage(
    weather: DataFrame, key: list[str], min_lead_hours: int = 24, already_vintaged: bool = False
) -> DataFrame:
    """Per key the newest forecast issued at least `min_lead_hours` ahead, with its exact lead.

    Input columns: w_valid_utc, issue_utc, w_valid_local, issue_local, src_order. Unknown issue times rank lowest;
    among equal issue times the row that came last in the source wins.
    """
    times = [F.col(c) for c in ("w_valid_utc", "issue_utc", "w_valid_local", "issue_local")]
    if not already_vintaged:
        weather = weather.filter(eligible_vintage(*times, min_lead_hours))
    picked = newest_per_key(
        weather,
        key,
        [
            F.col("issue_utc").desc_nulls_last(),
            F.col("issue_local").desc_nulls_last(),
            F.col("src_order").desc(),
        ],
    )
    return picked.withColumn("lead_hours", lead_hours(*times))


def normalize_weather(raw: DataFrame, min_lead_hours: int = 24, already_vintaged: bool = False) -> DataFrame:
    """One row per (point, delivery hour); the key is the source's trade key if it has one, else the valid time."""
    typed, explicit = type_weather(raw, already_vintaged)
    key = ["point_key", "w_trade_date", "w_trade_hour"] if explicit else ["point_key", "w_valid_local"]
    return latest_vintage(typed, key, min_lead_hours, already_vintaged).withColumn("explicit_key", F.lit(explicit))
