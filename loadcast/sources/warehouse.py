"""Weather vintages from a warehouse view: filters, date range, JDBC and named-parameter SQL."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loadcast import names as N
from loadcast.functions.text import to_day
from loadcast.functions.times import hours, lead_hours_by_minute
from loadcast.operators.vintage import newest_per_key
from loadcast.sources.scan import rename_by_alias

_KEY = ["point", "w_trade_date", "w_trade_hour"]


def as_datetime(value: object, name: str) -> dt.datetime:
    if value is None:
        raise ValueError(f"{name} must not be empty")
    try:
        moment = value if isinstance(value, dt.datetime) else dt.datetime.fromisoformat(str(value))
    except ValueError as exc:
        raise ValueError(f"{name} is not a date: {value!r}") from exc
    return moment.replace(microsecond=0)


def query_parameters(
    valid_from: object, valid_to: object, min_lead_hours: int, owner: str, forecast_type: str
) -> dict[str, object]:
    """The five checked parameters of the extract, by name."""
    lead = int(min_lead_hours)
    if not 0 <= lead <= 720:
        raise ValueError("min_lead_hours must lie in 0..720")
    low, high = as_datetime(valid_from, "valid_from"), as_datetime(valid_to, "valid_to")
    if low >= high:
        raise ValueError("valid_from must be before valid_to")
    if not str(owner).strip() or not str(forecast_type).strip():
        raise ValueError("owner and forecast_type must not be empty")
    return {
        "valid_from": low,
        "valid_to": high,
        "min_lead_hours": lead,
        "owner": str(owner).strip(),
        "forecast_type": str(forecast_type).strip(),
    }


def _wall_clock(moment: dt.datetime) -> Column:
    """A wall-clock literal by its text; a datetime would be shifted by the driver's zone."""
    return F.lit(moment.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp_ntz")


def ordered_extract(rows: DataFrame) -> DataFrame:
    """The extract in the order of its source query (point, delivery time): ranges over tasks, sorted in each, so that
    files written from it are in order one after another without a sort in one task."""
    order = ["point", "w_valid_local"]
    return rows.repartitionByRange(*order).sortWithinPartitions(*order)


def warehouse_extract(
    view: DataFrame,
    valid_from: object,
    valid_to: object,
    min_lead_hours: int,
    owner: str,
    forecast_type: str,
    points: list[str] | None = None,
) -> DataFrame:
    """Newest eligible vintage per (point, trade date, trade hour).

    All conditions are plain comparisons on source columns and come before the per-key pick, so they reach the
    Parquet or JDBC scan. Ties on the issue time go to the highest exec_id.
    """
    p = query_parameters(valid_from, valid_to, min_lead_hours, owner, forecast_type)
    df = rename_by_alias(view, {**N.WEATHER_ALIASES, **N.WAREHOUSE_ALIASES})
    rows = df.filter(
        F.col("point").isin(points or N.WEATHER_POINTS)
        & (F.col("owner") == p["owner"])
        & (F.col("forecast_type") == p["forecast_type"])
        & (F.col("is_last_in_batch") == 1)
        & (F.col("w_valid_local") >= _wall_clock(p["valid_from"]))
        & (F.col("w_valid_local") < _wall_clock(p["valid_to"]))
        & F.col("issue_utc").isNotNull()
        & (F.col("issue_utc") <= F.col("w_valid_utc") - hours(p["min_lead_hours"]))
    )
    picked = newest_per_key(rows, _KEY, [F.col("issue_utc").desc(), F.col("exec_id").desc()])
    return picked.withColumn("lead_hours_sql", lead_hours_by_minute(F.col("w_valid_utc"), F.col("issue_utc"))).drop(
        "owner", "forecast_type", "is_last_in_batch"
    )


def read_jdbc(spark: SparkSession, url: str, table: str, **options: str) -> DataFrame:
    """A warehouse view over JDBC; pass partitionColumn/lowerBound/upperBound/numPartitions to read in parallel."""
    return spark.read.format("jdbc").options(url=url, dbtable=table, **options).load()


def query_sql(spark: SparkSession, text: str, parameters: dict[str, object] | None = None) -> DataFrame:
    """Run the caller's own extract on registered views; `:name` markers are bound, never pasted."""
    df = spark.sql(text, args=parameters or {})
    return df.toDF(*[c.strip() for c in df.columns])


def infer_date_range(
    energy: DataFrame,
    valid_from: object = None,
    valid_to: object = None,
    weather_start: object = None,
) -> tuple[dt.datetime | None, dt.datetime]:
    """Half-open range of delivery dates, its lower end raised to the weather start.

    (None, end) means that all energy lies before the weather start, so the weather source need not be read.
    """
    low = high = None
    if valid_from is None or valid_to is None:
        day = energy.select(to_day(F.col("trade_date"), dict(energy.dtypes)["trade_date"]).alias("d"))
        low, high = day.agg(F.min("d"), F.max("d")).first()
        if low is None:
            raise ValueError("no readable trade_date: give valid_from and valid_to")
    start = as_datetime(valid_from if valid_from is not None else low, "valid_from")
    end = as_datetime(valid_to, "valid_to") if valid_to is not None else as_datetime(high, "valid_to") + dt.timedelta(1)
    if start >= end:
        raise ValueError("valid_from must be before valid_to")
    if weather_start is not None:
        available = as_datetime(weather_start, "weather_start").replace(hour=0, minute=0, second=0)
        if end <= available:
            return None, end
        start = max(start, available)
    return start, end


def empty_weather(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], "point string, w_valid_local timestamp_ntz, issue_local timestamp_ntz")
