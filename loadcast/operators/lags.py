"""Same-hour lags by calendar day."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from loadcast.config import check_lag_days
from loadcast.functions.rowwise import lag_name, lag_statistics, series_key

CELL = ["series_id", "trade_date", "trade_hour"]
DEFAULT_LAGS = tuple(range(3, 15))


def history_cells(df: DataFrame) -> DataFrame:
    """Mean actual per (series, date, hour); keys without an actual keep NULL so that future hours get lags too."""
    return (
        df.filter(F.col("trade_date").isNotNull() & F.col("trade_hour").isNotNull())
        .groupBy(*CELL)
        .agg(F.avg("actual").alias("cell_mean"))
    )


def lag_cells(cells: DataFrame, lag_days: tuple[int, ...] = DEFAULT_LAGS) -> DataFrame:
    """All lags of every cell over one window: RANGE k PRECEDING on the day number, so gaps stay NULL.

    A partition is one hour of one series and holds one row per calendar day, however many source rows there were.
    """
    check_lag_days(lag_days)
    window = W.partitionBy("series_id", "trade_hour").orderBy("_day")
    cells = cells.withColumn("_day", F.unix_date("trade_date"))
    lags = {lag_name(k): F.avg("cell_mean").over(window.rangeBetween(-k, -k)) for k in lag_days}
    return cells.withColumns(lags).drop("_day", "cell_mean")


def add_lags(
    df: DataFrame, lag_days: tuple[int, ...] = DEFAULT_LAGS, history: DataFrame | None = None
) -> DataFrame:
    """Lag columns for every row of `df`.

    Rows are first averaged per cell (a map-side combined aggregate on five columns), the window runs on cells only,
    and the wide rows are then joined to their cell. A series that holds a third of all rows thus never sits in one
    window partition, and AQE can split a hot cell in the join. `history` may name narrower rows with the same keys.
    """
    keyed = df.withColumn("series_id", series_key())
    source = keyed if history is None else history.withColumn("series_id", series_key())
    lags = lag_cells(history_cells(source.select(*CELL, "actual")), lag_days)
    return keyed.join(lags, CELL, "left")


def add_lag_statistics(df: DataFrame, lag_days: tuple[int, ...] = DEFAULT_LAGS) -> DataFrame:
    for step in lag_statistics(lag_days):
        df = df.withColumns(step)
    return df
