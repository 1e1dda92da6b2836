"""Expanding backtest windows, training rows, calibration windows and row status."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadcast import names as N

_USE = "struct<role:string,fold:int,set_id:string,model:int>"


@dataclass(frozen=True)
class Fold:
    number: int
    start: dt.datetime
    end: dt.datetime


def forecast_cutoff(df: DataFrame) -> dt.datetime | None:
    """Last UTC hour with an actual."""
    # Through timestamp_ntz: the driver's own time zone must not shift the value.
    return df.filter(F.col("actual").isNotNull()).agg(F.max("model_utc").cast("timestamp_ntz")).first()[0]


def expanding_splits(cutoff: dt.datetime | None, n_splits: int, validation_days: int) -> list[Fold]:
    """Consecutive test windows that end at the close of the cutoff's UTC day."""
    if cutoff is None:
        return []
    end = cutoff.replace(hour=0, minute=0, second=0, microsecond=0) + dt.timedelta(days=1)
    width = dt.timedelta(days=validation_days)
    first = end - n_splits * width
    return [Fold(k + 1, first + k * width, first + (k + 1) * width) for k in range(n_splits)]


def instant(value: dt.datetime) -> Column:
    return F.lit(value.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp")


def trainable() -> Column:
    """Rows that may train or be scored: an actual that is not negative."""
    return F.col("actual").isNotNull() & (F.col("actual") >= 0)


def fold_number(folds: list[Fold], utc: Column | None = None) -> Column:
    """Fold whose test window holds the row; NULL outside all windows."""
    utc = F.col("model_utc") if utc is None else utc
    out = F.lit(None).cast("int")
    for f in folds:
        out = F.when((utc >= instant(f.start)) & (utc < instant(f.end)), F.lit(f.number)).otherwise(out)
    return out


def calibration_part(start: dt.datetime, calibration_days: int, utc: Column | None = None) -> Column:
    """'FIT' before the calibration window, 'CALIBRATION' inside [start - days, start), else NULL."""
    utc = F.col("model_utc") if utc is None else utc
    begin = start - dt.timedelta(days=calibration_days)
    return F.when(utc < instant(begin), "FIT").when((utc >= instant(begin)) & (utc < instant(start)), "CALIBRATION")


def training_sets(df: DataFrame, folds: list[Fold], calibration_days: int, final: bool = True) -> DataFrame:
    """Trainable rows once per training set they belong to, tagged `set_id`.

    TEST_k holds everything before fold k, CAL_k everything before fold k's calibration window, FINAL all history.
    """
    utc = F.col("model_utc")
    tags = []
    for f in folds:
        begin = f.start - dt.timedelta(days=calibration_days)
        tags.append(F.when(utc < instant(f.start), F.lit(f"TEST_{f.number}")))
        tags.append(F.when(utc < instant(begin), F.lit(f"CAL_{f.number}")))
    if final:
        tags.append(F.when(utc.isNotNull(), F.lit("FINAL")))
    rows = df.filter(trainable())
    return rows.withColumn("set_id", F.explode(_present(tags, "string")))


def _present(items: list[Column], kind: str) -> Column:
    """Array of the items that are not NULL; unlike a filter with a lambda it is compiled with the rest of the stage."""
    none = F.array().cast(f"array<{kind}>")
    return F.flatten(F.array(*[F.when(x.isNotNull(), F.array(x)).otherwise(none) for x in items]))


def scoring_roles(df: DataFrame, pairs: list[tuple[Fold, str, int | None, bool]], calibration_days: int) -> DataFrame:
    """Trainable rows once per use in the backtest: `role` (TEST or CAL), `fold`, `set_id` of their medians, `model`.

    `pairs` lists fold, direction, the number of the model that scores them (None: no model) and whether the model is
    calibrated. Windows of calibration may overlap, so a row can have several uses; all are told in one pass.
    """
    utc, uses = F.col("model_utc"), []

    def use(f: Fold, d: str, inside: Column, role: str, model: int | None) -> Column:
        number = F.lit(model).cast("int")
        told = F.struct(
            F.lit(role).alias("role"), F.lit(f.number).alias("fold"), F.lit(f"{role}_{f.number}").alias("set_id"), number.alias("model")
        )
        return F.when((F.col("direction") == d) & inside, told)

    for f, d, model, calibrated in pairs:
        uses.append(use(f, d, (utc >= instant(f.start)) & (utc < instant(f.end)), "TEST", model))
        if calibrated:
            uses.append(use(f, d, calibration_part(f.start, calibration_days) == "CALIBRATION", "CAL", model))
    # Most rows lie in no window; they are left out before any list is made.
    some = reduce(Column.__or__, [u.isNotNull() for u in uses], F.lit(False))
    return df.filter(trainable() & some).select("*", F.inline(_present(uses, _USE)))


def fold_counts(df: DataFrame, folds: list[Fold], calibration_days: int) -> DataFrame:
    """Rows per (direction, fold): history, fit, usable fit, calibration, test - one aggregate for all folds."""
    utc = F.col("model_utc")
    rows = df.filter(trainable() & utc.isNotNull())
    natural = F.col("baseline").isNotNull()
    parts = []
    for f in folds:
        part = calibration_part(f.start, calibration_days)
        parts.append(
            F.struct(
                F.lit(f.number).alias("fold"),
                F.count_if(utc < instant(f.start)).alias("history"),
                F.count_if(part == "FIT").alias("fit"),
                F.count_if((part == "FIT") & natural).alias("usable_fit"),
                F.count_if(part == "CALIBRATION").alias("calibration"),
                F.count_if((utc >= instant(f.start)) & (utc < instant(f.end))).alias("test"),
            )
        )
    return rows.groupBy("direction").agg(F.array(*parts).alias("p")).select("direction", F.inline("p"))


def prediction_status(cutoff: dt.datetime | None) -> Column:
    """Status before scoring; OOF and FUTURE are set later on the rows that get a forecast."""
    utc, no_actual = F.col("model_utc"), F.col("actual").isNull()
    status = F.when(F.col("direction").isNull() | ~F.col("direction").isin(N.DIRECTIONS), N.P_NO_DIRECTION)
    status = status.when(utc.isNull(), N.P_NO_UTC)
    if cutoff is None:
        status = status.when(no_actual, N.P_GAP)
    else:
        status = status.when(no_actual & (utc > instant(cutoff)), N.P_AWAITING).when(no_actual, N.P_GAP)
    return status.otherwise(N.P_WARMUP)
