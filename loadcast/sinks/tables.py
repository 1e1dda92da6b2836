"""Result tables: column sets, Parquet, locale CSV, per-part output, manifest."""

from __future__ import annotations

import json
from dataclasses import asdict
from functools import reduce
from typing import Any, NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadcast import names as N
from loadcast.plans.forecast import ForecastResult
from loadcast.session import materialize

TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
#: Rows that one task puts in order for a file in order.
SORT_ROWS = 500_000


class Group(NamedTuple):
    """Columns that one step of the pipeline makes; `core` ones also belong to the compact output."""

    step: str
    core: tuple[str, ...] = ()
    other: tuple[str, ...] = ()


#: What a prediction row consists of, by the step that owns the columns. Which columns are core. Readers go by
#: names, so the order is that of the steps.
GROUPS = (
    Group("scan", core=("source_sheet", "source_row")),
    Group("series", core=tuple(c for c in N.SERIES_COLUMNS if c != "kind"), other=("kind",)),
    Group("energy", core=("trade_date", "trade_hour", "actual"), other=("direction_text", "direction_code", "direction_source")),
    Group("place", core=("point",)),
    Group("time", other=("valid_local", "model_utc", "forecast_cutoff_utc")),
    Group("weather match", core=("weather_matched", "weather_status", "without_weather")),
    Group("vintage", other=("w_valid_local", "issue_local", "issue_utc", "lead_hours", "weather_available")),
    Group("weather", other=tuple(N.WEATHER_FEATURES)),
    Group("lags", core=("lag_count", "feature_count")),
    Group("folds", core=("fold", "prediction_status")),
    Group("baseline", core=("baseline_backtest", "residual_actual")),
    Group("correction", core=("correction", "raw_candidate"), other=("full_model", "full_model_in_sample")),
    Group("blend", core=("forecast", "blend_alpha", "strategy")),
    Group("calibration", core=tuple(f"calibration_{c}" for c in ("n", "improvement", "reason"))),
    Group("errors", core=("error", "abs_error")),
)
COMPACT = [c for g in GROUPS for c in g.core]
FULL = [c for g in GROUPS for c in (*g.core, *g.other)]


def output_columns(df: DataFrame, compact: bool = False) -> list[str]:
    have = set(df.columns)
    return [c for c in (COMPACT if compact else FULL) if c in have]


def exported_rows(predictions: DataFrame, oof_only: bool = False) -> DataFrame:
    if not oof_only:
        return predictions
    return predictions.filter(F.col("prediction_status").isin(N.P_OOF, N.P_FUTURE))


def write_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def locale_text(df: DataFrame) -> DataFrame:
    """Doubles and decimals as text with a decimal comma; all other columns unchanged."""
    numeric = (T.DoubleType, T.FloatType, T.DecimalType)
    return df.withColumns(
        {
            f.name: F.regexp_replace(F.col(f.name).cast("string"), r"\.", ",")
            for f in df.schema.fields
            if isinstance(f.dataType, numeric)
        }
    )


def write_csv(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Semicolon, decimal comma, fixed time format, header; UTF-8 without a byte order mark."""
    writer = locale_text(df).write.mode("overwrite").options(
        sep=";", header=True, timestampFormat=TIME_FORMAT, timestampNTZFormat=TIME_FORMAT, dateFormat="yyyy-MM-dd"
    )
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.csv(path)


def in_one_partition(df: DataFrame, order: Column, sort_rows: int = SORT_ROWS) -> DataFrame:
    """All rows in order in a single partition, for a format that wants one file, without a task that holds them all.

    Ranges of the order are sorted side by side and written first. The last task only passes their rows on, range by range.
    """
    ranges = max(1, -(-df.count() // sort_rows))
    parts = materialize(df.repartitionByRange(ranges, order).sortWithinPartitions(order), "in_order")
    files = sorted(parts.inputFiles())
    frames = [df.sparkSession.read.schema(df.schema).parquet(f) for f in files]
    return reduce(DataFrame.unionByName, frames, df.limit(0)).coalesce(1)


def safe_part(name: str):
    """Part names reduced to letters, digits, '-' and '_'."""
    return F.regexp_replace(F.coalesce(F.col(name).cast("string"), F.lit("none")), r"[^\p{L}\p{N}_-]", "_")


def write_predictions(predictions: DataFrame, path: str, compact: bool, oof_only: bool, csv: bool = False) -> None:
    """Predictions split into one folder per source part."""
    out = exported_rows(predictions, oof_only)
    columns = output_columns(out, compact)
    chosen = out.select(*columns, safe_part("source_sheet").alias("part"))
    (write_csv if csv else write_parquet)(chosen, path, ["part"])


def manifest(result: ForecastResult, config: Any, source: dict[str, Any], package_facts: dict[str, Any]) -> dict:
    return {
        "config": asdict(config),
        "source": source,
        "categorical_features": result.spec.categorical,
        "numeric_features": result.spec.numeric,
        "package": package_facts,
        "note": (
            "HYBRID metrics use out-of-sample forecasts only. Each fold's alpha comes from the window before its test "
            "window; the alpha of a final model comes from all out-of-fold rows. alpha=0 is the plain baseline. "
            "full_model on historical rows is in-sample and is not used for evaluation."
        ),
    }


def write_manifest(spark, document: dict, path: str) -> None:
    row = spark.createDataFrame([(json.dumps(document, ensure_ascii=False),)], "value string")
    row.write.mode("overwrite").text(path)
