"""Quality rows about a whole run: source, limits, row status, final models."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loadcast import names as N
from loadcast.config import ForecastConfig

SCHEMA = "check string, count long, details string"


def append_quality(*blocks: DataFrame) -> DataFrame:
    out = blocks[0]
    for block in blocks[1:]:
        out = out.unionByName(block)
    return out


def run_quality(spark: SparkSession, rows: int, config: ForecastConfig) -> DataFrame:
    """Profile and limits of a run; -1 stands for "no limit"."""
    return spark.createDataFrame(
        [
            ("run_profile", rows, config.profile),
            ("input_row_limit", config.max_input_rows or -1, f"selection={config.row_selection}; -1 means whole source"),
            ("training_row_limit", config.max_train_rows or -1, "per direction; -1 means all usable rows"),
        ],
        SCHEMA,
    )


def source_quality(spark: SparkSession, weather_rows: int, valid_from: object, valid_to: object) -> DataFrame:
    skipped = valid_from is None
    low = "skipped: all energy lies before the weather start" if skipped else str(valid_from)
    return spark.createDataFrame(
        [
            ("weather_source_rows", weather_rows, "warehouse"),
            ("warehouse_valid_from", 0, low),
            ("warehouse_valid_to", 0, str(valid_to)),
        ],
        SCHEMA,
    )


def status_quality(predictions: DataFrame) -> DataFrame:
    status = F.col("prediction_status")
    checks = [
        ("oof_rows", F.count_if(status == N.P_OOF), ""),
        ("future_rows", F.count_if(status == N.P_FUTURE), ""),
        (
            "future_without_weather",
            F.count_if(F.coalesce(F.col("without_weather"), F.lit(False))),
            "forecast from energy history and calendar only",
        ),
        ("historical_gaps", F.count_if(status == N.P_GAP), "not counted as future"),
        ("warmup_rows", F.count_if(status == N.P_WARMUP), ""),
    ]
    stats = predictions.agg(*[c.alias(name) for name, c, _ in checks])
    cells = [x for name, _, details in checks for x in (F.lit(name), F.col(name), F.lit(details))]
    return stats.select(F.stack(F.lit(len(checks)), *cells).alias("check", "count", "details"))


def model_quality(spark: SparkSession, models: dict) -> DataFrame:
    """One line per direction and topic; the input is the handful of final model entries."""
    rows = [("final_models", len(models), ", ".join(sorted(models)))]
    for d, a in sorted(models.items()):
        rows.append(
            (
                f"calibration_{d.lower()}",
                a.calibration_n,
                f"alpha={a.alpha:.3f}; mae_gain={a.calibration_improvement:.2%}; decision={a.calibration_reason}; "
                f"target={a.target}; train_rows={a.train_rows}; history_rows={a.history_rows}",
            )
        )
        rows.append(
            (
                f"training_{d.lower()}",
                a.train_rows,
                f"used {a.train_rows} of {a.history_rows} historical rows; the others had no lag baseline",
            )
        )
    return spark.createDataFrame(rows, SCHEMA)
