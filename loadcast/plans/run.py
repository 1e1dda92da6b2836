"""The whole run: read, enrich, forecast, report, write."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from loadcast import names as N
from loadcast.config import ForecastConfig
from loadcast.operators import quality as Q
from loadcast.operators.energy import unknown_branches
from loadcast.operators.metrics import kpi_summary
from loadcast.plans.forecast import ForecastResult, run_forecast, with_predictions
from loadcast.plans.package import ForecastPackage, build_package, save_package
from loadcast.plans.prepare import join_prepared, prepare_energy
from loadcast.session import materialize
from loadcast.sinks import tables as OUT
from loadcast.sources import scan
from loadcast.sources.warehouse import empty_weather, infer_date_range, warehouse_extract


@dataclass
class RunOutput:
    result: ForecastResult
    quality: DataFrame
    kpi: DataFrame
    package: ForecastPackage


def run_from_files(
    spark: SparkSession,
    energy_path: str | list[str],
    weather_path: str | list[str],
    mapping_path: str,
    output_path: str,
    config: ForecastConfig = ForecastConfig(),
    part_regex: str | None = None,
    csv: bool = False,
) -> RunOutput:
    mapping = scan.scan_mapping(spark, mapping_path)
    energy, quality = prepare_energy(scan.scan_energy(spark, energy_path, part_regex=part_regex), mapping, config)
    joined, join_quality = join_prepared(energy, scan.scan_weather(spark, weather_path), config)
    quality = Q.append_quality(quality, join_quality)
    source = {"weather_source": "file", "weather_path": weather_path, "weather_start": config.weather_start}
    return _finish(energy, joined, quality, mapping, source, output_path, config, csv)


def run_from_warehouse(
    spark: SparkSession,
    energy_path: str | list[str],
    weather_view: DataFrame,
    mapping_path: str,
    output_path: str,
    owner: str,
    forecast_type: str,
    config: ForecastConfig = ForecastConfig(),
    valid_from: object = None,
    valid_to: object = None,
    points: list[str] | None = None,
    part_regex: str | None = None,
    csv: bool = False,
) -> RunOutput:
    """As above with weather from a warehouse view; the view is not read when all energy precedes the weather start."""
    mapping = scan.scan_mapping(spark, mapping_path)
    energy, quality = prepare_energy(scan.scan_energy(spark, energy_path, part_regex=part_regex), mapping, config)
    low, high = infer_date_range(energy, valid_from, valid_to, config.weather_start)
    if low is None:
        weather, n = empty_weather(spark), 0
    else:
        weather = warehouse_extract(weather_view, low, high, config.min_lead_hours, owner, forecast_type, points)
        n = weather.count()
        if n == 0:
            raise ValueError("the warehouse extract returned no weather rows")
    joined, join_quality = join_prepared(energy, weather, config)
    quality = Q.append_quality(quality, join_quality, Q.source_quality(spark, n, low, high))
    source = {"weather_source": "warehouse", "valid_from": str(low), "valid_to": str(high)}
    return _finish(energy, joined, quality, mapping, source, output_path, config, csv)


def _finish(energy, joined, quality, mapping, source, output_path, config, csv) -> RunOutput:
    spark = joined.sparkSession
    # Lags need energy only, so their history is read without the weather join.
    result = run_forecast(joined, config, history=energy)
    # Many outputs read the predictions, so they are written once.
    result = with_predictions(result, materialize(result.predictions, "predictions"))
    predictions = result.predictions
    quality = Q.append_quality(
        quality,
        Q.run_quality(spark, predictions.count(), config),
        Q.status_quality(predictions),
        Q.model_quality(spark, result.models),
    )
    kpi = kpi_summary(predictions, result.metrics, [d for d in N.DIRECTIONS if result.models[d].model is not None])
    package = build_package(result, config, mapping.drop("src_order"))
    root = output_path.rstrip("/")
    write = OUT.write_csv if csv else OUT.write_parquet
    OUT.write_predictions(predictions, f"{root}/predictions", config.compact_output, config.oof_output_only, csv)
    write(result.metrics, f"{root}/metrics")
    write(quality, f"{root}/quality")
    write(unknown_branches(energy), f"{root}/unknown_branches")
    write(mapping.drop("src_order"), f"{root}/mapping")
    write(kpi, f"{root}/kpi")
    if result.importance is not None:
        write(result.importance, f"{root}/importance")
    save_package(package, f"{root}/package")
    facts = {"schema_version": package.version, **package.facts}
    OUT.write_manifest(spark, OUT.manifest(result, config, source, facts), f"{root}/manifest")
    return RunOutput(result, quality, kpi, package)
