"""From source files to enriched energy rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loadcast.config import ForecastConfig
from loadcast.operators import energy as EN
from loadcast.operators import enrich as J
from loadcast.operators import vintage as V
from loadcast.session import materialize, plan_bytes, require_utc, tune
from loadcast.sources import scan
from loadcast.sources.limits import input_limit_report, limit_input


def prepare_energy(raw: DataFrame, mapping: DataFrame, config: ForecastConfig) -> tuple[DataFrame, DataFrame]:
    """Normalised energy and its quality rows. `raw` comes from `scan_energy`."""
    require_utc(raw.sparkSession)
    tune(raw.sparkSession, plan_bytes(raw))
    used = limit_input(raw, config.max_input_rows, config.row_selection)
    # The text is parsed once; counts, modes, lags and quality read the typed table.
    energy = materialize(EN.normalize_energy(used, mapping), "energy")
    total = raw.count() if config.max_input_rows is not None else F.col("used")
    quality = EN.energy_quality(energy).unionByName(input_limit_report(total, energy, config.row_selection))
    return energy, quality


def join_prepared(energy: DataFrame, weather_raw: DataFrame, config: ForecastConfig) -> tuple[DataFrame, DataFrame]:
    """Enriched energy and the quality rows of the join."""
    typed, explicit = V.type_weather(weather_raw, config.already_vintaged)
    mode = J.choose_join_mode(energy, typed, explicit)
    weather = V.normalize_weather(weather_raw, config.min_lead_hours, config.already_vintaged)
    if explicit and mode == J.VALID_TIME:
        repeated = J.duplicate_keys(weather, ["point_key", "w_valid_local"])
        if not repeated.isEmpty():
            raise ValueError("weather is not unique per point and valid time")
    joined = J.enrich(energy, weather, mode, config.timezone, config.weather_start)
    return joined, J.join_quality(joined, mode, config.weather_start)


def prepare_joined(
    spark: SparkSession,
    energy_path: str | list[str],
    weather_path: str | list[str],
    mapping_path: str,
    config: ForecastConfig = ForecastConfig(),
    part_regex: str | None = None,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(enriched energy, quality rows, mapping) from files."""
    mapping = scan.scan_mapping(spark, mapping_path)
    raw = scan.scan_energy(spark, energy_path, part_regex=part_regex)
    energy, energy_quality = prepare_energy(raw, mapping, config)
    joined, join_quality = join_prepared(energy, scan.scan_weather(spark, weather_path), config)
    return joined, energy_quality.unionByName(join_quality), mapping
