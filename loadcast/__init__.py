"""Hourly load forecasting on Spark DataFrames."""

from loadcast.config import ForecastConfig, fast_profile, full_training_profile
from loadcast.plans.forecast import ForecastResult, run_forecast
from loadcast.plans.package import ForecastPackage, build_package, load_package, save_package, score_package
from loadcast.plans.prepare import prepare_joined
from loadcast.plans.run import run_from_files, run_from_warehouse

__all__ = [
    "ForecastConfig",
    "ForecastPackage",
    "ForecastResult",
    "build_package",
    "fast_profile",
    "full_training_profile",
    "load_package",
    "prepare_joined",
    "run_forecast",
    "run_from_files",
    "run_from_warehouse",
    "save_package",
    "score_package",
]
