"""Run configuration: option groups whose bounds stand beside each field, presets and checks."""

from __future__ import annotations

from dataclasses import dataclass, field, fields, replace
from typing import Any


def option(default: Any, low: float | None = None, high: float | None = None, below: float | None = None, one_of: tuple = ()) -> Any:
    """A field with its bounds: low <= value <= high, value < below, or one of a few words. None is always allowed."""
    return field(default=default, metadata={"low": low, "high": high, "below": below, "one_of": one_of})


# The defaults of all groups must be those of the studied pipeline.
@dataclass(frozen=True)
class BlendOptions:
    """Share of the correction that is added, picked on the window before each test window."""

    min_improvement: float = option(0.02, low=0, below=1)
    grid_steps: int = option(21, low=2)
    calibration_days: int = option(7, low=1)
    min_calibration_rows: int = option(200, low=1)


@dataclass(frozen=True)
class FitOptions:
    """The residual model; `max_train_rows` bounds what one fit reads and nothing else."""

    backend: str = option("leaf_limited", one_of=("leaf_limited", "depth_limited"))
    max_iter: int = option(220, low=1)
    tree_depth: int = option(8, low=1)
    step_size: float = 0.06
    seed: int = 42
    min_train_rows: int = option(200, low=1)
    max_train_rows: int | None = option(None, low=1)
    parallel_fits: int = option(2, low=1)


@dataclass(frozen=True)
class FoldOptions:
    n_splits: int = option(3, low=1)
    validation_days: int = option(14, low=1)
    compute_importance: bool = True


@dataclass(frozen=True)
class TimeOptions:
    timezone: str = "Europe/Warsaw"
    lag_days: tuple[int, ...] = tuple(range(3, 15))
    min_lead_hours: int = option(24, low=0, high=720)
    weather_start: str | None = "2024-10-01"
    already_vintaged: bool = False


@dataclass(frozen=True)
class SourceOptions:
    """`max_input_rows` is the caller's own wish to read a head or tail of the source; no preset sets it."""

    row_selection: str = option("head", one_of=("head", "tail"))
    max_input_rows: int | None = option(None, low=1)


@dataclass(frozen=True)
class OutputOptions:
    profile: str = "standard"
    score_full_history: bool = True
    oof_output_only: bool = False
    compact_output: bool = False


@dataclass(frozen=True)
class ForecastConfig(OutputOptions, SourceOptions, TimeOptions, FoldOptions, FitOptions, BlendOptions):
    """All options of a run, as flat attributes."""

    def validate(self) -> ForecastConfig:
        faults = [fault for f in fields(self) if (fault := _fault(f.name, getattr(self, f.name), f.metadata))]
        if self.max_train_rows is not None and self.max_train_rows < self.min_train_rows:
            faults.append("max_train_rows is below min_train_rows")
        if faults:
            raise ValueError("; ".join(faults))
        check_lag_days(self.lag_days)
        return self


def _fault(name: str, value: Any, bounds: Any) -> str | None:
    if value is None or not bounds:
        return None
    if bounds["one_of"] and value not in bounds["one_of"]:
        return f"{name} must be one of {bounds['one_of']}, not {value!r}"
    outside = (
        (bounds["low"] is not None and value < bounds["low"])
        or (bounds["high"] is not None and value > bounds["high"])
        or (bounds["below"] is not None and value >= bounds["below"])
    )
    return f"{name}={value!r} is out of bounds" if outside else None


def check_lag_days(lag_days: tuple[int, ...]) -> None:
    if not lag_days or any(int(d) < 1 for d in lag_days):
        raise ValueError("lag_days must hold positive day counts")
    if len(set(lag_days)) != len(lag_days):
        raise ValueError("lag_days must not repeat")


def fast_profile(config: ForecastConfig = ForecastConfig()) -> ForecastConfig:
    """Bounded fits: each reads the newest 100,000 rows of its training set. All input rows are read and forecast."""
    return replace(config, profile="fast_30min", max_train_rows=config.max_train_rows or 100_000)


def full_training_profile(config: ForecastConfig = ForecastConfig()) -> ForecastConfig:
    """All rows, one 7-day fold, 180 trees of depth 6, no importance, OOF and future output only."""
    fit = {"backend": "depth_limited", "max_iter": 180, "tree_depth": 6}
    folds = {"n_splits": 1, "validation_days": 7, "compute_importance": False}
    output = {"score_full_history": False, "oof_output_only": True, "compact_output": True}
    return replace(config, profile="full_training", row_selection="tail", **fit, **folds, **output)
