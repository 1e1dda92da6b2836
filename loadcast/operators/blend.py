"""How much of the learned correction to use."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadcast import names as N
from loadcast.functions.rowwise import clip


def alpha_steps(grid_steps: int) -> list[float]:
    steps = max(int(grid_steps), 2)
    return [i / (steps - 1) for i in range(steps)]


def finite(*names: str) -> Column:
    ok = F.lit(True)
    for name in names:
        c = F.col(name)
        ok = ok & c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf")))
    return ok


def alpha_grid(
    df: DataFrame, keys: list[str], grid_steps: int = 21, baseline: str = "baseline", correction: str = "correction"
) -> DataFrame:
    """MAE of every alpha per key: `n`, `baseline_mae`, `alpha`, `mae`.

    One pass with one average per alpha (map-side combined); rows are not multiplied by the grid.
    """
    rows = df.filter(finite("actual", baseline, correction))
    alphas = alpha_steps(grid_steps)
    # Both inputs are finite here, so greatest() is a plain clip at zero.
    grid = [
        F.expr(f"avg(abs(greatest({baseline} + {a!r}D * {correction}, 0D) - actual)) as _a{i}")
        for i, a in enumerate(alphas)
    ]
    base_mae = F.expr(f"avg(abs(greatest({baseline}, 0D) - actual)) as baseline_mae")
    wide = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), base_mae, *grid)
    cells = ", ".join(f"named_struct('alpha', {a!r}D, 'mae', _a{i})" for i, a in enumerate(alphas))
    return wide.select(*keys, "n", "baseline_mae", F.expr(f"inline(array({cells}))"))


def select_alpha(
    df: DataFrame,
    keys: list[str],
    min_rows: int = 200,
    min_improvement: float = 0.02,
    grid_steps: int = 21,
    baseline: str = "baseline",
    correction: str = "correction",
) -> DataFrame:
    """One decision per key: alpha, n, baseline_mae, hybrid_mae, improvement, reason.

    The lowest MAE wins, the smallest alpha among equals. Alpha is 0 when there are too few rows, when the baseline is
    perfect, or when the gain stays below `min_improvement`.
    """
    grid = alpha_grid(df, keys, grid_steps, baseline, correction)
    best = grid.groupBy(*keys).agg(
        F.max("n").alias("n"),
        F.max("baseline_mae").alias("baseline_mae"),
        F.min(F.struct("mae", "alpha")).alias("best"),
    )
    gain = (F.col("baseline_mae") - F.col("best.mae")) / F.col("baseline_mae")
    few = F.col("n") < int(min_rows)
    perfect = F.col("baseline_mae") <= 0
    no_gain = (F.col("best.alpha") <= 0) | (gain < float(min_improvement))
    reason = (
        F.when(few, N.R_FEW_CALIBRATION).when(perfect, N.R_PERFECT).when(no_gain, N.R_NO_GAIN).otherwise(N.R_CHOSEN)
    )
    chosen = F.col("reason") == N.R_CHOSEN
    return best.withColumn("reason", reason).select(
        *keys,
        F.when(chosen, F.col("best.alpha")).otherwise(F.lit(0.0)).alias("alpha"),
        "n",
        F.when(~few, F.col("baseline_mae")).alias("baseline_mae"),
        F.when(chosen, F.col("best.mae")).when(~few, F.col("baseline_mae")).alias("hybrid_mae"),
        F.when(few | perfect, F.lit(0.0)).when(chosen, gain).otherwise(clip(gain, low=0.0)).alias("improvement"),
        "reason",
    )
