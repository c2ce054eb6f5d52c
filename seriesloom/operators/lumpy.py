"""Features and classes for intermittent demand."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seriesloom.functions.numeric import ratio
from seriesloom.spec import SeriesSpec


def _past_or_current(n: int, past: bool) -> tuple[int, int]:
    return (-n, -1) if past else (-(n - 1), 0)


def order_frequency(
    value: Column, spec: SeriesSpec, windows: tuple[int, ...], name: str = "Order", past: bool = True
) -> dict[str, Column]:
    """Share of rows above zero and share of zero rows in the window.

    ``past=False`` takes the current row in, as the older variants do.
    """
    out: dict[str, Column] = {}
    for n in windows:
        f = spec.frame(*_past_or_current(n, past))
        out[f"{name}_Frequency_{n}d"] = F.avg((value > 0).cast("double")).over(f)
        out[f"Zero_Frequency_{n}d"] = F.avg((value == 0).cast("double")).over(f)
    return out


def nonzero_count(value: Column, spec: SeriesSpec, windows: tuple[int, ...], name: str) -> dict[str, Column]:
    """Rows above zero in the full trailing window with the current row."""
    out: dict[str, Column] = {}
    for n in windows:
        f = spec.frame(-(n - 1), 0)
        out[f"NonZero_{name}_{n}d"] = F.when(
            F.count(F.lit(1)).over(f) == n, F.sum((value > 0).cast("int")).over(f)
        )
    return out


def nonzero_mean_var(value: Column, spec: SeriesSpec, windows: tuple[int, ...], suffix: str = "d") -> dict[str, Column]:
    """Mean and variance of the positive values among the n rows before; 0 where undefined."""
    positive = F.when(value > 0, value)
    out: dict[str, Column] = {}
    for n in windows:
        f = spec.frame(-n, -1)
        out[f"NonZero_Avg_Order_{n}{suffix}"] = F.coalesce(F.avg(positive).over(f), F.lit(0.0))
        out[f"NonZero_Order_Variance_{n}{suffix}"] = F.coalesce(F.var_samp(positive).over(f), F.lit(0.0))
    return out


def max_var(value: Column, spec: SeriesSpec, windows: tuple[int, ...]) -> dict[str, Column]:
    """Largest order, variance and deviation of the trailing window with the current row, 0 where undefined."""
    zero = F.lit(0.0)
    out: dict[str, Column] = {}
    for n in windows:
        f = spec.frame(-(n - 1), 0)
        out[f"Max_Order_Size_{n}d"] = F.coalesce(F.max(value).over(f), zero)
        out[f"Order_Size_Variance_{n}d"] = F.coalesce(F.var_samp(value).over(f), zero)
        out[f"Demand_Variability_{n}d"] = F.coalesce(F.stddev_samp(value).over(f), zero)
    return out


def zero_run_window(value: Column, spec: SeriesSpec, windows: tuple[int, ...]) -> dict[str, Column]:
    """Zero rows among the n rows before, 0 on the first row."""
    return {
        f"days_since_order_{n}": F.coalesce(
            F.sum((value == 0).cast("int")).over(spec.frame(-n, -1)), F.lit(0)
        )
        for n in windows
    }


def cumulative_zeros(value: Column, spec: SeriesSpec) -> Column:
    """Count of rows without an order since the start, shown as 0 on rows with one.

    It never resets; ``days_since_order`` is the gap its usual name promises.
    """
    running = F.sum((~(value > 0)).cast("int")).over(spec.frame(Window.unboundedPreceding, 0))
    return F.when(value > 0, F.lit(0)).otherwise(running)


def days_since_order(value: Column, spec: SeriesSpec) -> Column:
    """Days since the last row above zero; null before the first."""
    last = F.last(F.when(value > 0, spec.t()), ignorenulls=True)
    return F.datediff(spec.t(), last.over(spec.frame(Window.unboundedPreceding, 0)))


def recent_zeros(value: Column, spec: SeriesSpec, n: int = 7) -> Column:
    """Rows without an order among the last n rows, 0 on rows with one (test-row variant)."""
    recent = F.sum((~(value > 0)).cast("int")).over(spec.frame(-(n - 1), 0))
    return F.when(value > 0, F.lit(0)).otherwise(recent)


# Limits of the demand classes.
SMOOTH_CV, ERRATIC_CV = 0.5, 1.0
MIN_NONZERO_SHARE = 0.7


def demand_pattern(cv: Column) -> Column:
    """Coefficient of variation -> Smooth, Erratic or Lumpy; null stays null."""
    return (
        F.when(cv <= SMOOTH_CV, "Smooth")
        .when((cv > SMOOTH_CV) & (cv <= ERRATIC_CV), "Erratic")
        .when(cv > ERRATIC_CV, "Lumpy")
    )


def smooth_flags(df: DataFrame, keys: list[str], value: str, cv_limit: float = SMOOTH_CV, share: float = MIN_NONZERO_SHARE) -> DataFrame:
    """Per series: population CV of positive demand, share of positive rows, and whether it is smooth."""
    positive = F.when(F.col(value) > 0, F.col(value))
    stats = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        ratio(F.stddev_pop(positive), F.avg(positive)).alias("nonzero_cv"),
        F.avg((F.col(value) > 0).cast("double")).alias("nonzero_share"),
    )
    smooth = F.coalesce((F.col("nonzero_cv") <= cv_limit) & (F.col("nonzero_share") >= share), F.lit(False))
    return stats.withColumn("is_smooth", smooth)
