"""Forecast scores.

All scores are single-pass aggregates with partial aggregation before the shuffle;
sums of squares around a mean come from the population variance, which is stable
and needs no second pass.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seriesloom.functions.numeric import corr


def _a() -> Column:
    return F.col("actual")


def _p() -> Column:
    return F.col("predicted")


def _rmse() -> Column:
    return F.sqrt(F.avg(F.pow(_a() - _p(), F.lit(2.0))))


def _mae() -> Column:
    return F.avg(F.abs(_a() - _p()))


def _mape_nonzero() -> Column:
    return F.avg(F.when(_a() != 0, F.abs((_a() - _p()) / F.nullif(_a(), F.lit(0.0))))) * F.lit(100.0)


def _ss_res() -> Column:
    return F.sum(F.pow(_a() - _p(), F.lit(2.0)))


def _ss_tot() -> Column:
    return F.var_pop(_a()) * F.count(_a())


def _r2_det(flat_perfect: float = 1.0, flat_other: float = 0.0) -> Column:
    """1 - SSres/SStot with fixed values when the actuals are constant."""
    res, tot = _ss_res(), _ss_tot()
    return F.when(tot == 0, F.when(res == 0, F.lit(flat_perfect)).otherwise(F.lit(flat_other))).otherwise(
        F.lit(1.0) - F.try_divide(res, tot)
    )


def score_main(df: DataFrame, by: list[str]) -> DataFrame:
    """RMSE, MAE, R2 as squared correlation, MAPE over non-zero actuals."""
    r = corr(_a(), _p())
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        _rmse().alias("rmse"),
        _mae().alias("mae"),
        _mape_nonzero().alias("mape"),
        (r * r).alias("r2"),
    )


def score_filtered(df: DataFrame, by: list[str]) -> DataFrame:
    """Scores over complete pairs with a non-zero actual; null with fewer than two of them.

    Groups without any usable pair stay in the result.
    """
    usable = _a().isNotNull() & _p().isNotNull() & (_a() != 0)
    kept = df.select(*by, F.when(usable, _a()).alias("actual"), F.when(usable, _p()).alias("predicted"))
    n = F.count("actual")
    agg = {"rmse": _rmse(), "mae": _mae(), "mape": _mape_nonzero(), "r2": _r2_det()}
    return kept.groupBy(*by).agg(n.alias("n"), *[F.when(n > 1, c).alias(k) for k, c in agg.items()])


def score_r2_det(df: DataFrame, by: list[str], zero_when_flat: bool = True) -> DataFrame:
    """1 - SSres/SStot; for constant actuals 0, or null with ``zero_when_flat=False``."""
    tot = _ss_tot()
    flat = F.lit(0.0) if zero_when_flat else F.lit(None).cast("double")
    return df.groupBy(*by).agg(F.when(tot == 0, flat).otherwise(F.lit(1.0) - F.try_divide(_ss_res(), tot)).alias("r2"))


def score_r2_clamped(df: DataFrame, by: list[str]) -> DataFrame:
    """max(0, R2), null with fewer than two rows."""
    return df.groupBy(*by).agg(
        F.when(F.count(_a()) > 1, F.greatest(F.lit(0.0), _r2_det())).alias("r2"),
        _rmse().alias("rmse"),
        _mae().alias("mae"),
        _mape_nonzero().alias("mape"),
    )


def score_mape_eps(df: DataFrame, by: list[str], eps: float = 1e-6) -> DataFrame:
    return df.groupBy(*by).agg((F.avg(F.abs((_a() - _p()) / (_a() + F.lit(eps)))) * F.lit(100.0)).alias("mape"))


def score_mape_raw(df: DataFrame, by: list[str]) -> DataFrame:
    """Unguarded MAPE: null when any actual is zero (division would give infinity)."""
    broken = F.max((_a() == 0).cast("int")) == 1
    return df.groupBy(*by).agg(F.when(~broken, _mape_nonzero()).alias("mape"))


def score_bias(df: DataFrame, by: list[str]) -> DataFrame:
    return df.groupBy(*by).agg(F.avg(_p() - _a()).alias("bias"))


def score_zero_accuracy(df: DataFrame, by: list[str]) -> DataFrame:
    """Share of rows where 'actual is zero' agrees with 'prediction below a half'."""
    return df.groupBy(*by).agg(F.avg(((_a() == 0) == (_p() < 0.5)).cast("double")).alias("zero_accuracy"))


def score_rmse_pct(df: DataFrame, by: list[str], base: str = "test") -> DataFrame:
    """Test RMSE in percent of the mean actual of the train or test rows (``split`` column)."""
    in_test = F.col("split") == "test"
    err = F.sqrt(F.avg(F.when(in_test, F.pow(_a() - _p(), F.lit(2.0)))))
    mean = F.avg(F.when(F.col("split") == base, _a()))
    return df.groupBy(*by).agg((F.try_divide(err, mean) * F.lit(100.0)).alias("rmse_pct"))


def score_mse(df: DataFrame, by: list[str]) -> DataFrame:
    return df.groupBy(*by).agg(F.avg(F.pow(_a() - _p(), F.lit(2.0))).alias("mse"))


def score_train_test(df: DataFrame, by: list[str]) -> DataFrame:
    """RMSE, R2 and MAPE of train and test rows side by side."""
    scored = df.groupBy(*by, "split").agg(_rmse().alias("rmse"), _r2_det().alias("r2"), _mape_nonzero().alias("mape"))
    return scored.groupBy(*by).pivot("split", ["train", "test"]).agg(
        F.first("rmse").alias("rmse"), F.first("r2").alias("r2"), F.first("mape").alias("mape")
    )


def row_errors(df: DataFrame) -> DataFrame:
    """Absolute error, percentage error (null on a zero actual) and residual per row."""
    return df.withColumns(
        {
            "abs_error": F.abs(_a() - _p()),
            "pct_error": F.abs(F.try_divide(_a() - _p(), _a())) * F.lit(100.0),
            "residual": _a() - _p(),
        }
    )


def interval_const(df: DataFrame, by: list[str], fit_split: str = "train", z: float = 1.96) -> DataFrame:
    """Prediction plus and minus z population deviations of the residuals of one split."""
    spread = df.where(F.col("split") == fit_split).groupBy(*by).agg(F.stddev_pop(_a() - _p()).alias("_sd"))
    half = F.lit(z) * F.col("_sd")
    return (
        df.join(spread, by, "left")
        .withColumns({"lower": _p() - half, "upper": _p() + half, "half_width": half})
        .drop("_sd")
    )


def series_stats(df: DataFrame, by: list[str], value: str) -> DataFrame:
    """Row counts, train mean and CV, test mean and deviation per series (``split`` column)."""
    train = F.when(F.col("split") == "train", F.col(value))
    test = F.when(F.col("split") == "test", F.col(value))
    return df.groupBy(*by).agg(
        F.count(train).alias("n_train"),
        F.count(test).alias("n_test"),
        F.avg(train).alias("mean_demand"),
        F.when(F.avg(train) > 0, F.try_divide(F.stddev_samp(train), F.avg(train))).alias("demand_cv"),
        F.avg(test).alias("test_mean"),
        F.stddev_samp(test).alias("test_std"),
    )


def to_wide(scores: DataFrame, grains: tuple[str, ...] = ("daily", "weekly", "monthly")) -> DataFrame:
    """(series, grain, metrics...) -> one row per series with ``<grain>_<metric>`` columns."""
    metrics = [c for c in scores.columns if c not in ("series", "grain", "n")]
    return scores.groupBy("series").pivot("grain", list(grains)).agg(*[F.first(m).alias(m) for m in metrics])


def to_long(scores: DataFrame, keys: tuple[str, ...] = ("series", "grain")) -> DataFrame:
    """One row per metric; missing values are kept."""
    metrics = [c for c in scores.columns if c not in (*keys, "n")]
    return scores.unpivot(list(keys), metrics, "metric", "value")
