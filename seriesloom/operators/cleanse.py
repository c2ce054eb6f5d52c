"""Outlier caps and scalers, fitted on training rows and applied to all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seriesloom.functions.numeric import clip, inf_to_null


def iqr_bound(df: DataFrame, keys: list[str], value: str, factor: float = 1.5) -> DataFrame:
    """Per series: third quartile plus ``factor`` interquartile ranges."""
    q = df.groupBy(*keys).agg(F.percentile(value, F.array(F.lit(0.25), F.lit(0.75))).alias("_q"))
    return q.select(*keys, (F.col("_q")[1] + F.lit(factor) * (F.col("_q")[1] - F.col("_q")[0])).alias("upper_bound"))


def cap_iqr(df: DataFrame, keys: list[str], value: str, factor: float = 1.5) -> DataFrame:
    """Values above the bound of their series are set to it."""
    joined = df.join(iqr_bound(df, keys, value, factor), keys)
    return joined.withColumn(value, F.least(F.col(value), F.col("upper_bound"))).drop("upper_bound")


def outlier_counts(df: DataFrame, keys: list[str], value: str, factor: float = 1.5) -> DataFrame:
    """Rows above the bound per series, as a count and in percent."""
    joined = df.join(iqr_bound(df, keys, value, factor), keys)
    over = F.when(F.col(value) > F.col("upper_bound"), 1)
    return joined.groupBy(*keys).agg(
        F.first("upper_bound").alias("upper_bound"),
        F.count(over).alias("n_outliers"),
        (F.count(over) / F.count(F.lit(1)) * F.lit(100.0)).alias("pct_outliers"),
    )


def train_bounds(
    df: DataFrame, keys: list[str], columns: list[str], low: float, high: float, train: Column
) -> DataFrame:
    """Per series and column: mean, median and the two quantiles of the training rows."""
    agg = []
    for c in columns:
        v = F.when(train, inf_to_null(F.col(c)))
        q = F.percentile(v, F.array(F.lit(low), F.lit(0.5), F.lit(high)))
        agg += [F.avg(v).alias(f"{c}_mean"), q.alias(f"_{c}_q")]
    stats = df.groupBy(*keys).agg(*agg)
    return stats.select(
        *keys,
        *[
            x
            for c in columns
            for x in (
                F.col(f"{c}_mean"),
                F.col(f"_{c}_q")[1].alias(f"{c}_median"),
                F.col(f"_{c}_q")[0].alias(f"{c}_lower"),
                F.col(f"_{c}_q")[2].alias(f"{c}_upper"),
            )
        ],
    )


def cap_quantile(
    df: DataFrame,
    keys: list[str],
    columns: list[str],
    low: float = 0.01,
    high: float = 0.99,
    fill: str = "mean",
    train: Column | None = None,
) -> DataFrame:
    """Infinities to null, null to the train mean (or median), then clipped to train quantiles."""
    cond = (F.col("split") == "train") if train is None else train
    stats = train_bounds(df, keys, columns, low, high, cond)
    joined = df.join(stats, keys, "left")
    capped = {
        c: clip(
            F.coalesce(inf_to_null(F.col(c)), F.col(f"{c}_{fill}")), F.col(f"{c}_lower"), F.col(f"{c}_upper")
        )
        for c in columns
    }
    return joined.withColumns(capped).select(*df.columns)


def _one_if_zero(x: Column) -> Column:
    """A zero range, deviation or IQR scales by 1."""
    return F.when(x == 0, F.lit(1.0)).otherwise(x)


def _column_stats(df: DataFrame, columns: list[str], make) -> dict[str, dict[str, Column]]:
    """Statistics over all rows as one scalar subquery: no join, no window, one row of output."""
    agg = [make(F.col(c)).alias(c) for c in columns]
    one = df.agg(*agg).select(F.struct(*columns).alias("s")).scalar()
    return {c: one.getField(c) for c in columns}


def scale_minmax(df: DataFrame, columns: list[str], weight: float = 1.0) -> dict[str, Column]:
    """(x - min) / (max - min) over all rows."""
    stats = _column_stats(df, columns, lambda c: F.struct(F.min(c).alias("a"), F.max(c).alias("b")))
    return {
        c: (F.col(c) - s["a"]) / _one_if_zero(s["b"] - s["a"]) * F.lit(weight) for c, s in stats.items()
    }


def scale_standard(df: DataFrame, columns: list[str], weight: float = 1.0) -> dict[str, Column]:
    """(x - mean) / population deviation over all rows."""
    stats = _column_stats(df, columns, lambda c: F.struct(F.avg(c).alias("a"), F.stddev_pop(c).alias("b")))
    return {c: (F.col(c) - s["a"]) / _one_if_zero(s["b"]) * F.lit(weight) for c, s in stats.items()}


def scale_robust(df: DataFrame, keys: list[str], columns: list[str], train: Column) -> DataFrame:
    """(x - median) / interquartile range, both from the training rows of the series."""
    thirds = F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))
    stats = df.groupBy(*keys).agg(*[F.percentile(F.when(train, F.col(c)), thirds).alias(f"_{c}") for c in columns])
    joined = df.join(stats, keys, "left")
    scaled = {
        c: (F.col(c) - F.col(f"_{c}")[1]) / _one_if_zero(F.col(f"_{c}")[2] - F.col(f"_{c}")[0]) for c in columns
    }
    return joined.withColumns(scaled).select(*df.columns)


# Feature groups of the clustering, their scaler and weight.
GROUPS = (
    (("avg_monthly_demand", "demand_std", "demand_cv"), "minmax", 1.0),
    (("order_fulfillment",), "minmax", 1.5),
    (("sens_PIB_CO", "sens_ICI"), "standard", 2.0),
    (("sens_ECG_DESP", "sens_ISE_CO"), "standard", 2.0),
)
GROUP_COLUMNS = [c for columns, _, _ in GROUPS for c in columns]


def weight_groups(profile: DataFrame, keep: list[str] = ["series"]) -> DataFrame:
    """Each feature group scaled in its own way and multiplied by its weight.

    The statistics of all groups come from one aggregation over the profiles.
    """
    stats = _column_stats(
        profile,
        GROUP_COLUMNS,
        lambda c: F.struct(
            F.min(c).alias("low"), F.max(c).alias("high"), F.avg(c).alias("mean"), F.stddev_pop(c).alias("sd")
        ),
    )
    scaled = []
    for columns, kind, weight in GROUPS:
        for c in columns:
            s = stats[c]
            origin, span = (s["low"], s["high"] - s["low"]) if kind == "minmax" else (s["mean"], s["sd"])
            scaled.append(((F.col(c) - origin) / _one_if_zero(span) * F.lit(weight)).alias(c))
    return profile.select(*keep, *scaled)
