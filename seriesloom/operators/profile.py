"""Per-series profile used for clustering."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesloom.functions.numeric import corr

# Indicators a profile is correlated with.
SENSITIVITIES = ("PIB_CO", "ICI", "ECG_DESP", "ISE_CO")


def profile(monthly: DataFrame, spec_key: str = "series", eps: float = 1e-6) -> DataFrame:
    """Demand level, spread, fulfilment and indicator correlations in one aggregation.

    ``monthly`` holds dispatched, ordered and (for the correlations) the indicators.
    """
    d, o = F.col("dispatched"), F.col("ordered")
    base = [
        F.avg(d).alias("avg_monthly_demand"),
        F.stddev_samp(d).alias("demand_std"),
        (F.stddev_samp(d) / (F.avg(d) + F.lit(eps))).alias("demand_cv"),
        (F.sum(d) / (F.sum(o) + F.lit(eps))).alias("order_fulfillment"),
    ]
    if "series_name" in monthly.columns:
        base.insert(0, F.min_by("series_name", "month").alias("series_name"))
    sens = [
        F.coalesce(corr(d, F.col(c)), F.lit(0.0)).alias(f"sens_{c}")
        for c in SENSITIVITIES
        if c in monthly.columns
    ]
    return monthly.groupBy(spec_key).agg(*base, *sens)


def fulfil_mean_ratio(monthly: DataFrame) -> DataFrame:
    """Mean of the monthly fulfilment ratios (months without orders are skipped)."""
    return monthly.groupBy("series").agg(F.avg(F.try_divide("dispatched", "ordered")).alias("order_fulfillment"))
