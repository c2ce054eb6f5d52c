"""The naive baseline from end to end: previous-row forecasts scored at three grains."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesloom.operators import report, resample, score, split
from seriesloom.operators import window as win
from seriesloom.spec import SeriesSpec

GRAINS = {"daily": None, "weekly": "week_sun", "monthly": "month_end"}


def forecasts(orders: DataFrame, spec: SeriesSpec, test_from: str) -> DataFrame:
    """(series, grain, date, actual, predicted) of the test slice; rows are not gap-filled."""
    test = split.since(orders, spec.time, test_from)
    pairs = test.select(
        *spec.keys,
        spec.time,
        F.col(spec.target).alias("actual"),
        win.naive(F.col(spec.target), spec).alias("predicted"),
    )
    return resample.stack_grains(pairs, spec, ["actual", "predicted"], GRAINS)


def scores(orders: DataFrame, spec: SeriesSpec, test_from: str) -> DataFrame:
    """Scores per series and grain over complete pairs with a non-zero actual."""
    return score.score_filtered(forecasts(orders, spec, test_from), [*spec.keys, "grain"])


def summary(score_table: DataFrame) -> DataFrame:
    """Mean, median, spread and count of each score over the series."""
    return report.score_summary(score.to_long(score_table))
