"""Roll-ups of a daily panel to weeks and months, and complete-period filters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seriesloom.functions import calendar as cal
from seriesloom.spec import SeriesSpec

LABELS = {
    "week_sun": cal.week_ending_sunday,
    "week_mon": cal.week_ending_monday,
    "month_end": cal.month_end,
    "month_start": cal.month_start,
}


def resample(df: DataFrame, spec: SeriesSpec, rule: str, measures: list[str], how: str = "sum") -> DataFrame:
    """Aggregate the measures per series and period.

    ``sum`` counts missing values as 0 and gives 0 for a period without any, as
    ``mean`` skips them. Summation is partial before the shuffle.
    """
    label = LABELS[rule](spec.t()).alias(spec.time)
    agg = {
        "sum": lambda m: F.coalesce(F.sum(m), F.lit(0.0)).alias(m),
        "mean": lambda m: F.avg(m).alias(m),
    }[how]
    return df.groupBy(*spec.partition, label).agg(*[agg(m) for m in measures])


def stack_grains(df: DataFrame, spec: SeriesSpec, measures: list[str], grains: dict[str, str | None]) -> DataFrame:
    """Daily rows and their roll-ups in one pass, told apart by a ``grain`` column.

    Every row is emitted once per grain with the label of its period and all grains
    are summed in one aggregation. When the rows are already partitioned by series
    this needs no shuffle. A rule of None keeps the rows as they are, missing values
    included; in the roll-ups a missing value counts as 0.
    """
    labels = F.array(
        *[
            F.struct(
                F.lit(grain).alias("grain"), (spec.t() if rule is None else LABELS[rule](spec.t())).alias("_label")
            )
            for grain, rule in grains.items()
        ]
    )
    kept = [g for g, rule in grains.items() if rule is None]
    plain = F.col("grain").isin(*kept) if kept else F.lit(False)
    rows = df.select(*spec.partition, *measures, F.inline(labels))
    sums = [F.when(plain, F.sum(m)).otherwise(F.coalesce(F.sum(m), F.lit(0.0))).alias(m) for m in measures]
    return rows.groupBy(*spec.partition, "grain", "_label").agg(*sums).withColumnRenamed("_label", spec.time)


def shifted_resample(df: DataFrame, spec: SeriesSpec, rule: str, measure: str, rows: int) -> DataFrame:
    """Roll-up of the measure moved down by a number of rows first."""
    moved = df.withColumn(measure, F.lag(measure, rows).over(spec.window()))
    return resample(moved, spec, rule, [measure])


def by_year_month(df: DataFrame, spec: SeriesSpec, measures: list[str]) -> DataFrame:
    """Sums per (year, month) with the date rebuilt as the first of the month."""
    sums = df.groupBy(*spec.partition, F.year(spec.time).alias("year"), F.month(spec.time).alias("month_no")).agg(
        *[F.sum(m).alias(m) for m in measures]
    )
    return sums.withColumn(spec.time, F.make_date("year", "month_no", F.lit(1)))


def _within(df: DataFrame, spec: SeriesSpec, label: Column, low, high) -> DataFrame:
    """Rows whose period label lies between bounds derived from the series' first and last label."""
    labelled = df.withColumn("_p", label)
    bounds = labelled.groupBy(*spec.partition).agg(F.min("_p").alias("_lo"), F.max("_p").alias("_hi"))
    kept = labelled.join(bounds, list(spec.partition)).where(
        (F.col("_p") >= low(F.col("_lo"))) & (F.col("_p") <= high(F.col("_hi")))
    )
    return kept.drop("_p", "_lo", "_hi")


def complete_weeks(df: DataFrame, spec: SeriesSpec) -> DataFrame:
    """Rows without those of the first and the last Tuesday-to-Monday week."""
    return _within(
        df, spec, cal.week_from_tuesday(spec.t()), lambda c: F.date_add(c, 7), lambda c: F.date_sub(c, 7)
    )


def complete_months(df: DataFrame, spec: SeriesSpec) -> DataFrame:
    """Rows of months from month(first month + 32 days) to month(last month - 32 days).

    Counted from month starts: this drops one leading and two trailing months.
    """
    return _within(
        df,
        spec,
        cal.month_start(spec.t()),
        lambda c: cal.month_start(F.date_add(c, 32)),
        lambda c: cal.month_start(F.date_sub(c, 32)),
    )


def totals_error(df: DataFrame, keys: list[str], actual: str = "actual", predicted: str = "predicted") -> DataFrame:
    """Total actual and predicted, their difference and the error in percent."""
    sums = df.groupBy(*keys).agg(F.sum(actual).alias("total_actual"), F.sum(predicted).alias("total_predicted"))
    diff = F.col("total_predicted") - F.col("total_actual")
    return sums.withColumns(
        {"difference": diff, "pct_error": F.try_divide(diff, F.col("total_actual")) * F.lit(100.0)}
    )
