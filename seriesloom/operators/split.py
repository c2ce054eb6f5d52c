"""Train / validation / test splits, filters and minimum-history guards."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seriesloom.spec import SeriesSpec


def since(df: DataFrame, date: str, start: str) -> DataFrame:
    return df.where(F.col(date) >= F.lit(start).cast("date"))


def between(df: DataFrame, date: str, start: str, end: str) -> DataFrame:
    return df.where(F.col(date).between(F.lit(start).cast("date"), F.lit(end).cast("date")))


def cutoff_split(date: Column, test_from: str) -> Column:
    """'train' before the validation month, 'val' in it, 'test' from the cut-off on."""
    test = F.lit(test_from).cast("date")
    val = F.add_months(test, -1)
    return F.when(date < val, "train").when(date < test, "val").otherwise("test")


def two_window_split(date: Column, train_to: str, test_to: str) -> Column:
    """'train' up to and including ``train_to``, 'test' up to ``test_to``, null beyond."""
    a, b = F.lit(train_to).cast("date"), F.lit(test_to).cast("date")
    return F.when(date <= a, "train").when(date <= b, "test")


def gap_split(date: Column, cutoff: str | Column) -> Column:
    """Long horizon: validation is the month before the cut-off, the month after it is unused."""
    t = F.lit(cutoff).cast("date")
    return (
        F.when(date < F.add_months(t, -1), "train")
        .when(date < t, "val")
        .when(date >= F.add_months(t, 1), "test")
    )


def calendar_split(date: Column, train_to: str, test_from: str, test_to: str) -> Column:
    """'train' to a year end, 'test' between two dates, null elsewhere."""
    lit = lambda d: F.lit(d).cast("date")
    return F.when(date <= lit(train_to), "train").when(date.between(lit(test_from), lit(test_to)), "test")


def fraction_split(df: DataFrame, spec: SeriesSpec, train_share: float = 0.8) -> DataFrame:
    """First share of the rows of each series is train, by position."""
    position = F.row_number().over(spec.window())
    cut = F.floor(F.count(F.lit(1)).over(spec.whole()) * F.lit(train_share))
    return df.withColumn("split", F.when(position <= cut, "train").otherwise("test"))


def fraction_date_split(df: DataFrame, spec: SeriesSpec, train_share: float = 0.8) -> DataFrame:
    """Split at the date of row int(share * n), which belongs to both sides.

    The boundary row is in train and in test, as slicing by label on both sides
    gives; ``fraction_split`` is the variant without the shared row.
    """
    position = F.row_number().over(spec.window())
    cut = F.floor(F.count(F.lit(1)).over(spec.whole()) * F.lit(train_share)) + 1
    sides = F.when(position < cut, F.array(F.lit("train"))).when(
        position == cut, F.array(F.lit("train"), F.lit("test"))
    )
    return df.withColumn("split", sides.otherwise(F.array(F.lit("test")))).withColumn("split", F.explode("split"))


def last_n_split(df: DataFrame, spec: SeriesSpec, n: int = 12) -> DataFrame:
    """The last n rows of each series are test."""
    newest = Window.partitionBy(*spec.partition).orderBy(F.desc(spec.time))
    return df.withColumn("split", F.when(F.row_number().over(newest) <= n, "test").otherwise("train"))


def guard_history(df: DataFrame, keys: list[str], minimum: int, when: Column | None = None) -> DataFrame:
    """Keep series with at least ``minimum`` rows (of those where ``when`` holds).

    Counts are pre-aggregated per key and joined back, so a long series is never
    gathered for counting.
    """
    counted = F.count(F.lit(1)) if when is None else F.count(F.when(when, 1))
    enough = df.groupBy(*keys).agg(counted.alias("_n")).where(F.col("_n") >= minimum).drop("_n")
    return df.join(enough, keys, "left_semi")


def history_status(df: DataFrame, keys: list[str], minimum: int, has_test: Column) -> DataFrame:
    """One row per series: whether it can be modelled, and why not."""
    agg = df.groupBy(*keys).agg(
        F.count(F.when(~has_test, 1)).alias("n_train"), F.count(F.when(has_test, 1)).alias("n_test")
    )
    error = F.when(F.col("n_train") < minimum, "insufficient training data").when(
        F.col("n_test") < 1, "no test data"
    )
    return agg.withColumn("error", error).withColumn("success", F.col("error").isNull())


def drop_nulls(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.na.drop(subset=columns)


def in_dates(df: DataFrame, dates: DataFrame, date: str = "date") -> DataFrame:
    """Rows whose date appears in another table."""
    return df.join(dates.select(date).distinct(), date, "left_semi")
