"""Panels and score tables that the registered queries start from.

Cut-offs are parameters of the operators; these are the ones that fit the calendar
of the test tables.
"""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seriesloom.functions.text import INDICATORS
from seriesloom.operators import align, indicators, lumpy, resample, score, split
from seriesloom.operators import profile as prof
from seriesloom.operators import window as win
from seriesloom.plans import naive
from seriesloom.session import cut_lineage, remembered
from seriesloom.sources import tables
from seriesloom.spec import SeriesSpec

VAL, TEST = "2000-12-01", "2001-01-01"
SPEC = SeriesSpec()
SPLIT = SPEC.with_history("split")
MONTHLY = SeriesSpec(time="month")
MONTHLY_SPLIT = MONTHLY.with_history("split")
MEASURES = ["dispatched", "ordered"]


def _days(spark: SparkSession, sf: str) -> tuple[datetime.date | None, datetime.date | None]:
    """First and last day of the data, looked up once a session."""

    def look():
        ends = lambda name, c: tables.table(spark, sf, name).agg(F.min(F.col(c).cast("date")), F.max(F.col(c).cast("date"))).first()
        found = [d for row in (ends("lineitem", "l_shipdate"), ends("orders", "o_orderdate")) for d in row if d is not None]
        return (min(found), max(found)) if found else (None, None)

    return remembered(spark, ("days", sf), look)


def first_day(spark: SparkSession, sf: str) -> Column:
    """The first day of the data: the start of every calendar here, as a literal."""
    return F.lit(_days(spark, sf)[0]).cast("date")


def last_day(spark: SparkSession, sf: str) -> Column:
    """The last day of the data: the end of every calendar here, as a literal."""
    return F.lit(_days(spark, sf)[1]).cast("date")


def first_month(spark: SparkSession, sf: str) -> Column:
    return F.trunc(first_day(spark, sf), "month")


def last_month(spark: SparkSession, sf: str) -> Column:
    return F.trunc(last_day(spark, sf), "month")


def lumpy_key():
    return F.concat_ws("|", "p_brand", "p_type")


def daily(spark: SparkSession, sf: str) -> DataFrame:
    """series = brand; one row per active day."""
    return tables.orders_daily(spark, sf, F.col("p_brand"))


def daily_lumpy(spark: SparkSession, sf: str, since: str | None = None) -> DataFrame:
    """series = brand and type; most days have no row."""
    return tables.orders_daily(spark, sf, lumpy_key(), since=since)


def filled(spark: SparkSession, sf: str) -> DataFrame:
    """Brand panel on the complete calendar with its split."""
    panel = align.gap_fill(daily(spark, sf), SPEC, MEASURES, first_day(spark, sf), last_day(spark, sf))
    return panel.withColumn("split", split.cutoff_split(F.col("date"), TEST))


def filled_lumpy(spark: SparkSession, sf: str) -> DataFrame:
    panel = align.gap_fill(daily_lumpy(spark, sf), SPEC, MEASURES, first_day(spark, sf), last_day(spark, sf))
    return panel.withColumn("split", split.cutoff_split(F.col("date"), TEST))


def monthly(spark: SparkSession, sf: str) -> DataFrame:
    """Brand panel by month on the complete calendar."""
    rolled = tables.orders_monthly(spark, sf, F.col("p_brand"))
    return align.gap_fill(rolled, MONTHLY, MEASURES, first_month(spark, sf), last_month(spark, sf), step="month")


def monthly_lumpy(spark: SparkSession, sf: str) -> DataFrame:
    rolled = tables.orders_monthly(spark, sf, lumpy_key())
    return align.gap_fill(rolled, MONTHLY, MEASURES, first_month(spark, sf), last_month(spark, sf), step="month")


def monthly_with_split(spark: SparkSession, sf: str, panel: DataFrame | None = None) -> DataFrame:
    """``panel`` is `monthly` where the caller has it already."""
    return split.last_n_split(monthly(spark, sf) if panel is None else panel, MONTHLY, 12)


def external(spark: SparkSession, sf: str) -> DataFrame:
    """The indicators: one row per month, written once a session, so that plans know how small the table is."""
    return remembered(spark, ("indicators", sf), lambda: cut_lineage(tables.external_monthly(spark, sf).coalesce(1)))


def external_split(spark: SparkSession, sf: str) -> DataFrame:
    return external(spark, sf).withColumn("split", split.cutoff_split(F.col("month"), TEST))


def parts_monthly(spark: SparkSession, sf: str) -> DataFrame:
    """series = part; months with activity since 1998 only, joined with the indicators."""
    return align.join_month(tables.parts_monthly(spark, sf, "1998-01-01"), external(spark, sf))


def profiles(spark: SparkSession, sf: str) -> DataFrame:
    """Profile per part, without those that have a missing value."""
    table = prof.profile(parts_monthly(spark, sf))
    return split.drop_nulls(table, table.columns)


def profile_table(spark: SparkSession, sf: str) -> DataFrame:
    """The profiles, materialised: scaling and labelling read them several times."""
    return cut_lineage(profiles(spark, sf))


def label_by_level(profile: DataFrame) -> DataFrame:
    """A fixed rule that labels series by demand level against mean and deviation over all series."""
    one = profile.agg(
        F.struct(F.avg("avg_monthly_demand").alias("m"), F.stddev_samp("avg_monthly_demand").alias("s")).alias("x")
    ).scalar()
    level = F.col("avg_monthly_demand")
    low, high = one.getField("m") - one.getField("s") / 2, one.getField("m") + one.getField("s") / 2
    return profile.withColumn("cluster", F.when(level < low, 0).when(level < high, 1).otherwise(2))


def labelled(spark: SparkSession, sf: str) -> DataFrame:
    return label_by_level(profile_table(spark, sf))


def naive_daily(spark: SparkSession, sf: str) -> DataFrame:
    """Previous-row forecast on the active days of the test slice."""
    return daily_lumpy(spark, sf, TEST).select(
        "series", "date", F.col("dispatched").alias("actual"), win.naive(F.col("dispatched"), SPEC).alias("predicted")
    )


def by_grain(pairs: DataFrame) -> DataFrame:
    """Daily pairs with their weekly and monthly sums, stacked with a grain column."""
    return resample.stack_grains(pairs, SPEC, ["actual", "predicted"], naive.GRAINS)


def naive_pairs(spark: SparkSession, sf: str) -> DataFrame:
    return naive.forecasts(daily_lumpy(spark, sf, TEST), SPEC, TEST)


def naive_scores(spark: SparkSession, sf: str) -> DataFrame:
    """(series, grain, n, rmse, mae, mape, r2) with R2 as squared correlation."""
    pairs = naive_pairs(spark, sf).where(F.col("predicted").isNotNull())
    return score.score_main(pairs, ["series", "grain"])


def naive_score_table(spark: SparkSession, sf: str) -> DataFrame:
    """The scores, materialised for summaries that read them several times."""
    return cut_lineage(naive_scores(spark, sf))


def scores_labelled(spark: SparkSession, sf: str) -> DataFrame:
    """Monthly scores per series with its zero share and demand class as cluster."""
    monthly_scores = naive_scores(spark, sf).where(F.col("grain") == "monthly")
    stats = monthly_lumpy(spark, sf).groupBy("series").agg(
        F.try_divide(F.stddev_samp("ordered"), F.avg("ordered")).alias("cv"),
        F.avg((F.col("ordered") == 0).cast("double")).alias("sparsity"),
    )
    cluster = F.when(F.col("cv") <= 0.45, 0).when(F.col("cv") <= 0.6, 1).otherwise(2)
    return monthly_scores.join(stats.withColumn("cluster", cluster), "series")


def features_main(spark: SparkSession, sf: str) -> DataFrame:
    """The main daily feature matrix of every series, history restarting in each split."""
    from seriesloom.plans import clustered

    return clustered.feature_matrix(filled(spark, sf), external(spark, sf), SPEC, TEST)[0]


def external_day_lags(spark: SparkSession, sf: str, ks: tuple[int, ...] = (1, 2, 3)) -> DataFrame:
    """Indicator lags per split and day: one month further back outside train, 30 days in force."""
    ext = external_split(spark, sf)
    lagged = indicators.ext_lags(INDICATORS, ks, ("split",), F.col("split") != "train")
    table = ext.select("split", "month", *[c.alias(n) for n, c in lagged.items()])
    return align.month_to_days(table, list(lagged), ("split",))


def monthly_smooth_flags(spark: SparkSession, sf: str) -> DataFrame:
    return lumpy.smooth_flags(monthly(spark, sf), ["series"], "ordered")
