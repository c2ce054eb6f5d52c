"""Summaries, rankings and distributions of score tables.

``scores_long`` tables have (series, grain, metric, value). Group statistics are
plain aggregates; quantiles over all series go through ``exact_quantiles``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seriesloom.functions.numeric import corr
from seriesloom.operators.quantiles import quantile_columns


def _with_median(df: DataFrame, by: list[str], value: str, aggregates: list[Column]) -> DataFrame:
    stats = df.where(F.col(value).isNotNull()).groupBy(*by).agg(*aggregates)
    return stats.join(quantile_columns(df, by, value, {"median": 0.5}), by)


def score_summary(long: DataFrame, by: tuple[str, ...] = ("grain", "metric")) -> DataFrame:
    """Mean, median, deviation, min, max and count of each metric over the series."""
    v = F.col("value")
    return _with_median(
        long,
        list(by),
        "value",
        [
            F.avg(v).alias("mean"),
            F.stddev_samp(v).alias("std"),
            F.min(v).alias("min"),
            F.max(v).alias("max"),
            F.count(v).alias("n"),
        ],
    )


def describe(df: DataFrame, by: list[str], value: str) -> DataFrame:
    """Count, mean, deviation, min, quartiles and max."""
    v = F.col(value)
    stats = df.where(v.isNotNull()).groupBy(*by).agg(
        F.count(v).alias("count"),
        F.avg(v).alias("mean"),
        F.stddev_samp(v).alias("std"),
        F.min(v).alias("min"),
        F.max(v).alias("max"),
    )
    return stats.join(quantile_columns(df, by, value, {"q25": 0.25, "q50": 0.5, "q75": 0.75}), by)


def percentiles(df: DataFrame, by: list[str], value: str, points: tuple[int, ...] = (10, 25, 50, 75, 90)) -> DataFrame:
    return quantile_columns(df, by, value, {f"p{p}": p / 100.0 for p in points})


def cluster_stats(long: DataFrame, digits: int = 2) -> DataFrame:
    """Rounded mean, deviation, min, max and count per cluster and metric."""
    v = F.col("value")
    return long.where(v.isNotNull()).groupBy("cluster", "metric").agg(
        F.round(F.avg(v), digits).alias("mean"),
        F.round(F.stddev_samp(v), digits).alias("std"),
        F.round(F.min(v), digits).alias("min"),
        F.round(F.max(v), digits).alias("max"),
        F.count(v).alias("n"),
    )


def cluster_sizes(labelled: DataFrame) -> DataFrame:
    return labelled.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"))


def cluster_means(labelled: DataFrame, columns: list[str]) -> DataFrame:
    return labelled.groupBy("cluster").agg(*[F.avg(c).alias(c) for c in columns])


def cluster_map(labelled: DataFrame) -> DataFrame:
    """Assignments sorted by cluster, then by falling demand."""
    return labelled.select("series", "series_name", "cluster", "avg_monthly_demand").orderBy(
        F.asc("cluster"), F.desc("avg_monthly_demand"), F.asc("series")
    )


def success_rate(scores: DataFrame, by: list[str], r2: str = "r2", limit: float = 0.3) -> DataFrame:
    """Percent of series above the R2 limit; a cluster without any shows null."""
    good = F.count(F.when(F.col(r2) > limit, 1))
    rate = F.when(good > 0, F.round(good / F.count(F.lit(1)) * F.lit(100.0), 2))
    if not by:
        rate = F.round(good / F.count(F.lit(1)) * F.lit(100.0), 2)
    return scores.groupBy(*by).agg(rate.alias("success_rate"))


def best_cluster(scores: DataFrame, r2: str = "r2") -> DataFrame:
    """Clusters with the highest and lowest mean R2 and with the lowest deviation, lowest label on ties."""
    per = scores.groupBy("cluster").agg(F.avg(r2).alias("m"), F.stddev_samp(r2).alias("s"))
    order = lambda c: F.struct(c, F.col("cluster"))
    known = F.col("m").isNotNull()
    return per.agg(
        F.min_by("cluster", F.when(known, order(-F.col("m")))).alias("best_cluster"),
        F.min_by("cluster", F.when(known, order(F.col("m")))).alias("worst_cluster"),
        F.min_by("cluster", F.when(F.col("s").isNotNull(), order(F.col("s")))).alias("most_consistent"),
    )


def score_corr(wide: DataFrame, columns: list[str]) -> DataFrame:
    """Correlation matrix in long form, from one aggregation."""
    pairs = [(a, b) for a in columns for b in columns]
    one = wide.agg(
        F.array(
            *[
                F.struct(F.lit(a).alias("left"), F.lit(b).alias("right"), corr(F.col(a), F.col(b)).alias("corr"))
                for a, b in pairs
            ]
        ).alias("m")
    )
    return one.select(F.inline("m"))


# Right-closed R2 bins.
R2_BINS = ((0.0, "(-inf, 0]"), (0.2, "(0, 0.2]"), (0.4, "(0.2, 0.4]"), (0.6, "(0.4, 0.6]"), (0.8, "(0.6, 0.8]"), (1.0, "(0.8, 1]"))


def r2_bins(scores: DataFrame, r2: str = "r2") -> DataFrame:
    """Series per R2 bin, empty bins included."""
    label = F
    for upper, name in R2_BINS:
        label = label.when(F.col(r2) <= upper, name)
    rows = [
        F.struct(F.lit(name).alias("bin"), F.count(F.when(label == name, 1)).alias("n")) for _, name in R2_BINS
    ]
    return scores.agg(F.array(*rows).alias("bins")).select(F.inline("bins"))


def histogram(df: DataFrame, value: str, by: list[str], bins: int = 20) -> DataFrame:
    """Rows per equal-width bin between the smallest and largest value of a group.

    The last bin is closed on both sides. Bins without rows are absent.
    """
    known = df.where(F.col(value).isNotNull())
    edges = known.groupBy(*by).agg(F.min(value).alias("_lo"), F.max(value).alias("_hi"))
    width = (F.col("_hi") - F.col("_lo")) / F.lit(float(bins))
    slot = F.coalesce(F.floor(F.try_divide(F.col(value) - F.col("_lo"), width)), F.lit(0))
    joined = known.join(edges, by)
    return (
        joined.withColumn("bin", F.least(slot, F.lit(bins - 1)).cast("int"))
        .groupBy(*by, "bin")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def box_stats(df: DataFrame, by: list[str], value: str) -> DataFrame:
    """Quartiles per group."""
    return quantile_columns(df, by, value, {"q25": 0.25, "q50": 0.5, "q75": 0.75})


def sparsity(df: DataFrame, keys: list[str], value: str = "ordered") -> DataFrame:
    return df.groupBy(*keys).agg(F.avg((F.col(value) == 0).cast("double")).alias("sparsity"))


def sparsity_corr(scores: DataFrame, r2: str = "r2") -> DataFrame:
    return scores.agg(corr(F.col("sparsity"), F.col(r2)).alias("corr"))


def good_poor_groups(scores: DataFrame, limit: float = 0.4, r2: str = "r2") -> DataFrame:
    """Series with R2 below and from the limit: count and mean sparsity, MAE, RMSE."""
    group = F.when(F.col(r2) < limit, "poor").when(F.col(r2) >= limit, "good")
    return (
        scores.withColumn("performance", group)
        .where(F.col("performance").isNotNull())
        .groupBy("performance")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.avg("sparsity").alias("sparsity"),
            F.avg("mae").alias("mae"),
            F.avg("rmse").alias("rmse"),
        )
    )


def coverage(df: DataFrame, by: list[str], date: str = "date") -> DataFrame:
    return df.groupBy(*by).agg(
        F.min(date).alias("first_date"), F.max(date).alias("last_date"), F.count(F.lit(1)).alias("n_rows")
    )


def distinct_series(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.select(*columns).distinct()


def run_status(status: DataFrame) -> DataFrame:
    """Series done, failed and the share done in percent."""
    done = F.sum(F.col("success").cast("int"))
    return status.agg(
        F.count(F.lit(1)).alias("n"),
        done.alias("n_success"),
        (F.count(F.lit(1)) - done).alias("n_failed"),
        (done / F.count(F.lit(1)) * F.lit(100.0)).alias("pct_success"),
    )


def importance_by_category(importance: DataFrame, category: Column) -> DataFrame:
    return importance.groupBy(category.alias("category")).agg(F.sum("importance").alias("importance"))


def top_per_group(df: DataFrame, by: list[str], order: list[Column], n: int) -> DataFrame:
    """First n rows of each group. Spark limits each map task to n rows per group before the shuffle."""
    w = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)


def top_feature_freq(importance: DataFrame, n: int = 5) -> DataFrame:
    """How many series have a feature among their n most important."""
    top = top_per_group(importance, ["series"], [F.desc("importance"), F.asc("feature")], n)
    return top.groupBy("feature").agg(F.count(F.lit(1)).alias("n"))


def top_series(scores: DataFrame, by: str, n: int = 5, best: bool = True, grain: str = "grain") -> DataFrame:
    """The n best or worst series per grain, missing scores dropped, ties by series."""
    order = F.desc(by) if best else F.asc(by)
    return top_per_group(scores.where(F.col(by).isNotNull()), [grain], [order, F.asc("series")], n)


def peaks(df: DataFrame, columns: list[str], start: str, end: str, n: int = 10, date: str = "date") -> DataFrame:
    """The n largest values of each column inside a date range."""
    inside = df.where(F.col(date).between(F.lit(start).cast("date"), F.lit(end).cast("date")))
    parts = []
    for c in columns:
        top = inside.where(F.col(c).isNotNull()).orderBy(F.desc(c), F.asc("series"), F.asc(date)).limit(n)
        parts.append(top.select(F.lit(c).alias("kind"), "series", date, F.col(c).alias("value")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def rank_scores(scores: DataFrame, by: str = "r2") -> DataFrame:
    """Sorted by falling score, missing ones last."""
    return scores.orderBy(F.desc_nulls_last(by), F.asc("series"))
