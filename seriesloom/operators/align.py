"""Regular calendars and joins between daily panels and monthly tables.

Monthly tables are joined as they are: Spark broadcasts them where their size on disk says that they are small.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seriesloom.spec import SeriesSpec

STEPS = {"day": "interval 1 day", "week": "interval 7 days", "month": "interval 1 month"}


def gap_fill(
    df: DataFrame,
    spec: SeriesSpec,
    measures: list[str],
    start: str | Column | None = None,
    end: str | Column | None = None,
    step: str = "day",
) -> DataFrame:
    """Complete calendar per series; measures are 0 on the added rows.

    Each row looks at the next one and emits the days up to it, so there is no
    calendar join: the single shuffle is by series key, which the window features
    that follow reuse. Rows must be unique per series and time. Without ``start``
    / ``end`` a series is filled between its own first and last row. Rows outside the
    range go; a series that has no other rows gets the whole range with zeros.
    """
    step_by = F.expr(STEPS[step])
    w, day = spec.window(), spec.t()
    first = F.lit(start).cast("date") if start is not None else day
    last = F.lit(end).cast("date") if end is not None else day
    after_start = day >= first if start is not None else F.lit(True)
    inside = after_start & (day <= last if end is not None else F.lit(True))
    before, following = F.lag(spec.time).over(w), F.lead(spec.time).over(w)
    opens = before.isNull() | (before < first if start is not None else F.lit(False))
    closes = following.isNull() | (following > last if end is not None else F.lit(False))
    begin = F.when(opens, first).otherwise(day)
    until = F.when(closes, last).otherwise(F.date_sub(following, 1))
    rows = df.withColumns({"_begin": begin, "_until": until})
    if start is not None and end is not None:
        # A series without rows in the range keeps its first row, to be replaced by the whole calendar.
        alone = ~F.max(inside).over(spec.whole()) & before.isNull()
        rows = df.withColumns({"_alone": alone, "_begin": begin, "_until": until}).where(inside | F.col("_alone"))
        rows = rows.withColumns(
            {"_begin": F.when(F.col("_alone"), first).otherwise(F.col("_begin")), "_until": F.when(F.col("_alone"), last).otherwise(F.col("_until"))}
        )
    else:
        rows = rows.where(inside)
    days = F.explode(F.sequence(F.col("_begin"), F.col("_until"), step_by))
    others = [c for c in df.columns if c != spec.time and c not in measures]
    here = F.col("_day") == day
    return (
        rows.withColumn("_day", days)
        .select(
            *others,
            *[F.when(here, F.coalesce(F.col(m), F.lit(0.0))).otherwise(F.lit(0.0)).alias(m) for m in measures],
            F.col("_day").alias(spec.time),
        )
        .select(*df.columns)
    )


def join_year_month(fact: DataFrame, external: DataFrame, date: str = "date") -> DataFrame:
    """Fact left-joined with the indicators on (year, month)."""
    ext = external.withColumns({"year": F.year("month"), "month_no": F.month("month")}).drop("month")
    keyed = fact.withColumns({"year": F.year(date), "month_no": F.month(date)})
    return keyed.join(ext, ["year", "month_no"], "left")


def join_month(monthly: DataFrame, external: DataFrame) -> DataFrame:
    """Monthly fact left-joined with the indicators of its month."""
    return monthly.join(external, "month", "left")


def month_to_days(monthly: DataFrame, columns: list[str], keys: tuple[str, ...] = (), limit: int = 30) -> DataFrame:
    """A monthly value lands on the first of its month and is carried forward at most ``limit`` days.

    Output has one row per day and key. A day takes the latest non-null value in
    reach, so a missing month is bridged for the first days only. Equi-join this
    with the panel on the day.
    """
    days = F.explode(F.sequence(F.col("month"), F.date_add("month", limit)))
    latest = [
        F.max_by(F.col(c), F.when(F.col(c).isNotNull(), F.col("month"))).alias(c) for c in columns
    ]
    return monthly.select(*keys, "month", *columns, days.alias("date")).groupBy(*keys, "date").agg(*latest)


def join_days(panel: DataFrame, by_day: DataFrame, keys: tuple[str, ...] = (), date: str = "date") -> DataFrame:
    """Panel left-joined with a table that has one row per calendar day."""
    right = by_day if date == "date" else by_day.withColumnRenamed("date", date)
    return panel.join(right, [*keys, date], "left")


def carry_months(external: DataFrame, columns: list[str], until: str | Column) -> DataFrame:
    """Every calendar month to ``until``, values carried forward without limit.

    The unpartitioned window runs over the monthly table only.
    """
    span = external.agg(F.min("month").alias("a")).select(
        F.explode(F.sequence(F.col("a"), F.lit(until).cast("date"), F.expr("interval 1 month"))).alias("month")
    )
    w = Window.orderBy("month").rowsBetween(Window.unboundedPreceding, 0)
    full = span.join(external.select("month", *columns), "month", "left")
    return full.select("month", *[F.last(c, ignorenulls=True).over(w).alias(c) for c in columns])


def asof_month(panel: DataFrame, external: DataFrame, columns: list[str], until: str | Column, date: str = "date") -> DataFrame:
    """Each day takes the latest monthly value at or before it."""
    months = carry_months(external, columns, until)
    keyed = panel.withColumn("month", F.trunc(date, "month"))
    return keyed.join(F.broadcast(months), "month", "left").drop("month")


def asof_mean_fill(
    panel: DataFrame, external: DataFrame, columns: list[str], until: str | Column, spec: SeriesSpec
) -> DataFrame:
    """``asof_month``, then days before the first value take the mean of the series' carried values."""
    carried = asof_month(panel, external, columns, until, spec.time)
    means = carried.groupBy(*spec.partition).agg(*[F.avg(c).alias(f"_{c}") for c in columns])
    joined = carried.join(means, list(spec.partition), "left")
    return joined.select(
        *panel.columns, *[F.coalesce(F.col(c), F.col(f"_{c}")).alias(c) for c in columns]
    )


def asof_week_lag(panel: DataFrame, spec: SeriesSpec, lags: list[int], week_end: Column, name: str) -> DataFrame:
    """Weekly mean of the value one row earlier, k weeks back, on every day.

    The weekly value is dated at its week end and carried forward, so within a
    week the value in force is that of the last week end on or before the day.
    """
    w = spec.window()
    shifted = panel.withColumns({"_prev": F.lag(spec.target).over(w), "_week": week_end})
    weekly = shifted.groupBy(*spec.partition, "_week").agg(F.avg("_prev").alias("_mean"))
    ww = Window.partitionBy(*spec.partition).orderBy("_week")
    until_now = ww.rowsBetween(Window.unboundedPreceding, 0)
    lagged = weekly.select(*spec.partition, "_week", *[F.lag("_mean", k).over(ww).alias(f"{name}_{k}w") for k in lags])
    held = lagged.select(
        *spec.partition, "_week", *[F.last(f"{name}_{k}w", ignorenulls=True).over(until_now).alias(f"{name}_{k}w") for k in lags]
    )
    in_force = F.when(F.col("_week") == spec.t(), F.col("_week")).otherwise(F.date_sub("_week", 7))
    return (
        shifted.withColumn("_week", in_force)
        .join(held, [*spec.partition, "_week"], "left")
        .drop("_week", "_prev")
    )


def align_predictions(actual: DataFrame, predicted: DataFrame, spec: SeriesSpec) -> DataFrame:
    """Pairs of actual and predicted values of the same series and date."""
    return actual.join(predicted, [*spec.keys, spec.time])


def lookup_config(clusters: DataFrame, configs: DataFrame, fallback: int = 3) -> DataFrame:
    """Cluster label -> model configuration; an unknown label takes the fallback one."""
    known = configs.select(F.col("config").alias("_k"))
    joined = clusters.join(F.broadcast(known), F.col("cluster") == F.col("_k"), "left")
    return (
        joined.withColumn("config", F.coalesce(F.col("_k"), F.lit(fallback)).cast("int"))
        .drop("_k")
        .join(F.broadcast(configs), "config")
    )


def join_cluster(series: DataFrame, mapping: DataFrame, clean: Column, keep_unassigned: bool = True) -> DataFrame:
    """Series left-joined with cluster assignments on a cleaned id."""
    keyed = series.withColumn("_id", clean)
    right = mapping.withColumn("_id", F.regexp_replace(F.col("id").cast("string"), "^0+", "")).select("_id", "cluster")
    return keyed.join(right, "_id", "left" if keep_unassigned else "inner").drop("_id")


def cluster_members(rows: DataFrame, mapping: DataFrame, cluster: int) -> DataFrame:
    """The rows of the series assigned to one cluster."""
    return rows.join(mapping.where(F.col("cluster") == cluster).select("series"), "series", "left_semi")


def compare_series(long: DataFrame, series: list[str], metric: str = "metric", value: str = "value") -> DataFrame:
    """Metric values of the named series side by side."""
    return (
        long.where(F.col("series").isin(*series)).groupBy(metric).pivot("series", series).agg(F.first(value))
    )


def stack(frames: list[DataFrame]) -> DataFrame:
    """Rows of all frames, columns matched by name."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out
