"""Panels and indicator tables built from the star-schema tables.

A hot part, order or series may hold a large share of the rows. The joins are plain
equi-joins on a unique dimension key: Spark broadcasts the dimension when its size
allows and otherwise splits a skewed partition at run time. Sums are combined on the
map side, so what reaches one task after the joins is bounded by the number of days
and not by the number of lines.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def daily_totals(rows: DataFrame, keys: list[str], time: str, measures: list[str]) -> DataFrame:
    """One row per key and day; duplicate rows are summed."""
    return rows.groupBy(*keys, time).agg(*[F.sum(m).alias(m) for m in measures])


def _recent(spark: SparkSession, sf_dir: str, since: str) -> DataFrame:
    """l_partkey, date, dispatched, ordered of the ship days and the order days from ``since`` on."""
    from_day, zero = F.lit(since).cast("timestamp_ntz"), F.lit(0.0)
    fact = table(spark, sf_dir, "lineitem")
    shipped = fact.where(F.col("l_shipdate") >= from_day).select(
        "l_partkey", F.col("l_shipdate").cast("date").alias("date"), F.col("l_quantity").alias("dispatched"), zero.alias("ordered")
    )
    recent = table(spark, sf_dir, "orders").where(F.col("o_orderdate") >= from_day)
    recent = recent.select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_orderdate").cast("date").alias("date"))
    ordered = fact.select("l_orderkey", "l_partkey", "l_quantity").join(recent, "l_orderkey")
    return shipped.union(ordered.select("l_partkey", "date", zero.alias("dispatched"), F.col("l_quantity").alias("ordered")))


def _movements(
    spark: SparkSession, sf_dir: str, key: Column, name: Column | None, since: str | None
) -> tuple[DataFrame, list[str]]:
    """series, [series_name,] date, dispatched (ship day), ordered (order day): two rows per line.

    One scan of each fact table. Lines are joined as they are and expanded last, so the
    joins move each line once; nothing is summed before the series is known, because
    lines are nearly unique per part and day. With ``since`` the ship days and the order
    days are two branches, each with its date filter at its own scan; ship days need no orders.
    """
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_partkey",
        F.col("l_shipdate").cast("date").alias("ship_day"),
        F.col("l_quantity").alias("qty"),
    )
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), F.col("o_orderdate").cast("date").alias("order_day")
    )
    part = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("l_partkey"),
        key.alias("series"),
        *([name.alias("series_name")] if name is not None else []),
    )
    keys = ["series"] + (["series_name"] if name is not None else [])
    zero = F.lit(0.0)
    if since is not None:
        return _recent(spark, sf_dir, since).join(part, "l_partkey").select(*keys, "date", "dispatched", "ordered"), keys
    movement = F.inline(
        F.array(
            F.struct(F.col("ship_day").alias("date"), F.col("qty").alias("dispatched"), zero.alias("ordered")),
            F.struct(F.col("order_day").alias("date"), zero.alias("dispatched"), F.col("qty").alias("ordered")),
        )
    )
    return lines.join(orders, "l_orderkey").join(part, "l_partkey").select(*keys, movement), keys


def orders_daily(
    spark: SparkSession, sf_dir: str, key: Column, name: Column | None = None, since: str | None = None
) -> DataFrame:
    """series, [series_name,] date, dispatched, ordered: one row per active series-day."""
    rows, keys = _movements(spark, sf_dir, key, name, since)
    return daily_totals(rows, keys, "date", ["dispatched", "ordered"])


def orders_monthly(
    spark: SparkSession, sf_dir: str, key: Column, name: Column | None = None, since: str | None = None
) -> DataFrame:
    """The same by month, summed in one step where days are not needed."""
    rows, keys = _movements(spark, sf_dir, key, name, since)
    return daily_totals(rows.withColumn("month", F.trunc("date", "month")), keys, "month", ["dispatched", "ordered"])


def parts_monthly(spark: SparkSession, sf_dir: str, since: str) -> DataFrame:
    """`orders_monthly` with series = part: series, series_name, month, dispatched, ordered from ``since`` on.

    There are as many series as parts, and their rows are nearly as many as the lines. They are summed by part and month
    first, so that a hot part is a few rows, and then dealt by series alone: the names, the sums, and what is
    grouped by series afterwards need no further shuffle.
    """
    moved = _recent(spark, sf_dir, since).withColumn("month", F.trunc("date", "month"))
    summed = daily_totals(moved, ["l_partkey"], "month", ["dispatched", "ordered"])
    rows = summed.select(F.col("l_partkey").cast("string").alias("series"), "month", "dispatched", "ordered")
    names = table(spark, sf_dir, "part").select(F.col("p_partkey").cast("string").alias("series"), F.col("p_name").alias("series_name"))
    return daily_totals(rows.join(names, "series"), ["series", "series_name"], "month", ["dispatched", "ordered"])


def _exact(c: Column, scale: int) -> Column:
    return c.cast(f"decimal(18,{scale})")


def external_monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seven monthly indicators: one row per calendar month that has orders."""
    return external_by(spark, sf_dir, "month")


def external_by(spark: SparkSession, sf_dir: str, grain: str) -> DataFrame:
    """Seven indicators: one row per `month` or `day` that has orders.

    Money is summed as decimals, so the result does not depend on how rows are
    spread over tasks.
    """
    start = lambda c: (F.col(c).cast("date") if grain == "day" else F.trunc(F.col(c).cast("date"), "month")).alias(grain)
    by_order = (
        table(spark, sf_dir, "orders")
        .groupBy(start("o_orderdate"))
        .agg(
            F.count("*").cast("double").alias("ECG_DESP"),
            F.sum(_exact(F.col("o_totalprice"), 2)).cast("double").alias("ISE_CO"),
            F.countDistinct("o_custkey").cast("double").alias("VTOTAL_19"),
            F.avg(F.when(F.col("o_orderpriority") == "1-URGENT", 1.0).otherwise(0.0)).alias("OTOTAL_19"),
        )
    )
    price, discount = _exact(F.col("l_extendedprice"), 2), _exact(F.col("l_discount"), 2)
    by_line = (
        table(spark, sf_dir, "lineitem")
        .groupBy(start("l_shipdate"))
        .agg(
            F.sum(price * (F.lit(1).cast("decimal(3,2)") - discount)).cast("double").alias("PIB_CO"),
            F.sum(discount).cast("double").alias("_disc"),
            F.count("*").cast("double").alias("_lines"),
        )
    )
    return by_order.join(by_line, grain, "left").select(
        grain,
        "ECG_DESP",
        (F.col("ISE_CO") / F.col("ECG_DESP")).alias("TUAV"),
        "PIB_CO",
        "ISE_CO",
        "VTOTAL_19",
        "OTOTAL_19",
        (F.col("_disc") / F.col("_lines")).alias("ICI"),
    )


def monthly_rollup(daily: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Sum of both quantities per series and month; the month is its first day."""
    keys = keys or ["series"]
    return daily.groupBy(*keys, F.trunc("date", "month").alias("month")).agg(
        F.sum("dispatched").alias("dispatched"), F.sum("ordered").alias("ordered")
    )


def short_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily event counts and values per event type: a panel of only a few weeks."""
    return (
        table(spark, sf_dir, "events")
        .groupBy(F.col("event_type").alias("series"), F.col("ts").cast("date").alias("date"))
        .agg(F.count("*").cast("double").alias("dispatched"))
    )
