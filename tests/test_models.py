"""Learners on the registered panels: quality against the naive forecast, and that queries give rows."""

import pytest
from pyspark.sql import functions as F

from seriesloom.operators import boosting, models

SF = "/root/testdata/sf0.001"


def test_best_prefix_waits_as_long_as_the_patience():
    assert boosting.best_prefix([5.0, 3.0, 4.0, 2.0], 1) == 2
    assert boosting.best_prefix([5.0, 3.0, 4.0, 2.0], 2) == 4
    assert boosting.best_prefix([1.0], 5) == 1


@pytest.fixture(scope="module")
def monthly(spark):
    from seriesloom.plans import cat_models

    return cat_models.monthly_rows(spark, SF)[0]


@pytest.mark.parametrize("config", [models.SIMPLE, models.SECOND[0], models.LEAFWISE], ids=["level", "oblivious", "leaf"])
def test_learners_beat_the_previous_month(monthly, config):
    model = models.fit_boosted(monthly, config, "dispatched")
    keep = ["series", "month", F.col("Demand_lag_1").alias("naive")]
    pairs = models.predict(model, monthly.where("split = 'test'"), "dispatched", keep)
    error = lambda c: F.sqrt(F.avg(F.pow(F.col("actual") - F.col(c), 2)))
    ours, naive = pairs.agg(error("predicted"), error("naive")).first()
    assert ours < naive


@pytest.mark.parametrize("name", ["holt_winters", "baseline_ext", "fit_category"])
def test_model_query_gives_rows(spark, name):
    from seriesloom.plans import catalog

    assert catalog.QUERIES[name](spark, SF).count() > 0


def lines(spark, path):
    """Two years of orders of six brands, two lines each."""
    days = spark.range(730).select("id", F.date_add(F.lit("1999-01-01").cast("date"), F.col("id").cast("int")).cast("timestamp_ntz").alias("day"))
    orders = days.select(
        F.col("id").alias("o_orderkey"), F.col("day").alias("o_orderdate"), (F.col("id") % 9).alias("o_custkey"),
        F.lit(10.5).alias("o_totalprice"), F.when(F.col("id") % 3 == 0, "1-URGENT").otherwise("5-LOW").alias("o_orderpriority"),
    )
    parts = spark.range(12).select(F.col("id").alias("p_partkey"), F.concat(F.lit("Brand#"), F.col("id") % 6).alias("p_brand"))
    each = days.crossJoin(spark.range(2).toDF("line")).withColumn("l_partkey", (F.col("id") * 5 + F.col("line") * 7) % 12)
    item = each.select(
        F.col("id").alias("l_orderkey"), "l_partkey", F.col("day").alias("l_shipdate"), (F.col("l_partkey") % 6 * 10.0 + F.col("id") % 4 + 1).alias("l_quantity"),
        F.lit(3.25).alias("l_extendedprice"), F.lit(0.05).alias("l_discount"),
    )
    for name, df in (("orders", orders), ("part", parts), ("lineitem", item)):
        df.coalesce(1).write.parquet(f"{path}/{name}.parquet")


def test_monthly_rows_join_the_lines_once(spark, tmp_path, monkeypatch):
    from seriesloom.plans import cat_models, cat_window
    from seriesloom.plans import inputs as inp
    from seriesloom.sources import tables

    lines(spark, tmp_path)
    made, orders_monthly = [], tables.orders_monthly
    monkeypatch.setattr(tables, "orders_monthly", lambda *a, **k: made.append(1) or orders_monthly(*a, **k))
    rows, names = cat_models.monthly_rows(spark, str(tmp_path))
    assert len(made) == 1 and rows.count() == 6 * 24 and len(names) == 21
    keys = ["series", "month", "split", "dispatched", "ordered"]
    want = inp.monthly_with_split(spark, str(tmp_path)).join(cat_window.brand_labelled(spark, str(tmp_path)), "series").select(*keys, "cluster")
    got = rows.select(*keys, "cluster")
    assert want.exceptAll(got).isEmpty() and got.exceptAll(want).isEmpty() and got.select("cluster").distinct().count() == 3
