"""Panels by part: few shuffles, and the rows of the general form."""

import datetime

from pyspark.sql import functions as F

from seriesloom.plans import inputs as inp
from seriesloom.sources import tables

SF = "/root/testdata/sf0.001"


def test_profiles_are_dealt_by_part_once(spark, monkeypatch):
    """After the lines have met their orders: one shuffle by part and month, one by series, none for months and profiles."""
    real = inp.external(spark, SF)
    monkeypatch.setattr(inp, "external", lambda *_: F.broadcast(real))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = inp.profiles(spark, SF)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    dealt = [line for line in plan.split("\n") if " Exchange hashpartitioning" in line]
    # Lines and orders, part and month, the sums and the names by series.
    assert len(dealt) == 5, plan


def test_parts_monthly_with_repeated_and_missing_keys(spark, tmp_path):
    day = lambda m, d: datetime.datetime(1999, m, d)
    part = [(1, "one"), (2, "two"), (2, "zwei"), (3, None), (3, None), (None, "none")]
    orders = [(10, day(1, 5)), (11, day(2, 6)), (11, day(2, 7)), (12, datetime.datetime(1997, 1, 1)), (None, day(3, 3))]
    lines = [(10, 1, 4.0, day(1, 20)), (10, 1, 4.0, day(1, 20)), (11, 2, 5.0, day(3, 1)), (12, 3, 6.0, day(4, 1)), (12, 3, None, day(4, 2))]
    lines += [(None, 1, 7.0, day(5, 1)), (10, None, 8.0, day(5, 2)), (11, 9, 9.0, day(5, 3)), (12, 1, 2.0, datetime.datetime(1997, 2, 1))]
    made = {
        "part": (part, "p_partkey long, p_name string"),
        "orders": (orders, "o_orderkey long, o_orderdate timestamp_ntz"),
        "lineitem": (lines, "l_orderkey long, l_partkey long, l_quantity double, l_shipdate timestamp_ntz"),
    }
    for name, (rows, schema) in made.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    sf, since = str(tmp_path), "1998-01-01"
    plain = tables.orders_monthly(spark, sf, F.col("p_partkey").cast("string"), F.col("p_name"), since)
    rows = lambda df: sorted(map(str, df.select("series", "series_name", "month", "dispatched", "ordered").collect()))
    assert rows(tables.parts_monthly(spark, sf, since)) == rows(plain) and plain.count() > 5
