"""Connected components of an undirected graph whose edges are rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, store


def components(edges: DataFrame) -> DataFrame:
    """(`node`, `root`) of every node of edges (`a`, `b`): the smallest node reachable, itself included.

    Alternates the large-star and small-star steps until the edges are stars. Neighbours are only ever reduced to
    their minimum, so a node with very many of them is summed before each shuffle. Each round is
    written to the shared folder.
    """
    spark = edges.sparkSession
    own = edges.filter("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    now, path = store(own, "edges")
    mark = None
    while True:
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", "m"))
        following, next_path = store(small.distinct(), "edges")
        discard(spark, path)
        now, path = following, next_path
        seen = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if seen == mark:
            break
        mark = seen
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(now.select("v", "v").distinct())
