"""K-means steps over blocks of rows."""

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler

from seriesloom.operators import cluster


def test_kmeans_step_reads_blocks_of_arrays(spark):
    rng = np.random.default_rng(5)
    x = np.vstack([rng.normal(size=(700, 3)), [[1.0, 1.0, 1.0]] * 5])
    df = spark.createDataFrame([tuple(map(float, r)) for r in x], "a double, b double, c double").repartition(3)
    blocks = cluster._blocks(VectorAssembler(inputCols=["a", "b", "c"], outputCol="features").transform(df))
    try:
        held = blocks.collect()
        assert len(held) <= blocks.getNumPartitions() and sum(len(h) for h, _ in held) == len(x)
        # Two runs of two centres, one of which has no rows in the second, and a run of three with two equal ones.
        two = np.array([[0.0, 0, 0], [1, 1, 1], [0, 0, 0], [99, 99, 99]])
        three = np.array([[1.0, 1, 1], [1, 1, 1], [-1, 0, 0]])
        points, shapes = np.vstack([two, three]), [(2, 2), (1, 3)]
        n, cost, sums = cluster._added(blocks.mapPartitions(cluster._assigned(points, shapes)), points.nbytes)
    finally:
        blocks.unpersist()
    at = 0
    for run, k in enumerate([2, 2, 3]):
        own = points[at : at + k]
        far = ((x[:, None] - own) ** 2).sum(2)
        nearest = far.argmin(1)
        assert n[at : at + k].tolist() == np.bincount(nearest, minlength=k).tolist()
        assert cost[run] == pytest.approx(far.min(1).sum())
        for j in range(k):
            assert sums[at + j] == pytest.approx(x[nearest == j].sum(0) if (nearest == j).any() else np.zeros(3))
        at += k


def test_kmeans_sums_of_many_partitions_are_added_by_tasks(spark, monkeypatch):
    parts = spark.sparkContext.parallelize([(np.array([float(i)]), np.array([1.0, i])) for i in range(20)], 20)
    on_driver = cluster._added(parts, 24)
    monkeypatch.setattr(cluster, "DRIVER_BYTES", 0)
    by_tasks = cluster._added(parts, 24)
    assert [a.tolist() for a in on_driver] == [a.tolist() for a in by_tasks] == [[190.0], [20.0, 190.0]]
