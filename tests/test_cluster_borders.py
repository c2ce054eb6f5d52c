"""K-means steps that compare only rows near a border, the race for starts, labels and silhouettes of several clusterings."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from seriesloom.operators import cluster


def vectors(spark, x):
    names = [f"c{i}" for i in range(x.shape[1])]
    rows = [(f"s{i}", *map(float, r)) for i, r in enumerate(x)]
    return cluster.assemble(spark.createDataFrame(rows, "series string, " + ", ".join(f"{c} double" for c in names)).repartition(3), names), names


def plain_lloyd(x, centres, max_iter, tol):
    for step in range(max_iter + 1):
        near = ((x[:, None] - centres) ** 2).sum(-1).argmin(1)
        moved = np.stack([x[near == k].mean(0) if (near == k).any() else c for k, c in enumerate(centres)])
        if np.sqrt(((moved - centres) ** 2).sum(1)).max() <= tol or step == max_iter:
            return centres, ((x[:, None] - centres) ** 2).sum(-1).min(1).sum(), step
        centres = moved


def test_runs_compare_few_rows_and_equal_plain_steps_over_all(spark, monkeypatch):
    x = np.random.default_rng(3).normal(size=(3000, 3))
    rows, _ = vectors(spark, np.vstack([x, x[:50]]))  # some rows come twice
    x = np.vstack([x, x[:50]])
    starts = cluster.kmeans_runs(rows, (2, 5), 6, 0, 1e-6)
    over_all, looked_up, whole, borders = [], [], cluster._assigned, cluster._near_borders
    monkeypatch.setattr(cluster, "_assigned", lambda p, s: over_all.append(len(p)) or whole(p, s))
    monkeypatch.setattr(cluster, "_near_borders", lambda p, s, r: looked_up.append(len(p)) or borders(p, s, r))
    runs = cluster.kmeans_runs(rows, (2, 5), 6, 200, 1e-6)
    for start, run in zip(starts, runs, strict=True):
        centres, cost, steps = plain_lloyd(x, start.points, 200, 1e-6)
        assert (run.k, run.seed, run.iterations) == (start.k, start.seed, steps)
        assert np.allclose(run.points, centres, rtol=0, atol=1e-9) and run.cost == pytest.approx(cost)
    assert looked_up and sum(over_all) + 2 * sum(looked_up) < 0.8 * sum(r.k * (r.iterations + 1) for r in runs)


def test_rows_near_borders_are_enough_while_centres_stay_in_reach():
    rng = np.random.default_rng(4)
    x = np.vstack([rng.normal(size=(900, 3)), [[1.0, 1.0, 1.0]] * 5])
    # A run of three with two equal centres, two runs of four and a run of one.
    points = np.vstack([[[0.0, 0, 0], [0, 0, 0], [1, 1, 1]], rng.normal(size=(4, 3)), rng.normal(size=(4, 3)), [[0.5, 0, 0]]])
    shapes, lows, reaches = [(1, 3), (2, 4), (1, 1)], [0, 3, 7, 11, 12], [0.2, 0.05, 0.4, 1.0]
    held = list(cluster._near_borders(points, shapes, reaches)(iter([(None, x[:600]), (None, x[600:])])))
    share = [sum(len(near[r]) for _, near, _ in held) / len(x) for r in range(4)]
    assert 0 < share[1] < share[2] < 1 and share[3] == 0
    for _ in range(5):
        way = rng.normal(size=points.shape)
        way *= np.repeat(reaches, np.diff(lows))[:, None] / 2 / np.sqrt((way**2).sum(1))[:, None]
        n, cost, sums = next(cluster._assigned(points + way, shapes)(iter([(None, x)])))
        some = [0, 2, 3]
        moved = [(points + way)[lows[r] : lows[r + 1]] for r in some]
        again = next(cluster._assigned_again(moved, some, [lows[r] for r in some])(iter(held)))
        kept = np.concatenate([np.arange(lows[r], lows[r + 1]) for r in some])
        assert again[0].tolist() == n[kept].tolist() and np.allclose(again[1], sums[kept], rtol=0, atol=1e-9)
        assert cost[3] == pytest.approx(((x - (points + way)[11]) ** 2).sum())


def test_rows_out_of_the_race_would_not_have_won():
    rng = np.random.default_rng(5)
    x, h = rng.normal(size=(cluster.FIRST + 5000, 2)), rng.integers(-(2**62), 2**62, cluster.FIRST + 5000)
    h[4000:4003] = h[8000:8003]
    centres, seeds = [[x[r], x[r + 9]] for r in range(30)], list(range(30))
    for step in (0, 2):
        won = dict(cluster._drawn(centres, seeds, list(range(30)), step)(iter([(h, x)])))
        for run in range(30):
            rate = ((x[:, None] - np.stack(centres[run])) ** 2).sum(2).min(1) if step else np.ones(len(x))
            with np.errstate(divide="ignore"):
                time = -np.log(cluster._uniform(h, seeds[run], step)) / rate
            assert won[run][0] == pytest.approx(time.min()) and won[run][1] == x[time.argmin()].tolist()


def test_rows_on_centres_never_win():
    x = np.zeros((cluster.FIRST + 10, 2))
    won = dict(cluster._drawn([[x[0]]], [7], [0], 1)(iter([(np.arange(len(x)), x)])))
    assert won == {0: (np.inf, [0.0, 0.0])}


def test_the_first_of_runs_that_differ_by_rounding_counts():
    run = lambda seed, cost: cluster.Centres(3, seed, np.zeros((3, 1)), cost, seed)
    best = lambda *runs: cluster.best_runs(list(runs))[3].seed
    assert best(run(1, 7.0), run(2, 5.0), run(3, np.nextafter(5.0, 0.0)), run(4, 5.0)) == 2
    assert best(run(1, 5.0), run(2, 5.0 - 1e-9)) == 2 and best(run(1, 0.0), run(2, 0.0)) == 1


def test_blocks_hold_at_most_block_rows(monkeypatch):
    import pandas as pd

    monkeypatch.setattr(cluster, "BLOCK", 100)
    batches = [pd.DataFrame({"h": np.arange(n), "x": list(np.full((n, 2), float(n)))}) for n in (30, 60, 0, 250, 5)]
    sizes = [len(np.frombuffer(b["h"][0], dtype="int64")) for b in cluster._blocked(iter(batches))]
    assert max(sizes) <= 100 and sum(sizes) == 345 and len(sizes) == 4


def test_predictions_take_the_first_of_equally_near_centres(spark):
    x = np.array([[0.0, 0.0], [1.0, 0.0], [2.0, 0.0], [5.0, 1.0]])
    rows, _ = vectors(spark, x)
    two = cluster.Centres(2, 0, np.array([[2.0, 0.0], [0.0, 0.0]]), 0.0, 0)
    three = cluster.Centres(3, 0, np.array([[9.0, 9.0], [0.0, 0.0], [2.0, 0.0]]), 0.0, 0)
    found = cluster.predictions(rows, {"a": two, "b": three})
    assert dict(found.dtypes)["a"] == "int" and found.columns == [*rows.columns, "a", "b"]
    assert sorted((r.series, r.a, r.b) for r in found.collect()) == [("s0", 1, 1), ("s1", 0, 1), ("s2", 0, 2), ("s3", 0, 2)]
    assert sorted(r.prediction for r in two.transform(rows).collect()) == [0, 0, 0, 1]


def test_silhouettes_of_several_clusterings_equal_single_ones(spark):
    x = np.vstack([np.random.default_rng(6).normal(size=(300, 3)), [[9.0, 9.0, 9.0]], [[4.0, 4.0, 4.0]] * 3])
    rows, names = vectors(spark, x)
    i = F.regexp_replace("series", "s", "").cast("int")
    # Three clusters; one of a single row; one of equal rows; only one cluster at all.
    table = rows.withColumns(
        {"a": i % 3, "b": (i == 300).cast("int"), "c": F.when(i > 300, 7).otherwise(i % 2), "d": F.lit(0)}
    )
    found = cluster.silhouettes(table, names, ["a", "b", "c", "d"])
    for by, score in found.items():
        assert score == pytest.approx(cluster.silhouette(table, names, by).first()[0], abs=1e-12)
    assert found["b"] > 0.3 and found["d"] == 0.0
