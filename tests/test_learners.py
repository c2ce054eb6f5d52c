"""K-means, smoothing, bending trends and the run ledger against plain Python."""

import datetime

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from seriesloom.operators import boosting, cluster, models, recursive, trend
from seriesloom.operators.boosting import Boosting
from seriesloom.sources import ledger
from seriesloom.spec import SeriesSpec

# --- k-means -----------------------------------------------------------------------------


@pytest.fixture(scope="module")
def points(spark):
    rng = np.random.default_rng(1)
    x = np.concatenate([rng.normal(c, 0.6, size=(60, 2)) for c in ((0, 0), (4, 0), (0, 5), (6, 6))])
    frame = spark.createDataFrame([(f"s{i}", *map(float, p)) for i, p in enumerate(x)], "series string, a double, b double")
    return x, cluster.assemble(frame, ["a", "b"])


def plain_lloyd(x, centres, max_iter, tol):
    for _ in range(max_iter):
        near = ((x[:, None] - centres) ** 2).sum(-1).argmin(1)
        moved = np.stack([x[near == k].mean(0) if (near == k).any() else c for k, c in enumerate(centres)])
        shift = np.sqrt(((moved - centres) ** 2).sum(1)).max()
        if shift <= tol:
            break
        centres = moved
    return centres, ((x[:, None] - centres) ** 2).sum(-1).min(1).sum()


def test_runs_together_equal_single_runs(points):
    x, vectors = points
    together = cluster.kmeans_runs(vectors, (2, 4), 5, 50, 1e-6)
    assert [(r.k, r.seed) for r in together] == [(k, 42 + i) for k in (2, 4) for i in range(5)]
    for run in together[::3]:
        alone = cluster.kmeans_runs(vectors, (run.k,), 1, 50, 1e-6, run.seed)[0]
        assert alone.cost == pytest.approx(run.cost) and alone.iterations == run.iterations and np.allclose(alone.points, run.points)
    for run in together:
        # A settled run is a fixed point of plain Lloyd steps, and its cost is theirs.
        centres, cost = plain_lloyd(x, run.points, 5, 1e-6)
        assert np.allclose(centres, run.points, atol=1e-5) and run.cost == pytest.approx(cost)
    best = cluster.best_runs(together)
    assert best[4].cost == min(r.cost for r in together if r.k == 4) < 2 * 240 * 0.6**2 * 1.3


def test_starts_are_spread_by_squared_distance(points):
    x, vectors = points
    starts = cluster.kmeans_runs(vectors, (4,), 40, 0, 1e-6)
    groups = [len({int(((p - np.array([(0, 0), (4, 0), (0, 5), (6, 6)])) ** 2).sum(1).argmin()) for p in r.points}) for r in starts]
    assert all(any(np.allclose(p, row) for row in x) for r in starts[:5] for p in r.points)
    # Uniform starts hit all four groups in one run of ten, these in most.
    assert sum(g == 4 for g in groups) > 20


def test_sweep_takes_as_many_jobs_as_steps(points, spark):
    _, vectors = points
    context = spark.sparkContext
    context.setJobGroup("sweep", "")
    swept = cluster.sweep(vectors, ["a", "b"], (2, 3, 4), 10, 30, 1e-4).collect()
    jobs = len(context.statusTracker().getJobIdsForGroup("sweep"))
    context.setLocalProperty("spark.jobGroup.id", None)
    assert {r.k for r in swept} == {2, 3, 4} and max(swept, key=lambda r: r.silhouette).k == 4
    assert sorted(swept, key=lambda r: r.k)[0].inertia > sorted(swept, key=lambda r: r.k)[2].inertia
    # Two or three jobs a step under adaptive execution, for 30 runs.
    assert jobs <= 3 * (4 + max(r.iterations for r in swept) + 32) and jobs < 30 * 4


def test_fewer_rows_than_centres(spark):
    frame = spark.createDataFrame([("a", 1.0), ("b", 1.0), ("c", 5.0)], "series string, x double")
    run = cluster.kmeans_runs(cluster.assemble(frame, ["x"]), (3,), 2, 10, 1e-6)[0]
    assert run.cost == 0.0 and {1.0, 5.0} <= set(run.points.ravel())
    assert cluster.kmeans_runs(cluster.assemble(frame.limit(0), ["x"]), (3,), 2, 10, 1e-6) == []


# --- smoothing ---------------------------------------------------------------------------


def plain_smoothing(y, weights, states, season):
    a, b, g, phi = weights
    level, slope, seasonal, fitted = states[0], states[1], list(states[2:]), []
    for t, v in enumerate(y):
        base = level + phi * slope
        fitted.append(base + seasonal[t % season])
        new = a * (v - seasonal[t % season]) + (1 - a) * base
        slope = b * (new - level) + (1 - b) * phi * slope
        seasonal[t % season] = g * (v - base) + (1 - g) * seasonal[t % season]
        level = new
    return np.array(fitted), level, slope, seasonal


@pytest.fixture(scope="module")
def months():
    rng = np.random.default_rng(0)
    t = np.arange(60)
    return np.array([50 + 0.5 * t + 10 * np.sin(2 * np.pi * t / 12) + s * rng.normal(size=60) for s in (1, 8)] + [rng.poisson(3, 60).astype(float), np.zeros(60)])


def test_smoothing_is_the_plain_recursion_and_beats_every_grid_point(months):
    fitted, future, weights = recursive._holt_winters(months, 12, 7)
    errors, _ = recursive._responses(months, weights[:, None], 12)
    states, cost = recursive._starts(errors)
    grid = np.array(list(np.array(np.meshgrid(*recursive.GRID.values())).reshape(4, -1).T))
    for i, y in enumerate(months):
        plain, level, slope, seasonal = plain_smoothing(y, weights[i], states[i, 0], 12)
        assert np.allclose(plain, fitted[i], atol=1e-5) and cost[i, 0] == pytest.approx(((plain - y) ** 2).sum(), abs=1e-6)
        ahead = [level + sum(weights[i, 3] ** k for k in range(1, h + 1)) * slope + seasonal[(60 + h - 1) % 12] for h in range(1, 8)]
        assert np.allclose(ahead, future[i], atol=1e-5)
        # The usual starting states: first mean, mean step between seasons, first deviations.
        first = y[:12].mean()
        start = np.array([first, (y[12:24].mean() - first) / 12, *(y[:12] - first)])
        assert cost[i, 0] <= min(((plain_smoothing(y, g, start, 12)[0] - y) ** 2).sum() for g in grid) + 1e-6
    drawn = np.random.default_rng(3).uniform(*recursive.BOUNDS.T, size=(len(months), 500, 4))
    assert (cost[:, 0] <= recursive._costs(months, drawn, 12).min(1) * (1 + 1e-6) + 1e-9).all()
    low, high = recursive.BOUNDS.T
    assert (weights >= low).all() and (weights <= high).all()


def test_smoothing_of_series_of_different_lengths(spark, months):
    rows = []
    for i, y in enumerate(months):
        n = 60 - 6 * i
        for t in range(n):
            split = "test" if t >= n - 5 else "train"
            rows.append((f"s{i}", datetime.date(2000 + t // 12, t % 12 + 1, 1), split, float(y[t])))
    rows += [("short", datetime.date(2000, t + 1, 1), "train", 1.0) for t in range(12)]
    spec = SeriesSpec(time="month", target="v")
    got = recursive.holt_winters(spark.createDataFrame(rows, "series string, month date, split string, v double"), spec, "v").collect()
    assert len(got) == len(rows) - 12 and "short" not in {r.series for r in got}
    for i in (0, 2):
        mine = sorted((r for r in got if r.series == f"s{i}"), key=lambda r: r.month)
        n = 60 - 6 * i
        fitted, future, _ = recursive._holt_winters(months[i : i + 1, : n - 5], 12, 5)
        assert np.allclose([r.predicted for r in mine], np.concatenate([fitted[0], future[0]]))
        assert [r.actual for r in mine] == months[i, :n].tolist()


# --- bending trend -----------------------------------------------------------------------


def panel(spark, days=500, test=60):
    rng = np.random.default_rng(2)
    first, rows = datetime.date(1999, 1, 1), []
    for c in (0, 1):
        for s in range(3):
            for t in range(days):
                bend = 0.004 * max(0, t - 200) if c == 0 else 0.0
                y = np.expm1(2 + 0.2 * s + 0.001 * t + bend + 0.3 * np.sin(2 * np.pi * t / 7) + 0.05 * rng.normal())
                day = first + datetime.timedelta(days=t)
                rows.append((f"{c}{s}", c, day, "train" if t < days - test else "test", float(y), float(t % 5)))
    return spark.createDataFrame(rows, "series string, cluster int, date date, split string, dispatched double, x double")


def test_a_bend_is_found_and_intervals_widen(spark):
    rows = panel(spark)
    got = trend.seasonal_regression(rows, SeriesSpec(), ["x"]).toPandas()
    assert len(got) == rows.count()
    held = got[got["split"] == "test"].sort_values(["series", "date"])
    log = lambda c: np.log1p(held[c])
    assert np.abs(log("predicted") - log("actual")).mean() < 0.25
    inside = ((held["actual"] >= held["lower"]) & (held["actual"] <= held["upper"])).mean()
    assert inside > 0.8
    width = (log("upper") - log("lower")).to_numpy().reshape(6, -1)
    assert (width[:, -1] >= width[:, 0] - 1e-9).all() and (width[:3, -1] > width[:3, 0]).all()


def test_solution_meets_its_optimality_conditions():
    rng = np.random.default_rng(4)
    z = rng.normal(size=(300, 8))
    y = z @ np.array([2.0, 0, 0, 1.0, -1.0, 0, 0, 0.05]) + rng.normal(size=300)
    lasso = np.arange(8) < 5
    penalties = trend.Penalties(np.where(lasso, 0.05, 10.0), lasso)
    w, sigma = trend.solve(z.T @ z, z.T @ y, float(y @ y), 300, penalties)
    pull, cut = z.T @ (y - z @ w), sigma**2 / 0.05
    assert np.allclose(pull[~lasso], sigma**2 / 100 * w[~lasso], atol=1e-3)
    for j in np.flatnonzero(lasso):
        assert abs(pull[j] - np.sign(w[j]) * cut) < 1e-2 if w[j] else abs(pull[j]) <= cut + 1e-2
    assert sigma == pytest.approx(np.sqrt(((y - z @ w) ** 2).mean()), rel=1e-4)


def test_fit_without_penalties_is_least_squares():
    rng = np.random.default_rng(5)
    x = np.column_stack([np.ones(200), rng.uniform(size=200), rng.normal(5, 100, size=200)])
    y = x @ np.array([3.0, 2.0, 0.01]) + 0.1 * rng.normal(size=200)
    z = np.column_stack([x, y])
    found = trend.fit(z.T @ z, slice(1, 1), 1)
    assert np.allclose(found.weights, np.linalg.lstsq(x, y, rcond=None)[0], atol=1e-2)


def test_trend_of_no_train_rows(spark):
    rows = panel(spark, 40, 10).where("split = 'test'")
    assert trend.seasonal_regression(rows, SeriesSpec(), ["x"]).collect() == []


# --- failures ----------------------------------------------------------------------------


def test_a_failing_cluster_costs_itself_only(spark, monkeypatch):
    rng = np.random.default_rng(0)
    data = [(int(i % 3), "train" if i % 3 < 2 else "test", rng.normal(size=2).tolist(), float(i)) for i in range(90)]
    rows = spark.createDataFrame(data, "cluster int, split string, x array<double>, y double").withColumn("features", array_to_vector("x"))
    configs = {c: Boosting(2, 0.1, 2) for c in range(3)}
    fitted, errors = models.fit_isolated(rows, configs, "y", "cluster")
    assert set(fitted) == {0, 1} and errors == {2: "no rows to learn from"}
    whole = boosting.fit

    def fragile(rows, tasks, *args, **options):
        if any(t.key == 1 for t in tasks):
            raise RuntimeError("bad cluster")
        return whole(rows, tasks, *args, **options)

    monkeypatch.setattr(boosting, "fit", fragile)
    fitted, errors = models.fit_isolated(rows, configs, "y", "cluster")
    assert set(fitted) == {0} and errors == {1: "RuntimeError: bad cluster", 2: "no rows to learn from"}
    told = {}
    more = rows.unionByName(rows.where("cluster < 2").withColumn("split", F.lit("test")))
    pairs = models.panel_by_cluster(more, {**configs, 3: configs[0]}, "y", ["cluster"], [0, 1, 2], errors=told)
    assert {r.cluster for r in pairs.collect()} == {0} and told == errors


def test_a_restart_does_what_is_left(spark, tmp_path):
    path = str(tmp_path / "ledger")
    rows = spark.createDataFrame([(s, 1.0) for s in "abcd"], "series string, v double")
    status = rows.select("series", F.when(F.col("series") == "d", "too short").alias("error"))
    worked = []

    def work(todo):
        worked.append(sorted(r.series for r in todo.collect()))

    def broken(todo):
        raise OSError("disk")

    assert ledger.run(rows.where("series = 'a'"), status, path, "1", "fit", work) == 1
    assert ledger.run(rows.where("series <> 'a'"), status, path, "2", "fit", broken) == 2
    seen = {r.series: r.error for r in ledger.latest(spark, path).collect()}
    assert seen == {"a": None, "b": "OSError: disk", "c": "OSError: disk", "d": "too short"}
    assert ledger.run(rows, status, path, "3", "fit", work) == 2 and worked == [["a"], ["b", "c"]]
    assert {r.series: r.error for r in ledger.latest(spark, path).collect()} == {"a": None, "b": None, "c": None, "d": "too short"}
    assert ledger.run(rows, status, path, "4", "fit", work) == 0 and len(worked) == 2
    assert ledger.run(rows, status, path, "4", "score", work) == 3
