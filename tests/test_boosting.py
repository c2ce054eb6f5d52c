"""Boosting against plain numpy: penalties, ways of growth, categories, folds, stopping, blocks and cores."""

import os
import subprocess
import sys

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from seriesloom.operators import boosting, models
from seriesloom.operators.boosting import Boosting, Task

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def data(n=2000, noise=1.0, seed=0):
    rng = np.random.default_rng(seed)
    x = np.round(rng.uniform(-1, 1, size=(n, 4)), 3)
    x[:, 3] = rng.integers(0, 12, size=n)
    y = np.round(10 * x[:, 0] + 5 * (x[:, 1] > 0) * x[:, 2] + 4 * np.isin(x[:, 3], (1, 4, 7, 10)) + noise * rng.normal(size=n), 6)
    return x, y


def frame(spark, x, y, **columns):
    names = list(columns)
    rows = [(a.tolist(), float(b), *(columns[c][i] for c in names)) for i, (a, b) in enumerate(zip(x, y, strict=True))]
    schema = ", ".join(["x array<double>", "y double", *(f"{c} int" for c in names)])
    return spark.createDataFrame(rows, schema).withColumn("features", array_to_vector("x"))


def soft(g, l1):
    return np.sign(g) * max(abs(g) - l1, 0.0)


def plain_trees(x, y, config, edges, categorical=()):
    """Predictions on the rows it learns from, with every sum and every split by a plain loop."""
    binned = np.stack([np.searchsorted(e, x[:, j]) for j, e in enumerate(edges)], axis=1)
    out = np.full(len(y), y.mean())
    score = lambda g, h: soft(g, config.l1) ** 2 / (h + config.l2) if h + config.l2 > 0 else 0.0

    def candidates(rows):
        """(gain, feature, left bins) of a node, all of them."""
        g, h = (out - y)[rows].sum(), len(rows)
        for j in range(x.shape[1]):
            values = list(range(64))
            if j in categorical:
                mean = {b: (out - y)[rows][binned[rows, j] == b].mean() for b in set(binned[rows, j].tolist())}
                values = sorted(mean, key=lambda b: (mean[b], b)) + [b for b in values if b not in mean]
            for k in range(len(values) - 1):
                left = frozenset(values[: k + 1])
                inside = np.isin(binned[rows, j], list(left))
                gl, hl = (out - y)[rows][inside].sum(), int(inside.sum())
                yield score(gl, hl) + score(g - gl, h - hl) - score(g, h), j, k, left, hl, h - hl

    def best(rows):
        fit = [c for c in candidates(rows) if c[4] >= config.min_child and c[5] >= config.min_child]
        top = max(fit, key=lambda c: (round(c[0], 6), -c[1], -c[2]), default=None)
        return top if top and top[0] > 1e-6 else None

    def parts(rows, split):
        inside = np.isin(binned[rows, split[1]], list(split[3]))
        return [rows[inside], rows[~inside]]

    for _ in range(config.trees):
        leaves = [np.arange(len(y))]
        if config.growth == "level":
            for _ in range(config.depth):
                found = [(rows, best(rows)) for rows in leaves]
                leaves = [p for rows, split in found for p in (parts(rows, split) if split else [rows])]
        elif config.growth == "oblivious":
            for _ in range(config.depth):
                sums = {}
                for rows in leaves:
                    for gain, j, k, left, *_ in candidates(rows):
                        total, _ = sums.get((j, k), (0.0, None))
                        sums[j, k] = total + gain, left
                (j, k), (gain, left) = max(sums.items(), key=lambda s: (round(s[1][0], 6), -s[0][0], -s[0][1]))
                leaves = [p for rows in leaves for p in parts(rows, (gain, j, k, left))] if gain > 1e-6 else leaves
        else:
            depth = [0]
            while len(leaves) < config.leaves:
                open_ = [i for i in range(len(leaves)) if not config.depth or depth[i] < config.depth]
                found = [(s[0], i, s) for i in open_ if (s := best(leaves[i]))]
                if not found:
                    break
                _, i, split = max(found, key=lambda f: f[0])
                leaves[i : i + 1] = parts(leaves[i], split)
                depth[i : i + 1] = [depth[i] + 1] * 2
        step = np.zeros(len(y))
        for rows in leaves:
            g, h = (out - y)[rows].sum(), len(rows)
            step[rows] = -soft(g, config.l1) / (h + config.l2) if h + config.l2 > 0 else 0.0
        out = out + config.rate * step
    return out


CASES = {
    "plain": Boosting(4, 0.3, 3, l2=0.0),
    "l2": Boosting(4, 0.3, 3, 5, l2=20.0),
    "l1": Boosting(4, 0.3, 3, 5, l1=40.0, l2=1.0),
    "oblivious": Boosting(4, 0.3, 3, l2=3.0, growth="oblivious"),
    "leaf": Boosting(4, 0.3, 0, 10, l2=0.0, growth="leaf", leaves=9),
    "leaf of bounded depth": Boosting(3, 0.3, 2, 10, l1=5.0, growth="leaf", leaves=9),
}


@pytest.mark.parametrize("name", CASES)
@pytest.mark.parametrize("block", [1 << 16, 300])
def test_trees_are_those_of_plain_numpy(spark, monkeypatch, name, block):
    monkeypatch.setattr(boosting, "BLOCK_ROWS", block)
    monkeypatch.setattr(boosting, "REFRESH", 2)
    n = 2000 if name == "l2" else 400
    x, y = data(n)
    model = boosting.fit(frame(spark, x, y), [Task(CASES[name])], "y", bins=16)[0]
    want = plain_trees(x, y, CASES[name], model.edges)
    assert model.getNumTrees == CASES[name].trees and np.allclose(model.values(x), want, atol=1e-4)
    shown = model.transform(frame(spark, x[:50], y[:50])).select("predicted").collect()
    assert np.allclose([r[0] for r in shown], want[:50], atol=1e-4)


def test_sums_by_key_give_the_same_trees(spark, monkeypatch):
    x, y = data(900)
    whole = boosting.fit(frame(spark, x, y), [Task(CASES["l2"])], "y")[0].values(x)
    monkeypatch.setattr(boosting, "BLOCK_ROWS", 200)
    monkeypatch.setattr(boosting, "DRIVER_BYTES", 0)
    assert np.array_equal(boosting.fit(frame(spark, x, y), [Task(CASES["l2"])], "y")[0].values(x), whole)


def test_penalties_shrink_leaf_weights():
    assert boosting.weight(np.array([10.0]), np.array([4.0]), 0.0, 0.0) == -2.5
    assert boosting.weight(np.array([10.0]), np.array([4.0]), 2.0, 4.0) == -1.0
    assert boosting.weight(np.array([-1.0, 0.0]), np.array([4.0, 0.0]), 2.0, 0.0).tolist() == [0.0, 0.0]


def test_categories_are_split_by_sets(spark):
    x, y = data(800, noise=0.1)
    config = Boosting(3, 0.5, 2, 2, l2=1.0)
    model = boosting.fit(frame(spark, x, y), [Task(config)], "y", bins=16, categorical=(3,))[0]
    assert np.allclose(model.values(x), plain_trees(x, y, config, model.edges, (3,)), atol=1e-4)
    # The four categories of one level are no interval; a set takes them in one split.
    alone = Boosting(1, 1.0, 1, 1, l2=0.0)
    z = 4.0 * np.isin(x[:, 3], (1, 4, 7, 10))
    error = lambda cats: np.abs(boosting.fit(frame(spark, x[:, 3:], z), [Task(alone)], "y", categorical=cats)[0].values(x[:, 3:]) - z).max()
    assert error((0,)) < 1e-3 < error(())


def test_models_that_grow_together_equal_single_fits(spark):
    """Clusters, folds and points of a grid in one call against one call each, with drawn rows and columns."""
    x, y = data(1200)
    rows = frame(spark, x, y, cluster=[int(i % 3) for i in range(1200)], fold=[int(i // 3 % 4) for i in range(1200)])
    tasks = [
        Task(Boosting(5, 0.2, depth, 3, 0.7, 0.6, l1=l1), key, fold)
        for key in (0, 2)
        for fold in (0, 3)
        for depth in (2, 3)
        for l1 in (0.0, 9.0)
    ]
    together = boosting.fit(rows, tasks, "y", "cluster", fold=F.col("fold"))
    for task, model in list(zip(tasks, together, strict=True))[::5]:
        alone = boosting.fit(rows.where(F.col("cluster") == task.key), [task], "y", "cluster", fold=F.col("fold"))[0]
        assert model.held == alone.held and model.base == alone.base
        # Bins are shared by the models of a call, so only fits over the same rows have the same ones.
    same = boosting.fit(rows, tasks[3:4] + [Task(Boosting(1, 0.1, 1), 2)], "y", "cluster", fold=F.col("fold"))[0]
    inside = boosting.fit(rows.where("cluster <> 1"), tasks, "y", "cluster", fold=F.col("fold"))[3]
    alone = boosting.fit(rows.where("cluster <> 1"), [tasks[3], Task(Boosting(1, 0.1, 2), 2)], "y", "cluster", fold=F.col("fold"))[0]
    assert np.array_equal(inside.values(x), alone.values(x)) and inside.losses == alone.losses and same.rounds == 5


def test_folds_train_on_the_right_rows(spark):
    x, y = data(400)
    fold = [i // 100 for i in range(400)]
    rows = frame(spark, x, y, fold=fold)
    config = Boosting(3, 0.3, 2)
    for older, past in (("others", lambda f: f != 2), ("below", lambda f: f < 2), ("above", lambda f: f > 2 or f == 0)):
        model = boosting.fit(rows, [Task(config, fold=2, older=older)], "y", fold=F.col("fold"))[0]
        train, held = np.array([past(f) for f in fold]), np.array(fold) == 2
        assert model.base == pytest.approx(y[train].mean())
        assert model.losses[-1] == pytest.approx(((model.values(x[held]) - y[held]) ** 2).sum())
        assert model.r2() == pytest.approx(1 - model.losses[-1] / ((y[held] - y[held].mean()) ** 2).sum())


def test_boosting_stops_and_saves_the_work(spark):
    x, y = data(1500, noise=30.0)
    rows = frame(spark, x, y, role=[int(i % 4 == 0) for i in range(1500)])
    config = Boosting(60, 0.3, 3, stop_after=4)
    stopped = boosting.fit(rows, [Task(config)], "y", held=F.col("role") == 1)[0]
    full = boosting.fit(rows, [Task(Boosting(60, 0.3, 3))], "y", held=F.col("role") == 1)[0]
    keep = boosting.best_prefix(full.losses, 4)
    assert stopped.rounds == keep + 4 < 60 == full.rounds and stopped.getNumTrees == keep
    assert stopped.losses == full.losses[: stopped.rounds]


def test_odd_rows_and_tasks(spark):
    x, y = data(40)
    rows = frame(spark, x, y, cluster=[0] * 40)
    fitted = boosting.fit(rows, [Task(Boosting(2, 0.1, 2), 0), Task(Boosting(2, 0.1, 2), 7)], "y", "cluster")
    assert [m.getNumTrees for m in fitted] == [2, 0] and fitted[1].base == 0.0
    assert boosting.fit(rows.limit(0), [Task(Boosting(2, 0.1, 2))], "y")[0].getNumTrees == 0
    constant = boosting.fit(frame(spark, x, np.full(40, 3.0)), [Task(Boosting(2, 0.1, 2))], "y")[0]
    assert np.allclose(constant.values(x), 3.0) and sum(constant.importances()) == 0
    missing = rows.withColumn("y", F.when(F.col("y") > 0, F.col("y")))
    assert boosting.fit(missing, [Task(Boosting(1, 0.1, 1))], "y")[0].base == pytest.approx(y[y > 0].mean())
    with pytest.raises(ValueError):
        boosting.fit(rows, [Task(Boosting(1, 0.1, 1)), Task(Boosting(1, 0.1, 1, growth="leaf"))], "y")


SCRIPT = """
import sys
from pyspark.sql import functions as F
from seriesloom.operators import boosting, models
from seriesloom.session import local_session
boosting.BLOCK_ROWS = 700
spark = local_session("cores", sys.argv[1])
base = spark.range(3000).select(F.col("id"), *[(F.xxhash64("id", F.lit(i)) / 2.0**63).alias(f"x{i}") for i in range(4)])
rows = models.vectors(base.withColumn("y", F.col("x0") * 3 + F.col("x1")), ["x0", "x1", "x2", "x3"])
model = boosting.fit(rows, [boosting.Task(boosting.Boosting(4, 0.3, 3, 2, 0.7, 0.7, l1=0.5))], "y")[0]
print("SUM", repr(sum(t.value.sum() for t in model.trees)))
"""


def test_fits_do_not_depend_on_the_number_of_cores():
    found = set()
    for cores in ("2", "4"):
        env = os.environ | {"PYTHONPATH": ROOT}
        out = subprocess.run([sys.executable, "-c", SCRIPT, cores], env=env, capture_output=True, text=True, timeout=300)
        found.add([x for x in out.stdout.splitlines() if x.startswith("SUM")][0])
    assert len(found) == 1


def test_grid_search_finds_the_best_of_single_fits(spark):
    x, y = data(300, noise=4.0)
    rows = frame(spark, x, y, cluster=[i % 2 for i in range(300)], fold=[i // 2 % 3 for i in range(300)])
    grid = {"trees": (2, 4), "rate": (0.1, 0.4), "depth": (1, 3), "min_child": (2,), "rows": (0.8,), "cols": (1.0,), "l1": (0.0, 20.0), "l2": (1.0,)}
    assert all(set(g) == set(grid) for g in models.GRIDS.values())
    fitted, table = models.grid_search(rows, {0: grid, 1: grid}, "y", {0: Boosting(4, 0.1, 2), 1: Boosting(4, 0.1, 2)}, 3, bins=32)
    got = table.collect()
    assert len(got) == 2 * 16 and len({(r.cluster, str(sorted(r.params.items()))) for r in got}) == 32
    for c in (0, 1):
        mine = [r for r in got if r.cluster == c]
        (best,) = [r for r in mine if r.best]
        assert best.r2 == max(r.r2 for r in mine)
        values = {k: float(v) if k in ("rate", "l1", "l2", "rows", "cols") else int(v) for k, v in best.params.items()}
        assert fitted[c].task.config == Boosting(**values)
        for r in (best, mine[0], mine[-1]):
            values = {k: float(v) if k in ("rate", "l1", "l2", "rows", "cols") else int(v) for k, v in r.params.items()}
            tasks = [Task(Boosting(**values), c, f) for f in range(3)]
            singles = boosting.fit(rows, tasks + [Task(Boosting(1, 0.1, 1), 1 - c)], "y", "cluster", fold=F.col("fold"), bins=32)[:3]
            assert r.r2 == pytest.approx(np.mean([m.r2() for m in singles]))


class Plain:
    """Grows models level by level from whole histograms of all features, rows and nodes."""

    def __init__(self, unit, shape, seed):
        self.unit, self.shape, self.seed = unit, shape, seed

    def splits(self, plans, round_, level, blocks):
        columns = boosting._drawn_columns(self.shape, 0, self.seed, round_, level)
        return {0: boosting._choose(0, boosting._histograms(self.unit, plans[0], self.shape, self.seed, round_), columns, self.shape)}

    def settle(self):
        pass


def lone_unit(tasks, x, y, bins):
    folds = np.arange(len(y), dtype=np.int32) % 3
    train, held = (np.stack([boosting._roles(folds, t)[k] for t in tasks]) for k in (0, 1))
    draws = np.random.default_rng(5).integers(-(2**62), 2**62, len(y))
    f = np.repeat([[y[m].mean()] for m in train], len(y), axis=1)
    return boosting.Unit(0, 0, x, y, draws, train, held, f), boosting.Shape({0: tasks}, bins, len(x), 2.0**30, 2.0**40)


def test_lone_blocks_grow_the_same_trees_and_sum_less(monkeypatch):
    """Of two siblings the one with fewer rows is summed, and only features that may split."""
    rng = np.random.default_rng(3)
    n, width, bins, depth = 400, 10, 8, 4
    x, y = rng.integers(0, bins, (width, n)).astype(np.uint8), rng.exponential(50.0, n)
    tasks = [Task(Boosting(4, 0.3, depth, least, 0.8, cols, l1=l1, l2=l2), 0, f) for f in (0, 2) for least in (1, 9) for cols in (0.2, 0.4) for l1, l2 in ((0.0, 0.0), (30.0, 1.5))]
    unit, shape = lone_unit(tasks, x, y, bins)
    on, none = np.ones(len(tasks), dtype=bool), [[] for _ in tasks]
    plain = Plain(unit, shape, 9)
    want = []
    for r in range(4):
        want.append(boosting._by_level(plain, {0: on}, r, 1)[0])
        plain.unit = boosting._advanced(plain.unit, want[-1])
    summed = []
    bincount = np.bincount
    monkeypatch.setattr(np, "bincount", lambda a, *rest, **more: summed.append(len(a)) or bincount(a, *rest, **more))
    alone = boosting._Alone(unit, shape, 9)
    got = [tree for _, tree, _ in alone.rounds(on, 0, boosting._by_level, none, on, True)]
    assert len(got) == 4 and all(np.array_equal(a[k], b[k]) for a, b in zip(got, want, strict=True) for k in ("feature", "goes", "left", "value", "gain"))
    assert np.array_equal(alone.unit.f, plain.unit.f)
    # Gradients and counts of the drawn rows once for the root and at most half of them for each level below, in 4 of 10 features.
    drawn = sum(int(boosting._drawn_rows(unit, shape, 9, r).sum()) for r in range(4))
    assert sum(summed) <= 2 * 4 * drawn * (1 + (depth - 1) / 2)


def test_losses_alone_take_fewer_jobs(spark, monkeypatch):
    x, y = data(300)
    rows = frame(spark, x, y, fold=[i % 3 for i in range(300)])
    tasks = [Task(Boosting(trees, 0.2, 2, rows=0.8), fold=f) for trees in (5, 40) for f in range(3)]
    jobs, rounds = [], boosting._Run.rounds
    monkeypatch.setattr(boosting._Run, "rounds", lambda self, *a: jobs.append(1) or rounds(self, *a))
    lean = boosting.fit(rows, tasks, "y", fold=F.col("fold"), keep_trees=False)
    assert len(jobs) == 1
    whole = boosting.fit(rows, tasks, "y", fold=F.col("fold"))
    assert len(jobs) == 4 and [m.losses for m in lean] == [m.losses for m in whole] and [len(m.losses) for m in lean] == [5] * 3 + [40] * 3
