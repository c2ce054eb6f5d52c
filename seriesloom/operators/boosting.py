"""Second-order gradient boosting as keyed aggregates over all rows.

Features are binned once. Rows lie in blocks, and the aggregate of a level sums gradients and counts by (model, node,
feature, bin) over all blocks at once, so every model of a call (clusters, folds, points of a grid) grows in the same
job. What reaches the driver is bounded by models and nodes, never by rows: splits, or histograms of a few models.

Gradients are rounded to multiples of a power of two that keeps their sums exact, so trees depend neither on the order in
which blocks are added up nor on the number of cores. Rows and columns are drawn by hashes of the row and of (seed, round).

Trees grow by level, leaf by leaf (the best leaf of a tree first, up to a number of leaves), or oblivious (one split for
all nodes of a level). Predictions of all rows are carried from round to round; every REFRESH rounds they are
checkpointed in the shared folder. Where one block holds all rows of every model, its sums are whole already and REFRESH rounds,
or LOSS_ROUNDS where only losses are asked for, are one job; the trees are the same. Boosting ends when no model is left that its validation rows allow to go on.
"""

from __future__ import annotations

import heapq
import math
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pandas as pd
from pyspark import RDD, StorageLevel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seriesloom.session import cut_lineage, discard, shared_root

SEED = 42
#: At most 64: the bins that go left are the bits of one number.
BINS = 64
#: Rows of a block, elements (models x rows) and models of a chunk: bounds of what one task holds at a time.
BLOCK_ROWS = 1 << 16
CHUNK_CELLS, CHUNK_MODELS = 1 << 15, 256
#: Models of a chunk even of the largest blocks, as far as there are so many: they share the block's features.
LEAST_MODELS = 4
#: Cells of the histograms whose splits are weighed at a time, few enough to stay in a core's cache.
WEIGHED_CELLS = 1 << 15
#: Histograms up to this many bytes are summed on the driver; beyond it they are summed by key first.
DRIVER_BYTES = 64 << 20
REFRESH = 16
#: Rounds of a job where no trees are kept and each block holds all rows of its models.
LOSS_ROUNDS = 64

#: Fold of a row that validates every model.
HELD = -2


@dataclass(frozen=True)
class Boosting:
    """Trees, learning rate, depth, least hessian of a child, row share, column share, validation patience, penalties.

    ``l1`` and ``l2`` are the penalties of leaf weights, ``least_gain`` what a split must bring. ``growth`` is `level`, `leaf`
    (up to ``leaves``, and ``depth`` of 0 for no limit) or `oblivious`. Rows are drawn anew every ``every`` rounds.
    """

    trees: int
    rate: float
    depth: int
    min_child: float = 1
    rows: float = 1.0
    cols: float = 1.0
    stop_after: int | None = None
    l1: float = 0.0
    l2: float = 1.0
    least_gain: float = 0.0
    growth: str = "level"
    leaves: int = 31
    every: int = 1


@dataclass(frozen=True)
class Task:
    """One model: the rows it learns from (`key` of the by column, folds) and its configuration.

    With ``fold`` the rows of that fold validate; ``older`` says what trains: all `others`, folds `below`, or folds `above` and 0.
    """

    config: Boosting
    key: int = 0
    fold: int | None = None
    older: str = "others"


@dataclass
class Tree:
    """Split feature (-1: leaf), bins that go left (one bit each), left child (the right one follows), value, gain, by node."""

    feature: np.ndarray
    goes: np.ndarray
    left: np.ndarray
    value: np.ndarray
    gain: np.ndarray


@dataclass
class Fitted:
    """A model: base, trees up to the best round, the cuts of every feature, validation losses by round."""

    task: Task
    base: float
    edges: list[np.ndarray]
    trees: list[Tree] = field(default_factory=list)
    losses: list[float] = field(default_factory=list)
    held: tuple[float, float, float] = (0.0, 0.0, 0.0)
    rounds: int = 0

    @property
    def getNumTrees(self) -> int:
        return len(self.trees)

    def binned(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(self.edges)]).astype(np.uint8)

    def values(self, x: np.ndarray) -> np.ndarray:
        """Predictions of rows of feature values."""
        out, binned, row = np.full(len(x), self.base), self.binned(x), np.arange(len(x))
        for tree in self.trees:
            node = np.zeros(len(x), dtype=np.int64)
            while True:
                feature = tree.feature[node]
                if (feature < 0).all():
                    break
                node = np.where(feature >= 0, tree.left[node] + _right(tree.goes[node], binned[feature, row]), node)
            out += tree.value[node]
        return out

    def transform(self, rows: DataFrame) -> DataFrame:
        return predictions({self.task.key: self}, rows)

    def importances(self) -> list[float]:
        """Mean gain of a feature's splits as a share of the sum over features."""
        gain, count = np.zeros(len(self.edges)), np.zeros(len(self.edges))
        for tree in self.trees:
            inner = tree.feature >= 0
            np.add.at(gain, tree.feature[inner], tree.gain[inner])
            np.add.at(count, tree.feature[inner], 1)
        mean = gain / np.maximum(count, 1)
        return (mean / (mean.sum() or 1.0)).tolist()

    def r2(self, rounds: int | None = None) -> float | None:
        """R2 on the validation rows after some rounds; none without such rows or where they are constant."""
        n, total, squares = self.held
        spread = squares - total * total / n if n else 0.0
        if not self.losses or spread <= 0:
            return None
        return 1.0 - self.losses[min(rounds or len(self.losses), len(self.losses)) - 1] / spread


def _right(goes: np.ndarray, bins: np.ndarray) -> np.ndarray:
    """0 for rows that go left, 1 for the others."""
    return (1 - ((goes >> bins.astype(np.uint64)) & np.uint64(1)).astype(np.int64)).astype(np.int32)


def best_prefix(losses: list[float], patience: int) -> int:
    """Trees to keep: up to the lowest loss that is seen before ``patience`` trees bring no new lowest one.

    >>> best_prefix([5.0, 3.0, 4.0, 2.0], 1), best_prefix([5.0, 3.0, 4.0, 2.0], 2)
    (2, 4)
    """
    best = 0
    for i, loss in enumerate(losses):
        if loss < losses[best]:
            best = i
        elif i - best >= patience:
            break
    return best + 1


def predictions(fitted: dict[int, Fitted], rows: DataFrame, by: str | None = None) -> DataFrame:
    """rows with a column `predicted`; with ``by`` each row by the model of its key, NaN where that has none."""
    sent = rows.sparkSession.sparkContext.broadcast(fitted)  # bounded by trees and nodes
    only = next(iter(fitted))

    @F.pandas_udf("double")
    def predict(x: pd.Series, key: pd.Series) -> pd.Series:
        out = np.full(len(x), np.nan)
        for k in key.unique():
            mine = (key == k).to_numpy()
            if k in sent.value:
                out[mine] = sent.value[k].values(np.stack(x[mine].to_list()))
        return pd.Series(out)

    key = F.lit(only).cast("int") if by is None else F.col(by).cast("int")
    return rows.withColumn("predicted", predict(vector_to_array("features"), key))


# --- blocks ------------------------------------------------------------------------------


def feature_edges(x: Column, width: int, bins: int) -> list[Column]:
    """For each feature the quantiles between its bins, in one aggregate."""
    shares = F.array(*[F.lit(i / bins) for i in range(1, bins)])
    return [F.percentile_approx(F.get(x, F.lit(j)), shares, F.lit(10_000)).alias(f"e{j}") for j in range(width)]


@dataclass
class Unit:
    """The rows of a block for the models of a chunk, and what the models predict for them so far."""

    chunk: int
    block: int
    x: np.ndarray
    y: np.ndarray
    draw: np.ndarray
    train: np.ndarray
    held: np.ndarray
    f: np.ndarray


def _roles(fold: np.ndarray, task: Task) -> tuple[np.ndarray, np.ndarray]:
    """Which rows train and which validate a model."""
    held = fold == HELD
    if task.fold is None:
        return ~held, held
    own = fold == task.fold
    past = {"others": ~own, "below": fold < task.fold, "above": (fold > task.fold) | (fold == 0)}[task.older]
    return past & ~own & ~held, own | held


def _encode(edges: list[np.ndarray]):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parts = [b for b in batches if len(b)]
        if not parts:
            return
        rows = pd.concat(parts, ignore_index=True).sort_values("draw", kind="stable", ignore_index=True)
        for key, mine in rows.groupby("key", sort=True):
            x = np.stack(mine["x"].to_list())
            binned = np.stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(edges)]).astype(np.uint8)
            as_bytes = {"x": binned, "y": mine["y"].to_numpy("float64"), "draw": mine["draw"].to_numpy("int64"), "fold": mine["fold"].to_numpy("int32")}
            yield pd.DataFrame([{"key": int(key), "block": int(mine["part"].iloc[0]), **{c: a.tobytes() for c, a in as_bytes.items()}}])

    return run


# --- what a task does --------------------------------------------------------------------


def _mixed(h: np.ndarray, salt: int) -> np.ndarray:
    """Uniform numbers in [0, 1) from hashes and a salt."""
    with np.errstate(over="ignore"):
        z = h.view(np.uint64) + np.uint64(salt * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return (z ^ (z >> np.uint64(31))) / 2.0**64


def _route(x: np.ndarray, grown: dict[str, np.ndarray], steps: int) -> np.ndarray:
    """The node that each row reaches in the tree of each model."""
    node = np.zeros((len(grown["feature"]), x.shape[1]), dtype=np.int32)
    for _ in range(steps):
        node = _step(x, grown, node)
    return node


def _step(x: np.ndarray, grown: dict[str, np.ndarray], node: np.ndarray) -> np.ndarray:
    """The nodes one step further down."""
    models, nodes = grown["feature"].shape
    where = np.arange(models, dtype=np.int32)[:, None] * nodes + node
    feature, goes, left = (grown[c].ravel()[where] for c in ("feature", "goes", "left"))
    return np.where(feature >= 0, left + _right(goes, x[feature, np.arange(x.shape[1])]), node)


@dataclass
class Shape:
    """What all tasks of a call know: per chunk its tasks; bins, width, the power of two for gradients, features of categories."""

    tasks: dict[int, list[Task]]
    bins: int
    width: int
    scale: float
    limit: float
    categorical: tuple[int, ...] = ()

    def column(self, chunk: int, name: str) -> np.ndarray:
        return np.array([getattr(t.config, name) for t in self.tasks[chunk]], dtype=float)[:, None]


def _drawn_rows(unit: Unit, shape: Shape, seed: int, round_: int) -> np.ndarray:
    """Which rows the models of a unit learn from in a round."""
    share, every = shape.column(unit.chunk, "rows"), shape.column(unit.chunk, "every").astype(int).ravel()
    if (share >= 1).all():
        return unit.train
    uniform = {e: _mixed(unit.draw, seed + 1 + (round_ // e) * e) for e in set(every.tolist())}
    return unit.train & (np.stack([uniform[e] for e in every.tolist()]) < share)


def _gradients(unit: Unit, shape: Shape) -> np.ndarray:
    """Gradients as whole numbers, multiples of the power of two."""
    return np.clip(np.rint((unit.f - unit.y) * shape.scale), -shape.limit, shape.limit)


def _histograms(unit: Unit, plan: dict, shape: Shape, seed: int, round_: int, left_only: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Sums of gradients and counts, (models, slots, features, bins); with left_only those of even slots, the others are 0."""
    models, n = unit.f.shape
    node = _route(unit.x, plan, plan["steps"])
    slot = np.take_along_axis(plan["slot"], node, 1)
    drawn = _drawn_rows(unit, shape, seed, round_) & (slot >= 0)
    if left_only:
        drawn &= slot % 2 == 0
    at = np.flatnonzero(drawn)
    slots, bins = plan["slots"], shape.bins
    cell = (slot + np.arange(models, dtype=np.int64)[:, None] * slots).ravel()[at] * bins
    row = at % n
    gradient = _gradients(unit, shape).ravel()[at]
    size = models * slots * bins
    g, h = (np.empty((models * slots, shape.width, bins)) for _ in range(2))
    for j in range(shape.width):
        k = cell + unit.x[j][row]
        g[:, j] = np.bincount(k, gradient, size).reshape(-1, bins)
        h[:, j] = np.bincount(k, minlength=size).reshape(-1, bins)
    return g.reshape(models, slots, shape.width, bins), h.reshape(models, slots, shape.width, bins)


def _soft(g: np.ndarray, l1) -> np.ndarray:
    return np.sign(g) * np.maximum(np.abs(g) - l1, 0.0)


def weight(g, h, l1, l2) -> np.ndarray:
    """The value of a leaf: its soft-thresholded gradient against its hessian."""
    return np.where(h + l2 > 0, -_soft(g, l1) / np.where(h + l2 > 0, h + l2, 1.0), 0.0)


def _score(g: np.ndarray, h: np.ndarray, l1, l2) -> np.ndarray:
    """Squared soft-thresholded gradients against hessians; without a hessian there is no gradient."""
    out = np.abs(g)
    out -= l1
    np.maximum(out, 0.0, out=out)
    out *= out
    below = h + l2
    np.maximum(below, 1e-300, out=below)
    out /= below
    return out


def _choose(chunk: int, sums: tuple[np.ndarray, np.ndarray], columns: np.ndarray, shape: Shape) -> dict[str, np.ndarray]:
    """Per model and slot the best split: gain, feature, bins that go left, gradient and hessian of the left child and of the node.

    The categories of a feature are first put in the order of their mean gradient within the node, so that a split takes a set of them.
    """
    g, h = sums
    g = g / shape.scale
    models, slots, width, bins = g.shape
    order = np.broadcast_to(np.arange(bins), g.shape)
    if shape.categorical:
        own = list(shape.categorical)
        mean = np.where(h[:, :, own] > 0, g[:, :, own] / np.maximum(h[:, :, own], 1), np.inf)
        order = order.copy()
        order[:, :, own] = np.argsort(mean, axis=-1, kind="stable")
        g, h = (np.take_along_axis(a, order, -1) for a in (g, h))
    l1, l2, least, gamma = (shape.column(chunk, c)[:, :, None, None] for c in ("l1", "l2", "min_child", "least_gain"))
    node_g, node_h = g[:, :, :1].sum(-1, keepdims=True), h[:, :, :1].sum(-1, keepdims=True)
    left_g, left_h = np.cumsum(g, -1)[..., :-1], np.cumsum(h, -1)[..., :-1]
    right_h = node_h - left_h
    gain = _score(left_g, left_h, l1, l2)
    gain += _score(node_g - left_g, right_h, l1, l2)
    gain -= _score(node_g, node_h, l1, l2)
    closed = ~columns[:, None, :, None]
    oblivious = shape.tasks[chunk][0].config.growth == "oblivious"
    if oblivious:
        # One split for all nodes of a level, the one with the largest sum of gains.
        gain = np.broadcast_to(np.where(closed, -np.inf, gain).sum(1, keepdims=True), gain.shape)
    else:
        np.putmask(gain, closed | (left_h < least) | (right_h < least), -np.inf)
    flat = gain.reshape(models, slots, -1)
    best = flat.argmax(-1)[..., None]
    pick = lambda a: np.take_along_axis(a.reshape(models, slots, -1), best, -1)[..., 0]
    found = pick(gain) - gamma[..., 0, 0]
    feature, last = best[..., 0] // (bins - 1), best[..., 0] % (bins - 1)
    ranked = np.take_along_axis(order, feature[..., None, None], 2)[:, :, 0].astype(np.uint64)
    goes = np.where(np.arange(bins) <= last[..., None], np.uint64(1) << ranked, np.uint64(0)).sum(-1, dtype=np.uint64)
    out = {"gain": np.where(found > 1e-12, found, -np.inf), "feature": feature, "goes": goes}
    return out | {"gl": pick(left_g), "hl": pick(left_h), "g": node_g[..., 0, 0], "h": node_h[..., 0, 0]}


def _choose_level(chunk: int, left: list[np.ndarray], features: np.ndarray, columns: np.ndarray, shape: Shape) -> dict[str, np.ndarray]:
    """What `_choose` gives, by cell, of the running sums over bins of gradients and counts, (features, bins, cells).

    Cells are nodes of models; the first are one of each model, and so on.
    """
    g, h = left
    bins, cells = g.shape[1:]
    models = len(shape.tasks[chunk])
    l1, l2, least, gamma = (np.tile(shape.column(chunk, c).ravel(), cells // models) for c in ("l1", "l2", "min_child", "least_gain"))
    node_g, node_h, cell = g[0, -1], h[0, -1], np.arange(cells)
    whole = _score(node_g, node_h, l1, l2)
    closed = np.tile(~columns[:, features].T, (1, cells // models))
    found, best = np.full(cells, -np.inf), np.zeros(cells, dtype=np.int64)
    size = max(1, WEIGHED_CELLS // (bins * cells))
    for at in range(0, len(features), size):
        left_g, left_h = g[at : at + size, :-1], h[at : at + size, :-1]
        right_h = node_h - left_h
        gain = _score(left_g, left_h, l1, l2)
        gain += _score(node_g - left_g, right_h, l1, l2)
        gain -= whole
        shut = left_h < least
        shut |= right_h < least
        if closed[at : at + size].any():
            shut |= closed[at : at + size, None]
        np.putmask(gain, shut, -np.inf)
        gain = gain.reshape(-1, cells)
        top = gain.argmax(0)
        value = gain[top, cell]
        better = value > found
        found, best = np.where(better, value, found), np.where(better, at * (bins - 1) + top, best)
    own, last = best // (bins - 1), best % (bins - 1)
    found -= gamma
    goes = (np.uint64(1) << (last + 1).astype(np.uint64)) - np.uint64(1)
    out = {"gain": np.where(found > 1e-12, found, -np.inf), "feature": features[own], "goes": goes}
    return out | {"gl": g[own, last, cell], "hl": h[own, last, cell], "g": node_g, "h": node_h}


def _errors(unit: Unit) -> np.ndarray:
    """Per model the squared error on its validation rows."""
    return (np.where(unit.held, unit.f - unit.y, 0.0) ** 2).sum(1)


def _losses(unit: Unit) -> np.ndarray:
    """Per model the squared error on its validation rows, their number, sum and sum of squares; sum and number of train labels."""
    each = lambda mask, v: (mask * v).sum(1)
    held, train, y = unit.held, unit.train, unit.y
    return np.stack([_errors(unit), held.sum(1), each(held, y), each(held, y * y), each(train, y), train.sum(1)])


def _drawn_columns(shape: Shape, chunk: int, seed: int, round_: int, level: int) -> np.ndarray:
    """The columns that may split, by model: drawn by tree, for oblivious trees by level."""
    by_level = shape.tasks[chunk][0].config.growth == "oblivious"
    order = np.random.default_rng((seed, round_, level) if by_level else (seed, round_)).permutation(shape.width)
    return order < np.maximum(1, np.rint(shape.column(chunk, "cols") * shape.width))


def _advanced(unit: Unit, tree: dict) -> Unit:
    """The unit with a tree's values added to its predictions."""
    return _moved(unit, tree, _route(unit.x, tree, tree["steps"]))


def _moved(unit: Unit, tree: dict, node: np.ndarray) -> Unit:
    """The unit with the values of the nodes that its rows reach added to its predictions."""
    return Unit(**{**vars(unit), "f": unit.f + np.take_along_axis(tree["value"], node, 1)})


def _continues(tasks: list[Task], on: np.ndarray, histories: list[list[float]], judged: np.ndarray, rounds: int) -> np.ndarray:
    """Which of the growing models go on after so many rounds."""
    out = on.copy()
    for i in np.flatnonzero(on):
        config = tasks[i].config
        patient = config.stop_after is None or not judged[i] or rounds - best_prefix(histories[i], 1 << 30) < config.stop_after
        out[i] = rounds < config.trees and patient
    return out


# --- the loop over rounds ----------------------------------------------------------------


def rounds_of_job(keep_trees: bool) -> int:
    return REFRESH if keep_trees else LOSS_ROUNDS


class _Alone:
    """Grows the models of a unit that holds all their rows."""

    def __init__(self, unit: Unit, shape: Shape, seed: int):
        self.unit, self.shape, self.seed, self.above, self.node = unit, shape, seed, (), None
        self.by_level = shape.tasks[unit.chunk][0].config.growth == "level" and not shape.categorical

    def level(self, plan: dict, round_: int, level: int) -> dict[str, np.ndarray]:
        """The splits of a level. Rows go on from the nodes of the level above, and only features that may split are summed.

        Of two siblings the one with fewer rows is summed; the other has what their parent has and that one has not. So the cells
        of a level are first those that are summed, in the order of their parents, then their siblings; `place` says where a slot is.
        """
        unit, shape, slots = self.unit, self.shape, plan["slots"]
        models, n = unit.f.shape
        if level == 0:
            self.node, self.place = np.zeros((models, n), dtype=np.int32), np.arange(models)[:, None]
            self.drawn, self.gradient = _drawn_rows(unit, shape, self.seed, round_), _gradients(unit, shape) / shape.scale
            self.columns = _drawn_columns(shape, unit.chunk, self.seed, round_, level)
            self.features = np.flatnonzero(self.columns.any(0))
            cells, table, sides = models, np.where(plan["slot"] >= 0, self.place, -1), 1
        else:
            self.node = _step(unit.x, plan, self.node)
            cells, own, sides = models * slots // 2, slice(slots - 1, 2 * slots - 1), 2
            above, summed = np.repeat(self.place, 2, axis=1), np.arange(slots) % 2 == np.repeat(self.right, 2, axis=1)
            table = np.full(plan["slot"].shape, -1)
            table[:, own] = np.where((plan["slot"][:, own] >= 0) & summed, above, -1)
            self.place = np.where(summed, above, above + cells)
        cell = np.take_along_axis(table, self.node, 1)
        at = np.flatnonzero(self.drawn & (cell >= 0))
        row, cell, gradient = at % n, cell.ravel()[at], self.gradient.ravel()[at]
        size, sums = shape.bins * cells, [np.empty((len(self.features), shape.bins, sides, cells)) for _ in range(2)]
        for k, x in enumerate(unit.x[self.features].astype(np.int64) * cells):
            where = x[row]
            where += cell
            for out, weights in zip(sums, (gradient, None), strict=True):
                out[k, :, 0] = np.bincount(where, weights, size).reshape(-1, cells)
        for out in sums:
            for b in range(1, shape.bins):
                out[:, b, 0] += out[:, b - 1, 0]
        if level:
            for out, whole in zip(sums, self.above, strict=True):
                np.subtract(whole, out[:, :, 0], out=out[:, :, 1])
        self.above = [out.reshape(*out.shape[:2], -1) for out in sums]
        best = {k: v[self.place] for k, v in _choose_level(unit.chunk, self.above, self.features, self.columns, shape).items()}
        self.right = best["h"] - best["hl"] < best["hl"]
        return best

    def splits(self, plans: dict[int, dict], round_: int, level: int, blocks: int) -> dict[int, dict[str, np.ndarray]]:
        (chunk, plan), = plans.items()
        if self.by_level:
            return {chunk: self.level(plan, round_, level)}
        # Slots of a heap's level are pairs of siblings: a right one has what its parent has and the left one has not.
        paired = plan["heap"] and level > 0
        sums = _histograms(self.unit, plan, self.shape, self.seed, round_, paired)
        if paired:
            for part, above in zip(sums, self.above, strict=True):
                np.subtract(above, part[:, 0::2], out=part[:, 1::2])
        self.above = sums
        return {chunk: _choose(chunk, sums, _drawn_columns(self.shape, chunk, self.seed, round_, level), self.shape)}

    def settle(self) -> None:
        pass

    def rounds(self, on: np.ndarray, first: int, grow, histories: list[list[float]], judged: np.ndarray, keep_trees: bool) -> list[tuple]:
        """(models that grew, their trees, their losses) of the rounds of a job."""
        out, chunk = [], self.unit.chunk
        for r in range(first, first + rounds_of_job(keep_trees)):
            if not on.any():
                break
            self.node = None
            tree = grow(self, {chunk: on}, r, 1)[chunk]
            if self.node is None:
                self.unit = _advanced(self.unit, tree)
            else:
                self.unit = _moved(self.unit, tree, _step(self.unit.x, tree, self.node))
            losses = _errors(self.unit) if judged.any() else None
            out.append((on, tree if keep_trees else None, losses))
            for i in np.flatnonzero(on & judged):
                histories[i].append(float(losses[i]))
            on = _continues(self.shape.tasks[chunk], on, histories, judged, r + 1)
        return out


class _Run:
    """Grows the models of one call; `units` is an RDD because blocks of arrays are no rows of columns."""

    def __init__(self, units: RDD, shape: Shape, single: bool, seed: int):
        self.units, self.shape, self.single, self.seed = units.persist(StorageLevel.MEMORY_AND_DISK), shape, single, seed
        self.age, self.stale, self.written, self.kept = 0, None, [], []

    def summed(self, chunks: list[int], measure, post=None, size: int = 0) -> dict:
        """measure(unit) added up by chunk over all blocks; post(chunk, sums) of it where the sums are large."""
        wanted = set(chunks)
        parts = self.units.filter(lambda u: u.chunk in wanted).map(lambda u: (u.chunk, u.block, measure(u)))
        add = lambda a, b: tuple(x + y for x, y in zip(a, b, strict=True)) if isinstance(a, tuple) else a + b
        if post is not None and self.single:
            return dict(parts.map(lambda p: (p[0], post(p[0], p[2]))).collect())
        if size <= DRIVER_BYTES:
            found = defaultdict(list)
            for chunk, block, sums in parts.collect():
                found[chunk].append((block, sums))
            whole = {c: reduce(add, (s for _, s in sorted(p, key=lambda x: x[0]))) for c, p in found.items()}
            return whole if post is None else {c: post(c, s) for c, s in whole.items()}
        keyed = parts.map(lambda p: (p[0], p[2])).reduceByKey(add)
        return dict((keyed if post is None else keyed.map(lambda p: (p[0], post(*p)))).collect())

    def splits(self, plans: dict[int, dict], round_: int, level: int, blocks: int) -> dict[int, dict[str, np.ndarray]]:
        shape, seed = self.shape, self.seed
        masks = {c: _drawn_columns(shape, c, seed, round_, level) for c in plans}
        size = sum(16 * len(shape.tasks[c]) * p["slots"] * shape.width * shape.bins for c, p in plans.items()) * blocks
        return self.summed(list(plans), lambda u: _histograms(u, plans[u.chunk], shape, seed, round_), lambda c, s: _choose(c, s, masks[c], shape), size)

    def rounds(self, active: dict[int, np.ndarray], first: int, grow, histories: dict, judged: dict, keep_trees: bool) -> dict[int, list[tuple]]:
        """The rounds of one job, where every unit holds all rows of its models."""
        shape, seed = self.shape, self.seed

        def run(unit: Unit) -> tuple[Unit, list[tuple]]:
            if unit.chunk not in active:
                return unit, []
            alone = _Alone(unit, shape, seed)
            made = alone.rounds(active[unit.chunk], first, grow, histories[unit.chunk], judged[unit.chunk], keep_trees)
            return alone.unit, made

        before = self.units
        both = before.map(run).persist(StorageLevel.MEMORY_AND_DISK)
        both.checkpoint()
        self.written.append(both)
        found = dict(both.map(lambda p: (p[0].chunk, p[1])).collect())
        self.stale, self.units = before, both.map(lambda p: p[0])
        self.kept.append(both)
        while len(self.kept) > 1:
            self.kept.pop(0).unpersist()
        self.settle()
        return {c: r for c, r in found.items() if r}

    def advance(self, grown: dict[int, dict]) -> None:
        """Adds the trees of a round to the predictions."""

        def step(unit: Unit) -> Unit:
            tree = grown.get(unit.chunk)
            return unit if tree is None else _advanced(unit, tree)

        before, self.units = self.units, self.units.map(step).persist(StorageLevel.MEMORY_AND_DISK)
        self.age += 1
        if self.age % REFRESH == 0:
            self.units.checkpoint()
            self.written.append(self.units)
        self.stale = before

    def settle(self) -> None:
        """Frees the predictions of the round before, once a job has made the present ones."""
        if self.stale is not None:
            self.stale.unpersist()
            self.stale = None
        while len(self.written) > 1 and self.written[1].isCheckpointed():
            discard(self.units.context, self.written.pop(0).getCheckpointFile())

    def close(self) -> None:
        self.settle()
        for old in [self.units, *self.kept]:
            old.unpersist()
        for old in self.written:
            if old.isCheckpointed():
                discard(self.units.context, old.getCheckpointFile())


def _blank(models: int, nodes: int) -> dict[str, np.ndarray]:
    whole = lambda v, t: np.full((models, nodes), v, dtype=t)
    return {"feature": whole(-1, np.int32), "goes": whole(0, np.uint64), "left": whole(0, np.int32), "value": whole(0.0, float), "gain": whole(0.0, float)}


def _by_level(run: _Run, chunks: dict[int, np.ndarray], round_: int, blocks: int) -> dict[int, dict]:
    """Trees of a round whose nodes lie as in a heap; chunks give which of their models still grow."""
    shape, grown = run.shape, {}
    depth = {c: int(shape.column(c, "depth").max()) for c in chunks}
    for c in chunks:
        grown[c] = _blank(len(shape.tasks[c]), 2 ** (depth[c] + 1) - 1) | {"steps": 0}
    for level in range(max(depth.values())):
        plans = {}
        for c, active in chunks.items():
            tree, first, slots = grown[c], 2**level - 1, 2**level
            if level >= depth[c]:
                continue
            slot = np.full(tree["feature"].shape, -1, dtype=np.int32)
            alive = active[:, None] & (shape.column(c, "depth") > level)
            if level:
                up = (np.arange(first, first + slots) - 1) // 2
                alive = alive & (tree["feature"][:, up] >= 0)
            slot[:, first : first + slots] = np.where(alive, np.arange(slots), -1)
            if alive.any():
                plans[c] = {k: tree[k] for k in ("feature", "goes", "left")} | {"slot": slot, "slots": slots, "steps": level, "heap": True}
        if not plans:
            break
        for c, best in run.splits(plans, round_, level, blocks).items():
            tree, first, slots = grown[c], 2**level - 1, 2**level
            l1, l2, rate = (shape.column(c, k) for k in ("l1", "l2", "rate"))
            node = np.arange(first, first + slots)
            open_ = (plans[c]["slot"][:, node] >= 0) & np.isfinite(best["gain"])
            if level == 0:
                tree["value"][:, :1] = np.where(chunks[c][:, None], rate * weight(best["g"], best["h"], l1, l2), 0.0)
            for name in ("feature", "goes", "gain"):
                tree[name][:, node] = np.where(open_, best[name], tree[name][:, node])
            tree["left"][:, node] = 2 * node + 1
            sides = ((2 * node + 1, best["gl"], best["hl"]), (2 * node + 2, best["g"] - best["gl"], best["h"] - best["hl"]))
            for child, g, h in sides:
                tree["value"][:, child] = np.where(open_, rate * weight(g, h, l1, l2), 0.0)
            tree["steps"] = level + 1
        run.settle()
    return grown


def _by_leaf(run: _Run, chunks: dict[int, np.ndarray], round_: int, blocks: int) -> dict[int, dict]:
    """Trees of a round that split their best leaf first.

    Nodes that a best-first walk would take are given children, all of a job at a time, and the walk is repeated until
    it needs no node without known gains; what it did not take becomes leaves again.
    """
    shape = run.shape
    state = {c: [{"nodes": [{"depth": 0}], "new": [0] if a else []} for a in active] for c, active in chunks.items()}

    def arrays(c: int, chosen: list[set[int]] | None = None) -> dict[str, np.ndarray]:
        out = _blank(len(state[c]), max(len(m["nodes"]) for m in state[c]))
        for i, model in enumerate(state[c]):
            for k, node in enumerate(model["nodes"]):
                out["value"][i, k] = node.get("value", 0.0)
                if "left" in node and (chosen is None or k in chosen[i]):
                    out["feature"][i, k], out["goes"][i, k], out["left"][i, k] = node["feature"], node["goes"], node["left"]
                    out["gain"][i, k] = node["gain"]
        return out | {"steps": max(n["depth"] for m in state[c] for n in m["nodes"])}

    def walk(model: dict, config: Boosting) -> tuple[set[int], list[int]]:
        """Nodes that are split, best first, and those of them without children yet."""
        taken, lacking, heap = set(), [], []

        def push(k):
            node = model["nodes"][k]
            if node.get("gain", -np.inf) > 0 and np.isfinite(node["gain"]) and (not config.depth or node["depth"] < config.depth):
                heapq.heappush(heap, (-node["gain"], k))

        push(0)
        while heap and len(taken) < config.leaves - 1:
            k = heapq.heappop(heap)[1]
            taken.add(k)
            if "left" in model["nodes"][k]:
                push(model["nodes"][k]["left"])
                push(model["nodes"][k]["left"] + 1)
            else:
                lacking.append(k)
        return taken, lacking

    step = 0
    while True:
        plans = {}
        for c, models in state.items():
            if any(m["new"] for m in models):
                own = arrays(c)
                slot = np.full(own["feature"].shape, -1, dtype=np.int32)
                for i, m in enumerate(models):
                    slot[i, m["new"]] = np.arange(len(m["new"]))
                plans[c] = {k: own[k] for k in ("feature", "goes", "left", "steps")} | {"slot": slot, "slots": max(len(m["new"]) for m in models), "heap": False}
        if not plans:
            break
        best = run.splits(plans, round_, step, blocks)
        run.settle()
        for c in plans:
            for i, m in enumerate(state[c]):
                config, found = shape.tasks[c][i].config, {k: v[i] for k, v in best[c].items()}
                for s, k in enumerate(m["new"]):
                    node = m["nodes"][k]
                    node.update({name: found[name][s].item() for name in found})
                    node["value"] = config.rate * float(weight(node["g"], node["h"], config.l1, config.l2))
                m["new"] = []
                for k in walk(m, config)[1]:
                    node = m["nodes"][k]
                    node["left"] = len(m["nodes"])
                    m["nodes"] += [{"depth": node["depth"] + 1}, {"depth": node["depth"] + 1}]
                    m["new"] += [node["left"], node["left"] + 1]
        step += 1
    return {c: arrays(c, [walk(m, shape.tasks[c][i].config)[0] for i, m in enumerate(models)]) for c, models in state.items()}


def _clipped(tree: dict, i: int) -> Tree:
    """The tree of one model of a chunk."""
    return Tree(*(tree[k][i].copy() for k in ("feature", "goes", "left", "value", "gain")))


def fit(
    rows: DataFrame,
    tasks: list[Task],
    label: str,
    by: str | None = None,
    held: Column | None = None,
    fold: Column | None = None,
    bins: int = BINS,
    seed: int = SEED,
    categorical: tuple[int, ...] = (),
    keep_trees: bool = True,
) -> list[Fitted]:
    """Models of all tasks, grown together; all tasks of one call grow the same way.

    ``rows`` has a vector column `features`. ``by`` is an integer column: a task learns from the rows of its key. ``held`` marks
    rows that validate, ``fold`` numbers rows for tasks with a fold. Rows without label are left out. A task without
    rows to learn from gets a model without trees and base 0. ``categorical`` features hold category numbers, most frequent
    first; categories from ``bins`` - 1 on are one. Without keep_trees only the losses are returned.
    """
    if not 2 <= bins <= 64:
        raise ValueError("2 to 64 bins")
    growth = {t.config.growth for t in tasks}
    if len(growth) != 1:
        raise ValueError(f"one way of growth at a time, not {sorted(growth)}")
    spark = rows.sparkSession
    shared_root(spark)
    number = F.coalesce(fold.cast("int"), F.lit(-1)) if fold is not None else F.lit(-1)
    number = F.when(held, HELD).otherwise(number) if held is not None else number
    key = F.col(by).cast("int") if by else F.lit(tasks[0].key)
    numbers = F.coalesce(F.col(label).cast("double"), F.lit(float("nan")))
    flat = rows.select(key.alias("key"), number.alias("fold"), numbers.alias("y"), vector_to_array("features").alias("x"))
    flat = flat.filter(F.col("key").isin(*{t.key for t in tasks}) & ~F.isnan("y"))
    first = flat.select("x").first()
    if first is None:
        return [Fitted(t, 0.0, []) for t in tasks]
    width = len(first["x"])
    learn = F.col("fold") != HELD
    bounds = flat.agg(F.count(F.lit(1)).alias("n"), F.min("y").alias("low"), F.max("y").alias("high")).first()
    quantiles = flat.filter(learn).agg(*feature_edges(F.col("x"), width, bins)).first()
    edges = [np.unique(np.array(quantiles[f"e{j}"] or [], dtype=float)) for j in range(width)]
    for j in categorical:
        edges[j] = np.arange(bins - 1) + 0.5

    parts = max(1, -(-bounds["n"] // BLOCK_ROWS))
    draw = F.xxhash64("key", "fold", "y", "x")
    dealt = flat.withColumn("draw", draw).repartition(parts, "draw").withColumn("part", F.spark_partition_id())
    encoded = cut_lineage(dealt.mapInPandas(_encode(edges), "key int, block int, x binary, y binary, draw binary, fold binary"))
    per_key = {r["key"]: (r["n"], r["most"]) for r in encoded.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.max(F.octet_length("y") / 8).alias("most")).collect()}

    # Chunks of models of one key, depth and share of columns; the models of a key without rows have none.
    chunks: dict[int, list[int]] = {}
    groups = defaultdict(list)
    for i, t in enumerate(tasks):
        if t.key in per_key:
            groups[t.key, t.config.depth, t.config.cols].append(i)
    for (k, *_), own in sorted(groups.items()):
        size = max(LEAST_MODELS, min(CHUNK_MODELS, CHUNK_CELLS // max(1, int(per_key[k][1]))))
        for at in range(0, len(own), size):
            chunks[len(chunks)] = own[at : at + size]
    most = 4.0 * max(bounds["high"] - bounds["low"], 1e-9)
    scale = 2.0 ** math.floor(52 - math.log2(bounds["n"] + 1) - math.log2(most))
    shape = Shape({c: [tasks[i] for i in own] for c, own in chunks.items()}, bins, width, scale, most * scale, tuple(categorical))
    of_key = defaultdict(list)
    for c, own in chunks.items():
        of_key[tasks[own[0]].key].append(c)

    def open_units(row) -> Iterator[Unit]:
        y, draws, folds = (np.frombuffer(row[c], dtype=t) for c, t in (("y", "float64"), ("draw", "int64"), ("fold", "int32")))
        x = np.frombuffer(row["x"], dtype=np.uint8).reshape(width, len(y))
        for c in of_key[row["key"]]:
            own = [_roles(folds, t) for t in shape.tasks[c]]
            train, held_out = (np.stack([o[k] for o in own]) for k in (0, 1))
            yield Unit(c, row["block"], x, y, draws, train, held_out, np.zeros((len(own), len(y))))

    blocks = sum(n for n, _ in per_key.values())
    n_units = sum(per_key[k][0] * len(cs) for k, cs in of_key.items())
    wide = min(n_units, max(encoded.rdd.getNumPartitions(), 4 * spark.sparkContext.defaultParallelism))
    units = encoded.rdd.flatMap(open_units)
    if units.getNumPartitions() != wide:
        units = units.map(lambda u: (u.chunk * 1_000_003 + u.block, u)).partitionBy(wide).values()
    run = _Run(units, shape, all(n == 1 for n, _ in per_key.values()), seed)

    measured = 48 * len(tasks) * max(n for n, _ in per_key.values())
    sums = run.summed(list(chunks), _losses, size=measured)
    fitted: list[Fitted] = [Fitted(t, 0.0, edges) for t in tasks]
    for c, own in chunks.items():
        for i, m in enumerate(own):
            _, n, total, squares, label_sum, label_n = (float(v) for v in sums[c][:, i])
            fitted[m].base, fitted[m].held = label_sum / label_n if label_n else 0.0, (n, total, squares)
    bases = {c: np.array([fitted[m].base for m in own])[:, None] for c, own in chunks.items()}
    run.advance({c: _blank(len(own), 1) | {"value": bases[c], "steps": 0} for c, own in chunks.items()})

    judged = {c: np.array([fitted[m].held[0] > 0 for m in own]) for c, own in chunks.items()}
    grow = _by_leaf if growth == {"leaf"} else _by_level
    active = {c: np.array([fitted[m].task.config.trees > 0 for m in own]) for c, own in chunks.items()}

    def account(c: int, on: np.ndarray, tree: dict | None, losses: np.ndarray | None) -> None:
        """Notes a round of the models of a chunk that grew."""
        for i in np.flatnonzero(on):
            model = fitted[chunks[c][i]]
            model.rounds += 1
            if keep_trees:
                model.trees.append(_clipped(tree, i))
            if judged[c][i]:
                model.losses.append(float(losses[i]))

    round_ = 0
    while active:
        histories = {c: [fitted[m].losses if fitted[m].task.config.stop_after is not None else [] for m in chunks[c]] for c in active}
        if run.single:
            made = run.rounds(active, round_, grow, histories, judged, keep_trees)
            round_ += rounds_of_job(keep_trees)
        else:
            grown = grow(run, active, round_, blocks)
            round_ += 1
            run.advance(grown)
            watched = [c for c in active if (judged[c] & active[c]).any()]
            losses = run.summed(watched, _losses, size=measured) if watched else {}
            made = {c: [(on, grown[c], losses[c][0] if c in losses else None)] for c, on in active.items()}
        going = {}
        for c, rounds in made.items():
            for on, tree, loss in rounds:
                account(c, on, tree, loss)
            done = max(fitted[m].rounds for m in chunks[c])
            on = _continues(shape.tasks[c], rounds[-1][0], [fitted[m].losses for m in chunks[c]], judged[c], done)
            if on.any():
                going[c] = on
        active = going
    run.close()
    for model in fitted:
        if model.task.config.stop_after is not None and model.losses:
            del model.trees[best_prefix(model.losses, model.task.config.stop_after) :]
    return fitted
