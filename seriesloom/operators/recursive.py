"""Recursions over a series: moving averages with exponential weights, Croston, smoothing.

No window frame expresses these. Averages and Croston are folds of column functions over the
sorted rows of a (series[, split]) group; smoothing goes through one Arrow batch per series.
Rows are summed per series and period before, hence a group is at most as long as the calendar.
"""

from __future__ import annotations

import itertools
from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seriesloom.spec import SeriesSpec


#: Rows that are folded into one array before the next one is begun.
FOLD_ROWS = 64


def _append(df: DataFrame, fields: list[tuple[str, T.DataType]]) -> T.StructType:
    return T.StructType(df.schema.fields + [T.StructField(n, t) for n, t in fields])


def _fold(df: DataFrame, spec: SeriesSpec, value: str, state: dict[str, str], step: Callable, out: dict[str, str]) -> DataFrame:
    """A recursion over the rows of each group in order of time, as folds of column functions.

    Rows are folded in blocks that hand on their state. Adding to an array copies what it refers to, so one array for a whole series
    would take time in the square of its length; blocks of rows and a list of blocks stay short.
    ``state`` names the fields that are carried (all null at the start) and their types. ``step(state, v)`` gives the next
    state and the fields that a row gets; ``out`` has their types. The result has the keys, time, value and those fields.
    Only these columns are moved.
    """
    row = f"struct<t:{df.schema[spec.time].dataType.simpleString()},v:double," + ",".join(f"{n}:{t}" for n, t in out.items()) + ">"
    empty = F.array().cast(f"array<{row}>")
    start = F.struct(*[F.lit(None).cast(t).alias(n) for n, t in state.items()], F.array().cast(f"array<array<{row}>>").alias("blocks"))

    def take(acc: Column, r: Column) -> Column:
        following, given = step(acc, r["v"])
        made = F.struct(r["t"].alias("t"), r["v"].alias("v"), *[given[n].cast(t).alias(n) for n, t in out.items()])
        carried = [following[n].cast(t).alias(n) for n, t in state.items()]
        return F.struct(*carried, F.array_append(acc["rows"], made).alias("rows"))

    pairs = F.collect_list(F.struct(F.col(spec.time).alias("t"), F.col(value).cast("double").alias("v")))
    rows = df.groupBy(*spec.partition).agg(F.sort_array(pairs).alias("_rows"))
    cuts = F.sequence(F.lit(0), F.floor((F.size("_rows") - 1) / FOLD_ROWS).cast("int"))
    blocks = rows.select(*spec.partition, F.transform(cuts, lambda i: F.slice("_rows", i * FOLD_ROWS + 1, F.lit(FOLD_ROWS))).alias("_blocks"))

    def fold(acc: Column, block: Column) -> Column:
        carried = F.struct(*[acc[n].alias(n) for n in state], empty.alias("rows"))
        done = lambda a: F.struct(*[a[n].alias(n) for n in state], F.array_append(acc["blocks"], a["rows"]).alias("blocks"))
        return F.aggregate(block, carried, take, done)

    folded = F.flatten(F.aggregate("_blocks", start, fold, lambda acc: acc["blocks"]))
    return blocks.select(*spec.partition, F.inline(folded)).withColumnsRenamed({"t": spec.time, "v": value})


def ema(df: DataFrame, spec: SeriesSpec, value: str, spans: tuple[int, ...], name: str, adjust: bool = False, fill: float | None = None) -> DataFrame:
    """Exponential moving average of the value one row back, alpha = 2 / (span + 1).

    ``adjust=False`` is the plain recursion, ``adjust=True`` divides by the sum of
    the weights seen so far. A missing value leaves the average and lowers the weight of what came before.
    """
    state = {"before": "double"} | {f"{k}_{s}": "double" for s in spans for k in ("mean", "weight")}

    def step(acc: Column, v: Column):
        x = acc["before"]
        following, given = {"before": v}, {}
        for s in spans:
            alpha = 2.0 / (s + 1)
            new = 1.0 if adjust else alpha
            mean, old = acc[f"mean_{s}"], acc[f"weight_{s}"] * F.lit(1.0 - alpha)
            moved = F.when(x == mean, mean).otherwise((old * mean + F.lit(new) * x) / (old + F.lit(new)))
            following[f"mean_{s}"] = F.when(mean.isNull(), x).when(x.isNull(), mean).otherwise(moved)
            kept = old + F.lit(new) if adjust else F.lit(1.0)
            following[f"weight_{s}"] = F.when(mean.isNull(), F.lit(1.0)).when(x.isNull(), old).otherwise(kept)
            shown = following[f"mean_{s}"]
            given[f"{name}_{s}"] = shown if fill is None else F.coalesce(shown, F.lit(fill))
        return following, given

    return _fold(df, spec, value, state, step, {f"{name}_{s}": "double" for s in spans})


def croston(df: DataFrame, spec: SeriesSpec, value: str, alpha: float = 0.4) -> DataFrame:
    """Intermittent-demand forecast: smoothed order size over an interval count.

    The size starts at the first value and is smoothed over rows above zero. The
    interval starts at 1 and grows by one on every later row without an order; it
    is never reset. The forecast of the first row is 0.
    """

    def step(acc: Column, v: Column):
        first, hit = acc["interval"].isNull(), v > 0
        smoothed = acc["size"] * F.lit(1.0 - alpha) + v * F.lit(alpha)
        size = F.when(first, v).when(hit, F.when(acc["size"].isNull(), v).otherwise(smoothed)).otherwise(acc["size"])
        interval = F.when(first, F.lit(1.0)).when(hit, acc["interval"]).otherwise(acc["interval"] + 1)
        return {"size": size, "interval": interval}, {"croston": F.when(first, F.lit(0.0)).otherwise(size / interval)}

    return _fold(df, spec, value, {"size": "double", "interval": "double"}, step, {"croston": "double"})


def croston_textbook(df: DataFrame, spec: SeriesSpec, value: str, alpha: float = 0.4) -> DataFrame:
    """Croston's method: size and interval are both smoothed at each order, and the interval count starts anew.

    The forecast of a row knows only the rows before it: 0 until there was an order, then size over interval.
    """

    def step(acc: Column, v: Column):
        gap = F.coalesce(acc["gap"], F.lit(1.0))
        hit, first = v > 0, acc["size"].isNull()
        blend = lambda old, new: F.when(first, new).otherwise(old * F.lit(1.0 - alpha) + new * F.lit(alpha))
        following = {
            "size": F.when(hit, blend(acc["size"], v)).otherwise(acc["size"]),
            "interval": F.when(hit, blend(acc["interval"], gap)).otherwise(acc["interval"]),
            "gap": F.when(hit, F.lit(1.0)).otherwise(gap + 1),
        }
        return following, {"croston": F.coalesce(acc["size"] / acc["interval"], F.lit(0.0))}

    return _fold(df, spec, value, {"size": "double", "interval": "double", "gap": "double"}, step, {"croston": "double"})


def croston_aligned(train: DataFrame, test: DataFrame, spec: SeriesSpec, value: str) -> DataFrame:
    """The last fitted train values set against the test rows by position.

    Kept for comparison: the train fit of other dates is read as a test forecast.
    """
    keys = list(spec.keys)
    newest = Window.partitionBy(*keys).orderBy(F.desc(spec.time))
    back = F.row_number().over(newest)
    fitted = croston(train, spec, value).select(*keys, back.alias("_back"), F.col("croston").alias("predicted"))
    tested = test.select(*keys, spec.time, F.col(value).alias("actual"), back.alias("_back"))
    return tested.join(fitted, [*keys, "_back"]).drop("_back")


# Where the search for smoothing weights starts, and the bounds it stays in: level, trend, season, damping.
GRID = {
    "alpha": (0.05, 0.2, 0.4, 0.6, 0.8),
    "beta": (0.01, 0.05, 0.2),
    "gamma": (0.01, 0.1, 0.3),
    "phi": (0.8, 0.9, 0.98),
}
BOUNDS = np.array([(1e-4, 0.9999), (1e-4, 0.9999), (1e-4, 0.9999), (0.8, 0.995)])
#: The search ends when its steps are this small a part of the bounds, or after so many rounds.
LEAST_STEP, MOST_ROUNDS = 1e-4, 400
#: Numbers that one pass over time holds, and series of an Arrow batch's worth of work.
CELLS = 1 << 22


def _responses(y: np.ndarray, weights: np.ndarray, season: int) -> tuple[np.ndarray, tuple]:
    """One-step errors of additive damped smoothing as affine functions of the starting states.

    ``y`` is (series, periods), ``weights`` (series, points, 4). Column 0 of the last axis is the run from states of zero;
    the others are what a unit of level, trend or one of the seasons adds. Also returns the final states, likewise.
    """
    s, p, width = *weights.shape[:2], 3 + season
    a, b, g, phi = (weights[..., i, None] for i in range(4))
    level, trend = np.zeros((s, p, width)), np.zeros((s, p, width))
    seasonal = np.zeros((season, s, p, width))
    level[..., 1], trend[..., 2] = 1.0, 1.0
    for i in range(season):
        seasonal[i, ..., 3 + i] = 1.0
    errors = np.empty((y.shape[1], s, p, width))
    for t in range(y.shape[1]):
        damped = phi * trend
        error = -(level + damped + seasonal[t % season])
        error[..., 0] += y[:, t, None]
        errors[t] = error
        level = level + damped + a * error
        trend = damped + a * b * error
        seasonal[t % season] += g * error
    return errors, (level, trend, seasonal)


def _starts(errors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The starting states with the least sum of squared errors, and that sum, for each (series, point)."""
    e = np.moveaxis(errors, 0, -2)
    own, design = e[..., 0], e[..., 1:]
    gram = np.einsum("...ti,...tj->...ij", design, design)
    # Level and seasons overlap; a trace of ridge picks one of the equal solutions.
    ridge = 1e-9 * np.maximum(np.trace(gram, axis1=-2, axis2=-1), 1e-300)[..., None, None] * np.eye(gram.shape[-1])
    states = -np.linalg.solve(gram + ridge, np.einsum("...ti,...t->...i", design, own)[..., None])[..., 0]
    left = own + np.einsum("...ti,...i->...t", design, states)
    return states, (left**2).sum(-1)


def _costs(y: np.ndarray, weights: np.ndarray, season: int) -> np.ndarray:
    """Least squared errors of every (series, point), a bounded number of them at a time."""
    size = max(1, CELLS // (y.shape[1] * weights.shape[1] * (3 + season)))
    return np.concatenate([_starts(_responses(y[i : i + size], weights[i : i + size], season)[0])[1] for i in range(0, len(y), size)])


def smoothing_weights(y: np.ndarray, season: int) -> np.ndarray:
    """The weights of every series with the least squared error that a bounded pattern search from the best grid point finds.

    All series step together: each round tries a step up and down in every weight (and their joint continuation),
    takes the best, and halves the steps of the series that found none. The starting states of any weights follow exactly.
    """
    grid = np.array(list(itertools.product(*GRID.values())))
    first = _costs(y, np.broadcast_to(grid, (len(y), *grid.shape)), season)
    now, cost = grid[first.argmin(1)], first.min(1)
    low, high = BOUNDS.T
    step = np.full(len(y), 0.1)
    moves = np.concatenate([np.eye(4), -np.eye(4)])
    last = np.zeros_like(now)
    for _ in range(MOST_ROUNDS):
        open_ = np.flatnonzero(step > LEAST_STEP)
        if not len(open_):
            break
        tries = now[open_, None] + step[open_, None, None] * moves * (high - low)
        tries = np.clip(np.concatenate([tries, now[open_, None] + last[open_, None]], axis=1), low, high)
        found = _costs(y[open_], tries, season)
        best = found.argmin(1)
        better = found.min(1) < cost[open_] * (1 - 1e-12)
        moved, stuck = open_[better], open_[~better]
        new = tries[better, best[better]]
        last[moved], last[stuck] = new - now[moved], 0.0
        now[moved], cost[moved] = new, found.min(1)[better]
        step[stuck] /= 2
    return now


def _holt_winters(y: np.ndarray, season: int, ahead: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Fitted values, forecasts and weights of additive damped trend and season, for (series, periods) at once."""
    weights = smoothing_weights(y, season)
    errors, (level, trend, seasonal) = _responses(y, weights[:, None], season)
    states, _ = _starts(errors)
    whole = np.concatenate([np.ones((*states.shape[:2], 1)), states], axis=-1)
    at = lambda x: (x * whole).sum(-1)[..., 0]
    fitted = y - at(errors).T
    damp = np.cumsum(weights[:, 3:] ** np.arange(1, ahead + 1), axis=1)
    turn = at(seasonal)[(y.shape[1] + np.arange(ahead)) % season].T
    return fitted, at(level)[:, None] + damp * at(trend)[:, None] + turn, weights


def holt_winters(df: DataFrame, spec: SeriesSpec, value: str, season: int = 12) -> DataFrame:
    """Fitted values on train rows and forecasts on test rows of monthly series.

    ``df`` has a ``split`` column. Series with fewer than two seasons of train
    rows give no rows. Weights and starting states have the least squared error on the train rows; the series of a
    task that have as many rows are searched together.
    """
    time, keys = spec.time, list(spec.keys)
    weights = ["alpha", "beta", "gamma", "phi"]
    out = [*keys, time, "split", "actual", "predicted", *weights]

    def fit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            alike = defaultdict(list)
            for i, (train, test) in enumerate(zip(batch["train"], batch["test"], strict=True)):
                if len(train) >= 2 * season:
                    alike[len(train), len(test)].append(i)
            for (n, ahead), own in alike.items():
                y = np.array([[r["v"] for r in batch["train"].iloc[i]] for i in own], dtype=float)
                fitted, future, found = _holt_winters(y, season, ahead)
                predicted = np.concatenate([fitted, future], axis=1)
                parts = []
                for i, values, w in zip(own, predicted, found, strict=True):
                    rows = [*batch["train"].iloc[i], *batch["test"].iloc[i]]
                    part = {time: [r["t"] for r in rows], "split": ["train"] * n + ["test"] * ahead, "actual": [r["v"] for r in rows], "predicted": values}
                    parts.append(pd.DataFrame({k: [batch[k].iloc[i]] * len(rows) for k in keys} | part | dict(zip(weights, w, strict=True))))
                yield pd.concat(parts)[out]

    row = F.struct(F.col(time).alias("t"), F.coalesce(F.col(value).cast("double"), F.lit(0.0)).alias("v"))
    side = lambda name: F.sort_array(F.collect_list(F.when(F.col("split") == name, row))).alias(name)
    # A group is one series; its rows are bounded by the calendar.
    grouped = df.groupBy(*keys).agg(side("train"), side("test"))
    fields = [next(f for f in df.schema.fields if f.name == n) for n in (*keys, time, "split")]
    schema = T.StructType(fields + [T.StructField(n, T.DoubleType()) for n in out[len(fields) :]])
    return grouped.mapInPandas(fit, schema)
