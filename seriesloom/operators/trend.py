"""Seasonal regression with a bending trend: one fit per cluster from sums over its rows.

The trend may change its slope at candidate dates (hinges), whose changes carry an L1 penalty; yearly and weekly waves,
the level of a series and regressors carry a weak L2 penalty. All a fit needs is the cross products of the columns, which
are summed by cluster; solving them costs the same however many rows there were.
"""

from __future__ import annotations

import datetime
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seriesloom.functions import calendar as cal
from seriesloom.session import cut_lineage
from seriesloom.spec import SeriesSpec

#: Candidate changes of slope, the part of the train range they lie in, and the scales of the priors.
CHANGES, CHANGE_RANGE = 25, 0.8
CHANGE_PRIOR, TREND_PRIOR, WEIGHT_PRIOR = 0.05, 5.0, 10.0
SAMPLES, SEED, COVER = 1000, 42, 0.95


@dataclass(frozen=True)
class Penalties:
    """Per column the scale of its prior, and whether it is a change of slope (L1) or not (L2)."""

    scale: np.ndarray
    lasso: np.ndarray


@dataclass(frozen=True)
class Solution:
    """Weights of the raw columns, changes of slope in scaled units, residual deviation, scale of the label."""

    weights: np.ndarray
    changes: np.ndarray
    sigma: float
    unit: float


def _lasso(gram: np.ndarray, rhs: np.ndarray, ridge: np.ndarray, cut: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Least ½ w'(gram + ridge)w - rhs'w + Σ cut |w| by an active set: columns with a cut enter one at a time, and leave at zero."""
    lasso = cut > 0
    full = gram + np.diag(ridge + 1e-10 * max(np.trace(gram), 1e-300) / len(rhs))
    sign, now = np.sign(w) * lasso, w.copy()
    for _ in range(50 * len(rhs)):
        on = np.flatnonzero(~lasso | (sign != 0))
        new = np.zeros_like(now)
        new[on] = np.linalg.solve(full[np.ix_(on, on)], rhs[on] - cut[on] * sign[on])
        crossed = np.flatnonzero(lasso & (sign != 0) & (sign * new < 0))
        if len(crossed):
            # As far as the first column that would change its sign; that one leaves.
            share = now[crossed] / (now[crossed] - new[crossed])
            first = crossed[share.argmin()]
            now = now + share.min() * (new - now)
            now[first], sign[first] = 0.0, 0.0
            continue
        now = new
        pull = rhs - full @ now
        over = np.where(lasso & (sign == 0), np.abs(pull) - cut, -np.inf)
        worst = int(over.argmax())
        if over[worst] <= 1e-9 * max(float(np.abs(rhs).max()), 1e-300):
            break
        sign[worst] = np.sign(pull[worst])
    return now


def solve(gram: np.ndarray, rhs: np.ndarray, square: float, n: float, penalties: Penalties) -> tuple[np.ndarray, float]:
    """Weights and residual deviation that minimise the penalised squares, from cross products alone.

    The aim is ½ |y - Zw|² + s² (Σ |w| / scale over changes + Σ w² / 2 scale² over the others), where s² is the residual
    variance of the weights themselves, renewed until it settles.
    """
    w, sigma2 = np.zeros(len(rhs)), max(square / n, 1e-12)
    for _ in range(100):
        ridge = np.where(penalties.lasso, 0.0, sigma2 / penalties.scale**2)
        w = _lasso(gram, rhs, ridge, np.where(penalties.lasso, sigma2 / penalties.scale, 0.0), w)
        before, sigma2 = sigma2, max((square - 2 * rhs @ w + w @ gram @ w) / n, 1e-12)
        if abs(sigma2 - before) <= 1e-9 * before:
            break
    return w, float(np.sqrt(sigma2))


def fit(sums: np.ndarray, slopes: slice, trend: int) -> Solution:
    """A fit from the cross products of [1, columns, label]; columns are standardised here, except trend and changes."""
    n, last = sums[0, 0], len(sums) - 1
    means = sums[0] / n
    centred = sums - n * np.outer(means, means)
    free = np.arange(1, last)
    unit = max(np.sqrt(max(sums[last, last] / n, 0.0)), 1e-12)
    spread = np.sqrt(np.maximum(np.diag(centred) / n, 0.0))
    hinge = np.zeros(len(sums), dtype=bool)
    hinge[slopes] = True
    straight = hinge.copy()
    straight[trend] = True
    scale = np.where(straight | (spread < 1e-12), 1.0, spread)
    prior = np.where(hinge, CHANGE_PRIOR, np.where(straight, TREND_PRIOR, WEIGHT_PRIOR))
    z = centred / np.outer(scale, scale)
    w, sigma = solve(z[np.ix_(free, free)], z[free, last] * scale[last] / unit, centred[last, last] / unit**2, n, Penalties(prior[free], hinge[free]))
    raw = w * unit / scale[free]
    weights = np.concatenate([[means[last] - means[free] @ raw], raw])
    return Solution(weights, w[slopes.start - 1 : slopes.stop - 1], sigma, unit)


def deviations(found: Solution, ahead: int, span: int, seed: int = SEED) -> np.ndarray:
    """(lower, upper) of trend and noise by days after the train rows, from sampled changes of slope.

    Changes come as often, and are as large on average, as those of the fit. Day 0 stands for the train rows.
    """
    rng = np.random.default_rng(seed)
    noise = rng.normal(0.0, found.sigma, (SAMPLES, 1))  # the same on all days, so that only the drift widens the band
    size = float(np.abs(found.changes).mean()) if len(found.changes) else 0.0
    happens = rng.random((SAMPLES, ahead)) < min(1.0, len(found.changes) / (CHANGE_RANGE * max(span, 1)))
    slope = np.cumsum(np.where(happens, rng.laplace(0.0, size + 1e-12, (SAMPLES, ahead)), 0.0), axis=1)
    drift = np.concatenate([np.zeros((SAMPLES, 1)), np.cumsum(slope / max(span, 1), axis=1)], axis=1)
    tail = (1 - COVER) / 2
    return np.quantile((noise + drift) * found.unit, [tail, 1 - tail], axis=0).T


def _products(width: int):
    """Cross products of the rows of a task, one row of the matrix at a time."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for key, rows in batch.groupby("key"):
                z = np.stack(rows["z"].to_list())
                sums[key] = sums.get(key, np.zeros((width, width))) + z.T @ z
        for key, matrix in sums.items():
            yield pd.DataFrame({"key": key, "i": np.arange(width), "products": matrix.tolist()})

    return run


def seasonal_regression(rows: DataFrame, spec: SeriesSpec, regressors: list[str], by: str = "cluster", yearly: int = 5, weekly: int = 3, changes: int = CHANGES) -> DataFrame:
    """Trend with changes of slope, yearly and weekly waves and regressors on log(1 + y), with a 95 % interval.

    The logarithm makes the seasonality multiplicative. One fit per value of ``by``; series level enters as the mean of its
    train rows. The interval holds the noise and, beyond the train rows, what further changes of slope may add. A
    cluster without train rows gives no rows; missing regressors count as 0.
    """
    spark, day = rows.sparkSession, spec.t()
    train = F.col("split") == "train"
    known = rows.where(train & F.col(by).isNotNull()).agg(F.min(day).alias("low"), F.max(day).alias("high")).first()
    last = rows.agg(F.max(day).alias("d")).first()["d"]
    keys = [*spec.keys, spec.time, "split"]
    if known["low"] is None:
        shape = ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in keys)
        return spark.createDataFrame([], f"{shape}, actual double, predicted double, lower double, upper double")
    span = max((known["high"] - known["low"]).days, 1)
    label = F.log1p(F.greatest(F.col(spec.target).cast("double"), F.lit(0.0)))
    level = F.avg(F.when(train, label)).over(spec.whole())
    t = F.datediff(day, F.lit(known["low"])) / F.lit(float(span))
    at = [CHANGE_RANGE * (i + 1) / changes for i in range(changes)]
    waves: list[Column] = []
    for i in range(1, yearly + 1):
        angle = F.lit(cal.TWO_PI * i / 365.25) * F.dayofyear(day)
        waves += [F.sin(angle), F.cos(angle)]
    for i in range(1, weekly + 1):
        angle = F.lit(cal.TWO_PI * i / 7.0) * F.weekday(day)
        waves += [F.sin(angle), F.cos(angle)]
    parts = [F.lit(1.0), t, *[F.greatest(t - F.lit(c), F.lit(0.0)) for c in at], F.col("_level"), *waves, *[F.col(c).cast("double") for c in regressors]]
    columns = F.array(*[F.coalesce(p, F.lit(0.0)) for p in parts])
    wide = rows.withColumns({"_level": level, "_y": label}).withColumn("_z", columns)
    kept = list(dict.fromkeys([*keys, by, spec.target]))
    ready = cut_lineage(wide.select(*kept, "_y", "_z"))

    width = len(parts) + 1
    learn = ready.where(train & F.col(by).isNotNull() & F.col("_y").isNotNull())
    products = learn.select(F.col(by).cast("int").alias("key"), F.array_append("_z", F.col("_y")).alias("z"))
    summed = products.mapInPandas(_products(width), "key int, i int, products array<double>").groupBy("key", "i")
    found: dict[int, np.ndarray] = {}
    for r in summed.agg(F.array(*[F.sum(F.get("products", F.lit(j))) for j in range(width)]).alias("p")).collect():  # width rows per cluster
        found.setdefault(r["key"], np.zeros((width, width)))[r["i"]] = r["p"]
    fits = {k: fit(m, slice(2, 2 + changes), 1) for k, m in sorted(found.items())}

    ahead = max((last - known["high"]).days, 0)
    bands = [(k, known["high"] + datetime.timedelta(days=h), *map(float, d)) for k, f in fits.items() for h, d in enumerate(deviations(f, ahead, span))]
    # One row per cluster and day of the calendar.
    table = spark.createDataFrame(bands, "_k int, _d date, _low double, _high double")
    weights = spark.createDataFrame([(k, f.weights.tolist()) for k, f in fits.items()], "_c int, _w array<double>")
    fitted = ready.join(weights, F.col(by).cast("int") == F.col("_c"))
    fitted = fitted.withColumn("_p", F.aggregate(F.zip_with("_z", "_w", lambda a, b: a * b), F.lit(0.0), lambda s, v: s + v))
    # Days of the train range share the row of its last day.
    joined = fitted.join(table, (F.col("_c") == F.col("_k")) & (F.greatest(day, F.lit(known["high"])) == F.col("_d")))
    back = lambda c: F.greatest(F.expm1(c), F.lit(0.0))
    return joined.select(
        *keys,
        F.col(spec.target).cast("double").alias("actual"),
        back(F.col("_p")).alias("predicted"),
        back(F.col("_p") + F.col("_low")).alias("lower"),
        back(F.col("_p") + F.col("_high")).alias("upper"),
    )
