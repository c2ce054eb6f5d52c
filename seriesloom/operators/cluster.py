"""K-means on scaled profiles and the choice of k.

All runs of a call (every k, every seed) share their steps: a step is one aggregate over the rows by (run, centre), and only
sums by centre come back. The rows are packed once into blocks of a matrix, which all steps read.

Where the centres of a run move little, a pass over the rows finds those that lie so near to a border that their centre may
change within the next steps; the others are summed for good. Only the rows near a border are then compared again until the
centres have moved as far as was allowed for. That is exact: by the triangle inequality a row keeps its centre while the gap
between its two least distances is above twice the longest way of a centre.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from itertools import groupby

import numpy as np
import pandas as pd
from pyspark import RDD, StorageLevel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seriesloom.session import cut_lineage

# Settings of the sweep, of the final fit and of the older variant.
SWEEP = {"ks": tuple(range(2, 11)), "n_init": 25, "max_iter": 300, "tol": 1e-4}
FINAL = {"n_init": 100, "max_iter": 500, "tol": 1e-6}
SEED = 42
CLOSE_SCORES = 0.1
MAX_K = 3
FIXED_K = 4
#: Distances that a task holds at a time: what fits into the cache of a core.
CELLS = 1 << 16
#: Rows of a block at most; places in it take two bytes.
BLOCK = 1 << 16
#: Rows near a border are those that centres could reach in so many steps as long as the last one, but no nearer to
#: the next border than this share of the distance between centres. Runs that would get there sooner than in SOON steps compare all rows.
AHEAD, SHARE, SOON = 16, 0.1, 4
#: The rows near borders are looked up anew when steps that did without have cost as much: such a pass counts as so many steps over all
#: rows, and a step over rows near borders that a new pass would make far fewer as so much of one.
LOOKUP, LATE = 1.7, 0.1
#: Sums of the same rows in another order differ by less than this share.
ROUNDING = 1e-12
#: Rows that set the first time of a race before others can be left out of it.
FIRST = 4096
#: Sums up to this many bytes are added up on the driver; beyond it by the tasks first.
DRIVER_BYTES = 16 << 20


@dataclass(frozen=True)
class Centres:
    """A finished run."""

    k: int
    seed: int
    points: np.ndarray
    cost: float
    iterations: int

    def transform(self, vectors: DataFrame) -> DataFrame:
        """vectors with a column `prediction`: the nearest centre, the first of several."""
        return predictions(vectors, {"prediction": self})


def predictions(vectors: DataFrame, models: dict[str, Centres]) -> DataFrame:
    """vectors with a column for each of several models: the nearest centre, the first of several."""

    @F.pandas_udf("struct<" + ", ".join(f"m{i}: int" for i in range(len(models))) + ">")
    def nearest(features: pd.Series) -> pd.DataFrame:
        x = np.stack(features.to_list()) if len(features) else np.zeros((0, 0))
        return pd.DataFrame({f"m{i}": _nearest(x, points) for i, points in enumerate(tables)}, dtype="int32")

    tables = [m.points for m in models.values()]
    found = vectors.withColumn("_nearest", nearest(vector_to_array("features")))
    return found.withColumns({name: F.col("_nearest").getField(f"m{i}") for i, name in enumerate(models)}).drop("_nearest")


def _nearest(x: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Per row the first of its nearest points. Distances are sums of squared differences, feature by feature."""
    far = np.zeros((len(points), len(x)))
    for j in range(x.shape[1]):
        far += (points[:, j, None] - x[:, j]) ** 2
    return far.argmin(0)


def assemble(df: DataFrame, columns: list[str], keep: list[str] = ["series"]) -> DataFrame:
    """Rows without missing values as vectors, materialised once for the repeated fits."""
    complete = df.na.drop(subset=columns)
    vectors = VectorAssembler(inputCols=columns, outputCol="features").transform(complete)
    return cut_lineage(vectors.select(*keep, *columns, "features"))


def _distances(x: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Squared distances of rows to points."""
    return np.maximum((x * x).sum(1)[:, None] - 2.0 * x @ points.T + (points * points).sum(1), 0.0)


def _blocked(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows in blocks: their hashes and their matrix as bytes, so that no step takes rows apart again."""

    def packed(parts: list[tuple[np.ndarray, np.ndarray]]) -> pd.DataFrame:
        h, x = (np.concatenate(c) for c in zip(*parts, strict=True))
        return pd.DataFrame({"h": [h.tobytes()], "x": [x.tobytes()]})

    held: list[tuple[np.ndarray, np.ndarray]] = []
    for batch in batches:
        if len(batch):
            h, x = batch["h"].to_numpy(dtype="int64"), np.stack(batch["x"].to_list()).astype("float64")
            for at in range(0, len(h), BLOCK):
                part = h[at : at + BLOCK], x[at : at + BLOCK]
                if held and sum(len(k) for k, _ in held) + len(part[0]) > BLOCK:
                    yield packed(held)
                    held = []
                held.append(part)
    if held:
        yield packed(held)


def _blocks(vectors: DataFrame) -> RDD:
    """(hashes, matrix) of up to 65,536 rows each; an RDD because arrays are no columns."""
    x = vector_to_array("features")
    packed = vectors.select(F.xxhash64(x).alias("h"), x.alias("x")).mapInPandas(_blocked, "h binary, x binary")
    opened = lambda h, x: (h, np.frombuffer(x, dtype="float64").reshape(len(h), -1))
    return packed.rdd.map(lambda r: opened(np.frombuffer(r["h"], dtype="int64"), r["x"])).persist(StorageLevel.MEMORY_AND_DISK)


def _added(parts: RDD, size: int) -> tuple[np.ndarray, ...]:
    """Arrays of all partitions added up, in the order of the partitions where they are few bytes."""
    add = lambda a, b: tuple(x + y for x, y in zip(a, b, strict=True))
    return reduce(add, parts.collect()) if size * parts.getNumPartitions() <= DRIVER_BYTES else parts.treeReduce(add)


def _uniform(h: np.ndarray, seed: int, step: int) -> np.ndarray:
    """Numbers in (0, 1) from the hash of a row, the seed of a run and a step."""
    salt = (seed * 1_000_003 + step + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1
    z = h.view(np.uint64) ^ np.uint64(salt)
    for factor in (0xBF58476D1CE4E5B9, 0x94D049BB133111EB):
        z = (z ^ (z >> np.uint64(30))) * np.uint64(factor)
    return ((z ^ (z >> np.uint64(31))) >> np.uint64(11)).astype(float) / 2.0**53 + 2.0**-54


def _drawn(centres: list[list[np.ndarray]], seeds: list[int], runs: list[int], step: int):
    """Per run the row that a race with rates of its squared distance to the centres so far lets win."""

    def scan(blocks: Iterator[tuple[np.ndarray, np.ndarray]]) -> Iterator[tuple[int, tuple[float, list[float]]]]:
        best: dict[int, tuple[float, list[float]]] = {}
        parts = ((h[a:b], x[a:b]) for h, x in blocks for a, b in ((0, FIRST), (FIRST, len(h))) if a < len(h))
        tables = {run: np.stack(centres[run]) for run in runs} if step else {}
        for h, x in parts:
            longest = np.sqrt((x * x).sum(1).max())
            for run in runs:
                u = _uniform(h, seeds[run], step)
                most = (longest + np.sqrt((tables[run][0] ** 2).sum())) ** 2 if step else 1.0
                # -log(u) is at least 1 - u: rows that are too late even at the largest distance are out of the race.
                early = np.flatnonzero(1.0 - u <= best[run][0] * most * (1 + 1e-9) + 1e-15) if run in best and best[run][0] < np.inf else np.arange(len(h))
                if not len(early):
                    continue
                rate = _distances(x[early], tables[run]).min(1) if step else np.ones(len(early))
                with np.errstate(divide="ignore"):
                    time = np.where(rate > 0, -np.log(u[early]) / rate, np.inf)
                i = int(time.argmin())
                if run not in best or time[i] < best[run][0]:
                    best[run] = float(time[i]), x[early[i]].tolist()
        yield from best.items()

    return scan


def _ones(x: np.ndarray) -> np.ndarray:
    """Rows with a last column of ones, which takes the part of a distance that depends on the centre alone and counts rows."""
    return np.column_stack([x, np.ones(len(x))])


def _factors(points: np.ndarray) -> np.ndarray:
    """What gives, times rows of `_ones`, squared distances without the part that is the same for all centres."""
    return np.column_stack([-2.0 * points, (points * points).sum(1)])


def _members(far: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of distances by (run, centre, row) the least by run and row, and 1 where it is, at the first of equal ones."""
    least = far.min(1)
    mine = far == least[:, None]
    if np.count_nonzero(mine) != least.size:
        mine = far.argmin(1)[:, None] == np.arange(far.shape[1])[:, None]
    return least, mine.astype(float)


def _assigned(points: np.ndarray, shapes: list[tuple[int, int]]):
    """Per centre the rows that it is nearest to, their number and sums, and per run the squared distances.

    ``shapes`` says how many runs of how many centres there are, in order. Centres of a run lie side by side. Of equally near ones
    the first counts.
    """
    factors, widest = _factors(points), max(runs * k for runs, k in shapes)

    def scan(blocks: Iterator[tuple[np.ndarray, np.ndarray]]) -> Iterator[tuple[np.ndarray, ...]]:
        total, cost = np.zeros(factors.shape), np.zeros(sum(runs for runs, _ in shapes))
        size = max(256, CELLS // widest)
        for x in (block[at : at + size] for _, block in blocks for at in range(0, len(block), size)):
            z, own, low, run = _ones(x), (x * x).sum(1), 0, 0
            for runs, k in shapes:
                high = low + runs * k
                least, mine = _members((factors[low:high] @ z.T).reshape(runs, k, len(z)))
                total[low:high] += mine.reshape(runs * k, len(z)) @ z
                cost[run : run + runs] += np.maximum(least + own, 0.0).sum(1)
                low, run = high, run + runs
        yield total[:, -1], cost, total[:, :-1]

    return scan


def _near_borders(points: np.ndarray, shapes: list[tuple[int, int]], reaches: list[float]):
    """Blocks for the next steps: rows, per run the places of those near a border, and numbers and sums of the others by centre.

    A row is near a border if the gap between its two least distances isn't above the reach of the run. ``points`` and ``shapes`` are
    those of `_assigned`. Rows that no run has near a border are left out.
    """
    factors, widest = _factors(points), max(runs * k for runs, k in shapes)
    reach, longest = np.array(reaches)[:, None], np.sqrt((points * points).sum(1).max())

    def scan(blocks: Iterator[tuple[np.ndarray, np.ndarray]]) -> Iterator[tuple[np.ndarray, list[np.ndarray], np.ndarray]]:
        size = max(256, CELLS // widest)
        for _, block in blocks:
            rows, settled, near = _ones(block), np.zeros(factors.shape), np.zeros((len(reaches), len(block)), dtype=bool)
            for at in range(0, len(block), size):
                z, low, run = rows[at : at + size], 0, 0
                own = (z[:, :-1] ** 2).sum(1)
                rounding = 1e-6 * (np.sqrt(own) + longest)
                for runs, k in shapes:
                    high = low + runs * k
                    far = (factors[low:high] @ z.T).reshape(runs, k, len(z))
                    least, second = far[:, 0].copy(), np.full((runs, len(z)), np.inf)
                    for j in range(1, k):
                        np.minimum(second, np.maximum(least, far[:, j]), out=second)
                        np.minimum(least, far[:, j], out=least)
                    gap = np.sqrt(np.maximum(second + own, 0.0)) - np.sqrt(np.maximum(least + own, 0.0))
                    away = gap > reach[run : run + runs] + rounding
                    near[run : run + runs, at : at + size] = ~away
                    mine = (far == least[:, None]) & away[:, None]
                    settled[low:high] += mine.reshape(runs * k, len(z)).astype(float) @ z
                    low, run = high, run + runs
            needed = near.any(0)
            place = (np.cumsum(needed) - 1).astype(np.min_scalar_type(len(block) - 1))
            yield rows[needed], [place[n] for n in near], settled

    return scan


def _assigned_again(points: list[np.ndarray], at: list[int], lows: list[int]):
    """Numbers and sums by centre of some of the runs of `_near_borders`, whose centres are now ``points``.

    ``at`` and ``lows`` are the places of the runs and of their first centres there.
    """
    factors = [_factors(p) for p in points]
    ends = np.cumsum([0] + [len(p) for p in points])

    def scan(held: Iterator[tuple[np.ndarray, list[np.ndarray], np.ndarray]]) -> Iterator[tuple[np.ndarray, ...]]:
        total = np.zeros((ends[-1], factors[0].shape[1]))
        for rows, near, settled in held:
            for own, run, low, start in zip(factors, at, lows, ends, strict=False):
                k, size = len(own), max(256, CELLS // len(own))
                total[start : start + k] += settled[low : low + k]
                for i in range(0, len(near[run]), size):
                    z = rows[near[run][i : i + size]]
                    total[start : start + k] += _members((own @ z.T)[None])[1][0] @ z
        yield total[:, -1], total[:, :-1]

    return scan


def _placed(parts: RDD, at: np.ndarray, size: int) -> RDD:
    """Numbers and sums of some centres, as the first and the last of a tuple, among those of ``size`` centres."""

    def place(t: tuple[np.ndarray, ...]) -> tuple[np.ndarray, np.ndarray]:
        n, sums = np.zeros(size), np.zeros((size, t[-1].shape[1]))
        n[at], sums[at] = t[0], t[-1]
        return n, sums

    return parts.map(place)


@dataclass
class _Lookup:
    """The rows near borders of some runs: the places of the runs and of their first centres in it, and the centres that it is for."""

    near: RDD
    place: dict[int, int]
    low: dict[int, int]
    begun: dict[int, np.ndarray]
    allowed: dict[int, float]

    def holds(self, run: int, points: np.ndarray) -> bool:
        return run in self.place and bool(2.0 * np.sqrt(((points - self.begun[run]) ** 2).sum(1)).max() <= self.allowed[run])


def _reach(points: np.ndarray, shift: float) -> float:
    """Gap of distances up to which rows are near a border of a run whose last step was ``shift``; 0 if all rows are to be compared."""
    apart = _distances(points, points)
    np.fill_diagonal(apart, np.inf)
    reach = min(2.0 * AHEAD * shift, SHARE * float(np.sqrt(apart.min(1)).mean()))
    return reach if reach >= 2.0 * SOON * shift else 0.0


def kmeans_runs(vectors: DataFrame, ks: tuple[int, ...], n_init: int, max_iter: int, tol: float, seed: int = SEED) -> list[Centres]:
    """Runs of every k and seed from k-means++ starts, all in the same steps.

    A run ends when no centre moves by more than ``tol`` or after ``max_iter`` steps. A centre that loses its rows stays where it is.
    With fewer distinct rows than k some centres coincide. Runs are ordered by k and seed. No rows: no runs.
    """
    runs = [(k, seed + i) for k in ks for i in range(n_init)]
    if not runs:
        return []
    rows = _blocks(vectors)
    seeds, centres = [s for _, s in runs], [[] for _ in runs]
    for step in range(max(ks, default=0)):
        open_ = [r for r, (k, _) in enumerate(runs) if k > step]
        won = rows.mapPartitions(_drawn(centres, seeds, open_, step)).reduceByKey(min).collectAsMap()  # one row per run
        if not won:
            rows.unpersist()
            return []
        for r in open_:
            centres[r].append(np.array(won[r][1]))
    points = [np.stack(c) for c in centres]
    steps, reach, going = [0] * len(runs), [0.0] * len(runs), list(range(len(runs)))

    def laid(some: list[int]) -> tuple[np.ndarray, list[tuple[int, int]], dict[int, int]]:
        """All centres of some runs, how many runs of how many centres these are in order, and where each run begins."""
        lows = np.cumsum([0] + [len(points[r]) for r in some]).tolist()
        shapes = [(sum(1 for _ in same), k) for k, same in groupby(len(points[r]) for r in some)]
        return np.concatenate([points[r] for r in some]), shapes, dict(zip(some, lows))

    def centres_of(some: list[int]) -> int:
        return sum(len(points[r]) for r in some)

    lookup, owed = None, 0.0
    while going:
        inside = [r for r in going if lookup and lookup.holds(r, points[r])]
        calm = [r for r in going if reach[r]]
        owed += centres_of([r for r in calm if r not in inside]) + LATE * centres_of([r for r in inside if 0 < reach[r] < lookup.allowed[r] / 4])
        if calm and owed > LOOKUP * centres_of(calm):
            if lookup:
                lookup.near.unpersist()
            inside, owed = calm, 0.0
            flat, shapes, lows = laid(inside)
            near = rows.mapPartitions(_near_borders(flat, shapes, [reach[r] for r in inside])).persist(StorageLevel.MEMORY_AND_DISK)
            lookup = _Lookup(near, {r: i for i, r in enumerate(inside)}, lows, {r: points[r] for r in inside}, {r: reach[r] for r in inside})
        flat, _, lows = laid(going)
        wide, parts = [r for r in going if r not in inside], []
        places = lambda some: np.concatenate([np.arange(lows[r], lows[r] + len(points[r])) for r in some])
        if wide:
            parts.append(_placed(rows.mapPartitions(_assigned(*laid(wide)[:2])), places(wide), len(flat)))
        if inside:
            again = _assigned_again([points[r] for r in inside], [lookup.place[r] for r in inside], [lookup.low[r] for r in inside])
            parts.append(_placed(lookup.near.mapPartitions(again), places(inside), len(flat)))
        n, sums = _added(reduce(RDD.union, parts), 8 * (flat.size + len(flat)))
        still = []
        for r in going:
            own = slice(lows[r], lows[r] + len(points[r]))
            to = np.where(n[own, None] > 0, sums[own] / np.maximum(n[own, None], 1.0), points[r])
            shift = float(np.sqrt(((to - points[r]) ** 2).sum(1)).max())
            steps[r] += 1
            if not shift <= tol and steps[r] <= max_iter:
                points[r], reach[r] = to, _reach(to, shift)
                still.append(r)
        going = still
    if lookup:
        lookup.near.unpersist()
    flat, shapes, _ = laid(list(range(len(runs))))
    cost = _added(rows.mapPartitions(_assigned(flat, shapes)), 8 * (flat.size + len(flat) + len(runs)))[1]
    rows.unpersist()
    return [Centres(*run, points[r], float(cost[r]), steps[r] - 1) for r, run in enumerate(runs)]


def best_runs(runs: list[Centres]) -> dict[int, Centres]:
    """The run with the lowest cost for every k, the first of those that are equal but for rounding."""
    out: dict[int, Centres] = {}
    for run in runs:
        if run.k not in out or run.cost < out[run.k].cost * (1 - ROUNDING):
            out[run.k] = run
    return out


def kmeans(vectors: DataFrame, k: int, n_init: int, max_iter: int, tol: float, seed: int = SEED) -> Centres:
    """The run with the lowest cost over ``n_init`` seeds."""
    return best_runs(kmeans_runs(vectors, (k,), n_init, max_iter, tol, seed))[k]


def label(vectors: DataFrame, model: Centres, level: Column) -> DataFrame:
    """Cluster per row, numbered by rising mean of ``level`` so that labels do not depend on the seed."""
    raw = model.transform(vectors).withColumnRenamed("prediction", "_raw")
    order = raw.groupBy("_raw").agg(F.avg(level).alias("_m"))
    # One row per cluster.
    ranked = order.select("_raw", (F.row_number().over(Window.orderBy("_m", "_raw")) - 1).alias("cluster"))
    return raw.join(F.broadcast(ranked), "_raw").drop("_raw")


def _norm(columns: list[str]) -> Column:
    return sum((F.col(c) * F.col(c) for c in columns[1:]), F.col(columns[0]) * F.col(columns[0]))


def _cluster_sums(labelled: DataFrame, columns: list[str], by: str) -> DataFrame:
    """Per cluster its size, sum of squared norms and coordinate sums."""
    return labelled.groupBy(F.col(by).alias("_k")).agg(
        F.count(F.lit(1)).alias("_n"), F.sum(_norm(columns)).alias("_q"), *[F.sum(c).alias(f"_s_{c}") for c in columns]
    )


def silhouette_rows(labelled: DataFrame, columns: list[str], by: str = "cluster") -> DataFrame:
    """Silhouette of every row under squared Euclidean distance.

    The mean squared distance of a point to a cluster follows from the cluster's
    size, coordinate sums and sum of squared norms, so no pairs are formed: one
    aggregation, then a join with one row per cluster.
    """
    norm, stats = _norm(columns), _cluster_sums(labelled, columns, by)
    table = stats.agg(F.collect_list(F.struct("_k", "_n", "_q", *[f"_s_{c}" for c in columns])).alias("t")).scalar()
    # The list has one entry per cluster (at most SWEEP's largest k).
    dot = lambda e: sum(
        (F.col(c) * e.getField(f"_s_{c}") for c in columns[1:]), F.col(columns[0]) * e.getField(f"_s_{columns[0]}")
    )
    total = lambda e: e.getField("_n") * norm - F.lit(2.0) * dot(e) + e.getField("_q")
    own = F.element_at(F.filter("_t", lambda e: e.getField("_k") == F.col(by)), 1)
    others = F.filter("_t", lambda e: e.getField("_k") != F.col(by))
    a = F.try_divide(total(own), own.getField("_n") - 1)
    b = F.array_min(F.transform(others, lambda e: total(e) / e.getField("_n")))
    score = F.when(own.getField("_n") == 1, F.lit(0.0)).otherwise(F.try_divide(b - a, F.greatest(a, b)))
    return labelled.withColumn("_t", table).withColumn("silhouette", F.coalesce(score, F.lit(0.0))).drop("_t")


def silhouette(labelled: DataFrame, columns: list[str], by: str = "cluster") -> DataFrame:
    return silhouette_rows(labelled, columns, by).agg(F.avg("silhouette").alias("silhouette"))


def silhouettes(labelled: DataFrame, columns: list[str], bys: list[str]) -> dict[str, float | None]:
    """`silhouette` of several clusterings of the same rows, neither of which has missing values: one pass over the rows for the sums, one for the means."""
    sums = [_cluster_sums(labelled, columns, by).withColumn("_by", F.lit(by)) for by in bys]
    found = reduce(DataFrame.unionByName, sums).collect()  # one row per clustering and cluster
    tables = [np.array([[r["_k"], r["_n"], r["_q"], *[r[f"_s_{c}"] for c in columns]] for r in found if r["_by"] == by], dtype=float) for by in bys]

    @F.pandas_udf("struct<" + ", ".join(f"s{i}: double" for i in range(len(bys))) + ">")
    def scores(rows: pd.DataFrame) -> pd.DataFrame:
        x = rows[columns].to_numpy(dtype=float)
        return pd.DataFrame({f"s{i}": _silhouettes(x, rows[by].to_numpy(), tables[i]) for i, by in enumerate(bys)})

    means = labelled.select(scores(F.struct(*columns, *bys)).alias("s")).agg(*[F.avg(f"s.s{i}") for i in range(len(bys))])
    return dict(zip(bys, means.first(), strict=True))


def _silhouettes(x: np.ndarray, own: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Silhouettes of rows of the clusters ``own``; ``table`` has number, size, sum of squared norms and sums of every cluster."""
    label, n, q, sums = table[:, 0], table[:, 1], table[:, 2], table[:, 3:]
    total = (x * x).sum(1)[:, None] * n - 2.0 * x @ sums.T + q
    mine = own[:, None] == label
    size = mine @ n
    with np.errstate(divide="ignore", invalid="ignore"):
        a = np.where(mine, total, 0.0).sum(1) / (size - 1)
        b = np.where(mine, np.inf, total / n).min(1)
        score = (b - a) / np.maximum(a, b)
    return np.where((size > 1) & (len(label) > 1) & (np.maximum(a, b) != 0), score, 0.0)


def sweep(
    vectors: DataFrame,
    columns: list[str],
    ks: tuple[int, ...] = SWEEP["ks"],
    n_init: int = SWEEP["n_init"],
    max_iter: int = SWEEP["max_iter"],
    tol: float = SWEEP["tol"],
) -> DataFrame:
    """(k, inertia, silhouette, iterations) for every k."""
    best = best_runs(kmeans_runs(vectors, ks, n_init, max_iter, tol))
    # The clusters of all k in one pass over the rows, written once.
    table = cut_lineage(predictions(vectors, {f"_k{k}": run for k, run in best.items()}).select(*columns, *[f"_k{k}" for k in best]))
    scores = silhouettes(table, columns, [f"_k{k}" for k in best])
    rows = [(k, run.cost, float(scores[f"_k{k}"]), run.iterations) for k, run in best.items()]
    return vectors.sparkSession.createDataFrame(rows, "k int, inertia double, silhouette double, iterations int")


def _gradient(c: str, w) -> Column:
    """Central difference, one-sided at both ends."""
    before, after = F.lag(c).over(w), F.lead(c).over(w)
    return (
        F.when(before.isNull(), after - F.col(c))
        .when(after.isNull(), F.col(c) - before)
        .otherwise((after - before) / F.lit(2.0))
    )


def elbow_k(swept: DataFrame) -> DataFrame:
    """The k with the largest absolute second gradient of the inertia (first one on ties).

    The window runs over the sweep table: one row per k.
    """
    w = Window.orderBy("k")
    first = swept.withColumn("_g1", _gradient("inertia", w))
    second = first.withColumn("_g2", F.abs(_gradient("_g1", w)))
    return second.agg(F.min_by("k", F.struct(-F.col("_g2"), F.col("k"))).alias("elbow_k"))


def choose_k(swept: DataFrame) -> DataFrame:
    """Elbow k when its silhouette is close to the best one, else the best k; at most 3."""
    best = swept.agg(
        F.min_by("k", F.struct(-F.col("silhouette"), F.col("k"))).alias("silhouette_k"),
        F.max("silhouette").alias("best_score"),
    )
    elbow = elbow_k(swept).scalar()
    at_elbow = swept.where(F.col("k") == elbow).select("silhouette").scalar()
    pick = F.when(F.col("best_score") - at_elbow < CLOSE_SCORES, elbow).otherwise(F.col("silhouette_k"))
    return best.select(
        elbow.alias("elbow_k"), "silhouette_k", F.least(pick, F.lit(MAX_K)).alias("k")
    )
