"""Model panels: configurations, fits of all clusters at once, validation and grids.

One model is trained per cluster over the pooled rows of its series (series statistics are features). All models of a panel,
all folds and all points of a grid grow together in the jobs of ``boosting``; nothing loops over series or fits.
"""

from __future__ import annotations

from dataclasses import replace
from itertools import product

from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seriesloom.operators import boosting
from seriesloom.operators.boosting import Boosting, Fitted, Task
from seriesloom.spec import SeriesSpec

# Configurations by cluster.
FINISHED = {
    0: Boosting(100, 0.05, 4, 2, 0.8, 0.8),
    1: Boosting(150, 0.05, 5, 2, 0.8, 0.8),
    2: Boosting(100, 0.01, 4, 5, 0.7, 0.7),
    3: Boosting(1000, 0.01, 6, 3, 0.8, 0.8, stop_after=50),
}
_OBLIVIOUS = {"growth": "oblivious", "l2": 3.0}
SECOND = {
    0: Boosting(100, 0.05, 4, 2, 0.8, 0.8, **_OBLIVIOUS),
    1: Boosting(100, 0.048, 4, 2, 0.82, 0.82, **_OBLIVIOUS),
    2: Boosting(100, 0.045, 5, 3, 0.78, 0.78, **_OBLIVIOUS),
    3: Boosting(150, 0.02, 5, 5, 0.6, 0.6, growth="oblivious", l2=7.0),
}
ENSEMBLE = {c: Boosting(100, 0.05, 4, 2, 0.8, 0.8) for c in range(4)}
MONTHLY = {
    0: Boosting(100, 0.1, 4, 2, 0.8, 0.8, l1=0.1, l2=1.0),
    1: Boosting(100, 0.05, 3, 2, 0.8, 0.8, l1=0.1, l2=1.0),
    2: Boosting(150, 0.03, 3, 3, 0.7, 0.7, l1=0.2, l2=1.0),
    3: Boosting(200, 0.05, 4, 3, 0.8, 0.8, l1=0.2, l2=1.5),
}
IMPORTANCE = {
    0: Boosting(200, 0.05, 6, 3, 0.8, 0.8),
    1: Boosting(150, 0.08, 5, 2, 0.9, 0.9),
    2: Boosting(100, 0.1, 4, 4, 1.0, 1.0),
    3: Boosting(300, 0.03, 7, 2, 0.8, 0.8),
}
IMPORTANCE_STUDY = Boosting(100, 0.1, 5)
SIMPLE = Boosting(50, 0.1, 3, 1, 0.9, 0.9)
LEAFWISE = Boosting(100, 0.05, 0, 20, 0.8, 0.9, stop_after=10, l2=0.0, growth="leaf", leaves=31, every=5)
CATEGORY = Boosting(200, 0.1, 4, stop_after=20, l2=3.0, growth="oblivious")
SPARSE = Boosting(300, 0.03, 4, 5, 0.8, 0.8)
DENSE = Boosting(200, 0.05, 5, 3, 0.8, 0.8)
SPARSE_LIMIT = 0.7
SELECTION = {"mean": Boosting(100, 0.01, 2, 5, 0.7, 0.7), "median": Boosting(100, 0.1, 4)}
GRIDS = {
    0: {
        "trees": (80, 100, 120), "rate": (0.08, 0.1, 0.12), "depth": (3, 4, 5), "min_child": (2, 3),
        "rows": (0.7, 0.8, 0.9), "cols": (0.7, 0.8, 0.9), "l1": (0.05, 0.1, 0.2), "l2": (0.8, 1.0, 1.2),
    },
    1: {
        "trees": (80, 100, 120), "rate": (0.03, 0.05, 0.07), "depth": (2, 3, 4), "min_child": (1, 2, 3),
        "rows": (0.7, 0.8, 0.9), "cols": (0.7, 0.8, 0.9), "l1": (0.05, 0.1, 0.15), "l2": (0.8, 1.0, 1.2),
    },
    2: {
        "trees": (120, 150, 180), "rate": (0.02, 0.03, 0.04), "depth": (2, 3), "min_child": (2, 3, 4),
        "rows": (0.6, 0.7, 0.8), "cols": (0.6, 0.7, 0.8), "l1": (0.1, 0.2, 0.3), "l2": (0.8, 1.0, 1.2),
    },
    3: {
        "trees": (150, 200, 250), "rate": (0.03, 0.05, 0.07), "depth": (3, 4, 5), "min_child": (2, 3, 4),
        "rows": (0.7, 0.8, 0.9), "cols": (0.7, 0.8, 0.9), "l1": (0.1, 0.2, 0.3), "l2": (1.0, 1.5, 2.0),
    },
}
#: Bins of a grid search: its points share them, and they are few because every point sums them anew.
GRID_BINS = 16


def vectors(df: DataFrame, features: list[str]) -> DataFrame:
    """Feature vector; missing features count as 0, as every learner here is fed."""
    filled = df.withColumns({f: F.coalesce(F.col(f).cast("double"), F.lit(0.0)) for f in features})
    return VectorAssembler(inputCols=features, outputCol="features").transform(filled)


def fit_boosted(rows: DataFrame, config: Boosting, label: str, validate: bool = False, categorical: tuple[int, ...] = ()) -> Fitted:
    """Fit on train rows. With ``validate`` and a patience in the configuration, boosting ends when the validation rows say so."""
    return fit_panel(rows, {0: config}, label, validate=validate, categorical=categorical)[0]


def fit_panel(
    rows: DataFrame, configs: dict[int, Boosting], label: str, by: str | None = None, validate: bool = False, categorical: tuple[int, ...] = ()
) -> dict[int, Fitted]:
    """One model per key of ``by``, all grown in the same jobs. Validation rows count for configurations with a patience only."""
    learn = F.col("split") == "train"
    mine = rows.where(learn | (F.col("split") == "val")) if validate else rows.where(learn)
    tasks = [Task(c, key) for key, c in configs.items()]
    fitted = boosting.fit(mine, tasks, label, by, held=~learn, categorical=categorical)
    return {m.task.key: m for m in fitted}


def fit_isolated(
    rows: DataFrame, configs: dict[int, Boosting], label: str, by: str, validate: bool = False
) -> tuple[dict[int, Fitted], dict[int, str]]:
    """`fit_panel`, and what went wrong by key: a key that can't be fitted costs the others nothing.

    All keys grow together; only where that raises they are fitted one by one. A key without rows to learn from is an error.
    """
    errors: dict[int, str] = {}
    try:
        fitted = fit_panel(rows, configs, label, by, validate)
    except Exception:  # noqa: BLE001  which key it was shows below
        fitted = {}
        for key, config in configs.items():
            try:
                fitted |= fit_panel(rows.where(F.col(by) == key), {key: config}, label, by, validate)
            except Exception as e:  # noqa: BLE001
                errors[key] = f"{type(e).__name__}: {e}"[:500]
    errors |= {k: "no rows to learn from" for k, m in fitted.items() if not m.getNumTrees and configs[k].trees}
    return {k: m for k, m in fitted.items() if k not in errors}, errors


def predict(model: Fitted, rows: DataFrame, label: str, keep: list[str]) -> DataFrame:
    """Predictions clamped at zero next to the actual values."""
    return _paired(model.transform(rows), label, keep)


def _paired(predicted: DataFrame, label: str, keep: list[str]) -> DataFrame:
    return predicted.select(*keep, F.col(label).alias("actual"), F.greatest("predicted", F.lit(0.0)).alias("predicted"))


def second(config: Boosting) -> Boosting:
    """The second learner's form of a configuration: oblivious trees with its usual penalty."""
    return replace(config, **_OBLIVIOUS)


def panel_by_cluster(
    rows: DataFrame,
    configs: dict[int, Boosting],
    label: str,
    keep: list[str],
    clusters: list[int],
    learner: str = "boosted",
    errors: dict[int, str] | None = None,
) -> DataFrame:
    """Test predictions of one model per cluster; an unknown cluster uses configuration 3.

    ``rows`` has features, label, split and cluster and is materialised once. The models of all clusters grow
    together. Configurations with a patience stop on the validation rows. `second` grows oblivious trees. A cluster
    that can't be fitted has no predictions; ``errors`` gets its text. It is an error if none can.
    """
    own = {c: configs.get(c, configs[3]) for c in clusters}
    if learner == "second":
        own = {c: config if config.growth == "oblivious" else second(config) for c, config in own.items()}
    fitted, failed = fit_isolated(rows, own, label, "cluster", any(c.stop_after is not None for c in own.values()))
    if errors is not None:
        errors |= failed
    if not fitted:
        raise ValueError(f"no cluster could be fitted: {failed}")
    test = rows.where((F.col("split") == "test") & F.col("cluster").isin(*fitted))
    return _paired(boosting.predictions(fitted, test, "cluster"), label, keep)


def importances(model: Fitted, features: list[str], spark) -> DataFrame:
    """(feature, importance) from the model's mean gains: one row per feature."""
    return spark.createDataFrame(list(zip(features, model.importances(), strict=True)), "feature string, importance double")


def selected(importance: DataFrame, rule: str = "mean") -> list[str]:
    """Features at or above the mean (or median) importance. Reads one row per feature."""
    limit = F.avg("importance") if rule == "mean" else F.percentile("importance", 0.5)
    keep = importance.where(F.col("importance") >= importance.agg(limit).scalar())
    return [r["feature"] for r in keep.select("feature").collect()]


def ensemble_mean(first: DataFrame, second: DataFrame, keys: list[str]) -> DataFrame:
    """Mean of two predictions for the same rows."""
    a = first.withColumnRenamed("predicted", "_p1")
    b = second.select(*keys, F.col("predicted").alias("_p2"))
    return a.join(b, keys).withColumn("predicted", (F.col("_p1") + F.col("_p2")) / F.lit(2.0)).drop("_p1", "_p2")


def best_model(scores: DataFrame, never: tuple[str, ...] = ("croston",)) -> DataFrame:
    """Per series the model with the lowest RMSE (first name on ties); some are scored but never chosen."""
    open_ = scores.where(~F.col("model").isin(*never) & F.col("rmse").isNotNull())
    rank = F.struct("rmse", "model")
    return open_.groupBy("series").agg(
        F.min_by("model", rank).alias("best_model"), F.min("rmse").alias("rmse"), F.min_by("r2", rank).alias("r2")
    )


def sparse_config(sparsity: Column) -> Column:
    """Which configuration a series gets: regularised above 70 % zero rows."""
    return F.when(sparsity > SPARSE_LIMIT, F.lit("sparse")).otherwise(F.lit("dense"))


def route_smooth(flags: DataFrame, minimum: int = 24, held_out: int = 12) -> DataFrame:
    """Smoothing for smooth series with two years of train months, boosted trees for the rest."""
    enough = F.col("n") - F.lit(held_out) >= F.lit(minimum)
    return flags.withColumn(
        "route", F.when(F.col("is_smooth") & enough, "smoothing").otherwise("boosted")
    )


def expanding_folds(df: DataFrame, spec: SeriesSpec, n: int = 5) -> DataFrame:
    """Fold number of each row of its series for expanding-window validation.

    Fold 0 rows only train; rows of fold i validate the model trained on folds < i.
    Each of the n validation folds has rows // (n + 1) rows, the earliest rows take
    the rest.
    """
    position = F.row_number().over(spec.window()) - 1
    total = F.count(F.lit(1)).over(spec.whole())
    size = F.floor(total / F.lit(n + 1))
    from_end = F.floor((total - 1 - position) / F.greatest(size, F.lit(1)))
    return df.withColumn("fold", F.greatest(F.lit(n) - from_end, F.lit(0)).cast("int"))


def backward_folds(df: DataFrame, spec: SeriesSpec, test_rows: int, n: int = 5) -> DataFrame:
    """Fold number walking back from the end of train in blocks as long as the test slice.

    Fold 1 is the newest block; 0 marks rows older than all folds.
    """
    newest = Window.partitionBy(*spec.partition).orderBy(F.desc(spec.time))
    block = F.floor((F.row_number().over(newest) - 1) / F.lit(test_rows)) + 1
    return df.withColumn("fold", F.when(block <= n, block).otherwise(0).cast("int"))


def cross_validate(rows: DataFrame, config: Boosting, label: str, folds: list[int], older: str = "below") -> DataFrame:
    """R2 per fold: train on older rows, validate on the fold. The models of all folds grow together.

    ``older`` says whether smaller ('below', expanding) or larger ('above', backward)
    fold numbers are older; fold 0 is always oldest.
    """
    tasks = [Task(config, fold=f, older=older) for f in folds]
    fitted = boosting.fit(rows, tasks, label, fold=F.col("fold"), keep_trees=False)
    return rows.sparkSession.createDataFrame([(m.task.fold, m.r2()) for m in fitted], "fold int, r2 double")


def fold_summary(folds: DataFrame) -> DataFrame:
    return folds.agg(F.avg("r2").alias("cv_r2_mean"), F.stddev_pop("r2").alias("cv_r2_std"))


def block_folds(df: DataFrame, spec: SeriesSpec, n: int = 5) -> DataFrame:
    """Fold number 0 .. n - 1 of each row: consecutive blocks of its series, the first ones a row longer where they differ."""
    return df.withColumn("fold", F.ntile(n).over(spec.window()) - 1)


def grid_points(grid: dict[str, tuple], base: Boosting) -> list[tuple[dict, Boosting]]:
    """The points of a grid without its trees axis, each with its configuration at the most trees."""
    axes = [a for a in grid if a != "trees"]
    most = max(grid.get("trees", (base.trees,)))
    points = [dict(zip(axes, values, strict=True)) for values in product(*(grid[a] for a in axes))]
    return [(p, replace(base, trees=most, **p)) for p in points]


def grid_search(
    rows: DataFrame, grids: dict[int, dict[str, tuple]], label: str, bases: dict[int, Boosting], folds: int = 5, by: str = "cluster", bins: int = GRID_BINS
) -> tuple[dict[int, Fitted], DataFrame]:
    """Cross-validated R2 over the grid of every cluster; the best configuration of each is refitted.

    All points and folds of all clusters grow together, one job a level. The trees axis of a point is read off the losses after
    so many rounds. ``rows`` has a fold column 0 .. folds - 1. Returns the refitted models and (cluster, `params`, `r2`, `best`);
    best marks the point of the model, the first of several with the same score. Folds without R2 are left out of a mean.
    """
    spark = rows.sparkSession
    points = [(c, point, config) for c, grid in grids.items() for point, config in grid_points(grid, bases[c])]
    tasks = [Task(config, c, fold) for c, _, config in points for fold in range(folds)]
    fitted = boosting.fit(rows, tasks, label, by, fold=F.col("fold"), bins=bins, keep_trees=False)
    table, best = [], {}
    for k, (c, point, config) in enumerate(points):
        mine = fitted[k * folds : (k + 1) * folds]
        for trees in sorted(grids[c].get("trees", (config.trees,))):
            scores = [r for m in mine if (r := m.r2(trees)) is not None]
            mean = sum(scores) / len(scores) if scores else None
            table.append([c, {a: str(v) for a, v in {**point, "trees": trees}.items()}, mean, False])
            if c not in best or (mean is not None and (best[c][0] is None or mean > best[c][0])):
                best[c] = (mean, len(table) - 1, replace(config, trees=trees))
    for _, at, _ in best.values():
        table[at][3] = True
    models = {m.task.key: m for m in boosting.fit(rows, [Task(config, c) for c, (_, _, config) in best.items()], label, by)}
    return models, spark.createDataFrame(table, f"{by} int, params map<string,string>, r2 double, best boolean")


def categories(df: DataFrame, columns: list[str]) -> DataFrame:
    """Columns as string categories with an index each, for learners that take categories."""
    text = df.withColumns({c: F.col(c).cast("string") for c in columns})
    indexer = StringIndexer(inputCols=columns, outputCols=[f"{c}_index" for c in columns], handleInvalid="keep")
    return indexer.fit(text).transform(text)
