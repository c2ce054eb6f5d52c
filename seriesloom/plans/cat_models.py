"""Registered queries: model panels.

Results depend on the learner, so there is no SQL counterpart. Every run uses its whole configuration
from ``operators.models``.
"""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from seriesloom.functions import text
from seriesloom.operators import align, indicators, models, recursive, report, score, trend
from seriesloom.operators import window as win
from seriesloom.plans import clustered
from seriesloom.plans import inputs as inp
from seriesloom.plans.cat_sources import CATEGORIES, category_rows
from seriesloom.plans.cat_window import brand_labelled
from seriesloom.plans.registry import cols, query
from seriesloom.session import cut_lineage, remembered, scratch_path
from seriesloom.sources import sinks

KEYS = ["series", "date"]
MONTH_KEYS = ["series", "month"]


def daily_rows(spark, sf):
    """Main daily features with the cluster of the series and its train statistics, materialised."""
    features = inp.features_main(spark, sf)
    train = F.when(F.col("split") == "train", F.col("dispatched"))
    stats = features.groupBy("series").agg(F.avg(train).alias("series_mean"), F.stddev_samp(train).alias("series_std"))
    joined = features.join(stats, "series").join(brand_labelled(spark, sf), "series")
    names = [c for c in joined.columns if c not in (*KEYS, "split", "dispatched", "ordered", "cluster")]
    rows = models.vectors(joined, names).select(*KEYS, "split", "cluster", "dispatched", "features")
    return cut_lineage(rows), names


def monthly_rows(spark, sf):
    """Monthly features: lags, rolling statistics, indicators and calendar; last 12 months are test.

    The panel is materialised, so the lines are joined once for the features and the clusters.
    """
    target, panel = F.col("dispatched"), cut_lineage(inp.monthly(spark, sf))
    joined = align.join_month(inp.monthly_with_split(spark, sf, panel), inp.external(spark, sf))
    wide = win.add(
        joined,
        win.lags(target, inp.MONTHLY, win.LAGS["month_sparse"], "Demand"),
        win.roll_past(target, inp.MONTHLY, (3, 6, 12), "Demand"),
        {"MonthNo": F.month("month"), "Quarter": F.quarter("month"), "Year": F.year("month") - 2022},
    )
    labelled = wide.join(brand_labelled(spark, sf, panel), "series")
    names = [c for c in labelled.columns if c not in (*MONTH_KEYS, "split", "dispatched", "ordered", "cluster")]
    return cut_lineage(models.vectors(labelled, names)), names


def clusters_of(rows) -> list[int]:
    """Cluster labels present: one value per cluster."""
    return sorted(r["cluster"] for r in rows.select("cluster").distinct().collect())


def daily_panel(spark, sf, configs, **options):
    rows, _ = daily_rows(spark, sf)
    return models.panel_by_cluster(rows, configs, "dispatched", KEYS, clusters_of(rows), **options)


@query("fit_boosted")
def fit_boosted(spark, sf):
    """One boosted model per cluster, scored at three grains."""
    predicted = daily_panel(spark, sf, models.FINISHED)
    return score.score_main(inp.by_grain(predicted), ["series", "grain"])


@query("fit_second")
def fit_second(spark, sf):
    """Oblivious trees with the second learner's settings."""
    return daily_panel(spark, sf, models.SECOND, learner="second")


@query("fit_lgbm")
def fit_lgbm(spark, sf):
    """The leaf-wise learner's settings, stopping on the validation month."""
    return daily_panel(spark, sf, {c: models.LEAFWISE for c in range(4)})


@query("early_stop")
def early_stop(spark, sf):
    """Trees kept per cluster when the validation month decides, and trees that were fitted until it did."""
    rows, _ = daily_rows(spark, sf)
    configs = {c: models.LEAFWISE for c in clusters_of(rows)}
    fitted = models.fit_panel(rows, configs, "dispatched", "cluster", validate=True)
    kept = [(c, m.getNumTrees, m.rounds) for c, m in fitted.items()]
    return spark.createDataFrame(kept, "cluster int, trees int, fitted int")


@query("ensemble_models")
def ensemble_models(spark, sf):
    """Both learners with the ensemble settings, averaged."""
    rows, _ = daily_rows(spark, sf)
    labels = clusters_of(rows)
    one, two = (
        models.panel_by_cluster(rows, models.ENSEMBLE, "dispatched", KEYS, labels, learner=kind)
        for kind in ("boosted", "second")
    )
    return models.ensemble_mean(one, two, KEYS)


@query("fit_category")
def fit_category(spark, sf):
    """Lags and calendar categories; splits take sets of categories, the test months say when to stop."""
    target = F.col("dispatched")
    wide = win.add(inp.monthly_with_split(spark, sf), win.lags(target, inp.MONTHLY, win.LAGS["month_sparse"], "Demand"), win.roll_past(target, inp.MONTHLY, (3, 6, 12), "Demand"))
    coded = models.categories(category_rows(wide), list(CATEGORIES))
    codes = [f"{c}_index" for c in CATEGORIES]
    names = [*codes, *[c for c in wide.columns if c.startswith("Demand_")]]
    rows = cut_lineage(models.vectors(coded, names).select(*MONTH_KEYS, "split", "dispatched", "features"))
    judged = rows.withColumn("split", F.when(F.col("split") == "test", "val").otherwise(F.col("split")))
    model = models.fit_boosted(judged, models.CATEGORY, "dispatched", validate=True, categorical=tuple(range(len(codes))))
    return models.predict(model, rows.where("split = 'test'"), "dispatched", MONTH_KEYS)


@query("simple_vs_full")
def simple_vs_full(spark, sf):
    rows, _ = monthly_rows(spark, sf)
    frames = []
    for name, config in (("full", models.IMPORTANCE_STUDY), ("simple", models.SIMPLE)):
        model = models.fit_boosted(rows, config, "dispatched")
        pairs = models.predict(model, rows.where("split = 'test'"), "dispatched", MONTH_KEYS)
        frames.append(score.score_main(pairs, ["series"]).withColumn("model", F.lit(name)))
    return align.stack(frames)


@query("sparse_params")
def sparse_params(spark, sf):
    """Series with many zero days train on the regularised settings, the others on the larger ones."""
    rows = inp.filled_lumpy(spark, sf)
    config = models.sparse_config(F.col("sparsity"))
    keyed = rows.join(report.sparsity(rows, ["series"]).select("series", config.alias("config")), "series")
    target = F.col("ordered")
    wide = win.add(keyed, win.lags(target, inp.SPLIT, (1, 2, 3, 7), "Order"), win.roll_past(target, inp.SPLIT, (7, 14), "Order"))
    names = [c for c in wide.columns if c.startswith("Order_")]
    ready = cut_lineage(models.vectors(wide, names).select(*KEYS, "split", "config", "ordered", "features"))
    out = []
    for name, settings in (("sparse", models.SPARSE), ("dense", models.DENSE)):
        mine = ready.where(F.col("config") == name)
        if mine.where("split = 'train'").isEmpty():
            continue
        model = models.fit_boosted(mine, settings, "ordered")
        test = mine.where("split = 'test'")
        out.append(models.predict(model, test, "ordered", KEYS).withColumn("config", F.lit(name)))
    return align.stack(out)


@query("cv_expanding")
def cv_expanding(spark, sf):
    rows, _ = monthly_rows(spark, sf)
    folded = models.expanding_folds(rows.where("split = 'train'"), inp.MONTHLY, 5)
    folds = models.cross_validate(folded, models.SIMPLE, "dispatched", [1, 2, 3, 4, 5])
    return models.fold_summary(folds)


@query("cv_backward")
def cv_backward(spark, sf):
    rows, _ = monthly_rows(spark, sf)
    folded = models.backward_folds(rows.where("split = 'train'"), inp.MONTHLY, 12, 5)
    return models.cross_validate(folded, models.SIMPLE, "dispatched", [1, 2, 3, 4, 5], older="above")


@query("grid_search")
def grid_search(spark, sf):
    """All axes of each cluster's grid, cross-validated; best marks the chosen parameters, which are written and read back."""
    rows, _ = monthly_rows(spark, sf)
    folded = models.block_folds(rows.where("split = 'train'"), inp.MONTHLY, 5)
    labels = clusters_of(rows)
    _, table = models.grid_search(folded, {c: models.GRIDS[c] for c in labels}, "dispatched", {c: models.MONTHLY[c] for c in labels})
    path = scratch_path(spark, "params")
    sinks.write_params(table.where("best").select(F.col("cluster").cast("string").alias("series"), "params"), path)
    saved = sinks.read_batches(spark, path, "json", "series string, params map<string,string>")
    known = saved.select(F.col("series").cast("int").alias("cluster"), F.col("params").alias("saved"))
    return table.join(known, "cluster").select("cluster", F.to_json("params").alias("params"), "r2", "best", F.to_json("saved").alias("saved"))


def importance_table(spark, sf):
    """Importances, rows and feature names of the monthly study; fitted once a session."""

    def fit():
        rows, names = monthly_rows(spark, sf)
        model = models.fit_boosted(rows, models.IMPORTANCE_STUDY, "dispatched")
        return models.importances(model, names, spark), rows, names

    return remembered(spark, ("importance", sf), fit)


@query("importance")
def importance(spark, sf):
    table, _, _ = importance_table(spark, sf)
    return table.orderBy(F.desc("importance"), F.asc("feature"))


@query("importance_by_category")
def importance_by_category(spark, sf):
    table, _, _ = importance_table(spark, sf)
    return report.importance_by_category(table, text.category_fine(F.col("feature"))).orderBy(F.desc("importance"))


@query("topk_per_group")
def topk_per_group(spark, sf):
    """Three most important features of each category."""
    table, _, _ = importance_table(spark, sf)
    named = table.withColumn("category", text.category_fine(F.col("feature")))
    return report.top_per_group(named, ["category"], [F.desc("importance"), F.asc("feature")], 3)


@query("importance_cluster")
def importance_cluster(spark, sf):
    """Importances of each cluster's own monthly features."""
    ext = indicators.recipe_table(inp.external(spark, sf))
    panel = inp.monthly(spark, sf).join(brand_labelled(spark, sf), "series")
    wide = align.join_month(panel, ext).withColumns({"MonthNo": F.month("month"), "Quarter": F.quarter("month")})
    complete = cut_lineage(wide.na.drop().withColumn("split", F.lit("train")))
    out = []
    for c in clusters_of(complete):
        names = ["MonthNo" if n == "Month" else n for n in indicators.recipe_columns(c)]
        mine = models.vectors(complete.where(F.col("cluster") == c), names)
        model = models.fit_boosted(mine, models.IMPORTANCE[c], "ordered")
        out.append(models.importances(model, names, spark).withColumn("cluster", F.lit(c)))
    return align.stack(out)


@query("top_feature_freq")
def top_feature_freq(spark, sf):
    """How many series have a feature among their five most important.

    With one model per cluster the importance of a series is that of its cluster.
    """
    per_cluster = importance_cluster(spark, sf)
    return report.top_feature_freq(brand_labelled(spark, sf).join(per_cluster, "cluster"), 5)


@query("select_by_importance")
def select_by_importance(spark, sf):
    """Refit on features at or above the mean (or median) importance."""
    out = []
    table, rows, names = importance_table(spark, sf)
    for rule, config in models.SELECTION.items():
        chosen = models.selected(table, rule)
        narrow = models.vectors(rows.drop("features"), chosen)
        model = models.fit_boosted(narrow, config, "dispatched")
        pairs = models.predict(model, narrow.where("split = 'test'"), "dispatched", MONTH_KEYS)
        scored = score.score_main(pairs, ["series"])
        out.append(scored.withColumns({"rule": F.lit(rule), "n_features": F.lit(len(chosen))}))
    return align.stack(out)


@query("baseline_ext")
def baseline_ext(spark, sf):
    """Monthly orders from the raw indicators alone."""
    joined = align.join_month(inp.monthly_with_split(spark, sf), inp.external(spark, sf))
    ready = cut_lineage(models.vectors(joined, list(text.INDICATORS)))
    model = models.fit_boosted(ready, models.SIMPLE, "ordered")
    pairs = models.predict(model, ready.where("split = 'test'"), "ordered", MONTH_KEYS)
    return score.score_main(pairs, ["series"])


@query("holt_winters")
def holt_winters(spark, sf):
    """Smoothing per series with bounds from the train residuals."""
    fitted = recursive.holt_winters(inp.monthly_with_split(spark, sf), inp.MONTHLY, "ordered")
    return score.interval_const(fitted, ["series"], "train")


@query("smoothing_routed")
def smoothing_routed(spark, sf):
    """Smooth series through smoothing, the others through boosted trees, in one result."""
    flags = models.route_smooth(inp.monthly_smooth_flags(spark, sf)).select("series", "route")
    rows, _ = monthly_rows(spark, sf)
    routed = rows.join(flags, "series")
    smooth = recursive.holt_winters(
        routed.where("route = 'smoothing'").select("series", "month", "split", "ordered"), inp.MONTHLY, "ordered"
    )
    frames = [smooth.where("split = 'test'").select("series", "month", "actual", "predicted", F.lit("smoothing").alias("route"))]
    boosted = cut_lineage(routed.where("route = 'boosted'"))
    if not boosted.isEmpty():
        model = models.fit_boosted(boosted, models.SIMPLE, "ordered")
        pairs = models.predict(model, boosted.where("split = 'test'"), "ordered", MONTH_KEYS)
        frames.append(pairs.withColumn("route", F.lit("boosted")))
    return align.stack(frames)


@query("seasonal_regression")
def seasonal_regression(spark, sf):
    """Bending trend, waves and indicators by cluster; the indicators are carried to days, gaps take the mean."""
    panel = inp.filled(spark, sf)
    rows = align.asof_mean_fill(panel, inp.external(spark, sf), list(text.INDICATORS), inp.last_day(spark, sf), inp.SPEC)
    out = trend.seasonal_regression(rows.join(brand_labelled(spark, sf), "series"), inp.SPEC, list(text.INDICATORS))
    return out.where("split = 'test'")


@query("score_learners")
def score_learners(spark, sf):
    """Train and test scores of a learner side by side."""
    rows, _ = monthly_rows(spark, sf)
    model = models.fit_boosted(rows, models.MONTHLY[1], "dispatched")
    pairs = models.predict(model, rows, "dispatched", [*MONTH_KEYS, "split"])
    return score.score_train_test(pairs, ["series"])


@query("clustered_batch")
def clustered_batch(spark, sf):
    """The whole clustered run: clusters, features, models, results written and read back."""
    orders, external = inp.daily(spark, sf), inp.external(spark, sf)
    assignments = cut_lineage(clustered.clusters(orders, external, "1998-01-01"))
    out = scratch_path(spark, "batch")
    clustered.run(orders, external, inp.first_day(spark, sf), inp.last_day(spark, sf), inp.TEST, assignments, out=out)
    return spark.read.parquet(f"{out}/scores")


def _horizon_sql(horizon):
    """Demand and order features of a horizon, moved down outside train, in SQL."""
    w = "PARTITION BY series, split ORDER BY date"
    raw = {f"Demand_lag_{k}": f"lag(dispatched, {k}) OVER ({w})" for k in horizon.lags}
    for n in horizon.rolls:
        frame = f"OVER ({w} ROWS BETWEEN {n - 1 + horizon.roll_shift} PRECEDING AND {horizon.roll_shift} PRECEDING)"
        raw |= {f"Demand_mean_{n}": f"avg(dispatched) {frame}", f"Demand_std_{n}": f"stddev_samp(dispatched) {frame}"}
    raw |= {f"Order_lag_{k}": f"lag(ordered, {k}) OVER ({w})" for k in horizon.order_lags}
    raw |= {f"Order_ratio_{k}": f"lag(ordered, {k}) OVER ({w}) / nullif(lag(dispatched, {k}) OVER ({w}), 0)" for k in horizon.ratio_lags}
    end = "2000-12-01" if horizon.gap else "2001-01-01"
    rows = f"""SELECT series, date, dispatched, ordered, CASE WHEN date < DATE '{end}' - INTERVAL 1 MONTH THEN 'train'
  WHEN date < DATE '{end}' THEN 'val' WHEN date >= DATE '2001-01-01' THEN 'test' END AS split FROM filled"""
    moved = {
        n: f"coalesce(CASE split WHEN 'train' THEN {n} WHEN 'val' THEN lag({n}, 1) OVER ({w}) ELSE lag({n}, {1 + horizon.test_rows}) OVER ({w}) END, 0)"
        for n in raw
    }
    inner = ", ".join(f"{e} AS {n}" for n, e in raw.items())
    return f"SELECT series, date, split, {cols(moved)} FROM (SELECT series, date, split, {inner} FROM ({rows}) WHERE split IS NOT NULL)"


def _horizon_features(spark, sf, horizon):
    panel = inp.filled(spark, sf).withColumn("split", horizon.split(F.col("date"), inp.TEST)).where("split IS NOT NULL")
    wide, names = clustered.feature_matrix(panel, inp.external(spark, sf), inp.SPEC, inp.TEST, horizon)
    shown = {n: re.sub(r"_shift\d+|_roll", "", n).replace("ratio_lag", "ratio") for n in names if n.startswith(("Demand_", "Order_"))}
    return wide.select("series", "date", "split", *[F.round(F.col(n), 6).alias(s) for n, s in shown.items()])


@query("horizon_short_features", _horizon_sql(clustered.SHORT))
def horizon_short_features(spark, sf):
    return _horizon_features(spark, sf, clustered.SHORT)


@query("horizon_long_features", _horizon_sql(clustered.LONG))
def horizon_long_features(spark, sf):
    return _horizon_features(spark, sf, clustered.LONG)


@query("horizon_short")
def horizon_short(spark, sf):
    return _horizon(spark, sf, clustered.SHORT)


@query("horizon_long")
def horizon_long(spark, sf):
    return _horizon(spark, sf, clustered.LONG)


def _horizon(spark, sf, horizon):
    """Scores of a horizon's feature lists, one model per given cluster."""
    return clustered.run(
        inp.daily(spark, sf), inp.external(spark, sf), inp.first_day(spark, sf), inp.last_day(spark, sf), inp.TEST, brand_labelled(spark, sf), horizon
    )["scores"]
