"""Registered queries: cleansing, scaling and clustering."""

from __future__ import annotations

from pyspark.sql import functions as F

from seriesloom.operators import cleanse, cluster
from seriesloom.plans import inputs as inp
from seriesloom.plans.cat_aggregate import PROFILE, rnd
from seriesloom.plans.registry import cols, cte, query, r

WEIGHTED = cleanse.GROUP_COLUMNS


@query(
    "cap_iqr",
    f"SELECT d.series, d.date, {r('least(d.ordered, i.upper_bound)')} AS ordered FROM daily_lumpy d JOIN iqr i ON d.series = i.series",
)
def cap_iqr(spark, sf):
    out = cleanse.cap_iqr(inp.daily_lumpy(spark, sf), ["series"], "ordered")
    return rnd(out, ["series", "date"], ["ordered"])


cte(
    "spiky",
    """SELECT series, month, split, CASE WHEN month(month) = 5 THEN 'Infinity'::DOUBLE WHEN month(month) = 9 THEN NULL ELSE ordered END AS ordered, dispatched FROM monthly_split""",
)


def spiky(spark, sf):
    """Monthly rows with infinite and missing order values in two months of the year."""
    month = F.month("month")
    bad = F.when(month == 5, F.lit(float("inf"))).when(month != 9, F.col("ordered"))
    return inp.monthly_with_split(spark, sf).withColumn("ordered", bad).select("series", "month", "split", "ordered", "dispatched")


def _bounds_sql(low: float, high: float) -> str:
    parts = []
    for c in ("ordered", "dispatched"):
        v = f"CASE WHEN split = 'train' AND NOT isinf({c}) THEN {c} END"
        parts += [
            f"avg({v}) AS {c}_mean",
            f"quantile_cont({v}, 0.5) AS {c}_median",
            f"quantile_cont({v}, {low}) AS {c}_lower",
            f"quantile_cont({v}, {high}) AS {c}_upper",
        ]
    return f"SELECT series, {', '.join(parts)} FROM spiky GROUP BY 1"


cte("bounds_01", _bounds_sql(0.01, 0.99))
cte("bounds_05", _bounds_sql(0.05, 0.95))
_BOUNDS = [f"{c}_{s}" for c in ("ordered", "dispatched") for s in ("mean", "median", "lower", "upper")]


@query("bounds_stats", f"SELECT series, {cols({b: b for b in _BOUNDS})} FROM bounds_01")
def bounds_stats(spark, sf):
    stats = cleanse.train_bounds(
        spiky(spark, sf), ["series"], ["ordered", "dispatched"], 0.01, 0.99, F.col("split") == "train"
    )
    return rnd(stats, ["series"], _BOUNDS)


def _capped(c: str, fill: str) -> str:
    return f"greatest(least(coalesce(CASE WHEN isinf(s.{c}) THEN NULL ELSE s.{c} END, b.{c}_{fill}), b.{c}_upper), b.{c}_lower)"


@query(
    "cap_quantile",
    f"""SELECT 'mean' AS variant, s.series, s.month, {r(_capped('ordered', 'mean'))} AS ordered, {r(_capped('dispatched', 'mean'))} AS dispatched
FROM spiky s JOIN bounds_01 b ON s.series = b.series UNION ALL
SELECT 'median', s.series, s.month, {r(_capped('ordered', 'median'))}, {r(_capped('dispatched', 'median'))} FROM spiky s JOIN bounds_05 b ON s.series = b.series""",
)
def cap_quantile(spark, sf):
    rows = spiky(spark, sf)
    both = ["ordered", "dispatched"]
    variants = [
        rnd(
            cleanse.cap_quantile(rows, ["series"], both, low, high, fill).withColumn("variant", F.lit(fill)),
            ["variant", "series", "month"],
            both,
        )
        for low, high, fill in ((0.01, 0.99, "mean"), (0.05, 0.95, "median"))
    ]
    return variants[0].unionByName(variants[1])


def _minmax(c: str, w: float = 1.0) -> str:
    return f"({c} - (SELECT min({c}) FROM profiles)) / (SELECT CASE WHEN max({c}) = min({c}) THEN 1 ELSE max({c}) - min({c}) END FROM profiles) * {w}"


def _standard(c: str, w: float = 1.0) -> str:
    return f"({c} - (SELECT avg({c}) FROM profiles)) / (SELECT CASE WHEN stddev_pop({c}) = 0 THEN 1 ELSE stddev_pop({c}) END FROM profiles) * {w}"


@query("scale_minmax", f"SELECT series, {cols({c: _minmax(c) for c in PROFILE})} FROM profiles")
def scale_minmax(spark, sf):
    table = inp.profile_table(spark, sf)
    scaled = cleanse.scale_minmax(table, list(PROFILE))
    return table.select("series", *[F.round(c, 6).alias(n) for n, c in scaled.items()])


@query("scale_standard", f"SELECT series, {cols({c: _standard(c) for c in PROFILE})} FROM profiles")
def scale_standard(spark, sf):
    table = inp.profile_table(spark, sf)
    scaled = cleanse.scale_standard(table, list(PROFILE))
    return table.select("series", *[F.round(c, 6).alias(n) for n, c in scaled.items()])


def _robust(c: str) -> str:
    return f"(m.{c} - q.{c}_m) / CASE WHEN q.{c}_h = q.{c}_l THEN 1 ELSE q.{c}_h - q.{c}_l END"


_TRAIN_Q = ", ".join(
    f"quantile_cont(CASE WHEN split = 'train' THEN {c} END, {p}) AS {c}_{s}"
    for c in ("dispatched", "ordered")
    for s, p in (("l", 0.25), ("m", 0.5), ("h", 0.75))
)


@query(
    "scale_robust",
    f"SELECT m.series, m.month, m.split, {cols({c: _robust(c) for c in ('dispatched', 'ordered')})} FROM monthly_split m JOIN (SELECT series, {_TRAIN_Q} FROM monthly_split GROUP BY 1) q ON m.series = q.series",
)
def scale_robust(spark, sf):
    rows = inp.monthly_with_split(spark, sf)
    out = cleanse.scale_robust(rows, ["series"], ["dispatched", "ordered"], F.col("split") == "train")
    return rnd(out, ["series", "month", "split"], ["dispatched", "ordered"])


_WEIGHT_SQL = {
    c: (_minmax if kind == "minmax" else _standard)(c, weight) for columns, kind, weight in cleanse.GROUPS for c in columns
}


@query("weight_groups", f"SELECT series, {cols(_WEIGHT_SQL)} FROM profiles")
def weight_groups(spark, sf):
    return rnd(cleanse.weight_groups(inp.profile_table(spark, sf)), ["series"], WEIGHTED)


# --- clustering -------------------------------------------------------------------------------------

cte("weighted", "SELECT series, cluster, " + ", ".join(f"{e} AS {c}" for c, e in _WEIGHT_SQL.items()) + " FROM labelled")
_DIST = " + ".join(f"(a.{c} - b.{c}) ** 2" for c in WEIGHTED)
cte(
    "pair_means",
    f"""SELECT a.series, a.cluster, b.cluster AS other, sum({_DIST}) AS total, count(*) AS n FROM weighted a JOIN weighted b ON true GROUP BY 1, 2, 3""",
)


@query(
    "silhouette",
    f"""SELECT cluster, count(*) AS n, {r('avg(CASE WHEN own_n = 1 THEN 0 ELSE coalesce((b - a) / nullif(greatest(a, b), 0), 0) END)')} AS silhouette FROM (
SELECT series, cluster, max(CASE WHEN other = cluster THEN n END) AS own_n, max(CASE WHEN other = cluster THEN total / nullif(n - 1, 0) END) AS a,
  min(CASE WHEN other <> cluster THEN total / n END) AS b FROM pair_means GROUP BY 1, 2) GROUP BY 1""",
)
def silhouette(spark, sf):
    """Mean silhouette per given cluster; the SQL side measures all pairs."""
    labels = inp.labelled(spark, sf)
    scaled = cleanse.weight_groups(labels, ["series", "cluster"])
    rows = cluster.silhouette_rows(scaled, WEIGHTED)
    return rows.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("silhouette"), 6).alias("silhouette"))


cte(
    "level_bins",
    """SELECT k, least(floor((x - lo) / nullif(hi - lo, 0) * k), k - 1) AS bin, x FROM (SELECT avg_monthly_demand AS x FROM profiles),
(SELECT min(avg_monthly_demand) AS lo, max(avg_monthly_demand) AS hi FROM profiles), (SELECT unnest(range(2, 11)) AS k)""",
)
cte(
    "level_sweep",
    """SELECT CAST(k AS INTEGER) AS k, sum(v) AS inertia, 1 - sum(v) / max(t) AS silhouette FROM (
SELECT k, bin, var_pop(x) * count(*) AS v FROM level_bins GROUP BY 1, 2), (SELECT var_pop(avg_monthly_demand) * count(*) AS t FROM profiles) GROUP BY 1""",
)


def level_sweep(spark, sf):
    """A sweep table by rule: k equal-width bins of the demand level, with their inertia."""
    table = inp.profile_table(spark, sf)
    x = F.col("avg_monthly_demand")
    one = table.agg(F.struct(F.min(x).alias("lo"), F.max(x).alias("hi"), (F.var_pop(x) * F.count(x)).alias("t")).alias("s")).scalar()
    k = F.col("k")
    slot = F.floor(F.try_divide(x - one.getField("lo"), one.getField("hi") - one.getField("lo")) * k)
    binned = table.select(x, F.explode(F.sequence(F.lit(2), F.lit(10))).alias("k")).withColumn("bin", F.least(slot, k - 1))
    spread = binned.groupBy("k", "bin").agg((F.var_pop(x) * F.count(x)).alias("v"))
    sums = spread.groupBy("k").agg(F.sum("v").alias("inertia"))
    return sums.withColumn("silhouette", F.lit(1.0) - F.col("inertia") / one.getField("t"))


_GRADIENT = "CASE WHEN lag({c}) OVER (ORDER BY k) IS NULL THEN lead({c}) OVER (ORDER BY k) - {c} WHEN lead({c}) OVER (ORDER BY k) IS NULL THEN {c} - lag({c}) OVER (ORDER BY k) ELSE (lead({c}) OVER (ORDER BY k) - lag({c}) OVER (ORDER BY k)) / 2 END"
cte("sweep_g1", f"SELECT *, {_GRADIENT.format(c='inertia')} AS g1 FROM level_sweep")
cte("sweep_g2", f"SELECT *, abs({_GRADIENT.format(c='g1')}) AS g2 FROM sweep_g1")
cte("elbow", "SELECT k AS elbow_k FROM sweep_g2 ORDER BY g2 DESC, k LIMIT 1")


@query("elbow_k", "SELECT elbow_k FROM elbow")
def elbow_k(spark, sf):
    return cluster.elbow_k(level_sweep(spark, sf))


@query(
    "choose_k",
    """SELECT elbow_k, silhouette_k, least(CASE WHEN best_score - at_elbow < 0.1 THEN elbow_k ELSE silhouette_k END, 3) AS k FROM (
SELECT (SELECT elbow_k FROM elbow) AS elbow_k, (SELECT k FROM level_sweep ORDER BY silhouette DESC, k LIMIT 1) AS silhouette_k,
  (SELECT max(silhouette) FROM level_sweep) AS best_score, (SELECT silhouette FROM level_sweep WHERE k = (SELECT elbow_k FROM elbow)) AS at_elbow)""",
)
def choose_k(spark, sf):
    return cluster.choose_k(level_sweep(spark, sf))


def weighted_vectors(spark, sf):
    return cluster.assemble(cleanse.weight_groups(inp.profile_table(spark, sf)), WEIGHTED)


@query("kmeans_fit")
def kmeans_fit(spark, sf):
    rows = weighted_vectors(spark, sf)
    model = cluster.kmeans(rows, cluster.MAX_K, cluster.FINAL["n_init"], cluster.FINAL["max_iter"], cluster.FINAL["tol"])
    return cluster.label(rows, model, F.col("avg_monthly_demand")).select("series", "cluster")


@query("kmeans_sweep")
def kmeans_sweep(spark, sf):
    return cluster.sweep(weighted_vectors(spark, sf), WEIGHTED)


@query("fixed_k")
def fixed_k(spark, sf):
    """The older variant: four clusters on standard-scaled features of equal weight."""
    table = inp.profile_table(spark, sf)
    scaled = table.select("series", *[c.alias(n) for n, c in cleanse.scale_standard(table, list(PROFILE)).items()])
    rows = cluster.assemble(scaled, list(PROFILE))
    model = cluster.kmeans(rows, cluster.FIXED_K, cluster.SWEEP["n_init"], cluster.SWEEP["max_iter"], cluster.SWEEP["tol"])
    return cluster.label(rows, model, F.col("avg_monthly_demand")).select("series", "cluster")
