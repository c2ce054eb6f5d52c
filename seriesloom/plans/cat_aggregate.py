"""Registered queries: roll-ups, profiles, summaries, distributions and rankings."""

from __future__ import annotations

from pyspark.sql import functions as F

from seriesloom.functions import text
from seriesloom.operators import align, cleanse, indicators, lumpy, models, report, resample, score
from seriesloom.operators import profile as prof
from seriesloom.plans import inputs as inp
from seriesloom.plans.registry import cols, cte, query, r
from seriesloom.session import cut_lineage
from seriesloom.sources import tables

METRICS = ("rmse", "mae", "mape", "r2")
PROFILE = ("avg_monthly_demand", "demand_std", "demand_cv", "order_fulfillment", "sens_PIB_CO", "sens_ICI", "sens_ECG_DESP", "sens_ISE_CO")
MEASURES = inp.MEASURES


def rnd(df, keep: list[str], columns, digits: int = 6):
    return df.select(*keep, *[F.round(c, digits).alias(c) for c in columns])


def same(names) -> dict[str, str]:
    return {n: n for n in names}


# --- roll-ups ------------------------------------------------------------------------------


@query(
    "agg_monthly",
    """SELECT p.p_brand AS series, p.p_name AS series_name, CAST(date_trunc('month', m.date) AS DATE) AS month,
  sum(m.dispatched) AS dispatched, sum(m.ordered) AS ordered FROM moves m JOIN part p ON m.partkey = p.p_partkey GROUP BY 1, 2, 3""",
)
def agg_monthly(spark, sf):
    return tables.orders_monthly(spark, sf, F.col("p_brand"), F.col("p_name"))


cte(
    "ext_daily",
    """
SELECT o.day, n AS ECG_DESP, value / n AS TUAV, net AS PIB_CO, value AS ISE_CO, customers AS VTOTAL_19, urgent AS OTOTAL_19, discount AS ICI
FROM (SELECT CAST(o_orderdate AS DATE) AS day, CAST(count(*) AS DOUBLE) AS n, CAST(sum(CAST(o_totalprice AS DECIMAL(18, 2))) AS DOUBLE) AS value,
  CAST(count(DISTINCT o_custkey) AS DOUBLE) AS customers, avg(CASE WHEN o_orderpriority = '1-URGENT' THEN 1.0 ELSE 0.0 END) AS urgent FROM orders GROUP BY 1) o
LEFT JOIN (SELECT CAST(l_shipdate AS DATE) AS day,
  CAST(sum(CAST(l_extendedprice AS DECIMAL(18, 2)) * (CAST(1 AS DECIMAL(3, 2)) - CAST(l_discount AS DECIMAL(5, 2)))) AS DOUBLE) AS net,
  CAST(sum(CAST(l_discount AS DECIMAL(5, 2))) AS DOUBLE) / count(*) AS discount FROM lineitem GROUP BY 1) l ON o.day = l.day""",
)


@query(
    "agg_external",
    f"SELECT CAST(date_trunc('month', day) AS DATE) AS month, {cols({c: f'avg({c}) + 1e-9' for c in text.INDICATORS})} FROM ext_daily GROUP BY 1",
)
def agg_external(spark, sf):
    """Monthly means of indicators that come several times a month."""
    means = indicators.monthly_mean(tables.external_by(spark, sf, "day"), "day", text.INDICATORS)
    # Means of money over 8 or 16 days end at the half of the last digit shown; both sides move them off it.
    return rnd(means.withColumns({c: F.col(c) + F.lit(1e-9) for c in text.INDICATORS}), ["month"], text.INDICATORS)


@query("profile", f"SELECT series, series_name, {cols(same(PROFILE))} FROM profiles")
def profile(spark, sf):
    return rnd(inp.profiles(spark, sf), ["series", "series_name"], PROFILE)


@query(
    "fulfil_mean_ratio",
    f"SELECT series, {r('avg(dispatched / nullif(ordered, 0))')} AS order_fulfillment FROM parts_monthly GROUP BY 1",
)
def fulfil_mean_ratio(spark, sf):
    return rnd(prof.fulfil_mean_ratio(inp.parts_monthly(spark, sf)), ["series"], ["order_fulfillment"])


@query(
    "sensitivity",
    "SELECT m.series, "
    + cols(
        {
            f"sens_{c}": f"coalesce(covar_samp(dispatched, {c}) / nullif(stddev_samp(CASE WHEN {c} IS NOT NULL THEN dispatched END) * stddev_samp({c}), 0), 0)"
            for c in prof.SENSITIVITIES
        }
    )
    + " FROM monthly m LEFT JOIN ext e ON m.month = e.month GROUP BY 1",
)
def sensitivity(spark, sf):
    table = prof.profile(align.join_month(inp.monthly(spark, sf), inp.external(spark, sf)))
    return rnd(table, ["series"], [f"sens_{c}" for c in prof.SENSITIVITIES])


_SUMS = "sum(dispatched) AS dispatched, sum(ordered) AS ordered"
_LABELS = {
    "resample_week_sun": ("week_sun", "CAST(date_trunc('week', date) AS DATE) + 6"),
    "resample_week_mon": ("week_mon", "CAST(date_trunc('week', date - 1) AS DATE) + 7"),
    "resample_month_end": ("month_end", "last_day(date)"),
    "resample_month_start": ("month_start", "CAST(date_trunc('month', date) AS DATE)"),
}


def _register_resample(name: str, rule: str, label: str):
    @query(name, f"SELECT series, {label} AS date, {_SUMS} FROM filled_lumpy GROUP BY 1, 2")
    def run(spark, sf):
        return resample.resample(inp.filled_lumpy(spark, sf), inp.SPEC, rule, MEASURES)


for _name, (_rule, _label) in _LABELS.items():
    _register_resample(_name, _rule, _label)


@query(
    "resample_mean",
    f"""SELECT 'weekly' AS grain, series, CAST(date_trunc('week', date) AS DATE) + 6 AS date, {r('avg(dispatched)')} AS dispatched FROM filled_lumpy GROUP BY 2, 3
UNION ALL SELECT 'monthly', series, last_day(date), {r('avg(dispatched)')} FROM filled_lumpy GROUP BY 2, 3""",
)
def resample_mean(spark, sf):
    panel = inp.filled_lumpy(spark, sf)
    one = lambda grain, rule: resample.resample(panel, inp.SPEC, rule, ["dispatched"], "mean").select(
        F.lit(grain).alias("grain"), "series", "date", F.round("dispatched", 6).alias("dispatched")
    )
    return one("weekly", "week_sun").unionByName(one("monthly", "month_end"))


@query(
    "resample_offset",
    f"""SELECT 'weekly' AS grain, series, CAST(date_trunc('week', date) AS DATE) + 6 AS date, coalesce(sum(w7), 0.0) AS dispatched
FROM (SELECT series, date, lag(dispatched, 7) OVER w AS w7 FROM filled WHERE split = 'test' WINDOW w AS (PARTITION BY series ORDER BY date)) GROUP BY 2, 3
UNION ALL SELECT 'monthly', series, CAST(date_trunc('month', date) AS DATE), coalesce(sum(w1), 0.0)
FROM (SELECT series, date, lag(dispatched, 1) OVER w AS w1 FROM filled WHERE split = 'test' WINDOW w AS (PARTITION BY series ORDER BY date)) GROUP BY 2, 3""",
)
def resample_offset(spark, sf):
    test = inp.filled(spark, sf).where("split = 'test'")
    one = lambda grain, rule, rows: resample.shifted_resample(test, inp.SPEC, rule, "dispatched", rows).select(
        F.lit(grain).alias("grain"), "series", "date", "dispatched"
    )
    return one("weekly", "week_sun", 7).unionByName(one("monthly", "month_start", 1))


@query(
    "group_year_month",
    f"""SELECT series, CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month_no, {_SUMS},
  make_date(year(date), month(date), 1) AS date FROM daily_lumpy GROUP BY 1, year(date), month(date)""",
)
def group_year_month(spark, sf):
    return resample.by_year_month(inp.daily_lumpy(spark, sf), inp.SPEC, MEASURES)


@query(
    "complete_weeks",
    """SELECT series, date, dispatched FROM (SELECT *, CAST(date_trunc('week', date - 1) AS DATE) + 1 AS p,
  min(CAST(date_trunc('week', date - 1) AS DATE) + 1) OVER (PARTITION BY series) AS lo,
  max(CAST(date_trunc('week', date - 1) AS DATE) + 1) OVER (PARTITION BY series) AS hi FROM daily_lumpy) WHERE p >= lo + 7 AND p <= hi - 7""",
)
def complete_weeks(spark, sf):
    return resample.complete_weeks(inp.daily_lumpy(spark, sf), inp.SPEC).select("series", "date", "dispatched")


@query(
    "complete_months",
    """SELECT series, date, dispatched FROM (SELECT *, date_trunc('month', date) AS p,
  min(CAST(date_trunc('month', date) AS DATE)) OVER (PARTITION BY series) AS lo,
  max(CAST(date_trunc('month', date) AS DATE)) OVER (PARTITION BY series) AS hi FROM daily_lumpy)
WHERE p >= date_trunc('month', lo + 32) AND p <= date_trunc('month', hi - 32)""",
)
def complete_months(spark, sf):
    return resample.complete_months(inp.daily_lumpy(spark, sf), inp.SPEC).select("series", "date", "dispatched")


@query(
    "totals_error",
    f"""SELECT grain, sum(actual) AS total_actual, sum(predicted) AS total_predicted, sum(predicted) - sum(actual) AS difference,
  {r('(sum(predicted) - sum(actual)) / nullif(sum(actual), 0) * 100')} AS pct_error FROM naive_pairs GROUP BY 1""",
)
def totals_error(spark, sf):
    out = resample.totals_error(inp.naive_pairs(spark, sf), ["grain"])
    return out.withColumn("pct_error", F.round("pct_error", 6))


# --- summaries over series ------------------------------------------------------------------

_SUMMARY = {
    "mean": "avg(value)",
    "median": "quantile_cont(value, 0.5)",
    "std": "stddev_samp(value)",
    "min": "min(value)",
    "max": "max(value)",
}


@query(
    "score_summary",
    f"SELECT grain, metric, count(value) AS n, {cols(_SUMMARY)} FROM scores_long WHERE value IS NOT NULL GROUP BY 1, 2",
)
def score_summary(spark, sf):
    long = score.to_long(inp.naive_score_table(spark, sf))
    return rnd(report.score_summary(long), ["grain", "metric", "n"], _SUMMARY)


cte(
    "long_labelled",
    """SELECT s.series, s.grain, s.metric, s.value, l.cluster FROM scores_long s JOIN scores_labelled l ON s.series = l.series""",
)


def long_labelled(spark, sf):
    long = score.to_long(inp.naive_scores(spark, sf))
    return long.join(inp.scores_labelled(spark, sf).select("series", "cluster"), "series")


@query(
    "score_summary_cluster",
    f"SELECT cluster, grain, metric, count(value) AS n, {cols({k: v for k, v in _SUMMARY.items() if k != 'std'})} FROM long_labelled WHERE value IS NOT NULL GROUP BY 1, 2, 3",
)
def score_summary_cluster(spark, sf):
    out = report.score_summary(cut_lineage(long_labelled(spark, sf)), ("cluster", "grain", "metric"))
    return rnd(out, ["cluster", "grain", "metric", "n"], ["mean", "median", "min", "max"])


_DESCRIBE = {
    "mean": "avg(value)",
    "std": "stddev_samp(value)",
    "min": "min(value)",
    "q25": "quantile_cont(value, 0.25)",
    "q50": "quantile_cont(value, 0.5)",
    "q75": "quantile_cont(value, 0.75)",
    "max": "max(value)",
}


@query(
    "describe_scores",
    f'SELECT grain, metric, count(value) AS "count", {cols(_DESCRIBE)} FROM scores_long WHERE value IS NOT NULL GROUP BY 1, 2',
)
def describe_scores(spark, sf):
    long = score.to_long(inp.naive_score_table(spark, sf))
    return rnd(report.describe(long, ["grain", "metric"], "value"), ["grain", "metric", "count"], _DESCRIBE)


_POINTS = (10, 25, 50, 75, 90)


@query(
    "percentiles",
    f"SELECT grain, {cols({f'p{p}': f'quantile_cont(r2, {p / 100})' for p in _POINTS})} FROM naive_scores GROUP BY 1",
)
def percentiles(spark, sf):
    out = report.percentiles(inp.naive_score_table(spark, sf), ["grain"], "r2", _POINTS)
    return rnd(out, ["grain"], [f"p{p}" for p in _POINTS])


@query(
    "cluster_stats",
    f"""SELECT cluster, metric, {r('avg(value)', 2)} AS mean, {r('stddev_samp(value)', 2)} AS std, {r('min(value)', 2)} AS min,
  {r('max(value)', 2)} AS max, count(value) AS n FROM long_labelled WHERE grain = 'monthly' AND value IS NOT NULL GROUP BY 1, 2""",
)
def cluster_stats(spark, sf):
    return report.cluster_stats(long_labelled(spark, sf).where("grain = 'monthly'"))


@query("cluster_sizes", "SELECT cluster, count(*) AS n FROM labelled GROUP BY 1")
def cluster_sizes(spark, sf):
    return report.cluster_sizes(inp.labelled(spark, sf))


@query("cluster_means", f"SELECT cluster, {cols({c: f'avg({c})' for c in PROFILE})} FROM labelled GROUP BY 1")
def cluster_means(spark, sf):
    return rnd(report.cluster_means(inp.labelled(spark, sf), list(PROFILE)), ["cluster"], PROFILE)


@query(
    "cluster_map",
    f"SELECT series, series_name, cluster, {r('avg_monthly_demand')} AS avg_monthly_demand FROM labelled ORDER BY cluster, avg_monthly_demand DESC, series",
)
def cluster_map(spark, sf):
    out = report.cluster_map(inp.labelled(spark, sf))
    return rnd(out, ["series", "series_name", "cluster"], ["avg_monthly_demand"])


_RATE = "round(count(*) FILTER (r2 > 0.3) / count(*) * 100, 2)"


@query(
    "success_rate",
    f"""SELECT CAST(cluster AS VARCHAR) AS cluster, CASE WHEN count(*) FILTER (r2 > 0.3) > 0 THEN {_RATE} END AS success_rate FROM scores_labelled GROUP BY 1
UNION ALL SELECT 'all', {_RATE} FROM scores_labelled""",
)
def success_rate(spark, sf):
    scores = inp.scores_labelled(spark, sf)
    each = report.success_rate(scores, ["cluster"]).withColumn("cluster", F.col("cluster").cast("string"))
    return each.unionByName(report.success_rate(scores, []).withColumn("cluster", F.lit("all")))


cte(
    "cluster_r2",
    "SELECT cluster, avg(r2) AS m, stddev_samp(r2) AS s FROM scores_labelled GROUP BY 1 HAVING avg(r2) IS NOT NULL",
)


@query(
    "best_cluster",
    """SELECT (SELECT cluster FROM cluster_r2 ORDER BY m DESC, cluster LIMIT 1) AS best_cluster,
  (SELECT cluster FROM cluster_r2 ORDER BY m, cluster LIMIT 1) AS worst_cluster,
  (SELECT cluster FROM cluster_r2 WHERE s IS NOT NULL ORDER BY s, cluster LIMIT 1) AS most_consistent""",
)
def best_cluster(spark, sf):
    return report.best_cluster(inp.scores_labelled(spark, sf))


_GRAIN_R2 = ("daily_r2", "weekly_r2", "monthly_r2")


cte(
    "wide_r2",
    "SELECT series, " + ", ".join(f"max(r2) FILTER (grain = '{g[:-3]}') AS {g}" for g in _GRAIN_R2) + " FROM naive_scores GROUP BY 1",
)


@query(
    "score_corr",
    "SELECT * FROM ("
    + " UNION ALL ".join(
        f"SELECT '{a}' AS \"left\", '{b}' AS \"right\", {r(f'covar_samp({a}, {b}) / nullif(stddev_samp(CASE WHEN {b} IS NOT NULL THEN {a} END) * stddev_samp(CASE WHEN {a} IS NOT NULL THEN {b} END), 0)')} AS corr FROM wide_r2"
        for a in _GRAIN_R2
        for b in _GRAIN_R2
    )
    + ")",
)
def score_corr(spark, sf):
    wide = score.to_wide(inp.naive_scores(spark, sf))
    return rnd(report.score_corr(wide, list(_GRAIN_R2)), ["left", "right"], ["corr"])



_BINS = [(None, 0.0), (0.0, 0.2), (0.2, 0.4), (0.4, 0.6), (0.6, 0.8), (0.8, 1.0)]


@query(
    "r2_bins",
    " UNION ALL ".join(
        f"SELECT '{name}' AS bin, count(*) FILTER ({'r2 <= 0' if lo is None else f'r2 > {lo} AND r2 <= {hi}'}) AS n FROM naive_scores WHERE grain = 'monthly'"
        for (lo, hi), (_, name) in zip(_BINS, report.R2_BINS)
    ),
)
def r2_bins(spark, sf):
    return report.r2_bins(inp.naive_scores(spark, sf).where("grain = 'monthly'"))


@query(
    "histogram",
    """SELECT grain, CAST(least(floor((r2 - lo) / nullif((hi - lo) / 20, 0)), 19) AS INTEGER) AS bin, count(*) AS n
FROM naive_scores JOIN (SELECT grain AS g, min(r2) AS lo, max(r2) AS hi FROM naive_scores GROUP BY 1) ON g = grain
WHERE r2 IS NOT NULL GROUP BY 1, 2""",
)
def histogram(spark, sf):
    return report.histogram(inp.naive_scores(spark, sf), "r2", ["grain"], 20)


_BOX = {"q25": "quantile_cont({c}, 0.25)", "q50": "quantile_cont({c}, 0.5)", "q75": "quantile_cont({c}, 0.75)"}


@query(
    "box_stats",
    " UNION ALL ".join(
        f"SELECT '{c}' AS metric, cluster, {cols({k: v.format(c=c) for k, v in _BOX.items()})} FROM labelled GROUP BY cluster"
        for c in PROFILE
    ),
)
def box_stats(spark, sf):
    long = inp.labelled(spark, sf).unpivot(["series", "cluster"], list(PROFILE), "metric", "value")
    return rnd(report.box_stats(long, ["metric", "cluster"], "value"), ["metric", "cluster"], _BOX)


# --- demand classes --------------------------------------------------------------------------


_PATTERN = f"""SELECT series, CASE WHEN cv <= 0.5 THEN 'Smooth' WHEN cv <= 1 THEN 'Erratic' WHEN cv > 1 THEN 'Lumpy' END AS pattern FROM (
SELECT series, CASE WHEN avg(ordered) > 0 THEN stddev_samp(ordered) / avg(ordered) END AS cv FROM (
SELECT CAST(p.p_partkey AS VARCHAR) AS series, date_trunc('month', m.date) AS month,
  sum(CASE WHEN date_trunc('month', m.date) < DATE '{inp.TEST}' THEN m.ordered END) AS ordered
FROM moves m JOIN part p ON m.partkey = p.p_partkey GROUP BY 1, 2) GROUP BY 1)"""


@query("demand_pattern", _PATTERN)
def demand_pattern(spark, sf):
    """Classes of all parts from their active train months."""
    return demand_pattern_train(spark, sf)


@query("demand_pattern_train", _PATTERN)
def demand_pattern_train(spark, sf):
    rows = tables.orders_monthly(spark, sf, F.col("p_partkey").cast("string"))
    part = F.when(F.col("month") < F.lit(inp.TEST).cast("date"), "train").otherwise("test")
    stats = score.series_stats(rows.withColumn("split", part), ["series"], "ordered")
    return stats.select("series", lumpy.demand_pattern(F.col("demand_cv")).alias("pattern"))


_SMOOTH = """SELECT series, count(*) AS n, stddev_pop(CASE WHEN ordered > 0 THEN ordered END) / nullif(avg(CASE WHEN ordered > 0 THEN ordered END), 0) AS cv,
  avg(CASE WHEN ordered > 0 THEN 1.0 ELSE 0.0 END) AS share FROM monthly_lumpy GROUP BY 1"""


@query(
    "is_smooth",
    f"""SELECT series, n, {r('cv')} AS nonzero_cv, {r('share')} AS nonzero_share, coalesce(cv <= 0.5 AND share >= 0.7, false) AS is_smooth
FROM ({_SMOOTH})""",
)
def is_smooth(spark, sf):
    flags = lumpy.smooth_flags(inp.monthly_lumpy(spark, sf), ["series"], "ordered")
    return rnd(flags, ["series", "n", "is_smooth"], ["nonzero_cv", "nonzero_share"])


@query(
    "route_smooth",
    f"""SELECT series, CASE WHEN coalesce(cv <= 0.5 AND share >= 0.7, false) AND n - 12 >= 24 THEN 'smoothing' ELSE 'boosted' END AS route
FROM ({_SMOOTH})""",
)
def route_smooth(spark, sf):
    flags = lumpy.smooth_flags(inp.monthly_lumpy(spark, sf), ["series"], "ordered")
    return models.route_smooth(flags).select("series", "route")


@query(
    "sparsity",
    f"SELECT series, {r('avg(CASE WHEN ordered = 0 THEN 1.0 ELSE 0.0 END)')} AS sparsity FROM filled_lumpy GROUP BY 1",
)
def sparsity(spark, sf):
    return rnd(report.sparsity(inp.filled_lumpy(spark, sf), ["series"]), ["series"], ["sparsity"])


cte(
    "sparsity_scores",
    """SELECT n.*, p.sparsity FROM naive_scores n JOIN (SELECT series, avg(CASE WHEN ordered = 0 THEN 1.0 ELSE 0.0 END) AS sparsity
FROM filled_lumpy GROUP BY 1) p ON n.series = p.series WHERE n.grain = 'weekly'""",
)


@query(
    "sparsity_corr",
    f"""SELECT {r('covar_samp(sparsity, r2) / nullif(stddev_samp(CASE WHEN r2 IS NOT NULL THEN sparsity END) * stddev_samp(CASE WHEN sparsity IS NOT NULL THEN r2 END), 0)')} AS corr FROM sparsity_scores""",
)
def sparsity_corr(spark, sf):
    return rnd(report.sparsity_corr(sparsity_scores(spark, sf)), [], ["corr"])




def sparsity_scores(spark, sf):
    weekly = inp.naive_scores(spark, sf).where("grain = 'weekly'")
    return weekly.join(report.sparsity(inp.filled_lumpy(spark, sf), ["series"]), "series")


cte(
    "sparsity_monthly",
    """SELECT n.*, p.sparsity FROM naive_scores n JOIN (SELECT series, avg(CASE WHEN ordered = 0 THEN 1.0 ELSE 0.0 END) AS sparsity
FROM filled_lumpy GROUP BY 1) p ON n.series = p.series WHERE n.grain = 'monthly'""",
)


@query(
    "good_poor_groups",
    f"""SELECT CASE WHEN r2 < 0.4 THEN 'poor' ELSE 'good' END AS performance, count(*) AS n,
  {cols({c: f'avg({c})' for c in ('sparsity', 'mae', 'rmse')})} FROM sparsity_monthly WHERE r2 IS NOT NULL GROUP BY 1""",
)
def good_poor_groups(spark, sf):
    monthly = inp.naive_scores(spark, sf).where("grain = 'monthly'")
    scores = monthly.join(report.sparsity(inp.filled_lumpy(spark, sf), ["series"]), "series")
    return rnd(report.good_poor_groups(scores), ["performance", "n"], ["sparsity", "mae", "rmse"])


cte(
    "iqr",
    """SELECT series, q3 + 1.5 * (q3 - q1) AS upper_bound FROM (SELECT series, quantile_cont(ordered, 0.25) AS q1,
  quantile_cont(ordered, 0.75) AS q3 FROM daily_lumpy GROUP BY 1)""",
)


@query(
    "outlier_count",
    f"""SELECT d.series, {r('max(upper_bound)')} AS upper_bound, count(*) FILTER (ordered > upper_bound) AS n_outliers,
  {r('count(*) FILTER (ordered > upper_bound) / count(*) * 100')} AS pct_outliers FROM daily_lumpy d JOIN iqr i ON d.series = i.series GROUP BY 1""",
)
def outlier_count(spark, sf):
    out = cleanse.outlier_counts(inp.daily_lumpy(spark, sf), ["series"], "ordered")
    return rnd(out, ["series", "n_outliers"], ["upper_bound", "pct_outliers"])


@query(
    "coverage",
    "SELECT series, split, min(date) AS first_date, max(date) AS last_date, count(*) AS n_rows FROM filled_lumpy GROUP BY 1, 2",
)
def coverage(spark, sf):
    return report.coverage(inp.filled_lumpy(spark, sf), ["series", "split"])


@query("distinct_series", "SELECT DISTINCT p_brand AS series, p_name AS series_name FROM part")
def distinct_series(spark, sf):
    part = tables.table(spark, sf, "part").withColumnsRenamed({"p_brand": "series", "p_name": "series_name"})
    return report.distinct_series(part, ["series", "series_name"])


# --- sorting and top-k ------------------------------------------------------------------------


@query("sort_series", "SELECT series, date, dispatched FROM daily_lumpy ORDER BY 1, 2")
def sort_series(spark, sf):
    return inp.daily_lumpy(spark, sf).select("series", "date", "dispatched").orderBy("series", "date")


def _topk(order: str) -> str:
    return f"""SELECT grain, series, {r('r2')} AS r2, rank FROM (SELECT *, CAST(row_number() OVER (PARTITION BY grain ORDER BY r2 {order}, series) AS INTEGER) AS rank
FROM naive_scores WHERE r2 IS NOT NULL) WHERE rank <= 5"""


@query("topk", _topk("DESC"))
def topk(spark, sf):
    out = report.top_series(inp.naive_scores(spark, sf), "r2", 5, best=True)
    return rnd(out, ["grain", "series", "rank"], ["r2"])


@query("bottomk", _topk("ASC"))
def bottomk(spark, sf):
    out = report.top_series(inp.naive_scores(spark, sf), "r2", 5, best=False)
    return rnd(out, ["grain", "series", "rank"], ["r2"])


@query(
    "peaks_in_range",
    " UNION ALL ".join(
        f"""SELECT * FROM (SELECT '{c}' AS kind, series, date, {c} AS value FROM naive_pairs WHERE grain = 'daily' AND date BETWEEN DATE '2001-03-01' AND DATE '2001-06-30'
AND {c} IS NOT NULL ORDER BY {c} DESC, series, date LIMIT 10)"""
        for c in ("actual", "predicted")
    ),
)
def peaks_in_range(spark, sf):
    return report.peaks(inp.naive_daily(spark, sf), ["actual", "predicted"], "2001-03-01", "2001-06-30")


@query("rank_scores", f"SELECT series, grain, n, {cols(same(METRICS))} FROM naive_scores ORDER BY r2 DESC NULLS LAST, series")
def rank_scores(spark, sf):
    return rnd(report.rank_scores(inp.naive_scores(spark, sf)), ["series", "grain", "n"], METRICS)


