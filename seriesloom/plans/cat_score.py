"""Registered queries: forecast scores and intervals."""

from __future__ import annotations

from pyspark.sql import functions as F

from seriesloom.operators import align, report, score
from seriesloom.plans import inputs as inp
from seriesloom.plans.cat_aggregate import METRICS, rnd, same
from seriesloom.plans.ctes import SCORE
from seriesloom.plans.registry import cols, cte, query, r
from seriesloom.session import cut_lineage

_R2_DET = """CASE WHEN var_pop(actual) = 0 THEN CASE WHEN sum((actual - predicted) ** 2) = 0 THEN 1.0 ELSE 0.0 END
  ELSE 1 - sum((actual - predicted) ** 2) / (var_pop(actual) * count(actual)) END"""
_MAPE = "avg(CASE WHEN actual <> 0 THEN abs((actual - predicted) / nullif(actual, 0)) END) * 100"


def pairs(spark, sf):
    """Pairs of every grain with both sides present, zero actuals included."""
    from seriesloom.plans.cat_panel import model_table

    return inp.by_grain(model_table(spark, sf, 7)).where("predicted IS NOT NULL")


cte("weekly_model", "SELECT series, date, actual, weekly AS predicted FROM two_models")
cte(
    "score_pairs",
    """
SELECT series, 'daily' AS grain, date, actual, predicted FROM weekly_model WHERE predicted IS NOT NULL
UNION ALL SELECT series, 'weekly', CAST(date_trunc('week', date) AS DATE) + 6, sum(actual), coalesce(sum(predicted), 0.0) FROM weekly_model GROUP BY 1, 3
UNION ALL SELECT series, 'monthly', last_day(date), sum(actual), coalesce(sum(predicted), 0.0) FROM weekly_model GROUP BY 1, 3
""",
)
BY = ["series", "grain"]


@query(
    "score_main",
    f"SELECT series, grain, n, {cols(same(METRICS))} FROM (SELECT series, grain, {SCORE} FROM score_pairs GROUP BY 1, 2)",
)
def score_main(spark, sf):
    return rnd(score.score_main(pairs(spark, sf), BY), [*BY, "n"], METRICS)


@query(
    "score_filtered",
    f"""SELECT series, grain, n, {cols({m: f'CASE WHEN n > 1 THEN {m} END' for m in METRICS})} FROM (
SELECT s.series, s.grain, coalesce(n, 0) AS n, rmse, mae, mape, r2 FROM (SELECT DISTINCT series, grain FROM naive_pairs) s
LEFT JOIN (SELECT series, grain, count(*) AS n, sqrt(avg((actual - predicted) ** 2)) AS rmse, avg(abs(actual - predicted)) AS mae,
  {_MAPE} AS mape, {_R2_DET} AS r2 FROM naive_pairs WHERE actual <> 0 AND predicted IS NOT NULL GROUP BY 1, 2) x
ON x.series = s.series AND x.grain = s.grain)""",
)
def score_filtered(spark, sf):
    return rnd(score.score_filtered(inp.naive_pairs(spark, sf), BY), [*BY, "n"], METRICS)


@query(
    "naive_forecast",
    """SELECT series, date, actual, predicted FROM naive_daily""",
)
def naive_forecast(spark, sf):
    return inp.naive_daily(spark, sf)


@query(
    "score_r2_det",
    f"""SELECT series, grain, {r('CASE WHEN var_pop(actual) = 0 THEN 0 ELSE 1 - sum((actual - predicted) ** 2) / (var_pop(actual) * count(*)) END')} AS r2,
  {r('CASE WHEN var_pop(actual) = 0 THEN NULL ELSE 1 - sum((actual - predicted) ** 2) / (var_pop(actual) * count(*)) END')} AS r2_strict
FROM score_pairs GROUP BY 1, 2""",
)
def score_r2_det(spark, sf):
    rows = pairs(spark, sf)
    strict = score.score_r2_det(rows, BY, zero_when_flat=False).withColumnRenamed("r2", "r2_strict")
    return rnd(score.score_r2_det(rows, BY).join(strict, BY), BY, ["r2", "r2_strict"])


@query(
    "score_r2_clamped",
    f"""SELECT series, grain, {r(f'CASE WHEN count(*) > 1 THEN greatest(0.0, {_R2_DET}) END')} AS r2,
  {r('sqrt(avg((actual - predicted) ** 2))')} AS rmse, {r('avg(abs(actual - predicted))')} AS mae, {r(_MAPE)} AS mape
FROM score_pairs GROUP BY 1, 2""",
)
def score_r2_clamped(spark, sf):
    return rnd(score.score_r2_clamped(pairs(spark, sf), BY), BY, ["r2", "rmse", "mae", "mape"])


@query(
    "score_mape_eps",
    f"SELECT series, grain, {r('avg(abs((actual - predicted) / (actual + 1e-6))) * 100', 2)} AS mape FROM score_pairs GROUP BY 1, 2",
)
def score_mape_eps(spark, sf):
    return rnd(score.score_mape_eps(pairs(spark, sf), BY), BY, ["mape"], 2)


@query(
    "score_mape_raw",
    f"SELECT series, grain, {r(f'CASE WHEN min(abs(actual)) > 0 THEN {_MAPE} END')} AS mape FROM score_pairs GROUP BY 1, 2",
)
def score_mape_raw(spark, sf):
    return rnd(score.score_mape_raw(pairs(spark, sf), BY), BY, ["mape"])


@query("score_bias", f"SELECT series, grain, {r('avg(predicted - actual)')} AS bias FROM score_pairs GROUP BY 1, 2")
def score_bias(spark, sf):
    return rnd(score.score_bias(pairs(spark, sf), BY), BY, ["bias"])


@query(
    "score_zero_acc",
    f"SELECT series, grain, {r('avg(CASE WHEN (actual = 0) = (predicted < 0.5) THEN 1.0 ELSE 0.0 END)')} AS zero_accuracy FROM score_pairs GROUP BY 1, 2",
)
def score_zero_acc(spark, sf):
    return rnd(score.score_zero_accuracy(pairs(spark, sf), BY), BY, ["zero_accuracy"])


cte(
    "monthly_pairs",
    """SELECT series, month, split, ordered AS actual, avg(ordered) OVER (PARTITION BY series, split ORDER BY month ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING) AS predicted
FROM monthly_split""",
)


def monthly_pairs(spark, sf):
    """Mean of the three months before as prediction, on train and test months."""
    frame = inp.MONTHLY_SPLIT.frame(-3, -1)
    rows = inp.monthly_with_split(spark, sf)
    return rows.select("series", "month", "split", F.col("ordered").alias("actual"), F.avg("ordered").over(frame).alias("predicted"))


_RMSE_TEST = "sqrt(avg(CASE WHEN split = 'test' THEN (actual - predicted) ** 2 END))"


@query(
    "score_rmse_pct",
    f"""SELECT series, {r(_RMSE_TEST + " / nullif(avg(CASE WHEN split = 'train' THEN actual END), 0) * 100")} AS of_train,
  {r(_RMSE_TEST + " / nullif(avg(CASE WHEN split = 'test' THEN actual END), 0) * 100")} AS of_test FROM monthly_pairs GROUP BY 1""",
)
def score_rmse_pct(spark, sf):
    rows = monthly_pairs(spark, sf)
    of = lambda base: score.score_rmse_pct(rows, ["series"], base).withColumnRenamed("rmse_pct", f"of_{base}")
    return rnd(of("train").join(of("test"), "series"), ["series"], ["of_train", "of_test"])


@query("score_mse", f"SELECT series, grain, {r('avg((actual - predicted) ** 2)')} AS mse FROM score_pairs GROUP BY 1, 2")
def score_mse(spark, sf):
    return rnd(score.score_mse(pairs(spark, sf), BY), BY, ["mse"])


cte(
    "split_one",
    f"""SELECT series, split, sqrt(avg((actual - predicted) ** 2)) AS rmse, {_R2_DET} AS r2, {_MAPE} AS mape
FROM monthly_pairs WHERE predicted IS NOT NULL GROUP BY 1, 2""",
)
cte(
    "split_scores",
    "SELECT series, "
    + ", ".join(
        f"{r(f'max({m}) FILTER (split = {chr(39)}{s}{chr(39)})')} AS {s}_{m}" for s in ("train", "test") for m in ("rmse", "r2", "mape")
    )
    + " FROM split_one GROUP BY 1",
)


@query(
    "score_train_test",
    "SELECT * FROM split_scores",
)
def score_train_test(spark, sf):
    out = score.score_train_test(monthly_pairs(spark, sf).where("predicted IS NOT NULL"), ["series"])
    return rnd(out, ["series"], [f"{s}_{m}" for s in ("train", "test") for m in ("rmse", "r2", "mape")])


@query(
    "row_errors",
    f"""SELECT series, grain, date, abs(actual - predicted) AS abs_error, {r('abs((actual - predicted) / nullif(actual, 0)) * 100')} AS pct_error,
  actual - predicted AS residual FROM score_pairs""",
)
def row_errors(spark, sf):
    out = score.row_errors(pairs(spark, sf))
    return out.select("series", "grain", "date", "abs_error", F.round("pct_error", 6).alias("pct_error"), "residual")


_RES = {
    "mean": "avg(residual)",
    "std": "stddev_samp(residual)",
    "min": "min(residual)",
    "q25": "quantile_cont(residual, 0.25)",
    "q50": "quantile_cont(residual, 0.5)",
    "q75": "quantile_cont(residual, 0.75)",
    "max": "max(residual)",
}


@query(
    "residual_stats",
    f'SELECT grain, count(*) AS "count", {cols(_RES)} FROM (SELECT grain, actual - predicted AS residual FROM score_pairs) GROUP BY 1',
)
def residual_stats(spark, sf):
    out = report.describe(cut_lineage(score.row_errors(pairs(spark, sf))), ["grain"], "residual")
    return rnd(out, ["grain", "count"], _RES)


def _interval_sql(fit: str) -> str:
    return f"""SELECT m.series, m.month, m.split, {cols({'predicted': 'predicted', 'lower': 'predicted - 1.96 * sd', 'upper': 'predicted + 1.96 * sd', 'half_width': '1.96 * sd'})}
FROM monthly_pairs m LEFT JOIN (SELECT series, stddev_pop(actual - predicted) AS sd FROM monthly_pairs WHERE split = '{fit}' GROUP BY 1) s
ON m.series = s.series"""


@query("interval_const", _interval_sql("train"))
def interval_const(spark, sf):
    out = score.interval_const(monthly_pairs(spark, sf), ["series"], "train")
    return rnd(out, ["series", "month", "split"], ["predicted", "lower", "upper", "half_width"])


@query("interval_test", _interval_sql("test"))
def interval_test(spark, sf):
    out = score.interval_const(monthly_pairs(spark, sf), ["series"], "test")
    return rnd(out, ["series", "month", "split"], ["predicted", "lower", "upper", "half_width"])


_STATS = {
    "mean_demand": "avg(CASE WHEN split = 'train' THEN ordered END)",
    "demand_cv": "CASE WHEN avg(CASE WHEN split = 'train' THEN ordered END) > 0 THEN stddev_samp(CASE WHEN split = 'train' THEN ordered END) / avg(CASE WHEN split = 'train' THEN ordered END) END",
    "test_mean": "avg(CASE WHEN split = 'test' THEN ordered END)",
    "test_std": "stddev_samp(CASE WHEN split = 'test' THEN ordered END)",
}


@query(
    "model_series_stats",
    f"SELECT series, count(*) FILTER (split = 'train') AS n_train, count(*) FILTER (split = 'test') AS n_test, {cols(_STATS)} FROM monthly_split GROUP BY 1",
)
def model_series_stats(spark, sf):
    out = score.series_stats(inp.monthly_with_split(spark, sf), ["series"], "ordered")
    return rnd(out, ["series", "n_train", "n_test"], _STATS)


# --- choices given predictions and scores ------------------------------------------------------


@query("clamp_nonneg", "SELECT series, date, greatest(2 * predicted - actual, 0.0) AS predicted FROM weekly_model WHERE predicted IS NOT NULL")
def clamp_nonneg(spark, sf):
    """An extrapolated prediction that can go below zero, clamped."""
    from seriesloom.functions.numeric import clamp_nonneg as clamp
    from seriesloom.plans.cat_panel import model_table

    rows = model_table(spark, sf, 7).where("predicted IS NOT NULL")
    return rows.select("series", "date", clamp(F.lit(2.0) * F.col("predicted") - F.col("actual")).alias("predicted"))


@query(
    "ensemble_mean",
    "SELECT series, date, actual, (naive + weekly) / 2 AS predicted FROM two_models",
)
def ensemble_mean(spark, sf):
    from seriesloom.operators.models import ensemble_mean as mean_of
    from seriesloom.plans.cat_panel import model_table

    return mean_of(model_table(spark, sf, 1), model_table(spark, sf, 7), ["series", "date"])


cte(
    "model_scores",
    "\nUNION ALL ".join(
        f"SELECT series, '{m}' AS model, sqrt(avg((actual - {c}) ** 2)) AS rmse, (covar_samp(actual, {c}) / nullif(stddev_samp(CASE WHEN {c} IS NOT NULL THEN actual END) * stddev_samp({c}), 0)) ** 2 AS r2 FROM two_models GROUP BY 1"
        for m, c in (("naive", "naive"), ("weekly", "weekly"), ("croston", "monthly"))
    ),
)


@query(
    "best_model",
    f"""SELECT series, model AS best_model, {r('rmse')} AS rmse, {r('r2')} AS r2 FROM (SELECT *, row_number() OVER (PARTITION BY series ORDER BY rmse, model) AS k
FROM model_scores WHERE model <> 'croston' AND rmse IS NOT NULL) WHERE k = 1""",
)
def best_model(spark, sf):
    """Two candidate forecasts and one that is scored under a name never chosen."""
    from seriesloom.operators.models import best_model as choose
    from seriesloom.plans.cat_panel import model_table

    frames = [
        score.score_main(model_table(spark, sf, k).where("predicted IS NOT NULL"), ["series"]).withColumn("model", F.lit(m))
        for m, k in (("naive", 1), ("weekly", 7), ("croston", 30))
    ]
    return rnd(choose(align.stack(frames)), ["series", "best_model"], ["rmse", "r2"])
