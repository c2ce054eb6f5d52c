"""Registered queries: filters, splits, guards, joins and alignment."""

from __future__ import annotations

from pyspark.sql import functions as F

from seriesloom.functions import calendar as cal
from seriesloom.functions import text
from seriesloom.operators import align, report, score, split
from seriesloom.plans import inputs as inp
from seriesloom.plans import naive
from seriesloom.plans.registry import cols, cte, query, r
from seriesloom.session import cut_lineage, scratch_path
from seriesloom.sources import ledger, sinks, tables

IND = text.INDICATORS
BOTH = {"dispatched": "dispatched", "ordered": "ordered"}


# --- filters and splits -----------------------------------------------------------------


@query("filter_since", "SELECT * FROM daily WHERE date >= DATE '1999-01-01'")
def filter_since(spark, sf):
    return split.since(inp.daily(spark, sf), "date", "1999-01-01")


@query(
    "filter_series",
    "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_partkey = 7",
)
def filter_series(spark, sf):
    """One material's lines; the predicate reaches the scan."""
    lines = tables.table(spark, sf, "lineitem")
    return lines.where(F.col("l_partkey") == 7).select("l_orderkey", "l_linenumber", "l_quantity")


@query("filter_range", "SELECT * FROM daily WHERE date BETWEEN DATE '1998-03-01' AND DATE '1998-09-30'")
def filter_range(spark, sf):
    return split.between(inp.daily(spark, sf), "date", "1998-03-01", "1998-09-30")


@query(
    "split_cutoffs",
    f"""SELECT series, date, CASE WHEN date < DATE '{inp.VAL}' THEN 'train' WHEN date < DATE '{inp.TEST}' THEN 'val' ELSE 'test' END AS split
FROM daily""",
)
def split_cutoffs(spark, sf):
    return inp.daily(spark, sf).select("series", "date", split.cutoff_split(F.col("date"), inp.TEST).alias("split"))


@query(
    "split_two_window",
    """SELECT series, date, CASE WHEN date <= DATE '1999-12-31' THEN 'train' WHEN date <= DATE '2000-12-31' THEN 'test' END AS split
FROM daily""",
)
def split_two_window(spark, sf):
    s = split.two_window_split(F.col("date"), "1999-12-31", "2000-12-31")
    return inp.daily(spark, sf).select("series", "date", s.alias("split"))


@query(
    "split_gap",
    """SELECT series, date, CASE WHEN date < DATE '2000-11-01' THEN 'train' WHEN date < DATE '2000-12-01' THEN 'val'
  WHEN date >= DATE '2001-01-01' THEN 'test' END AS split FROM daily""",
)
def split_gap(spark, sf):
    return inp.daily(spark, sf).select("series", "date", split.gap_split(F.col("date"), "2000-12-01").alias("split"))


@query(
    "split_fraction_pos",
    """SELECT series, date, CASE WHEN row_number() OVER (PARTITION BY series ORDER BY date)
  <= floor(count(*) OVER (PARTITION BY series) * 0.8::DOUBLE) THEN 'train' ELSE 'test' END AS split FROM daily_lumpy""",
)
def split_fraction_pos(spark, sf):
    return split.fraction_split(inp.daily_lumpy(spark, sf), inp.SPEC).select("series", "date", "split")


@query(
    "split_fraction_date",
    """SELECT series, date, unnest(CASE WHEN rn < cut THEN ['train'] WHEN rn = cut THEN ['train', 'test'] ELSE ['test'] END) AS split
FROM (SELECT series, date, row_number() OVER (PARTITION BY series ORDER BY date) AS rn,
  floor(count(*) OVER (PARTITION BY series) * 0.8::DOUBLE) + 1 AS cut FROM daily_lumpy)""",
)
def split_fraction_date(spark, sf):
    return split.fraction_date_split(inp.daily_lumpy(spark, sf), inp.SPEC).select("series", "date", "split")


@query("split_last_n", "SELECT series, month, split FROM monthly_split")
def split_last_n(spark, sf):
    return inp.monthly_with_split(spark, sf).select("series", "month", "split")


@query(
    "split_calendar",
    """SELECT series, month, CASE WHEN month <= DATE '1999-12-31' THEN 'train'
  WHEN month BETWEEN DATE '2000-01-01' AND DATE '2000-11-30' THEN 'test' END AS split FROM monthly""",
)
def split_calendar(spark, sf):
    s = split.calendar_split(F.col("month"), "1999-12-31", "2000-01-01", "2000-11-30")
    return inp.monthly(spark, sf).select("series", "month", s.alias("split"))


cte(
    "events_daily",
    "SELECT event_type AS series, CAST(ts AS DATE) AS date, CAST(count(*) AS DOUBLE) AS dispatched FROM events GROUP BY 1, 2",
)
cte(
    "all_series",
    """SELECT series, date, dispatched FROM events_daily UNION ALL SELECT series, date, dispatched FROM daily_lumpy""",
)


def all_series(spark, sf):
    """Long and short series together, so that the minimum-history guard has both to decide on."""
    columns = ["series", "date", "dispatched"]
    return align.stack([tables.short_series(spark, sf).select(*columns), inp.daily_lumpy(spark, sf).select(*columns)])


@query(
    "guard_history",
    """SELECT series, count(*) AS n FROM all_series WHERE series IN (SELECT series FROM all_series GROUP BY 1 HAVING count(*) >= 60)
GROUP BY 1""",
)
def guard_history(spark, sf):
    kept = split.guard_history(all_series(spark, sf), ["series"], 60)
    return kept.groupBy("series").agg(F.count(F.lit(1)).alias("n"))


@query(
    "drop_nulls",
    """SELECT series, month, lag12, ICI FROM (SELECT m.series, m.month, lag(dispatched, 12) OVER (PARTITION BY m.series ORDER BY m.month) AS lag12,
  round(e.ICI, 6) AS ICI FROM monthly m LEFT JOIN ext e ON m.month = e.month) WHERE lag12 IS NOT NULL AND ICI IS NOT NULL""",
)
def drop_nulls(spark, sf):
    joined = align.join_month(inp.monthly(spark, sf), inp.external(spark, sf))
    wide = joined.select(
        "series", "month", F.lag("dispatched", 12).over(inp.MONTHLY.window()).alias("lag12"), F.round("ICI", 6).alias("ICI")
    )
    return split.drop_nulls(wide, ["lag12", "ICI"])


@query(
    "semi_filter",
    "SELECT * FROM daily WHERE date IN (SELECT CAST(o_orderdate AS DATE) FROM orders WHERE o_orderpriority = '1-URGENT')",
)
def semi_filter(spark, sf):
    urgent = tables.table(spark, sf, "orders").where("o_orderpriority = '1-URGENT'")
    return split.in_dates(inp.daily(spark, sf), urgent.select(F.col("o_orderdate").cast("date").alias("date")))


# --- joins and alignment ----------------------------------------------------------------


def _ext(prefix: str = "e.") -> str:
    return ", ".join(f"{r(prefix + c)} AS {c}" for c in IND)


def rounded_ext(df, *keep):
    return df.select(*keep, *[F.round(c, 6).alias(c) for c in IND])


@query(
    "join_year_month",
    f"""SELECT d.series, d.date, d.dispatched, {_ext()} FROM daily d
LEFT JOIN ext e ON year(d.date) = year(e.month) AND month(d.date) = month(e.month)""",
)
def join_year_month(spark, sf):
    joined = align.join_year_month(inp.daily(spark, sf), inp.external(spark, sf))
    return rounded_ext(joined, "series", "date", "dispatched")


@query(
    "join_month_key",
    f"SELECT m.series, m.month, m.dispatched, m.ordered, {_ext()} FROM monthly m LEFT JOIN ext e ON m.month = e.month",
)
def join_month_key(spark, sf):
    joined = align.join_month(inp.monthly(spark, sf), inp.external(spark, sf))
    return rounded_ext(joined, "series", "month", "dispatched", "ordered")


@query("gap_fill", "SELECT series, date, dispatched, ordered FROM filled_lumpy")
def gap_fill(spark, sf):
    return inp.filled_lumpy(spark, sf).drop("split")


cte(
    "ext_sparse",
    "SELECT month, CASE WHEN month(month) IN (3, 7) THEN NULL ELSE ECG_DESP END AS ECG_DESP, ICI FROM ext WHERE month(month) <> 11",
)


def ext_sparse(spark, sf):
    """The indicator table with a missing month and missing values, to exercise the carrying rules."""
    ext = inp.external(spark, sf).where(F.month("month") != 11)
    return ext.select(
        "month", F.when(~F.month("month").isin(3, 7), F.col("ECG_DESP")).alias("ECG_DESP"), "ICI"
    )


@query(
    "asof_month_limit",
    f"""SELECT f.series, f.date, f.dispatched,
  {r('(SELECT arg_max(e.ECG_DESP, e.month) FROM ext_sparse e WHERE e.ECG_DESP IS NOT NULL AND f.date - e.month BETWEEN 0 AND 30)')} AS ECG_DESP,
  {r('(SELECT arg_max(e.ICI, e.month) FROM ext_sparse e WHERE e.ICI IS NOT NULL AND f.date - e.month BETWEEN 0 AND 30)')} AS ICI
FROM filled f""",
)
def asof_month_limit(spark, sf):
    by_day = align.month_to_days(ext_sparse(spark, sf), ["ECG_DESP", "ICI"])
    joined = align.join_days(inp.filled(spark, sf), by_day)
    return joined.select("series", "date", "dispatched", *[F.round(c, 6).alias(c) for c in ("ECG_DESP", "ICI")])


@query(
    "asof_month",
    f"""SELECT f.series, f.date, f.dispatched, {r('a.ECG_DESP')} AS ECG_DESP, {r('b.ICI')} AS ICI FROM filled f
ASOF LEFT JOIN (SELECT month, ECG_DESP FROM ext_sparse WHERE ECG_DESP IS NOT NULL) a ON f.date >= a.month
ASOF LEFT JOIN (SELECT month, ICI FROM ext_sparse WHERE ICI IS NOT NULL) b ON f.date >= b.month""",
)
def asof_month(spark, sf):
    joined = align.asof_month(inp.filled(spark, sf), ext_sparse(spark, sf), ["ECG_DESP", "ICI"], inp.last_day(spark, sf))
    return joined.select("series", "date", "dispatched", *[F.round(c, 6).alias(c) for c in ("ECG_DESP", "ICI")])


cte("ext_late", "SELECT month, ECG_DESP, ICI FROM ext WHERE month >= DATE '1995-06-01'")


@query(
    "asof_mean_fill",
    f"""SELECT series, date, {r('coalesce(ECG_DESP, avg(ECG_DESP) OVER (PARTITION BY series))')} AS ECG_DESP,
  {r('coalesce(ICI, avg(ICI) OVER (PARTITION BY series))')} AS ICI
FROM (SELECT f.series, f.date, e.ECG_DESP, e.ICI FROM filled f ASOF LEFT JOIN ext_late e ON f.date >= e.month)""",
)
def asof_mean_fill(spark, sf):
    late = inp.external(spark, sf).where("month >= DATE '1995-06-01'")
    full = align.asof_mean_fill(
        inp.filled(spark, sf).drop("split"), late, ["ECG_DESP", "ICI"], inp.last_day(spark, sf), inp.SPEC
    )
    return full.select("series", "date", *[F.round(c, 6).alias(c) for c in ("ECG_DESP", "ICI")])


@query(
    "asof_week_lag",
    f"""SELECT f.series, f.date, {cols({f'Demand_lag_{k}w': f'w.k{k}' for k in (1, 2, 4, 8, 12)})}
FROM (SELECT series, date, dispatched FROM filled) f ASOF LEFT JOIN (
  SELECT series, week, {', '.join(f'lag(m, {k}) OVER (PARTITION BY series ORDER BY week) AS k{k}' for k in (1, 2, 4, 8, 12))}
  FROM (SELECT series, CAST(date_trunc('week', date) AS DATE) + 6 AS week, avg(prev) AS m FROM (
    SELECT series, date, lag(dispatched) OVER (PARTITION BY series ORDER BY date) AS prev FROM filled) GROUP BY 1, 2)
) w ON f.series = w.series AND f.date >= w.week""",
)
def asof_week_lag(spark, sf):
    lags = [1, 2, 4, 8, 12]
    panel = inp.filled(spark, sf).drop("split", "ordered")
    wide = align.asof_week_lag(panel, inp.SPEC, lags, cal.week_ending_sunday(F.col("date")), "Demand_lag")
    return wide.select("series", "date", *[F.round(f"Demand_lag_{k}w", 6).alias(f"Demand_lag_{k}w") for k in lags])


cte(
    "two_models",
    f"""
SELECT series, date, split, dispatched AS actual, lag(dispatched, 1) OVER w AS naive, lag(dispatched, 7) OVER w AS weekly,
  lag(dispatched, 30) OVER w AS monthly FROM filled_lumpy WHERE split = 'test' WINDOW w AS (PARTITION BY series ORDER BY date)
""",
)


def test_slice(spark, sf):
    return inp.filled_lumpy(spark, sf).where(F.col("split") == "test")


def model_table(spark, sf, k: int):
    """Predictions of the seasonal-naive model with period k on the test slice."""
    value = F.lag("dispatched", k).over(inp.SPEC.window())
    return test_slice(spark, sf).select("series", "date", F.col("dispatched").alias("actual"), value.alias("predicted"))


@query("align_pred", "SELECT series, date, actual, naive AS predicted FROM two_models")
def align_pred(spark, sf):
    actual = test_slice(spark, sf).select("series", "date", F.col("dispatched").alias("actual"))
    return align.align_predictions(actual, model_table(spark, sf, 1).drop("actual"), inp.SPEC)


CONFIGS = "(VALUES (0, 100), (1, 150), (2, 100), (3, 1000)) c(config, trees)"


@query(
    "lookup_cluster",
    f"""SELECT l.series, l.cluster, c.config, c.trees FROM (
  SELECT series, CASE WHEN demand_cv > 1 THEN 7 ELSE cluster END AS cluster FROM labelled) l
JOIN {CONFIGS} ON c.config = CASE WHEN l.cluster BETWEEN 0 AND 3 THEN l.cluster ELSE 3 END""",
)
def lookup_cluster(spark, sf):
    from seriesloom.operators.models import FINISHED

    configs = spark.createDataFrame([(k, v.trees) for k, v in FINISHED.items()], "config int, trees int")
    rows = inp.labelled(spark, sf).select(
        "series", F.when(F.col("demand_cv") > 1, 7).otherwise(F.col("cluster")).alias("cluster")
    )
    return align.lookup_config(rows, configs)


cte(
    "cluster_file",
    "SELECT lpad(series, 9, '0') AS id, cluster FROM labelled WHERE order_fulfillment < 1.05",
)


def cluster_file(spark, sf):
    """Assignments keyed by padded ids; series that shipped more than was ordered in the period are not in it."""
    rows = inp.labelled(spark, sf).where("order_fulfillment < 1.05")
    return rows.select(text.pad_id(F.col("series")).alias("id"), "cluster")


@query(
    "join_cluster",
    """SELECT p.p_partkey, c.cluster FROM part p LEFT JOIN cluster_file c
ON regexp_replace(CAST(p.p_partkey AS VARCHAR), '^0+', '') = regexp_replace(c.id, '^0+', '')""",
)
def join_cluster(spark, sf):
    parts = tables.table(spark, sf, "part").select("p_partkey")
    return align.join_cluster(parts, cluster_file(spark, sf), text.strip_id(F.col("p_partkey")))


@query(
    "cluster_members",
    """SELECT series, month, dispatched FROM parts_monthly WHERE series IN (SELECT series FROM labelled WHERE cluster = 2)""",
)
def cluster_members(spark, sf):
    rows = inp.parts_monthly(spark, sf).select("series", "month", "dispatched")
    return align.cluster_members(rows, inp.labelled(spark, sf), 2)


@query(
    "compare_columns",
    f"""SELECT metric, {r("max(value) FILTER (series = 'Brand#1|SMALL')")} AS "Brand#1|SMALL",
  {r("max(value) FILTER (series = 'Brand#2|SMALL')")} AS "Brand#2|SMALL"
FROM scores_long WHERE grain = 'daily' AND series IN ('Brand#1|SMALL', 'Brand#2|SMALL') GROUP BY 1""",
)
def compare_columns(spark, sf):
    series = ["Brand#1|SMALL", "Brand#2|SMALL"]
    long = score.to_long(inp.naive_scores(spark, sf).where("grain = 'daily'"))
    wide = align.compare_series(long, series)
    return wide.select("metric", *[F.round(F.col(f"`{s}`"), 6).alias(s) for s in series])


@query(
    "union_splits",
    """SELECT series, month, dispatched, 'Train' AS part FROM monthly_split WHERE split = 'train'
UNION ALL SELECT series, month, dispatched, 'Test' FROM monthly_split WHERE split = 'test'""",
)
def union_splits(spark, sf):
    rows = inp.monthly_with_split(spark, sf)
    side = lambda s, name: rows.where(F.col("split") == s).select(
        F.lit(name).alias("part"), "series", "month", "dispatched"
    )
    return align.stack([side("train", "Train"), side("test", "Test").select("series", "month", "dispatched", "part")])


# --- whole-batch control -----------------------------------------------------------------


@query(
    "all_series",
    f"""SELECT series, {cols({m: m for m in ('rmse', 'mae', 'mape', 'r2')})} FROM naive_scores WHERE grain = 'daily'""",
)
def all_series_plan(spark, sf):
    """Every series scored by one keyed plan, without a loop."""
    scores = inp.naive_scores(spark, sf).where("grain = 'daily'")
    return scores.select("series", *[F.round(m, 6).alias(m) for m in ("rmse", "mae", "mape", "r2")])


@query(
    "isolate_errors",
    f"""SELECT series, n_train, n_test, CASE WHEN n_train < 60 THEN 'insufficient training data' WHEN n_test < 1 THEN 'no test data' END AS error,
  NOT (n_train < 60 OR n_test < 1) AS success FROM (
SELECT series, count(*) FILTER (date < DATE '{inp.TEST}') AS n_train, count(*) FILTER (date >= DATE '{inp.TEST}') AS n_test
FROM all_series GROUP BY 1)""",
)
def isolate_errors(spark, sf):
    in_test = F.col("date") >= F.lit(inp.TEST).cast("date")
    return split.history_status(all_series(spark, sf), ["series"], 60, in_test)


@query(
    "run_ledger",
    f"""SELECT series, 'naive' AS stage, CASE WHEN n_train < 60 THEN 'insufficient training data' WHEN n_test < 1 THEN 'no test data' END AS error FROM (
SELECT series, count(*) FILTER (date < DATE '{inp.TEST}') AS n_train, count(*) FILTER (date >= DATE '{inp.TEST}') AS n_test
FROM all_series GROUP BY 1)""",
)
def run_ledger(spark, sf):
    """Two batches, the second one stopped by an error, and a restart that does only what is left."""
    rows = cut_lineage(all_series(spark, sf))
    in_test = F.col("date") >= F.lit(inp.TEST).cast("date")
    status = split.history_status(rows, ["series"], 60, in_test).select("series", "error")
    path, out = scratch_path(spark, "ledger"), scratch_path(spark, "forecasts")

    def forecast(batch):
        return lambda todo: sinks.write_forecast(naive.forecasts(todo.where(in_test), inp.SPEC, inp.TEST), out, batch)

    def stopped(todo):
        raise RuntimeError("lost connection")

    first = F.col("series") < "Brand#3"
    ledger.run(rows.where(first), status, path, "1", "naive", forecast("1"))
    ledger.run(rows.where(~first), status, path, "2", "naive", stopped)
    ledger.run(rows, status, path, "3", "naive", forecast("3"))
    return ledger.latest(spark, path)


@query(
    "run_status",
    f"""SELECT count(*) AS n, CAST(count(*) FILTER (ok) AS BIGINT) AS n_success, count(*) FILTER (NOT ok) AS n_failed,
  {r('count(*) FILTER (ok) * 100.0 / count(*)')} AS pct_success FROM (
SELECT series, count(*) FILTER (date < DATE '{inp.TEST}') >= 60 AND count(*) FILTER (date >= DATE '{inp.TEST}') >= 1 AS ok
FROM all_series GROUP BY 1)""",
)
def run_status(spark, sf):
    status = report.run_status(isolate_errors(spark, sf))
    return status.withColumn("pct_success", F.round("pct_success", 6))


