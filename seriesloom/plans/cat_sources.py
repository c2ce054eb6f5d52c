"""Registered queries: sources, sinks, parsing and column shaping."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from seriesloom.functions import calendar as cal
from seriesloom.functions import text
from seriesloom.operators import align, models, report, score, shape
from seriesloom.operators import window as win
from seriesloom.plans import inputs as inp
from seriesloom.plans.registry import cols, cte, query, r
from seriesloom.session import cut_lineage, scratch_path
from seriesloom.sources import files, sinks, tables

EXT = ", ".join(f"{r(c)} AS {c}" for c in text.INDICATORS)
SCORE_SCHEMA = T.StructType(
    [T.StructField("series", T.StringType()), T.StructField("n", T.LongType())]
    + [T.StructField(m, T.DoubleType()) for m in ("rmse", "mae", "mape", "r2")]
    + [T.StructField("grain", T.StringType())]
)
SCORES = {m: m for m in ("rmse", "mae", "mape", "r2")}


def number():
    return F.regexp_extract("series", r"(\d+)", 1)


def rounded_scores(df):
    return df.select("series", "grain", "n", *[F.round(m, 6).alias(m) for m in SCORES])


def order_rows(spark, sf):
    """Order rows in the layout of the source workbook."""
    return inp.daily(spark, sf).select(
        F.col("series").alias("Product ID"),
        F.concat(F.lit("Item "), number()).alias("Product Name"),
        F.date_format("date", "dd.MM.yyyy").alias("Date"),
        F.col("dispatched").alias("Dispatched Quantity"),
        F.col("ordered").alias("Customer Order Quantity"),
    )


@query(
    "src_orders",
    "SELECT series, 'Item ' || regexp_extract(series, '(\\d+)', 1) AS series_name, date, dispatched, ordered FROM daily",
)
def src_orders(spark, sf):
    path = scratch_path(spark, "orders")
    order_rows(spark, sf).write.csv(path, header=True)
    return files.read_orders(spark, path)


@query("src_external", f"SELECT month, {EXT} FROM ext")
def src_external(spark, sf):
    path = scratch_path(spark, "external")
    ext = inp.external(spark, sf)
    ext.select(F.lower(F.date_format("month", "MMM-yy")).alias("DATE"), *text.INDICATORS).write.csv(path, header=True)
    back = files.read_external(spark, path)
    return back.select("month", *[F.round(c, 6).alias(c) for c in text.INDICATORS])


def monthly_files(spark, sf):
    """Monthly rows written as one folder of CSV per series, with a combined copy to be skipped."""
    path = scratch_path(spark, "series")
    rows = inp.monthly(spark, sf).select(
        F.col("month").alias("YearMonth"),
        F.col("series").alias("Product ID"),
        F.concat(F.lit("Item "), number()).alias("Product Name"),
        F.col("dispatched").alias("Dispatched Quantity"),
        F.col("ordered").alias("Customer Order Quantity"),
        F.concat(F.lpad(number(), 9, "0"), F.lit("_item")).alias("stem"),
    )
    both = rows.withColumn("stem", F.explode(F.array(F.col("stem"), F.lit("combined_data"))))
    return sinks.write_series_dir(both, path)


@query(
    "src_series_dir",
    """SELECT series, month, dispatched, ordered, lpad(regexp_extract(series, '(\\d+)', 1), 9, '0') || '_item' AS stem FROM monthly""",
)
def src_series_dir(spark, sf):
    rows = files.read_series_dir(spark, monthly_files(spark, sf), files.MONTHLY_SCHEMA)
    return rows.select(
        F.col("Product ID").alias("series"),
        F.col("YearMonth").alias("month"),
        F.col("Dispatched Quantity").alias("dispatched"),
        F.col("Customer Order Quantity").alias("ordered"),
        "stem",
    )


@query(
    "src_series_by_prefix",
    """SELECT regexp_extract(series, '(\\d+)', 1) AS id, month, ordered FROM monthly""",
)
def src_series_by_prefix(spark, sf):
    number = F.regexp_extract("p_brand", r"(\d+)", 1)
    ids = tables.table(spark, sf, "part").select(number.alias("id")).distinct()
    rows = files.read_series_by_prefix(spark, monthly_files(spark, sf), files.MONTHLY_SCHEMA, ids)
    return rows.select("id", F.col("YearMonth").alias("month"), F.col("Customer Order Quantity").alias("ordered"))


@query("src_monthly", "SELECT series, month, ordered AS Demand FROM monthly")
def src_monthly(spark, sf):
    path = scratch_path(spark, "monthly")
    rows = inp.monthly(spark, sf).select(
        F.col("month").alias("YearMonth"),
        F.col("series").alias("Product ID"),
        F.col("series").alias("Product Name"),
        F.col("dispatched").alias("Dispatched Quantity"),
        F.col("ordered").alias("Customer Order Quantity"),
    )
    return files.read_monthly(spark, sinks.write_merged(rows, path, "csv"))


@query("src_results", f"SELECT series, grain, n, {cols(SCORES)} FROM naive_scores")
def src_results(spark, sf):
    path = scratch_path(spark, "scores")
    scores = inp.naive_scores(spark, sf).select(*SCORE_SCHEMA.names)
    return rounded_scores(files.read_results(spark, sinks.write_merged(scores, path, "csv"), SCORE_SCHEMA))


def in_batches(df, write):
    """Two batches of series with the same grains; the first one is written twice, as after a stop."""
    half = F.pmod(F.xxhash64("series"), F.lit(2))
    for name in (0, 1, 0):
        write(df.where(half == name), f"half-{name}")


@query("sink_forecast", "SELECT series, grain, date, actual, predicted FROM naive_pairs")
def sink_forecast(spark, sf):
    path = scratch_path(spark, "forecast")
    in_batches(inp.naive_pairs(spark, sf), lambda rows, name: sinks.write_forecast(rows, path, name))
    return sinks.read_batches(spark, path)


@query("sink_scores", f"SELECT series, grain, n, {cols(SCORES)} FROM naive_scores")
def sink_scores(spark, sf):
    path = scratch_path(spark, "scores")
    in_batches(inp.naive_score_table(spark, sf), lambda rows, name: sinks.write_scores(rows, path, name))
    return rounded_scores(sinks.read_batches(spark, path))


@query("sink_clusters", "SELECT series, cluster FROM labelled")
def sink_clusters(spark, sf):
    path = scratch_path(spark, "clusters")
    in_batches(inp.labelled(spark, sf).select("series", "cluster"), lambda rows, name: sinks.write_clusters(rows, path, name))
    return sinks.read_batches(spark, path, "csv", "series string, cluster int")


MERGED = "SELECT m.series, m.month, dispatched, ordered, " + ", ".join(f"{r('e.' + c)} AS {c}" for c in text.INDICATORS)


@query("sink_merged", MERGED + " FROM monthly m LEFT JOIN ext e ON m.month = e.month")
def sink_merged(spark, sf):
    merged = align.join_month(inp.monthly(spark, sf), inp.external(spark, sf))
    path = sinks.write_merged(merged, scratch_path(spark, "merged"))
    return spark.read.parquet(path).select(
        "series", "month", "dispatched", "ordered", *[F.round(c, 6).alias(c) for c in text.INDICATORS]
    )


@query(
    "sink_multi",
    f"""SELECT 'scores' AS part, series, grain AS label, {r('rmse')} AS value FROM naive_scores UNION ALL
SELECT 'pairs', series, grain || ' ' || date, {r('actual')} FROM naive_pairs UNION ALL SELECT 'clusters', series, CAST(cluster AS VARCHAR), NULL FROM labelled""",
)
def sink_multi(spark, sf):
    made = sinks.write_multi(
        {
            "scores": inp.naive_scores(spark, sf),
            "pairs": inp.naive_pairs(spark, sf),
            "clusters": inp.labelled(spark, sf).select("series", "cluster"),
        },
        scratch_path(spark, "multi"),
    )
    shown = {
        "scores": (F.col("grain"), F.round("rmse", 6)),
        "pairs": (F.concat_ws(" ", "grain", "date"), F.round("actual", 6)),
        "clusters": (F.col("cluster").cast("string"), F.lit(None).cast("double")),
    }
    return align.stack(
        [
            spark.read.parquet(path).select(F.lit(name).alias("part"), "series", shown[name][0].alias("label"), shown[name][1].alias("value"))
            for name, path in made.items()
        ]
    )


@query(
    "sink_params",
    """SELECT series, CASE WHEN avg(CASE WHEN ordered = 0 THEN 1.0 ELSE 0.0 END) > 0.7 THEN 'sparse' ELSE 'dense' END AS config,
  CASE WHEN avg(CASE WHEN ordered = 0 THEN 1.0 ELSE 0.0 END) > 0.7 THEN '300' ELSE '200' END AS trees
FROM filled_lumpy GROUP BY 1""",
)
def sink_params(spark, sf):
    config = models.sparse_config(F.col("sparsity"))
    trees = F.when(config == "sparse", str(models.SPARSE.trees)).otherwise(str(models.DENSE.trees))
    params = report.sparsity(inp.filled_lumpy(spark, sf), ["series"]).select(
        "series", F.create_map(F.lit("config"), config, F.lit("trees"), trees).alias("params")
    )
    path = scratch_path(spark, "params")
    in_batches(params, lambda rows, name: sinks.write_params(rows, path, name))
    back = sinks.read_batches(spark, path, "json", "series string, params map<string,string>")
    return back.select("series", F.col("params")["config"].alias("config"), F.col("params")["trees"].alias("trees"))


@query(
    "sink_summary",
    f"""SELECT s.series, l.cluster, s.grain, s.metric, {r('s.value')} AS value FROM scores_long s
LEFT JOIN scores_labelled l ON s.series = l.series""",
)
def sink_summary(spark, sf):
    labels, path = cut_lineage(inp.scores_labelled(spark, sf)), scratch_path(spark, "summary")
    scores = inp.naive_score_table(spark, sf).drop("n")
    in_batches(scores, lambda rows, name: sinks.write_summary(rows, labels, path, name))
    rows = sinks.read_batches(spark, path)
    return rows.select("series", "cluster", "grain", "metric", F.round("value", 6).alias("value"))


# --- parsing and shaping ---------------------------------------------------------------


@query("parse_dmy", "SELECT series, strftime(date, '%d.%m.%Y') AS text, date FROM daily")
def parse_dmy(spark, sf):
    rows = inp.daily(spark, sf).select("series", F.date_format("date", "dd.MM.yyyy").alias("text"))
    return rows.withColumn("date", cal.parse_dmy(F.col("text")))


@query(
    "parse_ymd_parts",
    "SELECT o_orderkey, CAST(o_orderdate AS DATE) AS date FROM orders",
)
def parse_ymd_parts(spark, sf):
    d = F.col("o_orderdate")
    parts = tables.table(spark, sf, "orders").select(
        "o_orderkey", F.year(d).alias("Year"), F.month(d).alias("Month"), F.dayofmonth(d).alias("Day")
    )
    return parts.select("o_orderkey", cal.parse_parts(F.col("Year"), F.col("Month"), F.col("Day")).alias("date"))


@query(
    "parse_mon_yy",
    """SELECT DISTINCT lower(strftime(o_orderdate, '%b-%y')) AS text, CAST(date_trunc('month', o_orderdate) AS DATE) AS month FROM orders
UNION SELECT DISTINCT upper(strftime(o_orderdate, '%b-%y')), CAST(date_trunc('month', o_orderdate) AS DATE) FROM orders""",
)
def parse_mon_yy(spark, sf):
    shown = F.date_format("o_orderdate", "MMM-yy")
    rows = tables.table(spark, sf, "orders").select(F.explode(F.array(F.lower(shown), F.upper(shown))).alias("text"))
    return rows.distinct().withColumn("month", cal.parse_mon_yy(F.col("text")))


@query(
    "month_key",
    "SELECT series, strftime(date, '%Y-%m') AS month_key, count(*) AS n_days FROM daily GROUP BY 1, 2",
)
def month_key(spark, sf):
    rows = inp.daily(spark, sf)
    return rows.groupBy("series", cal.month_key(F.col("date")).alias("month_key")).agg(
        F.count(F.lit(1)).alias("n_days")
    )


@query(
    "cast_double",
    """SELECT event_id, TRY_CAST(regexp_extract(props, '(\\d+)', 1) AS DOUBLE) AS k, TRY_CAST(event_type AS DOUBLE) AS kind,
  CAST(value AS DOUBLE) AS value FROM events""",
)
def cast_double(spark, sf):
    rows = tables.table(spark, sf, "events").select(
        "event_id",
        F.regexp_extract("props", r"(\d+)", 1).alias("k"),
        F.col("event_type").alias("kind"),
        F.col("value").cast("string").alias("value"),
    )
    return shape.cast_double(rows, ["k", "kind", "value"])


@query("pad_id", "SELECT p_partkey, lpad(CAST(p_partkey AS VARCHAR), 9, '0') AS padded FROM part")
def pad_id(spark, sf):
    return tables.table(spark, sf, "part").select("p_partkey", text.pad_id(F.col("p_partkey")).alias("padded"))


@query(
    "strip_id",
    "SELECT p_partkey, regexp_replace(lpad(CAST(p_partkey AS VARCHAR), 9, '0'), '^0+', '') AS clean_id FROM part",
)
def strip_id(spark, sf):
    padded = tables.table(spark, sf, "part").select("p_partkey", text.pad_id(F.col("p_partkey")).alias("padded"))
    return padded.select("p_partkey", text.strip_id(F.col("padded")).alias("clean_id"))


@query(
    "rename_drop",
    "SELECT series AS \"Product ID\", date, dispatched AS Demand, 'unit' AS source FROM daily",
)
def rename_drop(spark, sf):
    return shape.rename_drop(
        inp.daily(spark, sf), {"series": "Product ID", "dispatched": "Demand"}, ["ordered"], {"source": "unit"}
    )


@query(
    "select_features",
    f"""SELECT series, month, Demand_lag_1, {r('Demand_roll_mean_3')} AS Demand_roll_mean_3, ECG_DESP FROM (
SELECT m.series, m.month, e.ECG_DESP, lag(dispatched) OVER w AS Demand_lag_1,
  avg(dispatched) OVER (PARTITION BY m.series ORDER BY m.month ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING) AS Demand_roll_mean_3
FROM monthly m LEFT JOIN ext e ON m.month = e.month WINDOW w AS (PARTITION BY m.series ORDER BY m.month))""",
)
def select_features(spark, sf):
    joined = align.join_month(inp.monthly(spark, sf), inp.external(spark, sf))
    d = F.col("dispatched")
    wide = win.add(joined, win.lags(d, inp.MONTHLY, (1,), "Demand"), win.roll_past(d, inp.MONTHLY, (3,), "Demand"))
    chosen = shape.select_features(
        wide, ["series", "month"], prefixes=("Demand_",), contains=("ECG",), exclude=("Demand_roll_std_3",)
    )
    return chosen.withColumn("Demand_roll_mean_3", F.round("Demand_roll_mean_3", 6))


@query("select_numeric", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def select_numeric(spark, sf):
    orders = tables.table(spark, sf, "orders")
    return orders.select(*shape.numeric_columns(orders))


def _log_text():
    """Score block of a run built from a series' scores; the daily MAPE of some is missing."""
    parts = []
    for grain in text.LOG_GRAINS:
        g = grain.lower()
        shown = {m: F.format_string("%.6f", F.col(f"{g}_{m.lower()}")) for m in text.LOG_METRICS}
        lines = [
            F.lit(f"{grain} Metrics:\n"),
            *[
                F.concat(F.lit(head), F.coalesce(shown[m], F.lit("nan")), F.lit(tail))
                for m, head, tail in (
                    ("RMSE", "RMSE: ", "\n"),
                    ("MAE", "MAE: ", "\n"),
                    ("MAPE", "MAPE: ", "%\n"),
                    ("R2", "R2 (correlation squared): ", "\n"),
                )
            ],
        ]
        parts.append(F.concat(*lines))
    marks = [
        F.concat(
            F.lit(f"{g.upper()}_R2="), F.coalesce(F.format_string("%.6f", F.col(f"{g.lower()}_r2")), F.lit("N/A")), F.lit("\n")
        )
        for g in text.LOG_GRAINS
    ]
    return F.concat(*parts, F.lit(text.LOG_START + "\n"), *marks, F.lit(text.LOG_END))


def _sql_log():
    out = []
    for grain in text.LOG_GRAINS:
        g = grain.lower()
        v = lambda m: f"coalesce(printf('%.6f', {g}_{m}), 'nan')"
        out.append(
            f"'{grain} Metrics:' || chr(10) || 'RMSE: ' || {v('rmse')} || chr(10) || 'MAE: ' || {v('mae')} || chr(10) || "
            f"'MAPE: ' || {v('mape')} || '%' || chr(10) || 'R2 (correlation squared): ' || {v('r2')} || chr(10)"
        )
    marks = " || ".join(
        f"'{g.upper()}_R2=' || coalesce(printf('%.6f', {g.lower()}_r2), 'N/A') || chr(10)" for g in text.LOG_GRAINS
    )
    return " || ".join(out) + f" || '{text.LOG_START}' || chr(10) || {marks} || '{text.LOG_END}'"


_WIDE = ", ".join(
    f"max({m}) FILTER (grain = '{g}') AS {g}_{m}"
    for g in ("daily", "weekly", "monthly")
    for m in ("rmse", "mae", "mape", "r2")
)
_SCRAPE = ",\n  ".join(
    f"TRY_CAST(nullif(regexp_extract(log, '(?s){g} Metrics:.*?{p}', 1), '') AS DOUBLE) AS {g}_{m}"
    for g in text.LOG_GRAINS
    for m, p in text.LOG_METRICS.items()
)
_MARKED = ",\n  ".join(
    f"TRY_CAST(nullif(regexp_extract(block, '{g.upper()}_R2=([\\d.]+|N/A)', 1), '') AS DOUBLE) AS marked_{g}_R2"
    for g in text.LOG_GRAINS
)


@query(
    "scrape_metrics",
    f"""SELECT series, {_SCRAPE}, {_MARKED} FROM (
SELECT *, substr(log, instr(log, '{text.LOG_START}'), instr(log, '{text.LOG_END}') - instr(log, '{text.LOG_START}')) AS block FROM (
SELECT series, {_sql_log()} AS log FROM (SELECT series, {_WIDE} FROM naive_scores GROUP BY series)))""",
)
def scrape_metrics(spark, sf):
    logs = score.to_wide(inp.naive_scores(spark, sf)).select("series", _log_text().alias("log"))
    log = F.col("log")
    marked = {f"marked_{n}": c for n, c in text.scraped_marked_r2(log).items()}
    return logs.select("series", *[c.alias(n) for n, c in {**text.scraped_metrics(log), **marked}.items()])


def _names():
    lag = [f"{c}_lag_{k}m" for c in text.INDICATORS for k in (1, 2, 3)]
    demand = [f"Demand_lag_{k}" for k in (1, 2, 3, 7, 14, 30)]
    rolls = [f"Demand_shift1_{s}_{n}" for n in (7, 14, 30) for s in ("mean", "std")] + ["Demand_roll_mean_7", "Demand_roll_std_7"]
    calendar = ["Month", "Quarter", "WeekOfYear", "DayOfWeek", "DayOfMonth", "Month_sin", "Month_cos", "Day_sin", "Day_cos"]
    orders = [f"Order_lag_{k}" for k in (1, 2, 3, 7, 14)] + [f"Order_ratio_lag_{k}" for k in (1, 2, 3, 7)]
    return ["dispatched", "ordered", *demand, *rolls, *calendar, *orders, *lag, "PIB_CO", "ICI_roll_mean_6", "TUAV_roll_std_3", "TUAV"]


_ECON = "(feature LIKE '%PIB_CO%' OR feature LIKE '%ICI%')"
_MARKET = "(" + " OR ".join(f"feature LIKE '%{m.replace('_', chr(92) + '_')}%' ESCAPE '{chr(92)}'" for m in text.MARKET) + ")"


def _has(s: str) -> str:
    return f"contains(feature, '{s}')"


@query(
    "categorise_feature",
    f"""SELECT series, feature, CASE
  WHEN {_ECON} AND {_has('lag')} THEN 'Economic Indicator Lag'
  WHEN {_ECON} AND {_has('roll_mean')} THEN 'Economic Indicator Rolling Mean'
  WHEN {_ECON} AND {_has('roll_std')} THEN 'Economic Indicator Rolling Std'
  WHEN {_ECON} THEN 'Economic Indicator Direct'
  WHEN {_MARKET} AND {_has('lag')} THEN 'Market Indicator Lag'
  WHEN {_MARKET} AND {_has('roll_mean')} THEN 'Market Indicator Rolling Mean'
  WHEN {_MARKET} AND {_has('roll_std')} THEN 'Market Indicator Rolling Std'
  WHEN {_MARKET} THEN 'Market Indicator Direct'
  WHEN {_has('Demand')} AND {_has('roll_std')} THEN 'Demand Rolling Std'
  WHEN {_has('Demand')} AND {_has('roll_mean')} THEN 'Demand Rolling Mean'
  WHEN {_has('Demand')} THEN 'Demand Lag' ELSE 'Time Features' END AS fine,
  CASE WHEN ({_ECON} OR {_MARKET}) AND {_has('lag')} THEN 'External Variable Lag'
  WHEN ({_ECON} OR {_MARKET}) AND {_has('roll_mean')} THEN 'External Variable Rolling Mean'
  WHEN {_ECON} OR {_MARKET} THEN 'External Variable Direct'
  WHEN {_has('Demand')} THEN 'Demand History' ELSE 'Time Features' END AS coarse
FROM (SELECT DISTINCT p_brand AS series FROM part) CROSS JOIN (SELECT DISTINCT unnest({_names()!r}) AS feature)""",
)
def categorise_feature(spark, sf):
    name = F.col("feature")
    series = tables.table(spark, sf, "part").select(F.col("p_brand").alias("series")).distinct()
    rows = series.select("series", F.explode(F.array(*[F.lit(n) for n in _names()])).alias("feature"))
    return rows.select(
        "series", "feature", text.category_fine(name).alias("fine"), text.category_coarse(name).alias("coarse")
    )


CATEGORIES = ("MonthNo", "Quarter", "Year", "YearMonth", "Material")


def category_rows(monthly):
    """Months with their calendar parts and the id, to be read as categories."""
    return monthly.withColumns(
        {
            "MonthNo": F.month("month"),
            "Quarter": F.quarter("month"),
            "Year": F.year("month"),
            "YearMonth": F.date_format("month", "yyyyMM"),
            "Material": F.col("series"),
        }
    )


_CATEGORY_SQL = {
    "MonthNo": "CAST(month(month) AS VARCHAR)",
    "Quarter": "CAST(quarter(month) AS VARCHAR)",
    "Year": "CAST(year(month) AS VARCHAR)",
    "YearMonth": "strftime(month, '%Y%m')",
    "Material": "series",
}
cte("category_rows", "SELECT *, " + ", ".join(f"{e} AS {c}" for c, e in _CATEGORY_SQL.items()) + " FROM monthly")


@query(
    "as_category",
    "SELECT m.*, "
    + ", ".join(f"CAST(i{k}.i AS DOUBLE) AS {c}_index" for k, c in enumerate(CATEGORIES))
    + " FROM category_rows m "
    + " ".join(
        f"JOIN (SELECT {c}, row_number() OVER (ORDER BY count(*) DESC, {c}) - 1 AS i FROM category_rows GROUP BY {c}) i{k} ON i{k}.{c} = m.{c}"
        for k, c in enumerate(CATEGORIES)
    ),
)
def as_category(spark, sf):
    """Categories by name and by number, the most frequent first; `fit_category` learns from the numbers."""
    return models.categories(category_rows(inp.monthly(spark, sf)), list(CATEGORIES))


@query(
    "str_ops",
    """SELECT o_orderkey, substr(o_orderpriority, 1, 1) AS head, right(o_orderpriority, 3) AS tail,
  contains(o_orderpriority, 'URGENT') AS urgent, replace(o_orderpriority, '-', '_') AS replaced,
  lpad(CAST(o_orderkey AS VARCHAR), 9, '0') || '_' || o_orderstatus AS joined FROM orders""",
)
def str_ops(spark, sf):
    p = F.col("o_orderpriority")
    return tables.table(spark, sf, "orders").select(
        "o_orderkey",
        F.substring(p, 1, 1).alias("head"),
        F.right(p, F.lit(3)).alias("tail"),
        F.contains(p, F.lit("URGENT")).alias("urgent"),
        F.replace(p, F.lit("-"), F.lit("_")).alias("replaced"),
        F.concat(text.pad_id(F.col("o_orderkey")), F.lit("_"), F.col("o_orderstatus")).alias("joined"),
    )
