"""Registered queries: window features, recursions and calendar columns."""

from __future__ import annotations

from pyspark.sql import functions as F

from seriesloom.functions import calendar as cal
from seriesloom.functions import numeric as num
from seriesloom.operators import align, indicators, lumpy, recursive
from seriesloom.operators import window as win
from seriesloom.plans import inputs as inp
from seriesloom.plans.registry import cols, cte, query, r
from seriesloom.spec import SeriesSpec

P = "PARTITION BY series, split ORDER BY date"
C = "PARTITION BY series ORDER BY date"
M = "PARTITION BY series ORDER BY month"
X = "ORDER BY month"


def over(expr: str, start: int, end: int, part: str = P) -> str:
    """``expr`` over rows start..end; negative numbers are preceding rows."""

    def bound(n: int) -> str:
        return "CURRENT ROW" if n == 0 else (f"{-n} PRECEDING" if n < 0 else f"{n} FOLLOWING")

    return f"{expr} OVER ({part} ROWS BETWEEN {bound(start)} AND {bound(end)})"


def whole(expr: str, part: str = P) -> str:
    return f"{expr} OVER ({part} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"


def lag(c: str, k: int, part: str = P) -> str:
    return f"lag({c}, {k}) OVER ({part})"


def full(agg: str, c: str, n: int, start: int, end: int, part: str = P) -> str:
    return f"CASE WHEN {over(f'count({c})', start, end, part)} >= {n} THEN {over(f'{agg}({c})', start, end, part)} END"


AGG = {"mean": "avg", "std": "stddev_samp", "min": "min", "max": "max", "var": "var_samp", "sum": "sum"}


def daily_query(name: str, features: dict[str, str], build, ints: tuple[str, ...] = (), coarse: str = "-"):
    """Register features of the filled brand panel: SQL expressions and the function that builds the columns.

    ``ints`` are compared as they are; columns whose name contains ``coarse`` can be
    huge (a division by almost zero) and keep two decimals.
    """
    digits = {n: 2 if coarse in n else 6 for n in features}
    select = [f'{e} AS "{n}"' if n in ints else f'{r(e, digits[n])} AS "{n}"' for n, e in features.items()]

    @query(name, f"SELECT series, date, split, {', '.join(select)} FROM filled")
    def run(spark, sf):
        columns = build()
        if set(columns) != set(features):
            raise ValueError(f"{name}: {set(columns) ^ set(features)}")
        return inp.filled(spark, sf).select(
            "series", "date", "split", *[c.alias(n) if n in ints else F.round(c, digits[n]).alias(n) for n, c in columns.items()]
        )


def d():
    return F.col("dispatched")


def o():
    return F.col("ordered")


# --- lags and rolling statistics -----------------------------------------------------------------

_LAGS = (1, 2, 3, 5, 7, 14, 21, 28, 30, 60, 90, 180)
daily_query("lag_set", {f"Demand_lag_{k}": lag("dispatched", k) for k in _LAGS}, lambda: win.lags(d(), inp.SPLIT, _LAGS, "Demand"))
daily_query(
    "lag_flag",
    {
        f"{n}_positive_lag_{k}": f"CASE WHEN {lag(c, k)} > 0 THEN 1 ELSE 0 END"
        for n, c in (("Demand", "dispatched"), ("Order", "ordered"))
        for k in (1, 2, 3, 6, 12)
    },
    lambda: {
        **win.lag_flags(d(), inp.SPLIT, (1, 2, 3, 6, 12), "Demand"),
        **win.lag_flags(o(), inp.SPLIT, (1, 2, 3, 6, 12), "Order"),
    },
    ints=tuple(f"{n}_positive_lag_{k}" for n in ("Demand", "Order") for k in (1, 2, 3, 6, 12)),
)


@query("lag_set_monthly", "SELECT series, month, " + cols({f"Demand_lag_{k}": lag("dispatched", k, M) for k in win.LAGS["month_12"]}) + " FROM monthly")
def lag_set_monthly(spark, sf):
    columns = win.lags(d(), inp.MONTHLY, win.LAGS["month_12"], "Demand")
    return inp.monthly(spark, sf).select("series", "month", *num.rounded(columns))


_WIN = (5, 7, 14, 28, 30, 60, 90)
daily_query(
    "roll_past",
    {f"Demand_roll_{s}_{n}": over(f"{AGG[s]}(dispatched)", -n, -1) for n in _WIN for s in ("mean", "std")},
    lambda: win.roll_past(d(), inp.SPLIT, _WIN, "Demand"),
)
daily_query(
    "roll_past_minmax",
    {f"Demand_roll_{s}_{n}": over(f"{s}(dispatched)", -n, -1) for n in (7, 14, 30) for s in ("min", "max")},
    lambda: win.roll_past(d(), inp.SPLIT, (7, 14, 30), "Demand", ("min", "max")),
)
daily_query(
    "roll_past_cv",
    {
        f"Demand_roll_cv_{n}": f"{over('stddev_samp(dispatched)', -n, -1)} / nullif({over('avg(dispatched)', -n, -1)}, 0)"
        for n in (7, 14, 30)
    },
    lambda: win.roll_past_cv(d(), inp.SPLIT, (7, 14, 30), "Demand"),
)
daily_query(
    "roll_past_zeros",
    {
        f"Demand_zeros_{n}": f"CAST({over('sum(CASE WHEN dispatched = 0 THEN 1 ELSE 0 END)', -n, -1)} AS BIGINT)"
        for n in (7, 14, 30)
    },
    lambda: win.zero_count(d(), inp.SPLIT, (7, 14, 30), "Demand"),
    ints=("Demand_zeros_7", "Demand_zeros_14", "Demand_zeros_30"),
)
daily_query(
    "roll_shift",
    {
        **{
            f"Demand_shift1_{s}_{n}": full(AGG[s], "dispatched", n, -n, -1)
            for n in (7, 14, 30, 60, 90)
            for s in ("mean", "std")
        },
        **{
            f"Demand_shift30_{s}_{n}": over(f"{AGG[s]}(dispatched)", -(n + 29), -30)
            for n in (30, 60, 90)
            for s in ("mean", "std")
        },
    },
    lambda: {
        **win.roll_shift(d(), inp.SPLIT, (7, 14, 30, 60, 90), "Demand", 1, None),
        **win.roll_shift(d(), inp.SPLIT, (30, 60, 90), "Demand", 30, 1),
    },
)
daily_query(
    "roll_full",
    {f"Demand_full_{s}_{n}": full(AGG[s], "dispatched", n, -(n - 1), 0) for n in (3, 6, 12) for s in ("mean", "std")},
    lambda: win.roll_full(d(), inp.SPLIT, (3, 6, 12), "Demand"),
)
daily_query(
    "roll_current",
    {
        f"Demand_cur_{s}_{n}": over(f"{AGG[s]}(dispatched)", -(n - 1), 0)
        for n in (3, 5, 7, 14)
        for s in ("mean", "std", "max", "min")
    },
    lambda: win.roll_current(d(), inp.SPLIT, (3, 5, 7, 14), "Demand", ("mean", "std", "max", "min")),
)
daily_query(
    "roll_range_cv",
    {
        **{f"Demand_range_{n}": f"{over('max(dispatched)', 1 - n, 0)} - {over('min(dispatched)', 1 - n, 0)}" for n in (3, 5, 7, 14)},
        **{
            f"Demand_cv_{n}": f"{over('stddev_samp(dispatched)', 1 - n, 0)} / ({over('avg(dispatched)', 1 - n, 0)} + 1e-6)"
            for n in (3, 5, 7, 14)
        },
    },
    lambda: win.roll_range_cv(d(), inp.SPLIT, (3, 5, 7, 14), "Demand"),
)
_Q = (7, 14, 30, 60, 90)
daily_query(
    "roll_quantile",
    {
        f"Demand_q{p}_{n}": f"CASE WHEN {over('count(dispatched)', -n, -1)} >= {n} THEN {over(f'quantile_cont(dispatched, {p / 100})', -n, -1)} END"
        for n in _Q
        for p in (25, 75)
    },
    lambda: win.roll_quantiles(d(), inp.SPLIT, _Q, "Demand"),
)
daily_query(
    "roll_median",
    {
        **{f"Demand_roll_median_{n}": over("quantile_cont(dispatched, 0.5)", 1 - n, 0) for n in (2, 3, 4)},
        **{
            f"Demand_volatility_{n}": f"{over('stddev_samp(dispatched)', 1 - n, 0)} / ({over('quantile_cont(dispatched, 0.5)', 1 - n, 0)} + 1e-8)"
            for n in (2, 3, 4)
        },
    },
    lambda: win.roll_median(d(), inp.SPLIT, (2, 3, 4), "Demand"),
    coarse="volatility",
)
daily_query(
    "roll_cv_eps",
    {
        f"Demand_roll_cv_{n}": f"{over('stddev_samp(dispatched)', 1 - n, 0)} / ({over('avg(dispatched)', 1 - n, 0)} + 1e-8)"
        for n in (3, 6, 12)
    },
    lambda: win.roll_cv_eps(d(), inp.SPLIT, (3, 6, 12), "Demand"),
)
daily_query(
    "roll_mode_switch",
    {
        f"Demand_mode_{s}_{n}": f"CASE WHEN split = 'train' THEN {over(f'{AGG[s]}(dispatched)', 1 - n, 0)} ELSE {whole(f'{AGG[s]}(dispatched)')} END"
        for n in (3, 6, 12)
        for s in ("mean", "std")
    },
    lambda: win.roll_or_expand(d(), inp.SPLIT, (3, 6, 12), "Demand", F.col("split") == "train"),
)
daily_query(
    "expand_stats",
    {f"Demand_expanding_{s}": whole(f"{AGG[s]}(dispatched)") for s in ("mean", "std", "sum")},
    lambda: win.expanding(d(), inp.SPLIT, "Demand"),
)

# --- intermittent demand ----------------------------------------------------------------------------


def _share(test: str) -> str:
    return f"avg(CASE WHEN {test} THEN 1.0 ELSE 0.0 END)"


_FREQ = (7, 14, 30, 60, 90)
daily_query(
    "order_freq",
    {
        **{f"Order_Frequency_{n}d": over(_share("ordered > 0"), -n, -1) for n in _FREQ},
        **{f"Zero_Frequency_{n}d": over(_share("ordered = 0"), -n, -1) for n in _FREQ},
        **{f"cur_Order_Frequency_{n}d": over(_share("ordered > 0"), 1 - n, 0) for n in _FREQ},
        **{f"cur_Zero_Frequency_{n}d": over(_share("ordered = 0"), 1 - n, 0) for n in _FREQ},
    },
    lambda: {
        **lumpy.order_frequency(o(), inp.SPLIT, _FREQ),
        **{f"cur_{n}": c for n, c in lumpy.order_frequency(o(), inp.SPLIT, _FREQ, past=False).items()},
    },
)
daily_query(
    "nonzero_count",
    {
        f"NonZero_{name}_{n}d": f"CASE WHEN {over('count(*)', 1 - n, 0)} = {n} THEN CAST({over(f'sum(CASE WHEN {c} > 0 THEN 1 ELSE 0 END)', 1 - n, 0)} AS BIGINT) END"
        for name, c in (("Demand", "dispatched"), ("Orders", "ordered"))
        for n in (7, 14, 30)
    },
    lambda: {
        **lumpy.nonzero_count(d(), inp.SPLIT, (7, 14, 30), "Demand"),
        **lumpy.nonzero_count(o(), inp.SPLIT, (7, 14, 30), "Orders"),
    },
    ints=tuple(f"NonZero_{m}_{n}d" for m in ("Demand", "Orders") for n in (7, 14, 30)),
)
_POS = "CASE WHEN ordered > 0 THEN ordered END"
daily_query(
    "nonzero_mean_var",
    {
        **{f"NonZero_Avg_Order_{n}d": f"coalesce({over(f'avg({_POS})', -n, -1)}, 0)" for n in _FREQ},
        **{f"NonZero_Order_Variance_{n}d": f"coalesce({over(f'var_samp({_POS})', -n, -1)}, 0)" for n in _FREQ},
    },
    lambda: lumpy.nonzero_mean_var(o(), inp.SPLIT, _FREQ),
)
daily_query(
    "roll_max_var",
    {
        f"{name}_{n}d": f"coalesce({over(f'{agg}(ordered)', 1 - n, 0)}, 0)"
        for name, agg in (("Max_Order_Size", "max"), ("Order_Size_Variance", "var_samp"), ("Demand_Variability", "stddev_samp"))
        for n in _FREQ
    },
    lambda: lumpy.max_var(o(), inp.SPLIT, _FREQ),
)
daily_query(
    "zero_run_window",
    {
        f"days_since_order_{n}": f"CAST(coalesce({over('sum(CASE WHEN ordered = 0 THEN 1 ELSE 0 END)', -n, -1)}, 0) AS BIGINT)"
        for n in (7, 14, 30)
    },
    lambda: lumpy.zero_run_window(o(), inp.SPLIT, (7, 14, 30)),
    ints=("days_since_order_7", "days_since_order_14", "days_since_order_30"),
)
daily_query(
    "cumulative_zeros",
    {
        "cumulative_zeros": f"CASE WHEN ordered > 0 THEN 0 ELSE CAST({whole('sum(CASE WHEN ordered > 0 THEN 0 ELSE 1 END)')} AS BIGINT) END"
    },
    lambda: {"cumulative_zeros": lumpy.cumulative_zeros(o(), inp.SPLIT)},
    ints=("cumulative_zeros",),
)
daily_query(
    "days_since_order",
    {
        "days_since_order": f"CAST(date - {whole('max(CASE WHEN ordered > 0 THEN date END)')} AS INTEGER)",
        "recent_zeros": f"CASE WHEN ordered > 0 THEN 0 ELSE CAST({over('sum(CASE WHEN ordered > 0 THEN 0 ELSE 1 END)', -6, 0)} AS BIGINT) END",
    },
    lambda: {
        "days_since_order": lumpy.days_since_order(o(), inp.SPLIT),
        "recent_zeros": lumpy.recent_zeros(o(), inp.SPLIT),
    },
    ints=("days_since_order", "recent_zeros"),
)

# --- recursions ----------------------------------------------------------------------------------------


def _ema_sql(spans, adjust: bool, name: str, value: str, fill: bool = False) -> str:
    """Weights written out: each row is joined with the rows before it, the newest of which weighs most."""
    parts = []
    for s in spans:
        a = 2.0 / (s + 1)
        decay = f"pow({1 - a!r}, b.k - 1 - x.k)"
        weight = decay if adjust else f"(CASE WHEN x.k = 1 THEN 1.0 ELSE {a!r} END) * {decay}"
        total = f"sum({weight} * x.v)" + (f" / sum({decay})" if adjust else "")
        parts.append(f'{r(f"coalesce({total}, 0)" if fill else total)} AS "{name}_{s}"')
    rows = f"""(SELECT series, split, date, {value} AS v, row_number() OVER ({P}) AS k FROM filled)"""
    return f"""SELECT b.series, b.date, b.split, {', '.join(parts)} FROM {rows} b LEFT JOIN {rows} x
ON x.series = b.series AND x.split = b.split AND x.k < b.k GROUP BY 1, 2, 3"""


@query("ema_recursive", _ema_sql((7, 14, 30, 60), False, "Demand_ema", "dispatched"))
def ema_recursive(spark, sf):
    panel = inp.filled(spark, sf).select("series", "date", "split", "dispatched")
    out = recursive.ema(panel, inp.SPLIT, "dispatched", (7, 14, 30, 60), "Demand_ema")
    return out.select("series", "date", "split", *[F.round(f"Demand_ema_{s}", 6).alias(f"Demand_ema_{s}") for s in (7, 14, 30, 60)])


@query("ema_weighted", _ema_sql((7, 14, 30, 60, 90), True, "EMA", "ordered", fill=True))
def ema_weighted(spark, sf):
    panel = inp.filled(spark, sf).select("series", "date", "split", "ordered")
    out = recursive.ema(panel, inp.SPLIT, "ordered", (7, 14, 30, 60, 90), "EMA", adjust=True, fill=0.0)
    return out.select("series", "date", "split", *[F.round(f"EMA_{s}", 6).alias(f"EMA_{s}") for s in (7, 14, 30, 60, 90)])


cte(
    "croston_rows",
    f"""SELECT series, split, date, ordered, row_number() OVER ({P}) AS k,
  CASE WHEN ordered > 0 OR row_number() OVER ({P}) = 1 THEN 1 ELSE 0 END AS hit FROM filled""",
)
cte("croston_steps", f"SELECT *, {whole('sum(hit)')} - 1 AS j, {whole('sum(1 - hit)')} AS zeros FROM croston_rows")
cte(
    "croston_fit",
    """SELECT b.series, b.split, b.date, max(CASE WHEN b.k = 1 THEN 1 ELSE 0 END) AS is_first,
  sum((CASE WHEN x.j = 0 THEN 1.0 ELSE 0.4 END) * pow(0.6, b.j - x.j) * x.ordered) / (1 + max(b.zeros)) AS f
FROM croston_steps b JOIN croston_steps x ON x.series = b.series AND x.split = b.split AND x.hit = 1 AND x.j <= b.j GROUP BY 1, 2, 3""",
)


@query("croston", f"SELECT series, date, split, {r('CASE WHEN is_first = 1 THEN 0 ELSE f END')} AS croston FROM croston_fit")
def croston(spark, sf):
    panel = inp.filled(spark, sf).select("series", "date", "split", "ordered")
    out = recursive.croston(panel, inp.SPLIT, "ordered")
    return out.select("series", "date", "split", F.round("croston", 6).alias("croston"))


cte(
    "croston_hits",
    f"""SELECT series, split, k, ordered, row_number() OVER ({P.replace('date', 'k')}) - 1 AS j, k - coalesce(lag(k) OVER ({P.replace('date', 'k')}), 0) AS gap
FROM croston_rows WHERE ordered > 0""",
)
cte(
    "croston_text",
    """SELECT b.series, b.split, b.k, sum((CASE WHEN x.j = 0 THEN 1.0 ELSE 0.4 END) * pow(0.6, b.j - x.j) * x.ordered) AS size,
  sum((CASE WHEN x.j = 0 THEN 1.0 ELSE 0.4 END) * pow(0.6, b.j - x.j) * x.gap) AS gap
FROM croston_hits b JOIN croston_hits x ON x.series = b.series AND x.split = b.split AND x.j <= b.j GROUP BY 1, 2, 3""",
)


@query(
    "croston_textbook",
    f"""SELECT r.series, r.date, r.split, {r('coalesce(t.size / t.gap, 0)')} AS croston
FROM croston_rows r ASOF LEFT JOIN croston_text t ON r.series = t.series AND r.split = t.split AND r.k > t.k""",
)
def croston_textbook(spark, sf):
    panel = inp.filled(spark, sf).select("series", "date", "split", "ordered")
    out = recursive.croston_textbook(panel, inp.SPLIT, "ordered")
    return out.select("series", "date", "split", F.round("croston", 6).alias("croston"))


@query(
    "croston_align",
    f"""SELECT t.series, t.date, t.ordered AS actual, {r('f.f')} AS predicted FROM
(SELECT series, date, ordered, row_number() OVER (PARTITION BY series ORDER BY date DESC) AS b FROM filled WHERE split = 'test') t
JOIN (SELECT series, CASE WHEN is_first = 1 THEN 0 ELSE f END AS f, row_number() OVER (PARTITION BY series ORDER BY date DESC) AS b FROM croston_fit WHERE split = 'train') f
ON t.series = f.series AND t.b = f.b""",
)
def croston_align(spark, sf):
    panel = inp.filled(spark, sf).select("series", "date", "split", "ordered")
    side = lambda s: panel.where(F.col("split") == s)
    out = recursive.croston_aligned(side("train"), side("test"), inp.SPEC, "ordered")
    return out.select("series", "date", "actual", F.round("predicted", 6).alias("predicted"))


# --- differences, ratios and year-over-year --------------------------------------------------------------


@query(
    "diff_accel",
    "SELECT series, month, split, "
    + cols(
        {
            **{f"Demand_accel_{n}": over("avg(d1)", 1 - n, 0, "PARTITION BY series, split ORDER BY month") for n in (3, 6, 12)},
            **{
                f"Demand_jolt_{n}": f"CASE WHEN {over('count(d1)', 1 - n, 0, 'PARTITION BY series, split ORDER BY month')} >= {n} THEN d1 - {over('avg(d1)', 1 - n, 0, 'PARTITION BY series, split ORDER BY month')} END"
                for n in (3, 6, 12)
            },
        }
    )
    + " FROM (SELECT *, dispatched - lag(dispatched) OVER (PARTITION BY series, split ORDER BY month) AS d1 FROM monthly_split)",
)
def diff_accel(spark, sf):
    spec = inp.MONTHLY_SPLIT
    rows = inp.monthly_with_split(spark, sf).withColumn("_diff", win.diff(d(), spec))
    columns = {
        **win.diff_mean(F.col("_diff"), spec, (3, 6, 12), "Demand"),
        **win.diff_minus_mean(F.col("_diff"), spec, (3, 6, 12), "Demand"),
    }
    return rows.select("series", "month", "split", *num.rounded(columns))


def _momentum_sql(c: str, n: int) -> dict[str, str]:
    mean, std = over(f"avg({c})", 1 - n, 0, X), over(f"stddev_samp({c})", 1 - n, 0, X)
    return {
        f"{c}_momentum_{n}": f"{c} - {mean}",
        f"{c}_momentum_z_{n}": f"CASE WHEN {over(f'count({c})', 1 - n, 0, X)} >= {n} THEN ({c} - {mean}) / nullif({std}, 0) END",
        f"{c}_momentum_lag_{n}": f"{lag(c, 1, X)} - {mean}",
        f"{c}_rel_change_{n}": f"({lag(c, 1, X)} - {mean}) / ({mean} + 1e-8)",
    }


# The indicator table has no series key.
MONTHS = SeriesSpec(keys=(), time="month")


@query("momentum", "SELECT month, " + cols({k: v for c in ("TUAV", "ECG_DESP", "ISE_CO") for n in (3, 6) for k, v in _momentum_sql(c, n).items()}) + " FROM ext")
def momentum(spark, sf):
    columns = {}
    for c in ("TUAV", "ECG_DESP", "ISE_CO"):
        columns.update(win.momentum(F.col(c), MONTHS, (3, 6), c))
    return inp.external(spark, sf).select("month", *num.rounded(columns))


@query(
    "roll_corr",
    "SELECT month, "
    + r(
        "CASE WHEN "
        + over("count(*)", -5, 0, X)
        + " >= 6 THEN "
        + over("covar_samp(TUAV, ECG_DESP)", -5, 0, X)
        + " / nullif("
        + over("stddev_samp(TUAV)", -5, 0, X)
        + " * "
        + over("stddev_samp(ECG_DESP)", -5, 0, X)
        + ", 0) END"
    )
    + " AS market_correlation FROM ext",
)
def roll_corr(spark, sf):
    c = win.roll_corr(F.col("TUAV"), F.col("ECG_DESP"), MONTHS, 6)
    return inp.external(spark, sf).select("month", F.round(c, 6).alias("market_correlation"))


cte(
    "direction_rows",
    f"SELECT *, coalesce(CASE WHEN s <> lag(s) OVER ({P}) THEN 1 WHEN s = lag(s) OVER ({P}) THEN 0 END, 1) AS changed FROM (SELECT *, sign(dispatched - lag(dispatched) OVER ({P})) AS s FROM filled)",
)


@query(
    "direction_changes",
    "SELECT series, date, split, "
    + cols(
        {
            f"Demand_direction_{n}": f"""CASE WHEN split = 'train' AND {over('count(s)', 1 - n, 0)} >= 1 THEN CASE WHEN {over('count(*)', 1 - n, 0)} = {n}
  THEN ({over('sum(changed)', 2 - n, 0)} + 1) / {n} ELSE {over('sum(changed)', 1 - n, 0)} / {over('count(*)', 1 - n, 0)} END
  WHEN split <> 'train' AND {whole('count(s)')} >= 1 THEN {whole('sum(changed)')} / {whole('count(*)')} END"""
            for n in (2, 3, 4)
        }
    )
    + " FROM direction_rows",
)
def direction_changes(spark, sf):
    panel = inp.filled(spark, sf)
    out = win.direction_changes(panel, inp.SPLIT, (2, 3, 4), "Demand", F.col("split") == "train")
    return out.select("series", "date", "split", *[F.round(f"Demand_direction_{n}", 6).alias(f"Demand_direction_{n}") for n in (2, 3, 4)])


@query(
    "pct_change",
    "SELECT series, month, "
    + cols({f"Demand_pct_change_{p}": f"dispatched / nullif({lag('dispatched', p, M)}, 0) - 1" for p in (3, 6, 12)})
    + " FROM monthly",
)
def pct_change(spark, sf):
    return inp.monthly(spark, sf).select("series", "month", *num.rounded(win.pct_change(d(), inp.MONTHLY, (3, 6, 12), "Demand")))


@query("yoy_ratio", "SELECT series, month, " + r("dispatched / nullif(" + lag("dispatched", 12, M) + ", 0)") + " AS Demand_yoy_ratio FROM monthly")
def yoy_ratio(spark, sf):
    return inp.monthly(spark, sf).select("series", "month", *num.rounded(win.yoy_ratio(d(), inp.MONTHLY, "Demand")))


def _ly(end: int, n: int, slide: int) -> str:
    a, b = -(end + n - 1 + slide), -(end + slide)
    return full("avg", "dispatched", n, a, b, C)


def _ly_mode(end: int, n: int) -> str:
    return f"CASE WHEN split = 'test' THEN {_ly(end, n, 1)} ELSE {_ly(end, n, 0)} END"


daily_query(
    "same_period_last_year",
    {
        "Demand_same_day_last_year": lag("dispatched", 365, C),
        "Demand_same_day_last_year_diff": f"{lag('dispatched', 1, C)} - {lag('dispatched', 365, C)}",
        "Demand_same_week_last_year": _ly_mode(364, 7),
        "Demand_same_month_last_year": _ly_mode(365, 30),
        "Demand_same_quarter_last_year": _ly(365, 90, 0),
    },
    lambda: win.last_year(d(), inp.SPEC, "Demand", F.col("split") == "test"),
)

# --- orders beside dispatches ------------------------------------------------------------------------------

daily_query(
    "order_lag",
    {f"Order_lag_{k}": lag("ordered", k) for k in (1, 2, 3, 7, 14, 30)},
    lambda: win.lags(o(), inp.SPLIT, (1, 2, 3, 7, 14, 30), "Order"),
)
daily_query(
    "order_current",
    {"Customer_Order": "ordered", "Order_Demand_Ratio": "ordered / nullif(dispatched, 0)"},
    lambda: {"Customer_Order": o(), "Order_Demand_Ratio": num.ratio(o(), d())},
)
daily_query(
    "order_ratio_lag",
    {
        **{f"Order_ratio_lag_{k}": f"{lag('ordered', k)} / nullif({lag('dispatched', k)}, 0)" for k in (1, 2, 3, 7)},
        **{f"Eps_ratio_lag_{k}": f"{lag('ordered', k)} / ({lag('dispatched', k)} + 1e-6)" for k in (1, 2, 3, 7)},
    },
    lambda: {
        **win.order_ratio_lags(o(), d(), inp.SPLIT, (1, 2, 3, 7), "Order"),
        **win.order_ratio_lags(o(), d(), inp.SPLIT, (1, 2, 3, 7), "Eps", 1e-6),
    },
    coarse="Eps",
)
daily_query(
    "order_roll",
    {
        **{f"Order_cur_{s}_{n}": over(f"{AGG[s]}(ordered)", 1 - n, 0) for n in (3, 7, 14, 30) for s in ("mean", "std")},
        **{f"Order_shift1_mean_{n}": full("avg", "ordered", n, -n, -1) for n in (7, 14, 30)},
        "Order_roll_cv_3": f"{over('stddev_samp(ordered)', -2, 0)} / ({over('avg(ordered)', -2, 0)} + 1e-8)",
    },
    lambda: {
        **win.roll_current(o(), inp.SPLIT, (3, 7, 14, 30), "Order"),
        **win.roll_shift(o(), inp.SPLIT, (7, 14, 30), "Order", 1, None, ("mean",)),
        **win.roll_cv_eps(o(), inp.SPLIT, (3,), "Order"),
    },
)


def _fulfil(a: str, b: str) -> str:
    return f"greatest(0.0, least(1.0, CASE WHEN {b} = 0 THEN 1.0 ELSE {a} / nullif({b}, 0) END))"


daily_query(
    "fulfil_rate",
    {
        "Order_Fulfillment_Rate": _fulfil("dispatched", "ordered"),
        "Order_Fulfillment_Rate_lag_1": f"CASE WHEN {lag('ordered', 1)} IS NOT NULL THEN {_fulfil(lag('dispatched', 1), lag('ordered', 1))} END",
    },
    lambda: win.fulfil_rates(d(), o(), inp.SPLIT),
)
daily_query(
    "order_dispatch_gap",
    {
        "Order_Dispatch_Lag": f"coalesce(CASE WHEN split = 'train' THEN {lag('dispatched', 1)} - {lag('ordered', 1)} ELSE lead(dispatched) OVER ({P}) - ordered END, 0)",
        "Order_Dispatch_Lag_past": f"coalesce({lag('dispatched', 1)} - {lag('ordered', 1)}, 0)",
    },
    lambda: win.order_dispatch_gap(d(), o(), inp.SPLIT, F.col("split") == "train"),
)
daily_query(
    "demand_shock",
    {"Demand_Shock": f"abs((dispatched - {over('avg(dispatched)', -29, 0)}) / ({over('stddev_samp(dispatched)', -29, 0)} + 1e-6))"},
    lambda: {"Demand_Shock": win.demand_shock(d(), inp.SPLIT)},
)

# --- monthly indicators ---------------------------------------------------------------------------------------

ES = "PARTITION BY split ORDER BY month"
_IND = ("ECG_DESP", "TUAV", "PIB_CO", "ISE_CO", "VTOTAL_19", "OTOTAL_19", "ICI")
cte(
    "ext_lagged",
    "SELECT month, split, "
    + ", ".join(
        f"CASE WHEN split <> 'train' THEN {lag(c, k + 1, ES)} ELSE {lag(c, k, ES)} END AS {c}_lag_{k}m" for c in _IND for k in (1, 2, 3)
    )
    + " FROM ext_split",
)


@query(
    "ext_lag",
    "SELECT f.series, f.date, f.split, "
    + cols({f"{c}_lag_{k}m": f"coalesce(e.{c}_lag_{k}m, CASE WHEN f.date - p.month <= 30 THEN p.{c}_lag_{k}m END)" for c in _IND for k in (1, 2, 3)})
    + """ FROM filled f LEFT JOIN ext_lagged e ON e.split = f.split AND e.month = date_trunc('month', f.date)
LEFT JOIN ext_lagged p ON p.split = f.split AND p.month = date_trunc('month', f.date) - INTERVAL 1 MONTH""",
)
def ext_lag(spark, sf):
    ext = inp.external_day_lags(spark, sf)
    names = [c for c in ext.columns if c not in ("split", "date")]
    joined = align.join_days(inp.filled(spark, sf), ext, ("split",))
    return joined.select("series", "date", "split", *[F.round(c, 6).alias(c) for c in names])


@query(
    "ext_lag_long",
    "SELECT month, " + cols({f"{c}_lag_{k}m": lag(c, k, X) for c in ("PIB_CO", "ICI") for k in range(1, 25)}) + " FROM ext",
)
def ext_lag_long(spark, sf):
    columns = indicators.ext_lags(("PIB_CO", "ICI"), tuple(range(1, 25)))
    return inp.external(spark, sf).select("month", *num.rounded(columns))


_ROLLS = (3, 6, 9, 12, 18, 24)


@query(
    "ext_roll",
    "SELECT month, "
    + cols(
        {
            **{f"{c}_roll_{s}_{n}m": full(AGG[s], c, n, 1 - n, 0, X) for c in ("ISE_CO", "ICI") for n in _ROLLS for s in ("mean", "std")},
            **{f"shifted_{c}_roll_mean_{n}m": full("avg", c, n, -n, -1, X) for c in ("TUAV",) for n in (3, 6)},
            **{f"grown_{c}_roll_mean_{n}m": over(f"avg({c})", 1 - n, 0, X) for c in ("TUAV",) for n in (3, 6)},
        },
        5,
    )
    + " FROM ext",
)
def ext_roll(spark, sf):
    columns = {
        **indicators.ext_rolls(("ISE_CO", "ICI"), _ROLLS),
        **{f"shifted_{n}": c for n, c in indicators.ext_rolls(("TUAV",), (3, 6), shift=1, stats=("mean",)).items()},
        **{f"grown_{n}": c for n, c in indicators.ext_rolls(("TUAV",), (3, 6), full=False, stats=("mean",)).items()},
    }
    return inp.external(spark, sf).select("month", *num.rounded(columns, 5))


cte("ext_daily", "SELECT f.series, f.date, e.TUAV FROM filled f ASOF LEFT JOIN ext e ON f.date >= e.month")


@query(
    "ext_roll_daily",
    "SELECT series, date, " + cols({f"TUAV_{m}M": full("avg", "TUAV", m * 30, 1 - m * 30, 0, C) for m in (3, 6)}, 2) + " FROM ext_daily",
)
def ext_roll_daily(spark, sf):
    daily = align.asof_month(inp.filled(spark, sf), inp.external(spark, sf), ["TUAV"], inp.last_day(spark, sf))
    columns = {
        f"TUAV_{m}M": win.roll_full(F.col("TUAV"), inp.SPEC, (m * 30,), "TUAV", ("mean",))[f"TUAV_full_mean_{m * 30}"]
        for m in (3, 6)
    }
    return daily.select("series", "date", *num.rounded(columns, 2))


@query(
    "ext_change",
    "SELECT month, "
    + cols(
        {
            **{f"{c}_{k}m_change": f"{c} - {lag(c, k, X)}" for c in ("ECG_DESP", "ISE_CO", "ICI") for k in (1, 2, 3)},
            **{f"{c}_volatility": full("stddev_samp", c, 3, -2, 0, X) for c in ("ECG_DESP", "ISE_CO", "ICI")},
            **{f"{c}_pct_change_{p}m": f"{lag(c, 1, X)} / nullif({lag(c, p + 1, X)}, 0) - 1" for c in ("ECG_DESP", "ISE_CO", "ICI") for p in (3, 6)},
        }
    )
    + " FROM ext",
)
def ext_change(spark, sf):
    names = ("ECG_DESP", "ISE_CO", "ICI")
    columns = {**indicators.ext_changes(names), **indicators.ext_pct_changes(names)}
    return inp.external(spark, sf).select("month", *num.rounded(columns))


cte(
    "brand_labelled",
    """SELECT series, CASE WHEN a < m - s / 2 THEN 0 WHEN a < m + s / 2 THEN 1 ELSE 2 END AS cluster FROM
(SELECT series, avg(dispatched) AS a FROM monthly GROUP BY 1), (SELECT avg(a) AS m, stddev_samp(a) AS s FROM (SELECT avg(dispatched) AS a FROM monthly GROUP BY series))""",
)


def brand_labelled(spark, sf, panel=None):
    """``panel`` is `inp.monthly` where the caller has it already."""
    from seriesloom.operators.profile import profile

    monthly = inp.monthly(spark, sf) if panel is None else panel
    return inp.label_by_level(profile(monthly)).select("series", "cluster")


def _recipe_value(name: str) -> str:
    if name in ("Month", "Quarter"):
        return f"{name.lower()}(month)"
    if name.endswith("M") and "_" in name and name.rsplit("_", 1)[1][:-1].isdigit():
        base, size = name.rsplit("_", 1)
        return over(f"avg({base})", 1 - int(size[:-1]), 0, X)
    return name


cte(
    "recipe_rows",
    "\nUNION ALL ".join(
        f"SELECT month, {c} AS cluster, '{n}' AS feature, CAST({_recipe_value(n)} AS DOUBLE) AS value FROM ext"
        for c in (0, 1, 2)
        for n in indicators.recipe_columns(c)
    ),
)

cte(
    "recipe_names",
    "SELECT * FROM (VALUES " + ", ".join(f"({c}, '{n}')" for c in (0, 1, 2) for n in indicators.recipe_columns(c)) + ") AS t(cluster, feature)",
)


@query(
    "cluster_recipe",
    f"""SELECT m.series, m.month, l.cluster, n.feature,
  {r("CASE n.feature WHEN 'Month' THEN month(m.month) WHEN 'Quarter' THEN quarter(m.month) ELSE x.value END")} AS value
FROM monthly m JOIN brand_labelled l ON m.series = l.series JOIN recipe_names n ON n.cluster = l.cluster
LEFT JOIN recipe_rows x ON x.month = m.month AND x.cluster = n.cluster AND x.feature = n.feature""",
)
def cluster_recipe(spark, sf):
    panel = inp.monthly(spark, sf).select("series", "month").join(brand_labelled(spark, sf), "series")
    long = indicators.recipe_long(panel, indicators.recipe_table(inp.external(spark, sf)))
    return long.withColumn("value", F.round("value", 6))


# --- inference-time shifts, naive and fills ---------------------------------------------------------------------


@query(
    "infer_shift",
    "SELECT series, date, split, "
    + cols({c: f"CASE WHEN split <> 'train' THEN lag({c}) OVER ({P}) ELSE {c} END" for c in ("Demand_lag_1", "Demand_roll_mean_7", "Month")})
    + f" FROM (SELECT series, date, split, {lag('dispatched', 1)} AS Demand_lag_1, {over('avg(dispatched)', -7, -1)} AS Demand_roll_mean_7, CAST(month(date) AS DOUBLE) AS Month FROM filled)",
)
def infer_shift(spark, sf):
    names = ["Demand_lag_1", "Demand_roll_mean_7", "Month"]
    return _shifted(spark, sf, names, 1, None)


def _shifted(spark, sf, names, rows, when):
    base = win.add(
        inp.filled(spark, sf),
        win.lags(d(), inp.SPLIT, (1,), "Demand"),
        win.roll_past(d(), inp.SPLIT, (7,), "Demand", ("mean",)),
        {"Month": F.month("date").cast("double")},
    )
    out = win.infer_shift(base, inp.SPLIT, names, rows, when)
    return out.select("series", "date", "split", *[F.round(n, 6).alias(n) for n in names])


@query(
    "infer_shift_30",
    "SELECT series, date, split, "
    + cols({c: f"CASE WHEN split = 'test' THEN lag({c}, 30) OVER ({P}) ELSE {c} END" for c in ("Demand_lag_1", "Demand_roll_mean_7", "Month")})
    + f" FROM (SELECT series, date, split, {lag('dispatched', 1)} AS Demand_lag_1, {over('avg(dispatched)', -7, -1)} AS Demand_roll_mean_7, CAST(month(date) AS DOUBLE) AS Month FROM filled)",
)
def infer_shift_30(spark, sf):
    return _shifted(spark, sf, ["Demand_lag_1", "Demand_roll_mean_7", "Month"], 30, F.col("split") == "test")


@query(
    "carry_last",
    """SELECT t.series, t.month, t.ordered, l.l1 AS order_lag_1, l.l2 AS order_lag_2, l.l3 AS order_lag_3, """
    + cols(
        {
            f"order_rolling_mean_{n}": f"CASE WHEN {over('count(t.ordered)', -n, -1, 'PARTITION BY t.series ORDER BY t.month')} >= {n} THEN {over('avg(t.ordered)', -n, -1, 'PARTITION BY t.series ORDER BY t.month')} ELSE l.m{n} END"
            for n in (3, 6)
        }
    )
    + """ FROM monthly_split t LEFT JOIN (SELECT series, max(ordered) FILTER (b = 1) AS l1, max(ordered) FILTER (b = 2) AS l2, max(ordered) FILTER (b = 3) AS l3,
  avg(ordered) FILTER (b <= 3) AS m3, avg(ordered) FILTER (b <= 6) AS m6 FROM (SELECT *, row_number() OVER (PARTITION BY series ORDER BY month DESC) AS b
  FROM monthly_split WHERE split = 'train') GROUP BY 1) l ON t.series = l.series WHERE t.split = 'test'""",
)
def carry_last(spark, sf):
    out = win.carry_last(inp.monthly_with_split(spark, sf), inp.MONTHLY, "ordered")
    names = [f"order_rolling_mean_{n}" for n in (3, 6)]
    return out.select("series", "month", "ordered", *[f"order_lag_{k}" for k in (1, 2, 3)], *[F.round(n, 6).alias(n) for n in names])


@query(
    "point_in_time",
    "SELECT series, month, "
    + cols(
        {
            **{f"order_lag_{k}": f"CASE WHEN row_number() OVER ({M}) > 6 THEN {lag('ordered', k, M)} END" for k in (1, 2, 3)},
            **{f"order_rolling_mean_{n}": f"CASE WHEN row_number() OVER ({M}) > 6 THEN {over('avg(ordered)', -n, -1, M)} END" for n in (3, 6)},
        }
    )
    + " FROM monthly",
)
def point_in_time(spark, sf):
    return inp.monthly(spark, sf).select("series", "month", *num.rounded(win.point_in_time(o(), inp.MONTHLY)))


@query(
    "fill_chain",
    f"""SELECT series, date, coalesce(last_value(x IGNORE NULLS) OVER ({C} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 0.0) AS ffill_zero,
  last_value(x IGNORE NULLS) OVER ({C} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS ffill, coalesce(x, 0.0) AS zero,
  {r('coalesce(x, avg(ordered) OVER (PARTITION BY series))')} AS mean_fill FROM (SELECT *, CASE WHEN dispatched > 0 THEN dispatched END AS x FROM filled)""",
)
def fill_chain(spark, sf):
    rows = inp.filled(spark, sf).withColumn("x", F.when(d() > 0, d()))
    return rows.select(
        "series",
        "date",
        win.fill_forward_zero("x", inp.SPEC).alias("ffill_zero"),
        win.fill_forward("x", inp.SPEC).alias("ffill"),
        F.coalesce("x", F.lit(0.0)).alias("zero"),
        F.round(win.fill_mean("x", "ordered", inp.SPEC), 6).alias("mean_fill"),
    )


# --- calendar and guards -------------------------------------------------------------------------------------------

_TWO_PI = "6.283185307179586"


def _wave(name: str, e: str, period: str) -> dict[str, str]:
    return {f"{name}_sin": f"sin({_TWO_PI} * {e} / {period})", f"{name}_cos": f"cos({_TWO_PI} * {e} / {period})"}


@query(
    "cal_parts",
    """SELECT series, date, CAST(month(date) AS INTEGER) AS Month, CAST(quarter(date) AS INTEGER) AS Quarter, CAST(weekofyear(date) AS INTEGER) AS WeekOfYear,
  CAST(isodow(date) - 1 AS INTEGER) AS DayOfWeek, CAST(day(date) AS INTEGER) AS DayOfMonth, CAST(dayofyear(date) AS INTEGER) AS DayOfYear, CAST(year(date) - 2022 AS INTEGER) AS Year FROM daily""",
)
def cal_parts(spark, sf):
    return inp.daily(spark, sf).select("series", "date", *num.named(cal.parts(F.col("date"))))


@query(
    "cal_cyclic",
    "SELECT series, date, "
    + cols(
        {
            **_wave("Month", "month(date)", "12"),
            **_wave("Quarter", "quarter(date)", "4"),
            **_wave("Week", "weekofyear(date)", "52"),
            **_wave("Day", "(isodow(date) - 1)", "7"),
            **_wave("DayOfYear", "dayofyear(date)", "365"),
            **_wave("Leap_DayOfYear", "dayofyear(date)", "365.25"),
        }
    )
    + " FROM daily",
)
def cal_cyclic(spark, sf):
    day = F.col("date")
    leap = {f"Leap_{n}": c for n, c in cal.cyclic(day, 365.25).items() if n.startswith("DayOfYear")}
    return inp.daily(spark, sf).select("series", "date", *num.rounded({**cal.cyclic(day), **leap}))


@query(
    "cal_flags",
    """SELECT series, date, CAST(isodow(date) >= 6 AS INTEGER) AS IsWeekend, CAST(day(date) = 1 AS INTEGER) AS IsMonthStart,
  CAST(date = last_day(date) AS INTEGER) AS IsMonthEnd, CAST(day(date) = 1 AND month(date) IN (1, 4, 7, 10) AS INTEGER) AS IsQuarterStart,
  CAST(date = last_day(date) AND month(date) IN (3, 6, 9, 12) AS INTEGER) AS IsQuarterEnd, CAST(dayofyear(date) = 1 AS INTEGER) AS IsYearStart,
  CAST(month(date) = 12 AND day(date) = 31 AS INTEGER) AS IsYearEnd FROM daily""",
)
def cal_flags(spark, sf):
    return inp.daily(spark, sf).select("series", "date", *num.named(cal.flags(F.col("date"))))


@query(
    "cal_misc",
    f"SELECT series, date, CAST(ceil(day(date) / 7.0) AS INTEGER) AS WeekOfMonth, {r('dayofyear(date) / 365.25::DOUBLE')} AS YearFraction FROM daily",
)
def cal_misc(spark, sf):
    columns = cal.misc(F.col("date"))
    return inp.daily(spark, sf).select("series", "date", columns["WeekOfMonth"].alias("WeekOfMonth"), F.round(columns["YearFraction"], 6).alias("YearFraction"))


@query(
    "num_guard",
    f"""SELECT series, date, {r("CASE WHEN isinf(x) THEN NULL ELSE x END")} AS inf_null, CASE WHEN isinf(x) THEN 1.7976931348623157e308::DOUBLE ELSE round(x, 6) END AS inf_max,
  greatest(dispatched - ordered, 0.0) AS clamped, abs(dispatched - ordered) AS absolute, {r('sqrt(abs(dispatched - ordered))')} AS root,
  CAST(sign(dispatched - ordered) AS DOUBLE) + 0.0 AS signum, {r('ordered / 7', 1)} AS rounded
FROM (SELECT *, CASE WHEN dispatched = 0 THEN 'Infinity'::DOUBLE ELSE ordered / dispatched END AS x FROM filled)""",
)
def num_guard(spark, sf):
    x = F.when(d() == 0, F.lit(float("inf"))).otherwise(F.try_divide(o(), d()))
    gap = d() - o()
    rows = inp.filled(spark, sf).withColumn("x", x)
    infinite = F.abs(F.col("x")) == float("inf")
    return rows.select(
        "series",
        "date",
        F.round(num.inf_to_null(F.col("x")), 6).alias("inf_null"),
        F.when(infinite, num.inf_to_max(F.col("x"))).otherwise(F.round("x", 6)).alias("inf_max"),
        num.clamp_nonneg(gap).alias("clamped"),
        F.abs(gap).alias("absolute"),
        F.round(F.sqrt(F.abs(gap)), 6).alias("root"),
        F.signum(gap).alias("signum"),
        F.round(o() / F.lit(7.0), 1).alias("rounded"),
    )
