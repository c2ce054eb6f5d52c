"""Window features.

Each function returns named columns; put any number of them into one ``select``.
Columns over the same (partition, order) share one exchange and one sort. Frames
count rows, so gap-fill first when rows should mean days. Once rows are summed per
series and day, a partition is no longer than the calendar, whatever share of the
raw rows one series has.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from seriesloom.functions.numeric import flag, ratio, ratio_eps
from seriesloom.spec import SeriesSpec

# Lag and window lists of the forecast variants.
LAGS = {
    "main": (1, 2, 3, 7, 14, 30),
    "short": (5, 7, 14, 30, 60),
    "long": (30, 60, 90),
    "volatile": (1, 2, 3, 7, 14, 21, 30),
    "weekly": (1, 2, 3, 7, 14, 21, 28),
    "spikes": (1, 2, 3, 5),
    "far": (1, 2, 3, 7, 14, 30, 60, 90, 180),
    "month_3": (1, 2, 3),
    "month_6": (1, 2, 3, 4, 5, 6),
    "month_12": (1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11, 12),
    "month_sparse": (1, 2, 3, 6, 12),
}
ROLLS = {"main": (7, 14, 30), "short": (5, 7, 14, 30, 60), "order_freq": (7, 14, 30, 60, 90)}

_STATS = {
    "mean": F.avg,
    "std": F.stddev_samp,
    "min": F.min,
    "max": F.max,
    "var": F.var_samp,
    "sum": F.sum,
}


def add(df: DataFrame, *features: dict[str, Column]) -> DataFrame:
    """Append feature columns in one projection."""
    columns: dict[str, Column] = {}
    for group in features:
        columns.update(group)
    return df.withColumns(columns)


def _framed(value: Column, frame: WindowSpec, stats: tuple[str, ...], name: str, suffix: str) -> dict[str, Column]:
    return {f"{name}_{s}_{suffix}": _STATS[s](value).over(frame) for s in stats}


def lags(value: Column, spec: SeriesSpec, ks: tuple[int, ...], name: str) -> dict[str, Column]:
    """Value k rows back."""
    return {f"{name}_lag_{k}": F.lag(value, k).over(spec.window()) for k in ks}


def lag_flags(value: Column, spec: SeriesSpec, ks: tuple[int, ...], name: str) -> dict[str, Column]:
    """1 if the value k rows back is positive."""
    return {f"{name}_positive_lag_{k}": flag(F.lag(value, k).over(spec.window()) > 0) for k in ks}


def roll_past(
    value: Column, spec: SeriesSpec, windows: tuple[int, ...], name: str, stats: tuple[str, ...] = ("mean", "std")
) -> dict[str, Column]:
    """Statistics of the n rows before the current one; one row is enough."""
    out: dict[str, Column] = {}
    for n in windows:
        out.update(_framed(value, spec.frame(-n, -1), stats, f"{name}_roll", str(n)))
    return out


def roll_past_cv(value: Column, spec: SeriesSpec, windows: tuple[int, ...], name: str) -> dict[str, Column]:
    """Deviation over mean of the n rows before the current one."""
    return {
        f"{name}_roll_cv_{n}": ratio(
            F.stddev_samp(value).over(spec.frame(-n, -1)), F.avg(value).over(spec.frame(-n, -1))
        )
        for n in windows
    }


def zero_count(value: Column, spec: SeriesSpec, windows: tuple[int, ...], name: str) -> dict[str, Column]:
    """Zero rows among the n rows before the current one; null on the first row."""
    return {f"{name}_zeros_{n}": F.sum((value == 0).cast("int")).over(spec.frame(-n, -1)) for n in windows}


def roll_shift(
    value: Column,
    spec: SeriesSpec,
    windows: tuple[int, ...],
    name: str,
    shift: int = 1,
    min_rows: int | None = 1,
    stats: tuple[str, ...] = ("mean", "std"),
) -> dict[str, Column]:
    """Trailing windows that end ``shift`` rows back.

    ``min_rows=None`` asks for full windows: null until n values are there.
    """
    out: dict[str, Column] = {}
    for n in windows:
        frame = spec.frame(-(n + shift - 1), -shift)
        need = n if min_rows is None else min_rows
        enough = F.count(value).over(frame) >= need
        for key, column in _framed(value, frame, stats, f"{name}_shift{shift}", str(n)).items():
            out[key] = F.when(enough, column) if need > 1 else column
    return out


def roll_full(
    value: Column, spec: SeriesSpec, windows: tuple[int, ...], name: str, stats: tuple[str, ...] = ("mean", "std")
) -> dict[str, Column]:
    """Trailing windows with the current row, null until n values are there."""
    out: dict[str, Column] = {}
    for n in windows:
        frame = spec.frame(-(n - 1), 0)
        enough = F.count(value).over(frame) >= n
        for key, column in _framed(value, frame, stats, f"{name}_full", str(n)).items():
            out[key] = F.when(enough, column)
    return out


def roll_current(
    value: Column, spec: SeriesSpec, windows: tuple[int, ...], name: str, stats: tuple[str, ...] = ("mean", "std")
) -> dict[str, Column]:
    """Trailing windows with the current row, one row is enough.

    Over the target this lets the target into its own features; ``roll_past`` is
    the leak-free form.
    """
    out: dict[str, Column] = {}
    for n in windows:
        out.update(_framed(value, spec.frame(-(n - 1), 0), stats, f"{name}_cur", str(n)))
    return out


def roll_range_cv(value: Column, spec: SeriesSpec, windows: tuple[int, ...], name: str, eps: float = 1e-6) -> dict[str, Column]:
    """Range, and deviation over (mean + eps), of the trailing window with the current row."""
    out: dict[str, Column] = {}
    for n in windows:
        f = spec.frame(-(n - 1), 0)
        out[f"{name}_range_{n}"] = F.max(value).over(f) - F.min(value).over(f)
        out[f"{name}_cv_{n}"] = ratio_eps(F.stddev_samp(value).over(f), F.avg(value).over(f), eps)
    return out


def roll_quantiles(
    value: Column, spec: SeriesSpec, windows: tuple[int, ...], name: str, probs: tuple[float, ...] = (0.25, 0.75)
) -> dict[str, Column]:
    """Exact quantiles of the full window that ends one row back."""
    out: dict[str, Column] = {}
    for n in windows:
        f = spec.frame(-n, -1)
        enough = F.count(value).over(f) >= n
        for p in probs:
            out[f"{name}_q{int(p * 100)}_{n}"] = F.when(enough, F.percentile(value, p).over(f))
    return out


def roll_median(value: Column, spec: SeriesSpec, windows: tuple[int, ...], name: str, eps: float = 1e-8) -> dict[str, Column]:
    """Median, and deviation over (median + eps), of the trailing window with the current row."""
    out: dict[str, Column] = {}
    for n in windows:
        f = spec.frame(-(n - 1), 0)
        median = F.percentile(value, 0.5).over(f)
        out[f"{name}_roll_median_{n}"] = median
        out[f"{name}_volatility_{n}"] = ratio_eps(F.stddev_samp(value).over(f), median, eps)
    return out


def roll_cv_eps(value: Column, spec: SeriesSpec, windows: tuple[int, ...], name: str, eps: float = 1e-8) -> dict[str, Column]:
    out: dict[str, Column] = {}
    for n in windows:
        f = spec.frame(-(n - 1), 0)
        out[f"{name}_roll_cv_{n}"] = ratio_eps(F.stddev_samp(value).over(f), F.avg(value).over(f), eps)
    return out


def expanding(value: Column, spec: SeriesSpec, name: str, stats: tuple[str, ...] = ("mean", "std", "sum")) -> dict[str, Column]:
    """Statistics of all rows up to the current one."""
    grown = spec.frame(Window.unboundedPreceding, 0)
    return {f"{name}_expanding_{s}": _STATS[s](value).over(grown) for s in stats}


def roll_or_expand(
    value: Column,
    spec: SeriesSpec,
    windows: tuple[int, ...],
    name: str,
    training: Column,
    stats: tuple[str, ...] = ("mean", "std"),
) -> dict[str, Column]:
    """Trailing window on training rows, expanding window elsewhere.

    ``spec`` must carry the split in its history so that neither crosses it.
    """
    grown = spec.frame(Window.unboundedPreceding, 0)
    out: dict[str, Column] = {}
    for n in windows:
        f = spec.frame(-(n - 1), 0)
        for s in stats:
            out[f"{name}_mode_{s}_{n}"] = F.when(training, _STATS[s](value).over(f)).otherwise(
                _STATS[s](value).over(grown)
            )
    return out


def diff(value: Column, spec: SeriesSpec, k: int = 1) -> Column:
    return value - F.lag(value, k).over(spec.window())


def diff_mean(diff_column: Column, spec: SeriesSpec, windows: tuple[int, ...], name: str) -> dict[str, Column]:
    """Mean of first differences over the trailing window (``diff_column`` holds the differences)."""
    return {f"{name}_accel_{n}": F.avg(diff_column).over(spec.frame(-(n - 1), 0)) for n in windows}


def diff_minus_mean(diff_column: Column, spec: SeriesSpec, windows: tuple[int, ...], name: str) -> dict[str, Column]:
    """Difference minus its mean over the full trailing window."""
    out: dict[str, Column] = {}
    for n in windows:
        f = spec.frame(-(n - 1), 0)
        out[f"{name}_jolt_{n}"] = F.when(
            F.count(diff_column).over(f) >= n, diff_column - F.avg(diff_column).over(f)
        )
    return out


def momentum(value: Column, spec: SeriesSpec, windows: tuple[int, ...], name: str, eps: float = 1e-8) -> dict[str, Column]:
    """Four ways to set a value against its trailing mean.

    plain: x - mean; z: the same over the deviation (full windows); lagged:
    previous x - mean; relative: (previous x - mean) / (mean + eps).
    """
    out: dict[str, Column] = {}
    previous = F.lag(value, 1).over(spec.window())
    for n in windows:
        f = spec.frame(-(n - 1), 0)
        mean, std = F.avg(value).over(f), F.stddev_samp(value).over(f)
        out[f"{name}_momentum_{n}"] = value - mean
        out[f"{name}_momentum_z_{n}"] = F.when(F.count(value).over(f) >= n, ratio(value - mean, std))
        out[f"{name}_momentum_lag_{n}"] = previous - mean
        out[f"{name}_rel_change_{n}"] = ratio_eps(previous - mean, mean, eps)
    return out


def roll_corr(x: Column, y: Column, spec: SeriesSpec, n: int = 6) -> Column:
    """Correlation of two columns over the full trailing window, null when one is constant."""
    f = spec.frame(-(n - 1), 0)
    both = x.isNotNull() & y.isNotNull()
    px, py = F.when(both, x), F.when(both, y)
    sd = F.stddev_samp(px).over(f) * F.stddev_samp(py).over(f)
    return F.when(F.count(px).over(f) >= n, F.try_divide(F.covar_samp(x, y).over(f), sd))


def direction_changes(
    df: DataFrame, spec: SeriesSpec, windows: tuple[int, ...], name: str, training: Column | None = None
) -> DataFrame:
    """Share of rows in the trailing window whose move differs in sign from the row before.

    The oldest row of a window has nothing before it and always counts. The first
    row of a series has no move and yields null. Where ``training`` does not hold
    the window is expanding.
    """
    w = spec.window()
    signed = df.withColumn("_sign", F.signum(diff(F.col(spec.target), spec)))
    flagged = signed.withColumn(
        "_changed", flag(F.coalesce(F.col("_sign") != F.lag("_sign", 1).over(w), F.lit(True)))
    )
    grown = spec.frame(Window.unboundedPreceding, 0)
    out: dict[str, Column] = {}
    for n in windows:
        frame = spec.frame(-(n - 1), 0)
        rows = F.count(F.lit(1)).over(frame)
        inside = F.sum("_changed").over(frame)
        later = F.sum("_changed").over(spec.frame(-(n - 2), 0)) if n > 1 else F.lit(0)
        rolled = F.when(rows == n, later + 1).otherwise(inside) / rows
        if training is not None:
            whole = F.sum("_changed").over(grown) / F.count(F.lit(1)).over(grown)
            rolled = F.when(training, rolled).otherwise(whole)
            frame_seen = F.count("_sign").over(grown)
        else:
            frame_seen = F.count("_sign").over(frame)
        out[f"{name}_direction_{n}"] = F.when(frame_seen >= 1, rolled)
    return flagged.withColumns(out).drop("_sign", "_changed")


def pct_change(value: Column, spec: SeriesSpec, periods: tuple[int, ...], name: str) -> dict[str, Column]:
    """x / x p rows back - 1; null when the earlier value is zero."""
    return {
        f"{name}_pct_change_{p}": F.try_divide(value, F.lag(value, p).over(spec.window())) - F.lit(1.0)
        for p in periods
    }


def yoy_ratio(value: Column, spec: SeriesSpec, name: str, p: int = 12) -> dict[str, Column]:
    return {f"{name}_yoy_ratio": F.try_divide(value, F.lag(value, p).over(spec.window()))}


def last_year(value: Column, spec: SeriesSpec, name: str, testing: Column | None = None) -> dict[str, Column]:
    """The same day, week, month and quarter one year (365 rows) ago.

    On rows where ``testing`` holds, the week and month windows leave out their
    newest row: they cover the n rows before it instead.
    """

    def mean(end: int, n: int, slide: int) -> Column:
        f = spec.frame(-(end + n - 1 + slide), -(end + slide))
        return F.when(F.count(value).over(f) >= n, F.avg(value).over(f))

    def by_mode(end: int, n: int) -> Column:
        if testing is None:
            return mean(end, n, 0)
        return F.when(testing, mean(end, n, 1)).otherwise(mean(end, n, 0))

    day = F.lag(value, 365).over(spec.window())
    return {
        f"{name}_same_day_last_year": day,
        f"{name}_same_day_last_year_diff": F.lag(value, 1).over(spec.window()) - day,
        f"{name}_same_week_last_year": by_mode(364, 7),
        f"{name}_same_month_last_year": by_mode(365, 30),
        f"{name}_same_quarter_last_year": mean(365, 90, 0),
    }


def order_ratio_lags(order: Column, target: Column, spec: SeriesSpec, ks: tuple[int, ...], name: str, eps: float | None = None) -> dict[str, Column]:
    """Order over dispatch, both k rows back; null on a zero dispatch unless eps is given."""
    w = spec.window()
    out: dict[str, Column] = {}
    for k in ks:
        a, b = F.lag(order, k).over(w), F.lag(target, k).over(w)
        out[f"{name}_ratio_lag_{k}"] = ratio(a, b) if eps is None else ratio_eps(a, b, eps)
    return out


def fulfilment(dispatched: Column, ordered: Column) -> Column:
    """Dispatched over ordered in [0, 1]; 1 where nothing was ordered."""
    share = F.when(ordered == 0, F.lit(1.0)).otherwise(F.try_divide(dispatched, ordered))
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), share))


def fulfil_rates(dispatched: Column, ordered: Column, spec: SeriesSpec) -> dict[str, Column]:
    """Fulfilment of the same row and of the row before.

    The lagged form treats a missing earlier row like the division does: null.
    """
    w = spec.window()
    d, o = F.lag(dispatched, 1).over(w), F.lag(ordered, 1).over(w)
    return {
        "Order_Fulfillment_Rate": fulfilment(dispatched, ordered),
        "Order_Fulfillment_Rate_lag_1": F.when(o.isNotNull(), fulfilment(d, o)),
    }


def order_dispatch_gap(dispatched: Column, ordered: Column, spec: SeriesSpec, training: Column) -> dict[str, Column]:
    """Dispatch minus order: of the row before on training rows; next dispatch minus
    this order elsewhere (this looks one row ahead and is kept for comparison only).
    The leak-free form uses the row before everywhere."""
    w = spec.window()
    past = F.lag(dispatched, 1).over(w) - F.lag(ordered, 1).over(w)
    ahead = F.lead(dispatched, 1).over(w) - ordered
    return {
        "Order_Dispatch_Lag": F.coalesce(F.when(training, past).otherwise(ahead), F.lit(0.0)),
        "Order_Dispatch_Lag_past": F.coalesce(past, F.lit(0.0)),
    }


def demand_shock(value: Column, spec: SeriesSpec, n: int = 30, eps: float = 1e-6) -> Column:
    """Distance from the trailing mean in (deviation + eps), absolute."""
    f = spec.frame(-(n - 1), 0)
    return F.abs(ratio_eps(value - F.avg(value).over(f), F.stddev_samp(value).over(f), eps))


def infer_shift(df: DataFrame, spec: SeriesSpec, features: list[str], rows: int = 1, when: Column | None = None) -> DataFrame:
    """Features moved down by ``rows`` where ``when`` holds (default: outside train)."""
    w = spec.window()
    cond = (F.col("split") != "train") if when is None else when
    return df.withColumns({f: F.when(cond, F.lag(f, rows).over(w)).otherwise(F.col(f)) for f in features})


def carry_last(df: DataFrame, spec: SeriesSpec, value: str, lags_: tuple[int, ...] = (1, 2, 3), windows: tuple[int, ...] = (3, 6)) -> DataFrame:
    """Test features from what was known when training ended.

    Lags are frozen at the last train values. Rolling means start from the last
    full train window and step on earlier test rows once there are enough.
    """
    keys = list(spec.keys)
    newest = Window.partitionBy(*keys).orderBy(F.desc(spec.time))
    train = df.where(F.col("split") == "train").withColumn("_back", F.row_number().over(newest))
    tail = train.where(F.col("_back") <= max(*lags_, *windows))
    last = tail.groupBy(*keys).agg(
        *[F.max(F.when(F.col("_back") == k, F.col(value))).alias(f"order_lag_{k}") for k in lags_],
        *[
            F.when(
                F.count(F.when(F.col("_back") <= n, 1)) == n, F.avg(F.when(F.col("_back") <= n, F.col(value)))
            ).alias(f"_mean_{n}")
            for n in windows
        ],
    )
    test = df.where(F.col("split") == "test").join(last, keys, "left")
    w = Window.partitionBy(*keys).orderBy(spec.time)
    means = {
        f"order_rolling_mean_{n}": F.when(
            F.count(value).over(w.rowsBetween(-n, -1)) >= n, F.avg(value).over(w.rowsBetween(-n, -1))
        ).otherwise(F.col(f"_mean_{n}"))
        for n in windows
    }
    return test.withColumns(means).drop(*[f"_mean_{n}" for n in windows])


def point_in_time(value: Column, spec: SeriesSpec, name: str = "order") -> dict[str, Column]:
    """Lags 1-3 and means of the last 3 and 6 earlier rows, null before the 7th row."""
    ready = F.row_number().over(spec.window()) > 6
    columns = {
        **{f"{name}_lag_{k}": F.lag(value, k).over(spec.window()) for k in (1, 2, 3)},
        **{f"{name}_rolling_mean_{n}": F.avg(value).over(spec.frame(-n, -1)) for n in (3, 6)},
    }
    return {n: F.when(ready, c) for n, c in columns.items()}


def naive(value: Column, spec: SeriesSpec) -> Column:
    """The value of the previous row as forecast."""
    return F.lag(value, 1).over(spec.window())


def fill_forward(column: str, spec: SeriesSpec) -> Column:
    return F.last(column, ignorenulls=True).over(spec.frame(Window.unboundedPreceding, 0))


def fill_forward_zero(column: str, spec: SeriesSpec) -> Column:
    return F.coalesce(fill_forward(column, spec), F.lit(0.0))


def fill_mean(column: str, mean_of: str, spec: SeriesSpec) -> Column:
    """Missing values take the series mean of another column."""
    return F.coalesce(F.col(column), F.avg(mean_of).over(spec.whole()))
