"""Features of the monthly indicator table.

They are computed on the table with one row per month and reach the panel through
an equi-join on the day or month. ``by`` names split columns: with a split, the
indicator history starts afresh in each split.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F


def month_window(by: tuple[str, ...] = ()) -> WindowSpec:
    """Rows of the indicator table in month order. There is one row per month and
    split, so this partition stays a few hundred rows long."""
    return Window.partitionBy(*by).orderBy("month")


def ext_lags(names: tuple[str, ...], ks: tuple[int, ...], by: tuple[str, ...] = (), extra: Column | None = None) -> dict[str, Column]:
    """Indicator k months back; one month more where ``extra`` holds (inference rows)."""
    w = month_window(by)
    out: dict[str, Column] = {}
    for n in names:
        for k in ks:
            lagged = F.lag(n, k).over(w)
            if extra is not None:
                lagged = F.when(extra, F.lag(n, k + 1).over(w)).otherwise(lagged)
            out[f"{n}_lag_{k}m"] = lagged
    return out


def ext_rolls(
    names: tuple[str, ...],
    windows: tuple[int, ...],
    by: tuple[str, ...] = (),
    shift: int = 0,
    full: bool = True,
    stats: tuple[str, ...] = ("mean", "std"),
) -> dict[str, Column]:
    """Rolling mean and deviation, ``shift`` months back, over full or growing windows."""
    pick = {"mean": F.avg, "std": F.stddev_samp}
    out: dict[str, Column] = {}
    for n in names:
        for size in windows:
            f = month_window(by).rowsBetween(-(size - 1 + shift), -shift)
            for s in stats:
                c = pick[s](n).over(f)
                if full:
                    c = F.when(F.count(n).over(f) >= size, c)
                out[f"{n}_roll_{s}_{size}m"] = c
    return out


def ext_changes(names: tuple[str, ...], ks: tuple[int, ...] = (1, 2, 3), by: tuple[str, ...] = ()) -> dict[str, Column]:
    """Differences over k months and the deviation of the last three months."""
    w = month_window(by)
    three = w.rowsBetween(-2, 0)
    out: dict[str, Column] = {}
    for n in names:
        for k in ks:
            out[f"{n}_{k}m_change"] = F.col(n) - F.lag(n, k).over(w)
        out[f"{n}_volatility"] = F.when(F.count(n).over(three) >= 3, F.stddev_samp(n).over(three))
    return out


def ext_pct_changes(names: tuple[str, ...], periods: tuple[int, ...] = (3, 6), by: tuple[str, ...] = ()) -> dict[str, Column]:
    """Relative change over p months, one month back."""
    w = month_window(by)
    return {
        f"{n}_pct_change_{p}m": F.try_divide(F.lag(n, 1).over(w), F.lag(n, p + 1).over(w)) - F.lit(1.0)
        for n in names
        for p in periods
    }


# Monthly features by cluster; (plain columns, {column: rolling windows}).
RECIPES = {
    0: (("ICI",), {"PIB_CO": (3, 6), "ECG_DESP": (3, 6)}),
    1: (("OTOTAL_19",), {"TUAV": (3, 6), "VTOTAL_19": (3, 6)}),
    2: ((), {"ECG_DESP": (6, 12)}),
    3: (("ICI", "ISE_CO"), {"PIB_CO": (3, 6), "ECG_DESP": (3, 6), "TUAV": (3, 6)}),
}


def monthly_mean(rows: DataFrame, date: str, names: tuple[str, ...]) -> DataFrame:
    """Indicators that come several times a month as the mean of their month."""
    return rows.groupBy(F.trunc(date, "month").alias("month")).agg(*[F.avg(n).alias(n) for n in names])


def recipe_columns(cluster: int) -> list[str]:
    plain, rolled = RECIPES[cluster]
    out = [c for n, sizes in rolled.items() for c in (n, *(f"{n}_{s}M" for s in sizes))]
    return out + list(plain) + ["Month", "Quarter"]


def recipe_table(external: DataFrame) -> DataFrame:
    """All recipe features of every month, computed once."""
    sizes: dict[str, set[int]] = {}
    for _, rolled in RECIPES.values():
        for n, s in rolled.items():
            sizes.setdefault(n, set()).update(s)
    means = {
        f"{n}_{s}M": F.avg(n).over(month_window().rowsBetween(-(s - 1), 0))
        for n, group in sizes.items()
        for s in sorted(group)
    }
    return external.withColumns(means)


def _recipe_value(name: str) -> Column:
    if name in ("Month", "Quarter"):
        return {"Month": F.month, "Quarter": F.quarter}[name]("month").cast("double")
    return F.col(name).cast("double")


def recipe_long(panel: DataFrame, features: DataFrame, cluster: str = "cluster") -> DataFrame:
    """(series, month, cluster, feature, value): each series with the features of its cluster.

    Months without indicators stay; their values are null.
    """
    pairs = []
    for c in RECIPES:
        pairs.append(
            F.when(
                F.col(cluster) == c,
                F.array(
                    *[
                        F.struct(F.lit(n).alias("feature"), _recipe_value(n).alias("value"))
                        for n in recipe_columns(c)
                    ]
                ),
            )
        )
    joined = panel.join(features, "month", "left")
    return joined.select("series", "month", cluster, F.inline(F.coalesce(*pairs)))
