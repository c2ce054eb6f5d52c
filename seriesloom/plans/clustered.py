"""The clustered batch from end to end: profile, cluster, features, one model per
cluster, scores at three grains, partitioned results.

Every stage is a keyed plan over all series. What later stages read more than once
(profiles, the feature matrix) is materialised in the shared folder.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seriesloom.functions import calendar as cal
from seriesloom.functions.text import INDICATORS
from seriesloom.operators import align, cleanse, cluster, indicators, models, resample, score, split
from seriesloom.operators import profile as prof
from seriesloom.operators import window as win
from seriesloom.plans.naive import GRAINS
from seriesloom.session import cut_lineage
from seriesloom.sources import ledger, sinks, tables
from seriesloom.spec import SeriesSpec


@dataclass(frozen=True)
class Horizon:
    """What a forecast horizon changes: features, how far test rows are moved, the split, labels and learner."""

    lags: tuple[int, ...] = win.LAGS["main"]
    rolls: tuple[int, ...] = win.ROLLS["main"]
    roll_shift: int = 1
    order_lags: tuple[int, ...] = (1, 2, 3, 7, 14)
    ratio_lags: tuple[int, ...] = (1, 2, 3, 7)
    indicator_lags: tuple[int, ...] = (1, 2, 3)
    infer_rows: int = 1
    #: Rows that the features of the test slice are moved further down.
    test_rows: int = 0
    #: The month before the test slice stays unused.
    gap: bool = False
    #: Rows by which the actual values of a roll-up are moved down.
    actual_shift: tuple[tuple[str, int], ...] = ()
    month_label: str = "month_end"
    learner: str = "finished"

    def split(self, day: Column, test_from: str) -> Column:
        return split.gap_split(day, F.add_months(F.lit(test_from).cast("date"), -1)) if self.gap else split.cutoff_split(day, test_from)


MAIN = Horizon()
# The lists of the two other horizons.
SHORT = Horizon(
    lags=win.LAGS["short"],
    rolls=win.ROLLS["short"],
    order_lags=(5, 7, 14, 30, 60),
    ratio_lags=(5, 7),
    indicator_lags=tuple(range(1, 12)),
    month_label="month_start",
    learner="second",
)
LONG = Horizon(
    lags=win.LAGS["long"],
    rolls=(30, 60, 90),
    roll_shift=30,
    order_lags=(30, 60, 90),
    ratio_lags=(),
    test_rows=30,
    gap=True,
    actual_shift=(("weekly", 7), ("monthly", 1)),
    month_label="month_start",
    learner="second",
)


def rolled_up(pairs: DataFrame, spec: SeriesSpec, horizon: Horizon) -> DataFrame:
    """Daily pairs with their weekly and monthly sums; roll-ups sum actual values that are moved down first."""
    moves = dict(horizon.actual_shift)
    out = []
    for grain, rule in {**GRAINS, "monthly": horizon.month_label}.items():
        rows = pairs
        if grain in moves:
            rows = pairs.withColumn("actual", F.lag("actual", moves[grain]).over(spec.window()))
        out.append(resample.stack_grains(rows, spec, ["actual", "predicted"], {grain: rule}))
    return align.stack(out)


def clusters(orders: DataFrame, external: DataFrame, since: str, n_init: int = cluster.FINAL["n_init"], k: int | None = None) -> DataFrame:
    """(series, cluster): profiles of the monthly roll-up, scaled by group, k by sweep unless given."""
    monthly = tables.monthly_rollup(split.since(orders, "date", since))
    table = cut_lineage(prof.profile(align.join_month(monthly, external)).na.drop())
    vectors = cluster.assemble(cleanse.weight_groups(table), cleanse.GROUP_COLUMNS)
    if k is None:
        k = cluster.choose_k(cluster.sweep(vectors, cleanse.GROUP_COLUMNS)).first()["k"]
    model = cluster.kmeans(vectors, k, n_init, cluster.FINAL["max_iter"], cluster.FINAL["tol"])
    return cluster.label(vectors, model, F.col("avg_monthly_demand")).select("series", "cluster")


def feature_matrix(panel: DataFrame, external: DataFrame, spec: SeriesSpec, test_from: str, horizon: Horizon = MAIN) -> tuple[DataFrame, list[str]]:
    """Features of every series, history restarting in each split, and their names.

    All window features share the partition by (series, split) and its order. Rows
    outside train are moved down so that no feature knows its own day.
    """
    local = spec.with_history("split")
    target, order, day = F.col(spec.target), F.col(spec.order), F.col(spec.time)
    cyclic = {n: c for n, c in cal.cyclic(day).items() if n.startswith(("Month", "Day_"))}
    parts = {n: c for n, c in cal.parts(day).items() if n not in ("DayOfYear", "Year")}
    own = {
        **win.lags(target, local, horizon.lags, "Demand"),
        **win.roll_shift(target, local, horizon.rolls, "Demand", horizon.roll_shift),
        **parts,
        **cyclic,
        **win.lags(order, local, horizon.order_lags, "Order"),
        **win.order_ratio_lags(order, target, local, horizon.ratio_lags, "Order"),
    }
    months = external.withColumn("split", horizon.split(F.col("month"), test_from)).where("split IS NOT NULL")
    lagged = indicators.ext_lags(INDICATORS, horizon.indicator_lags, ("split",), F.col("split") != "train")
    by_day = align.month_to_days(
        months.select("split", "month", *[c.alias(n) for n, c in lagged.items()]), list(lagged), ("split",)
    )
    names = [*own, *lagged]
    wide = align.join_days(win.add(panel, own), by_day, ("split",), spec.time)
    moved = win.infer_shift(wide, local, names, horizon.infer_rows)
    if horizon.test_rows:
        moved = win.infer_shift(moved, local, names, horizon.test_rows, F.col("split") == "test")
    return moved.select(*panel.columns, *[F.coalesce(F.col(n).cast("double"), F.lit(0.0)).alias(n) for n in names]), names


def learned(rows: DataFrame, spec: SeriesSpec, labels: list[int], learner: str, errors: dict[int, str] | None = None) -> DataFrame:
    """Test predictions of the finished boosted models, of the second learner, or of the mean of two learners."""
    keys = ["series", spec.time]
    if learner == "ensemble":
        one, two = (models.panel_by_cluster(rows, models.ENSEMBLE, spec.target, keys, labels, kind, errors) for kind in ("boosted", "second"))
        return models.ensemble_mean(one, two, keys)
    configs, kind = {"finished": (models.FINISHED, "boosted"), "second": (models.SECOND, "second")}[learner]
    return models.panel_by_cluster(rows, configs, spec.target, keys, labels, kind, errors)


def run(
    orders: DataFrame,
    external: DataFrame,
    start: str | Column,
    end: str | Column,
    test_from: str,
    assignments: DataFrame,
    horizon: Horizon = MAIN,
    out: str | None = None,
    learner: str | None = None,
) -> dict[str, DataFrame]:
    """Forecasts and scores of all series, written under ``out`` when it is given, with a ledger of what could be fitted."""
    spec = SeriesSpec()
    panel = align.gap_fill(orders, spec, [spec.target, spec.order], start, end)
    panel = panel.withColumn("split", horizon.split(spec.t(), test_from)).where("split IS NOT NULL")
    features, names = feature_matrix(panel, external, spec, test_from, horizon)
    joined = features.join(assignments, "series", "left").fillna({"cluster": 3})
    vectors = models.vectors(joined, names)
    rows = cut_lineage(vectors.select("series", spec.time, "split", "cluster", spec.target, "features"))
    labels = sorted(r["cluster"] for r in rows.select("cluster").distinct().collect())
    errors: dict[int, str] = {}
    predicted = learned(rows, spec, labels, learner or horizon.learner, errors)
    forecasts = cut_lineage(rolled_up(cut_lineage(predicted), spec, horizon))
    scores = score.score_main(forecasts, ["series", "grain"])
    if out is not None:
        sinks.write_forecast(forecasts, f"{out}/forecasts")
        sinks.write_scores(scores, f"{out}/scores")
        sinks.write_clusters(assignments, f"{out}/clusters")
        # One text per failed cluster.
        error = F.coalesce(*[F.when(F.col("cluster") == c, F.lit(e)) for c, e in errors.items()], F.lit(None).cast("string"))
        ledger.record(rows.select("series", "cluster").distinct().select("series", error.alias("error")), f"{out}/ledger", "all", "fit")
    return {"forecasts": forecasts, "scores": scores}
