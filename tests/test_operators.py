"""Operators on small hand-made tables, against pandas, numpy or plain loops."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from seriesloom.functions import calendar as cal
from seriesloom.functions import numeric as num
from seriesloom.functions import text
from seriesloom.operators import align, cleanse, cluster, lumpy, models, recursive, report, resample, score, split
from seriesloom.operators import profile as prof
from seriesloom.operators import window as win
from seriesloom.operators.quantiles import exact_quantiles
from seriesloom.session import scratch_path
from seriesloom.sources import files, sinks, tables
from seriesloom.spec import SeriesSpec

SPEC = SeriesSpec()
DAY = dt.timedelta(days=1)


def series_frame(n=120, seed=3):
    """Three series: busy, sparse and all zero."""
    rng = np.random.default_rng(seed)
    start = dt.date(2022, 1, 3)
    rows = []
    for name, share in (("a", 0.9), ("b", 0.3), ("c", 0.0)):
        for i in range(n):
            hit = rng.random() < share
            d = float(rng.integers(1, 40)) if hit else 0.0
            o = float(rng.integers(1, 40)) if rng.random() < share else 0.0
            rows.append((name, start + i * DAY, d, o))
    return pd.DataFrame(rows, columns=["series", "date", "dispatched", "ordered"])


@pytest.fixture(scope="module")
def panel(spark):
    return spark.createDataFrame(series_frame()).cache()


def by_series(df, column):
    rows = df.orderBy("series", "date").toPandas()
    return {k: g[column].reset_index(drop=True) for k, g in rows.groupby("series")}


def same(a, b, tol=1e-9):
    np.testing.assert_allclose(pd.Series(a, dtype=float), pd.Series(b, dtype=float), rtol=tol, atol=tol, equal_nan=True)


def test_gap_fill_gives_every_day_once(spark):
    rows = [("a", dt.date(2022, 1, 5), 3.0, 1.0), ("a", dt.date(2022, 1, 5), 2.0, 0.0), ("a", dt.date(2022, 1, 9), 1.0, 1.0), ("b", dt.date(2022, 1, 1), 4.0, 4.0)]
    raw = spark.createDataFrame(rows, "series string, date date, dispatched double, ordered double")
    daily = tables.daily_totals(raw, ["series"], "date", ["dispatched", "ordered"])
    out = align.gap_fill(daily, SPEC, ["dispatched", "ordered"], "2022-01-01", "2022-01-10").toPandas()
    assert len(out) == 20 and out.groupby(["series", "date"]).size().max() == 1
    a = out[out.series == "a"].set_index("date").dispatched
    assert a[dt.date(2022, 1, 5)] == 5.0 and a.sum() == 6.0 and a[dt.date(2022, 1, 10)] == 0.0
    own = align.gap_fill(daily, SPEC, ["dispatched", "ordered"]).groupBy("series").count().toPandas().set_index("series")["count"]
    assert own["a"] == 5 and own["b"] == 1


def test_past_frames_ignore_the_current_row(spark, panel):
    bumped = panel.withColumn("dispatched", F.when(F.col("date") == "2022-02-20", 9999.0).otherwise(F.col("dispatched")))
    columns = win.roll_past(F.col("dispatched"), SPEC, (7, 30), "D", ("mean", "std", "min", "max"))
    pick = lambda df: df.select("series", "date", *num.named(columns)).where("date <= '2022-02-20'").orderBy("series", "date").toPandas()
    pd.testing.assert_frame_equal(pick(panel), pick(bumped))


def test_rolling_features_match_pandas(panel):
    d = F.col("dispatched")
    columns = {
        **win.roll_past(d, SPEC, (7,), "p"),
        **win.roll_shift(d, SPEC, (5,), "s", 3, None),
        **win.roll_full(d, SPEC, (6,), "f"),
        **win.roll_quantiles(d, SPEC, (7,), "q"),
    }
    got = panel.select("series", "date", *num.named(columns))
    for name, values in by_series(panel, "dispatched").items():
        v = values.astype(float)
        same(by_series(got, "p_roll_mean_7")[name], v.rolling(7, min_periods=1, closed="left").mean())
        same(by_series(got, "p_roll_std_7")[name], v.rolling(7, min_periods=1, closed="left").std(), 1e-7)
        same(by_series(got, "s_shift3_mean_5")[name], v.shift(3).rolling(5).mean())
        same(by_series(got, "f_full_std_6")[name], v.rolling(6).std(), 1e-7)
        same(by_series(got, "q_q25_7")[name], v.shift(1).rolling(7).quantile(0.25))


def test_direction_changes_match_rolling_apply(panel):
    got = win.direction_changes(panel, SPEC, (2, 4), "D")
    for name, values in by_series(panel, "dispatched").items():
        sign = np.sign(values.astype(float).diff())
        for n in (2, 4):
            want = sign.rolling(n, min_periods=1).apply(lambda x: (x != x.shift(1)).sum() / len(x))
            same(by_series(got, f"D_direction_{n}")[name], want)


@pytest.mark.parametrize("adjust", [False, True])
def test_ema_matches_the_recursion(panel, adjust):
    got = by_series(recursive.ema(panel, SPEC, "dispatched", (7,), "e", adjust), "e_7")
    for name, values in by_series(panel, "dispatched").items():
        alpha, top, weight, want = 2 / 8, 0.0, 0.0, [np.nan]
        for i, x in enumerate(values[:-1]):
            if adjust:
                top, weight = x + (1 - alpha) * top, 1 + (1 - alpha) * weight
                want.append(top / weight)
            else:
                top = x if i == 0 else alpha * x + (1 - alpha) * top
                want.append(top)
        same(got[name], want)


def test_croston_matches_a_loop(panel):
    got = by_series(recursive.croston(panel, SPEC, "ordered"), "croston")
    for name, values in by_series(panel, "ordered").items():
        size, gap, want = values[0], 1.0, [0.0]
        for x in values[1:]:
            if x > 0:
                size = 0.4 * x + 0.6 * size
            else:
                gap += 1
            want.append(size / gap)
        same(got[name], want)


def test_order_gap_and_running_zeros(panel):
    out = panel.withColumns({"gap": lumpy.days_since_order(F.col("ordered"), SPEC), "zeros": lumpy.cumulative_zeros(F.col("ordered"), SPEC)})
    for name, values in by_series(panel, "ordered").items():
        last, zeros, gaps, runs = None, 0, [], []
        for i, x in enumerate(values):
            last = i if x > 0 else last
            zeros += x <= 0
            gaps.append(np.nan if last is None else i - last)
            runs.append(0 if x > 0 else zeros)
        same(by_series(out, "gap")[name], gaps)
        same(by_series(out, "zeros")[name], runs)


@pytest.mark.parametrize("rule,alias", [("week_sun", "W"), ("week_mon", "W-MON"), ("month_end", "ME"), ("month_start", "MS")])
def test_period_labels_match_pandas(panel, rule, alias):
    got = resample.resample(panel, SPEC, rule, ["dispatched"]).orderBy("series", "date").toPandas()
    frame = series_frame()
    frame["date"] = pd.to_datetime(frame["date"])
    for name, g in frame.groupby("series"):
        want = g.set_index("date").dispatched.resample(alias).sum()
        mine = got[got.series == name]
        assert list(pd.to_datetime(mine.date)) == list(want.index)
        same(mine.dispatched.values, want.values)


def test_stacked_grains_keep_totals(panel):
    pairs = panel.select("series", "date", F.col("dispatched").alias("actual"), F.lag("dispatched").over(SPEC.window()).alias("predicted"))
    out = resample.stack_grains(pairs, SPEC, ["actual", "predicted"], {"daily": None, "weekly": "week_sun", "monthly": "month_end"})
    sums = out.groupBy("series", "grain").agg(F.sum("actual").alias("s")).groupBy("series").agg(F.countDistinct("s").alias("n"))
    assert {r["n"] for r in sums.collect()} == {1}
    assert out.where("grain = 'daily' AND predicted IS NULL").count() == 3


def test_month_value_is_carried_thirty_days_and_never_ahead(spark):
    months = pd.DataFrame({"month": [dt.date(2022, 1, 1), dt.date(2022, 2, 1), dt.date(2022, 4, 1)], "v": [1.0, 2.0, 4.0]})
    by_day = align.month_to_days(spark.createDataFrame(months), ["v"])
    days = pd.date_range("2022-01-01", "2022-04-20")
    panel = spark.createDataFrame(pd.DataFrame({"date": [d.date() for d in days], "series": "a"}))
    got = align.join_days(panel, by_day).orderBy("date").toPandas().v
    want = months.assign(month=pd.to_datetime(months.month)).set_index("month").v.reindex(days).ffill(limit=30)
    same(got, want)


def test_quantiles_over_all_series_are_exact(spark):
    rng = np.random.default_rng(1)
    values = np.concatenate([np.full(20000, 5.0), rng.normal(size=40000), rng.integers(0, 50, 17).astype(float)])
    frame = pd.DataFrame({"g": np.where(np.arange(values.size) % 7 == 0, "x", "y"), "v": values})
    got = exact_quantiles(spark.createDataFrame(frame).repartition(8), ["g"], "v", [0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0]).toPandas()
    for g, part in frame.groupby("g"):
        mine = got[got.g == g].set_index("p")["quantile"]
        for p in mine.index:
            assert mine[p] == pytest.approx(np.quantile(part.v, p), abs=1e-12)
    tiny = spark.createDataFrame([("z", 1.0), ("z", 4.0)], "g string, v double")
    assert exact_quantiles(tiny, ["g"], "v", [0.25]).first()["quantile"] == pytest.approx(1.75)


def test_silhouette_matches_all_pairs(spark):
    rng = np.random.default_rng(2)
    x = np.vstack([rng.normal(c, 1.0, (15, 2)) for c in (0, 4, 9)] + [np.array([[50.0, 50.0]])])
    labels = np.array([0] * 15 + [1] * 15 + [2] * 15 + [3])
    frame = spark.createDataFrame(pd.DataFrame({"x": x[:, 0], "y": x[:, 1], "cluster": labels}))
    dist = ((x[:, None] - x[None]) ** 2).sum(axis=2)
    want = []
    for i, c in enumerate(labels):
        own = (labels == c) & (np.arange(len(x)) != i)
        if not own.any():
            want.append(0.0)
            continue
        a = dist[i, own].mean()
        b = min(dist[i, labels == k].mean() for k in set(labels) - {c})
        want.append((b - a) / max(a, b))
    assert cluster.silhouette(frame, ["x", "y"]).first()[0] == pytest.approx(np.mean(want), abs=1e-9)


def test_scores_on_edge_rows(spark):
    rows = [("flat", 5.0, 5.0), ("flat", 5.0, 4.0), ("zero", 0.0, 1.0), ("zero", 0.0, 0.0), ("one", 3.0, 2.0), ("ok", 1.0, 2.0), ("ok", 3.0, 3.0), ("ok", 0.0, 9.0), ("ok", 4.0, None)]
    df = spark.createDataFrame(rows, "series string, actual double, predicted double")
    main = {r["series"]: r for r in score.score_main(df.where("predicted IS NOT NULL"), ["series"]).collect()}
    assert main["flat"]["r2"] is None and main["zero"]["mape"] is None and main["zero"]["mae"] == 0.5
    kept = {r["series"]: r for r in score.score_filtered(df, ["series"]).collect()}
    assert kept["zero"]["n"] == 0 and kept["zero"]["rmse"] is None and kept["one"]["r2"] is None
    assert kept["flat"]["r2"] == 0.0 and kept["ok"]["n"] == 2 and kept["ok"]["mape"] == pytest.approx(50.0)
    assert kept["ok"]["r2"] == pytest.approx(1 - 1 / 2)
    raw = {r["series"]: r["mape"] for r in score.score_mape_raw(df.where("predicted IS NOT NULL"), ["series"]).collect()}
    assert raw["ok"] is None and raw["flat"] == pytest.approx(10.0)


def test_constant_indicator_has_no_sensitivity(spark):
    rows = [("a", dt.date(2022, m, 1), float(m), 1.0, 7.0, 7.0, 7.0, float(m)) for m in range(1, 7)]
    df = spark.createDataFrame(rows, "series string, month date, dispatched double, ordered double, PIB_CO double, ICI double, ECG_DESP double, ISE_CO double")
    out = prof.profile(df).first()
    assert out["sens_PIB_CO"] == 0.0 and out["sens_ISE_CO"] == pytest.approx(1.0)


def test_fulfilment_rules(spark):
    df = spark.createDataFrame([(0.0, 0.0), (5.0, 0.0), (0.0, 4.0), (9.0, 3.0), (1.0, 4.0)], "d double, o double")
    assert [r[0] for r in df.select(win.fulfilment(F.col("d"), F.col("o"))).collect()] == [1.0, 1.0, 0.0, 1.0, 0.25]


def test_guards_and_boundary_split(spark, panel):
    short = panel.where("series <> 'b' OR date < '2022-01-10'")
    kept = split.guard_history(short, ["series"], 60).select("series").distinct().collect()
    assert {r[0] for r in kept} == {"a", "c"}
    both = split.fraction_date_split(panel, SPEC).groupBy("series", "date").count().where("count = 2")
    assert both.count() == 3


def test_folds_are_time_ordered(panel):
    rows = models.expanding_folds(panel, SPEC, 5).toPandas().sort_values(["series", "date"])
    for _, g in rows.groupby("series"):
        assert g.fold.is_monotonic_increasing and list(g.fold.value_counts().sort_index()) == [20] * 6


def test_caps_use_train_rows_only(spark):
    rows = [("a", "train", float(i)) for i in range(101)] + [("a", "test", 1e9), ("a", "test", None), ("a", "test", float("inf"))]
    df = spark.createDataFrame(rows, "series string, split string, v double")
    out = [r["v"] for r in cleanse.cap_quantile(df, ["series"], ["v"]).where("split = 'test'").collect()]
    assert sorted(out) == [50.0, 50.0, 99.0]


def test_dates_and_ids(spark):
    df = spark.createDataFrame([("jan-17", "05.03.2024", "0012"), ("DEC-99", "31.02.2024", "7")], "m string, d string, i string")
    got = df.select(cal.parse_mon_yy(F.col("m")), cal.parse_dmy(F.col("d")), text.strip_id(F.col("i")), text.pad_id(F.col("i"))).collect()
    assert got[0][:] == (dt.date(2017, 1, 1), dt.date(2024, 3, 5), "12", "000000012") or got[0][3] == "000000012"
    assert got[1][0] == dt.date(1999, 12, 1) and got[1][1] is None


def test_metric_scraping_falls_through(spark):
    log = "Daily Metrics:\nRMSE: nan\nMAE: 2.5\nWeekly Metrics:\nRMSE: 7.25\n"
    got = spark.createDataFrame([(log,)], "log string").select(*[c.alias(n) for n, c in text.scraped_metrics(F.col("log")).items()]).first()
    assert got["Daily_RMSE"] == 7.25 and got["Daily_MAE"] == 2.5 and got["Weekly_RMSE"] == 7.25 and got["Monthly_R2"] is None


def test_score_sink_can_be_repeated(spark):
    path = scratch_path(spark, "scores")
    rows = lambda *r: spark.createDataFrame(list(r), "series string, grain string, r2 double")
    sinks.write_scores(rows(("a", "daily", 0.1), ("a", "weekly", 0.2)), path, "first")
    sinks.write_scores(rows(("b", "daily", 0.3)), path, "second")
    sinks.write_scores(rows(("a", "daily", 0.5), ("a", "weekly", 0.2)), path, "first")
    got = {tuple(r) for r in sinks.read_batches(spark, path).select("series", "grain", "r2").collect()}
    assert got == {("a", "daily", 0.5), ("a", "weekly", 0.2), ("b", "daily", 0.3)}


def test_gap_fill_keeps_series_without_rows_in_the_range(spark):
    day = lambda d: dt.date(2020, 1, d)
    rows = [("in", day(3), 1.0), ("in", day(9), 2.0), ("before", day(1), 5.0), ("after", day(9), 7.0), ("around", day(1), 1.0), ("around", day(9), 1.0)]
    df = spark.createDataFrame(rows, "series string, date date, v double")
    got = align.gap_fill(df, SeriesSpec(), ["v"], "2020-01-02", "2020-01-04").collect()
    filled = sorted((r["series"], r["date"].day, r["v"]) for r in got)
    assert filled == sorted((s, d, 1.0 if (s, d) == ("in", 3) else 0.0) for s in ("in", "before", "after", "around") for d in (2, 3, 4))


def test_series_directory_skips_the_combined_file(spark):
    path = scratch_path(spark, "dir")
    rows = [(dt.date(2022, 1, 1), "12", "Item", 1.0, 2.0, "000000012_x"), (dt.date(2022, 1, 1), "12", "Item", 1.0, 2.0, "combined_data")]
    schema = "YearMonth date, `Product ID` string, `Product Name` string, `Dispatched Quantity` double, `Customer Order Quantity` double, stem string"
    sinks.write_series_dir(spark.createDataFrame(rows, schema), path)
    assert [r["stem"] for r in files.read_series_dir(spark, path, files.MONTHLY_SCHEMA).collect()] == ["000000012_x"]
    ids = spark.createDataFrame([("12",), ("13",)], "id string")
    assert files.read_series_by_prefix(spark, path, files.MONTHLY_SCHEMA, ids).count() == 1


def test_unassigned_cluster_takes_the_fallback(spark):
    clusters = spark.createDataFrame([("a", 0), ("b", 9), ("c", None)], "series string, cluster int")
    configs = spark.createDataFrame([(k, v.trees) for k, v in models.FINISHED.items()], "config int, trees int")
    got = {r["series"]: r["config"] for r in align.lookup_config(clusters, configs).collect()}
    assert got == {"a": 0, "b": 3, "c": 3}


def test_smoothing_follows_a_seasonal_series(spark):
    months = pd.date_range("2018-01-01", periods=60, freq="MS")
    y = 100 + 0.5 * np.arange(60) + 20 * np.sin(2 * np.pi * np.arange(60) / 12)
    frame = pd.DataFrame({"series": "a", "month": [m.date() for m in months], "v": y, "split": ["train"] * 48 + ["test"] * 12})
    out = recursive.holt_winters(spark.createDataFrame(frame), SeriesSpec(time="month"), "v").where("split = 'test'").toPandas()
    assert len(out) == 12 and np.sqrt(((out.actual - out.predicted) ** 2).mean()) < 8


def test_best_cluster_and_success_rate(spark):
    df = spark.createDataFrame([(0, 0.5), (0, 0.1), (1, 0.2), (1, 0.2), (2, None)], "cluster int, r2 double")
    assert report.best_cluster(df).first()[:] == (0, 1, 1)
    rates = {r["cluster"]: r["success_rate"] for r in report.success_rate(df, ["cluster"]).collect()}
    assert rates == {0: 50.0, 1: None, 2: None}


def test_demand_classes_of_all_train_months(spark):
    from statistics import mean, stdev

    from seriesloom.plans import cat_aggregate, inputs
    from seriesloom.sources import tables

    sf = "/root/testdata/sf0.001"
    train = {}
    for r in tables.orders_monthly(spark, sf, F.col("p_partkey").cast("string")).collect():
        months = train.setdefault(r.series, [])
        if str(r.month) < str(inputs.TEST):
            months.append(r.ordered)
    want = {}
    for k, v in train.items():
        cv = stdev(v) / mean(v) if len(v) > 1 and mean(v) > 0 else None
        want[k] = None if cv is None else "Smooth" if cv <= 0.5 else "Erratic" if cv <= 1 else "Lumpy"
    got = {r.series: r.pattern for r in cat_aggregate.demand_pattern_train(spark, sf).collect()}
    assert got == want
    cut = {r.series: r.pattern for r in cat_aggregate.demand_pattern(spark, sf).collect()}
    print("parts", len(got), "with the cut", len(cut), "other class", sum(cut.get(k) != v for k, v in got.items()))


def test_recursions_take_time_in_proportion_to_the_days(spark):
    """Four times the days take less than ten times as long; adding to one array for a whole series took sixteen."""
    import time

    from seriesloom.operators import recursive
    from seriesloom.spec import SeriesSpec

    def seconds(days):
        rows = spark.range(8 * days).selectExpr("CAST(id % 8 AS STRING) AS series", "date_add(DATE '1900-01-01', CAST(id DIV 8 AS INT)) AS date", "CAST(id % 13 AS DOUBLE) AS v")
        best = []
        for _ in range(2):
            start = time.perf_counter()
            recursive.ema(rows, SeriesSpec(target="v"), "v", (7, 30), "E").write.format("noop").mode("overwrite").save()
            best.append(time.perf_counter() - start)
        return min(best)

    seconds(100)
    assert seconds(20_000) < 10 * seconds(5_000)


def test_folds_in_blocks_equal_one_fold(spark, monkeypatch):
    from seriesloom.operators import recursive
    from seriesloom.spec import SeriesSpec

    rows = spark.range(400).selectExpr("CAST(id % 3 AS STRING) AS series", "date_add(DATE '2000-01-01', CAST(id AS INT)) AS date", "CAST(pow(id, 2) % 11 AS DOUBLE) AS v")
    spec = SeriesSpec(target="v")
    for made in (lambda: recursive.ema(rows, spec, "v", (3,), "E"), lambda: recursive.croston(rows, spec, "v"), lambda: recursive.croston_textbook(rows, spec, "v")):
        monkeypatch.setattr(recursive, "FOLD_ROWS", 64)
        blocks = sorted(made().collect())
        monkeypatch.setattr(recursive, "FOLD_ROWS", 100_000)
        assert blocks == sorted(made().collect()) and len(blocks) == 400
