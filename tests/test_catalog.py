"""Registered queries against their SQL, and plan checks.

``SERIESLOOM_ALL=1`` compares every query that has SQL; the default is a selection
that covers each module.
"""

import os

import pytest
from compare import connect, difference

from seriesloom.operators import align
from seriesloom.plans import catalog, inputs

SF = "/root/testdata/sf0.001"
SOME = [
    "src_series_dir",
    "sink_scores",
    "scrape_metrics",
    "split_fraction_date",
    "gap_fill",
    "asof_month_limit",
    "asof_week_lag",
    "profile",
    "score_summary",
    "complete_months",
    "score_filtered",
    "roll_past",
    "direction_changes",
    "ema_recursive",
    "croston",
    "croston_textbook",
    "horizon_short_features",
    "horizon_long_features",
    "ext_lag",
    "carry_last",
    "demand_pattern",
    "agg_external",
    "agg_monthly",
    "cluster_recipe",
    "as_category",
    "run_ledger",
    "weight_groups",
    "choose_k",
]


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(catalog.SQL) if os.environ.get("SERIESLOOM_ALL") else SOME)
def test_query_matches_sql(spark, con, name):
    assert difference(catalog.QUERIES[name](spark, SF), con, catalog.SQL[name]) is None


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_predicate_reaches_the_scan(spark):
    plan = _plan(catalog.QUERIES["filter_series"](spark, SF))
    assert "PushedFilters: [IsNotNull(l_partkey), EqualTo(l_partkey,7)]" in plan
    assert "l_comment" not in plan and "l_extendedprice" not in plan


def test_dates_reach_the_scans(spark):
    for name in ("naive_daily", "naive_pairs", "parts_monthly"):
        plan = _plan(getattr(inputs, name)(spark, SF))
        assert "GreaterThanOrEqual(l_shipdate" in plan and "GreaterThanOrEqual(o_orderdate" in plan, name


def test_calendars_scan_each_table_once(spark):
    for name in ("filled", "filled_lumpy", "monthly"):
        assert _plan(getattr(inputs, name)(spark, SF)).count("FileScan parquet") == 3, name


def test_indicators_need_no_hint_to_be_broadcast(spark):
    joined = align.join_month(inputs.monthly(spark, SF), inputs.external(spark, SF))
    assert "BroadcastHashJoin" in joined._jdf.queryExecution().executedPlan().toString()


def test_panels_reach_the_end_of_the_data(spark, con):
    want = con.execute("SELECT max(CAST(l_shipdate AS DATE)) FROM lineitem").fetchone()[0]
    assert inputs.filled(spark, SF).agg({"date": "max"}).first()[0] == want


def test_window_features_share_the_gap_fill_shuffle(spark):
    """The panel is shuffled by series once; gap filling, features and grains reuse it."""
    base = _plan(inputs.daily(spark, SF)).count("Exchange hashpartitioning")
    wide = _plan(catalog.QUERIES["roll_past"](spark, SF)).count("Exchange hashpartitioning")
    assert wide == base + 1


def test_naive_scores_add_one_shuffle_to_the_daily_sums(spark):
    base = _plan(inputs.daily_lumpy(spark, SF)).count("Exchange hashpartitioning")
    assert _plan(inputs.naive_scores(spark, SF)).count("Exchange hashpartitioning") == base + 1


def test_recursions_stay_in_the_jvm(spark):
    for name in ("ema_recursive", "ema_weighted", "croston", "croston_textbook"):
        assert "FlatMapGroupsInPandas" not in _plan(catalog.QUERIES[name](spark, SF))


def test_no_cartesian_products(spark):
    for name in ("asof_month", "weight_groups", "silhouette", "choose_k", "cluster_recipe"):
        assert "CartesianProduct" not in _plan(catalog.QUERIES[name](spark, SF))
