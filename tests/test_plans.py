"""Physical-plan checks: pushdown, pruning, shuffles, no cross products."""

from __future__ import annotations

import os
import re

import pytest

from tidemark.plans import metrics as M
from tidemark.plans import rankings as R
from tidemark.plans import universe as U
from tidemark.plans.run import LayerRun
from tidemark.settings import fixture_settings

SF = "/root/testdata/sf0.001"


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def layers(spark, tmp_path_factory):
    if not os.path.exists(SF):
        pytest.skip("test data not available")
    run = LayerRun(spark, SF, str(tmp_path_factory.mktemp("layers")), fixture_settings())
    run.stage_quotes()
    run.stage_dimensions()
    run.build_universe()
    run.build_metrics()
    return run


@pytest.fixture()
def no_aqe(spark):
    old = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.enabled", old)


def test_metrics_scan_prunes_and_pushes(layers, no_aqe):
    st = layers.settings
    m = M.build_metrics(layers.quotes(M.quotes_start(st), st.reference_date), layers.mart("universe"), layers.cdi(), st)
    plan = _plan(m)
    assert re.search(r"PartitionFilters: \[.*quote_month", plan)
    assert re.search(r"PushedFilters: \[.*GreaterThanOrEqual\(date,1998-05-30\).*LessThanOrEqual\(date,2001-06-30\)", plan)
    assert "ReadSchema: struct<fund_cnpj:string,subclass_id:string,date:date,nav:double>" in plan


def test_metrics_one_exchange_for_windows_and_aggregate(layers, no_aqe):
    st = layers.settings
    q = layers.quotes(M.quotes_start(st), st.reference_date)
    ri = M.return_rows(M.universe_quotes(q, layers.mart("universe"), st))
    bench = layers.cdi()
    m = M.series_metrics(ri, bench, st, M.benchmark_scalars(bench, st))
    plan = _plan(m)
    # the quote rows are shuffled once on the series key; lag, running product,
    # month compounding and the final aggregate reuse that partitioning
    quote_exchanges = re.findall(r"Exchange hashpartitioning\(fund_cnpj#\d+, subclass_id#\d+, \d+\)", plan)
    assert len(quote_exchanges) <= 2  # the quotes, and the distinct universe keys of the broadcast semi-join
    assert plan.count("Window") >= 3
    assert "SortMergeJoin" not in plan


@pytest.mark.parametrize("layer", ["universe", "metrics", "rankings"])
def test_no_cross_products(layers, no_aqe, layer):
    st = layers.settings
    if layer == "universe":
        df = U.build_universe(layers.snap("registry").drop("reference_date"), layers.snap("fees").drop("reference_date"),
                              layers.quotes(hi=st.reference_date), layers.snap("anbima").drop("reference_date"), st)
    elif layer == "metrics":
        df = M.build_metrics(layers.quotes(), layers.mart("universe"), layers.cdi(), st)
    else:
        df = R.build_rankings(layers.mart("metrics"), st)
    plan = _plan(df)
    assert "BroadcastNestedLoopJoin" not in plan and "CartesianProduct" not in plan


def test_rankings_rank_windows_are_split(layers, no_aqe):
    plan = _plan(R.build_rankings(layers.mart("metrics"), layers.settings))
    # percentile ranks run per (investor_type, feature, value bucket), segment ranks per
    # (segment, value bucket): no window partition holds a whole investor type or segment
    assert re.search(r"Window \[.*\], \[investor_type#\d+, feature#\d+, __b#\d+\]", plan)
    assert re.search(r"Window \[.*\], \[purpose#\d+, profile#\d+, investor_type#\d+, __b#\d+\]", plan)
    # a window on (investor_type, feature) alone only runs over the per-bucket totals (<= 32 rows a group)
    for line in plan.splitlines():
        if re.search(r"Window \[.*\], \[investor_type#\d+, feature#\d+\], \[", line):
            assert "__tot" in line


def test_top_n_uses_group_limit_before_shuffle(spark, layers, no_aqe):
    from tidemark.plans import serving as SV

    layers.build_rankings()
    plan = _plan(SV.top_n_per_segment(layers.mart("rankings"), layers.settings.top_n))
    assert "WindowGroupLimit" in plan
