"""Percentile ranks, scores and segment ranks."""

from __future__ import annotations

from datetime import date

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidemark.operators.ranking import average_rank_pct, cohort_percentile, competition_rank, top_n_per_group
from tidemark.plans import rankings as R
from tidemark.settings import Settings


def test_average_rank_pct_matches_pandas_with_ties_and_null(spark):
    vals = [3.0, 1.0, 3.0, None, 2.0, 3.0, float("inf")]
    df = spark.createDataFrame([("g", i, v) for i, v in enumerate(vals)], "g string, i int, v double")
    got = {r["i"]: r["pct"] for r in average_rank_pct(df, ["g"], "v").collect()}
    want = pd.Series(vals).rank(pct=True)
    for i, w in enumerate(want):
        if pd.isna(w):
            assert got[i] is None
        else:
            assert got[i] == w  # exact, not approximate


def test_competition_rank_min_of_ties(spark):
    df = spark.createDataFrame([("s", 0.9), ("s", 0.5), ("s", 0.9), ("s", 0.1)], "seg string, score double")
    got = sorted((r["score"], r["rank"]) for r in competition_rank(df, ["seg"], "score").collect())
    assert got == [(0.1, 4), (0.5, 3), (0.9, 1), (0.9, 1)]


def test_top_n_positions(spark):
    df = spark.createDataFrame([("s", k, r) for k, r in [("a", 2), ("b", 1), ("c", 2), ("d", 4)]], "seg string, k string, rank int")
    got = [(r["k"], r["position"]) for r in
           top_n_per_group(df, ["seg"], [F.col("rank"), F.col("k")], 3).orderBy("position").collect()]
    assert got == [("b", 1), ("a", 2), ("c", 3)]


def test_cohort_percentile_strictly_worse(spark):
    df = spark.createDataFrame([("s", i, v) for i, v in enumerate([1.0, 2.0, 2.0, 4.0, None])], "seg string, i int, v double")
    hi = {r["i"]: r["p"] for r in cohort_percentile(df, ["seg"], "v", True, "p").collect()}
    lo = {r["i"]: r["p"] for r in cohort_percentile(df, ["seg"], "v", False, "p").collect()}
    assert hi[3] == 75.0 and hi[1] == 25.0 and hi[0] == 0.0 and hi[4] is None
    assert lo[0] == 75.0 and lo[3] == 0.0


def _metrics(spark):
    rows = []
    for i in range(6):
        rows.append(dict(fund_cnpj=f"F{i}", subclass_id=None if i % 2 else "A", fund_name=f"Fund {i}", investor_level=i % 3,
                         ir_rate=0.15, alpha_12m_net=0.01 * i, alpha_3m_net=0.02 * (5 - i), alpha_6m_net=0.0,
                         alpha_24m_net=0.0, alpha_36m_net=0.0, return_annualized_net=0.1, sharpe_excess=float(i),
                         pct_months_above_cdi=0.5, max_drawdown=-0.01 * i, volatility=0.02 * i, span_days=365 * (i + 1),
                         redemption_days=i, min_investment=1000.0 * i, return_12m_net=0.1))
    return spark.createDataFrame(pd.DataFrame(rows))


def test_rank_funds_segments_and_scores(spark):
    st = Settings(reference_date=date(2024, 1, 31))
    out = R.build_rankings(_metrics(spark), st)
    counts = {(r["purpose"], r["profile"], r["investor_type"]): r["count"] for r in
              out.groupBy("purpose", "profile", "investor_type").count().collect()}
    assert len(counts) == 18
    # levels 0,1,2,0,1,2: retail sees 2 funds, qualified 4, professional 6
    assert counts[("cash", "balanced", "retail")] == 2
    assert counts[("cash", "balanced", "qualified")] == 4
    assert counts[("income", "aggressive", "professional")] == 6
    seg = out.where("purpose = 'cash' AND profile = 'conservative' AND investor_type = 'professional'").toPandas()
    # recompute one score by hand: weights x component scores
    w = st.weights["cash"]["conservative"]
    parts = [f"s_{c}" for c, _ in st.cont_features] + ["s_span", "s_liquidity"]
    row = seg.iloc[0]
    assert row["score"] == pytest.approx(sum(wi * row[p] for wi, p in zip(w, parts)), rel=1e-12)
    assert seg["rank"].min() == 1
    # descending feature: the lowest volatility gets 1 - 1/n, not 1
    best_vol = seg.loc[seg["volatility"].idxmin(), "s_volatility"]
    assert best_vol == pytest.approx(1 - 1 / 6)
    retail = out.where("investor_type = 'retail' AND purpose = 'cash' AND profile = 'conservative'").toPandas().iloc[0]
    wr = [(1 - st.accessibility_weight) * wi for wi in w]
    want = sum(c * retail[p] for c, p in zip(wr, parts)) + st.accessibility_weight * retail["s_accessibility"]
    assert retail["score"] == pytest.approx(want, rel=1e-12)


def test_settings_reject_bad_weights():
    with pytest.raises(ValueError):
        Settings(reference_date=date(2024, 1, 1), weights={"cash": {"conservative": (0.5,) * 12}})
