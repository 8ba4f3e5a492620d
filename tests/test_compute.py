"""Return, risk and tax operators on small synthetic series (FIXTURES.md Part A)."""

from __future__ import annotations

import math
from datetime import date

import pytest
from pyspark.sql import functions as F

from tidemark.functions import scalars as X
from tidemark.operators import timeseries as ts
from tidemark.plans import metrics as M
from tidemark.settings import Settings

SK = ["fund_cnpj", "subclass_id"]
REF = date(2023, 12, 15)


def _settings():
    return Settings(reference_date=REF)


def _rows(df, order=("fund_cnpj",)):
    return {(r["fund_cnpj"], r["subclass_id"]): r for r in df.orderBy(*order).collect()}


def test_daily_returns_one_row_fewer_per_series(quotes_2fund):
    r = ts.daily_return(quotes_2fund, SK)
    counts = {(x[0], x[1]): x[2] for x in r.groupBy(*SK).count().collect()}
    assert counts == {("A", None): 251, ("B", "sub1"): 251}
    a = r.where(F.col("fund_cnpj") == "A").orderBy("date").first()
    assert a["return_daily"] == pytest.approx(0.0005)


def test_division_by_zero_nav_is_dropped(spark):
    df = spark.createDataFrame(
        [("Z", None, date(2024, 1, 1), 0.0), ("Z", None, date(2024, 1, 2), 1.0), ("Z", None, date(2024, 1, 3), 2.0)],
        "fund_cnpj string, subclass_id string, date date, nav double")
    out = ts.daily_return(df, SK).collect()
    # 1/0 would be Infinity: dropped; only 2/1 - 1 remains
    assert [r["return_daily"] for r in out] == [1.0]


def _metrics(quotes, cdi):
    st = _settings()
    cw = M.benchmark_scalars(cdi, st)
    ri = ts.daily_return(quotes, SK)
    return M.series_metrics(ri, cdi, st, cw), cw


def test_series_metrics_null_key_kept_and_signs(quotes_2fund, cdi_flat):
    m, _ = _metrics(quotes_2fund, cdi_flat)
    rows = _rows(m)
    assert set(rows) == {("A", None), ("B", "sub1")}
    a, b = rows[("A", None)], rows[("B", "sub1")]
    for label in ("1m", "3m", "6m"):
        assert a[f"return_{label}"] > 0 and b[f"return_{label}"] > 0
    assert a["return_12m"] is None  # no NAV a year before the reference date
    assert 0.10 < a["annualized_return"] < 0.20
    assert a["max_drawdown"] == pytest.approx(0.0, abs=1e-12)  # monotone NAV
    assert a["volatility"] >= 0 and a["span_days"] > 300
    assert a["pct_months_above_cdi"] == pytest.approx(1.0)  # 0.05%/day beats 0.01%/day every month


def test_trailing_return_exact_value(quotes_2fund, cdi_flat):
    from tests.conftest import business_days

    m, _ = _metrics(quotes_2fund.where(F.col("date") <= F.lit(REF)), cdi_flat)
    a = _rows(m)[("A", None)]
    days = business_days(date(2023, 1, 2), 252)
    i_end = max(i for i, d in enumerate(days) if d <= REF)
    i_start = max(i for i, d in enumerate(days) if d <= date(2023, 11, 15))
    assert a["return_1m"] == pytest.approx(1.0005 ** (i_end - i_start) - 1, rel=1e-9)


def test_cagr_uses_return_rows(quotes_2fund, cdi_flat):
    from tests.conftest import business_days

    m, _ = _metrics(quotes_2fund.where(F.col("date") <= F.lit(REF)), cdi_flat)
    a = _rows(m)[("A", None)]
    days = business_days(date(2023, 1, 2), 252)
    i_end = max(i for i, d in enumerate(days) if d <= REF)
    n = i_end  # return rows: every quote but the first
    first, last = 100 * 1.0005 ** 1, 100 * 1.0005 ** i_end
    assert a["annualized_return"] == pytest.approx((last / first) ** (252.0 / n) - 1, rel=1e-9)


def test_max_drawdown_peak_drop(spark, cdi_flat):
    navs = [100 + i for i in range(11)] + [110 - 3 * i for i in range(1, 10)]
    days = [date(2023, 3, 1 + i) for i in range(20)]
    q = spark.createDataFrame([("P", "x", d, float(v)) for d, v in zip(days, navs)],
                              "fund_cnpj string, subclass_id string, date date, nav double")
    m, _ = _metrics(q, cdi_flat)
    mdd = m.first()["max_drawdown"]
    assert mdd < -0.1
    assert mdd == pytest.approx(83 / 110 - 1, rel=1e-9)


def test_sharpe_infinite_when_flat(spark, cdi_flat):
    days = [date(2023, 3, 1 + i) for i in range(5)]
    # constant NAV: every return is exactly 0, so the standard deviation is exactly 0
    q2 = spark.createDataFrame([("F", None, d, 100.0 + 0.0 * i) for i, d in enumerate(days)],
                               "fund_cnpj string, subclass_id string, date date, nav double")
    m, _ = _metrics(q2, cdi_flat)
    r = m.first()
    assert r["volatility"] == 0.0
    assert r["sharpe_excess"] == float("-inf")  # mean 0 minus a positive rate over std 0
    assert r["sharpe_raw"] is None  # 0 / 0


def test_benchmark_windows_and_annualised(cdi_flat, cdi_empty):
    st = _settings()
    w = M.benchmark_scalars(cdi_flat, st)
    assert w["annualized"] > 0
    assert w["12m"] > 0 and w["36m"] == pytest.approx(w["12m"])
    e = M.benchmark_scalars(cdi_empty, st)
    assert e["annualized"] == 0.0 and all(e[k] == 0.0 for k in st.windows)


def test_investor_level_map(spark):
    df = spark.createDataFrame([("Investidor Geral",), ("Qualificado",), ("Profissional",), (None,), ("PROFISSIONAL",)],
                               "t string")
    out = [r[0] for r in df.select(X.investor_level(F.col("t"))).collect()]
    assert out == [0, 1, 2, 0, 2]


def test_tax_rate_and_net_return(spark):
    st = _settings()
    df = spark.createDataFrame(
        [("Longo Prazo", "X FUND", 0.10), ("Isento", "X", -0.05), (None, "ABC INCENTIVADO", 0.1), ("Outros", "Y", None)],
        "tt string, name string, g double")
    rate = X.tax_rate(F.col("tt"), F.col("name"), st.rates_by_taxation, st.exempt_keywords, st.default_tax_rate)
    out = df.select(rate.alias("r"), X.net_return(F.col("g"), rate).alias("n")).collect()
    assert [r["r"] for r in out] == [0.15, 0.0, 0.0, 0.15]
    assert out[0]["n"] == pytest.approx(0.085)
    assert out[1]["n"] == pytest.approx(-0.05)  # losses are not credited
    assert out[3]["n"] is None
    assert X.net_value(-0.1, 0.15) == pytest.approx(-0.1)


def test_forward_fill_keeps_leading_nulls(spark):
    df = spark.createDataFrame(
        [("A", None, date(2024, 1, d), v) for d, v in [(1, None), (2, 1.0), (3, None), (4, 2.0), (5, None)]],
        "fund_cnpj string, subclass_id string, date date, nav double")
    out = [r["nav"] for r in ts.forward_fill(df, SK, "date", ["nav"]).orderBy("date").collect()]
    assert out == [None, 1.0, 1.0, 2.0, 2.0]


def test_window_mean_rate_matches_direct_average(spark, cdi_flat):
    b = spark.createDataFrame([("A", None, date(2023, 2, 1), date(2023, 3, 31)), ("B", "s", date(2022, 1, 1), date(2022, 6, 1))],
                              "fund_cnpj string, subclass_id string, lo date, hi date")
    out = {r["fund_cnpj"]: r["rf_daily"] for r in
           ts.window_mean_rate(b, cdi_flat, SK, "lo", "hi", date(2022, 1, 1), date(2023, 12, 31)).collect()}
    assert out["A"] == pytest.approx(0.0001)
    assert out["B"] is None  # no rate inside the range


def test_cumulative_and_drawdown(spark):
    df = spark.createDataFrame([("A", None, date(2024, 1, d), r) for d, r in [(1, 0.1), (2, -0.5), (3, 0.2)]],
                               "fund_cnpj string, subclass_id string, date date, return_daily double")
    out = ts.drawdown_series(df, SK, "date", "return_daily").orderBy("date").collect()
    assert [round(r["level"], 10) for r in out] == [1.1, 0.55, 0.66]
    assert out[1]["drawdown"] == pytest.approx(-0.5)
    assert math.isclose(out[2]["peak"], 1.1)
