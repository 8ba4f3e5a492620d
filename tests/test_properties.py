"""Property tests on random inputs: exact agreement with straightforward definitions."""

from __future__ import annotations

from datetime import date, timedelta

import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tidemark.operators import timeseries as ts
from tidemark.operators.ranking import average_rank_pct

SETTINGS = settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])

values = st.lists(st.one_of(st.none(), st.sampled_from([-1.5, 0.0, 0.25, 1.0, 2.0, 7.5])), min_size=1, max_size=25)


@SETTINGS
@given(groups=st.lists(values, min_size=1, max_size=3))
def test_average_rank_pct_equals_pandas(spark, groups):
    rows = [(g, i, v) for g, vs in enumerate(groups) for i, v in enumerate(vs)]
    df = spark.createDataFrame(rows, "g int, i int, v double")
    got = {(r["g"], r["i"]): r["pct"] for r in average_rank_pct(df, ["g"], "v").collect()}
    for g, vs in enumerate(groups):
        want = pd.Series(vs, dtype="float64").rank(pct=True)
        for i, w in enumerate(want):
            assert (got[(g, i)] is None) if pd.isna(w) else got[(g, i)] == w


@SETTINGS
@given(series=st.lists(st.lists(st.one_of(st.none(), st.floats(1, 100, allow_nan=False)), min_size=1, max_size=20),
                       min_size=1, max_size=3))
def test_forward_fill_equals_loop(spark, series):
    rows = []
    for k, vs in enumerate(series):
        sub = None if k % 2 == 0 else "s"
        for d, v in enumerate(vs):
            rows.append((f"F{k}", sub, date(2024, 1, 1) + timedelta(days=d), v))
    df = spark.createDataFrame(rows, "fund_cnpj string, subclass_id string, date date, nav double")
    got = {(r["fund_cnpj"], r["date"]): r["nav"] for r in
           ts.forward_fill(df, ["fund_cnpj", "subclass_id"], "date", ["nav"]).collect()}
    for k, vs in enumerate(series):
        last = None
        for d, v in enumerate(vs):
            last = v if v is not None else last
            assert got[(f"F{k}", date(2024, 1, 1) + timedelta(days=d))] == last
