"""How often rows move: staging moves raw quotes once, layers clean them once, small rank tables are not joined by shuffle."""

from __future__ import annotations

import re
from datetime import date

import pytest

from tidemark.operators.ranking import competition_rank
from tidemark.plans import rankings as R
from tidemark.plans import staging as S
from tidemark.plans.wiring import Layers
from tidemark.settings import fixture_settings

RAW = ("CNPJ_FUNDO_CLASSE string, ID_SUBCLASSE string, DT_COMPTC date, TP_FUNDO_CLASSE string, VL_QUOTA double, "
       "VL_PATRIM_LIQ double, CAPTC_DIA double, RESG_DIA double, NR_COTST int, tb1 long")


@pytest.fixture()
def large(spark):
    """Plans as over large tables: no join is small enough to broadcast unless it is said to be."""
    names = ["spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold"]
    old = {n: spark.conf.get(n) for n in names}
    spark.conf.set(names[0], "false")
    spark.conf.set(names[1], "-1")
    yield
    for n in names:
        spark.conf.set(n, old[n])


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _raw(spark):
    day = [date(2001, 1, d) for d in range(1, 4)]
    return spark.createDataFrame([
        ("a", None, day[0], "F", 1.0, 5.0, 0.0, 0.0, 3, 2), ("a", None, day[0], "F", 9.0, 5.0, 0.0, 0.0, 3, 3),
        ("a", None, day[0], "G", 8.0, 5.0, 0.0, 0.0, 3, 1), ("a", None, day[1], "F", 0.0, 5.0, 0.0, 0.0, 3, 4),
        ("a", "A", day[1], None, 2.0, 5.0, 0.0, 0.0, 3, 5), ("a", "A", day[2], "F", 0.0, 0.0, 0.0, 0.0, 0, 6),
        (None, "A", day[2], "F", 7.0, 5.0, 0.0, 0.0, 3, 7), (None, "A", day[2], "F", 7.0, 5.0, 0.0, 0.0, 3, 7),
    ], RAW)


def test_raw_quotes_move_once(spark, large):
    staged = S.clean_quotes(_raw(spark))
    assert sorted((str(r.fund_cnpj), str(r.subclass_id), r.date.day, r.nav) for r in staged.collect()) == [
        ("None", "A", 3, 7.0), ("a", "A", 2, 2.0), ("a", "None", 1, 1.0), ("a", "None", 2, 1.0)]
    assert len(re.findall(r"Exchange hashpartitioning", _plan(staged))) == 1


def test_stored_layers_clean_the_quotes_once(spark, tmp_path):
    p = Layers(spark, str(tmp_path), fixture_settings(), materialize=True)
    p._memo["fx_inf_diario"] = _raw(spark)
    quotes = p.quotes()
    assert quotes.count() == 4
    assert all("tidemark-marts" in f for f in quotes.inputFiles())
    assert "Window" not in _plan(quotes)


def test_segment_counts_are_not_shuffled_against_the_rows(spark, large):
    rows = [(s, float(i % 7) if i % 5 else None) for s in "xy" for i in range(40)]
    ranked = competition_rank(spark.createDataFrame(rows, "seg string, score double"), ["seg"], "score")
    plan = _plan(ranked)
    assert not re.search(r"SortMergeJoin \[seg#\d+\], \[seg#\d+\]", plan)
    want = sorted((s, -1.0 if v is None else v, 1 + sum(t == s and w is not None and (v is None or w > v) for t, w in rows)) for s, v in rows)
    assert sorted((r.seg, -1.0 if r.score is None else r.score, r["rank"]) for r in ranked.collect()) == want


def test_percentiles_may_be_kept_once(spark):
    from tests.test_ranking import _metrics

    seen = []

    def store(df):
        seen.append(df.columns)
        return df

    st = fixture_settings()
    kept = R.build_rankings(_metrics(spark), st, store)
    assert len(seen) == 1 and "s_alpha_12m_net" in seen[0]
    assert sorted(map(str, kept.collect())) == sorted(map(str, R.build_rankings(_metrics(spark), st).collect()))
