"""Rule pass / fail / no-snapshot behaviour and the gate."""

from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

from tidemark.operators import checks as V

REF = date(2025, 5, 10)


def _one(df):
    rows = df.collect()
    assert len(rows) == 1
    return rows[0]


@pytest.fixture(scope="module")
def snapshot_table(spark):
    return spark.createDataFrame([(date(2025, m, 1), m, "k") for m in (3, 4, 5, 6)], "reference_date date, v int, key string")


def test_snapshot_exists_and_missing(spark, snapshot_table):
    sl, snap = V.as_of_slice(snapshot_table, REF)
    assert snap == date(2025, 5, 1) and sl.count() == 1
    r = _one(V.snapshot_exists(spark, "x_snapshot_exists", snap, REF, "t"))
    assert r["passed"] and r["value"] == "2025-05-01" and r["threshold"] == "<= 2025-05-10"
    _, none = V.as_of_slice(snapshot_table, date(2025, 1, 1))
    assert none is None
    r = _one(V.snapshot_exists(spark, "x_snapshot_exists", none, date(2025, 1, 1), "t"))
    assert not r["passed"] and r["value"] is None


def test_row_count_no_nulls_on_empty_slice(spark, snapshot_table):
    empty = snapshot_table.where(F.lit(False))
    rc, nn = V.evaluate(empty, [V.row_count("rc", "t"), V.no_nulls("nn", "v", "t")]).collect()
    assert not rc["passed"] and rc["value"] == "0"
    assert nn["passed"]  # no snapshot passes the NULL check


def test_pk_unique_counts_groups(spark):
    ok = spark.createDataFrame([("X", "1"), ("X", "2"), ("Y", "1")], "a string, b string")
    bad = spark.createDataFrame([("X", "1"), ("X", "1"), ("Y", "2")], "a string, b string")
    assert _one(V.pk_unique(ok, "pk", ["a", "b"], "t"))["passed"]
    r = _one(V.pk_unique(bad, "pk", ["a", "b"], "t"))
    assert not r["passed"] and r["value"] == "1"
    nulls = spark.createDataFrame([(None, "1"), (None, "1")], "a string, b string")
    assert _one(V.pk_unique(nulls, "pk", ["a", "b"], "t"))["value"] == "1"  # NULL is a key value


def test_known_values_names_unknown_and_ignores_null(spark):
    df = spark.createDataFrame([("S",), ("N",), ("X",), (None,)], "status string")
    r = _one(V.known_values(df, "kv", "status", {"S", "N"}, "t"))
    assert not r["passed"] and r["value"] == "X" and r["severity"] == "warning"
    assert r["threshold"] == "subset of {N, S}"
    ok = _one(V.known_values(df.where("status <> 'X'"), "kv", "status", {"S", "N"}, "t"))
    assert ok["passed"] and ok["value"] is None


def test_null_rate_and_outliers(spark):
    rows = [("f", None, d, None if i < 6 else 1.0, 1.0, 1.0) for i, d in enumerate(range(1, 11))]
    df = spark.createDataFrame([(a, b, date(2024, 1, d), n, x, s) for a, b, d, n, x, s in rows],
                               "fund_cnpj string, subclass_id string, date date, nav double, aum double, shareholders double")
    bad = df.union(spark.createDataFrame([("g", None, date(2024, 1, 11), 2e9, 2e12, -1.0)], df.schema))
    res = {r["check_name"]: r for r in V.evaluate(bad, [
        V.null_rate("nav_null_rate", "nav", 0.5, "error", "< 50%"),
        V.count_where("nav_outliers", F.col("nav") > 1e9, "warning"),
        V.count_where("aum_outliers", F.col("aum") > 1e12, "warning"),
        V.count_where("sh_outliers", F.col("shareholders") < 0, "warning"),
    ]).collect()}
    assert not res["nav_null_rate"]["passed"] and res["nav_null_rate"]["value"] == "54.5%"
    assert res["nav_outliers"]["value"] == "1" and res["aum_outliers"]["value"] == "1" and res["sh_outliers"]["value"] == "1"


def test_max_gap(spark):
    weekend = spark.createDataFrame([(date(2024, 1, d),) for d in (5, 8, 9)], "date date")
    assert _one(V.max_gap(weekend, "gap", "date", 10, "t"))["passed"]
    big = spark.createDataFrame([(date(2024, 1, 1),), (date(2024, 1, 19),)], "date date")
    r = _one(V.max_gap(big, "gap", "date", 10, "t"))
    assert not r["passed"] and r["value"] == "18"
    single = spark.createDataFrame([(date(2024, 1, 1),)], "date date")
    r = _one(V.max_gap(single, "gap", "date", 10, "t"))
    assert not r["passed"] and r["value"] is None  # cannot be computed


def test_universe_null_rate_inclusive_bound(spark):
    s = "fund_cnpj string, target_taxation string"
    ok = spark.createDataFrame([("f%d" % i, None if i < 3 else "x") for i in range(100)], s)
    bad = spark.createDataFrame([("f%d" % i, None if i < 20 else "x") for i in range(100)], s)
    rule = [V.null_rate("u", "target_taxation", 0.05, "warning", "<= 5%", inclusive=True)]
    assert _one(V.evaluate(ok, rule))["passed"]
    assert not _one(V.evaluate(bad, rule))["passed"]
    assert _one(V.evaluate(ok.limit(0), rule))["passed"]  # empty counts as 0%


def test_metrics_bounds(spark):
    s = "fund_cnpj string, max_drawdown double, pct double, return_12m double"
    df = spark.createDataFrame([("a", 0.05, 1.1, 1.5), ("b", -0.1, -0.1, -0.95), ("c", -0.2, 0.5, None)], s)
    res = {r["check_name"]: r["value"] for r in V.evaluate(df, [
        V.count_where("mdd_sign", F.col("max_drawdown") > 0, "error"),
        V.count_where("pct", (F.col("pct") < 0) | (F.col("pct") > 1), "error"),
        V.count_where("r12", F.col("return_12m").isNotNull() & ((F.col("return_12m") < -0.9) | (F.col("return_12m") > 1.0)), "warning"),
    ]).collect()}
    assert res == {"mdd_sign": "1", "pct": "2", "r12": "2"}


def test_referential_and_required_columns(spark):
    child = spark.createDataFrame([(1,), (2,), (3,), (None,)], "k int")
    parent = spark.createDataFrame([(1,), (1,), (2,)], "k int")
    r = _one(V.referential(child, parent, "ref", "k", 0.95, "t"))
    assert not r["passed"] and r["value"] == "66.7%"
    r = _one(V.required_columns(spark, ["a", "b"], "req", {"a", "c", "d"}))
    assert not r["passed"] and r["value"] == "c, d"


def test_gate_raises_only_on_errors_and_logs(spark):
    df = spark.createDataFrame([(1,)], "v int")
    warn = V.with_context(V.evaluate(df, [V.count_where("w", F.col("v") > 0, "warning")]), "t", "d", REF)
    logged = []
    out = V.gate(warn, "t", logged.append)
    assert out.count() == 1 and len(logged) == 1
    err = V.with_context(V.evaluate(df, [V.count_where("e", F.col("v") > 0, "error")]), "t", "d", REF)
    with pytest.raises(V.GateError, match="e"):
        V.gate(err, "t", logged.append)
    assert len(logged) == 2  # written before raising


def test_lazy_slice_and_no_snapshot_branches(spark, snapshot_table):
    sl, snap = V.as_of_slice_lazy(snapshot_table, REF)
    assert sl.count() == 1
    r = _one(V.snapshot_exists(spark, "x", snap, REF, "t"))
    assert r["passed"] and r["value"] == "2025-05-01"
    early = date(2025, 1, 1)
    sl0, snap0 = V.as_of_slice_lazy(snapshot_table, early)
    assert sl0.count() == 0
    r = _one(V.snapshot_exists(spark, "x", snap0, early, "t"))
    assert not r["passed"] and r["value"] is None
    nr = _one(V.evaluate(sl0, [V.null_rate("nr", "v", 0.05, "warning", "< 5%", requires=snap0)]))
    assert not nr["passed"] and nr["value"] is None  # no snapshot fails
    ok = _one(V.evaluate(sl, [V.null_rate("nr", "v", 0.05, "warning", "< 5%", requires=snap)]))
    assert ok["passed"] and ok["value"] == "0.0%"
    child = spark.createDataFrame([(1,)], "k int")
    ref_missing = _one(V.referential(child, child, "ri", "k", 0.95, "t", requires=F.when(snap0.isNotNull(), F.lit(1))))
    assert not ref_missing["passed"] and ref_missing["threshold"] == ">= 95% matched" and ref_missing["value"] is None
    ref_ok = _one(V.referential(child, child, "ri", "k", 0.95, "t", requires=F.when(snap.isNotNull(), F.lit(1))))
    assert ref_ok["passed"] and ref_ok["threshold"] == ">= 95%" and ref_ok["value"] == "100.0%"


def test_log_is_read_back_by_day_and_by_newest_run(spark, tmp_dir):
    from datetime import datetime

    from tidemark.plans import serving as SV
    from tidemark.sinks import tables as T

    ref = date(2024, 1, 31)
    rows = lambda ok: spark.createDataFrame(
        [(ref, t, "d", n, s, ok or n == "b", "1", "2", None if ok or n == "b" else f"{n} failed") for t in ("one", "two") for n, s in (("a", "error"), ("b", "error"), ("c", "warning"))],
        "reference_date date, task string, dataset string, check_name string, severity string, passed boolean, value string, threshold string, message string")
    times = [datetime(2024, 2, 1, 6), datetime(2024, 2, 1, 9), datetime(2024, 2, 2, 6)]
    for at, ok in zip(times, (True, False, True)):
        T.write_check_log(rows(ok), f"{tmp_dir}/log", at)
    log = spark.read.parquet(f"{tmp_dir}/log")
    assert [r[0] for r in SV.logged_dates(log, ref).collect()] == [date(2024, 2, 2), date(2024, 2, 1)]
    assert SV.logged_dates(log, date(2024, 1, 1)).count() == 0
    detail = [tuple(r) for r in SV.log_detail(log, ref, "one", date(2024, 2, 1), latest=True).collect()]
    assert detail == [("c", "warning", False, "1", "2", "c failed", times[1]), ("a", "error", False, "1", "2", "a failed", times[1]), ("b", "error", True, "1", "2", None, times[1])]
    assert SV.log_detail(log, ref, "two").count() == 9 and SV.log_detail(log, ref, "two", latest=True).where("passed").count() == 3
    summary = {r.task: (r.total, r.failed, r.errors, r.last_logged_at) for r in SV.check_summary(SV.log_slice(log, ref, date(2024, 2, 1))).collect()}
    assert summary == {"one": (6, 2, 1, times[1]), "two": (6, 2, 1, times[1])}
