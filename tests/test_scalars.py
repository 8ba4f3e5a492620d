"""Scalar column functions."""

from __future__ import annotations

import random
from datetime import date, timedelta

import numpy as np
from pyspark.sql import functions as F

from tidemark.functions import scalars as X


def test_format_key(spark):
    df = spark.createDataFrame([("191",), ("00.000.000/0001-91",), (None,), ("123456789012345",), ("ab12",)], "k string")
    out = [r[0] for r in df.select(X.format_key(F.col("k"))).collect()]
    assert out == [
        "00.000.000/0001-91",
        "00.000.000/0001-91",
        "00.000.000/0000-00",   # NULL renders as zeros
        "12.345.678/9012-345",  # more than 14 digits spill into the last part
        "00.000.000/0000-12",
    ]


def test_business_days_matches_numpy(spark):
    rng = random.Random(7)
    pairs = []
    for _ in range(300):
        a = date(1995, 1, 1) + timedelta(days=rng.randrange(0, 9000))
        b = a + timedelta(days=rng.randrange(0, 800))
        pairs.append((a, b))
    df = spark.createDataFrame(pairs, "a date, b date")
    got = [r[0] for r in df.select(X.business_days(F.col("a"), F.col("b"))).collect()]
    want = [int(np.busday_count(a, b + timedelta(days=1))) for a, b in pairs]
    assert got == want


def test_month_range_and_floor(spark):
    df = spark.createDataFrame([(date(2024, 11, 30), date(2025, 2, 3))], "a date, b date")
    r = df.select(X.month_range(F.col("a"), F.col("b")).alias("m"), X.month_floor(F.col("a")).alias("f")).first()
    assert r["m"] == ["202411", "202412", "202501", "202502"]
    assert r["f"] == date(2024, 11, 1)


def test_months_back_clamps_to_month_end(spark):
    r = spark.range(1).select(X.months_back(F.lit("2024-03-31").cast("date"), 1).alias("d")).first()
    assert r["d"] == date(2024, 2, 29)


def test_fee_normalisation_and_flags(spark):
    df = spark.createDataFrame([(1.5, "S"), (150.0, "N"), (None, None), (5.0, "X")], "fee double, flag string")
    out = df.select(X.normalise_fee(F.col("fee")).alias("f"), X.flag_from_yn(F.col("flag")).alias("b"),
                    X.flag_positive(F.col("fee")).alias("p")).collect()
    assert [r["f"] for r in out] == [1.5, 1.5, None, 5.0]
    assert [r["b"] for r in out] == [True, False, None, None]
    assert [r["p"] for r in out] == [True, True, None, True]


def test_normalise_code_and_coercion(spark):
    df = spark.createDataFrame([(" 12 ", "3.5", "2024-01-31"), ("", "n/d", "bad"), (None, None, None)], "c string, n string, d string")
    out = df.select(X.normalise_code(F.col("c")).alias("c"), X.to_number_or_null(F.col("n")).alias("n"),
                    X.to_date_or_null(F.col("d")).alias("d")).collect()
    assert [r["c"] for r in out] == ["12", None, None]
    assert [r["n"] for r in out] == [3.5, None, None]
    assert [r["d"] for r in out] == [date(2024, 1, 31), None, None]
    num = spark.createDataFrame([(123.0,)], "c double")
    assert num.select(X.normalise_code(F.col("c"), num.schema["c"].dataType)).first()[0] == "123"


def test_scores(spark):
    r = spark.range(1).select(
        X.span_score(F.lit(365.0), 0.5).alias("s"),
        X.liquidity_score(F.lit(5.0), 0.2).alias("l"),
        X.accessibility_score(F.lit(100000.0), 100000.0).alias("a"),
        X.name_search(F.lit("Supplier#000000011 A"), "plier#00000001").alias("m"),
    ).first()
    assert abs(r["s"] - (1 - np.exp(-0.5))) < 1e-15
    assert abs(r["l"] - np.exp(-1.0)) < 1e-15 and abs(r["a"] - np.exp(-1.0)) < 1e-15
    assert r["m"] is True
