"""Write patterns on temporary folders: null-safe upsert, append, idempotent replace, high-water mark."""

from __future__ import annotations

import os
from datetime import date

import pytest
from pyspark.sql import functions as F

from tidemark.sinks import tables as T
from tidemark.sources import snapshots as SN

KEY = ["CNPJ_FUNDO_CLASSE", "ID_SUBCLASSE", "DT_COMPTC"]
Q_SCHEMA = "CNPJ_FUNDO_CLASSE string, ID_SUBCLASSE string, DT_COMPTC date, VL_QUOTA double"


def test_upsert_null_safe_replaces_value(spark, tmp_dir):
    path = os.path.join(tmp_dir, "inf_diario")
    first = spark.createDataFrame([("00.000.000/0001-91", None, date(2024, 1, 2), 1.0)], Q_SCHEMA)
    T.write_timeseries(first, path, "DT_COMPTC", key=["CNPJ_FUNDO_CLASSE", "ID_SUBCLASSE"])
    second = spark.createDataFrame([("00.000.000/0001-91", None, date(2024, 1, 2), 2.0)], Q_SCHEMA)
    T.upsert_timeseries(spark, second, path, KEY, "DT_COMPTC")
    rows = spark.read.parquet(path).collect()
    assert len(rows) == 1 and rows[0]["VL_QUOTA"] == 2.0


def test_upsert_touches_only_batch_months_and_keeps_batch_duplicates(spark, tmp_dir):
    path = os.path.join(tmp_dir, "ts")
    base = spark.createDataFrame(
        [("A", None, date(2024, 1, 2), 1.0), ("A", None, date(2024, 2, 1), 1.5), ("B", "x", date(2024, 2, 1), 9.0)], Q_SCHEMA)
    T.write_timeseries(base, path, "DT_COMPTC", key=["CNPJ_FUNDO_CLASSE", "ID_SUBCLASSE"])
    batch = spark.createDataFrame([("A", None, date(2024, 2, 1), 3.0), ("A", None, date(2024, 2, 1), 4.0)], Q_SCHEMA)
    T.upsert_timeseries(spark, batch, path, KEY, "DT_COMPTC")
    got = sorted((r["CNPJ_FUNDO_CLASSE"], str(r["DT_COMPTC"]), r["VL_QUOTA"]) for r in spark.read.parquet(path).collect())
    assert got == [("A", "2024-01-02", 1.0), ("A", "2024-02-01", 3.0), ("A", "2024-02-01", 4.0), ("B", "2024-02-01", 9.0)]


def test_upsert_equals_full_rebuild(spark, tmp_dir):
    rows = [("A", None, date(2024, m, d), float(m * 10 + d)) for m in (1, 2, 3) for d in (1, 2)]
    full = spark.createDataFrame(rows, Q_SCHEMA)
    path = os.path.join(tmp_dir, "inc")
    T.write_timeseries(full.where(F.month("DT_COMPTC") < 3), path, "DT_COMPTC", key=["CNPJ_FUNDO_CLASSE"])
    T.upsert_timeseries(spark, full.where(F.month("DT_COMPTC") >= 2), path, KEY, "DT_COMPTC")
    got = sorted(tuple(r) for r in spark.read.parquet(path).drop("quote_month").collect())
    assert got == sorted(tuple(r) for r in full.collect())


def test_empty_upsert_is_noop(spark, tmp_dir):
    path = os.path.join(tmp_dir, "noop")
    base = spark.createDataFrame([("A", None, date(2024, 1, 2), 1.0)], Q_SCHEMA)
    T.write_timeseries(base, path, "DT_COMPTC", key=["CNPJ_FUNDO_CLASSE"])
    T.upsert_timeseries(spark, base.limit(0), path, KEY, "DT_COMPTC")
    assert spark.read.parquet(path).count() == 1


def test_max_date_high_water_mark(spark, tmp_dir):
    path = os.path.join(tmp_dir, "hw")
    assert T.max_date(spark, path, "DT_COMPTC") is None  # missing table
    df = spark.createDataFrame([("A", None, date(2024, 1, 1)), ("A", None, date(2024, 3, 1))],
                               "CNPJ_FUNDO_CLASSE string, ID_SUBCLASSE string, DT_COMPTC date")
    df.write.parquet(path)
    assert T.max_date(spark, path, "DT_COMPTC") == date(2024, 3, 1)


def test_append_snapshot_keeps_versions(spark, tmp_dir):
    path = os.path.join(tmp_dir, "cdi")
    df = spark.createDataFrame([(date(2024, 1, 1), 0.0004)], "date date, rate double")
    T.append_snapshot(df, path, date(2024, 1, 5))
    T.append_snapshot(df, path, date(2024, 1, 12))
    got = spark.read.parquet(path)
    assert got.count() == 2
    assert sorted(str(r[0]) for r in got.select("reference_date").collect()) == ["2024-01-05", "2024-01-12"]


def test_replace_partition_idempotent_and_isolated(spark, tmp_dir):
    path = os.path.join(tmp_dir, "derived")
    s = "fund_cnpj string, subclass_id string, fund_name string, reference_date date"
    d1 = spark.createDataFrame([("A", None, "x", date(2024, 1, 1))], s)
    d2 = spark.createDataFrame([("B", "s", "y", date(2024, 2, 1)), ("C", None, "z", date(2024, 2, 1))], s)
    T.replace_partition(d1, path)
    T.replace_partition(d2, path)
    T.replace_partition(d2, path)  # twice = once
    got = spark.read.parquet(path)
    assert got.count() == 3
    T.replace_partition(spark.createDataFrame([("Z", None, "w", date(2024, 2, 1))], s), path)
    assert sorted(r[0] for r in spark.read.parquet(path).select("fund_cnpj").collect()) == ["A", "Z"]
    T.replace_partition(spark.createDataFrame([], s), path)  # empty frame leaves the slices
    assert spark.read.parquet(path).count() == 2


def test_align_columns_and_contract(spark):
    from pyspark.sql.types import DoubleType, StringType, StructField, StructType

    schema = StructType([StructField("a", StringType()), StructField("b", DoubleType())])
    df = spark.createDataFrame([("x",)], "a string")
    out = T.align_columns(df, schema)
    assert out.columns == ["a", "b"] and out.first()["b"] is None
    with pytest.raises(T.SchemaContractError):
        T.align_columns(spark.createDataFrame([("x", 1)], "a string, c int"), schema)
    assert T.schema_contract(df, schema) == {"missing": ["b"], "extra": []}


def test_snapshot_selection(spark):
    s = spark.createDataFrame([(date(2025, m, 1), m) for m in (3, 4, 5, 6)], "reference_date date, v int")
    ref = date(2025, 5, 10)
    assert SN.snapshot_date(s, ref) == date(2025, 5, 1)
    assert SN.as_of_snapshot(s, ref).first()["v"] == 5
    assert SN.as_of_snapshot_date(s, date(2025, 1, 1)) == date(2025, 3, 1)  # earliest after, for backfills
    assert SN.snapshot_date(s, date(2025, 1, 1)) is None  # validators: no future fallback
    assert SN.latest_snapshot(s).first()["v"] == 6


def test_null_report(spark):
    df = spark.createDataFrame([(None, 1.0), ("a", None), (None, None)], "a string, b double")
    got = {r["column"]: r["n_null"] for r in T.null_report(df).collect()}
    assert got == {"a": 2, "b": 2}


def test_slice_exists_skip_rule(spark, tmp_dir):
    path = os.path.join(tmp_dir, "u")
    df = spark.createDataFrame([("A", date(2024, 1, 1))], "fund_cnpj string, reference_date date")
    assert T.should_run(spark, path, date(2024, 1, 1))
    T.replace_partition(df, path)
    assert not T.should_run(spark, path, date(2024, 1, 1))
    assert T.should_run(spark, path, date(2024, 1, 1), force=True)


def test_lazy_as_of_snapshot_matches(spark, tmp_dir):
    path = os.path.join(tmp_dir, "snaps")
    s = spark.createDataFrame([(date(2025, m, 1), m) for m in (3, 4, 5, 6)], "reference_date date, v int")
    s.write.partitionBy("reference_date").parquet(path)
    t = spark.read.parquet(path)
    for ref in (date(2025, 5, 10), date(2025, 1, 1), date(2026, 1, 1)):
        assert sorted(r["v"] for r in SN.as_of_snapshot_lazy(t, ref).collect()) == \
            sorted(r["v"] for r in SN.as_of_snapshot(t, ref).collect())
    assert SN.as_of_snapshot_lazy(t.where(F.lit(False)), date(2025, 5, 10)).count() == 0


def _months(spark, path):
    return sorted((r["DT_COMPTC"].month, r["VL_QUOTA"]) for r in spark.read.parquet(path).collect())


def test_upsert_after_rebuild_keeps_rebuilt_months(spark, tmp_dir):
    path = os.path.join(tmp_dir, "rebuilt")
    month = lambda m, v: spark.createDataFrame([("A", None, date(2024, m, 2), v)], Q_SCHEMA)
    T.upsert_timeseries(spark, month(1, 1.0), path, KEY, "DT_COMPTC")
    T.write_timeseries(month(1, 2.0), path, "DT_COMPTC", key=["CNPJ_FUNDO_CLASSE"])
    T.upsert_timeseries(spark, month(2, 3.0), path, KEY, "DT_COMPTC")
    assert _months(spark, path) == [(1, 2.0), (2, 3.0)]
    assert os.listdir(tmp_dir) == ["rebuilt"]  # staging folders are gone


def test_rebuild_removes_stale_months(spark, tmp_dir):
    path = os.path.join(tmp_dir, "stale")
    rows = [("A", None, date(2024, m, 2), float(m)) for m in (1, 2)]
    T.write_timeseries(spark.createDataFrame(rows, Q_SCHEMA), path, "DT_COMPTC", key=["CNPJ_FUNDO_CLASSE"])
    T.write_timeseries(spark.createDataFrame(rows[1:], Q_SCHEMA), path, "DT_COMPTC", key=["CNPJ_FUNDO_CLASSE"])
    assert _months(spark, path) == [(2, 2.0)]


def test_upsert_writes_few_files_per_month(spark, tmp_dir):
    path = os.path.join(tmp_dir, "files")
    rows = [(str(i), None, date(2024, m, 2), 1.0) for m in range(1, 13) for i in range(50)]
    T.upsert_timeseries(spark, spark.createDataFrame(rows, Q_SCHEMA).repartition(16), path, KEY, "DT_COMPTC")
    for month in os.listdir(path):
        if month.startswith("quote_month"):
            assert len([f for f in os.listdir(os.path.join(path, month)) if f.endswith(".parquet")]) <= T.FILES_PER_MONTH


def test_snapshot_replace_is_idempotent(spark, tmp_dir):
    path = os.path.join(tmp_dir, "snapshot")
    df = spark.createDataFrame([("A", 1)], "fund_cnpj string, n int")
    for _ in range(2):
        T.replace_snapshot(df, path, date(2024, 1, 1))
    T.replace_snapshot(df, path, date(2024, 2, 1))
    assert spark.read.parquet(path).count() == 2
