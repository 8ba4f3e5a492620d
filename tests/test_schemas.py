"""Declared schemas: a drifted frame is refused on every write path, and what was stored before stays."""

from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

from tidemark.plans import loads as L
from tidemark.plans import staging as S
from tidemark.plans import universe as U
from tidemark.plans.run import LayerRun
from tidemark.schemas import DECLARED, KEYS, checked, schema_of
from tidemark.settings import fixture_settings
from tidemark.sinks.tables import SchemaContractError

DAY = date(2024, 1, 2)


@pytest.mark.parametrize("table", sorted(DECLARED))
def test_checked(spark, table):
    schema = schema_of(table)
    good = spark.createDataFrame([], schema)
    assert checked(good, table).schema.simpleString() == schema.simpleString()
    assert set(KEYS[table]) <= set(schema.fieldNames())
    with pytest.raises(SchemaContractError, match="new_one: not declared"):
        checked(good.withColumn("new_one", F.lit(1)), table)
    with pytest.raises(SchemaContractError, match=f"{KEYS[table][0]}: missing"):
        checked(good.drop(KEYS[table][0]), table)
    with pytest.raises(SchemaContractError, match=f"{schema.fieldNames()[0]}: array"):
        checked(good.withColumn(schema.fieldNames()[0], F.array(F.lit(1))), table)
    spare = [c for c in schema.fieldNames() if c not in KEYS[table]]
    if spare:
        assert checked(good.drop(spare[-1]), table).columns == schema.fieldNames()
    for f in schema.fields:
        if f.dataType.typeName() == "double":
            assert checked(good.withColumn(f.name, F.col(f.name).cast("int")), table).schema[f.name].dataType == f.dataType


def drifted(build):
    return lambda *a, **k: build(*a, **k).withColumn("drift", F.lit(1))


@pytest.mark.parametrize("module, builder, step", [
    (S, "clean_quotes", "stage_quotes"), (U, "quote_month_summary", "stage_quotes"), (S, "stage_registry", "stage_dimensions"),
    (S, "clean_fees", "stage_dimensions"), (S, "clean_characteristics", "stage_dimensions"), (S, "clean_benchmark", "stage_dimensions")])
def test_layered_run_refuses_drift(spark, tmp_dir, monkeypatch, module, builder, step):
    run = LayerRun(spark, "/root/testdata/sf0.001", tmp_dir, fixture_settings())
    monkeypatch.setattr(module, builder, drifted(getattr(module, builder)))
    with pytest.raises(SchemaContractError, match="drift: not declared"):
        getattr(run, step)()


def test_loads_refuse_drift(spark, tmp_dir, monkeypatch):
    ledger = L.Ledger(spark, f"{tmp_dir}/ledger")
    good = spark.createDataFrame([(DAY, 0.1)], "date date, rate double")
    good.write.parquet(f"{tmp_dir}/landed/a")
    read = lambda paths: spark.read.parquet(*paths)
    load = lambda r: L.load_series(ledger, "cdi_daily", f"{tmp_dir}/raw/cdi_daily", f"{tmp_dir}/landed/*/*.parquet", r, ["date"], "date", DAY, force=True)
    assert load(read) == L.REPLACE
    before = spark.read.parquet(f"{tmp_dir}/raw/cdi_daily").collect()
    for bad in (lambda p: read(p).withColumn("x", F.lit(1)), lambda p: read(p).withColumn("rate", F.col("rate").cast("string"))):
        with pytest.raises(SchemaContractError):
            load(bad)
    assert spark.read.parquet(f"{tmp_dir}/raw/cdi_daily").collect() == before
    with pytest.raises(SchemaContractError, match="CNPJ_FUNDO: missing"):
        L.load_snapshots(ledger, {"cad_fi_hist_taxa_adm": good}, f"{tmp_dir}/raw", DAY)
    monkeypatch.setattr(S, "clean_benchmark", drifted(S.clean_benchmark))
    with pytest.raises(SchemaContractError):
        L.restage_benchmark(spark, good, f"{tmp_dir}/staged/cdi_rates")
    assert [r.action for r in ledger.rows().collect()] == [L.REPLACE]
