"""The whole load lifecycle of the layered run over landed text files: load, repeat, new files, force."""

from __future__ import annotations

import json
import os
from datetime import date

import pytest
from pyspark.sql import functions as F

from tidemark.plans import loads as L
from tidemark.plans import staging as S
from tidemark.plans import universe as U
from tidemark.plans.run import LayerRun
from tidemark.settings import fixture_settings
from tidemark.sinks import tables as T
from tidemark.sources import bindings as B

SF = "/root/testdata/sf0.001"
DAY = date(2001, 6, 29)


def land(df, path):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    df.toPandas().to_csv(path, sep=";", index=False, encoding="latin-1")


@pytest.fixture(scope="module")
def landing(spark, tmp_path_factory):
    if not os.path.exists(SF):
        pytest.skip("test data not available")
    root = str(tmp_path_factory.mktemp("landing"))
    quotes = B.fx_inf_diario(spark, SF).drop("tb1", "tb2", "tb3")
    for year in range(1995, 2001):
        land(quotes.where(F.year("DT_COMPTC") == year), f"{root}/inf_diario/inf_diario_{year}.csv")
    land(B.fx_registro_classe(spark, SF).where("ID_Registro_Fundo > 0"), f"{root}/registro/registro_classe.csv")
    land(B.fx_registro_subclasse(spark, SF), f"{root}/registro/registro_subclasse.csv")
    land(B.fx_taxa_adm(spark, SF), f"{root}/cad_fi_hist/cad_fi_hist_taxa_adm.csv")
    land(B.fx_taxa_perfm(spark, SF), f"{root}/cad_fi_hist/cad_fi_hist_taxa_perfm.csv")
    land(B.fx_extrato(spark, SF), f"{root}/extrato/extrato_fi_{DAY.year}.csv")
    land(B.fx_anbima(spark, SF), f"{root}/anbima/caracteristicas.csv")
    os.makedirs(f"{root}/cdi")
    with open(f"{root}/cdi/rates.json", "w") as f:
        json.dump([{"data": r.date.strftime("%d/%m/%Y"), "valor": str(r.rate * 100)} for r in B.fx_cdi(spark, SF).collect()], f)
    return root


def rows(df):
    return sorted(map(str, df.collect()))


def test_refresh(spark, landing, tmp_path_factory):
    run = LayerRun(spark, SF, str(tmp_path_factory.mktemp("run")), fixture_settings())
    path = f"file:{landing}"
    first = run.refresh(path, DAY)
    assert set(first.values()) == {L.LOAD} and len(first) == 13
    again = run.refresh(path, DAY)
    staged_again = {k for k, v in again.items() if v != L.SKIP}
    assert staged_again == {"staging.daily_quotes"}  # the last staged month is always cleaned again

    def expect(quotes_until):
        raw = spark.read.parquet(run.path("raw", "inf_diario")).drop("quote_month")
        assert raw.agg(F.max("DT_COMPTC")).first()[0].year == quotes_until
        want = S.clean_quotes(raw)
        assert rows(run.quotes().select(*want.columns)) == rows(want)
        summary = spark.read.parquet(run.path("staging", "quote_month_summary"))
        assert rows(summary) == rows(U.quote_month_summary(run.quotes()).select(*summary.columns))

    expect(2000)
    land(B.fx_inf_diario(spark, SF).drop("tb1", "tb2", "tb3").where(F.year("DT_COMPTC") == 2001), f"{landing}/inf_diario/inf_diario_2001.csv")
    third = run.refresh(path, DAY)
    assert third["raw.inf_diario"] == L.LOAD and third["raw.cdi_daily"] == third["staging.fees"] == L.SKIP
    expect(2001)
    forced = run.refresh(path, DAY, force=True)
    assert {v for k, v in forced.items()} == {L.REPLACE}
    expect(2001)
    next_day = run.refresh(path, date(2001, 6, 30))
    assert {k for k, v in next_day.items() if v == L.LOAD} == {k for k in next_day if k not in ("raw.inf_diario", "raw.cdi_daily", "staging.cdi_rates")}
    registry = spark.read.parquet(run.path("staging", "registry"))
    assert sorted(r[0] for r in registry.select("reference_date").distinct().collect()) == [DAY, date(2001, 6, 30)]
    assert run.cdi().count() == B.fx_cdi(spark, SF).count()
    log = spark.read.parquet(run.path("logs", "validation_log"))
    assert [r[0] for r in log.select("task").distinct().collect()] == ["validate_ingestion"]
    assert T.partition_values(spark, run.path("staging", "registry"), "reference_date") == ["2001-06-29", "2001-06-30"]
