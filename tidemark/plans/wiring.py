"""Wiring of the layers over one set of raw tables.

``Layers`` builds each layer lazily from the raw views (by default the
fixture bindings over the driver tables). With ``materialize=True`` the staged quotes
and the marts (universe, metrics, rankings) are written as Parquet into the shared folder once
per application, input folder and settings, and all queries of the application
read them back: serving queries scan a stored mart with pruning and pushdown
instead of staging everything anew, and a lost executor only recomputes from the
last stored mart. The universe, the metrics and the checks all read the quotes, which are cleaned once.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field
from typing import Callable

from pyspark.sql import DataFrame, SparkSession

from ..session import shared_path, stored
from ..settings import Settings, fixture_settings
from ..sources import bindings as B
from . import metrics as M
from . import rankings as R
from . import staging as S
from . import universe as U


#: Paths of stored marts by application, input, settings and name; paths only, no session objects.
_MARTS: dict[tuple, str] = {}


@dataclass
class Layers:
    spark: SparkSession
    sf_dir: str
    settings: Settings = field(default_factory=fixture_settings)
    materialize: bool = False
    _memo: dict = field(default_factory=dict)

    def _get(self, name: str, build: Callable[[], DataFrame], layer: bool = True) -> DataFrame:
        if name not in self._memo:
            df = build()
            if self.materialize and layer:
                df = self._stored(name, df)
            self._memo[name] = df
        return self._memo[name]

    def _stored(self, name: str, df: DataFrame) -> DataFrame:
        key = (self.spark.sparkContext.applicationId, self.sf_dir, repr(self.settings), name)
        if key not in _MARTS:
            path = shared_path(self.spark, "tidemark-marts", f"{name}-{uuid.uuid4().hex}")
            df.write.parquet(path)
            _MARTS[key] = path
        return self.spark.read.schema(df.schema).parquet(_MARTS[key])

    def _written(self, df: DataFrame) -> DataFrame:
        return stored(df, "tidemark-marts", "percentiles")

    def raw(self, name: str) -> DataFrame:
        return self._get(name, lambda: B.BINDINGS[name](self.spark, self.sf_dir), layer=False)

    # staging
    def quotes(self) -> DataFrame:
        return self._get("quotes", lambda: S.clean_quotes(self.raw("fx_inf_diario")))

    def registry(self) -> DataFrame:
        return self._get("registry", lambda: S.stage_registry(self.raw("fx_registro_classe"), self.raw("fx_registro_subclasse")),
                         layer=False)

    def fees(self) -> DataFrame:
        return self._get("fees", lambda: S.clean_fees(self.raw("fx_taxa_adm"), self.raw("fx_taxa_perfm"), self.raw("fx_extrato")),
                         layer=False)

    def characteristics(self) -> DataFrame:
        return self._get("characteristics", lambda: S.clean_characteristics(self.raw("fx_anbima")), layer=False)

    def cdi(self) -> DataFrame:
        return self._get("cdi", lambda: S.clean_benchmark(self.raw("fx_cdi")), layer=False)

    # marts
    def universe(self) -> DataFrame:
        return self._get("universe", lambda: U.build_universe(
            self.registry(), self.fees(), self.quotes(), self.characteristics(), self.settings))

    def metrics(self) -> DataFrame:
        return self._get("metrics", lambda: M.build_metrics(self.quotes(), self.universe(), self.cdi(), self.settings))

    def rankings(self) -> DataFrame:
        return self._get("rankings", lambda: R.build_rankings(
            self.metrics(), self.settings, self._written if self.materialize else lambda df: df))
