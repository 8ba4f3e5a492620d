"""The full as-of run over stored layers (the production lifecycle, E1/E2).

raw views -> staging tables -> staging gate -> universe -> metrics ->
rankings -> marts gate -> publish. Each layer is written once (parquet under
``root``) and the next layer reads it back, so every step's plan starts at a
stored table and a failure re-runs from the last stored layer.
"""

from __future__ import annotations

import os
import time
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from datetime import date, timedelta
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import checks as V
from ..schemas import checked
from ..settings import Settings
from ..sinks import tables as T
from ..sources import bindings as B
from ..sources import snapshots as SN
from . import gates as G
from . import loads as LD
from . import metrics as M
from . import rankings as R
from . import serving as SV
from . import staging as S
from . import universe as U


@dataclass
class LayerRun:
    spark: SparkSession
    sf_dir: str
    root: str
    settings: Settings
    timings: dict[str, float] = field(default_factory=dict)

    def path(self, *parts: str) -> str:
        return os.path.join(self.root, *parts)

    def _timed(self, name: str, fn: Callable[[], object]) -> object:
        t = time.perf_counter()
        out = fn()
        self.timings[name] = round(time.perf_counter() - t, 3)
        return out

    # ---------------------------------------------------------------- readers of stored layers
    def quotes(self, lo: date | None = None, hi: date | None = None) -> DataFrame:
        """Stored quotes; a date range also prunes the month partitions at the scan."""
        df = self.spark.read.parquet(self.path("staging", "daily_quotes"))
        if lo is not None:
            df = df.where(F.col("quote_month") >= F.lit(lo.strftime("%Y-%m")))
        if hi is not None:
            df = df.where(F.col("quote_month") <= F.lit(hi.strftime("%Y-%m")))
        return df.drop("quote_month")

    def snap(self, name: str) -> DataFrame:
        return SN.as_of_snapshot_lazy(self.spark.read.parquet(self.path("staging", name)), self.settings.reference_date)

    def cdi(self) -> DataFrame:
        return self.spark.read.parquet(self.path("staging", "cdi_rates")).select("date", "rate")

    def mart(self, name: str) -> DataFrame:
        return SN.scan_where(self.spark.read.parquet(self.path("marts", name)), "reference_date",
                             eq=self.settings.reference_date)

    # ---------------------------------------------------------------- steps
    def stage_quotes(self) -> None:
        T.write_timeseries(checked(S.clean_quotes(B.fx_inf_diario(self.spark, self.sf_dir)), "staging.daily_quotes"), self.path("staging", "daily_quotes"))
        # per (series, month) span and count, partitioned like the quotes
        T.overwrite_table(checked(U.quote_month_summary(self.quotes()), "staging.quote_month_summary"), self.path("staging", "quote_month_summary"), "quote_year")

    def load_quotes_increment(self, raw_batch: DataFrame) -> list[str]:
        """C6/C7 incremental load: clean a batch of raw quotes seeded from the stored
        rows before it (W5), upsert it into the touched month partitions (K1), then
        refresh those months of the monthly summary. Returns the touched months."""
        qpath = self.path("staging", "daily_quotes")
        first = raw_batch.agg(F.min("DT_COMPTC").alias("m")).first()["m"]
        if first is None:
            return []
        seeds = S.seed_rows(self.spark.read.parquet(qpath),
                            self.spark.read.parquet(self.path("staging", "quote_month_summary")), first)
        clean = S.clean_quotes_incremental(raw_batch, self.quotes(), seeds)
        months = sorted(r[0] for r in clean.select(F.date_format("date", "yyyy-MM")).distinct().collect())
        if not months:
            return []
        T.upsert_timeseries(self.spark, checked(clean, "staging.daily_quotes"), qpath, [*S.SERIES_KEY, "date"], "date")
        self._refresh_summary(months)
        return months

    def _refresh_summary(self, months: list[str]) -> None:
        """The touched years of the summary keep their other months' rows and get the touched months recomputed;
        staged first, then swapped in by partition."""
        qpath, spath = self.path("staging", "daily_quotes"), self.path("staging", "quote_month_summary")
        years = sorted({int(m[:4]) for m in months})
        touched = self.spark.read.parquet(qpath).where(F.col("quote_month").isin(months)).drop("quote_month")
        fresh = checked(U.quote_month_summary(touched), "staging.quote_month_summary")
        if not T.path_exists(self.spark, spath):
            T.overwrite_table(fresh, spath, "quote_year")
            return
        kept = (self.spark.read.parquet(spath).where(F.col("quote_year").isin(years))
                .where(~F.col("quote_month").isin(months)))
        with T.staged(kept.unionByName(fresh.select(*kept.columns)), spath) as rows:
            T.replace_partition(rows, spath, "quote_year")

    def refresh(self, landing: str, run_date: date, force: bool = False) -> dict[str, str]:
        """Load what has landed, gate the raw layer if anything came in, bring the staged tables up to it.
        Returns what was done, by raw and staged table (``raw.`` and ``staging.`` names)."""
        raw_root = self.path("raw")
        ledger = LD.Ledger(self.spark, self.path("logs", "load_ledger"))
        loaded = LD.ingest_all(ledger, landing, raw_root, run_date, force)
        if set(loaded.values()) - {LD.SKIP}:
            raw = {name: T.read_table(self.spark, os.path.join(raw_root, folder)) for name, folder in LD.RAW_TABLES.items()}
            if all(df is not None for df in raw.values()):
                res = G.ingestion_checks(raw, self.settings)
                V.gate(res, "validate_ingestion", lambda r: T.write_check_log(r, self.path("logs", "validation_log")))
        staged, months = LD.restage_all(self.spark, raw_root, self.path("staging"), force)
        if months:
            if force:
                T.remove_path(self.spark, self.path("staging", "quote_month_summary"))
            self._refresh_summary(months)
        return {f"raw.{k}": v for k, v in loaded.items()} | {f"staging.{k}": v for k, v in staged.items()}

    def stage_dimensions(self) -> None:
        """Registry, fees and characteristics snapshots plus the benchmark: four
        independent jobs, submitted concurrently (Spark runs jobs from several
        driver threads side by side)."""
        ref = self.settings.reference_date
        sp, sf = self.spark, self.sf_dir
        writes = [
            lambda: T.replace_snapshot(checked(S.stage_registry(B.fx_registro_classe(sp, sf), B.fx_registro_subclasse(sp, sf)), "staging.registry"),
                                      self.path("staging", "registry"), ref),
            lambda: T.replace_snapshot(checked(S.clean_fees(B.fx_taxa_adm(sp, sf), B.fx_taxa_perfm(sp, sf), B.fx_extrato(sp, sf)), "staging.fees"),
                                      self.path("staging", "fees"), ref),
            lambda: T.replace_snapshot(checked(S.clean_characteristics(B.fx_anbima(sp, sf)), "staging.anbima"), self.path("staging", "anbima"), ref),
            lambda: T.overwrite_table(checked(S.clean_benchmark(B.fx_cdi(sp, sf)), "staging.cdi_rates"), self.path("staging", "cdi_rates")),
        ]
        with ThreadPoolExecutor(max_workers=len(writes)) as pool:
            for f in [pool.submit(w) for w in writes]:
                f.result()

    def staging_gate(self) -> DataFrame:
        stg = {"daily_quotes": self.quotes(),
               "registry": self.spark.read.parquet(self.path("staging", "registry")),
               "fees": self.spark.read.parquet(self.path("staging", "fees")),
               "cdi_rates": self.cdi(),
               "anbima": self.spark.read.parquet(self.path("staging", "anbima"))}
        res = G.staging_checks(stg, self.settings, M.quotes_start(self.settings))
        return V.gate(res, "validate_staging", lambda r: T.write_check_log(r, self.path("logs", "validation_log")))

    def universe_stats(self) -> DataFrame:
        """A1 from the monthly summary plus only the months of the medians' look-back."""
        st = self.settings
        ref = st.reference_date
        lo = ref - timedelta(days=st.universe.aum_lookback_days)
        summary = self.spark.read.parquet(self.path("staging", "quote_month_summary"))
        return U.quote_stats_from_summary(summary, self.quotes(lo, ref), ref, st.universe.aum_lookback_days)

    def build_universe(self) -> None:
        u = U.build_universe(self.snap("registry").drop("reference_date"), self.snap("fees").drop("reference_date"),
                             self.quotes(hi=self.settings.reference_date), self.snap("anbima").drop("reference_date"),
                             self.settings, stats=self.universe_stats())
        T.replace_partition(checked(u, "marts.universe"), self.path("marts", "universe"))

    def build_metrics(self) -> None:
        st = self.settings
        m = M.build_metrics(self.quotes(M.quotes_start(st), st.reference_date), self.mart("universe"), self.cdi(), st)
        T.replace_partition(checked(m, "marts.metrics"), self.path("marts", "metrics"))

    def build_rankings(self) -> None:
        T.replace_partition(checked(R.build_rankings(self.mart("metrics"), self.settings), "marts.rankings"), self.path("marts", "rankings"))

    def marts_gate(self) -> DataFrame:
        marts = {n: self.spark.read.parquet(self.path("marts", n)) for n in ("universe", "metrics", "rankings")}
        res = G.marts_checks(marts, self.settings)
        # the marts gate warns on the synthetic data; errors would raise here
        return V.gate(res, "validate_marts", lambda r: T.write_check_log(r, self.path("logs", "validation_log")))

    def publish(self) -> dict:
        st = self.settings
        top = SV.top_n_per_segment(self.mart("rankings"), st.top_n)
        segs = self.spark.createDataFrame(
            [(i, s.purpose, s.profile, s.investor_type) for i, s in enumerate(st.segments)],
            "seg_order int, purpose string, profile string, investor_type string")
        payload = SV.segment_payload(top, self.mart("universe"), segs, st.reference_date)
        T.publish(payload, [T.json_dir_sink(self.path("output", f"ranking_{st.reference_date.isoformat()}"))])
        T.write_metrics_parquet(self.mart("metrics"), self.path("output"), st.reference_date)
        return T.payload_to_dict(self.spark.read.json(self.path("output", f"ranking_{st.reference_date.isoformat()}")))

    def run_all(self) -> dict[str, float]:
        self._timed("clean_quotes", self.stage_quotes)
        self._timed("stage_dimensions", self.stage_dimensions)
        self._timed("staging_gate", lambda: self.staging_gate().collect())
        self._timed("build_universe", self.build_universe)
        self._timed("build_metrics", self.build_metrics)
        self._timed("build_rankings", self.build_rankings)
        self._timed("marts_gate", lambda: self.marts_gate().collect())
        self._timed("publish", self.publish)
        return self.timings
