"""Load lifecycle of the raw and staged layers: what a run loads, skips, repeats or replaces.

``Ledger`` is an append-only table with one row per decision. A run first asks it what is known of a table, then writes
the table, and only then adds its own row: a run that dies in between leaves no row, so the next one repeats it, and every
write here can be repeated without harm (an upsert by key, or the replacement of a slice).

* ``load_series``: landed files that the ledger does not know yet, or that changed since, are read from the month
  of the table's high-water mark on and upserted by key; nothing new is a skip; ``force`` reads every file from the start.
* ``load_snapshots``: a group of tables is loaded once per run date; ``force`` replaces that date's slice.
* ``restage_quotes``: staged months from the last staged one on are cleaned anew and replaced, seeded from the
  last-value state, so no earlier month of quotes is read.
* ``restage_benchmark``: rates newer than the staged mark, upserted by date.
* ``restage_snapshot``: a staged snapshot from raw tables that each have a newest slice of their own, if there is a newer one.
* ``ingest_all``, ``restage_all``: every source that has landed, and every staged table after it.
"""

from __future__ import annotations

import os
from dataclasses import dataclass
from datetime import date
from typing import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from ..operators import keyed, timeseries as ts
from ..schemas import KEYS, checked
from ..sinks import tables as T
from ..sources import readers as RD
from ..sources import snapshots as SN
from ..sources.readers import landed_files
from . import staging as S

LEDGER = ("dataset string, run_date date, action string, from_date date, high_water date, snapshot_date date, n_rows long, "
          "files array<struct<path:string,mark:string>>, logged_at timestamp")
SKIP, LOAD, REPLACE = "skip", "load", "replace"
#: The raw tables by the names that the ingestion gate gives them.
RAW_TABLES = {
    "inf_diario": "inf_diario", "cdi_daily": "cdi_daily", "registro_classe": "registro_classe", "registro_subclasse": "registro_subclasse",
    "taxa_adm": "cad_fi_hist_taxa_adm", "taxa_perfm": "cad_fi_hist_taxa_perfm", "extrato_fi": "extrato_fi", "anbima": "anbima_caracteristicas",
}


@dataclass
class Ledger:
    spark: SparkSession
    path: str

    def rows(self) -> DataFrame:
        return T.read_table(self.spark, self.path, LEDGER) if T.path_exists(self.spark, self.path) else self.spark.createDataFrame([], LEDGER)

    def known(self, dataset: str) -> Row:
        """high_water, snapshot_date and the newest mark of every file of a dataset; one row, of NULLs before the first load."""
        done = self.rows().where((F.col("dataset") == dataset) & (F.col("action") != SKIP))
        marks = F.max_by("files", "logged_at")
        return done.agg(F.max("high_water").alias("high_water"), F.max("snapshot_date").alias("snapshot_date"), marks.alias("files")).first()

    def add(self, dataset: str, run_date: date, action: str, from_date: date | None = None, high_water: date | None = None,
            snapshot_date: date | None = None, n_rows: int = 0, files: Sequence[tuple[str, str]] | None = None) -> str:
        row = self.spark.createDataFrame([(dataset, run_date, action, from_date, high_water, snapshot_date, n_rows, files, None)], LEDGER)
        row.withColumn("logged_at", F.current_timestamp()).coalesce(1).write.mode("append").parquet(self.path)
        return action


def load_series(ledger: Ledger, dataset: str, target: str, landing: str, read: Callable[[list[str]], DataFrame], key: Sequence[str],
                date_col: str, run_date: date, force: bool = False) -> str:
    """Upsert what has landed under the glob ``landing`` into the month-partitioned series ``target``; returns the action.

    The first load and a forced one take every file. Otherwise only files that are new or changed are read, and of their rows
    those from the month of the high-water mark on: an earlier month comes again by ``force`` only. The ledger holds one
    mark per landed file, and the driver compares them (metadata, one entry a file).
    """
    known, files = ledger.known(dataset), landed_files(ledger.spark, landing)
    seen = {(f["path"], f["mark"]) for f in known["files"] or []}
    again = force or known["high_water"] is None
    fresh = [path for path, mark in files if again or (path, mark) not in seen]
    if not fresh:
        return ledger.add(dataset, run_date, SKIP, high_water=known["high_water"])
    start = None if again else known["high_water"].replace(day=1)
    batch = read(fresh)
    if f"raw.{dataset}" in KEYS:
        batch = checked(batch, f"raw.{dataset}")
    if start is not None:
        batch = batch.where(F.col(date_col) >= F.lit(start).cast("date"))
    if force:
        T.write_timeseries(batch, target, date_col, key)
        stored = T.read_table(ledger.spark, target)
    else:
        stored = T.upsert_timeseries(ledger.spark, batch, target, list(key), date_col)
    mark = stored.where(F.col(date_col) >= F.lit(start).cast("date")) if start is not None else stored
    found = mark.agg(F.max(date_col).alias("high"), F.count(F.lit(1)).alias("n")).first()
    high = max([x for x in (found["high"], known["high_water"]) if x is not None], default=None)
    return ledger.add(dataset, run_date, REPLACE if force else LOAD, start, high, n_rows=found["n"], files=files)


def load_snapshots(ledger: Ledger, frames: Mapping[str, DataFrame], root: str, run_date: date, force: bool = False) -> dict[str, str]:
    """Write every frame as the slice of ``run_date`` of its table under ``root``, unless the ledger has that slice already.

    Older slices are never touched. A forced load, and one that repeats a load that died, replaces its own slice.
    """
    done = {}
    for name, frame in frames.items():
        have = ledger.known(name)["snapshot_date"]
        if have is not None and have >= run_date and not force:
            done[name] = ledger.add(name, run_date, SKIP, snapshot_date=have)
            continue
        path = os.path.join(root, name)
        T.replace_snapshot(checked(frame, f"raw.{name}"), path, run_date)
        n = ledger.spark.read.parquet(path).where(F.col("reference_date") == F.lit(run_date).cast("date")).count()
        again = have is not None and have >= run_date
        done[name] = ledger.add(name, run_date, REPLACE if again else LOAD, snapshot_date=run_date, n_rows=n)
    return done


# ------------------------------------------------------------------ staged quotes with a last-value state

STATE = "fund_cnpj string, subclass_id string, date date, nav double, as_of string"


def last_values(rows: DataFrame) -> DataFrame:
    """The newest row (date, nav) of every series."""
    return keyed.latest_row_per_key(rows.select(*S.SERIES_KEY, "date", "nav"), S.SERIES_KEY, "date")


def clean_from(raw: DataFrame, state: DataFrame) -> DataFrame:
    """Clean raw quotes whose series are seeded with the last values before them; reads nothing but the two."""
    rows = S.rename_quotes(S.mask_active_zero(S.drop_ghost_rows(S.dedupe_quotes(raw))))
    return ts.forward_fill_seeded(rows, state.select(*S.SERIES_KEY, "date", "nav"), S.SERIES_KEY, "date", ["nav"]).select(*S.QUOTE_COLS)


def _replace_months(rows: DataFrame, path: str, first: str | None) -> list[str]:
    """Make ``rows`` the table's months from ``first`` on (all months, if None); months that it no longer has go. Returns its months."""
    spark = rows.sparkSession
    by_month = checked(rows, "staging.daily_quotes").withColumn("quote_month", F.date_format("date", "yyyy-MM"))
    with T.staged(by_month, path) as held:
        months = sorted(r[0] for r in held.select("quote_month").distinct().collect())  # bounded by the calendar
        if first is None:
            T.write_timeseries(held.drop("quote_month"), path)
            return months
        T.replace_partition(held.repartition("quote_month", F.pmod(F.xxhash64(*S.SERIES_KEY), F.lit(T.FILES_PER_MONTH))), path, "quote_month")
    for month in T.partition_values(spark, path, "quote_month"):
        if month >= first and month not in months:
            T.remove_path(spark, os.path.join(path, f"quote_month={month}"))
    return months


def restage_quotes(spark: SparkSession, raw: DataFrame, staged: str, state: str, force: bool = False) -> list[str]:
    """Stage raw quotes from the last staged month on (from the start if nothing is staged, or by ``force``).

    The last staged month is always cleaned again, so a revision of it counts. ``state`` holds, per series, the last
    value before the month ``as_of``, the newest staged one; it seeds the fill, and each run writes its successor. The result
    equals a full rebuild as long as no month before the last staged one changed. Returns the months written.
    """
    held = [] if force else T.partition_values(spark, staged, "quote_month")
    states = [] if force else T.partition_values(spark, state, "as_of")
    # a run that died after the quotes were written has no state of the newest month: take the newest one there is
    month = max((s for s in states if held and s <= max(held)), default=None)
    if month is None:
        seeds, batch = spark.createDataFrame([], STATE).drop("as_of"), raw
    else:
        seeds = spark.read.schema(STATE).parquet(state).where(F.col("as_of") == month).drop("as_of")
        batch = raw.where(F.col("DT_COMPTC") >= F.lit(f"{month}-01").cast("date"))
    months = _replace_months(clean_from(batch.where(F.col("DT_COMPTC").isNotNull()), seeds), staged, month)  # no date, no month
    if not months:
        return []
    new = months[-1]
    written = spark.read.parquet(staged)
    recent = written.where((F.col("quote_month") < new) & (F.lit(True) if month is None else F.col("quote_month") >= month))
    after = last_values(recent.select(*S.SERIES_KEY, "date", "nav").unionByName(seeds)).withColumn("as_of", F.lit(new))
    if force or month is None:
        T.overwrite_table(after, state, "as_of")
    elif new != month:  # the same month's state is as it was
        T.replace_partition(after, state, "as_of")
    return months


def restage_benchmark(spark: SparkSession, raw: DataFrame, staged: str, force: bool = False) -> int:
    """Stage the benchmark's rates newer than the staged mark (all of them by ``force``), upserted by date; returns their number."""
    if force and T.path_exists(spark, staged):
        T.remove_path(spark, staged)
    held = T.read_table(spark, staged)
    with T.staged(checked(S.clean_benchmark(S.incremental_new_rows(raw, held, force)), "staging.cdi_rates"), staged) as rows:
        n = rows.count()
        if n:
            T.upsert_timeseries(spark, rows, staged, ["date"], "date")
    return n


# ------------------------------------------------------------------ snapshots of the staged layer


def restage_snapshot(spark: SparkSession, raw: Mapping[str, str], staged: str, build: Callable[..., DataFrame], force: bool = False) -> str:
    """Build a staged snapshot from raw snapshot tables (name -> path), each at its own newest slice, if the first one's newest
    is newer than the staged one (or by ``force``); stamped with the first one's date. ``build`` takes the frames by name; a
    table that has never been loaded is passed as None. One lazy plan: the newest dates are scalar subqueries.
    """
    first = next(iter(raw.values()))
    if not T.path_exists(spark, first) or not (force or T.raw_newer_than_staged(spark, first, staged)):
        return SKIP
    frames = {name: SN.latest_snapshot_lazy(spark.read.parquet(path)).drop(SN.RD) if T.path_exists(spark, path) else None for name, path in raw.items()}
    again = T.path_exists(spark, staged)
    T.replace_snapshot(checked(build(**frames), f"staging.{os.path.basename(staged)}"), staged, T.max_date(spark, first, SN.RD))
    return REPLACE if force and again else LOAD


def restage_registry(spark: SparkSession, raw_root: str, staged: str, force: bool = False) -> str:
    raw = {n: os.path.join(raw_root, n) for n in ("registro_classe", "registro_subclasse")}
    return restage_snapshot(spark, raw, staged, lambda registro_classe, registro_subclasse: S.stage_registry(registro_classe, registro_subclasse), force)


def restage_fees(spark: SparkSession, raw_root: str, staged: str, force: bool = False) -> str:
    raw = {n: os.path.join(raw_root, n) for n in ("cad_fi_hist_taxa_adm", "cad_fi_hist_taxa_perfm", "extrato_fi")}
    return restage_snapshot(spark, raw, staged, lambda cad_fi_hist_taxa_adm, cad_fi_hist_taxa_perfm, extrato_fi: S.clean_fees(
        cad_fi_hist_taxa_adm, cad_fi_hist_taxa_perfm, extrato_fi), force)


def restage_characteristics(spark: SparkSession, raw_root: str, staged: str, force: bool = False) -> str:
    raw = {"anbima": os.path.join(raw_root, "anbima_caracteristicas")}
    return restage_snapshot(spark, raw, staged, lambda anbima: S.clean_characteristics(anbima), force)


def restage_all(spark: SparkSession, raw_root: str, staged_root: str, force: bool = False) -> tuple[dict[str, str], list[str]]:
    """Bring every staged table up to the raw layer; what was done, by table, and the months of quotes that were written."""
    months: list[str] = []
    staged = lambda name: os.path.join(staged_root, name)
    done = {"registry": restage_registry(spark, raw_root, staged("registry"), force), "fees": restage_fees(spark, raw_root, staged("fees"), force),
            "anbima": restage_characteristics(spark, raw_root, staged("anbima"), force)}
    quotes, rates = (T.read_table(spark, os.path.join(raw_root, n)) for n in ("inf_diario", "cdi_daily"))
    if quotes is not None:
        months = restage_quotes(spark, quotes.drop("quote_month"), staged("daily_quotes"), staged("quote_state"), force)
        done["daily_quotes"] = (REPLACE if force else LOAD) if months else SKIP
    if rates is not None:
        n = restage_benchmark(spark, rates, staged("cdi_rates"), force)
        done["cdi_rates"] = (REPLACE if force else LOAD) if n else SKIP
    return done, months


# ------------------------------------------------------------------ everything that has landed


def read_quotes(spark: SparkSession, rejects: str) -> Callable[[list[str]], DataFrame]:
    """A reader for ``load_series`` that stores the lines that are no quotes (reason, line) by file; a file that is read again
    replaces its rejects."""

    def read(paths: list[str]) -> DataFrame:
        lines = RD.read_quotes_or_reasons(spark, paths)
        for path in paths:
            T.remove_path(spark, os.path.join(rejects, f"file={os.path.basename(path)}"))
        T.replace_partition(lines.where(F.col("reason").isNotNull()).select("reason", "line", "file"), rejects, "file")
        return lines.where(F.col("reason").isNull()).select(*RD.QUOTE_COLUMNS)

    return read


def ingest_all(ledger: Ledger, landing: str, raw_root: str, run_date: date, force: bool = False) -> dict[str, str]:
    """Load every source that has landed under ``landing``; what was done, by table. Sources without files are left out.

    Layout: ``inf_diario/*.csv`` (monthly quotes), ``cdi/*.json`` (rates), ``registro/``, ``cad_fi_hist/`` and ``extrato/``
    (tables as CSV; of the extract the run's year), ``anbima/*.csv``.
    """
    spark = ledger.spark
    raw = lambda name: os.path.join(raw_root, name)
    has = lambda pattern: bool(landed_files(spark, os.path.join(landing, pattern)))
    done = {}
    if has("inf_diario/*.csv"):
        done["inf_diario"] = load_series(ledger, "inf_diario", raw("inf_diario"), os.path.join(landing, "inf_diario/*.csv"),
                                         read_quotes(spark, raw("inf_diario_rejects")), S.RAW_QUOTE_KEY, "DT_COMPTC", run_date, force)
    if has("cdi/*.json"):
        done["cdi_daily"] = load_series(ledger, "cdi_daily", raw("cdi_daily"), os.path.join(landing, "cdi/*.json"),
                                        lambda paths: RD.read_benchmark_json(spark, paths), ["date"], "date", run_date, force)
    frames = {}
    for folder, names in {"registro": ("registro_classe", "registro_subclasse"), "cad_fi_hist": ("cad_fi_hist_taxa_adm", "cad_fi_hist_taxa_perfm")}.items():
        frames |= RD.read_members(spark, os.path.join(landing, folder), [n for n in names if has(f"{folder}/{n}.csv")])
    year = f"extrato/extrato_fi_{run_date.year}.csv"
    if has(year):
        frames["extrato_fi"] = RD.read_year_extract(spark, os.path.join(landing, year))
    if has("anbima/*.csv"):
        frames["anbima_caracteristicas"] = RD.read_characteristics(spark, os.path.join(landing, "anbima/*.csv"), {})
    return done | load_snapshots(ledger, frames, raw_root, run_date, force)
