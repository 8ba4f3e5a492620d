"""Registered queries: one per operator / pipeline of SURVEY §2.

Each takes (spark, sf_dir) and returns a DataFrame over the whole driver
tables (through the fixture bindings). The DuckDB twin of each lives in
``oracle/queries.py`` under the same key and with the same column names.
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .functions import scalars as X
from .operators import keyed, ranking as RK, timeseries as ts
from .plans import loads as LD
from .plans import metrics as M
from .plans import rankings as R
from .plans import staging as S
from .plans import universe as U
from .operators import checks as V
from .plans import gates as G
from .plans import serving as SV
from .plans.wiring import Layers
from .settings import fixture_settings
from .sinks import tables as T
from .sources import bindings as B
from .sources import readers as RD
from .sources import snapshots as SN

SK = ["fund_cnpj", "subclass_id"]
SPLIT_DATE = date(2000, 1, 1)  # batch boundary for the incremental fill check


def _p(spark: SparkSession, sf_dir: str, materialize: bool = False) -> Layers:
    return Layers(spark, sf_dir, fixture_settings(), materialize)


def _pm(spark: SparkSession, sf_dir: str) -> Layers:
    """A pipeline whose layers are stored once (for queries that read several layers)."""
    return _p(spark, sf_dir, True)


# ------------------------------------------------------------------ staging / cleaning


def q_dedupe_first(spark, sf):
    raw = _p(spark, sf).raw("fx_inf_diario")
    return S.dedupe_quotes(raw).drop("tb1", "tb2", "tb3")


def q_forward_fill(spark, sf):
    """W4 alone: fill VL_QUOTA and NR_COTST over the de-duplicated raw rows."""
    d = S.dedupe_quotes(_p(spark, sf).raw("fx_inf_diario"))
    d = d.withColumn("VL_QUOTA", F.when(F.col("VL_QUOTA") != 0, F.col("VL_QUOTA")))
    d = d.withColumn("NR_COTST", F.when(F.col("NR_COTST") != 0, F.col("NR_COTST")))
    out = ts.forward_fill(d, ["CNPJ_FUNDO_CLASSE", "ID_SUBCLASSE"], "DT_COMPTC", ["VL_QUOTA", "NR_COTST"])
    return out.select("CNPJ_FUNDO_CLASSE", "ID_SUBCLASSE", "DT_COMPTC", "VL_QUOTA", "NR_COTST")


def q_clean_quotes(spark, sf):
    return _p(spark, sf).quotes()


def q_forward_fill_seeded(spark, sf):
    p = _p(spark, sf)
    raw = p.raw("fx_inf_diario")
    cut = F.lit(SPLIT_DATE).cast("date")
    staged = S.clean_quotes(raw.where(F.col("DT_COMPTC") < cut))
    return S.clean_quotes_incremental(raw.where(F.col("DT_COMPTC") >= cut), staged)


def q_clean_registry_class(spark, sf):
    return S.clean_registry_class(_p(spark, sf).raw("fx_registro_classe")).drop("ID_Registro_Classe")


def q_class_subclass(spark, sf):
    return _p(spark, sf).registry()


def q_last_non_null_per_column(spark, sf):
    return S.clean_admin_fees(_p(spark, sf).raw("fx_taxa_adm"))


def q_fees_full(spark, sf):
    p = _p(spark, sf)
    return S.fees_full(S.clean_admin_fees(p.raw("fx_taxa_adm")), S.clean_perf_fees(p.raw("fx_taxa_perfm")))


def q_clean_fees(spark, sf):
    return _p(spark, sf).fees()


def q_clean_characteristics(spark, sf):
    return _p(spark, sf).characteristics().select(
        "fund_cnpj", "subclass_id", "structure", "commercial_name", "target_taxation", "redemption_days",
        "min_initial_investment")


# ------------------------------------------------------------------ universe


def q_quote_stats(spark, sf):
    st = fixture_settings()
    return U.quote_stats(_p(spark, sf).quotes(), st.reference_date, st.universe.aum_lookback_days)


def q_business_days(spark, sf):
    s = q_quote_stats(spark, sf)
    return s.select(*SK, "first_quote_date", "last_quote_date",
                    X.business_days(F.col("first_quote_date"), F.col("last_quote_date")).cast("bigint").alias("business_days"))


def q_quote_quality_filter(spark, sf):
    st = fixture_settings()
    return U.quote_quality_filter(q_quote_stats(spark, sf), st.reference_date, st.universe)


def q_eligible_registry(spark, sf):
    return U.eligible_registry(_p(spark, sf).registry(), fixture_settings().reference_date)


def q_build_universe(spark, sf):
    return _p(spark, sf).universe()


# ------------------------------------------------------------------ time series


def q_daily_return(spark, sf):
    return ts.daily_return(_p(spark, sf).quotes().select(*SK, "date", "nav"), SK)


def q_drawdown_series(spark, sf):
    r = ts.daily_return(_p(spark, sf).quotes().select(*SK, "date", "nav"), SK)
    return ts.drawdown_series(r, SK, "date", "return_daily").select(*SK, "date", "return_daily", "level", "peak", "drawdown")


def _series_metrics(spark, sf):
    p = _pm(spark, sf)
    st = p.settings
    bench = p.cdi().where(
        (F.col("date") >= F.lit(M.cdi_start(st)).cast("date")) & (F.col("date") <= F.lit(st.reference_date).cast("date")))
    cw = M.benchmark_scalars(bench, st)
    ri = M.return_rows(M.universe_quotes(p.quotes(), p.universe(), st))
    return M.series_metrics(ri, bench, st, cw)


def q_fund_metrics(spark, sf):
    return _series_metrics(spark, sf)


def q_trailing_returns(spark, sf):
    labels = list(fixture_settings().windows)
    return _series_metrics(spark, sf).select(*SK, *[f"return_{l}" for l in labels])


def q_annualized_return(spark, sf):
    return _series_metrics(spark, sf).select(*SK, "annualized_return")


def q_volatility_sharpe(spark, sf):
    return _series_metrics(spark, sf).select(*SK, "volatility", "sharpe_excess", "sharpe_raw")


def q_max_drawdown(spark, sf):
    return _series_metrics(spark, sf).select(*SK, "max_drawdown", "span_days")


def q_pct_months_above(spark, sf):
    return _series_metrics(spark, sf).select(*SK, "pct_months_above_cdi")


def q_monthly_compound(spark, sf):
    p = _pm(spark, sf)
    ri = M.return_rows(M.universe_quotes(p.quotes(), p.universe(), p.settings))
    return ri.groupBy(*SK, X.month_floor(F.col("date")).alias("month")).agg(
        (F.product(F.lit(1.0) + F.col("return_daily")) - F.lit(1.0)).alias("r_fund"))


def q_benchmark_window_returns(spark, sf):
    p = _p(spark, sf)
    st = p.settings
    bench = p.cdi().where(F.col("date") >= F.lit(M.cdi_start(st)).cast("date"))
    return ts.benchmark_summary(bench, st.reference_date, st.windows)


def q_tax_layer(spark, sf):
    """X9-X12 on the series metrics with their metadata, before P12's fills and drops."""
    p = _pm(spark, sf)
    st = p.settings
    bench = p.cdi().where(
        (F.col("date") >= F.lit(M.cdi_start(st)).cast("date")) & (F.col("date") <= F.lit(st.reference_date).cast("date")))
    cw = M.benchmark_scalars(bench, st)
    ri = M.return_rows(M.universe_quotes(p.quotes(), p.universe(), st))
    m = M.tax_layer(M.attach_metadata(M.series_metrics(ri, bench, st, cw), p.universe()), st, cw)
    labels = list(st.windows) + ["annualized"]
    return m.select(*SK, "ir_rate", *[f"return_{l}_net" for l in labels], *[f"alpha_{l}_net" for l in labels])


def q_build_metrics(spark, sf):
    return _pm(spark, sf).metrics()


# ------------------------------------------------------------------ ranking


def q_average_rank_pct(spark, sf):
    p = _pm(spark, sf)
    return R.feature_percentiles(R.expand_access(p.metrics()), p.settings)


def q_build_rankings(spark, sf):
    return _pm(spark, sf).rankings()


def q_top_n_per_segment(spark, sf):
    return SV.top_n_per_segment(_pm(spark, sf).rankings(), fixture_settings().top_n)


def q_display_table(spark, sf):
    return SV.display_table(q_top_n_per_segment(spark, sf))


def q_segment_payload(spark, sf):
    p = _pm(spark, sf)
    st = p.settings
    top = SV.top_n_per_segment(p.rankings(), st.top_n)
    segs = spark.createDataFrame(
        [(i, s.purpose, s.profile, s.investor_type) for i, s in enumerate(st.segments)],
        "seg_order int, purpose string, profile string, investor_type string")
    return SV.payload_rows(SV.segment_payload(top, p.universe(), segs, st.reference_date, PAYLOAD_TIME))


PAYLOAD_TIME = "2001-06-30T00:00:00.000000+00:00"

# Fixed parameters of the serving checks: one segment, a case-insensitive name needle.
SERVE_SEGMENT = ("income", "balanced", "qualified")
SERVE_NAME = "PLIER#00000001"
HIST_METRIC = "return_12m_net"


def q_filtered_top_n(spark, sf):
    st = fixture_settings()
    return SV.filtered_top_n(_pm(spark, sf).rankings(), st.reference_date, *SERVE_SEGMENT, st.top_n)


def q_filtered_top_n_name(spark, sf):
    st = fixture_settings()
    return SV.filtered_top_n(_pm(spark, sf).rankings(), st.reference_date, *SERVE_SEGMENT, st.top_n, SERVE_NAME)


def q_universe_summary(spark, sf):
    p = _pm(spark, sf)
    return SV.universe_summary(p.universe(), p.metrics(), p.settings.reference_date)


def q_fund_header(spark, sf):
    p = _pm(spark, sf)
    return SV.fund_header(p.universe(), p.metrics(), p.settings.reference_date)


def q_fund_rank_row(spark, sf):
    p = _pm(spark, sf)
    return SV.fund_rank_row(p.rankings(), p.settings.reference_date)


def q_cohort_returns(spark, sf):
    p = _pm(spark, sf)
    return SV.cohort_returns(p.rankings(), p.settings.reference_date)


def q_cohort_percentile(spark, sf):
    p = _pm(spark, sf)
    return SV.cohort_percentiles(p.rankings(), p.settings.reference_date)


def q_histogram(spark, sf):
    p = _pm(spark, sf)
    return SV.histogram(p.rankings(), p.settings.reference_date, HIST_METRIC)


def q_ranking_dims(spark, sf):
    p = _pm(spark, sf)
    return SV.ranking_dims(p.rankings(), p.settings.reference_date)


def q_fund_history_12m(spark, sf):
    p = _pm(spark, sf)
    return SV.fund_history_12m(p.quotes(), p.cdi(), p.universe(), p.settings.reference_date)


# ------------------------------------------------------------------ snapshots, sets, sources, tables, streaming

SNAP_REF = date(2001, 5, 10)      # run date for the snapshot-selection checks
SNAP_EARLY = date(2001, 1, 1)     # before every snapshot: exercises the future fallback
LAYOUT_SPLIT = date(1998, 1, 1)   # quote files before this date use the older header
UPSERT_CUT = date(1999, 7, 1)     # first date of the upsert batch
UPSERT_BASE_END = date(2000, 1, 1)


def snapshot_view(spark, sf):
    """fx_registro_classe spread over four monthly snapshots (2001-03-01 .. 2001-06-01)."""
    r = _p(spark, sf).raw("fx_registro_classe")
    return r.withColumn("reference_date", F.add_months(F.lit("2001-03-01").cast("date"),
                                                       (F.col("ID_Registro_Classe") % 4).cast("int")))


def q_as_of_snapshot(spark, sf):
    return SN.as_of_snapshot(snapshot_view(spark, sf), SNAP_REF)


def q_as_of_snapshot_backfill(spark, sf):
    return SN.as_of_snapshot(snapshot_view(spark, sf), SNAP_EARLY)


def q_latest_snapshot(spark, sf):
    return SN.latest_snapshot(snapshot_view(spark, sf))


def q_snapshot_date(spark, sf):
    v = snapshot_view(spark, sf)
    return v.limit(1).select(F.lit(SN.snapshot_date(v, SNAP_REF)).cast("date").alias("snapshot_date"))


def q_recent_dates(spark, sf):
    return SV.recent_dates(snapshot_view(spark, sf))


def q_distinct_keys(spark, sf):
    return _p(spark, sf).quotes().select(*SK).distinct()


def q_set_difference(spark, sf):
    """O3: eligible registry series that did not make the universe (null-safe anti-join)."""
    p = _pm(spark, sf)
    elig = U.eligible_registry(p.registry(), p.settings.reference_date).select(*SK)
    return keyed.null_safe_join(elig, p.universe().select(*SK), SK, "left_anti")


def q_month_range(spark, sf):
    """U6 over the benchmark's own span."""
    c = _p(spark, sf).cdi().agg(F.min("date").alias("lo"), F.max("date").alias("hi"))
    return c.select(F.explode(X.month_range(F.col("lo"), F.col("hi"))).alias("ym"))


def _scratch(spark, name: str) -> str:
    import uuid

    from .session import shared_path

    return shared_path(spark, "tidemark-queries", f"{name}-{uuid.uuid4().hex}")


def q_read_delimited(spark, sf):
    """S1 round trip: the class registry landed as ';'-separated Latin-1 text, read back as strings."""
    path = _scratch(spark, "registro_classe")
    src = _p(spark, sf).raw("fx_registro_classe")
    src.write.options(sep=";", encoding="ISO-8859-1", header="true").csv(path)
    return RD.read_delimited(spark, path)


def q_read_monthly_quotes(spark, sf):
    """Quote files in two header layouts (older files name the key CNPJ_FUNDO and
    the type TP_FUNDO, and have no subclass column), read back into one table."""
    root = _scratch(spark, "inf_diario")
    raw = _p(spark, sf).raw("fx_inf_diario").drop("tb1", "tb2", "tb3")
    cut = F.lit(LAYOUT_SPLIT).cast("date")
    old = raw.where(F.col("DT_COMPTC") < cut).drop("ID_SUBCLASSE").withColumnsRenamed(
        {"CNPJ_FUNDO_CLASSE": "CNPJ_FUNDO", "TP_FUNDO_CLASSE": "TP_FUNDO"})
    opts = dict(sep=";", encoding="ISO-8859-1", header="true")
    old.write.options(**opts).csv(root + "/old")
    raw.where(F.col("DT_COMPTC") >= cut).write.options(**opts).csv(root + "/new")
    return RD.read_monthly_quotes(spark, RD.list_files(spark, root + "/*/*.csv"))


def q_read_benchmark_json(spark, sf):
    """The benchmark landed as one JSON array of {data: dd/MM/yyyy, valor: percent}.
    The array is one document by format; its size is one entry per calendar day."""
    path = _scratch(spark, "cdi_json")
    c = _p(spark, sf).cdi()
    doc = c.select(F.to_json(F.collect_list(F.struct(
        F.date_format("date", "dd/MM/yyyy").alias("data"),
        (F.col("rate") * F.lit(100.0)).cast("string").alias("valor")))).alias("value"))
    doc.write.text(path)
    return RD.read_benchmark_json(spark, path)


def q_upsert_timeseries(spark, sf):
    """K1: a base load up to 2000-01-01, then a batch from 1999-07-01 on with revised
    (doubled) values; the overlap is replaced null-safely, repeated keys stay repeated."""
    root = _scratch(spark, "upsert")
    raw = _p(spark, sf).raw("fx_inf_diario").select("CNPJ_FUNDO_CLASSE", "ID_SUBCLASSE", "DT_COMPTC", "VL_QUOTA")
    T.write_timeseries(raw.where(F.col("DT_COMPTC") < F.lit(UPSERT_BASE_END).cast("date")), root + "/t", "DT_COMPTC",
                       key=["CNPJ_FUNDO_CLASSE", "ID_SUBCLASSE"])
    batch = raw.where(F.col("DT_COMPTC") >= F.lit(UPSERT_CUT).cast("date")).withColumn("VL_QUOTA", F.col("VL_QUOTA") * 2)
    T.upsert_timeseries(spark, batch, root + "/t", ["CNPJ_FUNDO_CLASSE", "ID_SUBCLASSE", "DT_COMPTC"], "DT_COMPTC")
    return spark.read.parquet(root + "/t").drop("quote_month")


def q_quote_feed(spark, sf):
    """Streaming K1: quote files landed per year, consumed by an availableNow file
    stream whose micro-batches upsert into the time-series table."""
    from .streaming.quotes_feed import run_feed_once

    root = _scratch(spark, "feed")
    raw = _p(spark, sf).raw("fx_inf_diario").select("CNPJ_FUNDO_CLASSE", "ID_SUBCLASSE", "DT_COMPTC", "VL_QUOTA", "NR_COTST")
    raw.withColumn("y", F.year("DT_COMPTC")).repartition("y").drop("y").write.parquet(root + "/landing")
    run_feed_once(spark, root + "/landing", raw.schema, root + "/table", root + "/ckpt")
    return spark.read.parquet(root + "/table").drop("quote_month")


def _check_log(spark, sf):
    """The staging gate's results logged twice on one day and once on the next, the last time without its row counts."""
    path = _scratch(spark, "check-log")
    results = T.read_table(spark, _stored_results(spark, sf))
    for at in LOG_TIMES[:2]:
        T.write_check_log(results, path, at)
    T.write_check_log(results.where(~F.col("check_name").contains("row_count")), path, LOG_TIMES[2])
    return spark.read.parquet(path)


def _stored_results(spark, sf):
    path = _scratch(spark, "check-results")
    staging_results(spark, sf).write.parquet(path)
    return path


LOG_TIMES = [datetime(2001, 7, 1, 6, 0), datetime(2001, 7, 1, 18, 30), datetime(2001, 7, 2, 6, 0)]


def q_log_detail(spark, sf):
    """T4 over the log: the newest run of one day, with its log time."""
    found = SV.log_detail(_check_log(spark, sf), fixture_settings().reference_date, "validate_staging", date(2001, 7, 1), latest=True)
    return found.drop("message").withColumn("logged_at", F.date_format("logged_at", "yyyy-MM-dd HH:mm:ss"))


def q_log_summary(spark, sf):
    """A15 over the log: all runs of a run date, with the last log time."""
    rows = SV.log_slice(_check_log(spark, sf), fixture_settings().reference_date)
    return SV.check_summary(rows).withColumn("last_logged_at", F.date_format("last_logged_at", "yyyy-MM-dd HH:mm:ss"))


def q_logged_dates(spark, sf):
    return SV.logged_dates(_check_log(spark, sf), fixture_settings().reference_date)


def q_quote_rejects(spark, sf):
    """Quote lines of which some are cut short, too long, undated or without a key; what was accepted and rejected."""
    path = _scratch(spark, "rejects")
    raw = _p(spark, sf).raw("fx_inf_diario")
    kind = F.col("tb1") % 40
    broken = {"DT_COMPTC": (1, "n/d"), "CNPJ_FUNDO_CLASSE": (2, ""), "VL_QUOTA": (5, "NaN")}
    fields = []
    for c in RD.QUOTE_COLUMNS:
        text = F.coalesce(F.col(c).cast("string"), F.lit(""))
        fields.append(F.when(kind == broken[c][0], broken[c][1]).otherwise(text) if c in broken else text)
    line = F.when(kind == 3, F.concat_ws(";", *fields[:-2])).when(kind == 4, F.concat_ws(";", *fields, F.lit("x"))).otherwise(F.concat_ws(";", *fields))
    # a column named like the header line makes Spark write that line first in every file; no field needs quoting
    raw.select(line.alias(";".join(RD.QUOTE_COLUMNS))).write.options(header="true", sep="\t", quote="").csv(path)
    found = RD.read_quotes_or_reasons(spark, RD.list_files(spark, path + "/*.csv"))
    return found.groupBy(F.coalesce("reason", F.lit("accepted")).alias("outcome")).agg(
        F.count(F.lit(1)).alias("n_lines"), F.count("VL_QUOTA").alias("n_quotas"), F.count("line").alias("n_kept_lines"))


def q_asof_join(spark, sf):
    """J17 for arbitrary dates: the newest NAV of a series on or before each order's date, unless it is over 30 days old."""
    probes = B.table(spark, sf, "orders").selectExpr(
        "o_orderkey AS probe_id", f"{B._dotted('1 + o_custkey % 40')} AS fund_cnpj",
        "CASE o_orderkey % 3 WHEN 0 THEN NULL WHEN 1 THEN 'A' ELSE 'R' END AS subclass_id", "CAST(o_orderdate AS DATE) AS probe_date")
    quotes = _p(spark, sf).quotes().select(*SK, "date", "nav")
    return ts.asof_join(probes, quotes, SK, "probe_date", "date", ["nav"], max_days=30)


# ------------------------------------------------------------------ load lifecycle


FIRST_LOAD_END = date(1999, 7, 15)   # what has landed by the first load
REVISED_FROM = date(1999, 7, 1)      # the last month of the first load comes again, with doubled quotas
SNAPSHOT_DAYS = [date(2001, m, 1) for m in range(2, 7)]


def _landing(raw, folder):
    """One file per month; a month that lands again replaces its file."""
    by_month = raw.withColumn("month", F.date_format("DT_COMPTC", "yyyy-MM")).repartition("month")
    by_month.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("month").parquet(folder)


def _revised(raw):
    """Raw quotes from the revised month on, their quotas doubled."""
    return raw.where(F.col("DT_COMPTC") >= F.lit(REVISED_FROM).cast("date")).withColumn("VL_QUOTA", F.col("VL_QUOTA") * 2)


def _loaded(spark, sf, force=False):
    """Quote loads: a first one, its repeat, one after a revision and new months, its repeat, and a forced one if asked for."""
    root = _scratch(spark, "loads")
    raw = _p(spark, sf).raw("fx_inf_diario").drop("tb1", "tb2", "tb3")
    ledger, target, landing = LD.Ledger(spark, root + "/ledger"), root + "/inf_diario", root + "/landed"

    def run(forced=False):
        LD.load_series(ledger, "inf_diario", target, landing + "/*/*.parquet", lambda paths: spark.read.parquet(*paths),
                       S.RAW_QUOTE_KEY, "DT_COMPTC", FIRST_LOAD_END, forced)

    _landing(raw.where(F.col("DT_COMPTC") < F.lit(FIRST_LOAD_END).cast("date")), landing)
    run()
    run()
    _landing(_revised(raw), landing)
    run()
    run()
    if force:
        run(True)
    return ledger, target


def q_load_series(spark, sf):
    """The raw quotes after first load, repeat, revision and repeat."""
    return spark.read.parquet(_loaded(spark, sf)[1]).drop("quote_month")


def q_load_ledger(spark, sf):
    """What each of five loads did; the last one is forced."""
    rows = _loaded(spark, sf, force=True)[0].rows()
    run = F.row_number().over(Window.orderBy("logged_at"))  # one row a load
    return rows.select(run.alias("run"), "action", "from_date", "high_water", "n_rows")


def q_load_snapshots(spark, sf):
    """Two days of registry snapshots: the first day loaded and then skipped, the second loaded and then replaced by force."""
    root = _scratch(spark, "snapshot-loads")
    raw = _p(spark, sf).raw("fx_registro_classe").select("ID_Registro_Fundo", "ID_Registro_Classe", "CNPJ_Classe", "Situacao")
    ledger, one, two = LD.Ledger(spark, root + "/ledger"), *SNAPSHOT_DAYS[:2]
    for frame, day, force in ((raw, one, False), (raw.limit(0), one, False), (raw.where("ID_Registro_Fundo > 0"), two, False),
                              (raw.withColumn("Situacao", F.upper("Situacao")), two, True)):
        LD.load_snapshots(ledger, {"registro_classe": frame}, root, day, force)
    return spark.read.parquet(root + "/registro_classe").drop("ID_Registro_Classe")


def _restaged(spark, sf):
    root = _scratch(spark, "restage")
    raw = _p(spark, sf).raw("fx_inf_diario")
    before = raw.where(F.col("DT_COMPTC") < F.lit(REVISED_FROM).cast("date"))
    first = raw.where(F.col("DT_COMPTC") < F.lit(FIRST_LOAD_END).cast("date"))
    for rows in (first, before.unionByName(_revised(raw))):
        LD.restage_quotes(spark, rows, root + "/quotes", root + "/state")
    return root


def q_restage_quotes(spark, sf):
    """Staged quotes after a first staging and one from the last staged month on, that month revised."""
    return spark.read.parquet(_restaged(spark, sf) + "/quotes").drop("quote_month")


def q_last_value_state(spark, sf):
    """The newest last-value state after the same two stagings."""
    state = spark.read.schema(LD.STATE).parquet(_restaged(spark, sf) + "/state")
    return state.where(F.col("as_of") == state.select(F.max("as_of")).scalar())


def q_restage_benchmark(spark, sf):
    """Rates staged up to a date, then the newer ones; older rates that changed meanwhile stay as they were staged."""
    path = _scratch(spark, "restage-cdi")
    cdi = _p(spark, sf).raw("fx_cdi")
    old = F.col("date") < F.lit(FIRST_LOAD_END).cast("date")
    LD.restage_benchmark(spark, cdi.where(old), path)
    LD.restage_benchmark(spark, cdi.withColumn("rate", F.when(old, F.col("rate") * 3).otherwise(F.col("rate"))), path)
    return spark.read.parquet(path).drop("quote_month")


def q_restage_fees(spark, sf):
    """Staged fees from three raw tables whose newest snapshots have different dates; older ones hold other values."""
    root, p = _scratch(spark, "restage-fees"), _p(spark, sf)
    adm, perf, ext = p.raw("fx_taxa_adm"), p.raw("fx_taxa_perfm"), p.raw("fx_extrato")
    days = SNAPSHOT_DAYS
    for name, frame, day in (
            ("cad_fi_hist_taxa_adm", adm.withColumn("TAXA_ADM", F.lit("4")), days[1]), ("cad_fi_hist_taxa_adm", adm, days[3]),
            ("cad_fi_hist_taxa_perfm", perf, days[2]), ("extrato_fi", ext.withColumn("TAXA_ADM", F.lit(3.0)), days[0]), ("extrato_fi", ext, days[4])):
        T.append_snapshot(frame, f"{root}/raw/{name}", day)
    for _ in range(2):  # the second one has nothing to do
        LD.restage_fees(spark, root + "/raw", root + "/fees")
    return spark.read.parquet(root + "/fees")


def q_null_report(spark, sf):
    return T.null_report(_p(spark, sf).raw("fx_inf_diario").drop("tb1", "tb2", "tb3"))


# ------------------------------------------------------------------ checks


GATE_COLS = ["reference_date", "task", "dataset", "check_name", "severity", "passed", "value", "threshold"]


def _snap(df: DataFrame) -> DataFrame:
    """Stamp a fixture view as the run's snapshot (reference_date = run date)."""
    return df.withColumn("reference_date", F.lit(fixture_settings().reference_date).cast("date"))


def ingestion_results(spark, sf, p: Layers | None = None):
    p = p or _pm(spark, sf)
    raw = {
        "inf_diario": p.raw("fx_inf_diario"), "cdi_daily": p.raw("fx_cdi"),
        "registro_classe": _snap(p.raw("fx_registro_classe")), "registro_subclasse": _snap(p.raw("fx_registro_subclasse")),
        "taxa_adm": _snap(p.raw("fx_taxa_adm")), "taxa_perfm": _snap(p.raw("fx_taxa_perfm")),
        "extrato_fi": _snap(p.raw("fx_extrato")), "anbima": _snap(p.raw("fx_anbima")),
    }
    return G.ingestion_checks(raw, p.settings)


def staging_results(spark, sf, p: Layers | None = None):
    p = p or _pm(spark, sf)
    stg = {"daily_quotes": p.quotes(), "registry": _snap(p.registry()), "fees": _snap(p.fees()),
           "cdi_rates": p.cdi(), "anbima": _snap(p.characteristics())}
    return G.staging_checks(stg, p.settings, M.quotes_start(p.settings))


def marts_results(spark, sf, p: Layers | None = None):
    p = p or _pm(spark, sf)
    return G.marts_checks({"universe": p.universe(), "metrics": p.metrics(), "rankings": p.rankings()}, p.settings)


def q_ingestion_gate(spark, sf):
    return ingestion_results(spark, sf).select(*GATE_COLS)


def q_staging_gate(spark, sf):
    return staging_results(spark, sf).select(*GATE_COLS)


def q_marts_gate(spark, sf):
    return marts_results(spark, sf).select(*GATE_COLS)


def _all_results(spark, sf):
    p = _pm(spark, sf)
    return ingestion_results(spark, sf, p).unionByName(staging_results(spark, sf, p)).unionByName(marts_results(spark, sf, p))


def q_check_summary(spark, sf):
    return SV.check_summary(_all_results(spark, sf))


def q_ordered_detail(spark, sf):
    return SV.ordered_detail(_all_results(spark, sf), "validate_staging")


QUERIES = {
    "dedupe_first": q_dedupe_first,
    "forward_fill": q_forward_fill,
    "clean_quotes": q_clean_quotes,
    "forward_fill_seeded": q_forward_fill_seeded,
    "clean_registry_class": q_clean_registry_class,
    "class_subclass": q_class_subclass,
    "last_non_null_per_column": q_last_non_null_per_column,
    "fees_full": q_fees_full,
    "clean_fees": q_clean_fees,
    "clean_characteristics": q_clean_characteristics,
    "quote_stats": q_quote_stats,
    "business_days": q_business_days,
    "quote_quality_filter": q_quote_quality_filter,
    "eligible_registry": q_eligible_registry,
    "build_universe": q_build_universe,
    "daily_return": q_daily_return,
    "drawdown_series": q_drawdown_series,
    "fund_metrics": q_fund_metrics,
    "trailing_returns": q_trailing_returns,
    "annualized_return": q_annualized_return,
    "volatility_sharpe": q_volatility_sharpe,
    "max_drawdown": q_max_drawdown,
    "pct_months_above": q_pct_months_above,
    "monthly_compound": q_monthly_compound,
    "benchmark_window_returns": q_benchmark_window_returns,
    "tax_layer": q_tax_layer,
    "build_metrics": q_build_metrics,
    "average_rank_pct": q_average_rank_pct,
    "build_rankings": q_build_rankings,
    "top_n_per_segment": q_top_n_per_segment,
    "display_table": q_display_table,
    "segment_payload": q_segment_payload,
    "filtered_top_n": q_filtered_top_n,
    "filtered_top_n_name": q_filtered_top_n_name,
    "universe_summary": q_universe_summary,
    "fund_header": q_fund_header,
    "fund_rank_row": q_fund_rank_row,
    "cohort_returns": q_cohort_returns,
    "cohort_percentile": q_cohort_percentile,
    "histogram": q_histogram,
    "ranking_dims": q_ranking_dims,
    "fund_history_12m": q_fund_history_12m,
    "as_of_snapshot": q_as_of_snapshot,
    "as_of_snapshot_backfill": q_as_of_snapshot_backfill,
    "latest_snapshot": q_latest_snapshot,
    "snapshot_date": q_snapshot_date,
    "recent_dates": q_recent_dates,
    "distinct_keys": q_distinct_keys,
    "set_difference": q_set_difference,
    "month_range": q_month_range,
    "read_delimited": q_read_delimited,
    "read_monthly_quotes": q_read_monthly_quotes,
    "read_benchmark_json": q_read_benchmark_json,
    "upsert_timeseries": q_upsert_timeseries,
    "quote_feed": q_quote_feed,
    "null_report": q_null_report,
    "ingestion_gate": q_ingestion_gate,
    "staging_gate": q_staging_gate,
    "marts_gate": q_marts_gate,
    "check_summary": q_check_summary,
    "ordered_detail": q_ordered_detail,
    "load_series": q_load_series,
    "load_ledger": q_load_ledger,
    "load_snapshots": q_load_snapshots,
    "restage_quotes": q_restage_quotes,
    "last_value_state": q_last_value_state,
    "restage_benchmark": q_restage_benchmark,
    "restage_fees": q_restage_fees,
    "asof_join": q_asof_join,
    "quote_rejects": q_quote_rejects,
    "log_detail": q_log_detail,
    "log_summary": q_log_summary,
    "logged_dates": q_logged_dates,
}
