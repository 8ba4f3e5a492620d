"""Metrics (C2): returns, risk and after-tax metrics per series.

Physical shape (one exchange on the series key):
  quotes scan (date range pushed to parquet) -> semi-join universe keys
  -> hash-partition on (fund_cnpj, subclass_id)
  -> windows on the series (lag, running product / peak) and on
     (series, month) for month compounding — same partitioning, no exchange
  -> one groupBy(series) computing every metric — no exchange
  -> broadcast calendar lookups for the per-series mean benchmark rate.

The benchmark is one small series (one row per day): its window returns and
annualised value are one-row aggregates read back as scalars and used as
literals.
"""

from __future__ import annotations

import math
from datetime import date

from dateutil.relativedelta import relativedelta
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import scalars as X
from ..operators import keyed, timeseries as ts
from ..settings import (
    DEFAULT_FILL,
    NEUTRAL_FILL,
    PERIODS_PER_YEAR,
    REQUIRED_METRICS,
    Settings,
)

SERIES_KEY = ["fund_cnpj", "subclass_id"]
META_COLS = ["fund_cnpj", "subclass_id", "fund_name", "target_investor", "target_taxation", "redemption_days", "min_investment"]
SQRT_N = math.sqrt(PERIODS_PER_YEAR)


def metric_labels(settings: Settings) -> list[str]:
    return list(settings.windows.keys())


def metrics_columns(settings: Settings) -> list[str]:
    labels = metric_labels(settings)
    return (
        ["fund_cnpj", "subclass_id", "fund_name", "target_investor", "target_taxation", "redemption_days", "min_investment"]
        + [f"return_{l}" for l in labels]
        + [f"alpha_{l}" for l in labels]
        + ["annualized_return"]
        + [f"return_{l}_net" for l in labels] + ["return_annualized_net"]
        + [f"alpha_{l}_net" for l in labels] + ["alpha_annualized_net"]
        + ["pct_months_above_cdi", "volatility", "sharpe_excess", "sharpe_raw", "max_drawdown", "span_days",
           "ir_rate", "investor_level", "reference_date"]
    )


def quotes_start(settings: Settings) -> date:
    return settings.reference_date - relativedelta(months=settings.quotes_start_months)


def cdi_start(settings: Settings) -> date:
    return settings.reference_date - relativedelta(months=settings.cdi_start_months)


def universe_quotes(quotes: DataFrame, universe: DataFrame, settings: Settings) -> DataFrame:
    """Quotes of universe series within [quotes_start, ref] (a null-safe semi-join)."""
    lo = F.lit(quotes_start(settings)).cast("date")
    hi = F.lit(settings.reference_date).cast("date")
    q = quotes.select(*SERIES_KEY, "date", "nav").where((F.col("date") >= lo) & (F.col("date") <= hi))
    return keyed.null_safe_join(q, universe.select(*SERIES_KEY).distinct(), SERIES_KEY, "left_semi")


def return_rows(quotes: DataFrame) -> DataFrame:
    """W7 on series quotes: (series, date, nav, return_daily)."""
    return ts.daily_return(quotes, SERIES_KEY, "date", "nav", "return_daily")


def benchmark_scalars(cdi: DataFrame, settings: Settings) -> dict[str, float]:
    """A4 + A13 as driver scalars: one one-row aggregate of the small benchmark."""
    row = ts.benchmark_summary(cdi, settings.reference_date, settings.windows).first().asDict()
    out = {label: float(row[f"cdi_{label}"]) for label in settings.windows}
    out["annualized"] = float(row["cdi_annualized"])
    return out


def series_metrics(ri: DataFrame, cdi: DataFrame, settings: Settings, cdi_window: dict[str, float]) -> DataFrame:
    """One row per series with trailing returns (J17/A7), gross alphas (X12),
    CAGR (A8), volatility (A9), Sharpe (A10, J11), max drawdown (A11), span (A12)
    and share of months above the benchmark (A2, A3, A5, J10)."""
    ref = settings.reference_date
    key = SERIES_KEY
    r = F.col("return_daily")
    # Month compounding inside (series, month) windows: same partitioning as the series.
    month = X.month_floor(F.col("date"))
    w_month = Window.partitionBy(*key, "month")
    bench_m = F.broadcast(ts.benchmark_monthly(cdi))  # months of a bounded window
    df = ri.withColumn("month", month)
    df = ts.cumulative_level(df, key, "date", "return_daily", "level")
    df = ts.running_peak(df, key, "date", "level", "peak")
    df = df.withColumn("r_month", F.product(F.lit(1.0) + r).over(w_month) - F.lit(1.0))
    df = df.withColumn("is_month_row", F.col("date") == F.max("date").over(w_month))
    df = df.join(bench_m, "month", "left")
    above = F.coalesce(F.col("r_month") > F.col("r_cdi"), F.lit(False)).cast("double")

    d = F.col("date")
    aggs: list[Column] = [
        F.max_by("nav", "date").alias("__v_end"),
        F.min_by("nav", "date").alias("__v_first"),
        F.count(F.lit(1)).alias("__n"),
        F.avg(r).alias("__mean_r"),
        F.stddev_samp(r).alias("__std_r"),
        F.min(F.try_divide(F.col("level"), F.col("peak")) - F.lit(1.0)).alias("__mdd"),
        F.min("date").alias("__first_date"),
        F.max("date").alias("__last_date"),
        F.avg(F.when(F.col("is_month_row"), above)).alias("pct_months_above_cdi"),
    ]
    for label, m in settings.windows.items():
        cut = X.months_back(F.lit(ref).cast("date"), m)
        aggs.append(F.max_by(F.col("nav"), F.when(d <= cut, d)).alias(f"__v_start_{label}"))
    g = df.groupBy(*key).agg(*aggs)

    cols: dict[str, Column] = {}
    for label in settings.windows:
        vs = F.col(f"__v_start_{label}")
        cols[f"return_{label}"] = F.when(vs > 0, F.try_divide(F.col("__v_end"), vs) - F.lit(1.0))
    for label in settings.windows:
        cols[f"alpha_{label}"] = F.col(f"return_{label}") - F.lit(cdi_window[label])
    n = F.col("__n")
    cagr = F.pow(F.try_divide(F.col("__v_end"), F.col("__v_first")), F.lit(252.0) / n) - F.lit(1.0)
    cols["annualized_return"] = F.when((n >= 2) & (F.col("__v_first") != 0), X.nan_to_null(cagr))
    std = F.col("__std_r")
    cols["volatility"] = std * F.lit(SQRT_N)
    cols["max_drawdown"] = F.when(n >= 2, F.col("__mdd"))
    cols["span_days"] = F.datediff("__last_date", "__first_date").cast("int")
    g = g.withColumns(cols)

    # Mean benchmark rate over each series' own [first, last] date range.
    g = ts.window_mean_rate(g, cdi, key, "__first_date", "__last_date", quotes_start(settings), ref)
    excess = F.col("__mean_r") - F.col("rf_daily")
    g = g.withColumn("sharpe_excess", _sharpe(excess, std)).withColumn("sharpe_raw", _sharpe(F.col("__mean_r"), std))
    return g.drop(*[c for c in g.columns if c.startswith("__")], "rf_daily")


def _sharpe(num: Column, std: Column) -> Column:
    """(num / std) * sqrt(252); std = 0 gives +/-Infinity (0/0 -> NULL), like float division."""
    ratio = (
        F.when(std.isNull() | num.isNull(), F.lit(None).cast("double"))
        .when(std == 0, F.when(num > 0, F.lit(float("inf"))).when(num < 0, F.lit(float("-inf"))))
        .otherwise(F.try_divide(num, std))
    )
    return ratio * F.lit(SQRT_N)


def tax_layer(df: DataFrame, settings: Settings, cdi_window: dict[str, float]) -> DataFrame:
    """IR rate per fund, net returns, net alphas against the taxed benchmark."""
    ir = X.tax_rate(F.col("target_taxation"), F.col("fund_name"), settings.rates_by_taxation,
                    settings.exempt_keywords, settings.default_tax_rate)
    df = df.withColumn("ir_rate", ir)
    cols: dict[str, Column] = {}
    for label in list(settings.windows) + ["annualized"]:
        gross = F.col(f"return_{label}") if label != "annualized" else F.col("annualized_return")
        cols[f"return_{label}_net"] = X.net_return(gross, F.col("ir_rate"))
    df = df.withColumns(cols)
    cols = {}
    for label in list(settings.windows) + ["annualized"]:
        bench_net = X.net_value(cdi_window[label], settings.cdi_ir_rate)
        cols[f"alpha_{label}_net"] = F.col(f"return_{label}_net") - F.lit(bench_net)
    return df.withColumns(cols)


def handle_missing_metrics(df: DataFrame) -> DataFrame:
    """Neutral fills, defaults, then drop rows still NULL in a required metric."""
    fills = {**NEUTRAL_FILL, **DEFAULT_FILL}
    df = df.withColumns({c: F.coalesce(F.col(c), F.lit(v).cast(df.schema[c].dataType)) for c, v in fills.items() if c in df.columns})
    cond = None
    for c in REQUIRED_METRICS:
        if c in df.columns:
            cc = F.col(c).isNotNull()
            cond = cc if cond is None else cond & cc
    return df.where(cond) if cond is not None else df


def dropped_metrics_report(df: DataFrame) -> DataFrame:
    """P12 companion: NULL counts per required metric among the rows P12 drops."""
    present = [c for c in REQUIRED_METRICS if c in df.columns]
    any_null = None
    for c in present:
        cc = F.col(c).isNull()
        any_null = cc if any_null is None else any_null | cc
    dropped = df.where(any_null)
    row = dropped.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in present])
    stack = ", ".join(f"'{c}', `{c}`" for c in present)
    return row.selectExpr(f"stack({len(present)}, {stack}) AS (metric, n_null)").where("n_null > 0")


def attach_metadata(metrics: DataFrame, universe: DataFrame) -> DataFrame:
    """Metrics LEFT JOIN one metadata row per universe series (null-safe)."""
    meta = keyed.keep_first(universe.select(*META_COLS), SERIES_KEY, ["fund_name"])
    return keyed.null_safe_join(metrics, meta, SERIES_KEY, "left")


def build_metrics(quotes: DataFrame, universe: DataFrame, cdi: DataFrame, settings: Settings) -> DataFrame:
    """J7 -> W7 -> A6 -> J9 -> tax layer -> investor level -> P12."""
    ref = settings.reference_date
    bench = cdi.select("date", "rate").where(
        (F.col("date") >= F.lit(cdi_start(settings)).cast("date")) & (F.col("date") <= F.lit(ref).cast("date"))
    )
    cdi_window = benchmark_scalars(bench, settings)
    ri = return_rows(universe_quotes(quotes, universe, settings))
    m = series_metrics(ri, bench, settings, cdi_window)
    m = attach_metadata(m, universe)
    m = tax_layer(m, settings, cdi_window)
    m = m.withColumn("investor_level", X.investor_level(F.col("target_investor")))
    m = handle_missing_metrics(m)
    m = m.withColumn("reference_date", F.lit(ref).cast("date"))
    return m.select(*metrics_columns(settings))
