"""Universe (C1): the eligible funds for a reference date.

registry snapshot -> P8 eligibility -> fees (J2) -> quote stats (J5, P11)
-> quote quality (P9) -> characteristics (J6) -> size filter (P10).

One lazy plan. The quote aggregate is reduced to eligible series first
(semi-join against the small eligible registry), so the big quotes table is
scanned once, filtered by date at the parquet scan, and aggregated per series
with a map-side partial pass.
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as X
from ..operators import keyed
from ..settings import ACTIVE_STATUS, CLOSED_STRUCTURE, FIXED_INCOME_PREFIX, Settings, UniverseParams

SERIES_KEY = ["fund_cnpj", "subclass_id"]

UNIVERSE_COLS = [
    "fund_cnpj", "subclass_id", "fund_name", "inception_date", "anbima_category", "target_investor",
    "share_class", "fund_structure", "adm_fee", "has_perf_fee", "median_aum", "median_holders",
    "target_taxation", "redemption_days", "min_investment", "reference_date",
]


def eligible_registry(registry: DataFrame, ref: date) -> DataFrame:
    """Active, fixed income, not exclusive, not closed, not pension, started by ref.
    NULL exclusive/pension count as 'N', NULL structure passes, NULL category or date fails."""
    cond = (
        (F.col("status") == ACTIVE_STATUS)
        & F.coalesce(F.col("anbima_category").startswith(FIXED_INCOME_PREFIX), F.lit(False))
        & (F.coalesce(F.col("is_exclusive"), F.lit("N")) != "S")
        & (F.coalesce(F.col("fund_structure"), F.lit("")) != CLOSED_STRUCTURE)
        & (F.coalesce(F.col("is_pension"), F.lit("N")) != "S")
        & F.coalesce(F.col("inception_date") <= F.lit(ref).cast("date"), F.lit(False))
    )
    return registry.where(cond)


def quote_stats(quotes: DataFrame, ref: date, lookback_days: int) -> DataFrame:
    """A1: per series over rows dated <= ref: exact medians of aum and holders in
    [ref - lookback, ref], first and last date, and row count (NULL nav rows count)."""
    r = F.lit(ref).cast("date")
    start = F.lit(ref - timedelta(days=lookback_days)).cast("date")
    in_window = (F.col("date") >= start) & (F.col("date") <= r)
    return (
        quotes.where(F.col("date") <= r)
        .groupBy(*SERIES_KEY)
        .agg(
            F.median(F.when(in_window, F.col("aum"))).alias("median_aum"),
            F.median(F.when(in_window, F.col("shareholders").cast("double"))).alias("median_holders"),
            F.min("date").alias("first_quote_date"),
            F.max("date").alias("last_quote_date"),
            F.count(F.lit(1)).alias("quote_count"),
        )
    )


def quote_month_summary(quotes: DataFrame) -> DataFrame:
    """Per (series, calendar month): first date, last date, row count. Written next
    to the staged quotes, partitioned by year (and refreshed for the months an
    upsert touches), it lets the universe read full-history span and density from
    series x months rows instead of scanning every quote."""
    return quotes.groupBy(*SERIES_KEY, F.date_format("date", "yyyy-MM").alias("quote_month")).agg(
        F.min("date").alias("first_date"), F.max("date").alias("last_date"), F.count(F.lit(1)).alias("n_rows")
    ).withColumn("quote_year", F.substring("quote_month", 1, 4).cast("int"))


def quote_stats_from_summary(summary: DataFrame, recent_quotes: DataFrame, ref: date, lookback_days: int) -> DataFrame:
    """A1 from the monthly summary: whole months before ref's month come from the
    summary, ref's own month (rows dated <= ref) and the medians' look-back window
    come from ``recent_quotes`` (which must cover [ref - lookback, ref]). Same
    result as ``quote_stats`` over the full history."""
    r = F.lit(ref).cast("date")
    ref_month = ref.strftime("%Y-%m")
    start = F.lit(ref - timedelta(days=lookback_days)).cast("date")
    old = (summary.where(F.col("quote_year") <= F.lit(ref.year))   # partition pruning
           .where(F.col("quote_month") < F.lit(ref_month)).select(*SERIES_KEY, "first_date", "last_date", "n_rows"))
    cur = (
        recent_quotes.where((F.date_format("date", "yyyy-MM") == F.lit(ref_month)) & (F.col("date") <= r))
        .groupBy(*SERIES_KEY)
        .agg(F.min("date").alias("first_date"), F.max("date").alias("last_date"), F.count(F.lit(1)).alias("n_rows"))
    )
    span = old.unionByName(cur).groupBy(*SERIES_KEY).agg(
        F.min("first_date").alias("first_quote_date"), F.max("last_date").alias("last_quote_date"),
        F.sum("n_rows").alias("quote_count"))
    med = (
        recent_quotes.where((F.col("date") >= start) & (F.col("date") <= r))
        .groupBy(*SERIES_KEY)
        .agg(F.median("aum").alias("median_aum"), F.median(F.col("shareholders").cast("double")).alias("median_holders"))
    )
    return keyed.null_safe_join(span, med, SERIES_KEY, "left").select(
        *SERIES_KEY, "median_aum", "median_holders", "first_quote_date", "last_quote_date", "quote_count")


def quote_quality_filter(df: DataFrame, ref: date, p: UniverseParams) -> DataFrame:
    """Fresh, long enough, dense enough; zero business days fails."""
    r = F.lit(ref).cast("date")
    span_cdays = F.datediff("last_quote_date", "first_quote_date")
    bdays = X.business_days(F.col("first_quote_date"), F.col("last_quote_date"))
    ratio = F.try_divide(F.col("quote_count").cast("double"), F.nullif(bdays, F.lit(0)).cast("double"))
    keep = (
        F.coalesce(F.datediff(r, F.col("last_quote_date")) <= p.max_quote_staleness_days, F.lit(False))
        & F.coalesce(span_cdays >= p.min_span_days, F.lit(False))
        & F.coalesce(ratio >= F.lit(float(p.min_obs_ratio)), F.lit(False))
    )
    return df.where(keep).drop("first_quote_date", "last_quote_date", "quote_count")


def size_filter(df: DataFrame, p: UniverseParams) -> DataFrame:
    """P10: median holders > min and median AuM > min (strict); NULL counts as 0."""
    return df.where(
        (F.coalesce(F.col("median_holders"), F.lit(0.0)) > F.lit(float(p.min_cotistas)))
        & (F.coalesce(F.col("median_aum"), F.lit(0.0)) > F.lit(float(p.min_aum)))
    )


def build_universe(
    registry: DataFrame,
    fees: DataFrame,
    quotes: DataFrame,
    characteristics: DataFrame,
    settings: Settings,
    stats: DataFrame | None = None,
) -> DataFrame:
    """C1 over already-chosen snapshots (see ``sources.snapshots.as_of_snapshot``).

    ``stats`` may carry precomputed A1 statistics (``quote_stats_from_summary``);
    otherwise they are aggregated from ``quotes``.
    """
    ref = settings.reference_date
    p = settings.universe
    eligible = eligible_registry(registry, ref)
    # Registry LEFT JOIN fees on the fund key (fees are one row per fund).
    eligible = eligible.join(fees.select("fund_cnpj", "adm_fee", "has_perf_fee"), "fund_cnpj", "left")
    # J5 + P11: attach quote stats; only series of eligible funds are aggregated.
    if stats is None:
        keys = eligible.select(*SERIES_KEY).distinct()
        q = keyed.null_safe_join(
            quotes.select(*SERIES_KEY, "date", "aum", "shareholders").where(F.col("date") <= F.lit(ref).cast("date")),
            keys, SERIES_KEY, "left_semi",
        )
        stats = quote_stats(q, ref, p.aum_lookback_days)
    out = keyed.null_safe_join(eligible, stats, SERIES_KEY, "left").where(F.col("median_aum").isNotNull())
    out = quote_quality_filter(out, ref, p)
    # Characteristics on (fund, subclass), null-safe.
    ch = characteristics.select(
        *SERIES_KEY, "target_taxation",
        F.round(F.col("redemption_days")).cast("int").alias("redemption_days"),
        F.col("min_initial_investment").cast("double").alias("min_investment"),
    )
    out = keyed.null_safe_join(out, ch, SERIES_KEY, "left")
    out = size_filter(out, p)
    return out.select(
        *[c for c in UNIVERSE_COLS if c != "reference_date"],
        F.lit(ref).cast("date").alias("reference_date"),
    )
