"""Serving and publishing queries over the marts.

The original serves one fund or one segment per call; here each query runs
for every fund / segment at once and a caller filters (the filter is pushed
to the reference_date partition when the marts are stored partitioned).
"""

from __future__ import annotations

from datetime import date
from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as X
from ..operators import keyed, ranking as RK, timeseries as ts
from ..settings import SCHEMA_VERSION

SK = ["fund_cnpj", "subclass_id"]
SEG = ["purpose", "profile", "investor_type"]

# The cohort metrics offered for context, with higher_is_better.
COHORT_METRICS = (
    ("return_12m_net", True),
    ("return_annualized_net", True),
    ("alpha_12m_net", True),
    ("alpha_6m_net", True),
    ("alpha_3m_net", True),
    ("sharpe_excess", True),
    ("pct_months_above_cdi", True),
    ("volatility", False),
    ("max_drawdown", False),
)

PAYLOAD_FUND_COLS = [
    "return_annualized_net", "alpha_12m_net", "return_12m_net", "sharpe_excess",
    "pct_months_above_cdi", "max_drawdown", "redemption_days", "volatility",
]

TOP_COLS = [
    "fund_cnpj", "subclass_id", "fund_name", "rank", "score", "return_annualized_net", "alpha_12m_net",
    "return_12m_net", "sharpe_excess", "pct_months_above_cdi", "max_drawdown", "redemption_days", "volatility",
]


def top_n_per_segment(rankings: DataFrame, n: int) -> DataFrame:
    """Per segment the first n funds by (rank, key) with their list position,
    plus the number of eligible funds in the segment."""
    order = [F.col("rank").asc(), F.col("fund_cnpj").asc(), F.col("subclass_id").asc_nulls_first()]
    top = RK.top_n_per_group(rankings.select(*SEG, *TOP_COLS), SEG, order, n, "position")
    counts = rankings.groupBy(*SEG).agg(F.count(F.lit(1)).alias("eligible_funds"))
    # one row per configured segment at most: a bounded broadcast
    return top.join(F.broadcast(counts), SEG, "inner")


def display_table(top: DataFrame) -> DataFrame:
    """The report's table over T1: place, key, name and eight formatted measures; a NULL stays NULL."""
    def shown(fmt: str, c: str, factor: float = 1.0) -> Column:
        return F.when(F.col(c).isNotNull(), F.format_string(fmt, F.col(c) * F.lit(factor)))

    return top.select(
        *SEG, "position", "fund_cnpj", "fund_name",
        shown("%+.2f%%", "return_annualized_net", 100.0).alias("return_annualized"),
        shown("%+.2f%%", "alpha_12m_net", 100.0).alias("alpha_12m"),
        shown("%+.2f%%", "return_12m_net", 100.0).alias("return_12m"),
        shown("%.2f", "sharpe_excess").alias("sharpe"),
        shown("%.0f%%", "pct_months_above_cdi", 100.0).alias("months_above"),
        shown("%.2f%%", "max_drawdown", 100.0).alias("max_drawdown"),
        shown("D+%.0f", "redemption_days").alias("redemption"),
        shown("%.2f%%", "volatility", 100.0).alias("volatility"),
    )


def segment_payload(top: DataFrame, universe: DataFrame, segments: DataFrame, ref: date, generated_at: str | None = None) -> DataFrame:
    """The nested ranking document: one row with segments[...funds[...]].

    Funds are gathered per segment (at most n each), then segments in
    configuration order; empty segments are kept through a left join from the
    segment table. NaN never appears (NULL is written as null).
    """
    fund = F.struct(
        F.col("position").alias("rank"), F.col("fund_cnpj").alias("cnpj"), F.col("subclass_id"),
        F.coalesce(F.col("fund_name"), F.lit("")).alias("fund_name"),
        *[(F.col(c).cast("int") if c == "redemption_days" else F.col(c)).alias(c) for c in PAYLOAD_FUND_COLS],
    )
    per_seg = top.groupBy(*SEG).agg(
        F.max("eligible_funds").alias("eligible_funds"),
        F.array_sort(F.collect_list(fund), lambda a, b: F.when(a["rank"] < b["rank"], -1).when(a["rank"] > b["rank"], 1).otherwise(0)).alias("funds"),
    )
    segs = segments.select("seg_order", *SEG).join(per_seg, SEG, "left")
    seg_struct = F.struct(
        F.col("seg_order"), *[F.col(c) for c in SEG],
        F.coalesce(F.col("eligible_funds"), F.lit(0)).alias("eligible_funds"),
        F.coalesce(F.col("funds"), F.array()).alias("funds"),
    )
    # Both sides are one-row aggregates over bounded inputs (the configured
    # segments; the universe count), joined on a constant key.
    doc = segs.agg(F.array_sort(F.collect_list(seg_struct)).alias("segments")).withColumn("__k", F.lit(1))
    size = universe.where(F.col("reference_date") == F.lit(ref).cast("date")).agg(
        F.count(F.lit(1)).alias("universe_size")).withColumn("__k", F.lit(1))
    return doc.join(size, "__k").select(
        F.lit(SCHEMA_VERSION).alias("schema_version"),
        (F.lit(generated_at) if generated_at else F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx")).alias("generated_at"),
        F.lit(ref.isoformat()).alias("reference_date"),
        F.col("universe_size"),
        F.transform("segments", lambda s: s.dropFields("seg_order")).alias("segments"),
    )


def payload_rows(payload: DataFrame) -> DataFrame:
    """T3 flattened: one row per segment and fund, a segment without funds as one row with no fund."""
    segs = payload.select("schema_version", "generated_at", "reference_date", "universe_size", F.explode("segments").alias("s"))
    head = ["schema_version", "generated_at", "reference_date", "universe_size"]
    funds = segs.select(*head, *[F.col(f"s.{c}") for c in (*SEG, "eligible_funds")], F.explode_outer("s.funds").alias("f"))
    return funds.select(*head, *SEG, "eligible_funds", "f.*")


def filtered_top_n(rankings: DataFrame, ref: date, purpose: str, profile: str, investor_type: str, n: int,
                   name_filter: str | None = None) -> DataFrame:
    """One segment of one slice, optional case-insensitive name search, by rank, first n."""
    cond = (
        (F.col("reference_date") == F.lit(ref).cast("date"))
        & (F.col("purpose") == purpose) & (F.col("profile") == profile) & (F.col("investor_type") == investor_type)
    )
    if name_filter:
        cond = cond & X.name_search(F.col("fund_name"), name_filter)
    return (
        rankings.where(cond)
        .select("rank", "fund_name", "fund_cnpj", "subclass_id", "score", "return_12m_net", "alpha_12m_net",
                "sharpe_excess", "volatility", "max_drawdown", "pct_months_above_cdi", "redemption_days", "min_investment")
        .orderBy(F.col("rank").asc(), F.col("fund_cnpj").asc(), F.col("subclass_id").asc_nulls_first())
        .limit(n)
    )


def universe_summary(universe: DataFrame, metrics: DataFrame, ref: date) -> DataFrame:
    """Fund count and medians of AuM, holders and net annualised return for a slice."""
    r = F.lit(ref).cast("date")
    u = universe.where(F.col("reference_date") == r)
    m = metrics.where(F.col("reference_date") == r).select(*SK, "return_annualized_net")
    j = keyed.null_safe_join(u, m, SK, "left")
    return j.agg(
        F.count("fund_cnpj").alias("n_funds"),
        F.median("median_aum").alias("median_aum"),
        F.median("median_holders").alias("median_holders"),
        F.median("return_annualized_net").alias("median_annualized_return"),
    )


HEADER_U = ["fund_name", "anbima_category", "target_investor", "target_taxation", "adm_fee", "has_perf_fee",
            "redemption_days", "min_investment", "median_aum", "median_holders", "inception_date", "share_class",
            "fund_structure"]
HEADER_M = ["return_12m_net", "alpha_12m_net", "alpha_6m_net", "alpha_3m_net", "sharpe_excess", "volatility",
            "max_drawdown", "pct_months_above_cdi", "return_annualized_net", "ir_rate", "span_days"]


def fund_header(universe: DataFrame, metrics: DataFrame, ref: date) -> DataFrame:
    """Universe LEFT JOIN metrics on key and date, the 24 header columns, every fund of the slice."""
    r = F.lit(ref).cast("date")
    u = universe.where(F.col("reference_date") == r).select(*SK, *HEADER_U)
    m = metrics.where(F.col("reference_date") == r).select(*SK, *HEADER_M)
    return keyed.null_safe_join(u, m, SK, "left")


def fund_rank_row(rankings: DataFrame, ref: date) -> DataFrame:
    """Rank and score of every fund in every segment of the slice."""
    return rankings.where(F.col("reference_date") == F.lit(ref).cast("date")).select(*SK, *SEG, "rank", "score")


COHORT_COLS = ["fund_cnpj", "subclass_id", "fund_name", "rank", "score", "return_12m_net", "return_annualized_net",
               "alpha_12m_net", "alpha_6m_net", "alpha_3m_net", "sharpe_excess", "pct_months_above_cdi",
               "max_drawdown", "volatility"]


def cohort_returns(rankings: DataFrame, ref: date) -> DataFrame:
    """C11: the 14 cohort columns for every segment of the slice."""
    return rankings.where(F.col("reference_date") == F.lit(ref).cast("date")).select(*SEG, *COHORT_COLS)


def cohort_percentiles(rankings: DataFrame, ref: date) -> DataFrame:
    """W15 for every fund, segment and cohort metric: unpivot, then one rank
    window per (segment, metric) with the metric's direction."""
    c = cohort_returns(rankings, ref)
    metrics = [m for m, _ in COHORT_METRICS]
    long = c.select(*SEG, *SK, *[F.col(m).cast("double") for m in metrics]).unpivot([*SEG, *SK], metrics, "metric", "value")
    hib = F.create_map(*[x for m, h in COHORT_METRICS for x in (F.lit(m), F.lit(h))])
    # orient so that "better" is always higher, then strictly-lower count = rank - 1
    oriented = long.withColumn("__v", F.when(hib[F.col("metric")], F.col("value")).otherwise(-F.col("value")))
    out = RK.cohort_percentile(oriented, [*SEG, "metric"], "__v", True, "percentile")
    return out.select(*SEG, *SK, "metric", "value", "percentile")


def histogram(rankings: DataFrame, ref: date, metric: str, bins: int = 40) -> DataFrame:
    """Equal-width histogram of a cohort metric per segment (NULLs excluded);
    the maximum falls in the last bin."""
    c = cohort_returns(rankings, ref).select(*SEG, F.col(metric).alias("v")).where(F.col("v").isNotNull())
    bounds = c.groupBy(*SEG).agg(F.min("v").alias("lo"), F.max("v").alias("hi"))
    j = c.join(F.broadcast(bounds), SEG, "inner")  # one row per segment: bounded
    width = (F.col("hi") - F.col("lo")) / F.lit(float(bins))
    b = F.when(width > 0, F.least(F.floor((F.col("v") - F.col("lo")) / width) + F.lit(1), F.lit(bins))).otherwise(F.lit(1))
    return (
        j.withColumn("bin", b.cast("int"))
        .groupBy(*SEG, "bin", "lo", "hi")
        .agg(F.count(F.lit(1)).alias("n"))
        .select(*SEG, "bin",
                (F.col("lo") + (F.col("bin") - F.lit(1)) * (F.col("hi") - F.col("lo")) / F.lit(float(bins))).alias("bin_lo"),
                "n")
    )


def ranking_dims(rankings: DataFrame, ref: date) -> DataFrame:
    """Sorted distinct purposes, profiles and investor types of a slice, as (dim, value, ord)."""
    r = rankings.where(F.col("reference_date") == F.lit(ref).cast("date"))
    # one pass; the dimensions' values are those of the configured segments
    dims = r.agg(*[F.sort_array(F.collect_set(c)).alias(c) for c in SEG])
    listed = F.array(*[F.struct(F.lit(c).alias("dim"), F.col(c).alias("vals")) for c in SEG])
    out = dims.select(F.inline(listed)).select("dim", F.posexplode("vals").alias("ord", "value"))
    return out.select("dim", "value", "ord").orderBy("dim", "ord")


def recent_dates(df: DataFrame, col: str = "reference_date") -> DataFrame:
    """T5: distinct dates, newest first."""
    return df.select(col).distinct().orderBy(F.col(col).desc())


def fund_history_12m(quotes: DataFrame, cdi: DataFrame, keys: DataFrame, ref: date) -> DataFrame:
    """C10 for a set of series at once: on the benchmark calendar of the 12 months
    ending at ref, each series' NAV (filled forward inside the window only),
    daily change (first = 0), cumulative fund and benchmark returns, drawdown.

    The calendar (at most 367 days) is attached to each series by exploding a
    literal array, so the grid is built without a join; the NAVs then arrive
    by one null-safe equi-join on (series, date).
    """
    r = F.lit(ref).cast("date")
    start = X.months_back(r, 12)
    cal = cdi.where((F.col("date") >= start) & (F.col("date") <= r)).select("date", F.col("rate").alias("cdi_rate"))
    days = [row["date"] for row in cal.select("date").distinct().collect()]  # bounded: <= 367 dates
    grid = keys.select(*SK).distinct().withColumn("date", F.explode(F.array(*[F.lit(x) for x in days]) if days else F.array().cast("array<date>")))
    grid = grid.join(F.broadcast(cal), "date", "left")
    nav = quotes.where((F.col("date") >= start) & (F.col("date") <= r)).select(*SK, "date", "nav")
    g = keyed.null_safe_join(grid, nav, [*SK, "date"], "left")
    g = ts.forward_fill(g, SK, "date", ["nav"])
    g = ts.pct_change_filled(g, SK, "date", "nav", "fund_ret")
    g = g.withColumn("cdi_ret", F.coalesce(F.col("cdi_rate"), F.lit(0.0)))
    g = ts.cumulative_level(g, SK, "date", "fund_ret", "level")
    g = ts.cumulative_level(g, SK, "date", "cdi_ret", "cdi_level")
    g = ts.running_peak(g, SK, "date", "level", "peak")
    return g.select(
        *SK, "date", "cdi_rate", "nav", "fund_ret", "cdi_ret",
        (F.col("level") - F.lit(1.0)).alias("fund_cum"),
        (F.col("cdi_level") - F.lit(1.0)).alias("cdi_cum"),
        (F.try_divide(F.col("level"), F.col("peak")) - F.lit(1.0)).alias("drawdown"),
    )


def check_summary(results: DataFrame) -> DataFrame:
    """Per task and dataset: total, passed, failed, errors, warnings, last log time."""
    failed = ~F.col("passed")
    aggs = [
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("passed")).alias("passed"),
        F.count_if(failed).alias("failed"),
        F.count_if(failed & (F.col("severity") == "error")).alias("errors"),
        F.count_if(failed & (F.col("severity") == "warning")).alias("warnings"),
    ]
    if "logged_at" in results.columns:
        aggs.append(F.max("logged_at").alias("last_logged_at"))
    return results.groupBy("reference_date", "task", "dataset").agg(*aggs)


def ordered_detail(results: DataFrame, task: str) -> DataFrame:
    """T4: one task's checks, failures first, then severity descending, then name."""
    return (
        results.where(F.col("task") == task)
        .select("check_name", "severity", "passed", "value", "threshold")
        .orderBy(F.col("passed").asc(), F.col("severity").desc(), F.col("check_name").asc())
    )


# ------------------------------------------------------------------ the append-only check log (K10 read back)


def log_slice(log: DataFrame, ref: date, logged_on: date | None = None, latest: bool = False) -> DataFrame:
    """The log's rows of a run date (a pruned partition), of one log day if given. With ``latest`` only the newest run of every
    task counts: a repeated run appends its results again, and each run has one log time."""
    rows = log.where(F.col("reference_date") == F.lit(ref).cast("date"))
    if logged_on is not None:
        rows = rows.where(F.to_date("logged_at") == F.lit(logged_on).cast("date"))
    if latest:
        newest = rows.groupBy("task").agg(F.max("logged_at").alias("logged_at"))  # one row a task
        rows = rows.join(F.broadcast(newest), ["task", "logged_at"], "left_semi")
    return rows


def logged_dates(log: DataFrame, ref: date) -> DataFrame:
    """T5: the days on which results of a run date were logged, newest first."""
    return log_slice(log, ref).select(F.to_date("logged_at").alias("logged_date")).distinct().orderBy(F.col("logged_date").desc())


def log_detail(log: DataFrame, ref: date, task: str, logged_on: date | None = None, latest: bool = False) -> DataFrame:
    """T4: one task's logged checks with message and log time, failures first, then severity descending, then name, newest first."""
    rows = log_slice(log, ref, logged_on, latest).where(F.col("task") == task)
    return rows.select("check_name", "severity", "passed", "value", "threshold", "message", "logged_at").orderBy(
        F.col("passed").asc(), F.col("severity").desc(), F.col("check_name").asc(), F.col("logged_at").desc())
