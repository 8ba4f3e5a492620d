"""Time-series operators over keyed daily series.

Series windows partition by the series key only after the natural key
(series, date) has been de-duplicated, so one window partition holds at most
one row per calendar day of one series: its size is bounded by the calendar,
not by the data volume. Benchmark windows run on the benchmark alone
(about 250 rows a year).

All operators are declarative: window functions and one-pass aggregates, no
Python per row.
"""

from __future__ import annotations

from datetime import date
from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import keyed

from ..functions import scalars as X


def _series_window(key: Sequence[str], date_col: str):
    return Window.partitionBy(*key).orderBy(F.col(date_col).asc())


def _running(key: Sequence[str], date_col: str):
    return _series_window(key, date_col).rowsBetween(Window.unboundedPreceding, Window.currentRow)


# ------------------------------------------------------------------ fills


def forward_fill(df: DataFrame, key: Sequence[str], date_col: str, cols: Sequence[str]) -> DataFrame:
    """Carry the last non-NULL value forward per series by date; leading NULLs stay."""
    w = _running(key, date_col)
    return df.withColumns({c: F.last(c, ignorenulls=True).over(w) for c in cols})


def forward_fill_seeded(
    batch: DataFrame,
    seeds: DataFrame,
    key: Sequence[str],
    date_col: str,
    cols: Sequence[str],
) -> DataFrame:
    """Fill a new batch using, per series, the last already-filled row before it.

    Seeds are unioned in with a flag, the batch is filled, seeds are dropped.
    Because staged rows are already filled, the result equals W4 over the full
    history.
    """
    s = seeds.select(*key, date_col, *cols).withColumn("__seed", F.lit(True))
    b = batch.withColumn("__seed", F.lit(False))
    filled = forward_fill(b.unionByName(s, allowMissingColumns=True), key, date_col, cols)
    return filled.where(~F.col("__seed")).drop("__seed")


def asof_join(probes: DataFrame, quotes: DataFrame, key: Sequence[str], probe_date: str, date_col: str,
              values: Sequence[str], max_days: int | None = None) -> DataFrame:
    """J17 for arbitrary probe dates: every probe with the ``values`` and the date of the newest quote of its series on or
    before it whose first value is not NULL; NULLs where there is none, or it is more than ``max_days`` older.

    Probes of one series and date are one question, so a series has at most one question and (quotes being unique by
    date) one quote a day: they are put in one line and answered by one last-non-NULL pass, in windows that the calendar bounds.
    The answers are joined back to the probes, where a hot key is a skewed join that Spark splits. NULL keys are keys; a
    probe without a date finds nothing. The probes' columns must not be named like the values or the quotes' date.
    """
    asked = probes.select(*key, F.col(probe_date).alias("__at")).where(F.col("__at").isNotNull()).distinct()
    found = F.when(F.col(values[0]).isNotNull(), F.struct(date_col, *values))
    told = quotes.where(F.col(date_col).isNotNull()).select(*key, F.col(date_col).alias("__at"), found.alias("__found"))
    line = told.withColumn("__asks", F.lit(False)).unionByName(asked.withColumn("__asks", F.lit(True)), allowMissingColumns=True)
    # a quote of the day itself comes before the question
    w = Window.partitionBy(*key).orderBy("__at", "__asks").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    answers = line.withColumn("__found", F.last("__found", ignorenulls=True).over(w)).where("__asks").drop("__asks")
    if max_days is not None:
        answers = answers.withColumn("__found", F.when(F.date_diff("__at", f"__found.{date_col}") <= max_days, F.col("__found")))
    joined = keyed.null_safe_join(probes.withColumn("__at", F.col(probe_date)), answers, [*key, "__at"], "left")
    return joined.select(*probes.columns, *[F.col(f"__found.{c}").alias(c) for c in (date_col, *values)])


# ------------------------------------------------------------------ returns


def daily_return(
    df: DataFrame,
    key: Sequence[str],
    date_col: str = "date",
    value_col: str = "nav",
    out_col: str = "return_daily",
) -> DataFrame:
    """Value / NULLIF(LAG(value), 0) - 1 over the non-NULL values of each
    series; rows without a return (first row, rows after a 0) are dropped."""
    w = _series_window(key, date_col)
    prev = F.lag(value_col).over(w)
    return (
        df.where(F.col(value_col).isNotNull())
        .withColumn(out_col, F.try_divide(F.col(value_col), F.nullif(prev, F.lit(0.0))) - F.lit(1.0))
        .where(F.col(out_col).isNotNull())
    )


def cumulative_level(df: DataFrame, key: Sequence[str], date_col: str, ret_col: str, out_col: str = "level") -> DataFrame:
    """Running product of (1 + r)."""
    return df.withColumn(out_col, F.product(F.lit(1.0) + F.col(ret_col)).over(_running(key, date_col)))


def running_peak(df: DataFrame, key: Sequence[str], date_col: str, level_col: str, out_col: str = "peak") -> DataFrame:
    """Running maximum of the level."""
    return df.withColumn(out_col, F.max(level_col).over(_running(key, date_col)))


def drawdown_series(df: DataFrame, key: Sequence[str], date_col: str, ret_col: str) -> DataFrame:
    """Level / running max - 1, level starting at the first return."""
    out = cumulative_level(df, key, date_col, ret_col)
    out = running_peak(out, key, date_col, "level")
    return out.withColumn("drawdown", F.try_divide(F.col("level"), F.col("peak")) - F.lit(1.0))


def pct_change_filled(df: DataFrame, key: Sequence[str], date_col: str, value_col: str, out_col: str) -> DataFrame:
    """Day-over-day change, first row (and gaps) = 0."""
    w = _series_window(key, date_col)
    return df.withColumn(
        out_col,
        F.coalesce(F.try_divide(F.col(value_col), F.lag(value_col).over(w)) - F.lit(1.0), F.lit(0.0)),
    )


# ------------------------------------------------------------------ benchmark (one small series)


def _window_return_cols(ref: date, windows: Mapping[str, int]) -> list[Column]:
    r = F.lit(ref).cast("date")
    cols = []
    for label, m in windows.items():
        inside = (F.col("date") > X.months_back(r, m)) & (F.col("date") <= r)
        cols.append(
            F.coalesce(F.product(F.when(inside, F.lit(1.0) + F.col("rate"))) - F.lit(1.0), F.lit(0.0)).alias(f"cdi_{label}")
        )
    return cols


def _annualised_col(ref: date) -> Column:
    r = F.lit(ref).cast("date")
    upto = F.col("date") <= r
    span = F.datediff(r, F.min(F.when(upto, F.col("date"))))
    value = F.pow(F.product(F.when(upto, F.lit(1.0) + F.col("rate"))), F.lit(252.0) / span) - F.lit(1.0)
    return F.coalesce(F.when(span > 0, value), F.lit(0.0)).alias("cdi_annualized")


def benchmark_window_returns(cdi: DataFrame, ref: date, windows: Mapping[str, int]) -> DataFrame:
    """A4: one row, one column per window: prod(1 + rate) - 1 over (ref - m months, ref];
    an empty window gives 0.0."""
    return cdi.agg(*_window_return_cols(ref, windows))


def benchmark_annualised(cdi: DataFrame, ref: date) -> DataFrame:
    """prod(1 + rate)^(252 / calendar days from the first rate to ref) - 1 over
    dates <= ref; no rates or span <= 0 gives 0.0."""
    return cdi.agg(_annualised_col(ref))


def benchmark_summary(cdi: DataFrame, ref: date, windows: Mapping[str, int]) -> DataFrame:
    """A4 + A13 in one pass over the benchmark: one row."""
    return cdi.agg(*_window_return_cols(ref, windows), _annualised_col(ref))


def benchmark_monthly(cdi: DataFrame) -> DataFrame:
    """A3: compounded benchmark return per calendar month."""
    return cdi.groupBy(X.month_floor(F.col("date")).alias("month")).agg(
        (F.product(F.lit(1.0) + F.col("rate")) - F.lit(1.0)).alias("r_cdi")
    )


def benchmark_prefix_calendar(cdi: DataFrame, lo: Column, hi: Column) -> DataFrame:
    """Dense daily calendar [lo, hi] with the running sum and count of benchmark
    rates up to each day. Turns "mean rate between a and b" into two equi-join
    lookups (no range join). Size = calendar days, bounded by the span, not by
    the data; the un-keyed running window runs on that small table only."""
    cal = cdi.sparkSession.range(1).select(F.explode(F.sequence(lo, hi)).alias("date"))
    one = cdi.groupBy("date").agg(F.max("rate").alias("rate"))  # a repeated date must not repeat the series
    joined = cal.join(F.broadcast(one), "date", "left")
    w = Window.orderBy("date").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return joined.select(
        "date",
        F.sum(F.coalesce(F.col("rate"), F.lit(0.0))).over(w).alias("cum_rate"),
        F.count("rate").over(w).alias("cum_n"),
    )


def window_mean_rate(
    bounds: DataFrame,
    cdi: DataFrame,
    key: Sequence[str],
    lo_col: str,
    hi_col: str,
    cal_lo: date,
    cal_hi: date,
) -> DataFrame:
    """Mean benchmark rate over each series' [lo, hi] date range.

    Computed from prefix sums on a dense calendar covering [cal_lo, cal_hi]
    (the caller's date filter, which bounds every lo and hi):
    mean = (S(hi) - S(lo - 1)) / (N(hi) - N(lo - 1)). Both lookups are
    equi-joins against the broadcast calendar, so the work is linear in the
    number of series; no series x days product. NULL when no rate falls
    inside the range.
    """
    cal = benchmark_prefix_calendar(
        cdi, F.date_sub(F.lit(cal_lo).cast("date"), 1), F.lit(cal_hi).cast("date")
    )
    c_hi = F.broadcast(cal.select(F.col("date").alias("__d_hi"), F.col("cum_rate").alias("__s_hi"), F.col("cum_n").alias("__n_hi")))
    c_lo = F.broadcast(cal.select(F.col("date").alias("__d_lo"), F.col("cum_rate").alias("__s_lo"), F.col("cum_n").alias("__n_lo")))
    out = (
        bounds.join(c_hi, F.col("__d_hi") == F.col(hi_col), "left")
        .join(c_lo, F.col("__d_lo") == F.date_sub(F.col(lo_col), 1), "left")
    )
    n = F.col("__n_hi") - F.col("__n_lo")
    mean = F.when(n > 0, (F.col("__s_hi") - F.col("__s_lo")) / n)
    return out.withColumn("rf_daily", mean).drop("__d_hi", "__s_hi", "__n_hi", "__d_lo", "__s_lo", "__n_lo")
