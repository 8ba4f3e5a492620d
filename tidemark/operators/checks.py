"""Data-quality rules (V1-V14) and the gate (V0).

A rule yields one result row: check_name, severity, passed, value,
threshold, message. Aggregate rules of one table compile into a single
``agg`` pass (a row of counts) that is exploded into result rows; only key,
set and gap rules need a pass of their own. Snapshot tables are checked on
their as-of slice (newest ``reference_date`` <= the run date, S10).
"""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date, timedelta
from typing import Callable, Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..sources import snapshots as SN
from pyspark.sql.types import BooleanType, StringType, StructField, StructType

RESULT_SCHEMA = StructType([
    StructField("check_name", StringType(), False),
    StructField("severity", StringType(), False),
    StructField("passed", BooleanType(), False),
    StructField("value", StringType(), True),
    StructField("threshold", StringType(), True),
    StructField("message", StringType(), True),
])

Acc = Callable[[str], Column]


def pct_text(rate: Column) -> Column:
    """'12.3%' with ties to even on the decimal value (like Python's format)."""
    return F.format_string("%.1f%%", F.bround(rate * F.lit(100.0), 1))


def _null_str() -> Column:
    return F.lit(None).cast("string")


@dataclass(frozen=True)
class AggRule:
    """A rule evaluated from aggregates of one table (or slice)."""

    name: str
    severity: str
    threshold: str
    aggs: dict[str, Column]
    passed: Callable[[Acc], Column]
    value: Callable[[Acc], Column]
    message: Callable[[Acc], Column] = field(default=lambda a: _null_str())


def _result_struct(name: str, severity: str, passed: Column, value: Column, threshold: str | None, message: Column) -> Column:
    return F.struct(
        F.lit(name).alias("check_name"), F.lit(severity).alias("severity"),
        F.coalesce(passed, F.lit(False)).alias("passed"), value.cast("string").alias("value"),
        F.lit(threshold).cast("string").alias("threshold"),
        F.when(~F.coalesce(passed, F.lit(False)), message).cast("string").alias("message"),
    )


def evaluate(df: DataFrame, rules: Sequence[AggRule]) -> DataFrame:
    """One aggregate pass over ``df`` for all rules, exploded to result rows."""
    exprs = []
    for i, r in enumerate(rules):
        for k, e in r.aggs.items():
            exprs.append(e.alias(f"r{i}__{k}"))
    row = df.agg(*exprs)
    structs = []
    for i, r in enumerate(rules):
        acc: Acc = (lambda i: (lambda k: F.col(f"r{i}__{k}")))(i)
        structs.append(_result_struct(r.name, r.severity, r.passed(acc), r.value(acc), r.threshold, r.message(acc)))
    return row.select(F.explode(F.array(*structs)).alias("r")).select("r.*")


# ------------------------------------------------------------------ aggregate rules


def row_count(name: str, label: str) -> AggRule:
    """V2: at least one row."""
    return AggRule(name, "error", "> 0", {"n": F.count(F.lit(1))},
                   lambda a: a("n") > 0, lambda a: a("n"), lambda a: F.lit(f"{label} has 0 rows"))


def no_nulls(name: str, column: str, label: str, severity: str = "error") -> AggRule:
    """V3: no NULL in a column."""
    return AggRule(name, severity, "0", {"n": F.count_if(F.col(column).isNull())},
                   lambda a: a("n") == 0, lambda a: a("n"),
                   lambda a: F.format_string(f"%d null values in {label}.{column}", a("n")))


def freshness(name: str, date_col: str, ref: date, label: str, max_lag_days: int = 7) -> AggRule:
    """V4: newest date within max_lag_days of the run date; no rows fails."""
    cutoff = ref - timedelta(days=max_lag_days)
    return AggRule(
        name, "warning", f">= {cutoff.isoformat()}", {"mx": F.max(F.col(date_col).cast("date"))},
        lambda a: a("mx") >= F.lit(cutoff).cast("date"), lambda a: a("mx").cast("string"),
        lambda a: F.when(a("mx").isNull(), F.lit(f"could not determine max {date_col} in {label}")).otherwise(
            F.format_string(f"latest {date_col} is %s, more than {max_lag_days} days before {ref.isoformat()}", a("mx").cast("string"))),
    )


def null_rate(name: str, column: str, bound: float, severity: str, threshold: str, inclusive: bool = False,
              message: str = "", requires: Column | None = None) -> AggRule:
    """V7: share of NULLs below (or at most) a bound; an empty table counts as 0.
    With ``requires`` (e.g. a snapshot date), the rule fails without a value when it is NULL."""
    rate = lambda a: F.coalesce(a("r"), F.lit(0.0))
    cmp = (lambda a: rate(a) <= bound) if inclusive else (lambda a: rate(a) < bound)
    if requires is None:
        passed, value = cmp, (lambda a: pct_text(rate(a)))
        msg = lambda a: F.concat(pct_text(rate(a)), F.lit(message or f" of {column} is null"))
    else:
        passed = lambda a: F.when(requires.isNull(), F.lit(False)).otherwise(cmp(a))
        value = lambda a: F.when(requires.isNotNull(), pct_text(rate(a)))
        msg = lambda a: F.when(requires.isNull(), F.lit("no snapshot")).otherwise(
            F.concat(pct_text(rate(a)), F.lit(message or f" of {column} is null")))
    return AggRule(name, severity, threshold,
                   {"r": F.avg(F.when(F.col(column).isNull(), F.lit(1.0)).otherwise(F.lit(0.0)))},
                   passed, value, msg)


def count_where(name: str, cond: Column, severity: str, threshold: str = "0", what: str = "rows") -> AggRule:
    """V8: no row matches a bad condition."""
    return AggRule(name, severity, threshold, {"n": F.count_if(F.coalesce(cond, F.lit(False)))},
                   lambda a: a("n") == 0, lambda a: a("n"),
                   lambda a: F.format_string(f"%d {what}", a("n")))


def min_count(name: str, agg: Column, n_min: int, severity: str, threshold: str) -> AggRule:
    """V9: at least n rows / distinct keys."""
    return AggRule(name, severity, threshold, {"n": agg},
                   lambda a: a("n") >= n_min, lambda a: a("n"),
                   lambda a: F.format_string(f"only %d, expected >= {n_min}", a("n")))


def window_coverage(name: str, date_col: str, start: date | None, label: str) -> AggRule:
    """The oldest date reaches back to the required start; empty fails."""
    thr = f"<= {start.isoformat() if start else None}"
    if start is None:
        return AggRule(name, "warning", thr, {"mn": F.min(date_col)}, lambda a: F.lit(False),
                       lambda a: _null_str(), lambda a: F.lit(f"{label} has no dates to compare with the required start"))
    return AggRule(
        name, "warning", thr, {"mn": F.min(F.col(date_col).cast("date"))},
        lambda a: a("mn") <= F.lit(start).cast("date"), lambda a: a("mn").cast("string"),
        lambda a: F.when(a("mn").isNull(), F.lit(f"{label} has no dates to compare with the required start")).otherwise(
            F.format_string(f"{label} starts at %s, after {start.isoformat()}", a("mn").cast("string"))),
    )


# ------------------------------------------------------------------ rules with their own pass


def _one(spark: SparkSession, name: str, severity: str, passed: Column, value: Column, threshold: str | None,
         message: Column, source: DataFrame | None = None) -> DataFrame:
    base = source if source is not None else spark.range(1)
    return base.select(_result_struct(name, severity, passed, value, threshold, message).alias("r")).select("r.*")


def as_of_slice_lazy(table: DataFrame, ref: date, col: str = "reference_date") -> tuple[DataFrame, Column]:
    """The as-of slice and its snapshot date as a scalar-subquery column (NULL when
    there is no snapshot <= ref); nothing runs until the checks run."""
    snap = table.select(F.max(F.when(F.col(col) <= F.lit(ref).cast("date"), F.col(col)))).scalar()
    return table.where(F.col(col) == snap), snap


def as_of_slice(table: DataFrame, ref: date, col: str = "reference_date") -> tuple[DataFrame, date | None]:
    snap = SN.snapshot_date(table, ref, col)
    if snap is None:
        return table.where(F.lit(False)), None
    return table.where(F.col(col) == F.lit(snap).cast("date")), snap


def snapshot_exists(spark: SparkSession, name: str, snap: date | Column | None, ref: date, label: str) -> DataFrame:
    """V1: a snapshot at or before the run date exists (``snap`` a date or a scalar column)."""
    if isinstance(snap, Column):
        ok, value = snap.isNotNull(), snap.cast("string")
    else:
        ok, value = F.lit(snap is not None), F.lit(snap.isoformat() if snap else None).cast("string")
    return _one(spark, name, "error", ok, value, f"<= {ref.isoformat()}",
                F.lit(f"no snapshot in {label} on or before {ref.isoformat()}"))


def pk_unique(df: DataFrame, name: str, columns: Sequence[str], label: str) -> DataFrame:
    """V5: number of duplicated key groups (NULL is a key value) is 0."""
    groups = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("__n"))
    agg = groups.agg(F.count_if(F.col("__n") > 1).alias("d"))
    return _one(df.sparkSession, name, "error", F.col("d") == 0, F.col("d"), "0",
                F.format_string(f"%d duplicate ({', '.join(columns)}) combinations in {label}", F.col("d")), agg)


def known_values(df: DataFrame, name: str, column: str, known: Iterable[str], label: str) -> DataFrame:
    """V6: distinct non-NULL values are a subset of the known set."""
    known = sorted(known)
    value = F.col(column).cast("string")
    # known values go first and each unknown one is kept once, so only distinct unknown values are gathered
    rare = df.select(value.alias("u")).where(value.isNotNull() & ~value.isin(known)).distinct()
    agg = rare.agg(F.array_sort(F.collect_list("u")).alias("u"))
    txt = F.when(F.size("u") > 0, F.array_join("u", ", "))
    return _one(df.sparkSession, name, "warning", F.size("u") == 0, txt, f"subset of {{{', '.join(known)}}}",
                F.concat(F.lit(f"unknown values in {label}.{column}: "), F.array_join("u", ", ")), agg)


def referential(child: DataFrame, parent: DataFrame, name: str, key: str, min_share: float, label: str,
                requires: Column | None = None) -> DataFrame:
    """Share of (non-NULL) child keys found among the distinct parent keys;
    no child keys counts as 100%.

    Child rows are first counted per key (a map-side partial aggregate), so a
    hot key crosses the shuffle as one counted row; the join then matches
    distinct keys only.
    """
    p = parent.select(F.col(key).alias("__k")).distinct().withColumn("__hit", F.lit(1))
    c = child.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("__k")).agg(F.count(F.lit(1)).alias("__n"))
    j = c.join(p, "__k", "left")
    hit_rows = F.sum(F.when(F.col("__hit").isNotNull(), F.col("__n")).otherwise(F.lit(0)))
    agg = j.agg(F.coalesce(hit_rows / F.sum("__n"), F.lit(1.0)).alias("share"))
    ok, value, thr = F.col("share") >= min_share, pct_text(F.col("share")), f">= {min_share:.0%}"
    msg = F.concat(pct_text(F.col("share")), F.lit(f" of {label} keys matched"))
    if requires is not None:
        missing = requires.isNull()
        ok = F.when(missing, F.lit(False)).otherwise(ok)
        value = F.when(~missing, value)
        msg = F.when(missing, F.lit("one of the two tables has no snapshot to compare")).otherwise(msg)
        # the threshold text differs when the check cannot run
        thr_col = F.when(missing, F.lit(f"{thr} matched")).otherwise(F.lit(thr))
        return agg.select(F.struct(
            F.lit(name).alias("check_name"), F.lit("warning").alias("severity"), F.coalesce(ok, F.lit(False)).alias("passed"),
            value.cast("string").alias("value"), thr_col.alias("threshold"),
            F.when(~F.coalesce(ok, F.lit(False)), msg).cast("string").alias("message")).alias("r")).select("r.*")
    return _one(child.sparkSession, name, "warning", ok, value, thr, msg, agg)


def max_gap(dates: DataFrame, name: str, date_col: str, max_days: int, label: str) -> DataFrame:
    """Largest gap between consecutive dates within bound; fewer than 2 dates fails.
    The window runs over the distinct dates of a calendar-bounded table."""
    d = dates.select(F.col(date_col).cast("date").alias("d")).where(F.col("d").isNotNull()).distinct()
    gaps = d.withColumn("g", F.datediff("d", F.lag("d").over(Window.orderBy("d"))))
    agg = gaps.agg(F.max("g").alias("mg"))
    return _one(dates.sparkSession, name, "warning", F.col("mg") <= max_days, F.col("mg"), f"<= {max_days} days",
                F.when(F.col("mg").isNull(), F.lit(f"fewer than 2 dates in {label}")).otherwise(
                    F.format_string("largest gap is %d days", F.col("mg"))), agg)


def required_columns(spark: SparkSession, df_columns: Sequence[str], name: str, required: Iterable[str]) -> DataFrame:
    """Column names present (schema only, no data pass)."""
    missing = sorted(set(required) - set(df_columns))
    return _one(spark, name, "error", F.lit(not missing), F.lit(", ".join(missing) if missing else None).cast("string"),
                "all required columns present", F.lit("missing columns: " + ", ".join(missing)))


def combo_coverage(rankings: DataFrame, name: str, expected: Sequence[tuple[str, str, str]]) -> DataFrame:
    """Every configured segment is present."""
    exp = rankings.sparkSession.createDataFrame(list(expected), "purpose string, profile string, investor_type string")
    present = rankings.select("purpose", "profile", "investor_type").distinct()
    n_present = exp.join(present, ["purpose", "profile", "investor_type"], "left_semi").agg(F.count(F.lit(1)).alias("n"))
    total = len(expected)
    return _one(rankings.sparkSession, name, "warning", F.col("n") == total,
                F.format_string(f"%d/{total}", F.col("n")), f"all {total} combos present",
                F.format_string(f"%d combos missing", F.lit(total) - F.col("n")), n_present)


# ------------------------------------------------------------------ gate (V0)


def with_context(results: DataFrame, task: str, dataset: str, ref: date) -> DataFrame:
    return results.select(
        F.lit(ref).cast("date").alias("reference_date"), F.lit(task).alias("task"), F.lit(dataset).alias("dataset"),
        "check_name", "severity", "passed", "value", "threshold", "message",
    )


class GateError(ValueError):
    pass


def gate(results: DataFrame, task: str, log_sink: Callable[[DataFrame], None] | None = None) -> DataFrame:
    """V0: evaluate the checks once, append every result to the log, then raise
    naming the failed error-level checks.

    The result has one row per rule (about a hundred at most), so it is
    collected once and re-created as a small DataFrame for the log.
    """
    spark = results.sparkSession
    rows = results.collect()
    res = spark.createDataFrame(rows, results.schema)
    if log_sink is not None:
        log_sink(res)
    failed = sorted(r["check_name"] for r in rows if not r["passed"] and r["severity"] == "error")
    if failed:
        raise GateError(f"{task}: error-level checks failed: {', '.join(failed)}")
    return res
