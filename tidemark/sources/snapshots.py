"""Snapshot selection over tables partitioned by ``reference_date``.

The chosen snapshot date is a scalar over partition values (one tiny
aggregate); the slice is then a partition-pruned equality filter.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

RD = "reference_date"


def scan_where(df: DataFrame, col: str, lo: date | None = None, hi: date | None = None, eq: date | None = None) -> DataFrame:
    """Equality / range predicate on a date column (pushed to the scan or pruned by partition)."""
    c = F.col(col)
    if eq is not None:
        return df.where(c == F.lit(eq).cast("date"))
    cond = F.lit(True)
    if lo is not None:
        cond = cond & (c >= F.lit(lo).cast("date"))
    if hi is not None:
        cond = cond & (c <= F.lit(hi).cast("date"))
    return df.where(cond)


def as_of_snapshot_date(df: DataFrame, ref: date, col: str = RD) -> date | None:
    """S8 date: newest snapshot <= ref, else the earliest after it, else None."""
    r = F.lit(ref).cast("date")
    row = df.agg(
        F.coalesce(F.max(F.when(F.col(col) <= r, F.col(col))), F.min(F.when(F.col(col) >= r, F.col(col)))).alias("s")
    ).first()
    return row["s"] if row else None


def as_of_snapshot(df: DataFrame, ref: date, col: str = RD) -> DataFrame:
    """The slice of the as-of snapshot (empty when the table has none)."""
    s = as_of_snapshot_date(df, ref, col)
    return df.where(F.lit(False)) if s is None else df.where(F.col(col) == F.lit(s).cast("date"))


def as_of_snapshot_lazy(df: DataFrame, ref: date, col: str = RD) -> DataFrame:
    """S8 without a driver round trip: the snapshot date is a scalar subquery
    (evaluated with the query, before the scan that it prunes)."""
    r = F.lit(ref).cast("date")
    snap = df.select(
        F.coalesce(F.max(F.when(F.col(col) <= r, F.col(col))), F.min(F.when(F.col(col) >= r, F.col(col))))
    ).scalar()
    return df.where(F.col(col) == snap)


def latest_snapshot_date(df: DataFrame, col: str = RD) -> date | None:
    row = df.agg(F.max(col).alias("s")).first()
    return row["s"] if row else None


def latest_snapshot(df: DataFrame, col: str = RD) -> DataFrame:
    """The newest snapshot of a table."""
    s = latest_snapshot_date(df, col)
    return df.where(F.lit(False)) if s is None else df.where(F.col(col) == F.lit(s).cast("date"))


def latest_snapshot_lazy(df: DataFrame, col: str = RD) -> DataFrame:
    """S9 without a driver round trip: the newest date is a scalar subquery, so several tables resolve in one plan."""
    return df.where(F.col(col) == df.select(F.max(col)).scalar())


def snapshot_date(df: DataFrame, ref: date, col: str = RD) -> date | None:
    """Newest snapshot <= ref, no future fallback."""
    row = df.agg(F.max(F.when(F.col(col) <= F.lit(ref).cast("date"), F.col(col))).alias("s")).first()
    return row["s"] if row else None
