"""Keyed-table operators: null-safe joins and ordered de-duplication.

``subclass_id`` is nullable and part of every series key; NULL is a real key
value. Joins therefore compare keys with ``<=>`` (still planned as an
equi-join), and de-duplication groups NULL keys together.

De-duplication is written as an aggregate (``min_by`` / ``max_by`` over a
struct of the row) instead of ``row_number() = 1``: the aggregate runs a
partial, map-side pass before the shuffle, so a key that holds a huge group of
copies is reduced to one row per map task before it moves, and no single task
ever sorts the whole group.
"""

from __future__ import annotations

from typing import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on keys treating NULL = NULL; the right side's key columns are dropped.

    For ``left_semi`` / ``left_anti`` only the left columns remain.
    """
    r = right.select(*[F.col(k).alias(f"__r_{k}") for k in keys], *[c for c in right.columns if c not in keys])
    cond = None
    for k in keys:
        c = left[k].eqNullSafe(r[f"__r_{k}"])
        cond = c if cond is None else cond & c
    out = left.join(r, cond, how)
    if how in ("left_semi", "semi", "leftsemi", "left_anti", "anti", "leftanti"):
        return out
    if how in ("full", "outer", "full_outer", "fullouter", "right", "right_outer"):
        out = out.select(
            *[F.coalesce(left[k], r[f"__r_{k}"]).alias(k) if k in keys else left[k] for k in left.columns],
            *[r[c] for c in r.columns if not c.startswith("__r_")],
        )
        return out
    return out.drop(*[f"__r_{k}" for k in keys])


def _order_struct(order: Sequence[Column | str]) -> Column:
    cols = [F.col(o) if isinstance(o, str) else o for o in order]
    return F.struct(*[c.alias(f"o{i}") for i, c in enumerate(cols)])


def _kept(df: DataFrame, key: Sequence[str], order: Sequence[Column | str], best: Callable[[Column, Column], Column]) -> DataFrame:
    """One row per key. The key columns are those grouped by: they stay out of the moved row, and what follows by the
    same key needs no further shuffle."""
    rest = [c for c in df.columns if c not in key]
    row = F.struct(*[F.col(c) for c in rest]) if rest else F.struct(F.lit(True))
    grouped = df.groupBy(*key).agg(best(row, _order_struct(order)).alias("__row"))
    return grouped.select(*[F.col(f"__row.{c}").alias(c) if c in rest else F.col(c) for c in df.columns])


def keep_first(df: DataFrame, key: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """Keep, per key, the row that sorts first by ``order`` (ascending, NULLs first).

    ``order`` must be a total order within a key for a deterministic result;
    append tie-breaker columns when the data has none.
    """
    return _kept(df, key, order, F.min_by)


def keep_last(df: DataFrame, key: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """Keep, per key, the row that sorts last by ``order`` (ascending, NULLs first,
    so NULL order values lose against any value)."""
    return _kept(df, key, order, F.max_by)


def dedupe_first(df: DataFrame, key: Sequence[str], by: str, tie_breakers: Sequence[str] = ()) -> DataFrame:
    """Per key keep the first row by ``by`` ascending with NULLs first."""
    return keep_first(df, key, [by, *tie_breakers])


def dedupe_latest(df: DataFrame, key: Sequence[str], by: str, tie_breakers: Sequence[str] = ()) -> DataFrame:
    """Per key keep the row with the highest ``by`` (NULL lowest)."""
    return keep_last(df, key, [by, *tie_breakers])


def latest_row_per_key(df: DataFrame, key: Sequence[str], date_col: str) -> DataFrame:
    """Newest row per key (``QUALIFY ROW_NUMBER() OVER (ORDER BY date DESC) = 1``)."""
    return keep_last(df, key, [date_col])


def last_non_null_per_column(
    df: DataFrame,
    key: Sequence[str],
    date_col: str,
    value_cols: Sequence[str],
    tie_breakers: Sequence[str] = (),
    null_date_is_latest: bool = True,
) -> DataFrame:
    """Sort by date (NULL date sorts as the latest), then per key take the
    last **non-NULL** value of each column independently. The date column
    itself becomes its last non-NULL value (its maximum).
    """
    d = F.col(date_col)
    if null_date_is_latest:
        d = F.coalesce(d, F.lit("9999-12-31").cast("date"))
    order = F.struct(d.alias("d"), *[F.col(t).alias(f"t{i}") for i, t in enumerate(tie_breakers)])
    aggs = [F.max(date_col).alias(date_col)]
    for c in value_cols:
        aggs.append(F.max_by(F.when(F.col(c).isNotNull(), F.col(c)), F.when(F.col(c).isNotNull(), order)).alias(c))
    return df.groupBy(*key).agg(*aggs)
