"""Rank operators: average-tie percentiles, competition ranks, top-n, cohort percentiles.

Ranks inside a group (an investor type, a segment) are computed without ever
holding a whole group in one window partition: ``rank_bounds`` counts rows per
distinct value (a map-side partial aggregate), cuts each group into value
buckets at approximate quantiles (a small, bounded table of cut points read
once), runs the cumulative count inside (group, bucket) windows and adds the
per-bucket offsets from a tiny totals table. The result is exact: the cut
points only decide where the work is split.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def rank_bounds(df: DataFrame, group: Sequence[str], value: str, descending: bool = False, buckets: int | None = None) -> DataFrame:
    """Per row with a non-NULL ``value``: ``__lo`` = 1 + number of values ordered
    strictly before it (the competition rank), ``__hi`` = number of values up to
    and including its ties, ``__n`` = non-NULL values in the group. Rows with a
    NULL value are returned with NULL bounds.

    Work is split by (group, value bucket); no window partition holds a group. A group gets as
    many buckets as the session has shuffle partitions, unless told otherwise.
    """
    spark = df.sparkSession
    buckets = max(2, buckets or int(spark.conf.get("spark.sql.shuffle.partitions")))
    g = list(group)
    v = F.col(value).cast("double")
    key = (-v if descending else v)
    rows = df.withColumn("__v", F.when(F.col(value).isNotNull(), key))
    counts = rows.where(F.col("__v").isNotNull()).groupBy(*g, "__v").agg(F.count(F.lit(1)).alias("__c"))
    # cut points per group: approximate quantiles of the distinct values, a bounded
    # (groups x buckets) table read once, so bucket membership is a pure function of the value
    probs = [i / buckets for i in range(1, buckets)]
    cuts_rows = counts.groupBy(*g).agg(F.percentile_approx("__v", probs, 1000).alias("__cuts")).collect()
    cuts_schema = ", ".join([f"`{c}` {dict(df.dtypes)[c]}" for c in g] + ["__cuts array<double>"])
    cuts = spark.createDataFrame([tuple(r) for r in cuts_rows], cuts_schema)
    counts = counts.join(F.broadcast(cuts), g, "inner").withColumn(
        "__b", F.size(F.filter(F.array_distinct("__cuts"), lambda c: c < F.col("__v")))).drop("__cuts")
    w_local = Window.partitionBy(*g, "__b").orderBy("__v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = counts.withColumn("__le_local", F.sum("__c").over(w_local))
    totals = counts.groupBy(*g, "__b").agg(F.sum("__c").alias("__tot"))
    w_prev = Window.partitionBy(*g).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select(
        *g, "__b",
        F.coalesce(F.sum("__tot").over(w_prev), F.lit(0)).alias("__off"),
        F.sum("__tot").over(Window.partitionBy(*g)).alias("__n"),
    )
    bounds = local.join(F.broadcast(totals), [*g, "__b"], "inner").select(
        *g, "__v",
        (F.col("__off") + F.col("__le_local") - F.col("__c") + F.lit(1)).alias("__lo"),
        (F.col("__off") + F.col("__le_local")).alias("__hi"),
        "__n",
    )
    ranked = rows.where(F.col("__v").isNotNull()).join(bounds, [*g, "__v"], "inner")
    nulls = (rows.where(F.col("__v").isNull()).withColumn("__lo", F.lit(None).cast("bigint"))
             .withColumn("__hi", F.lit(None).cast("bigint")).withColumn("__n", F.lit(None).cast("bigint")))
    return ranked.unionByName(nulls).drop("__v")


def average_rank_pct(df: DataFrame, partition: Sequence[str], value: str, out: str = "pct") -> DataFrame:
    """Pandas-style ``rank(pct=True)``: the average rank of ties divided by the
    number of non-NULL values; NULL values get NULL.

    average rank = (min rank + max rank) / 2, both exact integers from ``rank_bounds``.
    """
    r = rank_bounds(df, partition, value)
    pct = ((F.col("__lo") + F.col("__hi")) / F.lit(2.0)) / F.col("__n")
    return r.withColumn(out, pct).drop("__lo", "__hi", "__n")


def competition_rank(df: DataFrame, partition: Sequence[str], score: str, out: str = "rank") -> DataFrame:
    """Min rank of the score, descending, per partition; NULL scores rank after
    every non-NULL score (all tied), like ``rank()`` with NULLS LAST."""
    r = rank_bounds(df, partition, score, descending=True)
    n_nonnull = df.where(F.col(score).isNotNull()).groupBy(*partition).agg(F.count(F.lit(1)).alias("__nn"))
    # one row per group: a shuffle by group would put a group's rows in one task
    r = r.join(F.broadcast(n_nonnull), list(partition), "left")
    rank = F.coalesce(F.col("__lo"), F.coalesce(F.col("__nn"), F.lit(0)) + F.lit(1))
    return r.withColumn(out, rank.cast("int")).drop("__lo", "__hi", "__n", "__nn")


def top_n_per_group(df: DataFrame, partition: Sequence[str], order: Sequence[Column], n: int, pos: str = "position") -> DataFrame:
    """The first ``n`` rows per group by ``order`` with their 1-based position.
    ``row_number() <= n`` lets Spark insert a per-partition group limit before
    the shuffle (WindowGroupLimit), so only n rows per group per map task move."""
    w = Window.partitionBy(*partition).orderBy(*order)
    return df.withColumn(pos, F.row_number().over(w)).where(F.col(pos) <= n)


def cohort_percentile(df: DataFrame, partition: Sequence[str], value: str, higher_is_better: bool, out: str) -> DataFrame:
    """Share of the cohort strictly worse than the row, x 100 (NULLs excluded).

    Strictly lower values (higher is better) = competition rank - 1 ascending;
    strictly higher values (lower is better) = competition rank - 1 descending.
    """
    r = rank_bounds(df, partition, value, descending=not higher_is_better)
    pct = (F.col("__lo") - F.lit(1)) / F.col("__n") * F.lit(100.0)
    return r.withColumn(out, pct).drop("__lo", "__hi", "__n")
