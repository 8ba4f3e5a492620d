"""Vectors against query vectors in bounded cells of (shard of all vectors) x (block of queries).

A search runs in every cell by itself and returns its best few; Spark merges them per query. A cell holds at most
``SHARD_ROWS`` vectors and ``QUERY_ROWS`` queries, so no task grows with the table.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import group_arrow, stored

SHARD_ROWS, LEAST_SHARDS, QUERY_ROWS = 65_536, 16, 8_192
EVERY = 50


def usable(vectors: DataFrame, zero: bool) -> DataFrame:
    """vec_id, x (array<double>), uid of vectors without null or non-finite components; all-zero ones only if ``zero``."""
    x = F.col("embedding").cast("array<double>")
    bad = F.exists("x", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    rows = vectors.select("vec_id", x.alias("x")).where(F.col("x").isNotNull() & ~bad)
    if not zero:
        rows = rows.where(F.exists("x", lambda v: v != 0))
    return stored(rows.withColumn("uid", F.monotonically_increasing_id()), "vectors")


def matrix(lists: pa.Array) -> np.ndarray:
    """Rows of a list array as a matrix; shorter vectors are filled with 0."""
    if isinstance(lists, pa.ChunkedArray):
        lists = lists.combine_chunks()
    ends = lists.offsets.to_numpy().astype(np.int64)
    sizes, flat = np.diff(ends), lists.flatten().to_numpy(zero_copy_only=False)
    out = np.zeros((len(sizes), int(sizes.max(initial=0))))
    out[np.repeat(np.arange(len(sizes)), sizes), np.arange(len(flat)) - np.repeat(ends[:-1] - ends[0], sizes)] = flat
    return out


def search(vectors: DataFrame, cell_search: Callable, score: str, k: int = 5, every: int = EVERY) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` best of ``cell_search`` for each row whose vec_id is divisible by ``every``.

    ``cell_search(data, queries)`` yields, per query row, the places and scores of its candidates in the cell; it may
    give the query's own row, which is dropped here, so it should give ``k`` + 1.
    """
    n = vectors.count()
    is_query = F.col("vec_id") % every == 0
    shards = max(LEAST_SHARDS, -(-n // SHARD_ROWS))
    blocks = max(1, -(-vectors.where(is_query).count() // QUERY_ROWS))
    shard = F.pmod(F.xxhash64("uid"), F.lit(shards))
    block = F.pmod(F.xxhash64("uid", F.lit("block")), F.lit(blocks))
    data = vectors.select("vec_id", "uid", "x", F.lit(False).alias("query"), shard.alias("shard"),
                          F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))).alias("block"))
    queries = vectors.where(is_query).select("vec_id", "uid", "x", F.lit(True).alias("query"),
                                             F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long"))).alias("shard"),
                                             block.alias("block"))

    def cell(rows: pa.Table) -> pa.Table:
        ask = rows.column("query").to_numpy()
        own, vec = rows.column("uid").to_numpy(), rows.column("vec_id")
        all_x = matrix(rows.column("x"))
        at, asked = np.flatnonzero(~ask), np.flatnonzero(ask)
        found = [(q, at[c], s) for q, (c, s) in zip(asked, cell_search(all_x[at], all_x[asked]))] if len(at) and len(asked) else []
        q = np.concatenate([np.full(len(c), q) for q, c, _ in found]).astype(np.int64) if found else np.zeros(0, np.int64)
        c = np.concatenate([c for _, c, _ in found]).astype(np.int64) if found else np.zeros(0, np.int64)
        s = np.concatenate([s for *_, s in found]) if found else np.zeros(0, "int64" if score == "long" else float)
        keep = own[q] != own[c]
        q, c, s = q[keep], c[keep], s[keep]
        return pa.table({"query_uid": pa.array(own[q], pa.int64()), "query_id": vec.take(pa.array(q)).cast(pa.int64()),
                         "vec_id": vec.take(pa.array(c)).cast(pa.int64()), "score": pa.array(s)})

    found = group_arrow(data.unionByName(queries).groupBy("shard", "block"), cell, f"query_uid long, query_id long, vec_id long, score {score}")
    best = Window.partitionBy("query_uid").orderBy(F.desc("score"), F.col("vec_id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
