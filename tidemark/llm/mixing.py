"""Mixing sources to target weights by weighted fair queueing.

1. ``source_targets``: one row per source with its size, weight and target. Targets share ``share`` times all sizes by
   weight; none exceeds ``cap`` times its source, and the excess goes to the others by weight. With sources in
   ascending order of cap per weight, the common level is the largest of (budget - caps before) / (weights from here
   on), so windows over the source table solve it exactly.
2. ``mix``: every source's documents are shuffled (by a hash of their id) and offered up to ceil(cap) times over. A
   copy's virtual finish time is its source's running size at its end divided by the source's target. All copies are
   sorted by finish time, and taken until the budget is used up; the copy on the border is taken in part.

Running sums never hold a source or the whole table in one task: they are taken within hash prefixes of a source (and
within narrow ranges of finish time) and added to the running sums of the prefixes' (ranges') totals.

Cases: null text has size 0; sizes of 0 take nothing; a null source is a source of its own, last in order; a null id
hashes as an empty one; equal hashes are ordered by id and size, so repeated rows are copies next to each other, each
with its own share; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

#: White space is space, tab and the line and page controls; everything between is a word.
WORD = r"[^\x20\x09-\x0D]+"
SEED = "mix"
#: Ranges of finish time: this many to 1 (the budget's end) and as many to 2, then 64 to each doubling.
RANGES = 4096


def n_words(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def _before(value: str, window) -> Column:
    return F.sum(value).over(window.rowsBetween(Window.unboundedPreceding, 0)) - F.col(value)


def source_targets(sized: DataFrame, weights: tuple = (5, 2, 1), share: float = 1.5, cap: float = 2.0) -> DataFrame:
    """source, source_size, weight, budget, target: one row per source; ``weights`` repeat in code-point order."""
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    every = Window.partitionBy()
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.row_number().over(order) - 1) % len(weights) + 1)
    caps = totals.withColumn("weight", weight).withColumn("most", F.col("source_size") * cap).withColumn(
        "budget", F.sum("source_size").over(every) * share)
    filling = Window.orderBy(F.col("most") / F.col("weight"), F.col("source").asc_nulls_last())
    level = (F.col("budget") - _before("most", filling)) / (F.sum("weight").over(every) - _before("weight", filling))
    return caps.withColumn("level", level).withColumn("level", F.max("level").over(every)).select(
        "source", "source_size", "weight", F.floor("budget").alias("budget"),
        F.least(F.col("most"), F.col("level") * F.col("weight")).alias("target"))


def mix(docs: DataFrame, weights: tuple = (5, 2, 1), share: float = 1.5, cap: float = 2.0, keep: tuple = ()) -> DataFrame:
    """doc_id, size, source_size, target, taken (words, repeats counted) for every row, and the columns ``keep``."""
    sized = stored(docs.select("doc_id", "source", n_words(F.col("text")).alias("size"), *keep), "sizes")
    hashed = sized.withColumn("h", F.md5(F.concat(F.lit(SEED), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))))
    hashed = hashed.withColumn("prefix", F.substring("h", 1, 3))
    targets = stored(source_targets(sized, weights, share, cap), "targets")

    line = Window.partitionBy("source", "prefix").orderBy("h", F.col("doc_id").asc_nulls_first(), "size", *keep)
    placed = hashed.withColumn("inside", F.sum("size").over(line.rowsBetween(Window.unboundedPreceding, 0))).withColumn(
        "number", F.row_number().over(line))
    prefixes = hashed.groupBy("source", "prefix").agg(F.sum("size").alias("n"))
    prefixes = prefixes.join(targets, prefixes.source.eqNullSafe(targets.source)).select(
        prefixes.source, "prefix", "source_size", "budget", "target",
        _before("n", Window.partitionBy(prefixes.source).orderBy("prefix")).alias("before"))
    placed = placed.join(prefixes, placed.source.eqNullSafe(prefixes.source) & (placed.prefix == prefixes.prefix)).select(
        "doc_id", placed.source, placed.prefix, "h", "number", "size", *keep, "source_size", "budget", "target",
        (F.col("before") + F.col("inside")).alias("end"))

    rounds = F.when(F.col("size") > 0, F.sequence(F.lit(0), F.lit(math.ceil(cap) - 1))).otherwise(F.array(F.lit(0)))
    copies = placed.withColumn("round", F.explode(rounds)).withColumn(
        "finish", (F.col("end") + F.col("round") * F.col("source_size")) / F.nullif("target", F.lit(0.0)))
    ranges = (F.when((F.col("size") == 0) | F.col("finish").isNull(), -1 - F.pmod(F.xxhash64("h"), F.lit(RANGES)))
              .when(F.col("finish") < 2, F.floor(F.col("finish") * RANGES))
              .otherwise(2 * RANGES + F.floor(F.log2("finish") * 64)).cast("int"))
    copies = stored(copies.withColumn("range", ranges), "copies")
    spread = copies.groupBy("range").agg(F.sum("size").alias("n")).select(
        "range", _before("n", Window.orderBy("range")).alias("earlier"))
    queue = Window.partitionBy("range").orderBy("finish", F.col("source").asc_nulls_last(), "h",
                                                F.col("doc_id").asc_nulls_first(), "size", *keep, "round", "number")
    return copies.withColumn("so_far", _before("size", queue)).join(spread, "range").withColumn(
        "taken", F.greatest(F.lit(0), F.least(F.col("size"), F.col("budget") - F.col("earlier") - F.col("so_far"))).cast("long")
    ).groupBy("doc_id", "source", "prefix", "number", "size", *keep, "source_size", "target").agg(F.sum("taken").alias("taken")).select(
        "doc_id", "size", "source_size", "target", "taken", *keep)


ORACLE = f"""
with sized as (
  select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{WORD}'))::bigint as size,
         md5('{SEED}' || coalesce(doc_id::varchar, '')) as h
  from documents),
totals as (
  select source, sum(size)::bigint as source_size,
         [5, 2, 1][(row_number() over (order by source nulls last) - 1) % 3 + 1] as weight
  from sized group by source),
caps as (
  select *, source_size * 2.0::double as most, sum(source_size) over () * 1.5::double as budget from totals),
levels as (
  select *, (budget - (sum(most) over w - most)) / (sum(weight) over () - (sum(weight) over w - weight)) as one
  from caps window w as (order by most / weight, source nulls last rows unbounded preceding)),
targets as (
  select source, source_size, floor(budget)::bigint as budget, least(most, max(one) over () * weight) as target from levels),
placed as (
  select s.*, t.source_size, t.budget, t.target, row_number() over w as number, sum(size) over w as done
  from sized s join targets t on s.source is not distinct from t.source
  window w as (partition by s.source order by h, doc_id nulls first, size rows unbounded preceding)),
copies as (
  select *, (done + round * source_size) / nullif(target, 0) as finish from placed, (values (0), (1)) r(round)),
queue as (
  select *, sum(size) over (order by finish, source nulls last, h, doc_id nulls first, size, round, number
                            rows unbounded preceding) - size as used
  from copies where size > 0),
taken as (
  select source, number, sum(greatest(0, least(size, budget - used)))::bigint as taken from queue group by source, number)
select doc_id, size, source_size, target, coalesce(taken, 0)::bigint as taken
from placed p left join taken t on p.source is not distinct from t.source and p.number = t.number
"""
