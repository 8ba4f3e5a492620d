"""Links of the second pass: what is told apart where items meet, and components joined whole."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from tests.llm import brute
from tidemark.llm import links
from tidemark.llm.common import stored


def grouped(pairs) -> dict:
    groups = brute.Groups({x for p in pairs for x in p})
    for a, b in pairs:
        groups.join(a, b)
    return {x: groups.find(x) for x in groups.up}


@pytest.mark.parametrize("seed", [1, 2])
def test_components_are_joined_whole(spark, seed):
    rng = random.Random(seed)
    first, later = ([(a, b) for a, b in ((rng.randrange(150), rng.randrange(150)) for _ in range(n)) if a != b] for n in (60, 40))
    table = lambda pairs: spark.createDataFrame(pairs, "a long, b long")
    found = links._merged(links.components(table(first)), table(later))
    assert {r.id: r.component for r in found.collect()} == grouped(first + later)


def test_leftover_pairs_are_told_apart_where_they_meet(spark):
    # values of one key within a tenth and of the same parity are links; the center is a link of few
    rng = random.Random(3)
    values = sorted(rng.sample(range(100, 4000), 150))
    posts = stored(spark.createDataFrame([(7, v, 0, (v,)) for v in values], "key long, id long, weight int, item struct<n:long>"), "posts")
    given = []
    linked = lambda pairs: pairs.select("a", "b", (F.col("a") % 2 == F.col("b") % 2).alias("linked"), F.lit(None).cast("boolean").alias("gap"))
    match = lambda x, y: F.abs(x.n - y.n) * 10 <= F.greatest(x.n, y.n)

    def rest(pairs, gaps):
        given.extend((r.a, r.b) for r in pairs.collect())
        return linked(pairs)

    found = links.linked(posts, match, lambda pairs, gaps: linked(pairs), span=lambda item: F.floor(F.log(item.n) / 0.10537), confirm_rest=rest,
                         sketch=lambda ids: ids.withColumn("sketch", F.col("id") % 2), apart=lambda x, y: x != y)
    near = lambda a, b: abs(a - b) * 10 <= max(a, b) and a % 2 == b % 2
    want = grouped([(a, b) for a in values for b in values if a < b and near(a, b)])
    assert {r.id: r.component for r in found.collect()} == want
    assert given and all(near(a, b) for a, b in given)


def test_the_join_of_leftover_pairs_is_compiled(spark, monkeypatch):
    key, seen = "spark.sql.codegen.hugeMethodLimit", {}
    before = spark.conf.get(key)
    kept = links.stored

    def noted(df, label, *more):
        seen[label] = spark.conf.get(key)
        return kept(df, label, *more)

    monkeypatch.setattr(links, "stored", noted)
    posts = kept(spark.createDataFrame([(7, v, 0, (v,)) for v in range(5)], "key long, id long, weight int, item struct<n:long>"), "posts")
    linked = lambda pairs, gaps: pairs.select("a", "b", (F.col("a") + F.col("b") == 6).alias("linked"), F.lit(None).cast("boolean").alias("gap"))
    found = links.linked(posts, lambda x, y: x.n != y.n, linked)
    assert {r.id: r.component for r in found.collect()} == {2: 2, 4: 2}
    assert int(seen["rest"]) == 8000 and seen["star"] == before == spark.conf.get(key)
