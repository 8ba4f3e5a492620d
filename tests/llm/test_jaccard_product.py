"""The n-gram Jaccard join against all pairs in plain Python; its block keys lose no link."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm import brute
from tidemark.llm import jaccard_product, queries
from tidemark.llm.common import stored


def plain_join(rows, n: int = 4, similarity: int = 85) -> list[tuple]:
    sets = [brute.shingles(r[1], n) for r in rows]
    groups, named = brute.Groups(range(len(rows))), {}
    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if both and 100 * both >= similarity * (len(a) + len(sets[j]) - both):
                groups.join(i, j)
    for i, r in enumerate(rows):
        if r[0] is not None:
            named[groups.find(i)] = min(r[0], named.get(groups.find(i), r[0]))
    return sorted(((r[0], len(s), named.get(groups.find(i)) if s else r[0]) for i, (r, s) in enumerate(zip(rows, sets))), key=str)


def found(df):
    return sorted(map(tuple, df.select("doc_id", "n_shingles", "component_id").collect()), key=str)


def test_block_keys_lose_no_link():
    rng = np.random.default_rng(13)
    links = 0
    for k in range(2500):
        size = int(rng.integers(6, 20 if k % 3 else 400))
        pool = rng.integers(0, 2**64, 2 * size, dtype=np.uint64)
        drop, add = (int(rng.integers(0, size // 6 + 1)) for _ in range(2))
        a, b = np.unique(pool[:size]), np.unique(np.concatenate([pool[drop:size], pool[size : size + add]]))
        both = len(np.intersect1d(a, b))
        if 100 * both >= 85 * (len(a) + len(b) - both) and len(a) + len(b) > 2 * both:
            links += 1
            rows, keys = jaccard_product.block_keys(np.concatenate([a, b]), np.array([0, len(a), len(a) + len(b)]))
            assert len(np.intersect1d(keys[rows == 0], keys[rows == 1]))
    assert links > 500


def test_parities_differ_in_no_more_buckets_than_the_sets_do():
    rng = np.random.default_rng(4)
    pool = rng.integers(0, 2**64, 9000, dtype=np.uint64)
    for size in (1, 50, 4000):
        a, b = (np.unique(rng.choice(pool[: 2 * size], size)) for _ in range(2))
        odd = jaccard_product.parities(np.concatenate([a, b]), np.array([0, len(a), len(a) + len(b)]))
        bits = sum(int(x).bit_count() for x in (odd[0] ^ odd[1]).view(np.uint64))
        assert bits <= len(np.setxor1d(a, b))


def test_product_counts_or_drops():
    rng = np.random.default_rng(1)
    for _ in range(200):
        pool = rng.integers(0, 2**64, 120, dtype=np.uint64)
        center = np.unique(rng.choice(pool[:60], 50))
        rows = [np.unique(rng.choice(pool[: rng.choice([55, 60, 120])], rng.integers(1, 90))) for _ in range(9)]
        rows += [center, np.unique(np.append(center, pool[80]))]
        got = jaccard_product.product(center, np.concatenate(rows), np.cumsum([0, *map(len, rows)]))
        for r, n in zip(rows, got):
            both = len(np.intersect1d(center, r))
            assert n == (both if 100 * both >= 85 * (len(center) + len(r) - both) else -1)


@pytest.mark.parametrize("seed", [1, 2])
def test_join_on_awkward_documents(spark, tmp_path, seed):
    rows, rng = brute.awkward(seed, 90), random.Random(seed)
    rows = [(None, *r[1:]) if k % 17 == 3 else r for k, r in enumerate(rows)] + [(9, "another text of an id that is there twice", *rows[0][2:])]
    base = [f"w{k}" for k in range(300)]
    for k in range(50):  # a loose group around the threshold, its changes partly shared
        words = list(base)
        for _ in range(rng.randint(0, 12)):
            words[rng.randrange(300)] = f"x{rng.randrange(40)}"
        rows.append((1000 + k, " ".join(words), *rows[0][2:]))
    spark.createDataFrame(rows, brute.DOCS).repartition(5).write.parquet(f"{tmp_path}/documents.parquet")
    want = plain_join(rows)
    assert found(queries.op13_jaccard_product(spark, str(tmp_path))) == want
    assert len({r[2] for r in want}) < len(rows) - 40


def test_no_rows(spark):
    assert jaccard_product.jaccard_join(spark.createDataFrame([], brute.DOCS)).count() == 0
    assert found(jaccard_product.jaccard_join(spark.createDataFrame([(4, " \t "), (None, None)], "doc_id long, text string"))) == [(4, 0, 4), (None, 0, None)]


def test_rows_that_repeat_are_read_as_one(spark):
    rows = [(1, "a b c d e"), (1, "a b c d e"), (1, "another text of this id"), (None, "a b c d"), (None, "a b c d"), (0, "a b c d"), (2, None), (2, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    classes = stored(docs.distinct().select(F.monotonically_increasing_id().alias("id"), "doc_id", F.xxhash64("text").alias("text_hash")), "classes")
    got = jaccard_product._with_texts(docs, classes).join(classes, "id").select("doc_id", "text")
    assert sorted(map(tuple, got.collect()), key=str) == sorted(set(rows), key=str)
    made = jaccard_product.incidence(docs, classes, 4)
    assert made.count() == len(set(rows))
    assert made._jdf.queryExecution().executedPlan().toString().count("Exchange") == 2  # none but the join's
