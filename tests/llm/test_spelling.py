"""Spelling variants against plain Python, and the query's whole rows."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tests.llm import brute
from tidemark.llm import queries, spelling


def plain_counts(rows, least_length: int, least_count: int, damage: int | None) -> dict[str, int]:
    counts: Counter = Counter()
    for doc_id, text in rows:
        for word in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = word.translate(brute.LOWER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{word}".encode())
            if damage and h % damage == 0:
                word = word[: h % len(word)] + word[h % len(word) + 1 :]
            counts[word] += 1
    return {w: n for w, n in counts.items() if len(w) >= least_length and n >= least_count}


def plain_variants(counts: dict[str, int], ratio: int) -> set[tuple]:
    letters = {x for w in counts for x in w}
    form, near = {}, {}
    for w, n in counts.items():
        found = {w[:i] + w[i + 1 :] for i in range(len(w))} | {w[:i] + x + w[i + k :] for k in (0, 1) for i in range(len(w) + 1 - k) for x in letters}
        near[w] = [v for v in found - {w} if v in counts]
        best = min(near[w], key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best and counts[best] >= ratio * n else None
    out = set()
    for w, n in counts.items():
        root = w
        while form[root]:
            root = form[root]
        out.add((w, form[w], root, n, len(near[w]), counts.get(form[w])))
    return out


def rows_of(df):
    return sorted(map(tuple, df.select("word", "form", "root", "n", "n_near", "form_n").collect()), key=str)


@pytest.mark.parametrize("letters, least_length, least_count, ratio", [("aabX", 3, 1, 3), ("aabbcàÿé×X", 2, 2, 2), ("àÀaA", 1, 1, 2)])
def test_variants(spark, letters, least_length, least_count, ratio):
    rng = random.Random(letters)
    text = lambda: "".join(rng.choice([*letters] * 6 + [" ", "1"]) for _ in range(rng.choice([0, 300, 2000])))
    rows = [(rng.choice([None, 5, 17]) if d < 3 else d, None if d == 4 else text()) for d in range(25)]
    rows += [(7, "a" * 700 + " " + "a" * 699), (8, "ab" * 100), (8, "ab" * 100)]
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, n int, word string").repartition(3)
    counts = spelling.word_counts(docs, least_length, least_count, damage=7)
    want = plain_counts(rows, least_length, least_count, 7)
    assert {r.word: r.n for r in counts.collect()} == want
    assert rows_of(spelling.variants(counts, ratio)) == sorted(plain_variants(want, ratio), key=str)


def test_trie_nodes_are_numbered_alike_over_many_partitions(spark):
    rng = random.Random(5)
    paths = sorted({"".join(rng.choice("abé") for _ in range(rng.randint(1, 9))) for _ in range(400)} | {"a" * 300})
    df = spark.createDataFrame([(p, k) for k, p in enumerate(paths)], "path string, id long")
    rows = spelling.numbered(df, "test").collect()
    of = {}
    for r in rows:
        for k, node in enumerate(r.nodes):
            assert of.setdefault(r.path[:k], node) == node
    assert len(set(of.values())) == len(of) and len(rows) == len(paths)
    assert [r.path for r in sorted(rows, key=lambda r: r.place)] == sorted(paths, key=lambda p: p.encode())


def test_query_rows(spark, tmp_path):
    rng = random.Random(2)
    common = ["because", "Weather", "straße", "ÉCOLES", "running"]
    rows = []
    for k in range(120):
        words = [rng.choice(common) for _ in range(60)]
        if k % 2:
            words += ["becuase", "weathers", "wether", "runnig"]
        rows.append((k, ", ".join(words)))
    rows += [(None, None), (3, "")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    found = queries.op12_spelling_variants(spark, str(tmp_path))
    assert found.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    want = plain_variants(plain_counts(rows, 6, 5, 199), 5)
    assert rows_of(found) == sorted(want, key=str) and any(w[1] for w in want)


def test_no_rows(spark):
    docs = spark.createDataFrame([], brute.DOCS)
    assert spelling.variants(spelling.word_counts(docs)).count() == 0
    assert spelling.variants(spelling.word_counts(spark.createDataFrame([(1, " 12 ")], "doc_id long, text string").where(F.col("doc_id") > 0))).count() == 0
