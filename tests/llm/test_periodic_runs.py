"""Periodic runs against a plain search of every period, whole query digests included."""

from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import pytest

from tests.llm import brute
from tidemark.llm import periodic_runs, queries


def plain_runs(s: list, least: int) -> list[tuple]:
    """(start, length, period) by start, then period."""
    n, out = len(s), []
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and s[j] == s[j + q]:
                j += 1
            length = j + q - i
            if j > i and length >= max(least, 2 * q) and not any(s[i : i + length - r] == s[i + r : i + length] for r in range(1, q)):
                out.append((i, length, q))
            i = max(j, i) + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def planted(doc_id: int | None, text: str | None) -> list[str]:
    words = brute.WORD.findall(text or "")
    n = len(words)
    h = None if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    return words


def plain_row(doc_id, text) -> tuple:
    words = planted(doc_id, text)
    found = plain_runs(words, 12)
    gone = {i for b, length, q in found for i in range(b + q, b + length)}
    best = min(found, key=lambda r: (-r[1], r[0], r[2]), default=None)
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    head = (best[0], best[1], best[2], 1000 * best[1] // best[2]) if best else (None,) * 4
    return (doc_id, len(found), *head, sha("".join(f"{b},{n},{q}\n" for b, n, q in found)), sha(" ".join(w for i, w in enumerate(words) if i not in gone)))


@pytest.mark.parametrize("seed", range(4))
def test_runs_of_random_strings(seed):
    rng = random.Random(seed)
    for _ in range(60):
        letters, least, texts = rng.choice([1, 2, 3, 30]), rng.choice([2, 5, 12]), []
        for _ in range(rng.randint(1, 6)):
            s = [rng.randrange(letters) for _ in range(rng.choice([0, 1, 12, 70]))]
            if s and rng.random() < 0.6:
                a = rng.randrange(len(s))
                p = 1 + rng.randrange(max(1, (len(s) - a) // 2 + 1))
                s = [s[i] if i < a else s[a + (i - a) % p] for i in range(len(s))]
            texts.append(s)
        offsets = np.cumsum([0, *map(len, texts)])
        found = periodic_runs.runs(np.array([x for s in texts for x in s], np.int64), offsets, least)
        assert [tuple(r) for r in found.tolist()] == [(k, *r) for k, s in enumerate(texts) for r in plain_runs(s, least)]


def test_grid_in_parts_is_the_whole_grid(monkeypatch):
    whole = [np.concatenate(c) for c in zip(*periodic_runs.grid(200, 12))]
    monkeypatch.setattr(periodic_runs, "PAIRS", 50)
    parts = [np.concatenate(c) for c in zip(*periodic_runs.grid(200, 12))]
    assert all((a == b).all() for a, b in zip(whole, parts)) and list(periodic_runs.grid(1, 12)) == []


def test_query_rows(spark, tmp_path):
    rows = [r[:2] for r in brute.awkward(3)]
    rows += [(1000 + k, "so it goes on and on " * 9 + "é À z " * (k % 5)) for k in range(40)] + [(None, "a b " * 10), (5000, "x " * 3000), (-7, "q r s " * 30)]
    spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id long, text string, runs int, n int").write.parquet(f"{tmp_path}/documents.parquet")
    found = queries.op11_periodic_runs(spark, str(tmp_path))
    assert found.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    want = [plain_row(*r) for r in rows]
    assert sorted(map(tuple, found.collect()), key=str) == sorted(want, key=str)
    assert sum(1 for r in want if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 10 == 0 and r[1]) > 2


def test_no_rows(spark):
    docs = spark.createDataFrame([], brute.DOCS)
    assert periodic_runs.digests(periodic_runs.find_runs(periodic_runs.with_planted_runs(docs))).count() == 0
