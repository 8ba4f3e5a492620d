"""Bytes in removed windows, by one count over all windows of a slice."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from tidemark.llm import column_dedup


def test_bytes_in_windows(monkeypatch):
    random, n = np.random.default_rng(3), 700
    base = random.integers(column_dedup.SPAN, n - column_dedup.LENGTH, 9)
    lefts = [random.choice(column_dedup.SPAN, k, replace=False) for k in (0, 1, 2, 3, 1, 0, 4, 1, 33)]
    mask = np.array([sum(1 << int(x) for x in some) for some in lefts], np.uint64)
    want = np.zeros(n, bool)
    for at, some in zip(base, lefts):
        for left in some:
            want[at - left : at - left + column_dedup.LENGTH] = True
    counts = []
    monkeypatch.setattr(column_dedup.np, "bincount", lambda *a, count=np.bincount, **b: counts.append(1) or count(*a, **b))
    assert (column_dedup.in_windows(base, mask, n) == want).all()
    assert len(counts) == 2  # not two for each of the 33 distances
    none = np.zeros(0, np.int64)
    assert not column_dedup.in_windows(none, none.view(np.uint64), 5).any() and not len(column_dedup.in_windows(none, none.view(np.uint64), 0))


def test_anchors_do_not_depend_on_the_slice():
    random = np.random.default_rng(4)
    column = pa.array(["".join(random.choice(list("ab é"), size)) for size in (0, 49, 50, 51, 400, 90, 3000, 7)], pa.large_string())
    whole = column_dedup.anchors(column)
    parts = [(i, column_dedup.anchors(column[i : i + 1])) for i in range(len(column))]
    for k in range(5):
        assert np.concatenate([x[k] + i if k == 0 else x[k] for i, x in parts]).tolist() == whole[k].tolist()
