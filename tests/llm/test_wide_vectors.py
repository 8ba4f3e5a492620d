"""Recall of the collision search on wide, evenly spread vectors."""

from __future__ import annotations

import numpy as np
import pytest

from tidemark.llm import collision_search


def recall(n: int, width: int, queries: int = 20, k: int = 5) -> float:
    x = collision_search.unit_rows(np.random.default_rng(width).standard_normal((n, width)))
    hits = 0
    for i, (places, scores) in enumerate(collision_search.CollisionIndex(x).nearest(x[:queries], k)):
        found = set(places[np.argsort(-scores, kind="stable")[: k + 1]].tolist())
        hits += len(found & set(np.argsort(-(x @ x[i]), kind="stable")[: k + 1].tolist()) - {i})
    return hits / (queries * k)


@pytest.mark.parametrize("width", [64, 384, 768])
def test_recall(width):
    assert recall(4000, width) >= 0.9
