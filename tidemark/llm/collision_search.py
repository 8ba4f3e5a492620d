"""Approximate nearest neighbours by collision counting over single projections.

Index of a cell: ``PROJECTIONS`` random directions, and for each one the vectors' (normalised) projections in sorted
order. A query starts with a narrow window around its own projection in each sorted array and widens all windows by a
factor, round by round (virtual rehashing); every vector that newly enters a window collides once more, and one that
has collided ``THRESHOLD`` times is verified with its exact cosine. A query stops when its ``k`` best verified vectors
lie within the distance that the window of the round stands for, or when the windows hold everything; no share of the
cell ends it before.

Cases: vectors null, all zero, or with null or non-finite components take no part; with fewer candidates than ``k``
all are found; equal cosines go by vec_id, nulls last; repeated rows are candidates of each other; a null vec_id is no
query; shorter vectors count as filled with 0; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame

from .vectors import search, usable

PROJECTIONS, THRESHOLD = 64, 38
#: Half width of the first window, its growth per round (a last round takes all), and the half width that stands for distance 1:
#: a vector at that distance is then within 73% of the windows, 46.6 of 64 on average, and misses THRESHOLD about once in 100.
FIRST, GROWTH, ROUNDS, UNIT = 0.25, 1.3, 10, 1.1
SEED = 20
QUERIES_AT_ONCE = 256


def unit_rows(x: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1; a power of two first keeps squares in range."""
    x = np.ldexp(x, -np.frexp(np.abs(x).max(1, initial=0))[1][:, None])
    return x / np.sqrt((x * x).sum(1, keepdims=True))


class CollisionIndex:
    def __init__(self, x: np.ndarray) -> None:
        self.x = unit_rows(x)
        self.directions = np.random.default_rng(SEED).standard_normal((x.shape[1], PROJECTIONS))
        projected = self.x @ self.directions
        order = np.argsort(projected, axis=0, kind="stable").T
        self.sorted = np.take_along_axis(projected.T, order, 1)
        self.order = np.ascontiguousarray(order).ravel()
        self.base = np.arange(PROJECTIONS) * len(x)

    def _between(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Members of the sorted arrays' ranges low..high, one range per projection."""
        size = high - low
        return self.order[np.repeat(self.base + low - (np.cumsum(size) - size), size) + np.arange(size.sum())]

    def windows(self, queries: np.ndarray, half: float) -> tuple[np.ndarray, np.ndarray]:
        """Every query's window in every sorted array: first place and place after the last."""
        at = queries @ self.directions
        return tuple(np.stack([np.searchsorted(row, at[:, j] + shift, side) for j, row in enumerate(self.sorted)], 1)
                     for shift, side in ((-half, "left"), (half, "right")))

    def nearest(self, queries: np.ndarray, k: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Places and cosines of the verified vectors that may be among the ``k`` + 1 nearest of each query."""
        n, halves = len(self.x), [FIRST * GROWTH**r for r in range(ROUNDS)] + [np.inf]
        for start in range(0, len(queries), QUERIES_AT_ONCE):
            part = queries[start : start + QUERIES_AT_ONCE]
            rounds = [self.windows(part, half) for half in halves]
            for i, query in enumerate(part):
                counts, verified, scores = np.zeros(n, np.int64), np.zeros(n, bool), np.full(n, -np.inf)
                low = high = rounds[0][0][i]
                for half, (left, right) in zip(halves, rounds):
                    counts += np.bincount(self._between(left[i], low), minlength=n) + np.bincount(self._between(high, right[i]), minlength=n)
                    low, high = left[i], right[i]
                    new = np.flatnonzero((counts >= THRESHOLD) & ~verified)
                    verified[new] = True
                    scores[new] = self.x[new] @ query
                    enough = np.count_nonzero(verified)
                    if enough > k and 2 - 2 * np.partition(scores, -k - 1)[-k - 1] <= (half / UNIT) ** 2:
                        break
                best = np.flatnonzero(verified)
                if len(best) > k + 1:
                    best = best[scores[best] >= np.partition(scores[best], -k - 1)[-k - 1]]
                yield best, scores[best]


def _cell(data: np.ndarray, queries: np.ndarray, k: int = 5) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    yield from CollisionIndex(data).nearest(unit_rows(queries), k)


def nearest(vectors: DataFrame) -> DataFrame:
    """query_id, rank, vec_id, score (cosine): up to 5 near vectors of every query."""
    return search(usable(vectors, zero=False), _cell, "double")
