"""Best-fit packing by length patterns: fit pattern counts to the length histogram, round, pack the rest best-fit.

1. Spark tokenizes every document once and stores one small row per piece (id, piece number, start, length, CRC).
2. The histogram of lengths has at most ``capacity`` rows whatever the input; it is all that the driver sees.
   ``pack_plan`` enumerates patterns of up to four lengths that fill a sequence, fits non-negative repeat counts to
   the histogram by least squares, rounds them with error diffusion, and packs what is left best-fit, longest first,
   run by run of equal lengths. The plan is a list of slots ("ranks lo..hi of length l go to sequences base.."); its
   size follows the number of different lengths, not the number of documents.
3. Spark numbers the pieces of each length (salted, so that a length shared by a third of all pieces is split) and
   looks every piece up in the plan.

Cases: a null or empty text has only the end id and packs as a piece of length 1; equal lengths are numbered by
salt, document and piece, so repeated rows get slots of their own; an empty table gives no rows; other columns of
the input are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import map_arrow, stored
from .tokens import VOCABULARY, crc, encoder

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
PACKED = f"{PIECES}, sequence_id long, offset long"


def pieces(docs: DataFrame, capacity: int, end_id: int, vocabulary: str = VOCABULARY) -> DataFrame:
    """Tokenize whole texts and cut only those of more than ``capacity`` ids; one row per piece."""

    def cut(batches):
        for batch in batches:
            ids_of = batch.column(0)
            for first, ids, offsets in encoder(vocabulary).documents(batch.column(1), end_id):
                rows = []
                for i in range(len(offsets) - 1):
                    n = int(offsets[i + 1] - offsets[i])
                    for piece, at in enumerate(range(0, n, capacity)):
                        part = ids[offsets[i] + at : offsets[i] + min(n, at + capacity)]
                        rows.append((first + i, piece, at, len(part), crc(part)))
                which, piece, start, length, crcs = zip(*rows)
                yield pa.RecordBatch.from_arrays(
                    [ids_of.take(pa.array(which)), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                     pa.array(length, pa.int64()), pa.array(crcs, pa.int64())],
                    ["doc_id", "piece", "start", "length", "ids_crc32"])

    return map_arrow(docs.select(F.col("doc_id").cast("long"), "text"), cut, PIECES)


def enumerate_patterns(counts: np.ndarray, capacity: int, grid: int = 24) -> np.ndarray:
    """Patterns of up to four lengths, longest first, as rows padded with 0; each fills all but 1% of ``capacity``.

    The last length of a pattern is the longest present one that still fits, the middle ones are token-mass
    quantiles of the histogram.
    """
    present = np.flatnonzero(counts)
    present = present[present > 0]
    below = np.zeros(capacity + 1, np.int64)
    below[present] = present
    below = np.maximum.accumulate(below)
    mass = np.cumsum(counts[present] * present)
    quantiles = lambda n: np.unique(present[np.searchsorted(mass, (np.arange(n) + 0.5) / n * mass[-1])])
    rows = [np.stack([present, below[capacity - present]], 1)]
    middle = quantiles(grid)
    a, b = (x.ravel() for x in np.meshgrid(present, middle, indexing="ij"))
    keep = (a >= b) & (a + b < capacity)
    rows.append(np.stack([a[keep], b[keep], below[capacity - a[keep] - b[keep]]], 1))
    few = quantiles(max(2, grid // 4))
    a, b, c = (x.ravel() for x in np.meshgrid(present, few, few, indexing="ij"))
    keep = (a >= b) & (b >= c) & (a + b + c < capacity)
    rows.append(np.stack([a[keep], b[keep], c[keep], below[capacity - a[keep] - b[keep] - c[keep]]], 1))
    out = np.concatenate([np.pad(r, ((0, 0), (0, 4 - r.shape[1]))) for r in rows])
    out = -np.sort(-out, axis=1)
    return np.unique(out[out.sum(1) >= capacity * 0.99], axis=0)[::-1]


def fit_counts(patterns: np.ndarray, counts: np.ndarray, rounds: int = 200) -> np.ndarray:
    """Non-negative least squares of pattern counts against the histogram, long lengths weighing more.

    Multiplicative updates keep every count non-negative and need no matrix, only sums by length.
    """
    size = len(counts)
    weight = np.arange(size, dtype=float) / size
    weight[0] = 0
    back = lambda y: (weight * y)[patterns].sum(1)  # noqa: E731  weight[0] is 0, so padding adds nothing
    aim = back(counts.astype(float))
    x = np.full(len(patterns), counts.sum() / max(1, len(patterns)) / 3)
    for _ in range(rounds):
        made = sum(np.bincount(patterns[:, k], weights=x, minlength=size) for k in range(patterns.shape[1]))
        x *= aim / np.maximum(back(made), 1e-12)
    return x


class _Bins:
    """Runs of sequences with equal contents, by free space."""

    def __init__(self, capacity: int) -> None:
        self.by_gap: list[list[tuple[tuple, int]]] = [[] for _ in range(capacity + 1)]
        self.open = np.zeros(capacity + 1, bool)

    def put(self, gap: int, slots: tuple, bins: int) -> None:
        if bins:
            self.by_gap[gap].append((slots, bins))
            self.open[gap] = True

    def best(self, length: int) -> int:
        """The smallest free space of at least ``length``, or -1."""
        at = int(np.argmax(self.open[length:])) + length
        return at if at < len(self.open) and self.open[at] else -1

    def take(self, gap: int) -> tuple[tuple, int]:
        run = self.by_gap[gap].pop()
        self.open[gap] = bool(self.by_gap[gap])
        return run


def _shifted(slots: tuple, bins: int) -> tuple:
    return tuple((length, lo + bins * copies, copies) for length, lo, copies in slots)


def pack_plan(histogram: dict[int, int], capacity: int) -> dict[str, np.ndarray]:
    """Slots (length, lo, hi, copies, base, offset): ranks lo..hi of a length, ``copies`` to a sequence from ``base``.

    With few documents rounding costs more than patterns gain, so the fit is rounded in full, by half and not at all,
    and the plan with the fewest sequences is taken.
    """
    counts = np.zeros(capacity + 1, np.int64)
    for length, n in histogram.items():
        counts[length] = n
    patterns = enumerate_patterns(counts, capacity) if counts.any() else np.zeros((0, 4), np.int64)
    fitted = fit_counts(patterns, counts) if len(patterns) else np.zeros(0)
    plans = [_rounded_plan(counts, patterns, fitted * share) for share in (1.0, 0.5, 0.0)]
    return min(plans, key=lambda plan: int(plan["sequences"][0]))


def _rounded_plan(counts: np.ndarray, patterns: np.ndarray, fitted: np.ndarray) -> dict[str, np.ndarray]:
    capacity = len(counts) - 1
    bins, left, rank = _Bins(capacity), counts.copy(), np.zeros(capacity + 1, np.int64)
    carry, longest = 0.0, -1
    for pattern, x in zip(patterns.tolist(), fitted.tolist()) if fitted.any() else ():
        if pattern[0] != longest:
            carry, longest = 0.0, pattern[0]
        lengths = [n for n in pattern if n]
        want = int(carry + x + 0.5)
        fits = min(want, *(int(left[n]) // lengths.count(n) for n in lengths))
        carry += x - fits if fits == want else 0.0
        if fits:
            slots = []
            for n in dict.fromkeys(lengths):
                copies = lengths.count(n)
                slots.append((n, int(rank[n]), copies))
                rank[n] += fits * copies
                left[n] -= fits * copies
            bins.put(capacity - sum(lengths), tuple(slots), fits)

    for length in np.flatnonzero(left)[::-1].tolist():
        n = int(left[length])
        while n:
            gap = bins.best(length)
            slots, run = bins.take(gap) if gap >= 0 else ((), n)
            gap = gap if gap >= 0 else capacity
            copies = gap // length
            full = min(run, n // copies)
            if not full:  # fewer left than one sequence could hold
                copies, full = n, 1
            bins.put(gap - copies * length, (*slots, (length, int(rank[length]), copies)), full)
            if slots:
                bins.put(gap, _shifted(slots, full), run - full)
            rank[length] += full * copies
            n -= full * copies

    rows, base = [], 0
    for runs in bins.by_gap:
        for slots, run in runs:
            offset = 0
            for length, lo, copies in slots:
                rows.append((length, lo, lo + run * copies, copies, base, offset))
                offset += length * copies
            base += run
    rows.sort()
    names = ("length", "lo", "hi", "copies", "base", "offset")
    return {k: np.array([r[i] for r in rows], np.int64) for i, k in enumerate(names)} | {"sequences": np.array([base])}


def place(plan: dict[str, np.ndarray], length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sequence and offset of the rank-th piece of each length."""
    first = np.searchsorted(plan["length"], length)
    key = lambda a, b: (a << 40) + b  # noqa: E731  up to 2**40 pieces of one length
    at = np.searchsorted(key(plan["length"], plan["lo"]), key(length, rank), side="right") - 1
    at = np.maximum(at, first)
    inside = rank - plan["lo"][at]
    return plan["base"][at] + inside // plan["copies"][at], plan["offset"][at] + inside % plan["copies"][at] * length


def pack(docs: DataFrame, capacity: int = 4096, end_id: int = 1, vocabulary: str = VOCABULARY) -> DataFrame:
    """One row per piece of every document: its ids' place in the text and its place in a sequence of ``capacity``."""
    cut = stored(pieces(docs, capacity, end_id, vocabulary), "pieces")
    histogram = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count("*").alias("n")).collect()}
    plan = pack_plan(histogram, capacity)

    salts = max(1, int(sum(histogram.values()) ** 0.5))
    salted = cut.withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(salts)))
    before = salted.groupBy("length", "salt").agg(F.count("*").alias("n")).select(
        "length", "salt",
        (F.sum("n").over(Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, 0)) - F.col("n")).alias("before"))
    own = F.row_number().over(Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "ids_crc32"))
    ranked = salted.withColumn("own", own).join(before, ["length", "salt"]).select(
        "doc_id", "piece", "start", "length", "ids_crc32", (F.col("before") + F.col("own") - 1).alias("rank"))

    def look_up(batches):
        for batch in batches:
            length, rank = (batch.column(k).to_numpy(zero_copy_only=False) for k in (3, 5))
            sequence, offset = place(plan, length, rank)
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(sequence, pa.int64()), pa.array(offset, pa.int64())],
                                             ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    return map_arrow(ranked, look_up, PACKED)
