"""Periodic runs of words (tandem repeats) of whole texts, found by recompression.

A run is a stretch of consecutive words with smallest period q (words q apart are identical), of at least
``max(least, 2 * q)`` words, that no neighbouring word extends keeping the period.

1. The words of a block of texts become numbers, one string with a separator of its own between any two texts.
2. Recompression: maximal blocks of one symbol become a symbol, then neighbours of a left and a right class become a
   symbol, in turn, until every text is one symbol (``grammar``). Equal stretches are parsed equally but for their ends.
3. Every run of period q contains two equal words q apart on a grid: of step q, or wider where ``least`` makes the run
   longer than two periods. Grid pairs of equal words (``grid``; harmonic, n log n in all) are extended to both sides by
   longest common extensions read off the grammar (``extend``): whole symbols are compared on the way up, then the first
   unequal symbol is opened level by level. Extensions are exact; the same stretch found with a multiple of its period
   keeps the smallest.

Memory is some hundred bytes for each word of the longest text (or of ``SLICE_BYTES`` of shorter ones); no rows move
between tasks.

Cases: a null or empty text, or one of white space only, has no words, no runs and the collapsed text ``""``; repeated
rows and null ids are judged row by row; columns other than doc_id and text are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_arrow, mix64, slices, texts
from .words import words

WORD = r"([^\x20\x09-\x0D]+)"
#: Grid pairs looked at together.
PAIRS = 1 << 21


@dataclass
class Level:
    """One string of the grammar and how its symbols are joined into the next one's."""

    symbols: np.ndarray
    parent: np.ndarray  # place in the next string
    first: np.ndarray  # of each symbol of the next string: place of its first part here
    size: np.ndarray  # and its number of parts
    blocks: bool  # parts are one symbol repeated, otherwise a pair


def _joined(symbols: np.ndarray, first: np.ndarray, blocks: bool, name: int) -> tuple[Level, np.ndarray, int]:
    """The level whose symbols are joined from each place of ``first`` to before the next, and the new string."""
    size = np.diff(np.append(first, len(symbols)))
    new = symbols[first].copy()
    many = np.flatnonzero(size > 1)
    if len(many):
        other = size[many] if blocks else symbols[first[many] + 1]
        keys, number = np.unique(new[many] * (int(other.max()) + 1) + other, return_inverse=True)
        new[many] = name + number
        name += len(keys)
    parent = np.repeat(np.arange(len(first)), size)
    return Level(symbols, parent, first, size, blocks), new, name


def grammar(symbols: np.ndarray) -> list[Level]:
    """The levels of a string in which negative symbols are separators, each used once; the last one joins nothing."""
    levels, name, rounds = [], int(symbols.max(initial=0)) + 1, 0
    while (open_ := (symbols[1:] >= 0) & (symbols[:-1] >= 0)).any():
        if (symbols[1:] == symbols[:-1]).any():
            first = np.flatnonzero(np.concatenate([[True], symbols[1:] != symbols[:-1]]))
            level, symbols, name = _joined(symbols, first, True, name)
            levels.append(level)
            open_ = (symbols[1:] >= 0) & (symbols[:-1] >= 0)
        rounds += 1
        side = (mix64(symbols.astype(np.uint64) + np.uint64(rounds << 40)) & np.uint64(1)).astype(bool)
        pairs = max(open_ & side[:-1] & ~side[1:], open_ & ~side[:-1] & side[1:], key=np.count_nonzero)
        if pairs.any():
            first = np.flatnonzero(~np.concatenate([[False], pairs]))
            level, symbols, name = _joined(symbols, first, False, name)
            levels.append(level)
    none = np.zeros(0, np.int64)
    return [*levels, Level(symbols, none, none, none, True)]


def extend(levels: list[Level], x: np.ndarray, y: np.ndarray, step: int) -> np.ndarray:
    """For pairs of unequal places of the first string: the place, from x on in direction ``step`` (1 or -1), of the first
    symbol that differs from its partner."""
    index, apart = np.arange(len(x)), []
    for level in levels:
        same = level.symbols[x] == level.symbols[y]
        out = [(index[~same], x[~same], y[~same])]
        apart.append(out)
        index, x, y = index[same], x[same], y[same]
        if not len(index):
            break
        px, py = level.parent[x], level.parent[y]
        left_x, left_y = x - level.first[px], y - level.first[py]  # parts before the place
        if step > 0:
            left_x, left_y = level.size[px] - left_x, level.size[py] - left_y
            whole = (left_x == level.size[px]) & (left_y == level.size[py])
        else:
            left_x, left_y = left_x + 1, left_y + 1
            whole = (left_x == level.size[px]) & (left_y == level.size[py])
        go = whole | (left_x == left_y)
        on = np.where(whole, 0, step)
        less = np.minimum(left_x, left_y)[~go] * step
        out.append((index[~go], x[~go] + less, y[~go] + less))
        index, x, y = index[go], (px + on)[go], (py + on)[go]
    found = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    for h in range(len(apart) - 1, -1, -1):
        index, x, y = (np.concatenate(c) for c in zip(found, *apart[h]))
        if h:
            level = levels[h - 1]
            nx, ny = level.first[x], level.first[y]
            if step < 0:
                nx, ny = nx + level.size[x] - 1, ny + level.size[y] - 1
            same = level.symbols[nx] == level.symbols[ny]
            parts = np.minimum(level.size[x], level.size[y]) if level.blocks else 1
            on = np.where(same, parts, 0) * step
            x, y = nx + on, ny + on
        found = index, x, y
    place = np.empty(len(found[0]), np.int64)
    place[found[0]] = found[1]
    return place


def grid(n: int, least: int):
    """(place, period) arrays of the grid pairs of a text of n words, of about ``PAIRS`` at a time."""
    periods = np.arange(1, n // 2 + 1)
    steps = np.maximum(periods, least - periods)
    counts = -(-(n - periods) // steps)
    ends = np.cumsum(counts)
    for low in range(0, int(ends[-1]) if len(ends) else 0, PAIRS):
        part = slice(*np.searchsorted(ends, [low, low + PAIRS], side="right"))
        if n_pairs := int(counts[part].sum()):
            number = np.arange(n_pairs) - np.repeat(np.cumsum(counts[part]) - counts[part], counts[part])
            yield number * np.repeat(steps[part], counts[part]), np.repeat(periods[part], counts[part])


def runs(codes: np.ndarray, offsets: np.ndarray, least: int) -> np.ndarray:
    """(text, start, length, period) rows of all runs of the texts of a block, by text, start and period."""
    n_texts = len(offsets) - 1
    at = offsets[:-1] + np.arange(1, n_texts + 1)  # of each text's first word in the string
    string = np.full(len(codes) + n_texts + 1, -1, np.int64)
    place = np.arange(len(codes)) + np.repeat(np.arange(1, n_texts + 1), np.diff(offsets))
    string[place] = codes
    gaps = np.flatnonzero(string < 0)
    string[gaps] = -1 - np.arange(len(gaps))
    xs, qs, held, parts = [], [], 0, []

    def judge() -> None:
        nonlocal xs, qs, held
        if held:
            x, q = np.concatenate(xs), np.concatenate(qs)
            end = extend(levels, x, x + q, 1) + q
            start = extend(levels, x, x + q, -1) + 1
            long = end - start >= np.maximum(least, 2 * q)
            parts.append(np.unique(np.stack([start[long], end[long], q[long]], 1), axis=0))
        xs, qs, held = [], [], 0

    levels = None
    for i in np.flatnonzero(np.diff(offsets) >= max(least, 2)):
        for x, q in grid(int(offsets[i + 1] - offsets[i]), least):
            x += at[i]
            equal = string[x] == string[x + q]
            if equal.any():
                levels = levels or grammar(string)
                xs.append(x[equal])
                qs.append(q[equal])
                held += len(xs[-1])
                if held > PAIRS:
                    judge()
    judge()
    found = np.unique(np.concatenate(parts), axis=0) if parts else np.zeros((0, 3), np.int64)
    if not len(found):
        return np.zeros((0, 4), np.int64)
    start, end, period = found.T
    new = np.concatenate([[True], (start[1:] != start[:-1]) | (end[1:] != end[:-1])])  # the smallest period comes first
    start, end, period = start[new], end[new], period[new]
    text = np.searchsorted(at, start, side="right") - 1
    order = np.lexsort((period, start))
    return np.stack([text, start - at[text], end - start, period], 1)[order]


SCHEMA = "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"


def _collapsed(values: list[bytes], found: np.ndarray) -> bytes:
    """The words of one text outside every run's words after its first period."""
    gone = np.zeros(len(values) + 1, np.int64)
    np.add.at(gone, found[:, 1] + found[:, 3], 1)
    np.add.at(gone, found[:, 1] + found[:, 2], -1)
    kept = np.flatnonzero(np.cumsum(gone[:-1]) == 0)
    return b" ".join([values[k] for k in kept])


def find_runs(docs: DataFrame, least: int = 12) -> DataFrame:
    """doc_id, n_words, runs (by start, then period), collapsed (the text without repeats) of every row."""

    def judge(batches):
        for batch in batches:
            column = texts(batch.column(1))
            for a, b in slices(column):
                values, offsets = words(column[a:b])
                codes = values.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
                found = runs(codes, offsets, least)
                ends = np.searchsorted(found[:, 0], np.arange(b - a + 1))
                plain = values.to_pylist()
                collapsed = [_collapsed(plain[offsets[i] : offsets[i + 1]], found[ends[i] : ends[i + 1]]) if ends[i] < ends[i + 1]
                             else b" ".join(plain[offsets[i] : offsets[i + 1]]) for i in range(b - a)]
                fields = pa.StructArray.from_arrays([pa.array(found[:, k]) for k in (1, 2, 3)], ["start", "length", "period"])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.array(np.diff(offsets), pa.int64()), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), fields),
                     pa.array(collapsed, pa.binary()).cast(pa.string())], ["doc_id", "n_words", "runs", "collapsed"])

    return map_arrow(docs.select(F.col("doc_id").cast("long"), "text"), judge, SCHEMA)


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """doc_id and text; in about a tenth of the documents, told by a checksum of the id, the words from some place on repeat.

    With h the unsigned crc32 of the decimal id and g = floor(h / 10), texts of n > 0 words with h % 10 = 0 have, from
    word a = g % n on, the period 1 + floor((n - a) / (3 + g % 8)), their words joined by one space. A null id plants nothing.
    """
    h = F.crc32(F.col("doc_id").cast("long").cast("string").cast("binary"))
    held = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", h.alias("h"), F.floor(h / 10).cast("long").alias("g"))
    parts = F.when(F.col("h") % 10 == 0, F.regexp_extract_all("text", F.lit(WORD), F.lit(1)))
    held = held.withColumn("words", parts).withColumn("n", F.nullif(F.size("words").cast("long"), F.lit(0)))
    held = held.withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")))
    held = held.withColumn("p", 1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8)).cast("long"))
    again = F.transform(F.sequence(F.col("a"), F.col("n") - 1), lambda i: F.get("words", (F.col("a") + (i - F.col("a")) % F.col("p")).cast("int")))
    planted = F.array_join(F.concat(F.slice("words", F.lit(1), F.col("a").cast("int")), again), " ")
    return held.select("doc_id", F.when(F.col("a").isNotNull(), planted).otherwise(F.col("text")).alias("text"))


def digests(found: DataFrame) -> DataFrame:
    """doc_id, n_runs; start, length, period, exponent_milli of the longest run (the first, then of the smallest period); hashes
    of all runs and of the collapsed text."""
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r.length.alias("length"), (-r.start).alias("start"), (-r.period).alias("period"))))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r.start, r.length, r.period), F.lit("\n"))), "")
    held = found.withColumn("longest", longest)
    return held.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("longest.start")).alias("start"), F.col("longest.length").alias("length"),
        (-F.col("longest.period")).alias("period"), F.expr("(1000 * longest.length) div (-longest.period)").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
