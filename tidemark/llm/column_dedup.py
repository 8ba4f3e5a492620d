"""Removal of repeated passages by column-wise construction of the sorted suffixes of many short documents.

A byte goes if it lies in a string of ``LENGTH`` bytes that also starts in a document with a smaller doc_id. Building one
Burrows-Wheeler transform over whole texts column by column would take as many rounds as the longest text has bytes, and
each round would pass over all files. Three steps make the collection short and many-sided first:

1. Anchors. The smallest (by hash) ``KMER``-byte string of a window of ``LENGTH`` bytes is its anchor; equal windows have
   equal anchors at equal places. Only anchors that two different texts share can matter; Spark finds them by counting,
   with partial sums and skew-split joins.
2. Fragments. Around every shared anchor a document's fragment holds just the windows anchored there. Fragments are the
   documents of the collection; those of one anchor go to one task, as a file sorted by anchor.
3. Columns (``equal_windows``). Fragments are aligned at their anchors. Each round inserts one symbol per fragment, from the
   right end leftwards: the symbols that precede the sorted suffixes - this round's column of the collection's BWT - are
   stably sorted, which gives the next order, and the common prefixes follow as 1 + the least common prefix between two
   neighbours' old places. When ``LENGTH`` symbols are common, neighbours hold the same window, and the smallest doc_id
   of such a run decides. 65 rounds do for texts of any length, because windows of different columns are never equal.

An anchor with more than ``GROUP`` holders is split into sub-collections by text; equal windows of different
sub-collections then meet by a 128-bit hash (``_merge_large``). Equal texts are one document of the collection, named by a
64-bit hash of the whole text; of them only the smallest doc_id can keep anything.

Cases: a null text is an empty one; texts shorter than ``LENGTH`` lose nothing; rows that repeat a doc_id do not remove
each other's bytes; a null doc_id counts as larger than all others; an empty table gives no rows; other columns are
ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_arrow, mix64, raw_bytes, release, slices, stored, texts

LENGTH, KMER = 50, 18
#: Windows that share an anchor at most, and so the columns left of it.
SPAN = LENGTH - KMER + 1
GROUP = 1 << 19
#: Fragments sorted together; whole groups only, so a larger group is taken alone.
BATCH = 1 << 17
NO_ID = 2**63 - 1
#: Text looked at together; some twenty arrays of eight bytes for each of its bytes are alive at once, few of which fit a core's cache.
SLICE_BYTES = 1 << 18
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_powers: dict[int, np.ndarray] = {}


def _power(base: np.uint64, n: int) -> np.ndarray:
    """The first n powers modulo 2**64, kept between calls."""
    have = _powers.get(int(base))
    if have is None or len(have) < n:
        have = _powers[int(base)] = np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(max(n, 1 << 20), base, np.uint64))])
    return have[:n]


def anchors(column: pa.Array) -> tuple[np.ndarray, ...]:
    """Row, place in the row's bytes, least and greatest windows' distance to the left, and hash of every anchor."""
    data, offsets = raw_bytes(column)
    empty = np.zeros(0, np.int64)
    if len(data) < LENGTH:
        return empty, empty, empty, empty, np.zeros(0, np.uint64)
    sums = np.concatenate([[np.uint64(0)], np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _power(_BASE, len(data)), dtype=np.uint64)])
    hashes = mix64((sums[KMER:] - sums[:-KMER]) * _power(_INVERSE, len(data) - KMER + 1))
    least = (hashes & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(hashes), dtype=np.uint64)  # ties: the leftmost
    width = 1
    while 2 * width <= SPAN:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    if width < SPAN:
        least = np.minimum(least[: len(least) - (SPAN - width)], least[SPAN - width :])
    row = np.repeat(np.arange(len(column)), np.diff(offsets))[: len(least)]
    start = np.flatnonzero(np.arange(len(least)) + LENGTH <= offsets[1:][row])
    if not len(start):
        return empty, empty, empty, empty, np.zeros(0, np.uint64)
    at = (least[start] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
    last = np.concatenate([first[1:], [len(start)]]) - 1
    place, row = at[first], row[start[first]]
    return row, place - offsets[row], place - start[last], place - start[first], hashes[place]


def _tag(row: np.ndarray, x: np.ndarray) -> np.ndarray:
    """One hash for a row's number and a hash in it."""
    return mix64(x ^ mix64(row.astype(np.uint64) + _BASE))


def _anchor_pairs(docs: DataFrame) -> DataFrame:
    """anchor, t: each document's different anchors."""

    def pairs(batches):
        for batch in batches:
            column, t = texts(batch.column(1)), batch.column(0).to_numpy(zero_copy_only=False)
            for a, b in slices(column, SLICE_BYTES):
                row, *_, h = anchors(column[a:b])
                _, one = np.unique(_tag(row, h), return_index=True)
                yield pa.RecordBatch.from_arrays([pa.array(h[one].view(np.int64)), pa.array(t[a + row[one]])], ["anchor", "t"])

    return map_arrow(docs.select("t", "text"), pairs, "anchor long, t long")


FRAGMENTS = "anchor long, part int, ord long, t long, low int, high int, bytes binary, places array<int>"


def _fragments(wanted: DataFrame, docs: DataFrame) -> DataFrame:
    """A document's different fragments around its wanted anchors, each with all its places."""

    def cut(batches):
        for batch in batches:
            column = texts(batch.column(2))
            ord_, t = (batch.column(k).to_numpy(zero_copy_only=False) for k in (0, 1))
            for a, b in slices(column, SLICE_BYTES):
                part = column[a:b]
                data, offsets = raw_bytes(part)
                row, place, low, high, h = anchors(part)
                lists = batch.column(3).slice(a, b - a)
                ends = lists.offsets.to_numpy().astype(np.int64)
                items = lists.flatten()
                owner = np.repeat(np.arange(b - a), np.diff(ends)).astype(np.uint64)
                keys = _tag(owner, items.field("anchor").to_numpy(zero_copy_only=False).view(np.uint64))
                by = np.argsort(keys, kind="stable")
                mine = _tag(row, h)
                at = np.minimum(np.searchsorted(keys[by], mine), max(0, len(keys) - 1))
                keep = np.flatnonzero(keys[by][at] == mine) if len(keys) else np.zeros(0, np.int64)
                row, place, low, high, h = (x[keep] for x in (row, place, low, high, h))
                group = items.field("part").to_numpy(zero_copy_only=False)[by][at[keep]] if len(keep) else np.zeros(0, np.int32)
                start = offsets[row] + place - high
                size = high - low + LENGTH
                sums = np.concatenate([[np.uint64(0)], np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _power(_BASE, len(data)), dtype=np.uint64)])
                content = mix64((sums[start + size] - sums[start]) * _power(_INVERSE, len(data) + 1)[start])
                same = mix64(content ^ mix64(mine[keep] + (low * 64 + high).astype(np.uint64)))
                order = np.argsort(same, kind="stable")
                head = np.flatnonzero(np.concatenate([[True], same[order][1:] != same[order][:-1]])) if len(order) else np.zeros(0, np.int64)
                one = order[head]
                span = size[one]
                flat = data[np.repeat(start[one] - (np.cumsum(span) - span), span) + np.arange(span.sum())]
                bytes_ = pa.Array.from_buffers(pa.large_binary(), len(one), [None, pa.py_buffer(np.concatenate([[0], np.cumsum(span)]).astype(np.int64)), pa.py_buffer(flat)])
                places = pa.ListArray.from_arrays(pa.array(np.append(head, len(order)), pa.int32()), pa.array(place[order], pa.int32()))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h[one].view(np.int64)), pa.array(group[one], pa.int32()), pa.array(ord_[a + row[one]]), pa.array(t[a + row[one]]),
                     pa.array(low[one], pa.int32()), pa.array(high[one], pa.int32()), bytes_.cast(pa.binary()), places],
                    ["anchor", "part", "ord", "t", "low", "high", "bytes", "places"])

    joined = docs.select("ord", "t", "text").join(wanted, ["ord", "t"]).select("ord", "t", "text", "wanted")
    return map_arrow(joined, cut, FRAGMENTS)


def _round(order: np.ndarray, common: np.ndarray, column: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Insert a symbol before every suffix: the new order, and each suffix's common prefix with the one before it."""
    bwt = column[order]
    by = np.argsort(bwt, kind="stable")
    symbols = bwt[by]
    between = np.stack([by[:-1] + 1, by[1:] + 1], 1).ravel()
    least = np.minimum.reduceat(np.append(common, np.int16(0)), between)[::2] if len(by) > 1 else np.zeros(0, np.int16)
    new = np.zeros(len(order), np.int16)
    new[1:] = np.where((symbols[1:] == symbols[:-1]) & (symbols[1:] > 0), least + np.int16(1), np.int16(0))
    return order[by], new


def equal_windows(group: np.ndarray, low: np.ndarray, high: np.ndarray, data: np.ndarray, offsets: np.ndarray):
    """Yield (distance of the window's start to the left of the anchor, fragments in order, starts of their runs of equal
    windows), for runs of two or more. ``group`` numbers the anchors; fragments lie in ``data`` from ``offsets``."""
    n = len(group)
    anchor_at = offsets[:-1] + high

    def column(at: int) -> np.ndarray:
        """Symbols at a distance from the anchor, 1 to 256; 0 where a fragment has none."""
        there = (at < LENGTH - low) & (at >= -high)
        out = np.zeros(n, np.uint16)
        out[there] = data[anchor_at[there] + at].astype(np.uint16) + np.uint16(1)
        return out

    order, common = np.arange(n), np.zeros(n, np.int16)
    for at in range(LENGTH - 1, KMER - 1, -1):
        order, common = _round(order, common, column(at))
    # the anchor's own columns are equal within a group and different between groups: one sort inserts them all
    by = np.argsort(group[order], kind="stable")
    between = np.stack([by[:-1] + 1, by[1:] + 1], 1).ravel()
    least = np.minimum.reduceat(np.append(common, np.int16(0)), between)[::2] if n > 1 else np.zeros(0, np.int16)
    order = order[by]
    common = np.zeros(n, np.int16)
    common[1:] = np.where(group[order][1:] == group[order][:-1], least + np.int16(KMER), np.int16(0))
    for left in range(SPAN):
        if left:
            order, common = _round(order, common, column(-left))
        same = common >= LENGTH
        if same.any():
            inside = same | np.append(same[1:], False)
            yield left, order[inside], np.flatnonzero(~same[inside])


def _batches(batches):
    """Arrow batches sorted by (anchor, part), regrouped into tables of whole groups."""
    held, rows = [], 0
    for batch in batches:
        held.append(batch)
        rows += batch.num_rows
        if rows >= BATCH:
            table = pa.Table.from_batches(held)
            keys = [table.column(c).to_numpy() for c in ("anchor", "part")]
            change = np.flatnonzero((keys[0][1:] != keys[0][:-1]) | (keys[1][1:] != keys[1][:-1]))
            if len(change):
                cut = int(change[-1]) + 1
                yield table.slice(0, cut)
                held, rows = table.slice(cut).to_batches(), table.num_rows - cut
    if rows:
        yield pa.Table.from_batches(held)


def _columns(table: pa.Table):
    table = table.combine_chunks()
    get = lambda c: table.column(c).to_numpy()
    anchor, part, ord_, t, low, high = (get(c) for c in ("anchor", "part", "ord", "t", "low", "high"))
    group = np.cumsum(np.concatenate([[0], (anchor[1:] != anchor[:-1]).astype(np.int64)]))
    blobs = table.column("bytes").combine_chunks().cast(pa.large_binary())
    offsets = np.frombuffer(blobs.buffers()[1], np.int64)[blobs.offset : blobs.offset + len(blobs) + 1]
    data = np.frombuffer(blobs.buffers()[2], np.uint8)
    places = table.column("places").combine_chunks()
    return part, ord_, t, low, high, group, data, offsets, places


def _spread(t: np.ndarray, masks: np.ndarray, places: pa.ListArray) -> pa.RecordBatch:
    """t, place, mask of every place of the fragments with a mask."""
    some = np.flatnonzero(masks)
    taken = places.take(pa.array(some))
    sizes = np.diff(taken.offsets.to_numpy())
    return pa.RecordBatch.from_arrays(
        [pa.array(np.repeat(t[some], sizes)), taken.flatten().cast(pa.int32()), pa.array(np.repeat(masks[some].view(np.int64), sizes))],
        ["t", "place", "mask"])


COVERED = "t long, place int, mask long"


def _covered(fragments: DataFrame) -> DataFrame:
    """t, place, mask: bit d of the mask says that the window d bytes left of the place starts in an earlier document."""

    def judge(batches):
        for table in _batches(batches):
            part, ord_, t, low, high, group, data, offsets, places = _columns(table)
            masks = np.zeros(len(t), np.uint64)
            for left, rows, starts in equal_windows(group, low, high, data, offsets):
                first = np.repeat(np.minimum.reduceat(ord_[rows], starts), np.diff(np.append(starts, len(rows))))
                late = rows[ord_[rows] > first]
                masks[late] |= np.uint64(1 << left)
            yield _spread(t, masks, places)

    whole = fragments.repartition("anchor", "part").sortWithinPartitions("anchor", "part")
    return map_arrow(whole, judge, COVERED)


WINDOWS = "one long, two long, first long, members array<struct<ord:long,t:long,place:int>>, distance int"


def _merge_large(fragments: DataFrame) -> DataFrame:
    """The same for anchors split into parts: each part gives its different windows, which then meet by hash."""

    def judge(batches):
        for table in _batches(batches):
            part, ord_, t, low, high, group, data, offsets, places = _columns(table)
            sums = [np.concatenate([[np.uint64(0)], np.cumsum(mix64(data.astype(np.uint64) + np.uint64(k)) * _power(_BASE, len(data)), dtype=np.uint64)]) for k in (1, 1000)]
            held = {left: (rows, starts) for left, rows, starts in equal_windows(group, low, high, data, offsets)}
            for left in range(SPAN):
                rows, starts = held.get(left, (np.zeros(0, np.int64), np.zeros(0, np.int64)))
                single = np.setdiff1d(np.flatnonzero((low <= left) & (high >= left)), rows)
                starts = np.concatenate([starts, len(rows) + np.arange(len(single))])
                rows = np.concatenate([rows, single])
                if not len(rows):
                    continue
                lead = rows[starts]
                at = offsets[lead] + high[lead] - left
                one, two = (mix64((s[at + LENGTH] - s[at]) * _power(_INVERSE, len(data) + 1)[at]).view(np.int64) for s in sums)
                taken = places.take(pa.array(rows))
                sizes = np.diff(taken.offsets.to_numpy())
                members = pa.StructArray.from_arrays([pa.array(np.repeat(ord_[rows], sizes)), pa.array(np.repeat(t[rows], sizes)), taken.flatten().cast(pa.int32())], ["ord", "t", "place"])
                bounds = np.append(np.concatenate([[0], np.cumsum(sizes)])[starts], sizes.sum())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(one), pa.array(two), pa.array(np.minimum.reduceat(ord_[rows], starts)),
                     pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), members), pa.array(np.full(len(starts), left), pa.int32())],
                    ["one", "two", "first", "members", "distance"])

    windows = stored(map_arrow(fragments.repartition("anchor", "part").sortWithinPartitions("anchor", "part"), judge, WINDOWS), "windows")
    firsts = stored(windows.groupBy("one", "two").agg(F.min("first").alias("overall")), "firsts")
    late = windows.join(firsts, ["one", "two"]).select("distance", "overall", F.explode("members").alias("m")).where(F.col("m.ord") > F.col("overall"))
    return late.groupBy("m.t", "m.place").agg(F.expr("bit_or(shiftleft(1L, distance))").alias("mask")).select("t", "place", "mask")


def in_windows(base: np.ndarray, mask: np.ndarray, n: int) -> np.ndarray:
    """Which of n bytes lie in a window that starts as many bytes left of its place as a bit of the place's mask says."""
    starts = np.concatenate([base[(mask >> np.uint64(left)) & np.uint64(1) > 0] - left for left in range(SPAN)])
    change = np.bincount(starts, minlength=n + 1) - np.bincount(starts + LENGTH, minlength=n + 1)
    return np.cumsum(change[:n]) > 0


REMOVED = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"


def remove_repeats(docs: DataFrame, group: int = GROUP) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans (maximal removed runs), kept_sha256, kept (the remaining bytes) of every row."""
    own = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    own = own.withColumns({"t": F.xxhash64("text"), "ord": F.coalesce("doc_id", F.lit(NO_ID))})

    pairs = _anchor_pairs(own)
    shared = pairs.groupBy("anchor").agg(F.min("t").alias("a"), F.max("t").alias("b"), F.count("*").alias("n")).where(F.col("a") < F.col("b"))
    shared = stored(shared.select("anchor", "n"), "shared-anchors")
    split = F.when(F.col("n") > group, 1 + F.pmod(F.col("t"), F.ceil(F.col("n") / group))).otherwise(0).cast("int")
    wanted = pairs.join(shared, "anchor").groupBy("t").agg(F.collect_set(F.struct("anchor", split.alias("part"))).alias("wanted"))  # a document's
    firsts = stored(own.groupBy("t").agg(F.min("ord").alias("ord")), "first-of-text")
    wanted = stored(wanted.join(firsts, "t").select("ord", "t", "wanted"), "wanted")
    fragments = _fragments(wanted, own)
    if shared.where(F.col("n") > group).isEmpty():
        covered = _covered(fragments)
    else:
        fragments = stored(fragments, "fragments")
        covered = _covered(fragments.where(F.col("part") == 0)).unionByName(_merge_large(fragments.where(F.col("part") > 0)))
    marks = covered.groupBy("t").agg(F.collect_list(F.struct("place", "mask")).alias("marks"))  # bounded by a document's anchors
    marks = stored(firsts.join(marks, "t", "left"), "marks")
    release(docs.sparkSession)

    def remove(batches):
        for batch in batches:
            column = texts(batch.column(1))
            first = batch.column(2).to_numpy(zero_copy_only=False)
            for a, b in slices(column, SLICE_BYTES):
                part = column[a:b]
                data, offsets = raw_bytes(part)
                lists = batch.column(3).slice(a, b - a)
                lists = pa.ListArray.from_arrays(lists.offsets, lists.values) if lists.null_count else lists
                ends = lists.offsets.to_numpy().astype(np.int64)
                items = lists.flatten()
                base = np.repeat(offsets[:-1], np.diff(ends)) + items.field("place").to_numpy(zero_copy_only=False)
                mask = items.field("mask").to_numpy(zero_copy_only=False).view(np.uint64)
                gone = in_windows(base, mask, len(data))
                rows = []
                for i in range(b - a):
                    own_gone, text = gone[offsets[i] : offsets[i + 1]], data[offsets[i] : offsets[i + 1]]
                    if not first[a + i] and len(text) >= LENGTH:  # an equal text has a smaller doc_id
                        own_gone = np.ones(len(text), bool)
                    kept = text[~own_gone].tobytes()
                    spans = int(np.count_nonzero(np.diff(own_gone.astype(np.int8), prepend=0) > 0))
                    rows.append((len(text), len(text) - len(kept), spans, hashlib.sha256(kept).hexdigest(), kept))
                n, removed, spans, sha, kept = zip(*rows)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()),
                     pa.array(sha), pa.array(kept, pa.binary())],
                    ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])

    joined = own.join(marks.withColumn("first", F.lit(True)), ["t", "ord"], "left").select(
        "doc_id", "text", F.coalesce("first", F.lit(False)).alias("first"), "marks")
    return map_arrow(joined, remove, REMOVED)
