"""Spelling variants: words one inserted, deleted or replaced code point apart, found by a trie-node pair dictionary.

1. ``word_counts`` counts the words of whole texts, batch by batch before the shuffle.
2. ``numbered`` sorts the words by range and numbers the nodes of their trie: within a partition a word shares the nodes
   of the prefix that it has in common with the word before, and makes new ones for the rest; what the first word of a
   partition shares with the last one of the partition before is taken over from there (one row a partition passes the
   driver). The same of the reversed words numbers their suffixes.
3. A prefix and a suffix are now two integers. Every word is posted under the pairs around each skipped position, (node before
   it, node after it), and under the pairs around each place where something may be inserted. Words that share a skip
   pair differ in that code point only; a skip pair of one and an insertion pair of another tell a deletion. Equal nodes are
   equal strings, so nothing is left to verify. Of a stretch of equal code points only the first skip counts for
   deletions, so every near pair has one pair of nodes.
4. A pair of nodes has at most one word for each letter of the alphabet and one insertion, so its words fit an array; each
   member gets its number of near words there and the one of largest count, and no pair of words is ever a row.
5. Roots follow forms by pointer jumping. A form has at least ``ratio`` times its word's count, so with a ratio above 1 there
   are no cycles and few rounds.

Cases: null and empty texts have no words; repeated rows count each; a null id is written as nothing; words of any length take
part, with work in proportion to their length; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_arrow, raw_bytes, slices, stored, texts
from .words import cut, spans

#: Bytes of UTF-8 that can be part of a word: A-Z, a-z, and U+00C0 to U+00FF, which are C3 and one more byte.
_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = _LETTER[0xC3] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: Words of more bytes are hashed one by one.
_LONG = 48


def _crc_table() -> np.ndarray:
    values = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        values = np.where(values & np.uint32(1), (values >> np.uint32(1)) ^ np.uint32(0xEDB88320), values >> np.uint32(1))
    return values


_CRC = _crc_table()


def _checksums(prefixes: np.ndarray, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """crc32 of each span of ``data``, continued from the crc32 of what stands before it."""
    state, length = ~prefixes, ends - starts
    order = np.argsort(-length, kind="stable")
    state, at, length = state[order], starts[order], length[order]
    for k in range(min(int(length[0]) if len(length) else 0, _LONG)):
        n = np.searchsorted(-length, -k, side="left")  # spans of more than k bytes
        state[:n] = _CRC[(state[:n] ^ data[at[:n] + k]) & np.uint32(255)] ^ (state[:n] >> np.uint32(8))
    out = np.empty(len(state), np.uint32)
    out[order] = ~state
    for i in order[: np.searchsorted(-length, -_LONG, side="left")]:
        out[i] = zlib.crc32(data[starts[i] : ends[i]].tobytes(), int(prefixes[i]))
    return out


def word_counts(docs: DataFrame, least_length: int = 6, least_count: int = 5, damage: int | None = None) -> DataFrame:
    """word, n: maximal runs of ``[A-Za-z\\u00C0-\\u00FF]``, A-Z lower-cased, of at least that many code points and occurrences.

    With ``damage`` given, an occurrence for which it divides h, the crc32 of "<doc_id>:<word>", loses its code point h % length.
    """

    def count(batches):
        for batch in batches:
            column = texts(batch.column(1))
            for a, b in slices(column):
                data, offsets = raw_bytes(column[a:b])
                data = _LOWER[data]
                inside = _LETTER[data]
                inside[1:] |= data[:-1] == 0xC3
                starts, ends, of = spans(inside, offsets)
                found: Counter = Counter()
                if damage:
                    before = np.array([zlib.crc32(f"{'' if i is None else i}:".encode()) for i in batch.column(0).slice(a, b - a).to_pylist()], np.uint32)
                    h = _checksums(np.repeat(before, np.diff(of)), data, starts, ends)
                    hit = h % np.uint32(damage) == 0
                    for k in np.flatnonzero(hit):
                        word = data[starts[k] : ends[k]].tobytes().decode()
                        at = int(h[k]) % len(word)
                        found[word[:at] + word[at + 1 :]] += 1
                    codes = cut(data, starts, ends).dictionary_encode()
                    n = np.bincount(codes.indices.to_numpy(zero_copy_only=False)[~hit], minlength=len(codes.dictionary))
                else:
                    codes = cut(data, starts, ends).dictionary_encode()
                    n = np.bincount(codes.indices.to_numpy(zero_copy_only=False), minlength=len(codes.dictionary))
                plain = codes.dictionary.cast(pa.large_string())
                long = pc.greater_equal(pc.utf8_length(plain), least_length).to_numpy(zero_copy_only=False)
                lost = [w for w in found if len(w) >= least_length]
                words = pa.concat_arrays([plain.filter(pa.array(long & (n > 0))).cast(pa.string()), pa.array(lost, pa.string())])
                counts = np.concatenate([n[long & (n > 0)], [found[w] for w in lost]]).astype(np.int64)
                yield pa.RecordBatch.from_arrays([words, pa.array(counts)], ["word", "n"])

    counted = map_arrow(docs.select(F.col("doc_id").cast("long"), "text"), count, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


def numbered(paths: DataFrame, label: str) -> DataFrame:
    """path, id, place, nodes of every distinct path: the trie nodes of its prefixes from the empty one to itself, and
    its place in the order of all paths (not gapless)."""

    def number(batches):
        part, made, before, nodes, seq = TaskContext.get().partitionId(), 1, "", [0], 0
        for batch in batches:
            held = []
            for path in batch.column(0).to_pylist():
                same = 0
                for x, y in zip(path, before):
                    if x != y:
                        break
                    same += 1
                new = len(path) - same
                nodes = nodes[: same + 1] + list(range(made, made + new))
                made, before = made + new, path
                held.append(nodes)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(np.full(len(held), part), pa.int64()), pa.array(seq + np.arange(len(held)), pa.int64()),
                 pa.array(held, pa.list_(pa.int64()))], ["path", "id", "part", "seq", "nodes"])
            seq += len(held)

    ordered = paths.select("path", "id").repartitionByRange("path").sortWithinPartitions("path")
    local = stored(map_arrow(ordered, number, "path string, id long, part long, seq long, nodes array<long>"), label)
    edge = F.struct("seq", "path", "nodes")
    borders = local.groupBy("part").agg(F.min(F.struct("seq", "path")).path.alias("first"), F.max(edge).alias("last")).orderBy("part").collect()
    base, rows, before = 0, [], None
    for border in borders:  # one row a partition
        taken = [0]
        if before is not None:
            path, nodes = before
            shared = next((k for k, (x, y) in enumerate(zip(border["first"], path)) if x != y), min(len(border["first"]), len(path)))
            taken = nodes[: shared + 1]
        rows.append((border["part"], base, taken))
        last = border["last"]
        before = last["path"], [taken[x] if x < len(taken) else base + x for x in last["nodes"]]
        base += last["nodes"][-1] + 1
    moves = paths.sparkSession.createDataFrame(rows, "part long, base long, taken array<long>")
    node = lambda x: F.when(x < F.size("taken"), F.get("taken", x.cast("int"))).otherwise(F.col("base") + x)
    return local.join(F.broadcast(moves), "part").select(
        "path", "id", (F.col("part") * F.lit(1 << 40) + F.col("seq")).alias("place"), F.transform("nodes", node).alias("nodes"))


def _posts(words: DataFrame) -> DataFrame:
    """before, after, skip, counts, n, id of every word's skip and insertion pairs (columns id, n, letters, up, down)."""
    size = F.size("letters")
    pair = lambda i, rest, skip, counts: F.struct(
        F.get("up", i).alias("before"), F.get("down", size - i - rest).alias("after"), F.lit(skip).alias("skip"), counts.alias("counts"))
    skips = F.transform(F.sequence(F.lit(0), size - 1), lambda i: pair(i, 1, True, (i == 0) | (F.get("letters", i) != F.get("letters", i - 1))))
    inserts = F.transform(F.sequence(F.lit(0), size), lambda i: pair(i, 0, False, F.lit(True)))
    return words.select("id", "n", F.explode(F.concat(skips, inserts)).alias("pair")).select("pair.*", "n", "id")


def near_words(words: DataFrame) -> DataFrame:
    """id, n_near, best (n and id of the near word of largest n, then first in order) of every word (id, n, letters, up, down)
    with a near one."""
    members = F.collect_list(F.struct("skip", "counts", "n", "id"))  # at most one for each letter of the alphabet, and one more
    groups = _posts(words).groupBy("before", "after").agg(members.alias("members")).where(F.size("members") > 1)
    each = groups.select("members", F.explode("members").alias("m"))
    others = F.filter("members", lambda x: (x.id != F.col("m.id")) & ((x.skip & F.col("m.skip")) | ((x.skip != F.col("m.skip")) & x.counts & F.col("m.counts"))))
    each = each.select("m.id", others.alias("others")).where(F.size("others") > 0)
    best = F.array_max(F.transform("others", lambda x: F.struct(x.n.alias("n"), (-x.id).alias("minus_id"))))
    found = each.select("id", F.size("others").cast("long").alias("n_near"), best.alias("best")).groupBy("id").agg(
        F.sum("n_near").alias("n_near"), F.max("best").alias("best"))
    return found.select("id", "n_near", F.struct(F.col("best.n").alias("n"), (-F.col("best.minus_id")).alias("id")).alias("best"))


def _roots(forms: DataFrame) -> DataFrame:
    """id, root of (id, form) rows that make no cycle: the last id reached."""
    at = stored(forms.select("id", F.col("form").alias("root")), "roots")
    while True:
        further = at.select(F.col("id").alias("root"), F.col("root").alias("further"))
        new = stored(at.join(further, "root", "left").select("id", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "roots")
        if new.where("moved").isEmpty():
            return new.select("id", "root")
        at = new.select("id", "root")


def variants(counts: DataFrame, ratio: int = 5) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word of (word, n) rows, words distinct."""
    counts = stored(counts.select("word", "n"), "words")
    up = numbered(counts.select(F.col("word").alias("path"), F.lit(0).cast("long").alias("id")), "prefixes")
    up = stored(up.join(counts, up.path == counts.word).select(F.col("place").alias("id"), "word", "n", F.col("nodes").alias("up")), "forward")
    down = numbered(up.select(F.reverse("word").alias("path"), "id"), "suffixes").select("id", F.col("nodes").alias("down"))
    letters = F.split("word", "")
    near = near_words(up.join(down, "id").select("id", "n", letters.alias("letters"), "up", "down"))
    known = stored(up.select("id", "word", "n").join(near, "id", "left"), "near-words")
    forms = known.where(F.col("best.n") >= ratio * F.col("n")).select("id", F.col("best.id").alias("form"), F.col("best.n").alias("form_n"))
    forms = stored(forms, "forms")
    led = forms.join(_roots(forms), "id")
    named = up.select("id", "word")
    led = led.join(named.withColumnsRenamed({"id": "form", "word": "form_word"}), "form").join(named.withColumnsRenamed({"id": "root", "word": "root_word"}), "root")
    led = led.select("id", F.col("form_word").alias("form"), F.col("root_word").alias("root"), "form_n")
    return known.join(led, "id", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form_n")
