"""Near copies of whole documents by a signature-coordinate inverted join.

1. One pass over the texts makes each document's set of word shingles, its size, a 128-bit fingerprint of the set, and
   ``COUNTED`` MinHash values. Documents with equal sets are one class from here on.
2. Every class has ``COORDINATES`` keys, its first (coordinate, value) pairs. At least ``MATCHES`` of them must collide, so with
   all keys ordered by how many classes have them, two such classes share one of their ``COORDINATES`` - ``MATCHES`` + 1
   rarest: only that prefix is posted, and keys that one class alone has are not posted at all. Values that very common
   shingles lend to very many documents thus never gather postings. Under a key the collisions of two whole signatures
   are counted (of one byte per value, seven to a long); counting is skipped where set sizes alone rule a link out.
3. Pairs with ``COLLISIONS`` or more are confirmed on the full shingle sets of their texts, with integers.
4. Linked classes form components (``links.py``); a document's component is named after its smallest doc_id. In a large
   group of near copies, two that are no link are told apart by their differences from the group's center: a link's
   differences must overlap (``_near``), and MinHash values of the differences show whether they do.

The tests on signatures miss a pair of similarity 0.8 with a probability of about 1 in 10,000, closer ones far more rarely.

Cases: a null or empty text, or one of white space only, has an empty set and is linked with nothing; fewer words than
a shingle's count as one shingle; repeated rows share a class; a null doc_id is an item of its own class's component
but never names it (its component is null if no member has an id); other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import map_arrow, mix64, raw_bytes, release, remembered, slices, stored, texts
from .links import linked

COORDINATES, MATCHES = 32, 16
PREFIX = COORDINATES - MATCHES + 1
COUNTED, COLLISIONS = 126, 84
_BYTES_LOW, _BYTES_TOP = 0x007F7F7F7F7F7F7F, 0x0080808080808080
#: Links have 100 * intersection >= SIMILARITY * union.
SIMILARITY = 80
_BASE = np.uint64(0x9E3779B97F4A7C15)
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _power(name: str, base: np.uint64, n: int) -> np.ndarray:
    """The first n powers of an odd base modulo 2**64, kept between calls."""
    powers = remembered("word powers")
    if name not in powers or len(powers[name]) < n:
        size = max(n, 1 << 20)
        powers[name] = np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(size - 1, base, np.uint64))])
    return powers[name][:n]


_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))


def word_hashes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words of all texts one after the other, and n + 1 offsets of the texts.

    A word is a run of bytes other than white space, A-Z lower-cased. Hashes are differences of running polynomial
    sums, scrambled, so whole columns are hashed without a loop over words.
    """
    data, offsets = raw_bytes(column)
    word = ~_SPACE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    inner = edge[:-1]
    starts = np.flatnonzero(word & (np.concatenate([[True], ~word[:-1]]) | inner)) if len(data) else np.zeros(0, np.int64)
    ends = np.flatnonzero(word & (np.concatenate([~word[1:], [True]]) | edge[1:])) + 1 if len(data) else np.zeros(0, np.int64)
    sums = np.concatenate([[np.uint64(0)], np.cumsum((_LOWER[data].astype(np.uint64) + np.uint64(1)) * _power("up", _BASE, len(data)), dtype=np.uint64)])
    hashes = mix64((sums[ends] - sums[starts]) * _power("down", _INVERSE, len(data) + 1)[starts] + (ends - starts).astype(np.uint64))
    return hashes, np.searchsorted(starts, offsets)


def shingle_sets(column: pa.Array, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of every text, one after the other, and n + 1 offsets of the texts."""
    hashes, offsets = word_hashes(column)
    n = np.diff(offsets)
    rolled, size = hashes.copy(), len(hashes)
    for k in range(1, words):
        rolled[: size - k] = mix64(rolled[: size - k] * _BASE + hashes[k:])
    pieces = []
    for i in range(len(n)):
        a, b = offsets[i], offsets[i + 1]
        if b - a >= words:
            pieces.append(np.unique(rolled[a : b - words + 1]))
        elif b > a:
            whole = np.full(1, b - a, np.uint64)
            for k in range(a, b):
                whole = mix64(whole * _BASE + hashes[k : k + 1])
            pieces.append(whole)
        else:
            pieces.append(np.zeros(0, np.uint64))
    ends = np.concatenate([[0], np.cumsum([len(p) for p in pieces])]).astype(np.int64)
    return (np.concatenate(pieces) if pieces else np.zeros(0, np.uint64)), ends


def _signatures(sets: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """COUNTED minima per non-empty set, as unsigned 32-bit values."""
    seeds = np.random.default_rng(9).integers(1, 2**63, (2, COUNTED), dtype=np.uint64) | np.uint64(1)
    out = np.zeros((len(ends) - 1, COUNTED), np.uint32)
    full = np.flatnonzero(np.diff(ends))
    if len(full):
        for j in range(COUNTED):
            out[full, j] = np.minimum.reduceat(((sets ^ seeds[1, j]) * seeds[0, j]) >> np.uint64(32), ends[full]).astype(np.uint32)
    return out


def _packed(signatures: np.ndarray) -> np.ndarray:
    """The values' low bytes, seven to a long."""
    low = (signatures & np.uint32(255)).astype(np.int64).reshape(len(signatures), -1, 7)
    return (low << (8 * np.arange(7))).sum(2)


PRINTS = "doc_id long, n_shingles long, print binary, signature array<int>, packed array<long>"


def prints(docs: DataFrame, words: int) -> DataFrame:
    """doc_id, n_shingles, fingerprint of the shingle set, signature; one row per document."""

    def one(batches):
        for batch in batches:
            column = texts(batch.column(1))
            for a, b in slices(column):
                sets, ends = shingle_sets(column[a:b], words)
                n = np.diff(ends)
                sums = np.zeros((b - a, 2), np.uint64)
                full = np.flatnonzero(n)
                if len(full):
                    other = mix64(sets ^ _BASE)
                    sums[full, 0] = np.add.reduceat(sets, ends[full])
                    sums[full, 1] = np.bitwise_xor.reduceat(other, ends[full]) + np.add.reduceat(other >> np.uint64(7), ends[full])
                signature = _signatures(sets, ends)
                packed = _packed(signature)
                lists = lambda x, kind: pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * x.shape[1], pa.int32()), pa.array(np.ascontiguousarray(x).ravel(), kind))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.array(n, pa.int64()), pa.array([r.tobytes() for r in sums], pa.binary()),
                     lists(np.ascontiguousarray(signature[:, :COORDINATES]).view(np.int32), pa.int32()), lists(packed, pa.int64())],
                    ["doc_id", "n_shingles", "print", "signature", "packed"])

    return map_arrow(docs.select(F.col("doc_id").cast("long"), "text"), one, PRINTS)


#: Documents of either side that meet in one row group.
ONES, OTHERS = 128, 256


def confirmed(pairs: DataFrame, docs: DataFrame, words: int, gaps: bool = True) -> DataFrame:
    """a, b, linked, gap of every pair (one, other) of doc_ids, judged on the full shingle sets.

    Pairs of one hint share documents, so texts travel by blocks and not by pairs: up to about ``ONES`` documents of one
    side meet up to about ``OTHERS`` of the other, each text once, and the other side's rows name their partners.
    The gap holds the number of shingles that one of the two alone has, and their packed MinHash values; it is null for
    sets that have less than half in common.
    """
    sizes = pairs.groupBy("hint").agg(F.approx_count_distinct("one").alias("ones"), F.approx_count_distinct("other").alias("others"))
    part = lambda c, n, most: F.pmod(F.xxhash64(c), F.greatest(F.lit(1), F.ceil(F.col(n) / most)).cast("long"))
    group = ["hint", "block", "share"]
    meet = stored(pairs.join(sizes, "hint").select(
        "hint", part("one", "ones", ONES).alias("block"), part("other", "others", OTHERS).alias("share"), "one", "other"), "meet")
    routes = meet.groupBy(*group, F.col("other").alias("doc_id")).agg(F.collect_set("one").alias("partners"))  # a block's
    routes = routes.unionByName(meet.select(*group, F.col("one").alias("doc_id")).distinct().withColumn("partners", F.lit(None).cast("array<long>")))
    # repeated rows of an id all travel; the last one counts
    carried = routes.join(docs.select(F.col("doc_id").cast("long"), "text"), "doc_id").select(*group, "doc_id", "partners", "text")
    # a fixed number of partitions: the groups are small in bytes but not in work
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    carried = carried.repartition(tasks, *group).sortWithinPartitions(*group, F.col("partners").isNotNull(), "doc_id", "text")

    def judge(batches):
        key, held = None, {}
        for batch in batches:
            column = texts(batch.column(5))
            for first, last in slices(column):
                sets, ends = shingle_sets(column[first:last], words)
                found = []
                hint, block, share, own, partners = (batch.column(k).slice(first, last - first).to_pylist() for k in range(5))
                for i in range(last - first):
                    one = sets[ends[i] : ends[i + 1]]
                    if (hint[i], block[i], share[i]) != key:
                        key, held = (hint[i], block[i], share[i]), {}
                    if partners[i] is None:
                        held[own[i]] = one.copy()
                        continue
                    for partner in partners[i]:
                        center = held[partner]
                        both = len(np.intersect1d(center, one, assume_unique=True))
                        union = len(center) + len(one) - both
                        gap = None
                        if gaps and 2 * both > union:  # the difference of sets further apart tells nothing
                            alone = np.setxor1d(center, one, assume_unique=True)
                            gap = {"n": len(alone), "packed": _packed(_signatures(alone, np.array([0, len(alone)])))[0].tolist()}
                        found.append((min(partner, own[i]), max(partner, own[i]), 100 * both >= SIMILARITY * union, gap))
                columns = zip(*found) if found else ([], [], [], [])
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["a", "b", "linked", "gap"])

    kinds = (pa.int64(), pa.int64(), pa.bool_(), pa.struct([("n", pa.int64()), ("packed", pa.list_(pa.int64()))]))
    judged = map_arrow(carried, judge, "a long, b long, linked boolean, gap struct<n:long,packed:array<long>>")
    return judged.dropDuplicates(["a", "b"])


def _collisions(one: Column, other: Column) -> Column:
    """Equal bytes of two packed signatures."""
    low, top = F.lit(_BYTES_LOW), F.lit(_BYTES_TOP)
    apart = [F.get(one, i).bitwiseXOR(F.get(other, i)) for i in range(COUNTED // 7)]
    return F.lit(COUNTED) - sum((F.bit_count((x.bitwiseAND(low) + low).bitwiseOR(x).bitwiseAND(top)) for x in apart), F.lit(0))


def _match(one: Column, other: Column) -> Column:
    """Set sizes that allow a link, and enough colliding coordinates."""
    small, large = F.least(one.n, other.n), F.greatest(one.n, other.n)
    return (small * 100 >= large * SIMILARITY) & (_collisions(one.packed, other.packed) >= COLLISIONS)


def _near(one: Column, one_gap: Column, other: Column, other_gap: Column) -> Column:
    """Whether two sets may be a link, by their differences A and B from a common center.

    The sets differ in A xor B, of which a link has at most (n + m) * (1 - s) / (1 + s) elements; so A and B share at least
    half of |A| + |B| less that, and their similarity has a least value. Collisions four deviations below it rule it out.
    """
    most = (one.n + other.n) * ((100 - SIMILARITY) / (100 + SIMILARITY))
    shared = (one_gap.n + other_gap.n - most) / 2
    least = F.greatest(F.lit(0.0), shared / F.greatest(F.lit(1.0), one_gap.n + other_gap.n - shared))
    bound = COUNTED * least - 4 * F.sqrt(COUNTED * least * F.greatest(F.lit(0.0), 1 - least))
    return (shared <= F.least(one_gap.n, other_gap.n)) & (_collisions(one_gap.packed, other_gap.packed) >= bound)


def _postings(classes: DataFrame) -> DataFrame:
    """key, id, weight, item: every class under those of its rarest keys that another class has as well.

    The weight is the number of posts that all of a class's keys have: copies differ from their original in keys of
    their own, so the original of a group has the greatest.
    """
    pairs = classes.select("id", F.posexplode("signature").alias("coordinate", "value"))
    keys = pairs.select("id", (F.col("coordinate") * F.lit(1 << 32) + F.col("value")).alias("key"))
    shared = stored(keys.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > 1), "shared-keys")
    ordered = F.sort_array(F.collect_list(F.struct(F.coalesce("n", F.lit(1)).alias("n"), "key")))  # COORDINATES entries
    rarest = keys.join(shared, "key", "left").groupBy("id").agg(
        F.filter(F.slice(ordered, 1, PREFIX), lambda k: k.n > 1).alias("keys"), F.sum(F.coalesce("n", F.lit(1))).alias("weight"))
    posts = rarest.where(F.size("keys") > 0).join(classes, "id").select("id", "weight", "keys.key", F.struct("n", "packed").alias("item"))
    return stored(posts, "posts").select("id", "weight", F.explode("key").alias("key"), "item")


def near_copies(docs: DataFrame, words: int = 5) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row."""
    made = stored(prints(docs, words), "prints")
    classes = made.where(F.col("n_shingles") > 0).groupBy("print", "n_shingles").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "signature", "packed")).alias("first"))
    classes = stored(classes.select("print", F.col("first.doc_id").alias("id"), F.col("n_shingles").alias("n"), "first.signature", "first.packed"), "classes")
    named = classes.where(F.col("id").isNotNull())
    found = linked(_postings(named), _match, lambda pairs, gaps: confirmed(pairs, docs, words, gaps), _near)
    groups = classes.join(found, "id", "left").select("print", F.col("n").alias("n_shingles"), F.coalesce("component", "id").alias("component_id"))
    groups = stored(groups, "groups")
    release(docs.sparkSession)
    return made.select("doc_id", "n_shingles", "print").join(groups, ["print", "n_shingles"], "left").select(
        "doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id")
    ).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)))
