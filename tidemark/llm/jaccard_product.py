"""N-gram Jaccard join by a blocked sparse product of the document by n-gram incidence matrix.

A row of the matrix is a document's set of word n-grams (64-bit hashes, in order), a column an n-gram; the product of the
matrix with its transpose holds every pair's overlap. Only the part that can hold a link is ever computed:

1. Rows of equal sets are one class from here on (``rows_of``).
2. Column blocks (``blocks_of``). Two linked sets of a and b n-grams differ in at most D = floor((a + b) * (1 - s) / (1 + s))
   columns, by their sizes alone. With the columns dealt into more than D blocks, a linked pair agrees on a whole block, so
   only rows equal in some block meet. Sizes fall into classes of ratio 1.5, each with its own number of blocks; sizes from which a link
   reaches into the next class take part there, too. An empty block says nothing, so there are some blocks more than D + 1, and a
   row with more empty blocks than that (its partner then has them as well) is also posted under its first columns,
   of which any link shares one. No link is lost.
3. Rounds (``joined``). Under every block key a center (in later rounds up to ``GROWTH``, then its square, ... of them) meets the key's other rows, unless they are one
   component already or their sizes rule a link out; centers are done after their round, keys whose rows are one
   component are done altogether. A large group of copies thus costs one pair per copy and key, and no key's pairs are all written.
   From the second round on two bounds drop most pairs of a loose group before they are written (``bounded``): a pair's overlap
   is at most the number of columns that a row shares with any row still open, and two sets differ in at least as many
   columns as parities of their columns' counts in ``64 * WORDS`` buckets.
4. The product (``overlaps``) runs in tiles of one center by up to ``TILE`` rows, column range by column range: overlap counts add up, and
   rows whose count plus what is left can no longer reach ceil(s * (a + b) / (1 + s)) are dropped on the way.

Two different n-grams of equal 64-bit hash would count as one.

Cases: a null or empty text, or one of white space only, has an empty set and is linked with nothing; fewer words than
an n-gram's count as one; repeated rows, also of one id with different texts, are judged row by row; a null doc_id is linked like any other but
never names a component (which is null if no member has an id); other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, map_arrow, mix64, release, slices, stored, texts
from .links import components
from .near_copies import shingle_sets

#: Links have 100 * intersection >= SIMILARITY * union.
SIMILARITY = 85
#: Rows of one tile beside its center, and ranges of columns.
TILE, RANGES = 256, 8
#: Longs of parities to a row, and of the same in fewer buckets, which are looked at first.
WORDS, FEW = 32, 8
#: Each round has so many times the centers of the round before.
GROWTH = 64
_SEED = np.uint64(0xD1B54A32D192ED03)
_OTHER = np.uint64(0x8CB92BA72F3D8DD7)


def least_overlap(a, b):
    """The overlap that sets of a and b n-grams need."""
    return -(-SIMILARITY * (a + b) // (100 + SIMILARITY))


class SizeClasses:
    """lo and hi size, number of blocks and allowed number of empty blocks of every size class up to a size."""

    def __init__(self, largest: int) -> None:
        self.lo, self.hi, self.blocks, self.empty = [], [], [], []
        low = 1
        while not self.hi or self.hi[-1] < largest:
            high = max(low, low * 3 // 2)
            differ = 2 * high * (100 - SIMILARITY) // (100 + SIMILARITY)
            spare = self._spare(differ, max(1, low * SIMILARITY // 100))
            for held, value in zip((self.lo, self.hi, self.blocks, self.empty), (low, high, differ + 1 + spare, spare)):
                held.append(value)
            low = high + 1
        self.lo, self.hi, self.blocks, self.empty = (np.array(c, np.int64) for c in (self.lo, self.hi, self.blocks, self.empty))

    @staticmethod
    def _spare(differ: int, size: int) -> int:
        """Blocks beyond differ + 1: few, but so many that rarely more blocks of a set of that size are empty."""
        best = (2.0, 0)
        for spare in range(differ + 3):
            blocks = differ + 1 + spare
            rate, term, below = blocks * math.exp(-size / blocks), math.exp(-blocks * math.exp(-size / blocks)), 0.0
            for k in range(spare + 1):
                below += term
                term *= rate / (k + 1)
            if 1 - below < 0.02:
                return spare
            best = min(best, (1 - below, spare))
        return best[1]


def rows_of(docs: DataFrame, n: int) -> DataFrame:
    """doc_id, text_hash, n_shingles, print (128 bits of the set) of every row."""

    def one(batches):
        for batch in batches:
            column = texts(batch.column(2))
            for a, b in slices(column):
                sets, ends = shingle_sets(column[a:b], n)
                sums, full = np.zeros((b - a, 2), np.uint64), np.flatnonzero(np.diff(ends))
                if len(full):
                    for k, seed in enumerate((_SEED, _OTHER)):
                        sums[full, k] = np.add.reduceat(mix64(sets ^ seed), ends[full])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), batch.column(1).slice(a, b - a), pa.array(np.diff(ends), pa.int64()),
                     pa.array([r.tobytes() for r in sums], pa.binary())], ["doc_id", "text_hash", "n_shingles", "print"])

    held = docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("text_hash"), "text")
    return map_arrow(held, one, "doc_id long, text_hash long, n_shingles long, print binary")


def block_keys(sets: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, key) of every block key of the rows."""
    sizes = np.diff(ends)
    classes = SizeClasses(int(sizes.max(initial=1)) * 2)
    own = np.searchsorted(classes.hi, sizes)
    reach = sizes * 100 // SIMILARITY >= classes.lo[own + 1]
    rows, keys = [], []
    for up in (0, 1):
        some = np.flatnonzero((sizes > 0) & (reach if up else True))
        some = some[classes.blocks[own[some] + up] > 1]  # one block only: no links but of equal sets
        if not len(some):
            continue
        n, space = sizes[some], own[some] + up
        of = np.repeat(np.arange(len(some)), n)
        column = np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n)
        values = sets[ends[some][of] + column]
        # columns are in order, so a row's block is a stretch of them
        block = ((values >> np.uint64(32)) * classes.blocks[space][of].astype(np.uint64)) >> np.uint64(32)
        first = np.flatnonzero(np.concatenate([[True], (of[1:] != of[:-1]) | (block[1:] != block[:-1])]))
        label = mix64((space[of[first]].astype(np.uint64) << np.uint64(40)) + block[first] + np.uint64(1))
        rows.append(some[of[first]])
        keys.append(mix64(np.add.reduceat(mix64(values ^ _OTHER), first) ^ label))
        thin = classes.blocks[space] - np.bincount(of[first], minlength=len(some)) > classes.empty[space]
        prefix = thin[of] & (column <= (n - (-(-SIMILARITY * n // 100)))[of])
        rows.append(some[of[prefix]])
        keys.append(mix64(values[prefix] ^ mix64(space[of[prefix]].astype(np.uint64) + _SEED)))
    none = np.zeros(0, np.int64)
    return (np.concatenate(rows) if rows else none), (np.concatenate(keys) if keys else none.astype(np.uint64)).view(np.int64)


def _with_texts(docs: DataFrame, classes: DataFrame) -> DataFrame:
    """id and text of classes (id, doc_id, text_hash), each once also where rows repeat."""
    doc_id = F.col("doc_id").cast("long")
    named = [F.coalesce(doc_id, F.lit(0)).alias("named"), doc_id.isNull().alias("unnamed")]
    held = docs.select(*named, F.xxhash64("text").alias("text_hash"), "text")
    # a merge join at every size: what is small here would be large on more data; rows of equal keys lie together after it
    keys = ["named", "unnamed", "text_hash"]
    return held.join(classes.select(*named, "text_hash", "id").hint("merge"), keys).dropDuplicates(keys).select("id", "text")


def blocks_of(docs: DataFrame, classes: DataFrame, n: int) -> DataFrame:
    """key, id: every class under its block keys."""

    def post(batches):
        for batch in batches:
            column, ids = texts(batch.column(1)), batch.column(0).to_numpy(zero_copy_only=False)
            for a, b in slices(column):
                rows, keys = block_keys(*shingle_sets(column[a:b], n))
                yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(ids[a:b][rows], pa.int64())], ["key", "id"])

    return map_arrow(_with_texts(docs, classes), post, "key long, id long")


def parities(sets: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """For every row, ``WORDS`` longs of bits: whether an odd number of its columns falls into a bucket."""
    n, buckets = len(ends) - 1, 64 * WORDS
    row = np.repeat(np.arange(n), np.diff(ends))
    odd = np.bincount(row * buckets + (sets & np.uint64(buckets - 1)).astype(np.int64), minlength=n * buckets) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64).reshape(n, WORDS)


def incidence(docs: DataFrame, classes: DataFrame, n: int) -> DataFrame:
    """id, its matrix row (the columns, n-gram hashes in unsigned order, that it has) and their parities."""

    def one(batches):
        for batch in batches:
            column = texts(batch.column(1))
            for a, b in slices(column):
                sets, ends = shingle_sets(column[a:b], n)
                rows = pa.LargeListArray.from_arrays(pa.array(ends), pa.array(sets.view(np.int64))).cast(pa.list_(pa.int64()))
                odd = np.concatenate([parities(sets[ends[i] : ends[min(i + 256, b - a)]], ends[i : min(i + 256, b - a) + 1] - ends[i]) for i in range(0, b - a, 256)])
                odd = pa.ListArray.from_arrays(pa.array(np.arange(b - a + 1) * WORDS, pa.int32()), pa.array(odd.ravel()))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), rows, odd], ["id", "columns", "odd"])

    return map_arrow(_with_texts(docs, classes), one, "id long, columns array<long>, odd array<long>")


def product(center: np.ndarray, columns: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Overlap of a center row with each of the rows of a tile, or -1 where their sizes and counts so far rule a link out."""
    sizes = np.diff(ends)
    need = least_overlap(len(center), sizes)
    counts, alive = np.zeros(len(sizes), np.int64), np.minimum(sizes, len(center)) >= need
    row = np.repeat(np.arange(len(sizes)), sizes)
    part = (columns >> np.uint64(61)).astype(np.int8)
    left = np.stack([np.bincount(row[part == r], minlength=len(sizes)) for r in range(RANGES)])
    own = np.bincount((center >> np.uint64(61)).astype(np.int64), minlength=RANGES)
    for r in range(RANGES):
        here = np.flatnonzero((part == r) & alive[row])
        mine = center[(center >> np.uint64(61)) == np.uint64(r)]
        if len(here) and len(mine):
            at = np.minimum(np.searchsorted(mine, columns[here]), len(mine) - 1)
            counts += np.bincount(row[here[mine[at] == columns[here]]], minlength=len(sizes))
        rest = np.minimum(left[r + 1 :].sum(0), own[r + 1 :].sum())
        alive &= counts + rest >= need
    return np.where(alive, counts, -1)


def overlaps(pairs: DataFrame, matrix: DataFrame, many: bool) -> DataFrame:
    """one, other, linked of every pair (one, other); ``many`` if most rows take part."""
    sizes = pairs.groupBy("one").agg(F.count("*").alias("others"))
    share = F.pmod(F.xxhash64("other"), F.ceil(F.col("others") / TILE).cast("long"))
    tiles = stored(pairs.join(sizes, "one").select("one", share.alias("share"), "other"), "tiles")
    routes = tiles.select("one", "share", "other").unionByName(tiles.select("one", "share", F.col("one").alias("other")).distinct())
    tasks = int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # small in bytes, but not in work
    rows = matrix.select(F.col("id").alias("other"), "columns")
    carried = routes.join(rows.hint("merge") if many else rows, "other").select("one", "share", "other", "columns")
    carried = carried.repartition(tasks, "one", "share").sortWithinPartitions("one", "share", F.col("one") != F.col("other"))

    def judge(batches):
        center = np.zeros(0, np.uint64)
        for batch in batches:
            one, share, other = (batch.column(k).to_numpy(zero_copy_only=False) for k in range(3))
            rows = batch.column(3)
            ends = rows.offsets.to_numpy().astype(np.int64)
            columns = rows.values.to_numpy(zero_copy_only=False).view(np.uint64)
            edges = np.flatnonzero(np.concatenate([[True], (one[1:] != one[:-1]) | (share[1:] != share[:-1]), [True]]))
            linked = np.zeros(len(one), bool)
            for a, b in zip(edges[:-1], edges[1:]):
                if one[a] == other[a]:
                    center = columns[ends[a] : ends[a + 1]].copy()
                    a += 1
                if a < b:
                    linked[a:b] = product(center, columns[ends[a] : ends[b]], ends[a : b + 1] - ends[a]) >= 0
            found = np.flatnonzero(one != other)
            yield pa.RecordBatch.from_arrays([pa.array(one[found]), pa.array(other[found]), pa.array(linked[found])], ["one", "other", "linked"])

    return map_arrow(carried, judge, "one long, other long, linked boolean")


def bounded(open_: DataFrame, matrix: DataFrame) -> DataFrame:
    """The open posts (key, id, n ...) with the parities of their rows and ``common``, the number of columns that another open
    row has as well; without rows that share too few to link with any."""
    rows = stored(matrix.join(open_.select("id").distinct(), "id"), "open-rows")
    columns = rows.select("id", F.explode("columns").alias("column")).groupBy("column").agg(F.min("id").alias("id"), F.count("*").alias("rows"))
    alone = columns.where(F.col("rows") == 1).groupBy("id").agg(F.count("*").alias("alone"))
    few = F.array(*[F.expr(" ^ ".join(f"get(odd, {i})" for i in range(k, WORDS, FEW))) for k in range(FEW)])
    held = open_.join(rows.select("id", "odd", few.alias("few")), "id").join(alone, "id", "left")
    held = held.withColumn("common", F.col("n") - F.coalesce("alone", F.lit(0))).drop("alone")
    return held.where(F.col("common") * 100 >= F.col("n") * SIMILARITY)


def joined(posts: DataFrame, matrix: DataFrame) -> DataFrame:
    """id, component of the linked classes; ``posts`` (key, id, n) and ``matrix`` are stored tables."""
    weights = posts.groupBy("id").agg(F.count("*").alias("weight"))
    none = F.lit(None).cast("array<long>")
    held = stored(posts.join(weights, "id"), "open-posts").withColumns({"component": F.col("id"), "common": F.col("n"), "odd": none, "few": none})
    judged, found, centers_of = None, posts.select("id", F.col("id").alias("component")).limit(0), 1
    while not held.isEmpty():
        salt = F.pmod(F.xxhash64("id"), F.lit(centers_of))
        centers = held.groupBy("key", salt.alias("salt")).agg(F.min(F.struct(-F.col("weight"), "id", "n", "component", "common", "odd", "few")).alias("center"))
        centers = stored(centers.select("key", F.col("center.id").alias("one"), *[F.col(f"center.{c}").alias(f"one_{c}") for c in ("n", "component", "common", "odd", "few")]), "centers")
        small, large = F.least("n", "one_n"), F.greatest("n", "one_n")
        apart = lambda x, k: sum((F.bit_count(F.get(x, i).bitwiseXOR(F.get(f"one_{x}", i))) for i in range(k)), F.lit(0))
        may = lambda differ: differ * (100 + SIMILARITY) <= (small + large) * (100 - SIMILARITY)
        near = F.col("odd").isNull() | (may(apart("few", FEW)) & may(apart("odd", WORDS)))
        enough = F.least("common", "one_common") * (100 + SIMILARITY) >= (small + large) * SIMILARITY
        pairs = held.join(centers, "key").where((F.col("component") != F.col("one_component")) & (small * 100 >= large * SIMILARITY) & enough & near)
        pairs = pairs.select("one", F.col("id").alias("other")).distinct()
        if judged is not None:
            pairs = pairs.join(judged.select("one", "other"), ["one", "other"], "left_anti")
        new = stored(overlaps(stored(pairs, "pairs"), matrix, many=judged is None), "judged")
        judged = new if judged is None else judged.unionByName(new)
        if not new.where("linked").isEmpty():
            found = components(judged.where("linked").select(F.col("one").alias("a"), F.col("other").alias("b")))
        rest = held.drop("component", "common", "odd", "few").join(centers.select("key", F.col("one").alias("id")), ["key", "id"], "left_anti")
        rest = stored(rest.join(found, "id", "left").withColumn("component", F.coalesce("component", "id")), "rest")
        several = rest.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high")).where(F.col("low") != F.col("high"))
        several = rest.join(several.select("key"), "key").select("key", "id", "n", "weight", "component")
        held = stored(bounded(several, matrix), "open-posts")
        centers_of *= GROWTH
    return found


def jaccard_join(docs: DataFrame, n: int = 4) -> DataFrame:
    """doc_id, n_shingles, component_id of every row."""
    made = stored(rows_of(docs, n), "rows")
    classes = made.where(F.col("n_shingles") > 0).groupBy("print", "n_shingles").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "text_hash")).alias("first"))
    classes = stored(classes.select(F.monotonically_increasing_id().alias("id"), "print", "n_shingles", "first.doc_id", "first.text_hash"), "classes")
    posts = stored(blocks_of(docs, stored(classes.select("id", "doc_id", "text_hash"), "class-rows"), n), "posts")
    release(docs.sparkSession)
    shared = stored(posts.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > 1).select("key"), "shared-keys")
    release(docs.sparkSession)
    live = stored(posts.join(shared, "key").join(classes.select("id", F.col("n_shingles").alias("n")), "id").distinct(), "live-posts")
    discard(posts)
    release(docs.sparkSession)
    wanted = classes.join(live.select("id").distinct(), "id").select("id", "doc_id", "text_hash")
    matrix = stored(incidence(docs, stored(wanted, "wanted-rows"), n), "incidence")
    release(docs.sparkSession)
    found = joined(live, matrix)
    groups = classes.join(found, "id", "left").withColumn("component", F.coalesce("component", "id"))
    names = groups.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    groups = stored(groups.join(names, "component").select("print", "n_shingles", "component_id"), "groups")
    release(docs.sparkSession)
    return made.join(groups, ["print", "n_shingles"], "left").select(
        "doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))
