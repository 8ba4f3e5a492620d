"""Connected groups of similar items, without ever pairing all members of a group of candidates.

Items are posted under keys (shared signature values); items under one key are candidates of each other. Two passes:

1. Star: under every key each item is compared with the key's center, the item of the greatest ``weight`` (then the smallest).
   Pairs that match and are confirmed join. The weight should favour the original of a group of copies.
2. Rest: only keys of three or more items that still lie in different components are looked at again; there every item outside the
   key's largest component is compared with all items of other components. So no matching pair between components
   goes unchecked, while a large group of copies, one component after the first pass, costs one pair per copy. With
   ``near`` given, all items of such a key, if it has ``HUB_FROM`` or more, are first confirmed against the hub of its largest component, the item of the
   greatest weight; what that tells of two items' differences from it can rule out the pair. With ``span`` given, the items of
   such a key are compared within neighbouring spans only; with ``sketch`` given, pairs are told apart where they meet, before
   they are written.

Components come from repeated minimum labels over stored tables; what the second pass links joins whole components of the first. All steps are DataFrame operations; keys with very many
items are joins that Spark splits where skewed, or aggregates with partial sums.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import discard, stored

HUB_FROM = 64
#: Longest method in bytes that the JVM compiles. What compares two items makes one that is longer, and so interpreted, if Spark
#: generates code for a whole join; beyond this limit Spark generates code for the comparison alone, in methods of its own.
METHOD_BYTES = "spark.sql.codegen.hugeMethodLimit", 8000


@contextmanager
def _compiled(spark: SparkSession) -> Iterator[None]:
    """Within this, joins whose code is too long to be compiled as a whole are done piece by piece."""
    key, most = METHOD_BYTES
    was = spark.conf.get(key, None)
    spark.conf.set(key, most)
    try:
        yield
    finally:
        spark.conf.unset(key) if was is None else spark.conf.set(key, was)


def components(links: DataFrame) -> DataFrame:
    """id, component for every item of links (a, b): the smallest item that it reaches.

    Each round points every item at the smallest label among itself and its neighbours' labels, then at that item's
    own label, so long chains halve; it ends when a round changes nothing.
    """
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).where(F.col("a") != F.col("b"))
    edges = stored(both.distinct(), "edges")
    labels = stored(edges.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("component")).withColumnRenamed("a", "id"), "labels")
    while True:
        jump = labels.select(F.col("id").alias("component"), F.col("component").alias("further"))
        pointed = labels.join(jump, "component", "left").select("id", F.coalesce("further", "component").alias("component"))
        near = edges.join(pointed.withColumnRenamed("id", "a"), "a").groupBy(F.col("b").alias("id")).agg(F.min("component").alias("near"))
        new = stored(pointed.join(near, "id").join(labels.withColumnRenamed("component", "old"), "id").select(
            "id", F.least("component", "near").alias("component"), "old"), "labels")
        if new.where(F.col("component") != F.col("old")).isEmpty():
            return new.select("id", "component")
        labels = new.select("id", "component")


def _pairs(pairs: DataFrame, label: str, known: DataFrame | None = None) -> DataFrame:
    """Each pair (one, other, hint) once, as stored columns a < b besides; without those already judged."""
    ordered = pairs.withColumns({"a": F.least("one", "other"), "b": F.greatest("one", "other")})
    once = ordered.groupBy("a", "b").agg(F.min(F.struct("hint", "one", "other")).alias("p")).select("a", "b", "p.*")
    return stored(once if known is None else once.join(known.select("a", "b"), ["a", "b"], "left_anti"), label)


def _merged(found: DataFrame, more: DataFrame) -> DataFrame:
    """The components ``found`` after further links (a, b), followed between whole components."""
    of = lambda x: found.select(F.col("id").alias(x), F.col("component").alias(f"{x}_component"))
    lifted = more.join(of("a"), "a", "left").join(of("b"), "b", "left").select(F.coalesce("a_component", "a").alias("a"), F.coalesce("b_component", "b").alias("b"))
    top = components(lifted)
    moved = found.join(top.select(F.col("id").alias("component"), F.col("component").alias("further")), "component", "left")
    new = top.join(found.select("id"), "id", "left_anti")  # items that had no link before
    return stored(moved.select("id", F.coalesce("further", "component").alias("component")).unionByName(new), "components")


def linked(posts: DataFrame, match: Callable[[Column, Column], Column], confirm: Callable[[DataFrame, bool], DataFrame],
           near: Callable[[Column, Column, Column, Column], Column] | None = None, span: Callable[[Column], Column] | None = None,
           sketch: Callable[[DataFrame], DataFrame] | None = None, apart: Callable[[Column, Column], Column] | None = None,
           confirm_rest: Callable[[DataFrame, bool], DataFrame] | None = None) -> DataFrame:
    """id, component of items that are linked with another one.

    ``posts`` has key, id, weight and a struct ``item`` that ``match`` compares; it is read several times, so it should come
    from a stored table. ``confirm`` returns every pair (a, b), a < b, that it is given with ``linked`` and ``gap``, anything
    about the difference of the two (only if its second argument says so); it is also given which of them is ``one`` and which ``other``, and a ``hint``: pairs of
    equal hint have many items in common. ``near(item, gap, other item, other gap)`` may say false for two items that their gaps
    to a common center show to be no link. ``span(item)`` is a whole number that differs by 1 at most between items of a link.
    ``sketch`` returns id and sketch for a table of ids, those of the second pass, and ``apart(sketch, other sketch)`` may say
    true for two items that are no link. ``confirm_rest`` takes the place of ``confirm`` in the second pass, where few pairs are links.
    """
    centers = posts.groupBy("key").agg(F.min(F.struct(-F.col("weight"), "id", "item")).alias("center"), F.count("*").alias("n"))
    centers = stored(centers.where(F.col("n") > 1).select("key", "center"), "centers")
    star = posts.join(centers, "key").where((F.col("id") != F.col("center.id")) & match(F.col("item"), F.col("center.item")))
    judged = stored(confirm(_pairs(star.select(F.col("center.id").alias("one"), F.col("id").alias("other"), F.col("center.id").alias("hint")), "star"), near is not None), "star-judged")
    found = components(judged.where("linked").select("a", "b"))

    tagged = posts.join(found, "id", "left").withColumn("component", F.coalesce("component", "id"))
    per = tagged.groupBy("key", "component").agg(F.count("*").alias("n"))
    mixed = per.groupBy("key").agg(F.max(F.struct("n", "component")).alias("most"), F.count("*").alias("kinds"), F.sum("n").alias("n"))
    mixed = mixed.where((F.col("kinds") > 1) & (F.col("n") > 2)).select("key", "n", F.col("most.component").alias("main"))
    more = None
    if near is None:
        open_posts = stored(tagged.join(stored(mixed, "mixed"), "key").withColumn("gap", F.lit(None).cast("boolean")), "open-posts")
    else:
        hubs = tagged.groupBy("component").agg(F.max_by("id", F.struct("weight", -F.col("id"))).alias("hub"))
        mixed = mixed.join(hubs.withColumnRenamed("component", "main"), "main")
        mixed = stored(mixed.withColumn("hub", F.when(F.col("n") >= HUB_FROM, F.col("hub"))), "mixed")
        open_posts = stored(tagged.join(mixed, "key").select("key", "id", "item", "component", "main", "hub", "n"), "open-posts")
        to_hub = open_posts.where(F.col("id") != F.col("hub")).select(F.col("hub").alias("one"), F.col("id").alias("other"), F.col("hub").alias("hint"))
        hub_judged = stored(confirm(_pairs(to_hub, "hubs", judged), True), "hub-judged")
        more = hub_judged.where("linked").select("a", "b")
        judged = judged.unionByName(hub_judged)
        gaps = judged.select("a", "b", "gap").where(F.col("gap").isNotNull())
        open_posts = stored(open_posts.withColumns({"a": F.least("id", "hub"), "b": F.greatest("id", "hub")}).join(gaps, ["a", "b"], "left").select(
            "key", "id", "item", "component", "main", "n", F.when(F.col("hub").isNotNull(), F.col("gap")).alias("gap")), "open-posts")
    if sketch is not None:
        plain = open_posts
        open_posts = stored(plain.join(sketch(plain.select("id").distinct()), "id"), "sketched-posts")
        discard(plain)
    else:
        open_posts = open_posts.withColumn("sketch", F.lit(None).cast("boolean"))
    spans = F.lit(0) if span is None else F.when(F.col("n") >= HUB_FROM, span(F.col("item"))).otherwise(F.lit(0))
    reach = F.array(F.col("span")) if span is None else F.when(F.col("n") >= HUB_FROM, F.array(*[F.col("span") + k for k in (-1, 0, 1)])).otherwise(F.array("span"))
    open_posts = open_posts.withColumn("span", spans)
    few = open_posts.where(F.col("component") != F.col("main")).select("key", F.explode(reach).alias("span"), *[F.col(c).alias(f"a_{c}") for c in ("id", "item", "component", "gap", "sketch")])
    ruled_out = F.lit(False)
    if near is not None:
        ruled_out = F.coalesce(~near(F.col("a_item"), F.col("a_gap"), F.col("item"), F.col("gap")), F.lit(False))
    if apart is not None:
        ruled_out = ruled_out | apart(F.col("a_sketch"), F.col("sketch"))
    pairs = few.join(open_posts, ["key", "span"]).where(
        (F.col("a_component") != F.col("component")) & ((F.col("component") == F.col("main")) | (F.col("a_id") < F.col("id")))
        & match(F.col("a_item"), F.col("item")) & ~ruled_out)
    with _compiled(posts.sparkSession):
        rest = _pairs(pairs.select(F.col("a_id").alias("one"), F.col("id").alias("other"), F.col("main").alias("hint")), "rest", judged)
    if not rest.isEmpty():
        linked_rest = stored((confirm_rest or confirm)(rest, False).where("linked").select("a", "b"), "rest-linked")  # read from both ends of a link
        more = linked_rest if more is None else more.union(linked_rest)
    return found if more is None else _merged(found, more)
