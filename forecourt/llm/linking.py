"""Connected groups, and links among the members of buckets, without all pairs of a bucket."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forecourt.llm.tables import FEW_IDS
from forecourt.sources.storage import written


def _pairs(a, b) -> list:
    return [F.greatest(a, b).alias("u"), F.least(a, b).alias("v")]


def components(links: DataFrame) -> DataFrame:
    """The smallest id of each id's connected group: links (a, b) of longs give (id, component), the smallest left out.

    Alternating stars: every id hands its larger neighbours to its smallest one, then its smaller ones too, until
    every id hangs on one smallest id. Each round is written, so that a lost executor costs one round. A hub with many
    links is an aggregate that merges before the shuffle and a join whose large partitions Spark splits.
    Links of an id with itself or with null, and repeated links, change nothing; no links give no rows.
    """
    edges = written(links.where("a <> b").select(*_pairs(F.col("a"), F.col("b"))).distinct(), "links")
    while not _stars(edges):
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        lowest = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("low"))
        wide = both.where("v > u").join(lowest, "u").select(F.col("v").alias("u"), F.col("low").alias("v")).distinct()
        least = wide.groupBy("u").agg(F.min("v").alias("low"))
        near = wide.join(least, "u")
        edges = written(near.where("v <> low").select(F.col("v").alias("u"), F.col("low").alias("v"))
                        .union(near.select("u", F.col("low").alias("v"))).distinct(), "stars")
    return edges.select(F.col("u").alias("id"), F.col("v").alias("component"))


def _stars(edges: DataFrame) -> bool:
    """Whether every id has one smaller neighbour, or larger ones only."""
    ends = edges.select(F.col("u").alias("id"), F.lit(1).alias("up"), F.lit(0).alias("down")) \
        .union(edges.select("v", F.lit(0), F.lit(1)))
    return ends.groupBy("id").agg(F.sum("up").alias("up"), F.max("down").alias("down")).where("up > 1 or (up = 1 and down = 1)").isEmpty()


def linked(buckets: DataFrame, confirm: Callable[[DataFrame], DataFrame], near: Callable[[str, str], Column] | None = None,
           across: Callable[[DataFrame], DataFrame] | None = None, prepare: Callable[[DataFrame], None] | None = None,
           seen: list[Column] | None = None, worth: Column | None = None, small: int = 16) -> DataFrame:
    """Groups of ids connected by confirmed pairs within buckets: (id, component), the smallest of a group left out.

    `buckets` has (key, id) without repeats and columns of the id's own, `confirm` keeps the pairs (a, b) that are
    links; `near` is a condition on pairs, given the names of both sides.

    Buckets of at most `small` members give all their pairs. In a larger one each member meets one hub, another one
    in each of its buckets. Of these pairs each id's first one is confirmed, then those between different groups: that
    joins the copies of a text, and pairs of one group need no comparison. Where a large bucket still holds several
    groups, every member outside its largest group meets the members of all other groups. So all pairs of a
    bucket end in one group or are compared, and a bucket costs its outsiders times its size, not its square. `across`
    takes those buckets as (key, id, group, outside) and finds the links of outsiders without a row for each pair.
    `prepare` gets the ids that pairs may have, once, before the first of them is to be confirmed. `worth` is a
    condition on buckets, by aggregates `seen` of their rows and their `crowd`: the others hold no pair that is near.
    """
    own = [c for c in buckets.columns if c not in ("key", "id")]
    # Most buckets hold one id: only the others' rows go on. They are found by their counts, and met by broadcast
    # while they are few.
    shared = buckets.groupBy("key").agg(F.count("*").alias("crowd"), *(seen or [])).where("crowd > 1")
    shared = written((shared if worth is None else shared.where(worth)).select("key", "crowd"), "shared")
    crowded = buckets.join(F.broadcast(shared) if shared.count() <= FEW_IDS else shared, "key")
    crowded = written(crowded.select("key", "id", "crowd", *own), "buckets")
    side = lambda name, rows: rows.select("key", *[F.col(c).alias(f"{c}_{name}") for c in rows.columns if c not in ("key", "crowd")])
    ordered = lambda rows: rows.select(F.least("id_a", "id_b").alias("a"), F.greatest("id_a", "id_b").alias("b")).distinct()
    close = near("a", "b") if near else F.lit(True)
    few, many = crowded.where(F.col("crowd") <= small), crowded.where(F.col("crowd") > small)
    pairs = side("a", few).join(side("b", few), "key").where((F.col("id_a") < F.col("id_b")) & close)
    hubs = many.groupBy("key").agg(F.min_by(F.struct("id", *own), F.xxhash64("id", "key")).alias("hub")).select("key", "hub.*")
    spokes = side("a", many).join(side("b", hubs), "key").where((F.col("id_a") != F.col("id_b")) & close)
    tried = written(ordered(pairs).union(ordered(spokes)).distinct(), "pairs")
    if prepare:
        prepare(tried.select(F.col("a").alias("id")).union(tried.select("b")).union(many.select("id")).distinct())
    first = written(confirm(written(tried.groupBy("b").agg(F.min("a").alias("a")).select("a", "b"), "first")).select("a", "b"), "linked")
    groups = written(components(first), "groups")

    def between(rows: DataFrame, group: DataFrame) -> DataFrame:
        named = lambda n: group.select(F.col("id").alias(n), F.col("component").alias(f"of_{n}"))
        both = rows.join(named("a"), "a", "left").join(named("b"), "b", "left")
        return both.where(F.coalesce("of_a", "a") != F.coalesce("of_b", "b")).select("a", "b")

    second = written(confirm(written(between(tried, groups), "second")).select("a", "b"), "linked")
    known = groups.select(F.col("id").alias("a"), F.col("component").alias("b"))
    if not second.isEmpty():
        groups = written(components(known.union(second)), "groups")
        known = groups.select(F.col("id").alias("a"), F.col("component").alias("b"))
    placed = many.join(groups, "id", "left").select("key", "id", F.coalesce("component", "id").alias("group"), *own)
    sizes = placed.groupBy("key", "group").agg(F.count("*").alias("held"))
    mixed = sizes.groupBy("key").agg(F.max_by("group", "held").alias("largest"), F.count("*").alias("groups")) \
        .where("groups > 1")
    rest = written(placed.join(mixed.select("key", "largest"), "key").withColumn("outside", F.col("group") != F.col("largest")), "mixed")
    if rest.isEmpty():
        return groups
    if across:
        more = across(rest.select("key", "id", "group", "outside")).select("a", "b")
    else:
        left = ordered(side("a", rest.where("outside")).join(side("b", rest), "key").where((F.col("group_a") != F.col("group_b")) & close))
        more = confirm(written(left.join(tried, ["a", "b"], "left_anti"), "across")).select("a", "b")
    more = written(more, "linked")
    return groups if more.isEmpty() else components(known.union(more))
