"""Connected components of an edge table, and of the members of buckets, in rounds of joins and aggregations."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One step of the alternating star method on edges (a, b) with a < b.

    Large star: every node's larger neighbours are tied to its least neighbour, itself included. Small star: a
    node and its smaller neighbours are tied to the least of them. Both keep the components. The least neighbour
    is an aggregation (combined before its shuffle); the join with it can be split by adaptive execution.
    """
    if large:
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionAll(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        # a larger neighbour of u is the b of an edge with a = u; a node whose neighbours are all larger has itself as least
        tied = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).join(least, "u").select(F.col("m").alias("a"), F.col("v").alias("b"))
    else:
        least = edges.groupBy("b").agg(F.min("a").alias("m"))
        joined = edges.join(least, "b")
        tied = joined.select(F.col("m").alias("a"), "b").unionAll(joined.where(F.col("a") != F.col("m")).select(F.col("m").alias("a"), F.col("a").alias("b")))
    return tied.where(F.col("a") != F.col("b")).distinct()


def _settled(edges: DataFrame) -> bool:
    """Whether edges (a, b) are stars: no node hangs on two others, and none that hangs on another has nodes of its own."""
    ends = edges.select(F.col("a").alias("v"), F.lit(0).alias("hangs")).unionAll(edges.select(F.col("b").alias("v"), F.lit(1).alias("hangs")))
    nodes = ends.groupBy("v").agg(F.sum("hangs").alias("on"), F.count(F.lit(1)).alias("n"))
    return nodes.where("on > 1 or (on = 1 and n > 1)").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """(id, component) for every node of ``edges`` (a, b); the component is its least node.

    Edges shrink to stars around the least nodes; a table per round is written to the shared folder, and the rounds
    end when there are only stars, which edges to a least node often are from the start.
    """
    now = edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a <> b").distinct()
    now = materialize(now, "edges")
    while not _settled(now):
        now = materialize(_star(_star(now, True), False), "edges")
    return now.select(F.col("b").alias("id"), F.col("a").alias("component")).unionAll(
        now.select(F.col("a").alias("id"), F.col("a").alias("component")).distinct()
    )


def joined(labels: DataFrame, links: DataFrame) -> DataFrame:
    """(id, component) after ``links`` (a, b) are added to components found before: only their components are joined, so
    what the earlier links gave is not worked out again. Stored."""
    ids = links.select(F.col("a").alias("id")).unionAll(links.select(F.col("b").alias("id"))).distinct()
    new = ids.join(labels.select("id"), "id", "left_anti").select("id", F.col("id").alias("component"))
    known = materialize(labels.unionAll(new), "known")
    ends = known.select(F.col("id").alias("x"), "component")
    edges = links.join(ends, F.col("a") == F.col("x")).select(F.col("component").alias("a"), "b")
    edges = edges.join(ends, F.col("b") == F.col("x")).select("a", F.col("component").alias("b"))
    moved = components(edges).select(F.col("id").alias("component"), F.col("component").alias("to"))
    return materialize(known.join(moved, "component", "left").select("id", F.coalesce("to", "component").alias("component")), "labels")


def shared_buckets(rows: DataFrame) -> DataFrame:
    """``rows`` (key, id, ...) of the keys that several ids have, stored."""
    shared = rows.groupBy("key").agg(F.min("id").alias("lo"), F.max("id").alias("hi")).where("lo <> hi").select("key")
    return materialize(rows.join(shared, "key"), "members")


#: In each later round, one member in so many is offered against all of its bucket.
ROUNDS = (64, 8, 1)


def linked_members(members: DataFrame, confirm: Callable[[DataFrame], DataFrame], may_link: Callable[[str, str], Column],
                   refine: Callable[[DataFrame], tuple] | None = None, closer: tuple[Callable[[DataFrame], DataFrame], Callable[[str, str], Column]] | None = None,
                   few: int = 0) -> DataFrame:
    """(id, component) of the members that links reach, where two members of one bucket are linked if ``confirm``
    keeps their pair. ``members`` has (key, id, n) without repeated rows, n the size that ``may_link`` compares;
    ``confirm`` takes pairs (a, b) and returns those that hold.

    Every bucket first offers its members against its least one. Then buckets that still hold several components
    offer a growing part of their members against those of other components, until each pair of a bucket was
    offered or lies within one component. A large group of alike members so costs one pair per member, not all
    pairs, and no link between components is missed. ``refine`` may give narrower buckets, in which all links
    meet as well, for the members (id) of the mixed ones, with a ``confirm`` and ``may_link`` of their own; it keeps
    large buckets whose members are unlike apart. Buckets of up to ``few`` members offer the rest of their pairs before it,
    at most half of ``few`` a member. ``closer`` describes the members that are left then, (key, id, n, c) with an n
    of its own, and has the ``may_link`` for it that the later rounds go by: what is too wide to go with every row of every
    bucket.
    """
    labels = materialize(components(materialize(_least_pairs(members, confirm, may_link), "links")), "labels")
    rest = _mixed(members, labels)
    if few and not rest.isEmpty():
        rest, pairs = _few(rest, few, may_link)
        labels = joined(labels, materialize(confirm(pairs), "links"))
        rest = _mixed(rest, labels)
    if refine and not rest.isEmpty():
        members, confirm, may_link = refine(rest.select("id").distinct())
        members = materialize(members, "refined")
        labels = joined(labels, materialize(_least_pairs(members, confirm, may_link), "links"))
        rest = _mixed(members, labels)
    if closer and not rest.isEmpty():
        describe, may_link = closer
        rest = materialize(describe(rest), "closer")
    for part in ROUNDS:
        if rest.isEmpty():
            break
        chosen = F.pmod(F.xxhash64("id"), F.lit(part)) == 0
        offered = rest.where(chosen).select("key", F.col("id").alias("a"), F.col("n").alias("n_a"), F.col("c").alias("c_a")).join(rest, "key")
        once = (F.col("a") < F.col("id")) | ~chosen  # a pair of two chosen members is met from its lesser side
        offered = offered.where((F.col("c_a") != F.col("c")) & once & may_link("n_a", "n"))
        more = materialize(confirm(offered.select("a", F.col("id").alias("b")).distinct()), "links")
        if not more.isEmpty():
            labels = joined(labels, more)
        rest = _mixed(rest.where(~chosen).select("key", "id", "n"), labels)
    return labels


def _least_pairs(members: DataFrame, confirm, may_link) -> DataFrame:
    """Confirmed pairs of each bucket's least member with the others."""
    least = members.groupBy("key").agg(F.min(F.struct("id", "n")).alias("lo"), F.max("id").alias("hi")).where("lo.id <> hi")
    met = members.join(least.select("key", F.col("lo.id").alias("lo"), F.col("lo.n").alias("lo_n")), "key")
    met = met.where(F.col("id") != F.col("lo")).where(may_link("n", "lo_n"))
    return confirm(met.select(F.col("lo").alias("a"), F.col("id").alias("b")).distinct())


def _few(rest: DataFrame, few: int, may_link) -> tuple[DataFrame, DataFrame]:
    """The members (key, id, n) of buckets above ``few``, and the pairs of the others between components, without those of
    a bucket's least member, which have been offered."""
    sizes = rest.groupBy("key").agg(F.count(F.lit(1)).alias("size"), F.min("id").alias("least")).where("size > 2")
    sized = materialize(rest.join(sizes, "key"), "sized")
    others = sized.where((F.col("size") <= few) & (F.col("id") != F.col("least"))).drop("size", "least")
    pairs = others.select("key", F.col("id").alias("a"), F.col("n").alias("n_a"), F.col("c").alias("c_a")).join(others, "key")
    pairs = pairs.where((F.col("a") < F.col("id")) & (F.col("c_a") != F.col("c")) & may_link("n_a", "n"))
    return sized.where(F.col("size") > few).select("key", "id", "n"), pairs.select("a", F.col("id").alias("b")).distinct()


def _mixed(members: DataFrame, labels: DataFrame) -> DataFrame:
    """Members, with their component c, of the buckets that hold several."""
    labelled = members.join(labels, "id", "left").select("key", "id", "n", F.coalesce("component", "id").alias("c"))
    mixed = labelled.groupBy("key").agg(F.min("c").alias("c0"), F.max("c").alias("c1")).where("c0 <> c1").select("key")
    return materialize(labelled.join(mixed, "key"), "mixed")
