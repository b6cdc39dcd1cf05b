"""Communities of graphs of any size: moves of labels in rounds over an edge table.

One round gives every node the weight of its links to each neighbouring label, one aggregate, and the labels'
totals, another; half of the nodes, by a seeded coin, then take the label of the largest gain of modularity.
Rounds end when modularity does.  Communities are then refined from single nodes: those whose coin says so join,
along a link, a part that stays, so parts hang together.  Parts become the nodes of the next, smaller graph.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import kept

#: Rounds that are made, and written, at once; pairs of a refinement; gains of modularity with which a level's moves, and the levels, go on.
AT_ONCE, REFINING, STEP, GAIN = 2, 2, 0.005, 1e-4
LEAST_WEIGHT = 1e-9


class _Graph(NamedTuple):
    """edges: grp, a, b, w both ways, loops once with all their weight; nodes: grp, node, k (its links' weight), whole (its group's)."""

    edges: DataFrame
    nodes: DataFrame


def _graph(edges: DataFrame) -> _Graph:
    edges = kept(edges.groupBy("grp", "a", "b").agg(F.sum("w").alias("w")))
    k = edges.groupBy("grp", F.col("a").alias("node")).agg(F.sum("w").alias("k"))
    whole = k.groupBy("grp").agg(F.sum("k").alias("whole"))  # a row a group
    return _Graph(edges, kept(k.join(whole, "grp")))


def modularity(edges: DataFrame, labels: DataFrame, resolution: float = 1.0) -> DataFrame:
    """grp, q.  edges: grp, a, b, w both ways; labels: grp, node, label."""
    of = lambda end, name: labels.select("grp", F.col("node").alias(end), F.col("label").alias(name))
    sums = edges.join(of("a", "la"), ["grp", "a"]).groupBy("grp", "b", "la").agg(F.sum("w").alias("w")).join(of("b", "lb"), ["grp", "b"])
    per = sums.groupBy("grp", F.col("lb").alias("label")).agg(F.sum("w").alias("total"), F.sum(F.when(F.col("la") == F.col("lb"), F.col("w")).otherwise(0.0)).alias("inside"))
    whole = per.groupBy("grp").agg(F.sum("total").alias("whole"))  # a row a group
    share = F.col("inside") / F.col("whole") - resolution * (F.col("total") / F.col("whole")) ** 2
    return per.join(whole, "grp").groupBy("grp").agg(F.sum(share).alias("q"))


def _coin(turn: int):
    """Half of the nodes; the other half in the next round of a pair."""
    return F.pmod(F.xxhash64("node", F.lit(turn // AT_ONCE)) + turn % AT_ONCE, F.lit(2)) == 1


def _round(graph: _Graph, labels: DataFrame, resolution: float, turn: int, inside: DataFrame | None = None) -> DataFrame:
    """grp, node, label after one round; with inside (edges within communities), single nodes join parts that stay."""
    edges = graph.edges.where("a <> b") if inside is None else inside
    nodes = graph.nodes.join(labels, ["grp", "node"]).withColumn("turn", _coin(turn))
    totals = nodes.groupBy("grp", "label").agg(F.sum("k").alias("total"), F.count(F.lit(1)).alias("size"), F.max("turn").alias("leaves"))
    links = edges.join(nodes.select("grp", F.col("node").alias("b"), "label"), ["grp", "b"]).groupBy("grp", F.col("a").alias("node"), "label").agg(F.sum("w").alias("near"))
    own = nodes.select("grp", "node", "label", F.lit(0.0).alias("near"))
    links = links.unionByName(own).groupBy("grp", "node", "label").agg(F.sum("near").alias("near"))
    seen = links.join(totals, ["grp", "label"]).join(nodes.select("grp", "node", F.col("label").alias("own"), "k", "whole", "turn"), ["grp", "node"])
    stays = F.col("label") == F.col("own")
    gain = F.round(F.col("near") - resolution * F.col("k") * (F.col("total") - F.when(stays, F.col("k")).otherwise(0.0)) / F.col("whole"), 12)
    if inside is None:
        able = stays | F.col("turn")
    else:  # a part stays if it has several nodes, or its one node's coin says so
        able = stays | (F.col("turn") & ((F.col("size") > 1) | ~F.col("leaves")))
    order = F.struct(gain, stays, -F.col("label"))
    best = seen.where(able).groupBy("grp", "node").agg(F.max_by("label", order).alias("label"), F.first("own").alias("own"))
    if inside is None:
        return best.select("grp", "node", "label")
    alone = totals.where("size = 1").select("grp", F.col("label").alias("own"), F.lit(True).alias("alone"))
    best = best.join(alone, ["grp", "own"], "left")
    return best.select("grp", "node", F.when(F.col("alone"), F.col("label")).otherwise(F.col("own")).alias("label"))


def _rounds(graph: _Graph, labels: DataFrame, resolution: float, turn: int, inside: DataFrame | None = None) -> DataFrame:
    for k in range(AT_ONCE):
        labels = _round(graph, labels, resolution, turn + k, inside)
    return labels


def _quality(graph: _Graph, labels: DataFrame, resolution: float) -> float:
    return modularity(graph.edges, labels, resolution).agg(F.sum("q")).first()[0] or 0.0


def bulk_communities(edges: DataFrame, group: str, least: int = 3, resolution: float = 1.0) -> DataFrame:
    """group, node, community of each group's weighted graph, -1 in communities of fewer than `least` nodes.

    edges: group, a, b, w; each pair once, or parts of its weight.  A community's number is its least node's.
    All groups go through the same rounds, so neither a group nor a hub has to fit a task.
    """
    w = F.greatest(F.col("w").cast("double"), F.lit(LEAST_WEIGHT))
    one = edges.select(F.col(group).alias("grp"), F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b"), w.alias("w"))
    graph = _graph(one.unionByName(one.select("grp", F.col("b").alias("a"), F.col("a").alias("b"), "w")))
    members = graph.nodes.select("grp", "node", F.col("node").alias("part"))
    if not graph.nodes.limit(1).count():
        return graph.nodes.select(F.col("grp").alias(group), "node", F.col("node").alias("community"))
    labels = graph.nodes.select("grp", "node", F.col("node").alias("label"))
    best, turn = _quality(graph, labels, resolution), 0
    while True:
        before, more = best, True
        while more:
            now, turn = kept(_rounds(graph, labels, resolution, turn)), turn + AT_ONCE
            q = _quality(graph, now, resolution)
            more = q > best + STEP
            if q > best:
                best, labels = q, now
        ends = lambda end, name: labels.select("grp", F.col("node").alias(end), F.col("label").alias(name))  # noqa: B023, E731
        inside = kept(graph.edges.where("a <> b").join(ends("a", "la"), ["grp", "a"]).join(ends("b", "lb"), ["grp", "b"]).where("la = lb").select("grp", "a", "b", "w"))
        parts = graph.nodes.select("grp", "node", F.col("node").alias("label"))
        for _ in range(REFINING):
            parts, turn = kept(_rounds(graph, parts, resolution, turn, inside)), turn + AT_ONCE
        named = kept(parts.join(labels.withColumnRenamed("label", "community"), ["grp", "node"]))
        counts = named.agg(F.count(F.lit(1)).alias("nodes"), F.countDistinct("grp", "label").alias("parts")).first()
        renamed = named.select("grp", F.col("node").alias("part"), F.col("label").alias("new"), "community")
        members = kept(members.join(renamed, ["grp", "part"]).select("grp", "node", F.col("new").alias("part"), "community"))
        if counts.parts == counts.nodes or best - before < GAIN and before > 0:
            break
        to = lambda end, name: named.select("grp", F.col("node").alias(end), F.col("label").alias(name))  # noqa: B023, E731
        smaller = graph.edges.join(to("a", "pa"), ["grp", "a"]).groupBy("grp", "pa", "b").agg(F.sum("w").alias("w")).join(to("b", "pb"), ["grp", "b"])
        graph = _graph(smaller.select("grp", F.col("pa").alias("a"), F.col("pb").alias("b"), "w"))
        # a part's label is the least part of its community: labels are nodes of the graph in work
        least_part = named.groupBy("grp", "community").agg(F.min("label").alias("to"))
        labels = kept(named.select("grp", F.col("label").alias("node"), "community").distinct().join(least_part, ["grp", "community"]).select("grp", "node", F.col("to").alias("label")))
        members = members.drop("community")
    sizes = members.groupBy("grp", "community").agg(F.count(F.lit(1)).alias("size"), F.min("node").alias("name"))
    found = members.join(sizes, ["grp", "community"])
    return found.select(F.col("grp").alias(group), "node", F.when(F.col("size") >= least, F.col("name")).otherwise(-1).alias("community"))
