"""Connected components of a link table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardflow.llm.common import written


def _both_ways(links: DataFrame) -> DataFrame:
    return links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Link the neighbours of each node to the smallest of them and the node itself.

    ``large`` keeps the neighbours above the node, the small step those below (and the node). The
    smallest neighbours are a written table that the edges are joined with, so the edges of a
    node with a great many neighbours can be split over tasks.
    """
    if large:
        near = _both_ways(edges)
        low = written(near.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")),
                      "low", True)
        out = near.join(low, "a").where("b > a").select("b", "m")
    else:
        near = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        low = written(near.groupBy("a").agg(F.min("b").alias("m")), "low", True)
        out = near.join(low, "a").select("b", "m").union(low.select(F.col("a").alias("b"), "m"))
    return out.where("b <> m").select(
        F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _state(edges: DataFrame):
    return edges.agg(F.count("a").alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("x"),
                     F.countDistinct("a").alias("nodes")).first()


def components(links: DataFrame, rounds: int = 60) -> DataFrame:
    """``(node, component)`` for every node of ``links(a, b)``; the component is its smallest node.

    Ends when a round changes nothing and every node is linked to one other, its smallest. Each
    step is written to the shared folder. Links with a null end and loops are left out; an empty
    link table gives an empty result. ``rounds`` only guards against a bug: the number needed
    grows with the logarithm of the longest chain, and running out raises.
    """
    edges = written(
        links.select("a", "b").where("a <> b").select(
            F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
        "links", True)
    before = None
    for _ in range(rounds):
        now = _state(edges)
        if tuple(now) == before or not now["n"]:
            break
        # A star joined back to nothing but its centers does not change any more.
        chained = edges.join(edges.select(F.col("a").alias("b")), "b", "left_semi")
        if now["n"] == now["nodes"] and chained.isEmpty():
            break
        before = tuple(now)
        edges = written(_star(written(_star(edges, True), "large", True), False), "small", True)
    else:
        raise RuntimeError("components did not converge")
    up = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    centers = edges.select(F.col("b").alias("node"), F.col("b").alias("component"))
    return up.union(centers.distinct())
