"""Connected components of links too many for one machine, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstream.session import Scratch, materialize


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return tuple(row)


def _large_star(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node with the least node around it."""
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m"))
    around = both.join(least, "u").where(F.col("v") > F.col("u"))
    return around.select(F.col("v").alias("u"), F.least("u", "m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours with the least of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    others = edges.join(least, "u").where(F.col("v") > F.col("m"))
    moved = others.select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """``(node, component)`` of every node of the links ``(a, b)``; the least node names it.

    Rounds go on until the links are stars that no longer change. Each round writes its links to
    the shared folder, so lineage stays short and a lost executor costs one round. Minima are formed
    before the shuffle; a node with many links only skews a join, which is split at run time.
    """
    edges = links.where(F.col("a") != F.col("b")).select(
        F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")
    )
    with Scratch(links.sparkSession) as scratch:
        edges = scratch.keep(edges.distinct())
        state = _state(edges)
        while state[0]:
            edges = scratch.keep(_small_star(_large_star(edges)))
            before, state = state, _state(edges)
            if state == before:
                break
        stars = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
        roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
        return materialize(stars.union(roots))
