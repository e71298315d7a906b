"""Connected components of links between documents, as joins and groupings only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitchflow.llm.common import dropped, staged


def _sign(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.coalesce(F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.lit(0))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the node's smallest neighbour (or itself)."""
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select("b", "a"))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").filter("v <> m").select(F.col("v").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select(F.col("u").alias("a"), F.col("m").alias("b"))).distinct()


def connected_components(links: DataFrame) -> DataFrame:
    """(node, component) of every node of the links (a, b): component is the smallest node it reaches.

    Large-star and small-star steps in turn until the edges stay as they are, each step written to the shared
    folder. A node with very many links is summed up before its shuffle. Links in either direction, repeated
    links and loops are allowed; rows with a NULL count for nothing; without links there is no row.
    """
    ends = links.select("a", "b").dropna()
    edges = staged(ends.filter("a <> b").distinct(), "edges")
    sign = _sign(edges)
    while sign[0]:
        large = staged(_large_star(edges), "edges")
        dropped(edges)
        edges = staged(_small_star(large), "edges")
        dropped(large)
        before, sign = sign, _sign(edges)
        if sign == before:
            break
    nodes = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    roots = edges.select("b").distinct().select(F.col("b").alias("node"), F.col("b").alias("component"))
    found = staged(nodes.union(roots), "components")
    dropped(edges)
    return found
