"""Connected components of a graph given by its links, by alternating star joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from perilframe.llm.common import staged


def connected_components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links(a, b)``, whole numbers; root is the component's
    smallest node. Links to oneself, repeated links and links with a null side change nothing.

    Each round hangs the larger neighbours of every node, then its smaller ones, on the smallest
    node it knows. A round is two grouped minima, each joined back on the node; the number of
    rounds grows with the logarithm of the longest chain. Neighbours are never gathered, so a node
    with very many of them is a hot join key, which adaptive execution splits.
    """
    edges = (
        links.select(F.least("a", "b").alias("u"), F.greatest("a", "b").alias("v"))
        .where("a is not null and b is not null and a <> b")
        .distinct()
    )
    edges = staged(edges)
    before = _mark(edges)
    while before[0]:
        edges = staged(_small_star(_large_star(edges)))
        after = _mark(edges)
        if after == before:
            break
        before = after
    root = edges.select(F.col("u").alias("node"), F.col("u").alias("root")).distinct()
    return edges.select(F.col("v").alias("node"), F.col("u").alias("root")).union(root)


def _mark(edges: DataFrame) -> tuple:
    """Equal for equal sets of links."""
    row = edges.agg(
        F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
    ).first()
    return tuple(row)


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select("v", "u"))
    least = both.groupBy("u").agg(F.min("v").alias("m"))
    return (
        both.where("v > u")
        .join(least, "u")
        .select(F.least("u", "m").alias("u"), "v")
        .distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("v").agg(F.min("u").alias("m"))
    hung = edges.join(least, "v").select(F.col("m").alias("u"), F.col("u").alias("v"))
    return hung.where("u <> v").union(least.select(F.col("m").alias("u"), "v")).distinct()
