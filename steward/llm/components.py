"""Connected components of a graph held as an edge table, by alternating stars.

Each round turns every node towards the smallest neighbour it knows, first for larger neighbours, then for smaller ones,
until each component is a star around its smallest node. Rounds are few (logarithmic in practice), each a constant number
of joins and combining aggregates; a hub's edges are spread by adaptive skew splitting, as only one row of the other side
belongs to it. Every round is written to the shared scratch folder, so lost executors cost a round at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from steward.session import stored


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m"))
    return (
        both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.least("a", "m").alias("b")).distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """``edges`` have the larger node in ``a``."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    turned = edges.join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return turned.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def _is_stars(edges: DataFrame) -> bool:
    """Whether every node has one smaller neighbour at most, which has none itself."""
    seen = edges.select(F.col("a").alias("x"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(
        edges.select(F.col("b").alias("x"), F.lit(0).alias("up"), F.lit(1).alias("down"))
    )
    odd = seen.groupBy("x").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return odd.filter("up > 1 OR (up = 1 AND down = 1)").isEmpty()


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, root)`` for every node of an edge, ``root`` being the smallest node it is connected to.

    Edges are undirected and may repeat; loops and edges with a null end are ignored, so a node with no other edge is left
    out, and a table without edges gives an empty result.
    """
    pair = edges.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b"), (F.col(a) != F.col(b)).alias("real"))
    stars = stored(pair.filter("real").select("a", "b").distinct(), "edges")
    while not _is_stars(stars):
        stars = stored(_small_star(_large_star(stars)), "stars")
    roots = stars.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return stars.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
