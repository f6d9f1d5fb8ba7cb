"""Connected components of a table of links, by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from schoolyard.llm.common import gathered


def _smallest_beside(edges: DataFrame) -> DataFrame:
    """For every edge (u, v) also m, the smallest node among u and its neighbours.

    A minimum per u is made map-side first and joined back, so that a node with very many
    links is split by adaptive execution instead of meeting in one task.
    """
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    least = least.select(F.col("u").alias("w"), F.least("u", "m").alias("m"))
    return edges.join(least, F.col("u") == F.col("w")).select("u", "v", "m")


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    seen = _smallest_beside(both).filter("v > u")
    return seen.select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    seen = _smallest_beside(down)
    to_least = seen.select(F.col("v").alias("u"), F.col("m").alias("v"))
    own = seen.select("u", F.col("m").alias("v"))
    return to_least.union(own).filter("u <> v").distinct()


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node with a link to another; root is the smallest node reachable.

    `links` are undirected, of one comparable type, repeats and self-links allowed; links with
    a null end are left out. Each round is written to the checkpoint folder. The number of
    rounds grows with the logarithm of the longest path.
    """
    edges = gathered(
        links.filter(F.col(a) != F.col(b))
        .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .distinct()
    )
    before = None
    while True:
        edges = gathered(_small_star(_large_star(edges)))
        state = edges.agg(
            F.count(F.lit(1)).alias("n"),
            F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("digest"),
        ).first()
        if state == before or not state["n"]:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
                edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
            )
        before = state
