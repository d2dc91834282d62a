"""Connected components of an undirected graph given by its links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from replicheck.sources import Workspace


def components(links: DataFrame, ws: Workspace) -> DataFrame:
    """``(node, root)`` for every node that ``links`` ``(a, b)`` names; the root is the smallest
    node reachable.

    Large and small stars by turns: a round ties each node's larger (then smaller) neighbours
    to the smallest node it knows, until no link changes. Each round is staged, so its plan
    starts from a table; the number of rounds grows with the logarithm of the graph's width.
    """
    edges = ws.stage(
        links.filter("a <> b")
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct(),
        "links",
    )
    seen = None
    while True:
        print_of = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if print_of == seen:
            break
        seen = print_of
        edges = ws.stage(_small_star(_large_star(edges)), "links")
    roots = edges.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("root"))
    return roots.union(edges.select("v", "v").distinct())


def _both(edges: DataFrame) -> DataFrame:
    return edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _large_star(edges: DataFrame) -> DataFrame:
    """(v, m) for each neighbour v > u of u, where m is the smallest of u and its neighbours."""
    near = _both(edges)
    low = near.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return (
        near.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """(v, m) for u and each smaller neighbour v, where m is the smallest of those."""
    low = edges.groupBy("u").agg(F.min("v").alias("m"))
    tied = edges.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return tied.union(low.select("u", F.col("m").alias("v"))).filter("u <> v").distinct()
