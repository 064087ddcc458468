"""Connected components of a graph of links by alternating large-star and small-star."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import spool


def least_of(edges: DataFrame) -> DataFrame:
    """u, m: the smallest of each node and its neighbours v."""
    return edges.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))


def with_least(edges: DataFrame) -> DataFrame:
    """u, v, m. A node with very many neighbours is a skewed key of a plain join, which is split at run time."""
    return edges.join(least_of(edges), "u")


def large_star(edges: DataFrame) -> DataFrame:
    """Every node links its larger neighbours to the smallest node that it sees."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return with_least(both).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()


def small_star(edges: DataFrame) -> DataFrame:
    """Every node links its smaller neighbours, and itself, to the smallest of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    seen = with_least(down)
    mine = least_of(down).select("u", F.col("m").alias("v"))
    return seen.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(mine).filter("u <> v").distinct()


def components(links: DataFrame) -> DataFrame:
    """node, component (its smallest reachable node) for every node of `links` (columns u, v).

    Links may repeat, run either way, or lead from a node to itself (such a node alone has no
    row). Rows with a null end are no links. Each round is written to the shared folder; rounds grow
    with the logarithm of the longest path.
    """
    edges = links.select("u", "v").filter("u is not null and v is not null and u <> v").distinct()
    edges = spool(edges, "links")
    mark = lambda e: e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    before = mark(edges)
    while before[0]:
        edges = spool(small_star(large_star(edges)), "star")
        now = mark(edges)
        if now == before:
            break
        before = now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
