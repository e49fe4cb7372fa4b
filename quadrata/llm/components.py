"""Connected components of any number of links, by DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quadrata.session import cut_lineage


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root) for every node of ``links``: the smallest node that can be reached.

    Alternates two steps until nothing changes: every node sends its larger neighbours to its smallest one, then its smaller
    neighbours and itself. Minima are folded before they are shuffled and joined back, so no task lists a node's neighbours.
    Null ends are ignored; a self link names its node. Nodes may be of any type with an order.
    """
    pairs = links.select(F.col(a).alias("u"), F.col(b).alias("v")).dropna()
    nodes = pairs.select("u").unionByName(pairs.select(F.col("v").alias("u"))).distinct()
    edges = cut_lineage(_directed(pairs))
    state = _state(edges)
    while state[0]:
        edges = cut_lineage(_small_star(_large_star(edges)))
        now = _state(edges)
        if now == state:
            break
        state = now
    roots = edges.groupBy("u").agg(F.min("v").alias("v"))
    return nodes.join(roots, "u", "left").select(F.col("u").alias("node"), F.coalesce("v", "u").alias("root"))


def _directed(pairs: DataFrame) -> DataFrame:
    """Each link once, from its larger to its smaller end."""
    return pairs.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()


def _state(edges: DataFrame) -> tuple:
    """How many links, and a sum that changes with any of them."""
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    lowest = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(lowest, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    lowest = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(lowest, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
    return moved.unionByName(lowest.select("u", F.col("m").alias("v"))).distinct()
