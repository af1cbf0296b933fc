"""Connected components of a graph whose links are spread over the cluster."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


#: Links of a node from which it is hot, and half the number of hot nodes at most (more links make fewer nodes hot).
HOT_LINKS, HOT_NODES = 200, 50_000


def with_least(rows: DataFrame, least: DataFrame, links: int) -> DataFrame:
    """rows (a, b) with m of least (a, m, n links; twice ``links`` in all).

    Nodes of more links than max(HOT_LINKS, links / HOT_NODES) number 2 * HOT_NODES at most: these are broadcast, so that
    their rows stay where they are. All others are joined by node, where no node has more rows than that.
    """
    most = max(HOT_LINKS, links // HOT_NODES)
    hot, cold = least.where(F.col("n") > most).select("a", "m"), least.where(F.col("n") <= most).select("a", "m")
    seen = rows.join(F.broadcast(hot), "a", "left")
    return seen.where("m IS NOT NULL").select("a", "b", "m").union(seen.where("m IS NULL").drop("m").join(cold, "a").select("a", "b", "m"))


def components(links: DataFrame) -> DataFrame:
    """node and root, the smallest node reachable, of each node of links (a, b: long) but the roots themselves.

    Rounds of large star and small star: each node hands its smallest neighbour to its larger neighbours, then to its
    smaller ones. A round is two aggregations by node and joins to them; the number of rounds grows with the logarithm of the
    graph. Each round is written to the shared folder. No group of links is gathered: minima are taken in tasks first,
    and a hot node's links are not shuffled by node. Nulls link nothing; an empty table has no components.
    """
    edges = links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges, before = written(edges, "links"), None
    while True:
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        if state == before or not state[0]:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = state
        up = edges.select(F.col("b").alias("a"), F.col("a").alias("b"))
        least = edges.union(up).groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("n")).select("a", F.least("a", "m").alias("m"), "n")
        large = with_least(up, least, state[0]).select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", "m"))
        large = written(large.where("a <> b").distinct(), "large-star")
        least = large.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("n"))
        small = with_least(large, least, state[0]).where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", "m"))
        edges = written(small.where("a <> b").distinct(), "small-star")
