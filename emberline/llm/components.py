"""Connected components of a graph of links, in DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberline.llm.lineage import cut, parts


def _large_star(edges: DataFrame, n: int) -> DataFrame:
    """Links each larger neighbour of a node to the least of the node and its neighbours."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
    return both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).coalesce(n).distinct()


def _small_star(edges: DataFrame, n: int) -> DataFrame:
    """Links a node and its smaller neighbours to the least of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    joined = edges.join(least, "a")
    return joined.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b"))).coalesce(n).distinct()


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, component`` for every node of a link: the least node that can be reached.

    Large-star and small-star steps in turn, each written before the next, until all links
    lead to ends that lead nowhere and no node has two; groups are counted before they are
    shuffled, and no neighbourhood is gathered in one row. Loops, repeated links and nulls do
    no harm; nodes with loops only are left out. Steps take as many tasks as the links ask for.
    """
    edges = links.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).where("a <> b").distinct()
    edges = cut(edges)
    n = parts(edges.count())
    while True:
        edges = edges.coalesce(n)
        ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(edges.select(F.col("b").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")))
        ends = ends.groupBy("node").agg(F.sum("up").alias("up"), F.sum("down").alias("down")).coalesce(n)
        count, bad = ends.agg(F.sum("up"), F.sum(F.expr("int(up > 1 or (up > 0 and down > 0))"))).first()
        if not bad:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
        n = parts(count)
        edges = cut(_small_star(_large_star(edges, n).coalesce(n), n).coalesce(n))
