"""Connected components by contraction: distributed union-find in DataFrame joins.

Each round lets every node point to its least neighbour, follows the pointers to the roots, and carries the links that
are left over to the roots. A star, a clique and a chain shrink by at least half a round, so rounds grow with the
logarithm of the longest path. Nothing is collected but one boolean a step. Frames are cut by written tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from storyloom.llm import scratch


def connected_components(spark: SparkSession, links: DataFrame, name: str = "cc") -> DataFrame:
    """links (a, b) of any ordered type -> (id, root): root is the least id that links reach. Ids without links (and
    links with a null end or with both ends equal) give no row; an empty frame gives an empty one."""
    with scratch.scope(spark) as kept:
        return kept(_contract(spark, links, name))


def _contract(spark: SparkSession, links: DataFrame, name: str) -> DataFrame:
    keep = lambda df, what: scratch.save(spark, df, f"{name}-{what}")
    edges = keep(links.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links")
    found = None
    while True:
        both = edges.select(F.col("a").alias("v"), F.col("b").alias("n")).union(edges.select("b", "a"))
        parent = keep(both.groupBy("v").agg(F.min("n").alias("n")).select("v", F.least("v", "n").alias("p")), "parent")
        if found is not None and parent.isEmpty():
            return found
        while True:
            up = parent.select(F.col("v").alias("p"), F.col("p").alias("pp"))
            jumped = keep(parent.join(up, "p").select("v", F.col("pp").alias("p"), (F.col("pp") != F.col("p")).alias("moved")), "jump")
            parent = jumped.select("v", "p")
            if jumped.where("moved").isEmpty():
                break
        if found is None:
            found = keep(parent.select(F.col("v").alias("id"), F.col("p").alias("root")), "found")
        else:
            to = parent.select(F.col("v").alias("root"), "p")
            found = keep(found.join(to, "root", "left").select("id", F.coalesce("p", "root").alias("root")), "found")
        pa, pb = parent.select(F.col("v").alias("a"), F.col("p").alias("x")), parent.select(F.col("v").alias("b"), F.col("p").alias("y"))
        rest = edges.join(pa, "a").join(pb, "b").where("x <> y")
        edges = keep(rest.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), "links")
