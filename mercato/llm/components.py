"""Connected components by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato.session import materialise

MOST_ROUNDS = 100  # rounds grow with the logarithm of the longest path; reaching this is an error, not an end


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node points to the least of the node and its neighbours."""
    both = edges.select("src", "dst").union(edges.select("dst", "src")).toDF("node", "other")
    least = both.groupBy("node").agg(F.min("other").alias("least")).select("node", F.least("node", "least").alias("least"))
    least = materialise(least, "least")  # written, so that the edges of a hub can be split in the join
    return both.filter("other > node").join(least, "node").select(F.col("other").alias("src"), F.col("least").alias("dst"))


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours point to the least of these."""
    down = edges.select(F.greatest("src", "dst").alias("node"), F.least("src", "dst").alias("other"))
    least = materialise(down.groupBy("node").agg(F.min("other").alias("least")), "least")
    moved = down.join(least, "node").select(F.col("other").alias("src"), F.col("least").alias("dst"))
    return moved.union(least.select("node", "least")).filter("src <> dst")


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("src", "dst").cast("decimal(20,0)"))).collect()[0])


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of ``edges`` (src, dst) that is not its component's least node, the root.

    Each half-round is one grouping, combined before its shuffle, and one join of written tables, so that adaptive
    execution can split the edges of a hub; edges never outnumber those given. Nulls link nothing, repeated edges count
    once, and no edges give no rows.
    """
    edges = materialise(edges.select("src", "dst").filter("src <> dst"), "links")
    state = _state(edges)
    for _ in range(MOST_ROUNDS):
        if not state[0]:
            break
        edges = materialise(_large_star(edges).distinct(), "large-star")
        edges = materialise(_small_star(edges).distinct(), "small-star")
        now = _state(edges)
        if now == state:
            break
        state = now
    else:
        raise RuntimeError("components did not settle")
    return edges.select(F.col("src").alias("node"), F.col("dst").alias("root"))
