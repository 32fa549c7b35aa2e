"""Connected components of an edge table, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logloom.session import cut_lineage

#: Edges that one partition holds (16 bytes each); fewer need no exchange between the steps of a round.
PER_PARTITION = 1 << 15


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is tied to the smallest node around it."""
    ways = F.explode(F.array(F.struct("u", "v"), F.struct(F.col("v").alias("u"), F.col("u").alias("v"))))
    around = edges.select(ways.alias("e")).select("e.u", "e.v")
    least = around.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return around.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are tied to the smallest of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v")
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    kept = down.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return kept.union(least.select("u", F.col("m").alias("v")))


def connected_components(edges: DataFrame) -> DataFrame:
    """``(node, component)`` for the nodes of ``edges(u, v)``, component = smallest node.

    Nulls and loops are ignored, repeated edges do no harm, and an empty table
    gives an empty one; nodes whose component is themselves are left out. Each
    round keeps one edge table of at most the size of the first, checkpointed
    in the shared folder; rounds grow with the logarithm of the longest chain. The
    partitions of a round follow from the number of its edges.
    """
    now = cut_lineage(edges.select("u", "v").where("u <> v").distinct())
    rows, before = now.count(), None
    while True:
        # few edges need few partitions, and a single one needs no exchange at all
        now = now.coalesce(-(-max(1, rows) // PER_PARTITION))
        # repeated edges fall together once every node hangs on its smallest one
        now = cut_lineage(_small_star(_large_star(now)))
        mark = now.agg(F.count("u"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(mark) == before:
            return now.select(F.col("u").alias("node"), F.col("v").alias("component"))
        rows, before = mark[0], tuple(mark)
