"""Page graph: nodes, edges and the paths through them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logloom.plans.skew import hot_keys, salted_join
from logloom.session import cut_lineage


def distinct_edges(edges: DataFrame) -> DataFrame:
    """Distinct directed edges; a→b and b→a are two."""
    return edges.select("src", "dst").dropna().distinct()


def nodes_of(edges: DataFrame) -> DataFrame:
    ends = edges.select(F.explode(F.array("src", "dst")).alias("page"))
    return ends.dropna().distinct()


def build_graph(edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(nodes, edges), both distinct."""
    return nodes_of(edges), distinct_edges(edges)


def enumerate_paths(edges: DataFrame, max_len: int) -> DataFrame:
    """(path, length): every path of 1 to ``max_len`` edges that repeats no edge.

    Each round extends the paths of the round before by one edge; the pages in
    which many of these paths end are counted anew and salted. A round is
    checkpointed, so the next one and the final union read it instead of
    running all earlier joins again, and a lost executor costs one round only.
    """
    links = cut_lineage(distinct_edges(edges))
    level = links.select(F.array("src", "dst").alias("path"), F.col("dst").alias("src"))
    levels = [level]
    for step in range(1, max_len):
        used = F.exists(
            F.sequence(F.lit(1), F.size("path") - 1),
            lambda i: (F.element_at("path", i) == F.col("src"))
            & (F.element_at("path", i + 1) == F.col("dst")),
        )
        hot = hot_keys(level.groupBy("src").agg(F.count(F.lit(1)).alias("n")), "src", "n")
        level = (
            salted_join(level, links, "src", hot, F.col("path"))
            .where(~used)
            .select(F.array_append("path", F.col("dst")).alias("path"), F.col("dst").alias("src"))
        )
        if step < max_len - 1:
            level = cut_lineage(level)
            if level.isEmpty():
                break
        levels.append(level)
    paths = reduce(DataFrame.unionByName, levels)
    return paths.select("path", (F.size("path") - 1).alias("length"))
