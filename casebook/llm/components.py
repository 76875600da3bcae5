"""Connected components of a graph kept as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casebook.sources.work import Work


def _stars(edges: DataFrame, larger: bool) -> DataFrame:
    """One step of the star contraction: neighbours are hung on the least node known to their common neighbour."""
    if larger:  # every node tells its larger neighbours the least of its neighbours and itself
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        moved = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:  # every node hangs its smaller neighbours and itself on the least of them
        least = edges.groupBy("u").agg(F.min("v").alias("m"))
        others = edges.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        moved = others.unionByName(least.select("u", F.col("m").alias("v")))
    return moved.where("u <> v").distinct()


def _only_stars(edges: DataFrame) -> bool:
    up = edges.groupBy("u").agg(F.count("*").alias("n"))
    return up.where("n > 1").isEmpty() and edges.join(up.select(F.col("u").alias("_u")), F.col("v") == F.col("_u"), "left_semi").isEmpty()


def components(edges: DataFrame, work: Work) -> DataFrame:
    """``node`` and ``component``, the least node that can be reached, for every node of ``edges`` (u, v) but those that
    are the least of theirs.

    Large-star and small-star steps alternate until only stars are left (every node has one edge, to a node that has
    none), which takes about log2(n) rounds; each round is a written table, so that lost executors cost one round at most. A node with very many neighbours is only ever a key of
    a partial aggregate or of a join whose large side Spark can split.
    """
    own = edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    now = work.keep(own, "edges")
    while not _only_stars(now):
        now = work.keep(_stars(_stars(now, True).select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")), False), "stars")
    return now.select(F.col("u").alias("node"), F.col("v").alias("component"))
