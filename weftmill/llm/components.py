"""Connected components by contraction, as joins and aggregations over written edge tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftmill.lineage import cut


def connected_components(edges: DataFrame) -> DataFrame:
    """`(node, root)` for every node of `edges` `(a, b)` (longs); nodes of a component share a root.

    Each round every node picks the neighbour (or itself) that comes first in an order drawn anew by
    hash, and edges are contracted to the picked nodes. A constant share of the nodes goes per round
    whatever the shape of the graph, so rounds grow with the logarithm of the largest component. Picks
    are minima, combined before the shuffle, so a node with very many edges is no large group; its
    edges are spread by Spark's skew join. Each round is written.
    """
    roots = None
    edges = cut(edges.select("a", "b").filter("a <> b").distinct())
    turn = 0
    while not edges.isEmpty():
        rank = lambda c, turn=turn: F.struct(F.xxhash64(c, F.lit(turn)).alias("order"), F.col(c).alias("root"))
        both = edges.union(edges.select("b", "a"))
        pick = F.least(F.min(rank("b")), rank("a"))
        picks = cut(both.groupBy("a").agg(pick["root"].alias("root")).withColumnRenamed("a", "node"))
        roots = picks if roots is None else cut(_follow(roots, picks))
        edges = cut(
            edges.join(_named(picks, "a", "ra"), "a")
            .join(_named(picks, "b", "rb"), "b")
            .filter("ra <> rb")
            .select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b"))
            .distinct()
        )
        turn += 1
    if roots is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots


def _named(picks: DataFrame, node: str, root: str) -> DataFrame:
    return picks.select(F.col("node").alias(node), F.col("root").alias(root))


def _follow(roots: DataFrame, picks: DataFrame) -> DataFrame:
    """Roots after one more round: nodes whose root was contracted further move on."""
    moved: Column = F.coalesce("next", "root")
    return roots.join(_named(picks, "root", "next"), "root", "left").select("node", moved.alias("root"))
