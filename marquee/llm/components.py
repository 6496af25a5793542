"""Connected components by repeated contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node that occurs in ``edges`` (columns a, b; undirected).

    Each round gives every node the neighbour (or itself) with the smallest
    hash, drawn anew per round, and contracts to it. Random order makes even a
    long chain shrink by a constant share a round. Nodes of one component get
    the same root, which is one of its nodes. The rounds' tables are
    checkpointed; they shrink geometrically, and so do the joins that compose them.
    """
    edges = edges.filter("a <> b").select("a", "b").distinct().checkpoint()
    rounds: list[DataFrame] = []
    while not edges.isEmpty():
        k = F.lit(len(rounds))
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        best = F.min(F.struct(F.xxhash64(k, "b").alias("h"), F.col("b").alias("v")))
        own = F.struct(F.xxhash64(k, "a").alias("h"), F.col("a").alias("v"))
        step = (both.groupBy("a").agg(best.alias("best"))
                .select(F.col("a").alias("node"), F.least("best", own)["v"].alias("up")).checkpoint())
        rounds.append(step)
        a, b = (step.select(F.col("node").alias(x), F.col("up").alias(f"up_{x}")) for x in "ab")
        edges = (edges.join(a, "a").join(b, "b").filter("up_a <> up_b")
                 .select(F.least("up_a", "up_b").alias("a"), F.greatest("up_a", "up_b").alias("b"))
                 .distinct().checkpoint())
    if not rounds:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    found = rounds[-1].select("node", F.col("up").alias("root"))
    for step in reversed(rounds[:-1]):
        later = found.select(F.col("node").alias("up"), "root")
        found = step.join(later, "up", "left").select("node", F.coalesce("root", "up").alias("root")).checkpoint()
    return found
