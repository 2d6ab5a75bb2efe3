"""Connected components by alternating large and small stars (Kiveris et al. 2014), each round written out."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import staged


def _large(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the node's least neighbour (or itself)."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy(F.col("a").alias("n")).agg(F.min("b").alias("m")).select("n", F.least("n", "m").alias("m"))
    return both.where("b > a").join(least, F.col("a") == F.col("n")).select(F.col("m").alias("a"), "b").distinct()


def _small(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the least of these."""
    least = edges.groupBy(F.col("b").alias("n")).agg(F.min("a").alias("m"))
    near = edges.join(least, F.col("b") == F.col("n"))
    return (near.where("a <> m").select(F.col("m").alias("a"), F.col("a").alias("b"))
            .unionByName(least.select(F.col("m").alias("a"), F.col("n").alias("b"))).where("a <> b").distinct())


def connected(edges: DataFrame, max_rounds: int = 50) -> DataFrame:
    """(node, root) for every node of the undirected ``edges`` (a, b); root is the least node of the
    component in the columns' order. Repeated edges and loops are harmless; no edges, no rows."""
    e = staged(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a <> b").distinct(),
               "components")
    seen = None
    for _ in range(max_rounds):
        # sums of hashes wrap as decimals do not: two equal sums over equal counts are the same edges
        state = e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if not state[0] or tuple(state) == seen:
            break
        seen = tuple(state)
        e = staged(_small(_large(e)), "components")
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return e.select(F.col("b").alias("node"), F.col("a").alias("root")).unionByName(
        e.select(F.col("a").alias("node"), F.col("a").alias("root"))).distinct()
