"""Connected components by alternating large and small stars.

Every round is two shuffles of the edges and one written table; the number of
rounds grows with the logarithm of the longest chain. No task gathers the
neighbours of a node: minima are partial aggregates, and a node with very many
neighbours is a skewed join that adaptive execution splits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import pin

MAX_ROUNDS = 60


def _hung_on_least(edges: DataFrame, both: DataFrame) -> DataFrame:
    """``both`` (u, v) with each u's least neighbour, itself included."""
    least = both.groupBy("u").agg(F.min("v").alias("least")).select("u", F.least("u", "least").alias("least"))
    return edges.join(least, "u")


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    larger = both.filter("v > u")
    return _hung_on_least(larger, both).select(F.col("v").alias("u"), F.col("least").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    hung = _hung_on_least(edges, edges)
    return (hung.select(F.explode(F.array(F.struct("u", F.col("least").alias("v")),
                                          F.struct(F.col("v").alias("u"), F.col("least").alias("v")))).alias("e"))
            .select("e.*").filter("u > v").distinct())


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(links: DataFrame) -> DataFrame:
    """(node, root) of every node of ``links`` (u, v: long); root is the least node reachable.

    Repeated links and links of a node with itself or with null change nothing; no links, no rows.
    """
    edges = pin(links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                .filter("u > v").distinct())
    state = _state(edges)
    for _ in range(MAX_ROUNDS):
        if not state[0]:
            break
        edges = pin(_small_star(_large_star(edges)))
        before, state = state, _state(edges)
        if before == state:
            break
    else:
        raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
    roots = edges.select("v").distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        roots.select(F.col("v").alias("node"), F.col("v").alias("root")))
