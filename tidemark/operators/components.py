"""Connected components of an edge table by alternating large-star and small-star steps.

Each step is an aggregation and an equi-join; no neighbourhood is ever collected. The rounds grow with
the logarithm of the longest chain. (Kiveris et al. 2014.)
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select("v", "u"))
    low = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
    return both.join(low, "u").filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    low = down.groupBy("u").agg(F.min("v").alias("m"))
    linked = down.join(low, "u").filter(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return linked.union(low.select("u", F.col("m").alias("v")))


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("h")).first()
    return row["n"], row["h"]


def connected_components(edges: DataFrame, a: str, b: str, max_rounds: int = 100) -> DataFrame:
    """(node, component) for every node with an edge; the component is its smallest node."""
    current = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).filter(F.col("u") != F.col("v"))
    current = cut(current.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    state = _state(current)
    for _ in range(max_rounds):
        current = cut(_small_star(_large_star(current).filter(F.col("u") != F.col("v")).distinct()).distinct())
        after = _state(current)
        if after == state:
            break
        state = after
    else:
        raise RuntimeError("components did not converge")
    roots = current.select(F.col("v").alias("node")).distinct()
    leaves = current.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return leaves.unionByName(roots.select("node", F.col("node").alias("component")))
