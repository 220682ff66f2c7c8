"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _mins(edges: DataFrame, of: str, other: str) -> DataFrame:
    return edges.groupBy(of).agg(F.min(other).alias("__m")).select(F.col(of).alias("__u"), F.least("__m", of).alias("__m"))


def connected_components(edges: DataFrame, save: Callable[[DataFrame, str], DataFrame], *, max_rounds: int = 60) -> DataFrame:
    """node and component (its least reachable node) for every node of edges (a, b).

    save(df, label) writes df where executors that are lost cannot take it away, and reads it back; it cuts
    the lineage of each round. Loops and null ends are left out; repeated edges and either direction are one. No group is ever collected:
    a round is a grouped minimum and a join. The number of rounds grows with the logarithm of the longest path.
    """
    ab = edges.where("a IS NOT NULL AND b IS NOT NULL AND a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    now = save(ab, "edges")
    mark = None
    for _ in range(max_rounds):
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = both.join(_mins(both, "a", "b"), F.col("a") == F.col("__u")).where("b > a").select(F.col("b").alias("a"), F.col("__m").alias("b")).where("a <> b").distinct()
        low = _mins(large, "a", "b")
        small = large.join(low, F.col("a") == F.col("__u")).select(F.col("b").alias("a"), F.col("__m").alias("b")).unionByName(low.select(F.col("__u").alias("a"), F.col("__m").alias("b")))
        now = save(small.where("a <> b").distinct(), "edges")
        new = now.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("x")).first()
        if new == mark:
            break
        mark = new
    else:
        raise RuntimeError("components did not settle")
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
