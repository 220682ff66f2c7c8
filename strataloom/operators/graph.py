"""Evidence-backed entity graphs: weights, degrees, neighbours, quality figures and fingerprints."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.names import normal_name


def relation_weights(evidence: DataFrame, active: DataFrame) -> DataFrame:
    """source, target, weight: distinct active, verified parents of each relation (source, target, parent_id, provisional); loops are left out."""
    kept = evidence.where((~F.col("provisional")) & (F.col("source") != F.col("target"))).join(active, "parent_id", "left_semi")
    return kept.groupBy("source", "target").agg(F.countDistinct("parent_id").alias("weight"))


def degrees(edges: DataFrame) -> DataFrame:
    """node, degree (distinct neighbours), relations (edges at it), either direction."""
    both = edges.select(F.col("source").alias("node"), F.col("target").alias("other")).unionByName(edges.select(F.col("target").alias("node"), F.col("source").alias("other")))
    return both.groupBy("node").agg(F.countDistinct("other").alias("degree"), F.count("*").alias("relations"))


def neighbours(seeds: DataFrame, edges: DataFrame, hops: int = 2) -> DataFrame:
    """seed, node, hop: nodes within `hops` (1 or 2) undirected steps of seeds (node), with the least number of steps."""
    if hops not in (1, 2):
        raise ValueError("hops must be 1 or 2")
    both = edges.select(F.col("source").alias("u"), F.col("target").alias("v")).unionByName(edges.select(F.col("target").alias("u"), F.col("source").alias("v"))).distinct()
    now = seeds.select(F.col("node").alias("seed"), F.col("node").alias("u"))
    found = None
    for hop in range(1, hops + 1):
        now = now.join(both, "u").select("seed", F.col("v").alias("u")).distinct()
        step = now.select("seed", F.col("u").alias("node"), F.lit(hop).alias("hop"))
        found = step if found is None else found.unionByName(step)
    return found.where("seed <> node").groupBy("seed", "node").agg(F.min("hop").alias("hop"))


def fingerprint(row: Column) -> list[Column]:
    """Order-independent fingerprint of rows: XOR of the four 60-bit slices of their SHA-256, as aggregates w0..w3, and the count."""
    h = F.sha2(row, 256)
    return [*(F.bit_xor(F.conv(F.substring(h, 1 + 15 * k, 15), 16, 10).cast("long")).alias(f"w{k}") for k in range(4)), F.count("*").alias("n")]


def quality(entities: DataFrame, edges: DataFrame) -> DataFrame:
    """One row of key figures: entities, orphans, mean degree, short and long names, duplicates by folded name. Entities: node, name."""
    d = entities.join(degrees(edges), "node", "left").select("node", "name", F.coalesce("degree", F.lit(0)).alias("degree"))
    named = d.agg(
        F.count("*").alias("entities"), F.count_if(F.col("degree") == 0).alias("orphans"), F.round(F.avg("degree"), 6).alias("mean_degree"),
        F.count_if(F.length("name") <= 1).alias("short_names"), F.count_if(F.length("name") > 100).alias("long_names"), F.count_if(F.col("degree") <= 2).alias("weak"),
    )
    twice = entities.groupBy(F.lower(F.trim("name")).alias("k")).count().where("count > 1").agg(F.count("*").alias("duplicate_groups"), F.coalesce(F.sum("count"), F.lit(0)).alias("duplicates"))
    return named.crossJoin(F.broadcast(twice))  # one row each


def weighted_mean(children: DataFrame) -> DataFrame:
    """parent_id, dim, value: unit-length weighted mean of the vectors of children (parent_id, position, text, vector, weight).

    Of children whose texts are equal but for case, punctuation and white space the first by position stands, even if it has no vector and another has. A weight is
    at least 1. Vectors of different dimension and a mean of length zero are errors; a parent without any vector has no rows.
    """
    first = Window.partitionBy("parent_id", normal_name(F.col("text"))).orderBy("position")
    once = children.withColumn("__k", F.row_number().over(first)).where("__k = 1 AND vector IS NOT NULL")
    parts = once.select("parent_id", F.greatest(F.coalesce("weight", F.lit(1)), F.lit(1)).cast("double").alias("w"), F.size("vector").alias("d"), F.posexplode("vector").alias("dim", "x"))
    mean = parts.groupBy("parent_id", "dim").agg((F.sum(F.col("w") * F.col("x")) / F.sum("w")).alias("m"), F.min("d").alias("lo"), F.max("d").alias("hi"))
    norm = mean.groupBy("parent_id").agg(F.sqrt(F.sum(F.col("m") * F.col("m"))).alias("norm"), F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    sound = norm.where(F.assert_true(F.col("lo") == F.col("hi"), F.lit("vectors of different dimension")).isNull() & F.assert_true(F.col("norm") > 0, F.lit("mean vector of length zero")).isNull())
    return mean.join(sound.select("parent_id", "norm"), "parent_id").select("parent_id", "dim", F.round(F.col("m") / F.col("norm"), 6).alias("value"))
