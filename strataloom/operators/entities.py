"""Entity resolution, taxonomy guards and evaluation figures."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import lemma


def lemma_groups(entities: DataFrame) -> DataFrame:
    """canonical, members, target: entities (id, name, in_scope) that share a lemma, if more than one and any is in scope. The merge target is the least id of those
    out of scope, which were there before; without such, the least id. Without in_scope every entity is in scope."""
    scope = F.col("in_scope") if "in_scope" in entities.columns else F.lit(True)
    got = entities.withColumn("__s", F.coalesce(scope, F.lit(False))).groupBy(lemma(F.col("name")).alias("canonical"))
    return got.agg(F.count("*").alias("members"), F.min(F.struct("__s", "id"))["id"].alias("target"), F.max("__s").alias("__any")).where("members > 1 AND __any").drop("__any")


def duplicate_anchors(entities: DataFrame, distance: int = 2) -> DataFrame:
    """id, label, name of entities with a later one (greater id) of the same label that contains it, is contained in it, or differs by few edits.

    Candidates meet on equal keys, not in all pairs. A contained name's first three letters are among the other's; of distance + 1 segments of a
    name within `distance` edits, one stands in the other at most that far away. Containment takes names of 3 letters and more, edits of 6 and more.
    """
    e = entities.select("id", "label", F.col("name").alias("whole"), F.lower("name").alias("name")).where("name IS NOT NULL")
    at = lambda x: F.transform(F.sequence(F.lit(1), F.greatest(F.length(x) - 2, F.lit(1))), lambda s: F.substring(x, s, F.lit(3)))
    row = F.struct("id", "name")
    grams = e.where("length(name) > 2").select("label", row.alias("x"), F.explode(F.array_distinct(at(F.col("name")))).alias("key"))
    heads = e.where("length(name) > 2").select("label", row.alias("y"), F.substring("name", 1, 3).alias("key"))
    inside = grams.join(heads, ["label", "key"]).where(F.contains("x.name", "y.name") & (F.col("x.id") != F.col("y.id")))
    found = [inside.select(F.least("x.id", "y.id").alias("id"))]
    parts = distance + 1
    cut = lambda n, k: F.floor(n * k / parts).cast("int")
    first = e.where("length(name) > 5")
    n = F.length("name")
    segments = first.select("label", row.alias("x"), n.alias("n"), F.explode(F.array(*(F.struct(F.lit(k).alias("k"), F.substring("name", cut(n, k) + 1, cut(n, k + 1) - cut(n, k)).alias("s")) for k in range(parts)))).alias("g"))
    lengths = F.explode(F.sequence(F.greatest(F.length("name") - distance, F.lit(6)), F.length("name") + distance))
    others = e.where(f"length(name) >= {6 - distance}").select("label", row.alias("y"), "name", lengths.alias("n"))
    for k in range(parts):
        shift = F.explode(F.sequence(F.greatest(cut(F.col("n"), k) + 1 - distance, F.lit(1)), cut(F.col("n"), k) + 1 + distance))
        y = others.select("label", "y", "n", "name", shift.alias("p")).select("label", "y", "n", F.substring("name", F.col("p"), cut(F.col("n"), k + 1) - cut(F.col("n"), k)).alias("s")).distinct()
        x = segments.where(F.col("g.k") == k).select("label", "x", "n", F.col("g.s").alias("s"))
        found.append(x.join(y, ["label", "n", "s"]).where((F.col("x.id") < F.col("y.id")) & (F.levenshtein("x.name", "y.name", distance) >= 0)).select(F.col("x.id").alias("id")))
    ids = reduce(DataFrame.unionByName, found).distinct()
    return e.join(ids, "id", "left_semi").select("id", "label", F.col("whole").alias("name"))


def guard(proposals: DataFrame, edges: DataFrame, hops: int = 6) -> DataFrame:
    """source, target, verdict of proposed taxonomy edges: self-loop, reverse, cycle (target reaches source within hops), taken (source has another target) or ok."""
    p = proposals.select("source", "target").distinct()
    e = edges.select(F.col("source").alias("u"), F.col("target").alias("v")).distinct()
    key = ["source", "target"]
    now, back = p.select(*key, F.col("target").alias("at")), None
    for hop in range(1, hops + 1):
        now = now.join(e, F.col("at") == F.col("u")).select(*key, F.col("v").alias("at")).distinct()
        met = now.where("at = source").select(*key, F.lit(hop).alias("hop"))
        back = met if back is None else back.unionByName(met)
    back = back.groupBy(*key).agg(F.min("hop").alias("hop"))
    taken = e.groupBy(F.col("u").alias("source")).agg(F.min("v").alias("lo"), F.max("v").alias("hi"))
    verdict = (
        F.when(F.col("source") == F.col("target"), "self-loop").when(F.col("hop") == 1, "reverse").when(F.col("hop").isNotNull(), "cycle")
        .when((F.col("lo") != F.col("target")) | (F.col("hi") != F.col("target")), "taken").otherwise("ok")
    )
    return p.join(back, key, "left").join(taken, "source", "left").select(*key, verdict.alias("verdict"))


def evaluation_gate(scores: DataFrame, ratio: float = 0.95) -> DataFrame:
    """One row: means of baseline and candidate, wins, losses, ties (differences of at most 1), unsupported sums, and whether the candidate passes. Scores: baseline, candidate, base_unsupported, unsupported."""
    d = F.col("candidate") - F.col("baseline")
    got = scores.agg(
        F.count("*").alias("n"), F.avg("baseline").alias("b"), F.avg("candidate").alias("c"), F.count_if(d > 1).alias("wins"), F.count_if(d < -1).alias("losses"), F.count_if(F.abs(d) <= 1).alias("ties"),
        F.coalesce(F.sum("base_unsupported"), F.lit(0)).alias("base_unsupported"), F.coalesce(F.sum("unsupported"), F.lit(0)).alias("unsupported"),
    )
    passed = (F.col("c") >= ratio * F.col("b")) & (F.col("unsupported") <= F.col("base_unsupported"))
    return got.select("n", F.round("b", 6).alias("baseline"), F.round("c", 6).alias("candidate"), "wins", "losses", "ties", "base_unsupported", "unsupported", F.coalesce(passed, F.lit(False)).alias("passed"))
