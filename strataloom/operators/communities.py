"""Communities of a weighted graph by label propagation in fixed rounds, and checks of their hierarchy."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Save = Callable[[DataFrame, str], DataFrame]


def _both(edges: DataFrame) -> DataFrame:
    e = edges.where("source IS NOT NULL AND target IS NOT NULL AND source <> target AND weight IS NOT NULL")
    turned = e.select(F.col("target").alias("source"), F.col("source").alias("target"), "weight")
    return e.select("source", "target", "weight").unionByName(turned).groupBy("source", "target").agg(F.sum("weight").alias("weight"))


def propagate(nodes: DataFrame, edges: DataFrame, rounds: int = 3, save: Save = lambda df, _: df) -> DataFrame:
    """node, label. Each round a node takes the label of most weight among its neighbours and itself, the smallest of equals; its own label counts
    as much as its heaviest edge, so that two nodes don't swap labels for ever. A node of no edges keeps its own.

    nodes: node (distinct); edges: source, target, weight, in either direction. A round is one join and two grouped aggregates over the edges, the first one
    a single aggregate, as every node is still its own label; no neighbourhood is collected. save(df, label) may write and reread the labels of a round.
    """
    between = _both(edges)
    own = between.groupBy("source").agg(F.max("weight").alias("weight")).select("source", F.col("source").alias("target"), "weight")
    both = save(between.unionByName(own), "edges")
    votes = both.select("source", F.col("target").alias("label"), F.col("weight").alias("w"))  # at first every node is its own label, and both has a pair once
    at = nodes.select("node", F.col("node").alias("label"))
    for k in range(rounds):
        if k:
            votes = both.join(at.withColumnRenamed("node", "target"), "target").groupBy("source", "label").agg(F.sum("weight").alias("w"))
        best = votes.groupBy("source").agg(F.min(F.struct((-F.col("w")).alias("w"), "label"))["label"].alias("label"))
        at = save(best.select(F.col("source").alias("node"), "label"), "labels")
    return nodes.select("node").join(at, "node", "left").select("node", F.coalesce("label", "node").alias("label"))


def hierarchy(nodes: DataFrame, edges: DataFrame, save: Save, levels: int = 2, most: int = 10, rounds: int = 3) -> DataFrame:
    """level, node, label, parent: communities, and below level 0 those that communities of more than `most` nodes fall into.

    A deeper level keeps the edges inside one community that weigh more than its edges do on average, and propagates again. Labels hold
    their parent's, so that no community spans two. Nodes of small communities have no deeper row. save(df, label) writes df where lost executors cannot take it away and reads it back;
    without it plans would double with every use of a level.
    """
    now = save(propagate(nodes, edges, rounds, save).select(F.lit(0).alias("level"), "node", F.col("label").cast("string").alias("label"), F.lit(None).cast("string").alias("parent")), "level")
    out = now
    for level in range(1, levels):
        large = now.groupBy("label").count().where(F.col("count") > most).select("label")
        inside = save(now.join(large, "label", "left_semi").select("node", F.col("label").alias("parent")), "inside")
        a, b = inside.select(F.col("node").alias("source"), F.col("parent").alias("p")), inside.select(F.col("node").alias("target"), F.col("parent").alias("q"))
        held = edges.join(a, "source").join(b, "target").where("p = q")
        mean = held.groupBy("p").agg(F.avg("weight").alias("mean"))
        kept = held.join(mean, "p").where("weight > mean").select("source", "target", "weight")
        new = propagate(inside.select("node"), kept, rounds, save).join(inside, "node")
        now = save(new.select(F.lit(level).alias("level"), "node", F.concat_ws("/", "parent", F.col("label").cast("string")).alias("label"), "parent"), "level")
        out = out.unionByName(now)
    return out


def hierarchy_faults(members: DataFrame, nodes: DataFrame) -> DataFrame:
    """fault, subject: nodes twice on a level, nodes without a community, and parents that are no community one level up."""
    twice = members.groupBy("level", "node").count().where("count > 1").select(F.lit("twice").alias("fault"), F.col("node").cast("string").alias("subject"))
    bare = nodes.join(members, "node", "left_anti").select(F.lit("bare").alias("fault"), F.col("node").cast("string").alias("subject"))
    above = members.select((F.col("level") + 1).alias("level"), F.col("label").alias("parent")).distinct()
    below = members.where("level > 0").select("level", "parent").distinct()
    lost = below.join(above, ["level", "parent"], "left_anti").select(F.lit("no parent").alias("fault"), F.col("parent").alias("subject"))
    return twice.unionByName(bare).unionByName(lost)


def report_evidence(members: DataFrame, mentions: DataFrame, relations: DataFrame) -> DataFrame:
    """level, label, parent_id: what a community's report may cite, the parents that mention a member (mentions: node, parent_id) and those of relations within it (relations: source, target, parent_id)."""
    of = members.select("level", "label", "node")
    named = of.join(mentions, "node").select("level", "label", "parent_id")
    a, b = of.withColumnRenamed("node", "source"), of.withColumnRenamed("node", "target")
    inside = relations.select("source", "target", "parent_id").distinct().join(a, "source").join(b, ["level", "label", "target"]).select("level", "label", "parent_id")
    return named.unionByName(inside).distinct()


def ungrounded(findings: DataFrame, evidence: DataFrame) -> DataFrame:
    """finding_id of findings (finding_id, level, label, sources) that cite nothing, or something that is no evidence of their community."""
    cited = findings.select("finding_id", "level", "label", F.explode("sources").alias("parent_id"))
    wrong = cited.join(evidence, ["level", "label", "parent_id"], "left_anti").select("finding_id")
    return wrong.unionByName(findings.where(F.coalesce(F.size("sources"), F.lit(0)) <= 0).select("finding_id")).distinct()


def reports(members: DataFrame, evidence: DataFrame, reporter: Callable[[DataFrame], DataFrame], save: Save) -> DataFrame:
    """Reports of all communities, the deepest level first, so that a report sees the findings of those below it.

    reporter gets level, label, parent, n (members), evidence (sorted parent ids) and below (findings of the communities within, by label), and gives level, label, summary and findings (array of texts).
    """
    depth = members.agg(F.max("level")).first()[0]  # a handful
    groups = members.groupBy("level", "label", "parent").agg(F.count("*").alias("n")).join(evidence.groupBy("level", "label").agg(F.sort_array(F.collect_set("parent_id")).alias("evidence")), ["level", "label"], "left")
    out = below = None
    for level in range(depth if depth is not None else -1, -1, -1):
        now = groups.where(F.col("level") == level)
        now = now.join(below, "label", "left") if below is not None else now.withColumn("below", F.lit(None).cast("array<string>"))
        made = save(reporter(now).select("level", "label", "summary", "findings"), "reports")
        parent = groups.where(F.col("level") == level).select("label", "parent")
        below = made.join(parent, "label").groupBy("parent").agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("label", "findings"))), lambda x: x["findings"])).alias("below")).withColumnRenamed("parent", "label")
        out = made if out is None else out.unionByName(made)
    return out if out is not None else members.sparkSession.createDataFrame([], "level int, label string, summary string, findings array<string>")
