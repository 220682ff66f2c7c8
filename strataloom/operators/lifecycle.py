"""Revisions from staging to activity and back, and what goes when their evidence goes."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def activated(revisions: DataFrame, stored: DataFrame) -> DataFrame:
    """revisions with status after activation.

    revisions: document_id, revision_id, status, expected; stored: revision_id, one row per stored chunk. Of each document's STAGED revisions
    that have exactly the expected chunks, the one with the greatest id becomes ACTIVE, and whatever was ACTIVE there becomes INACTIVE.
    Documents without such a revision keep every status.
    """
    n = stored.groupBy("revision_id").agg(F.count("*").alias("__n"))
    whole = (F.col("status") == "STAGED") & (F.coalesce("__n", F.lit(0)) == F.col("expected"))
    first = F.max(F.when(whole, F.col("revision_id"))).over(Window.partitionBy("document_id"))
    status = F.when(F.col("revision_id") == F.col("__first"), "ACTIVE").when((F.col("status") == "ACTIVE") & F.col("__first").isNotNull(), "INACTIVE").otherwise(F.col("status"))
    return revisions.join(n, "revision_id", "left").withColumn("__first", first).withColumn("status", status).drop("__n", "__first")


def rolled_back(revisions: DataFrame, failed: DataFrame) -> DataFrame:
    """revisions with those in failed (revision_id) FAILED, and each document that lost its ACTIVE one back on its newest INACTIVE revision: by deactivated_at, else created_at, then id."""
    marked = revisions.join(failed.select("revision_id", F.lit(True).alias("__f")).distinct(), "revision_id", "left")
    lost = F.max(F.col("__f") & (F.col("status") == "ACTIVE")).over(Window.partitionBy("document_id"))
    newest = F.struct(F.coalesce("deactivated_at", "created_at").alias("at"), F.col("revision_id").alias("id"))
    back = F.max(F.when((F.col("status") == "INACTIVE") & F.col("__f").isNull(), newest)).over(Window.partitionBy("document_id"))["id"]
    out = marked.withColumn("__lost", lost).withColumn("__back", F.when(F.col("__lost"), back))
    status = F.when(F.col("__f"), "FAILED").when(F.col("revision_id") == F.col("__back"), "ACTIVE").otherwise(F.col("status"))
    return out.withColumn("status", status).drop("__f", "__lost", "__back")


def graph_ready(revisions: DataFrame, parents: DataFrame) -> DataFrame:
    """revision_id, ready: whether none of a revision's parents (revision_id, status) is other than COMPLETED; without parents it is."""
    open_ = parents.where(~F.col("status").eqNullSafe("COMPLETED")).groupBy("revision_id").agg(F.lit(False).alias("ready"))
    return revisions.select("revision_id").join(open_, "revision_id", "left").withColumn("ready", F.coalesce("ready", F.lit(True)))


def retracted(evidence: DataFrame, gone: DataFrame) -> DataFrame:
    """evidence without the rows of revisions in gone (revision_id)."""
    return evidence.join(gone.select("revision_id").distinct(), "revision_id", "left_anti")


def unsupported(items: DataFrame, evidence: DataFrame, on: list[str]) -> DataFrame:
    """items that no evidence row names any more."""
    return items.join(evidence.select(*on).distinct(), on, "left_anti")
