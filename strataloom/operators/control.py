"""What steers consolidation from run to run: failure modes, thresholds under guard, catalogs, retries, vectors that are not made twice."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import words

#: Rungs of a retry, in order: name, low verbosity, tokens of a new chunk (0: the chunks stay), overlap, chunks combined (0: as before). Fixed values.
RUNGS = (("original", False, 0, 0, 0), ("low-verbosity-same-chunks", True, 0, 0, 1), ("rechunk-2000", True, 2000, 200, 1), ("rechunk-1000", True, 1000, 100, 1), ("rechunk-500", True, 500, 50, 1))


def failure_mode(concept_ratio: Column, untaxed_ratio: Column, duplicate_rate: Column, *, concept: float, untaxed: float, duplicates: float) -> Column:
    taxonomy, copies = (concept_ratio > concept) | (untaxed_ratio > untaxed), duplicate_rate > duplicates
    return F.when(taxonomy & copies, "mixed_debt").when(copies, "duplicate_debt").when(taxonomy, "taxonomy_debt").otherwise("balanced")


def guarded_threshold(current: Column, proposed: Column, duplicate_rate: Column, judged: Column, accepted: Column, *, target: float, low: float = 0.7, high: float = 0.99) -> Column:
    """The next threshold within [low, high]: a lower one only while duplicates exceed 1.2 times the target and at least 20 pairs were judged, a fifth of them accepted."""
    next_ = F.greatest(F.lit(low), F.least(F.lit(high), F.coalesce(proposed, current)))
    may = F.coalesce((duplicate_rate > 1.2 * target) & (judged >= 20) & (accepted >= 0.2), F.lit(False))
    return F.when((next_ < current) & ~may, current).otherwise(next_)


def catalog_faults(labels: DataFrame, required: str = "Concept", most: int = 40) -> DataFrame:
    """fault of each catalog (catalog_id, label), one row per kind: missing (the required label), backtick, repeated (but for case), many. Blank labels do not count."""
    named = labels.select("catalog_id", F.btrim("label").alias("label")).where("label <> ''")
    seen = labels.select("catalog_id").distinct().join(
        named.groupBy("catalog_id").agg(F.count("*").alias("n"), F.count_distinct(F.lower("label")).alias("d"), F.max(F.col("label") == required).alias("has"), F.max(F.contains("label", F.lit("`"))).alias("tick")), "catalog_id", "left"
    )
    kinds = F.array(F.when(~F.coalesce("has", F.lit(False)), "missing"), F.when(F.col("tick"), "backtick"), F.when(F.col("d") < F.col("n"), "repeated"), F.when(F.col("n") > most, "many"))
    return seen.select("catalog_id", F.explode(F.array_compact(kinds)).alias("fault"))


def retry_plan(failures: DataFrame, over_limit: Column) -> DataFrame:
    """failures with the next rung's settings: one further per attempt while the message tells of an output limit, the same rung again for other errors; null after the last."""
    cast = "array<struct<name:string,low_verbosity:boolean,tokens:int,overlap:int,combined:int>>"
    rungs = F.array(*(F.struct(*map(F.lit, r)) for r in RUNGS)).cast(cast)
    return failures.withColumn("rung", F.get(rungs, F.col("attempt") + F.when(over_limit, 1).otherwise(0))).select("*", "rung.*").drop("rung")


def hashed_features(docs: DataFrame, slots: int = 256) -> DataFrame:
    """document_id, slot, n and weight: counts of a document's words by hash of the word, and these over their Euclidean norm. Deterministic vectors for where no model is given."""
    w = docs.select("document_id", F.explode(words(F.lower("text"))).alias("w"))
    slot = (F.conv(F.substring(F.md5("w"), 1, 8), 16, 10).cast("long") % slots).cast("int")
    n = w.groupBy("document_id", slot.alias("slot")).agg(F.count("*").alias("n"))
    norm = n.groupBy("document_id").agg(F.sqrt(F.sum(F.col("n") * F.col("n"))).alias("norm"))
    return n.join(norm, "document_id").select("document_id", "slot", "n", (F.col("n") / F.col("norm")).alias("weight"))


def cached(rows: DataFrame, cache: DataFrame, key: str, make: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """cache (key and results) with what make gives for the rows whose key it lacks; make sees each key once."""
    fresh = rows.dropDuplicates([key]).join(cache.select(key), key, "left_anti")
    return cache.unionByName(make(fresh).select(*cache.columns))


def reserve_swaps(scores: DataFrame, most: int = 2) -> DataFrame:
    """Per dataset, at most two questions to replace: the graph was of no value, the first condition won or tied, and neither answer drew documents together (3 at most). Least synthesis first, then least total, then place."""
    weak = scores.where("value = 'no' AND winner IN ('first', 'tie') AND first_synthesis <= 3 AND second_synthesis <= 3")
    order = [F.greatest("first_synthesis", "second_synthesis"), F.greatest("first_total", "second_total"), F.col("place"), F.col("question_id")]
    return weak.withColumn("position", F.row_number().over(Window.partitionBy("dataset").orderBy(*order))).where(F.col("position") <= most).select("dataset", "question_id", "position")
