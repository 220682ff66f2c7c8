"""Documents to blocks and chunks, duplicates, terms, usage and retention."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.storage import materialize, tasks


def stable_id(*parts: Column) -> Column:
    """SHA-256 of the parts joined by the unit separator."""
    return F.sha2(F.concat_ws("\u001f", *(p.cast("string") for p in parts)), 256)


def blocks(docs: DataFrame) -> DataFrame:
    """document_id, ordinal, text, start, end, block_id: paragraphs, which blank lines or the end of the text end; ordinals contiguous from 0. Docs: document_id, text.

    start and end are offsets in the text with line feeds only, of the paragraph without white space at its ends. block_id hashes document, ordinal and the
    text with runs of white space as one space. Null or blank text has no block.
    """
    text = F.regexp_replace(F.col("text"), "\r\n?", "\n")
    gap = "\n[ \t\n\f\r]*\n"
    row = Window.partitionBy("document_id", "__row").orderBy("at")
    cut = docs.select("document_id", text.alias("__t")).withColumn("__row", F.monotonically_increasing_id())
    parts = cut.select("document_id", "__row", F.posexplode(F.arrays_zip(F.split("__t", gap, -1).alias("p"), F.regexp_extract_all("__t", F.lit(gap), 0).alias("s"))).alias("at", "x")).select("document_id", "__row", "at", "x.p", "x.s")
    before = F.coalesce(F.sum(F.length("p") + F.coalesce(F.length("s"), F.lit(0))).over(row.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    space = " \t\n\f\r"
    placed = parts.withColumns({"text": F.btrim("p", F.lit(space)), "start": before + F.length("p") - F.length(F.ltrim("p", F.lit(space)))}).where("text <> ''")
    out = placed.withColumn("ordinal", (F.row_number().over(row) - 1).cast("int")).withColumn("end", F.col("start") + F.length("text"))
    return out.select("document_id", "ordinal", "text", "start", "end", stable_id(F.col("document_id"), F.col("ordinal"), F.regexp_replace("text", "[ \t\n\f\r]+", " ")).alias("block_id"))


def exact_duplicates(docs: DataFrame, key: str = "text") -> DataFrame:
    """One row: groups, rows in them and removable rows."""
    g = docs.groupBy(F.sha2(key, 256).alias("k")).count().where("count > 1")
    return g.agg(F.count("*").alias("duplicate_groups"), F.coalesce(F.sum("count"), F.lit(0)).alias("rows"), F.coalesce(F.sum(F.col("count") - 1), F.lit(0)).alias("removable"))


def term_frequencies(docs: DataFrame, least: int = 2) -> DataFrame:
    """term, df, tf over docs (document_id, text): lower-case terms of 4 and more letters in at least `least` documents."""
    terms = docs.select("document_id", F.explode(F.split(F.lower("text"), "[^a-z]+")).alias("term")).where(F.length("term") >= 4)
    once = terms.groupBy("term", "document_id").agg(F.count("*").alias("c"))
    return once.groupBy("term").agg(F.count("*").alias("df"), F.sum("c").alias("tf")).where(F.col("df") >= least)


def retained(messages: DataFrame, max_turns: int = 2) -> DataFrame:
    """The last 2 * max_turns messages of each conversation."""
    w = Window.partitionBy("conv_id").orderBy(F.desc("turn"))
    return messages.withColumn("back", F.row_number().over(w)).where(F.col("back") <= 2 * max_turns).drop("back")


def usage(events: DataFrame, limit: float) -> DataFrame:
    """Per user: total, and what is left of a limit."""
    t = F.sum("value")
    return events.groupBy("user_id").agg(F.round(t, 4).alias("used"), F.round(F.greatest(F.lit(limit) - t, F.lit(0.0)), 4).alias("left"), F.countDistinct(F.to_date("ts")).alias("days"))


def latency(events: DataFrame, by: str) -> DataFrame:
    """Exact percentiles with linear interpolation."""
    p = lambda q, n: F.round(F.percentile("value", F.lit(q)), 6).alias(n)
    return events.groupBy(by).agg(F.min("value").alias("least"), p(0.5, "p50"), p(0.95, "p95"), p(0.99, "p99"), F.max("value").alias("most"), F.count("*").alias("n"))


def spread_sample(rows: DataFrame, id_col: str, n: int) -> DataFrame:
    """n rows evenly spaced in the order of ids (rounded half to even), the first and last among them; all, if there are no more.

    Ranks come from counts per range of ids, so no task sees all rows: ids are ranked within range partitions and offset by their sizes.
    """
    total = rows.count()
    if total <= n:
        return rows
    wanted = {round(k * (total - 1) / (n - 1)) for k in range(n)} if n > 1 else {0}
    # Ranges come from a sample that each execution draws anew, so they are written once, with their numbers.
    ranged = materialize(rows.repartitionByRange(tasks(rows.sparkSession), id_col).withColumn("__p", F.spark_partition_id()), "ranges", scan=True)
    sizes = {r["__p"]: r["c"] for r in ranged.groupBy("__p").agg(F.count("*").alias("c")).collect()}  # one row per partition
    start, offset = {}, 0
    for p in sorted(sizes):
        start[p] = offset
        offset += sizes[p]
    starts = rows.sparkSession.createDataFrame(list(start.items()), "__p int, __start long")
    local = F.row_number().over(Window.partitionBy("__p").orderBy(id_col)) - 1
    return ranged.join(F.broadcast(starts), "__p").withColumn("__rank", local + F.col("__start")).where(F.col("__rank").isin(*wanted)).drop("__p", "__start", "__rank")


def removed(previous: DataFrame, current: DataFrame, key: str) -> DataFrame:
    """Keys of previous that current lacks."""
    return previous.select(key).distinct().join(current.select(key), key, "left_anti")
