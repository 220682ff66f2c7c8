"""Batch retrieval: rankings per query, their fusion, diversity and context budget."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .nearest import nearest


def vector_top_k(queries: DataFrame, records: DataFrame, k: int, max_queries: int = 10_000) -> DataFrame:
    """query_id, id, score, rank: the k records (id, vector) of greatest cosine similarity per query (query_id, vector); 0 with a zero vector; ties by id.

    Every query is compared with every record, in pairs of blocks of at most about max_queries queries (see nearest).
    """
    return _ranked(nearest(queries, records, k, "cosine", max_queries).withColumnRenamed("value", "score"), k)


def _ranked(scored: DataFrame, k: int) -> DataFrame:
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    return scored.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def bm25_top_k(queries: DataFrame, docs: DataFrame, k: int, k1: float = 1.2, b: float = 0.75) -> DataFrame:
    """query_id, id, score, rank by BM25; queries (query_id, text), docs (id, text); terms are lower-case runs of a-z and digits."""
    terms = lambda t: F.filter(F.split(F.lower(F.coalesce(F.col(t), F.lit(""))), "[^a-z0-9]+"), lambda x: x != "")
    tokens = docs.select("id", terms("text").alias("ts")).withColumn("len", F.size("ts"))
    size = tokens.agg(F.count("*").alias("n"), F.avg("len").alias("avg_len"))
    wanted = queries.select("query_id", F.explode(F.array_distinct(terms("text"))).alias("term"))
    tf = tokens.select("id", "len", F.explode("ts").alias("term")).join(wanted.select("term").distinct(), "term", "left_semi").groupBy("term", "id", "len").agg(F.count("*").alias("tf"))
    df = tf.groupBy("term").agg(F.count("*").alias("df"))
    hits = tf.join(df, "term").join(wanted, "term").crossJoin(F.broadcast(size))  # size is one row
    idf = F.log1p((F.col("n") - F.col("df") + 0.5) / (F.col("df") + 0.5))
    gain = F.col("tf") * (k1 + 1) / (F.col("tf") + k1 * (1 - b + b * F.col("len") / F.col("avg_len")))
    return _ranked(hits.groupBy("query_id", "id").agg(F.round(F.sum(idf * gain), 6).alias("score")), k)


def fuse(channels: dict[str, DataFrame], k: int = 60) -> DataFrame:
    """Reciprocal-rank fusion of rankings (query_id, id, rank): query_id, id, rrf, channels (sorted)."""
    parts = [df.select("query_id", "id", "rank", F.lit(name).alias("channel")) for name, df in channels.items()]
    every = parts[0]
    for p in parts[1:]:
        every = every.unionByName(p)
    return every.groupBy("query_id", "id").agg(F.round(F.sum(1 / (F.lit(float(k)) + F.col("rank"))), 9).alias("rrf"), F.array_join(F.array_sort(F.collect_set("channel")), ",").alias("channels"))


def diversify(fused: DataFrame, top: int, cap: int = 4, least_groups: int = 3) -> DataFrame:
    """At most cap rows per group if a query has at least least_groups groups, else no cap; then the first `top` in order. Rows: query_id, id, group_id, rrf."""
    order = [F.desc("rrf"), "id"]
    seen = fused.groupBy("query_id").agg(F.countDistinct("group_id").alias("groups"))
    within = F.row_number().over(Window.partitionBy("query_id", "group_id").orderBy(*order))
    kept = fused.join(seen, "query_id").withColumn("in_group", within).where((F.col("groups") < least_groups) | (F.col("in_group") <= cap))
    return kept.withColumn("position", F.row_number().over(Window.partitionBy("query_id").orderBy(*order))).where(F.col("position") <= top).select("query_id", "id", "group_id", "rrf", "position")


def budget(chosen: DataFrame, tokens: int = 12_000, parents: int = 8) -> DataFrame:
    """Rows (query_id, position, n_tokens) that fit a token budget: adds used (tokens taken; the row that overflows is clipped) and citation."""
    w = Window.partitionBy("query_id").orderBy("position")
    before = F.coalesce(F.sum("n_tokens").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    out = chosen.withColumn("before", before).withColumn("nth", F.row_number().over(w)).where((F.col("before") < tokens) & (F.col("nth") <= parents))
    return out.withColumns({"used": F.least(F.col("n_tokens"), tokens - F.col("before")), "citation": F.concat(F.lit("S"), F.col("nth"))}).drop("before", "nth")
