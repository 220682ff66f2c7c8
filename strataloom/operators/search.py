"""Hybrid search as an operation over batches of requests: validation, scope, channels, expansion over the graph, reranking and citations."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import names as N
from . import nearest as exact
from . import retrieval

MODES = ("vector", "lexical", "hybrid", "graph_hybrid")
#: Relation types that hold a store together and say nothing. Fixed values.
STRUCTURAL = ("HAS_SOURCE", "MATERIALIZED_AS", "LEGACY_EVIDENCE", "HAS_CHUNK", "HAS_PARENT", "NEXT_CHUNK", "MENTIONS", "IN_COMMUNITY")


@dataclass(frozen=True)
class SearchRequest:
    """A request; one that is out of bounds raises ValueError."""

    query: str
    mode: str = "hybrid"
    top_k: int = 12
    hops: int = 1
    document_ids: Sequence = field(default_factory=tuple)
    source_types: Sequence = field(default_factory=tuple)
    language: str | None = None

    def __post_init__(self):
        if self.mode not in MODES:
            raise ValueError(f"mode {self.mode!r} is none of {MODES}")
        if not self.query.strip():
            raise ValueError("query is empty")
        if not 1 <= self.top_k <= 50:
            raise ValueError("top_k must lie within 1 and 50")
        if self.hops not in (1, 2):
            raise ValueError("hops must be 1 or 2")


def in_scope(units: DataFrame, request_filters: dict[str, Sequence | str | None], revisions: DataFrame) -> DataFrame:
    """Units of active, ready revisions that pass the filters (column: allowed values, or one value); an empty or missing filter lets all pass.

    units: revision_id and the filters' columns; revisions: revision_id, status, vector_ready. Filters and readiness come before any scoring, so that no
    widening of a top-k list is needed.
    """
    live = revisions.where((F.col("status") == "ACTIVE") & F.col("vector_ready")).select("revision_id")
    out = units
    for column, allowed in request_filters.items():
        if allowed is None or (not isinstance(allowed, str) and len(allowed) == 0):
            continue
        out = out.where(F.col(column) == allowed if isinstance(allowed, str) else F.col(column).isin(*allowed))
    return out.join(live, "revision_id", "left_semi")


def same_fingerprint(units: DataFrame, wanted: str) -> DataFrame:
    """units, or an error at the first one whose embedding fingerprint is not the wanted one."""
    return units.where(F.assert_true(F.col("embedding_fingerprint") == wanted, F.concat(F.lit("embedding fingerprint is "), F.coalesce("embedding_fingerprint", F.lit("missing")))).isNull())


def nearest(queries: DataFrame, records: DataFrame, k: int) -> DataFrame:
    """query_id, id, distance, score, rank: the k records of least squared distance per query; score 1 / (1 + distance). Every query is compared with every record, in pairs of blocks."""
    met = exact.nearest(queries, records, k, "squared").withColumnRenamed("value", "distance")
    ranked = met.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy("distance", "id"))).where(F.col("rank") <= k)
    return ranked.withColumn("score", F.round(1 / (1 + F.col("distance")), 6))


def expansion(seeds: DataFrame, mentions: DataFrame, relations: DataFrame, hops: int = 1, most_parents: int = 1000) -> DataFrame:
    """query_id, parent_id, origin, reached, hop: parents that mention entities within hops (0 to `hops`) of those that seed parents mention, with the least hop; seeds left out.

    seeds: query_id, parent_id; mentions: entity, parent_id; relations: source, target, type. Entities with more than most_parents parents neither start nor
    carry a path, which bounds what one hub adds; structural relations do not count.
    """
    if hops not in (0, 1, 2):
        raise ValueError("hops must be 0, 1 or 2")
    m = mentions.select("entity", "parent_id").distinct()
    narrow = m.groupBy("entity").agg(F.count("*").alias("n")).where(F.col("n") <= most_parents).select("entity")
    m = m.join(narrow, "entity", "left_semi")
    r = relations.where(~F.col("type").isin(*STRUCTURAL) & (F.col("source") != F.col("target")))
    both = r.select(F.col("source").alias("u"), F.col("target").alias("v")).unionByName(r.select(F.col("target").alias("u"), F.col("source").alias("v"))).distinct()
    now = seeds.select("query_id", "parent_id").distinct().join(m, "parent_id").select("query_id", F.col("entity").alias("origin"), F.col("entity").alias("reached")).distinct()
    found = now.withColumn("hop", F.lit(0))
    for hop in range(1, hops + 1):
        now = now.join(both, F.col("reached") == F.col("u")).select("query_id", "origin", F.col("v").alias("reached")).distinct()
        found = found.unionByName(now.withColumn("hop", F.lit(hop)))
    found = found.groupBy("query_id", "origin", "reached").agg(F.min("hop").alias("hop"))
    out = found.join(m, F.col("reached") == F.col("entity")).select("query_id", "parent_id", "origin", "reached", "hop")
    return out.join(seeds.select("query_id", "parent_id").distinct(), ["query_id", "parent_id"], "left_anti")


def capped(rows: DataFrame, per_entity: int = 5, per_document: int = 10, limit: int = 125) -> DataFrame:
    """query_id, parent_id, document_id, reached, hop, position of expansion rows that come in before caps close: new parents per reached entity, per document, and in all.

    Rows are taken in the order of hop, parent, origin, reached. What a row does depends on all before it, so a query's rows are walked in one group; the
    first 5 * limit of them are, as in the order of hops.
    """
    order = ["hop", "parent_id", "origin", "reached"]
    first = rows.withColumn("__k", F.row_number().over(Window.partitionBy("query_id").orderBy(*order))).where(F.col("__k") <= 5 * limit)

    def walk(pdf):
        entities, documents, kept = {}, {}, {}
        for r in pdf.sort_values("__k").itertuples():
            if entities.get(r.reached, 0) >= per_entity or documents.get(r.document_id, 0) >= per_document:
                continue
            if r.parent_id not in kept:
                kept[r.parent_id] = r.Index
                entities[r.reached] = entities.get(r.reached, 0) + 1
                documents[r.document_id] = documents.get(r.document_id, 0) + 1
            if len(kept) >= limit:
                break
        out = pdf.loc[list(kept.values())].sort_values("__k")
        out["position"] = range(1, len(out) + 1)
        return out[["query_id", "parent_id", "document_id", "reached", "hop", "position"]]

    kinds = dict(rows.dtypes)
    schema = ", ".join(f"{c} {kinds[c]}" for c in ("query_id", "parent_id", "document_id", "reached", "hop")) + ", position int"
    return first.groupBy("query_id").applyInPandas(walk, schema)


def token_overlap(question: Column, text: Column) -> Column:
    """Share of a question's distinct tokens that a text has: the reranker that needs no model."""
    q, t = N.token_set(question), N.token_set(text)
    return F.round(F.when(F.size(q) > 0, F.size(F.array_intersect(q, t)) / F.size(q)).otherwise(0.0), 6)


def reranked(candidates: DataFrame, score: Column) -> DataFrame:
    """candidates (query_id, id, rrf) with reranker_score and position, by that score (null as 0), then rrf, then id."""
    scored = candidates.withColumn("reranker_score", score)
    w = Window.partitionBy("query_id").orderBy(F.desc(F.coalesce("reranker_score", F.lit(0.0))), F.desc("rrf"), "id")
    return scored.withColumn("position", F.row_number().over(w))


def clipped(parents: DataFrame, tokens: int = 12_000, most: int = 8) -> DataFrame:
    """query_id, id, position, citation, text, used: the parents that fit a budget of white-space tokens; the one that overflows is clipped to a window of what is
    left, which begins a third of it before the match.

    parents: query_id, id, position, text, match_at (place of the matching token, from 0; null as 0). A parent counts once, at its first position.
    """
    once = parents.withColumn("__k", F.row_number().over(Window.partitionBy("query_id", "id").orderBy("position"))).where("__k = 1").drop("__k")
    words = F.filter(F.split(F.coalesce("text", F.lit("")), "[ \t\n\r\f]+"), lambda x: x != "")
    w = Window.partitionBy("query_id").orderBy("position")
    sized = once.withColumn("__w", words).withColumn("__n", F.size("__w"))
    sized = sized.withColumns({"__before": F.coalesce(F.sum("__n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)), "__nth": F.row_number().over(w)})
    kept = sized.where((F.col("__before") < tokens) & (F.col("__nth") <= most)).withColumn("__left", (F.lit(tokens) - F.col("__before")).cast("int"))
    start = F.greatest(F.lit(0), F.least(F.coalesce("match_at", F.lit(0)) - F.floor(F.col("__left") / 3), F.col("__n") - F.col("__left"))).cast("int")
    text = F.when(F.col("__n") <= F.col("__left"), F.array_join("__w", " ")).otherwise(F.array_join(F.slice("__w", start + 1, F.col("__left")), " "))
    return kept.select("query_id", "id", "position", F.concat(F.lit("S"), "__nth").alias("citation"), text.alias("text"), F.least("__n", "__left").alias("used"))


def citations(rows: DataFrame) -> DataFrame:
    """rows (id, text, ...) with preview, the first 280 characters."""
    return rows.withColumn("preview", F.substring("text", 1, 280))


def answered(answers: DataFrame) -> DataFrame:
    """answers (answer, requested, allowed) with citations that are allowed, in order and once, text without tags that are not, and insufficient: no valid citation is left."""
    tags = F.regexp_extract_all("answer", F.lit(r"\[(S\d+)\]"), 1)
    asked = F.array_distinct(F.concat(F.coalesce("requested", F.array().cast("array<string>")), tags))
    valid = F.filter(asked, lambda c: F.array_contains("allowed", c))
    bad = F.array_except(F.array_distinct(tags), F.col("allowed"))
    text = F.aggregate(bad, F.col("answer"), lambda t, c: F.replace(t, F.concat(F.lit("["), c, F.lit("]")), F.lit("")))
    out = answers.withColumns({"citations": valid, "text": F.btrim(F.regexp_replace(text, " +", " "))})
    return out.withColumn("insufficient", F.size("citations") == 0)


def reports_found(hits: DataFrame, k: int) -> DataFrame:
    """query_id, report_id, score, channels, findings, position: reports over all channels' hits (query_id, report_id, channel, score, finding), by greatest score."""
    got = hits.groupBy("query_id", "report_id").agg(F.max("score").alias("score"), F.array_join(F.array_sort(F.collect_set("channel")), ",").alias("channels"), F.countDistinct("finding").alias("findings"))
    return got.withColumn("position", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "report_id"))).where(F.col("position") <= k)


def broadest(reports: DataFrame) -> DataFrame:
    """Reports (build_id, level, rank, report_id) of each build's least level, by falling rank."""
    least = reports.groupBy("build_id").agg(F.min("level").alias("level"))
    return reports.join(least, ["build_id", "level"], "left_semi").withColumn("position", F.row_number().over(Window.partitionBy("build_id").orderBy(F.desc("rank"), "report_id")))


def hybrid(vector: DataFrame, lexical: DataFrame, graph: DataFrame | None, units: DataFrame, top: int = 12) -> DataFrame:
    """query_id, id, group_id, rrf, position: channels of rankings fused, spread over documents (units: id, group_id) and cut at top."""
    channels = {"vector": vector, "lexical": lexical} | ({"graph": graph} if graph is not None else {})
    return retrieval.diversify(retrieval.fuse(channels).join(units.select("id", "group_id"), "id"), top)
