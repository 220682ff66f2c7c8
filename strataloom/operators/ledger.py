"""The ledger of sources, corpus counts, gates, queues and reconciliations, and the compact projection's coverage, grounding and fingerprints."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import names as N


def audit(sources: DataFrame) -> DataFrame:
    """One row of counts over sources (source_id, provider, provider_source_id, retrieval_status, ready, legacy, alias)."""
    n = lambda c: F.count_distinct(F.when(c, F.col("source_id")))
    tube = F.col("provider") == "youtube"
    return sources.agg(
        F.count_distinct("source_id").alias("total"), n(F.col("retrieval_status") == "ACTIVE").alias("active"), n(F.col("retrieval_status") == "LEGACY_ONLY").alias("legacy_only"), n(F.col("ready")).alias("ready"),
        n(F.col("legacy")).alias("with_legacy"), n(tube).alias("youtube"), n(F.col("provider") == "document").alias("documents"), n(F.col("alias").isNotNull()).alias("aliases"),
        n(tube & F.startswith("provider_source_id", F.lit("content:"))).alias("awaiting_video_id"),
    )


def corpus_counts(documents: DataFrame, revisions: DataFrame, parents: DataFrame, chunks: DataFrame) -> DataFrame:
    """corpus_id, documents, active_revisions, parents, chunks: of active revisions, counted level by level, so that no join multiplies rows."""
    live = revisions.where("status = 'ACTIVE'").select("revision_id", "document_id")
    own = lambda df: df.join(live, "revision_id").groupBy("document_id").agg(F.count("*").alias("n"))
    d = documents.select("corpus_id", "document_id").distinct()
    per = d.join(live.groupBy("document_id").agg(F.count("*").alias("r")), "document_id", "left").join(own(parents).withColumnRenamed("n", "p"), "document_id", "left").join(own(chunks).withColumnRenamed("n", "c"), "document_id", "left")
    total = lambda x: F.coalesce(F.sum(x), F.lit(0)).cast("long")
    return per.groupBy("corpus_id").agg(F.count("*").alias("documents"), total("r").alias("active_revisions"), total("p").alias("parents"), total("c").alias("chunks"))


def embedding_coverage(children: DataFrame) -> DataFrame:
    """One row: parents, complete_parents, children, embedded_children of children (parent_id, embedding)."""
    per = children.groupBy("parent_id").agg(F.count("*").alias("n"), F.count("embedding").alias("e"))
    return per.agg(F.count("*").alias("parents"), F.count_if(F.col("n") == F.col("e")).alias("complete_parents"), F.coalesce(F.sum("n"), F.lit(0)).alias("children"), F.coalesce(F.sum("e"), F.lit(0)).alias("embedded_children"))


def vector_checksums(records: DataFrame) -> DataFrame:
    """id, dim, first, last, total, weighted: of each vector (id, vector); weighted multiplies by places from 1 on."""
    v = F.transform("vector", lambda x: x.cast("double"))
    add = lambda a: F.round(F.aggregate(a, F.lit(0.0), lambda s, x: s + x), 6)
    return records.select("id", F.size("vector").alias("dim"), F.round(F.get(v, F.lit(0)), 6).alias("first"), F.round(F.try_element_at(v, F.lit(-1)), 6).alias("last"), add(v).alias("total"), add(F.transform(v, lambda x, i: x * (i + 1))).alias("weighted"))


def ordered_fingerprint(rows: DataFrame, by: list[str], id_col: str, payload: Column) -> DataFrame:
    """by, n, fingerprint: SHA-256 over the rows' digests in the order of ids, per group; groups are a document's or revision's rows."""
    one = F.struct(F.col(id_col).alias("id"), F.sha2(payload, 256).alias("h"))
    got = rows.groupBy(*by).agg(F.count("*").alias("n"), F.array_sort(F.collect_list(one)).alias("all"))
    return got.select(*by, "n", F.sha2(F.array_join(F.transform("all", lambda x: F.concat_ws(":", x["id"].cast("string"), x["h"])), "\n"), 256).alias("fingerprint"))


def inventory(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """kind, name, n: nodes by label, edges by type, and how many nodes have each property. nodes: labels (array), properties (map); edges: type."""
    label = nodes.select(F.explode("labels").alias("name")).groupBy("name").agg(F.count("*").alias("n")).select(F.lit("label").alias("kind"), "name", "n")
    prop = nodes.select(F.explode(F.map_keys("properties")).alias("name")).groupBy("name").agg(F.count("*").alias("n")).select(F.lit("property").alias("kind"), "name", "n")
    rel = edges.groupBy(F.col("type").alias("name")).agg(F.count("*").alias("n")).select(F.lit("relation").alias("kind"), "name", "n")
    return label.unionByName(prop).unionByName(rel)


def inventory_differences(source: DataFrame, target: DataFrame) -> DataFrame:
    """kind, name, source_n, target_n where two inventories differ; what one side lacks is 0."""
    both = source.withColumnRenamed("n", "source_n").join(target.withColumnRenamed("n", "target_n"), ["kind", "name"], "full_outer")
    return both.select("kind", "name", F.coalesce("source_n", F.lit(0)).alias("source_n"), F.coalesce("target_n", F.lit(0)).alias("target_n")).where("source_n <> target_n")


def capacity(counts: DataFrame, most_nodes: int = 200_000, most_relations: int = 400_000, headroom: float = 0.25) -> DataFrame:
    """counts (nodes, relations) with allowed numbers, which keep the headroom free, and fits."""
    nodes, relations = int(most_nodes * (1 - headroom)), int(most_relations * (1 - headroom))
    return counts.select("nodes", "relations", F.lit(nodes).cast("long").alias("allowed_nodes"), F.lit(relations).cast("long").alias("allowed_relations"), ((F.col("nodes") <= nodes) & (F.col("relations") <= relations)).alias("fits"))


def compact_activated(revisions: DataFrame, parents: DataFrame) -> DataFrame:
    """revision_id, parents, embedded, expected, activates: stored parents, embedded parents and the expected number agree, and the revision is STAGED and graph_ready."""
    n = parents.groupBy("revision_id").agg(F.count("*").alias("parents"), F.count("embedding").alias("embedded"))
    j = revisions.join(n, "revision_id", "left").withColumns({"parents": F.coalesce("parents", F.lit(0)), "embedded": F.coalesce("embedded", F.lit(0))})
    ok = (F.col("parents") == F.col("expected")) & (F.col("embedded") == F.col("expected")) & (F.col("status") == "STAGED") & F.col("graph_ready")
    return j.select("revision_id", "parents", "embedded", "expected", ok.alias("activates"))


def sync_status(current: DataFrame, manifest: DataFrame) -> DataFrame:
    """source, status: unchanged (checksum, extractor and its version agree), updated, added, removed or suppressed (in the manifest so, whatever is found)."""
    side = lambda df, x: df.select("source", *(F.col(c).alias(f"{c}_{x}") for c in df.columns if c != "source"))
    j = side(current, "c").withColumn("__c", F.lit(True)).join(side(manifest, "m").withColumn("__m", F.lit(True)), "source", "full_outer")
    same = F.col("checksum_c").eqNullSafe(F.col("checksum_m")) & F.col("extractor_c").eqNullSafe(F.col("extractor_m")) & F.col("version_c").eqNullSafe(F.col("version_m"))
    status = F.when(F.coalesce("suppressed_m", F.lit(False)), "suppressed").when(F.col("__m").isNull(), "added").when(F.col("__c").isNull(), "removed").when(same, "unchanged").otherwise("updated")
    return j.select("source", status.alias("status"))


def reconciled(historical: DataFrame, live: DataFrame, legacy: DataFrame) -> DataFrame:
    """key, verdict: ok (once on both sides, at least one legacy row), missing live, missing historical, repeated or no legacy. Each side: key."""
    n = lambda df, x: df.groupBy("key").agg(F.count("*").alias(x))
    j = n(historical, "h").join(n(live, "l"), "key", "full_outer").join(n(legacy, "g"), "key", "left")
    verdict = F.when(F.col("h").isNull(), "missing historical").when(F.col("l").isNull(), "missing live").when((F.col("h") > 1) | (F.col("l") > 1), "repeated").when(F.col("g").isNull(), "no legacy").otherwise("ok")
    return j.select("key", verdict.alias("verdict"))


def same_sets(expected: DataFrame, found: DataFrame, key: str, by: list[str]) -> DataFrame:
    """by, missing, surplus, equal: how two sets of keys differ per group."""
    e, f = expected.select(*by, key).distinct().withColumn("__e", F.lit(1)), found.select(*by, key).distinct().withColumn("__f", F.lit(1))
    got = e.join(f, [*by, key], "full_outer").groupBy(*by).agg(F.count_if(F.col("__f").isNull()).alias("missing"), F.count_if(F.col("__e").isNull()).alias("surplus"))
    return got.withColumn("equal", (F.col("missing") == 0) & (F.col("surplus") == 0))


def graph_queue(parents: DataFrame, limit: int, most_attempts: int | None = None) -> DataFrame:
    """The next parents (parent_id, status, attempts, created_at, position): PENDING before FAILED before others, then the oldest, then by position. COMPLETED ones are not queued, nor those tried most_attempts times."""
    order = F.when(F.col("status") == "PENDING", 0).when(F.col("status") == "FAILED", 1).otherwise(2)
    open_ = parents.where("status <> 'COMPLETED'")
    open_ = open_ if most_attempts is None else open_.where(F.col("attempts") < most_attempts)
    return open_.withColumn("priority", order).orderBy("priority", "created_at", "position", "parent_id").limit(limit)


def claim_queue(parents: DataFrame, fingerprint: str, limit: int) -> DataFrame:
    """The next parents (parent_id, claim_status, claim_fingerprint) to take claims from: none taken, failed, or taken by another extractor."""
    stale = F.col("claim_status").isNull() | (F.col("claim_status") == "FAILED") | ~F.col("claim_fingerprint").eqNullSafe(fingerprint)
    return parents.where(stale).orderBy("parent_id").limit(limit)


def grounded_relations(relations: DataFrame, bridges: DataFrame) -> DataFrame:
    """source, target, parents: how many parents mention both ends (bridges: entity, parent_id); relations without any are left out."""
    b = bridges.select("entity", "parent_id").distinct()
    side = lambda x: b.select(F.col("entity").alias(x), "parent_id")
    met = relations.select("source", "target").distinct().join(side("source"), "source").join(side("target"), ["target", "parent_id"])
    return met.groupBy("source", "target").agg(F.count("*").alias("parents"))


def best_matches(old: DataFrame, parents: DataFrame, least: float = 0.5) -> DataFrame:
    """old_id, parent_id, coverage: the parent of the same source that has most of an old text's word triples; none where two tie, or below `least`.

    old: old_id, source, text; parents: parent_id, source, text. Texts meet on triples, so pairs that share none are never made; a triple of more than
    a thousand parents of its source is in every one of them and decides nothing beside the others, and still counts.
    """
    cut = lambda df, i: df.select(i, "source", N.shingles(N.name_tokens(F.col("text"))).alias("s")).withColumn("n", F.size("s"))
    a, b = cut(old, "old_id"), cut(parents, "parent_id")
    met = a.select("old_id", "source", "n", F.explode("s").alias("x")).join(b.select("parent_id", "source", F.explode("s").alias("x")), ["source", "x"])
    scored = met.groupBy("old_id", "parent_id").agg((F.count("*") / F.max("n")).alias("coverage")).where(F.col("coverage") >= least)
    w = Window.partitionBy("old_id")
    top = scored.withColumn("__r", F.rank().over(w.orderBy(F.desc("coverage")))).where("__r = 1").withColumn("__n", F.count("*").over(w))
    return top.where("__n = 1").select("old_id", "parent_id", F.round("coverage", 6).alias("coverage"))


def exact_mentions(entities: DataFrame, parents: DataFrame) -> DataFrame:
    """entity, parent_id: entities (entity, source, name) whose tokens stand in a row in a parent (parent_id, source, text) of the same source.

    Names meet texts on equal runs of as many words, for the lengths that names have; a name is never found within a word.
    """
    named = entities.select("entity", "source", N.name_tokens(F.col("name")).alias("t")).where(F.size("t") > 0).select("entity", "source", F.size("t").alias("n"), F.array_join("t", " ").alias("x"))
    lengths = named.select("source", "n").distinct()
    words = parents.select("parent_id", "source", N.name_tokens(F.col("text")).alias("t")).join(lengths, "source").where(F.size("t") >= F.col("n"))
    runs = F.array_distinct(F.transform(F.sequence(F.lit(1), F.size("t") - F.col("n") + 1), lambda i: F.array_join(F.slice("t", i, F.col("n")), " ")))
    return named.join(words.select("parent_id", "source", "n", F.explode(runs).alias("x")), ["source", "n", "x"]).select("entity", "parent_id").distinct()


def ab_summary(scores: DataFrame) -> DataFrame:
    """dataset (null for all), n, mean_a, mean_b, rating_a, rating_b (out of 10, of scores out of 20), wins_a, wins_b, ties."""
    d = F.col("score_a") - F.col("score_b")
    r = lambda c, k: F.round(F.avg(c) / k, 6)
    return scores.rollup("dataset").agg(F.count("*").alias("n"), r("score_a", 1).alias("mean_a"), r("score_b", 1).alias("mean_b"), r("score_a", 2).alias("rating_a"), r("score_b", 2).alias("rating_b"), F.count_if(d > 0).alias("wins_a"), F.count_if(d < 0).alias("wins_b"), F.count_if(d == 0).alias("ties"))


def citation_validity(answers: DataFrame) -> DataFrame:
    """answers (answer, citations, validity) with effective: 1 if nothing is cited and the answer says that evidence is insufficient, else the validity (null as 0)."""
    none = F.coalesce(F.size("citations"), F.lit(0)) <= 0
    return answers.withColumn("effective", F.when(none & F.contains(F.coalesce("answer", F.lit("")), F.lit("Insufficient evidence")), 1.0).otherwise(F.coalesce("validity", F.lit(0.0))))


def positional_match(baseline: DataFrame, candidate: DataFrame) -> DataFrame:
    """One row: whether two question lists (position, id, text, category) are equal place by place, and how many places differ."""
    side = lambda df, x: df.select("position", F.struct("id", "text", "category").alias(x))
    both = side(baseline, "b").join(side(candidate, "c"), "position", "full_outer")
    return both.agg(F.count("*").alias("n"), F.count_if(~F.col("b").eqNullSafe(F.col("c"))).alias("different")).withColumn("equal", F.col("different") == 0)


def cooccurrence(terms: DataFrame, most_share: float = 0.5, least: int = 2) -> DataFrame:
    """a, b, n: in how many sentences two terms stand together (a < b), at least `least`. terms: parent_id, sentence, term.

    Terms of more than most_share of all parents are hubs and left out first, which also bounds what one term can pair with.
    """
    t = terms.select("parent_id", "sentence", "term").distinct()
    parents = t.agg(F.count_distinct("parent_id").alias("parents"))
    rare = t.groupBy("term").agg(F.count_distinct("parent_id").alias("df")).join(F.broadcast(parents)).where(F.col("df") <= F.greatest(F.col("parents") * most_share, F.lit(1.0))).select("term")
    kept = t.join(rare, "term", "left_semi")
    a, b = kept.withColumnRenamed("term", "a"), kept.withColumnRenamed("term", "b")
    return a.join(b, ["parent_id", "sentence"]).where("a < b").groupBy("a", "b").agg(F.count("*").alias("n")).where(F.col("n") >= least)
