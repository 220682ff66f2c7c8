"""Queries of the ledger, of lifecycle checks and of the compact projection, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import ledger as L
from .registry import _t, query

_SRC = """src AS (SELECT c_custkey AS source_id, CASE WHEN c_custkey % 3 = 0 THEN 'youtube' ELSE 'document' END AS provider, CASE WHEN c_custkey % 6 = 0 THEN 'content:' || c_custkey ELSE 'id:' || c_custkey END AS pid,
CASE c_custkey % 5 WHEN 0 THEN 'LEGACY_ONLY' WHEN 1 THEN 'RETIRED' ELSE 'ACTIVE' END AS st, c_acctbal > 0 AS ready, c_custkey % 4 = 0 AS legacy, CASE WHEN c_custkey % 7 = 0 THEN 'n' || c_custkey END AS alias FROM customer)"""


@query(f"""WITH {_SRC} SELECT count(DISTINCT source_id) AS total, count(DISTINCT source_id) FILTER (st = 'ACTIVE') AS active, count(DISTINCT source_id) FILTER (st = 'LEGACY_ONLY') AS legacy_only, count(DISTINCT source_id) FILTER (ready) AS ready,
count(DISTINCT source_id) FILTER (legacy) AS with_legacy, count(DISTINCT source_id) FILTER (provider = 'youtube') AS youtube, count(DISTINCT source_id) FILTER (provider = 'document') AS documents, count(DISTINCT source_id) FILTER (alias IS NOT NULL) AS aliases,
count(DISTINCT source_id) FILTER (provider = 'youtube' AND starts_with(pid, 'content:')) AS awaiting_video_id FROM src""")
def ledger_audit(spark, d):
    """Customers as sources."""
    k = F.col("c_custkey")
    return L.audit(_t(spark, d, "customer").select(
        k.alias("source_id"), F.when(k % 3 == 0, "youtube").otherwise("document").alias("provider"), F.concat(F.when(k % 6 == 0, "content:").otherwise("id:"), k).alias("provider_source_id"),
        F.when(k % 5 == 0, "LEGACY_ONLY").when(k % 5 == 1, "RETIRED").otherwise("ACTIVE").alias("retrieval_status"), (F.col("c_acctbal") > 0).alias("ready"), (k % 4 == 0).alias("legacy"), F.when(k % 7 == 0, F.concat(F.lit("n"), k)).alias("alias"),
    ))


def _revisions(spark, d):
    return _t(spark, d, "orders").select(F.col("o_orderkey").alias("revision_id"), F.col("o_custkey").alias("document_id"), F.when(F.col("o_orderstatus") == "F", "ACTIVE").otherwise("STAGED").alias("status"))


@query("""WITH d AS (SELECT c_mktsegment AS corpus_id, c_custkey AS k FROM customer), r AS (SELECT o_orderkey, o_custkey FROM orders WHERE o_orderstatus = 'F'), p AS (SELECT o_custkey AS k, count(*) AS n FROM lineitem JOIN r ON l_orderkey = o_orderkey WHERE l_linenumber = 1 GROUP BY 1),
c AS (SELECT o_custkey AS k, count(*) AS n FROM lineitem JOIN r ON l_orderkey = o_orderkey GROUP BY 1), a AS (SELECT o_custkey AS k, count(*) AS n FROM r GROUP BY 1)
SELECT corpus_id, count(*) AS documents, CAST(coalesce(sum(a.n), 0) AS BIGINT) AS active_revisions, CAST(coalesce(sum(p.n), 0) AS BIGINT) AS parents, CAST(coalesce(sum(c.n), 0) AS BIGINT) AS chunks FROM d LEFT JOIN a USING (k) LEFT JOIN p USING (k) LEFT JOIN c USING (k) GROUP BY 1""")
def corpus_counts(spark, d):
    """Segments as corpora, customers as documents, orders as revisions, first lines as parents, lines as chunks."""
    docs = _t(spark, d, "customer").select(F.col("c_mktsegment").alias("corpus_id"), F.col("c_custkey").alias("document_id"))
    lines = _t(spark, d, "lineitem").select(F.col("l_orderkey").alias("revision_id"), "l_linenumber")
    return L.corpus_counts(docs, _revisions(spark, d), lines.where("l_linenumber = 1").drop("l_linenumber"), lines.drop("l_linenumber"))


@query("""WITH c AS (SELECT label AS p, count(*) AS n, count(*) FILTER (vec_id % 9 <> 0 OR label % 2 = 0) AS e FROM embeddings GROUP BY 1)
SELECT count(*) AS parents, count(*) FILTER (n = e) AS complete_parents, CAST(sum(n) AS BIGINT) AS children, CAST(sum(e) AS BIGINT) AS embedded_children FROM c""")
def embedding_coverage(spark, d):
    kept = (F.col("vec_id") % 9 != 0) | (F.col("label") % 2 == 0)
    return L.embedding_coverage(_t(spark, d, "embeddings").select(F.col("label").alias("parent_id"), F.when(kept, F.col("embedding")).alias("embedding")))


@query("""WITH x AS (SELECT vec_id AS id, embedding::DOUBLE[] AS v FROM embeddings) SELECT id, CAST(len(v) AS INTEGER) AS dim, round(v[1], 6) AS first, round(v[-1], 6) AS last, round(list_sum(v), 6) AS total, round(list_sum(list_transform(v, lambda x, i: x * i)), 6) AS weighted FROM x""")
def vector_checksums(spark, d):
    return L.vector_checksums(_t(spark, d, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector")))


@query("""WITH h AS (SELECT o_custkey, o_orderkey, sha256(concat_ws('|', o_orderkey, o_orderpriority)) AS h FROM orders)
SELECT o_custkey, count(*) AS n, sha256(string_agg(o_orderkey || ':' || h, chr(10) ORDER BY o_orderkey)) AS fingerprint FROM h GROUP BY 1""")
def ordered_fingerprints(spark, d):
    return L.ordered_fingerprint(_t(spark, d, "orders"), ["o_custkey"], "o_orderkey", F.concat_ws("|", "o_orderkey", "o_orderpriority"))


_INV = """inv AS (SELECT 'label' AS kind, name, count(*) AS n FROM (SELECT unnest(['Entity', p_brand]) AS name FROM part) GROUP BY 2 UNION ALL SELECT 'property', name, count(*) FROM (SELECT unnest(CASE WHEN p_size > 25 THEN ['name', 'size'] ELSE ['name'] END) AS name FROM part) GROUP BY 2
UNION ALL SELECT 'relation', l_returnflag, count(*) FROM lineitem GROUP BY 2)"""


def _inventory(spark, d):
    size = F.when(F.col("p_size") > 25, F.create_map(F.lit("name"), F.col("p_name"), F.lit("size"), F.col("p_size").cast("string"))).otherwise(F.create_map(F.lit("name"), F.col("p_name")))
    return L.inventory(_t(spark, d, "part").select(F.array(F.lit("Entity"), F.col("p_brand")).alias("labels"), size.alias("properties")), _t(spark, d, "lineitem").select(F.col("l_returnflag").alias("type")))


@query(f"WITH {_INV} SELECT * FROM inv")
def graph_inventory(spark, d):
    return _inventory(spark, d)


@query(f"WITH {_INV} SELECT kind, name, n AS source_n, CASE WHEN kind = 'relation' THEN n + 1 ELSE 0 END AS target_n FROM inv WHERE kind = 'relation' OR n % 2 = 0")
def inventory_differences(spark, d):
    """The inventory against one with another relation in each type, and without the names of even counts."""
    own = _inventory(spark, d)
    other = own.where("kind = 'relation' OR n % 2 <> 0").withColumn("n", F.when(F.col("kind") == "relation", F.col("n") + 1).otherwise(F.col("n")))
    return L.inventory_differences(own, other)


@query("SELECT nodes, relations, 150000::BIGINT AS allowed_nodes, 300000::BIGINT AS allowed_relations, nodes <= 150000 AND relations <= 300000 AS fits FROM (SELECT (SELECT count(*) FROM part) AS nodes, (SELECT count(*) FROM lineitem) AS relations)")
def capacity_gate(spark, d):
    return L.capacity(_t(spark, d, "part").agg(F.count("*").alias("nodes")).crossJoin(F.broadcast(_t(spark, d, "lineitem").agg(F.count("*").alias("relations")))))  # one row each


@query("""WITH n AS (SELECT l_orderkey AS k, count(*) AS p, count(*) FILTER (l_quantity > 1) AS e FROM lineitem GROUP BY 1), r AS (SELECT o_orderkey AS k, CASE WHEN o_orderstatus = 'F' THEN 'ACTIVE' ELSE 'STAGED' END AS st, o_orderkey % 4 <> 0 AS gr FROM orders)
SELECT k AS revision_id, coalesce(p, 0) AS parents, coalesce(e, 0) AS embedded, 4 AS expected, coalesce(p, 0) = 4 AND coalesce(e, 0) = 4 AND st = 'STAGED' AND gr AS activates FROM r LEFT JOIN n USING (k)""")
def compact_activation(spark, d):
    lines = _t(spark, d, "lineitem").select(F.col("l_orderkey").alias("revision_id"), F.when(F.col("l_quantity") > 1, F.col("l_quantity")).alias("embedding"))
    return L.compact_activated(_revisions(spark, d).withColumns({"expected": F.lit(4), "graph_ready": F.col("revision_id") % 4 != 0}), lines)


@query("""WITH c AS (SELECT doc_id AS source, md5(text) AS k, lang AS e, 1 AS v FROM documents WHERE doc_id % 7 <> 0), m AS (SELECT doc_id AS source, CASE WHEN doc_id % 5 = 0 THEN 'old' ELSE md5(text) END AS k, CASE WHEN doc_id % 11 = 0 THEN 'xx' ELSE lang END AS e, 1 AS v, doc_id % 13 = 0 AS s FROM documents WHERE doc_id % 3 <> 0)
SELECT source, CASE WHEN coalesce(m.s, false) THEN 'suppressed' WHEN m.v IS NULL THEN 'added' WHEN c.v IS NULL THEN 'removed' WHEN c.k IS NOT DISTINCT FROM m.k AND c.e IS NOT DISTINCT FROM m.e AND c.v IS NOT DISTINCT FROM m.v THEN 'unchanged' ELSE 'updated' END AS status FROM c FULL JOIN m USING (source)""")
def sync_status(spark, d):
    """Documents against a manifest that lacks some, has others changed, read by another extractor or suppressed."""
    i = F.col("doc_id")
    docs = _t(spark, d, "documents").select(i.alias("source"), F.md5("text").alias("checksum"), F.col("lang").alias("extractor"), F.lit(1).alias("version"), i)
    now = docs.where("doc_id % 7 <> 0").drop("doc_id")
    then = docs.where("doc_id % 3 <> 0").withColumns({"checksum": F.when(i % 5 == 0, "old").otherwise(F.col("checksum")), "extractor": F.when(i % 11 == 0, "xx").otherwise(F.col("extractor")), "suppressed": i % 13 == 0}).drop("doc_id")
    return L.sync_status(now, then)


@query("""WITH h AS (SELECT o_custkey AS key, count(*) AS h FROM orders WHERE o_orderstatus = 'F' GROUP BY 1), l AS (SELECT c_custkey AS key, 1 AS l FROM customer WHERE c_custkey % 3 <> 0), g AS (SELECT c_custkey AS key, 1 AS g FROM customer WHERE c_acctbal > 0)
SELECT key, CASE WHEN h IS NULL THEN 'missing historical' WHEN l IS NULL THEN 'missing live' WHEN h > 1 OR l > 1 THEN 'repeated' WHEN g IS NULL THEN 'no legacy' ELSE 'ok' END AS verdict FROM h FULL JOIN l USING (key) LEFT JOIN g USING (key)""")
def reconciled_inventory(spark, d):
    c = _t(spark, d, "customer").select(F.col("c_custkey").alias("key"), "c_acctbal")
    return L.reconciled(_t(spark, d, "orders").where("o_orderstatus = 'F'").select(F.col("o_custkey").alias("key")), c.where("key % 3 <> 0"), c.where("c_acctbal > 0"))


@query("""WITH e AS (SELECT DISTINCT l_suppkey AS s, l_partkey AS k, 1 AS x FROM lineitem WHERE l_returnflag <> 'R'), f AS (SELECT DISTINCT l_suppkey AS s, l_partkey AS k, 1 AS y FROM lineitem WHERE l_linestatus = 'F')
SELECT s AS l_suppkey, count(*) FILTER (y IS NULL) AS missing, count(*) FILTER (x IS NULL) AS surplus, count(*) FILTER (y IS NULL OR x IS NULL) = 0 AS equal FROM e FULL JOIN f USING (s, k) GROUP BY 1""")
def revision_sets(spark, d):
    line = _t(spark, d, "lineitem")
    return L.same_sets(line.where("l_returnflag <> 'R'"), line.where("l_linestatus = 'F'"), "l_partkey", ["l_suppkey"])


@query("""SELECT o_orderkey AS parent_id, CASE o_orderstatus WHEN 'O' THEN 'PENDING' WHEN 'P' THEN 'RUNNING' ELSE CASE WHEN o_orderkey % 2 = 0 THEN 'FAILED' ELSE 'COMPLETED' END END AS status, o_orderkey % 4 AS attempts, o_orderdate AS created_at, o_custkey AS position,
CASE o_orderstatus WHEN 'O' THEN 0 WHEN 'P' THEN 2 ELSE 1 END AS priority FROM orders WHERE NOT (o_orderstatus = 'F' AND o_orderkey % 2 <> 0) AND o_orderkey % 4 < 3 ORDER BY priority, created_at, position, parent_id LIMIT 100""")
def graph_queue(spark, d):
    """The next hundred parents; those tried three times are not taken again."""
    k, s = F.col("o_orderkey"), F.col("o_orderstatus")
    status = F.when(s == "O", "PENDING").when(s == "P", "RUNNING").when(k % 2 == 0, "FAILED").otherwise("COMPLETED")
    parents = _t(spark, d, "orders").select(k.alias("parent_id"), status.alias("status"), (k % 4).alias("attempts"), F.col("o_orderdate").alias("created_at"), F.col("o_custkey").alias("position"))
    return L.graph_queue(parents, 100, 3)


@query("""SELECT o_orderkey AS parent_id, CASE WHEN o_orderkey % 5 = 0 THEN NULL WHEN o_orderstatus = 'P' THEN 'FAILED' ELSE 'DONE' END AS claim_status, CASE WHEN o_orderkey % 3 = 0 THEN 'v0' WHEN o_orderkey % 3 = 1 THEN 'v1' END AS claim_fingerprint FROM orders
WHERE o_orderkey % 5 = 0 OR o_orderstatus = 'P' OR o_orderkey % 3 <> 1 ORDER BY parent_id LIMIT 100""")
def claim_queue(spark, d):
    k = F.col("o_orderkey")
    status = F.when(k % 5 == 0, None).when(F.col("o_orderstatus") == "P", "FAILED").otherwise("DONE")
    return L.claim_queue(_t(spark, d, "orders").select(k.alias("parent_id"), status.alias("claim_status"), F.when(k % 3 == 0, "v0").when(k % 3 == 1, "v1").alias("claim_fingerprint")), "v1", 100)


@query("""WITH b AS (SELECT DISTINCT l_partkey AS e, l_suppkey AS p FROM lineitem WHERE l_quantity > 45), r AS (SELECT DISTINCT l_partkey AS s, (l_partkey + l_suppkey) % (SELECT count(*) FROM part) AS t FROM lineitem WHERE l_linenumber = 1)
SELECT s AS source, t AS target, count(*) AS parents FROM r JOIN b x ON x.e = s JOIN b y ON y.e = t AND y.p = x.p GROUP BY 1, 2""")
def grounded_relations(spark, d):
    """Relations of parts, held up by suppliers that both have lines of more than 45 pieces with."""
    line = _t(spark, d, "lineitem")
    n = _t(spark, d, "part").agg(F.count("*").alias("n"))
    rel = line.where("l_linenumber = 1").crossJoin(F.broadcast(n)).select(F.col("l_partkey").alias("source"), ((F.col("l_partkey") + F.col("l_suppkey")) % F.col("n")).alias("target"))  # n is one row
    return L.grounded_relations(rel, line.where("l_quantity > 45").select(F.col("l_partkey").alias("entity"), F.col("l_suppkey").alias("parent_id")))


_TRI = r"""list_filter(string_split_regex(lower(coalesce({0}, '')), '[^\p{{L}}\p{{N}}]+'), lambda t: t <> '')"""
_S3 = "CASE WHEN len(t) = 0 THEN [] WHEN len(t) < 3 THEN [array_to_string(t, ' ')] ELSE list_distinct(list_transform(range(1, len(t) - 1), lambda i: array_to_string(t[i:i + 2], ' '))) END"


@query(f"""WITH a AS (SELECT conv_id, turn, {_TRI.format("substr(text, 1, length(text) - 5)")} AS t FROM conversations WHERE turn % 2 = 0), o AS (SELECT conv_id, turn, {_S3} AS s FROM a), b AS (SELECT conv_id, turn, {_TRI.format("text")} AS t FROM conversations), p AS (SELECT conv_id, turn, {_S3} AS s FROM b),
m AS (SELECT o.conv_id || '/' || o.turn AS old_id, p.conv_id || '/' || p.turn AS parent_id, len(list_intersect(o.s, p.s)) / len(o.s) AS coverage FROM o JOIN p USING (conv_id) WHERE len(o.s) > 0), g AS (SELECT *, rank() OVER (PARTITION BY old_id ORDER BY coverage DESC) AS r FROM m WHERE coverage >= 0.5)
SELECT old_id, any_value(parent_id) AS parent_id, round(any_value(coverage), 6) AS coverage FROM g WHERE r = 1 GROUP BY 1 HAVING count(*) = 1""")
def best_matches(spark, d):
    """Even turns without their last five characters against all turns of the conversation."""
    c = _t(spark, d, "conversations").withColumn("key", F.concat_ws("/", "conv_id", "turn"))
    old = c.where("turn % 2 = 0").select(F.col("key").alias("old_id"), F.col("conv_id").alias("source"), F.substring("text", F.lit(1), F.length("text") - 5).alias("text"))
    return L.best_matches(old, c.select(F.col("key").alias("parent_id"), F.col("conv_id").alias("source"), "text"))


@query(f"""WITH w AS (SELECT conv_id, turn, {_TRI.format("text")} AS t FROM conversations), e AS (SELECT DISTINCT conv_id, array_to_string(t[1:2], ' ') AS x FROM w WHERE turn = 0 AND len(t) > 0)
SELECT DISTINCT e.conv_id AS entity, w.conv_id || '/' || w.turn AS parent_id FROM e JOIN w USING (conv_id) WHERE contains(' ' || array_to_string(t, ' ') || ' ', ' ' || x || ' ')""")
def exact_mentions(spark, d):
    """The first two words of a conversation as a name, found in its turns."""
    from ..functions.names import name_tokens

    c = _t(spark, d, "conversations")
    name = F.array_join(F.slice(name_tokens(F.col("text")), 1, 2), " ")
    entities = c.where("turn = 0").select(F.col("conv_id").alias("entity"), F.col("conv_id").alias("source"), name.alias("name"))
    return L.exact_mentions(entities, c.select(F.concat_ws("/", "conv_id", "turn").alias("parent_id"), F.col("conv_id").alias("source"), "text"))


@query("""WITH s AS (SELECT o_orderpriority AS dataset, o_orderkey % 20 AS a, o_custkey % 20 AS b FROM orders)
SELECT dataset, count(*) AS n, round(avg(a), 6) AS mean_a, round(avg(b), 6) AS mean_b, round(avg(a) / 2, 6) AS rating_a, round(avg(b) / 2, 6) AS rating_b, count(*) FILTER (a > b) AS wins_a, count(*) FILTER (a < b) AS wins_b, count(*) FILTER (a = b) AS ties FROM s GROUP BY ROLLUP (dataset)""")
def ab_summary(spark, d):
    return L.ab_summary(_t(spark, d, "orders").select(F.col("o_orderpriority").alias("dataset"), (F.col("o_orderkey") % 20).alias("score_a"), (F.col("o_custkey") % 20).alias("score_b")))


@query("""SELECT conv_id, turn, CASE WHEN turn % 3 = 0 AND turn % 2 = 0 THEN 1.0 WHEN turn % 5 = 0 THEN 0.0 ELSE turn / 10 END AS effective FROM conversations""")
def citation_validity(spark, d):
    t = F.col("turn")
    rows = _t(spark, d, "conversations").select("conv_id", "turn", F.when(t % 2 == 0, "Insufficient evidence to tell.").otherwise(F.col("text")).alias("answer"), F.when(t % 3 == 0, F.array().cast("array<string>")).otherwise(F.array(F.lit("S1"))).alias("citations"), F.when(t % 5 != 0, t / 10).alias("validity"))
    return L.citation_validity(rows).select("conv_id", "turn", "effective")


@query("SELECT count(*) AS n, count(*) FILTER (item_id % 7 = 0) AS different, count(*) FILTER (item_id % 7 = 0) = 0 AS equal FROM benchmark")
def question_lists(spark, d):
    b = _t(spark, d, "benchmark").select(F.col("item_id").alias("position"), F.col("item_id").alias("id"), "text", F.lit("factual").alias("category"))
    return L.positional_match(b, b.withColumn("category", F.when(F.col("position") % 7 == 0, "bridge").otherwise(F.col("category"))))


@query("""WITH t AS (SELECT DISTINCT l_orderkey AS p, l_linenumber % 2 AS s, l_suppkey AS term FROM lineitem), n AS (SELECT count(DISTINCT p) AS n FROM t), k AS (SELECT term FROM t GROUP BY 1 HAVING count(DISTINCT p) <= greatest((SELECT n FROM n) * 0.5, 1))
SELECT a.term AS a, b.term AS b, count(*) AS n FROM t a JOIN t b USING (p, s) WHERE a.term < b.term AND a.term IN (SELECT term FROM k) AND b.term IN (SELECT term FROM k) GROUP BY 1, 2 HAVING count(*) >= 2""")
def term_cooccurrence(spark, d):
    """Suppliers as terms, orders as parents, odd and even lines as their sentences."""
    return L.cooccurrence(_t(spark, d, "lineitem").select(F.col("l_orderkey").alias("parent_id"), (F.col("l_linenumber") % 2).alias("sentence"), F.col("l_suppkey").alias("term")))
