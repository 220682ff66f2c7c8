"""Queries of ingestion, resolution and evaluation, with their SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import corpus, entities, ingest
from .registry import _BLOCKS, _docs, _t, query

_WORDS = r"list_filter(string_split_regex(coalesce(text, ''), '[ \t\n\r\f]+'), lambda w: w <> '')"
NAMESPACE = str(uuid.NAMESPACE_URL)


@query(f"""WITH w AS (SELECT doc_id, {_WORDS} AS ws FROM documents), p AS (SELECT *, unnest(range(CASE WHEN len(ws) > 192 THEN CAST(ceil((len(ws) - 192) / 168.0) AS BIGINT) + 1 ELSE 1 END)) AS position FROM w WHERE len(ws) > 0)
SELECT doc_id AS document_id, position, len(ws[position * 168 + 1 : position * 168 + 192]) AS n_words, array_to_string(ws[position * 168 + 1 : position * 168 + 192], ' ') AS text FROM p""")
def sliding_window_chunks(spark, d):
    return ingest.windows(_docs(spark, d))


@query(_BLOCKS + "SELECT document_id, ordinal // 6 AS part, count(*) AS n_blocks, string_agg(text, chr(10) ORDER BY ordinal) AS text FROM b GROUP BY 1, 2")
def combined_blocks(spark, d):
    return ingest.combined(corpus.blocks(_docs(spark, d)), 6)


def _uuid(g: str) -> str:
    return f"substr({g}, 1, 8) || '-' || substr({g}, 9, 4) || '-5' || substr({g}, 14, 3) || '-' || lower(printf('%02x', (CAST('0x' || substr({g}, 17, 2) AS INTEGER) & 63) | 128)) || substr({g}, 19, 2) || '-' || substr({g}, 21, 12)"


@query(f"""WITH c AS (SELECT doc_id, source, sha1(unhex('{NAMESPACE.replace("-", "")}') || encode(array_to_string(list_filter(string_split(replace(lower(trim(source, ' ')), '_', '-'), '-'), lambda p: p <> ''), '-'))) AS g FROM documents WHERE source IS NOT NULL),
k AS (SELECT doc_id, {_uuid("g")} AS corpus_id FROM c), e AS (SELECT doc_id, corpus_id, sha1(unhex(replace(corpus_id, '-', '')) || encode(CAST(doc_id AS VARCHAR))) AS g FROM k)
SELECT doc_id, corpus_id, {_uuid("g")} AS document_id FROM e""")
def document_ids(spark, d):
    corpus_id = T.uuid5(F.lit(NAMESPACE), T.corpus_key(F.col("source")))
    docs = _t(spark, d, "documents").where("source IS NOT NULL").select("doc_id", corpus_id.alias("corpus_id"))
    return docs.select("doc_id", "corpus_id", T.uuid5(F.col("corpus_id"), F.col("doc_id").cast("string")).alias("document_id"))


_URI = r"""u AS (SELECT page_id, html, trim(url, ' ') AS v FROM pages), s AS (SELECT *, regexp_extract(v, '^((?i:https?))://([^/?#]*)([^?#]*)(\?[^#]+)?', 1) AS scheme, regexp_replace(lower(regexp_extract(v, '^((?i:https?))://([^/?#]*)([^?#]*)(\?[^#]+)?', 2)), '^www\.', '') AS host,
regexp_replace(regexp_extract(v, '^((?i:https?))://([^/?#]*)([^?#]*)(\?[^#]+)?', 3), '/+$', '') AS stem, regexp_extract(v, '^((?i:https?))://([^/?#]*)([^?#]*)(\?[^#]+)?', 4) AS q FROM u),
c AS (SELECT page_id, html, CASE WHEN v = '' THEN NULL WHEN scheme = '' THEN lower(v) WHEN host = 'youtu.be' AND regexp_matches(stem, '^/[A-Za-z0-9_-]{11}$') THEN 'https://www.youtube.com/watch?v=' || substr(stem, 2)
WHEN host IN ('youtube.com', 'm.youtube.com') AND regexp_matches(q, '[?&]v=[A-Za-z0-9_-]{11}(&|$)') THEN 'https://www.youtube.com/watch?v=' || regexp_extract(q, '[?&]v=([A-Za-z0-9_-]{11})(&|$)', 1)
ELSE lower(scheme) || '://' || host || CASE WHEN stem = '' THEN '/' ELSE stem END || q END AS uri FROM s)"""


@query(f"WITH {_URI} SELECT page_id, uri FROM c")
def canonical_uris(spark, d):
    return _t(spark, d, "pages").select("page_id", T.canonical_uri(F.col("url")).alias("uri"))


_FP = f"sha256(lower(array_to_string({_WORDS}, ' ')))"


@query(f"SELECT doc_id AS document_id, {_FP} AS checksum FROM documents")
def content_fingerprints(spark, d):
    return ingest.fingerprinted(_docs(spark, d))


_TERM = r"[\p{L}\p{N}_-]+"


@query(rf"""WITH runs AS (SELECT doc_id, unnest(regexp_extract_all(text, '(^|[^\p{{L}}\p{{N}}_])([A-Z]{_TERM}([ \t\n\r\f]+[A-Z]{_TERM}){{0,3}})', 2)) AS x FROM documents),
tk AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '{_TERM}')) AS x FROM documents), rep AS (SELECT doc_id, x FROM tk WHERE length(x) >= 5 AND NOT regexp_full_match(x, '[0-9]+') GROUP BY 1, 2 HAVING count(*) >= 2),
t AS (SELECT DISTINCT doc_id, regexp_replace(regexp_replace(array_to_string(list_filter(string_split_regex(x, '[ \t\n\r\f]+'), lambda w: w <> ''), ' '), '^[-_ ]+', ''), '[-_ ]+$', '') AS term FROM (SELECT * FROM runs UNION ALL SELECT * FROM rep)),
f AS (SELECT * FROM t WHERE term <> '' QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY lower(term), term) <= 40),
k AS (SELECT lower(term) AS k, count(*) AS df FROM f GROUP BY 1 HAVING count(*) <= (SELECT greatest(1, floor(count(*) * 0.5)) FROM documents))
SELECT doc_id AS document_id, term, df FROM f JOIN k ON lower(term) = k""")
def provisional_terms(spark, d):
    return ingest.provisional_terms(_docs(spark, d))


@query(f"""WITH cur AS (SELECT doc_id, {_FP} AS c FROM documents WHERE lang IS DISTINCT FROM 'fr'), old AS (SELECT l.doc_id, CASE WHEN quality = 1 THEN {_FP} ELSE '' END AS m FROM labels l JOIN documents USING (doc_id))
SELECT coalesce(cur.doc_id, old.doc_id) AS source_id, CASE WHEN old.doc_id IS NULL THEN 'added' WHEN cur.doc_id IS NULL THEN 'removed' WHEN c IS NOT DISTINCT FROM m THEN 'unchanged' ELSE 'updated' END AS status FROM cur FULL JOIN old ON cur.doc_id = old.doc_id""")
def sync_diff(spark, d):
    """French documents have left the corpus; labelled ones are known, those of quality 0 by an older text."""
    docs = _t(spark, d, "documents").select("doc_id", "lang", T.content_fingerprint(F.col("text")).alias("checksum"))
    known = docs.join(_t(spark, d, "labels").select("doc_id", "quality"), "doc_id").select(F.col("doc_id").alias("source_id"), F.when(F.col("quality") == 1, F.col("checksum")).otherwise("").alias("checksum"))
    return ingest.sync_diff(docs.where(~F.col("lang").eqNullSafe("fr")).select(F.col("doc_id").alias("source_id"), "checksum"), known)


@query(f"""WITH {_URI}, p AS (SELECT page_id, page_id AS provider_id, uri, sha256(coalesce(html, '')) AS checksum FROM c), l AS (SELECT min(page_id) AS ledger_id, uri, min(checksum) AS checksum FROM p GROUP BY uri),
h AS (SELECT page_id, ledger_id, 0 AS k FROM p JOIN l ON ledger_id = provider_id UNION ALL SELECT page_id, ledger_id, 1 FROM p JOIN l ON p.uri = l.uri AND p.uri <> '' UNION ALL SELECT page_id, ledger_id, 2 FROM p JOIN l ON p.checksum = l.checksum),
b AS (SELECT page_id, count(DISTINCT ledger_id) AS n, min(ledger_id) AS lo, min(k) AS k FROM h GROUP BY 1)
SELECT page_id AS probe_id, CASE WHEN n IS NULL THEN 'novel' WHEN n = 1 THEN 'matched' ELSE 'conflict' END AS status, CASE WHEN n = 1 THEN ['provider_id', 'uri', 'checksum'][k + 1] END AS reason, CASE WHEN n = 1 THEN lo END AS ledger_id FROM p LEFT JOIN b USING (page_id)""")
def ledger_resolve(spark, d):
    """Pages as probes; one ledger row per URI."""
    probes = _t(spark, d, "pages").select(F.col("page_id").alias("probe_id"), F.col("page_id").alias("provider_id"), T.canonical_uri(F.col("url")).alias("uri"), F.sha2(F.coalesce("html", F.lit("")), 256).alias("checksum"))
    ledger = probes.groupBy("uri").agg(F.min("probe_id").alias("ledger_id"), F.min("checksum").alias("checksum")).withColumn("provider_id", F.col("ledger_id"))
    return ingest.resolve_sources(probes, ledger)


@query("""WITH w AS (SELECT user_id, count(*) OVER r AS n, sum(value) OVER r AS v FROM events WINDOW r AS (PARTITION BY user_id ORDER BY ts RANGE BETWEEN INTERVAL 60 SECONDS PRECEDING AND CURRENT ROW))
SELECT user_id, max(n) AS peak, round(max(v), 4) AS most_value FROM w GROUP BY 1""")
def rate_window(spark, d):
    return ingest.peak_rates(_t(spark, d, "events"))


_PHRASE = r"' ' || array_to_string(regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}_]+'), ' ') || ' '"


@query(f"SELECT DISTINCT item_id, doc_id AS document_id FROM (SELECT item_id, {_PHRASE} AS phrase FROM benchmark) JOIN (SELECT doc_id, {_PHRASE} AS whole FROM documents) ON contains(whole, phrase) WHERE trim(phrase, ' ') <> ''")
def text_match(spark, d):
    return ingest.contained(_t(spark, d, "benchmark"), _docs(spark, d))


_LEMMA = r"""CASE WHEN regexp_matches(one, '[^aeiou ]ies$') THEN regexp_replace(one, 'ies$', 'y') WHEN regexp_matches(one, '(s|x|z|ch|sh)es$') THEN regexp_replace(one, 'es$', '') WHEN regexp_matches(one, '[^sui ]s$') THEN regexp_replace(one, 's$', '') ELSE one END"""


@query(f"WITH o AS (SELECT p_partkey, array_to_string(list_filter(string_split_regex(lower(p_name), '[ \\t\\n\\r\\f]+'), lambda w: w <> ''), ' ') AS one FROM part) SELECT {_LEMMA} AS canonical, count(*) AS members, min(p_partkey) AS target FROM o GROUP BY 1 HAVING count(*) > 1")
def lemma_groups(spark, d):
    return entities.lemma_groups(_t(spark, d, "part").select(F.col("p_partkey").alias("id"), F.col("p_name").alias("name")))


@query("""WITH e AS (SELECT min(p_partkey) AS id, p_type AS label, p_name AS name, lower(p_name) AS k FROM part GROUP BY 2, 3)
SELECT DISTINCT x.id, x.label, x.name FROM e x JOIN e y ON x.label = y.label AND x.id < y.id AND ((length(y.k) > 2 AND contains(x.k, y.k)) OR (length(x.k) > 2 AND contains(y.k, x.k)) OR (length(x.k) > 5 AND levenshtein(x.k, y.k) < 3))""")
def duplicate_anchors(spark, d):
    e = _t(spark, d, "part").groupBy(F.col("p_type").alias("label"), F.col("p_name").alias("name")).agg(F.min("p_partkey").alias("id"))
    return entities.duplicate_anchors(e)


@query("""WITH e AS (SELECT 'n' || n_nationkey AS u, 'r' || n_regionkey AS v FROM nation UNION SELECT 's' || s_suppkey, 'n' || s_nationkey FROM supplier),
p AS (SELECT u AS source, u AS target FROM e UNION SELECT v, u FROM e UNION SELECT a.u, b.v FROM e a JOIN e b ON a.v = b.u UNION SELECT b.v, a.u FROM e a JOIN e b ON a.v = b.u UNION SELECT 'r' || r_regionkey, 'world' FROM region),
t AS (SELECT u AS source, min(v) AS lo, max(v) AS hi FROM e GROUP BY 1)
SELECT source, target, CASE WHEN source = target THEN 'self-loop' WHEN EXISTS (SELECT 1 FROM e WHERE u = target AND v = source) THEN 'reverse' WHEN EXISTS (SELECT 1 FROM e a JOIN e b ON a.v = b.u WHERE a.u = target AND b.v = source) THEN 'cycle'
WHEN lo <> target OR hi <> target THEN 'taken' ELSE 'ok' END AS verdict FROM p LEFT JOIN t USING (source)""")
def taxonomy_guard(spark, d):
    """Nations and suppliers as a taxonomy of two steps; proposed are loops, reversed and skipping edges, and a root above the regions."""
    edge = lambda t, a, b: t.select(F.concat(F.lit(a[0]), a[1]).alias("source"), F.concat(F.lit(b[0]), b[1]).alias("target"))
    e = edge(_t(spark, d, "nation"), ("n", "n_nationkey"), ("r", "n_regionkey")).unionByName(edge(_t(spark, d, "supplier"), ("s", "s_suppkey"), ("n", "s_nationkey")))
    two = e.alias("a").join(e.alias("b"), F.col("a.target") == F.col("b.source")).select(F.col("a.source").alias("source"), F.col("b.target").alias("target"))
    turned = lambda t: t.select(F.col("target").alias("source"), F.col("source").alias("target"))
    roots = _t(spark, d, "region").select(F.concat(F.lit("r"), "r_regionkey").alias("source"), F.lit("world").alias("target"))
    return entities.guard(e.select("source", F.col("source").alias("target")).unionByName(turned(e)).unionByName(two).unionByName(turned(two)).unionByName(roots), e)


@query("""SELECT count(*) AS n, round(avg(4 * quality), 6) AS baseline, round(avg(4 * quality + toxic), 6) AS candidate, count(*) FILTER (toxic > 1) AS wins, count(*) FILTER (toxic < -1) AS losses, count(*) FILTER (abs(toxic) <= 1) AS ties,
CAST(coalesce(sum(1 - quality), 0) AS BIGINT) AS base_unsupported, CAST(coalesce(sum(toxic), 0) AS BIGINT) AS unsupported, avg(4 * quality + toxic) >= 0.95 * avg(4 * quality) AND sum(toxic) <= sum(1 - quality) AS passed FROM labels""")
def evaluation_gate(spark, d):
    return entities.evaluation_gate(_t(spark, d, "labels").selectExpr("4 * quality AS baseline", "4 * quality + toxic AS candidate", "1 - quality AS base_unsupported", "toxic AS unsupported"))


@query("SELECT DISTINCT c_mktsegment AS from_label, 'PLACED_' || o_orderstatus AS relation, o_orderpriority AS to_label FROM orders JOIN customer ON c_custkey = o_custkey")
def schema_triples(spark, d):
    rows = _t(spark, d, "orders").join(_t(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    return rows.select(F.col("c_mktsegment").alias("from_label"), F.concat(F.lit("PLACED_"), "o_orderstatus").alias("relation"), F.col("o_orderpriority").alias("to_label")).distinct()


@query("SELECT p_type AS label, count(*) AS entities, count(DISTINCT p_name) AS names, count(*) FILTER (p_partkey NOT IN (SELECT l_partkey FROM lineitem)) AS orphans FROM part GROUP BY 1")
def label_histogram(spark, d):
    used = _t(spark, d, "lineitem").select(F.col("l_partkey").alias("p_partkey"), F.lit(True).alias("used")).distinct()
    return _t(spark, d, "part").join(used, "p_partkey", "left").groupBy(F.col("p_type").alias("label")).agg(F.count("*").alias("entities"), F.countDistinct("p_name").alias("names"), F.count_if(F.col("used").isNull()).alias("orphans"))
