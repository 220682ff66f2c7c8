"""Queries of scoped search, graph expansion, reranking, citations and community reports, with their SQL."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import names as N
from ..operators import retrieval
from ..operators import search as S
from .consolidation import _TOK
from .registry import _t, query

_UNITS = """u AS (SELECT vec_id AS id, label AS revision_id, vec_id % 3 AS document_id, CASE WHEN vec_id % 2 = 0 THEN 'pdf' ELSE 'text' END AS source_type, embedding FROM embeddings), rv AS (SELECT DISTINCT label AS revision_id FROM embeddings WHERE label % 4 <> 3 AND label % 5 <> 4),
sc AS (SELECT u.* FROM u JOIN rv USING (revision_id) WHERE source_type = 'pdf' AND document_id IN (0, 2))"""


def _scoped(spark, d):
    """Vectors as units, their labels as revisions, of which some are not active or not ready; two filters."""
    e = _t(spark, d, "embeddings")
    units = e.select(F.col("vec_id").alias("id"), F.col("label").alias("revision_id"), (F.col("vec_id") % 3).alias("document_id"), F.when(F.col("vec_id") % 2 == 0, "pdf").otherwise("text").alias("source_type"), F.col("embedding").alias("vector"), F.lit("f1").alias("embedding_fingerprint"))
    revisions = e.select(F.col("label").alias("revision_id")).distinct().select("revision_id", F.when(F.col("revision_id") % 4 == 3, "INACTIVE").otherwise("ACTIVE").alias("status"), (F.col("revision_id") % 5 != 4).alias("vector_ready"))
    return S.same_fingerprint(S.in_scope(units, {"source_type": "pdf", "document_id": [0, 2], "language": None}, revisions), "f1")


def _queries(spark, d):
    return _t(spark, d, "embeddings").where("vec_id % 20 = 0").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("vector"))


@query(f"WITH {_UNITS} SELECT id, revision_id, document_id FROM sc")
def search_scope(spark, d):
    return _scoped(spark, d).select("id", "revision_id", "document_id")


_DIST = "list_sum(list_transform(list_zip(q.embedding::DOUBLE[], r.embedding::DOUBLE[]), lambda z: (z[1] - z[2]) * (z[1] - z[2])))"


@query(f"""WITH {_UNITS}, m AS (SELECT q.vec_id AS query_id, r.id, round({_DIST}, 6) AS distance FROM embeddings q JOIN sc r ON q.vec_id <> r.id WHERE q.vec_id % 20 = 0)
SELECT query_id, id, distance, row_number() OVER (PARTITION BY query_id ORDER BY distance, id) AS rank, round(1 / (1 + distance), 6) AS score FROM m QUALIFY rank <= 12""")
def nearest_vectors(spark, d):
    """Least squared distances within the scope."""
    return S.nearest(_queries(spark, d), _scoped(spark, d), 12)


_CS = "round(list_dot_product(q.embedding::DOUBLE[], r.embedding::DOUBLE[]) / (sqrt(list_dot_product(q.embedding::DOUBLE[], q.embedding::DOUBLE[])) * sqrt(list_dot_product(r.embedding::DOUBLE[], r.embedding::DOUBLE[]))), 6)"


@query(f"""WITH {_UNITS} SELECT query_id, id, score, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS rank FROM (SELECT q.vec_id AS query_id, r.id, {_CS} AS score FROM embeddings q JOIN sc r ON q.vec_id <> r.id WHERE q.vec_id % 20 = 0) QUALIFY rank <= 12""")
def scoped_vector_search(spark, d):
    return retrieval.vector_top_k(_queries(spark, d), _scoped(spark, d), 12)


_EXP = """mn AS (SELECT DISTINCT l_partkey AS e, l_orderkey AS p FROM lineitem WHERE l_quantity > 40), na AS (SELECT e FROM mn GROUP BY 1 HAVING count(*) <= 40), m AS (SELECT * FROM mn WHERE e IN (SELECT e FROM na)), sd AS (SELECT o_orderkey AS q, o_orderkey AS p FROM orders WHERE o_orderkey % 400 = 0),
rl AS (SELECT DISTINCT l_partkey AS s, (l_partkey * 7 + l_suppkey) % (SELECT count(*) FROM part) AS t, CASE WHEN l_linenumber = 2 THEN 'MENTIONS' ELSE 'RELATED_TO' END AS ty FROM lineitem WHERE l_quantity < 3), r AS (SELECT s, t FROM rl WHERE ty <> 'MENTIONS' AND s <> t),
b AS (SELECT DISTINCT s AS u, t AS v FROM (SELECT s, t FROM r UNION ALL SELECT t, s FROM r)), h0 AS (SELECT DISTINCT q, e AS o, e AS x FROM sd JOIN m USING (p)), h1 AS (SELECT DISTINCT q, o, v AS x FROM h0 JOIN b ON u = x),
f AS (SELECT q, o, x, min(h) AS hop FROM (SELECT *, 0 AS h FROM h0 UNION ALL SELECT *, 1 FROM h1) GROUP BY 1, 2, 3), ex AS (SELECT q AS query_id, p AS parent_id, o AS origin, x AS reached, hop FROM f JOIN m ON m.e = x WHERE (q, p) NOT IN (SELECT (q, p) FROM sd))"""


def _expansion(spark, d):
    """Orders as parents that mention parts of large lines; every four-hundredth order is a query of its own. Parts in more than forty such orders are hubs."""
    line = _t(spark, d, "lineitem")
    mentions = line.where("l_quantity > 40").select(F.col("l_partkey").alias("entity"), F.col("l_orderkey").alias("parent_id"))
    n = _t(spark, d, "part").agg(F.count("*").alias("n"))
    rel = line.where("l_quantity < 3").crossJoin(F.broadcast(n)).select(F.col("l_partkey").alias("source"), ((F.col("l_partkey") * 7 + F.col("l_suppkey")) % F.col("n")).alias("target"), F.when(F.col("l_linenumber") == 2, "MENTIONS").otherwise("RELATED_TO").alias("type"))  # n is one row
    seeds = _t(spark, d, "orders").where("o_orderkey % 400 = 0").select(F.col("o_orderkey").alias("query_id"), F.col("o_orderkey").alias("parent_id"))
    return S.expansion(seeds, mentions, rel, 1, 40)


@query(f"WITH {_EXP} SELECT * FROM ex")
def graph_expansion(spark, d):
    return _expansion(spark, d)


@query()
def capped_expansion(spark, d):
    """The expansion under its caps per reached entity and per document (customers); the walk is beyond SQL and tested against plain Python."""
    docs = _t(spark, d, "orders").select(F.col("o_orderkey").alias("parent_id"), F.col("o_custkey").alias("document_id"))
    return S.capped(_expansion(spark, d).join(docs, "parent_id"))


_REL = r"""rel AS (SELECT l_suppkey AS s, l_partkey AS t, CASE WHEN l_returnflag = 'R' THEN 'RETURNS' ELSE 'SELLS' END AS ty FROM lineitem)"""


@query(f"""WITH {_REL}, b AS (SELECT s AS n, ty, t AS o FROM rel) SELECT n AS node, count(DISTINCT o) AS degree, array_to_string(list_sort(list_distinct(list(ty)))[1:6], ',') AS types FROM b GROUP BY 1""")
def neighbour_types(spark, d):
    """Degrees with the first six relation types."""
    line = _t(spark, d, "lineitem").select(F.col("l_suppkey").alias("node"), F.col("l_partkey").alias("o"), F.when(F.col("l_returnflag") == "R", "RETURNS").otherwise("SELLS").alias("ty"))
    return line.groupBy("node").agg(F.count_distinct("o").alias("degree"), F.array_join(F.slice(F.array_sort(F.collect_set("ty")), 1, 6), ",").alias("types"))


@query(f"""WITH c AS (SELECT q.conv_id AS query_id, q.text AS qt, a.turn AS id, a.text, 1.0 / (60 + a.turn) AS rrf FROM conversations q JOIN conversations a USING (conv_id) WHERE q.turn = 0 AND a.turn > 0), t AS (SELECT *, list_distinct({_TOK('qt')}) AS q, list_distinct({_TOK('text')}) AS w FROM c),
s AS (SELECT query_id, id, round(rrf, 9) AS rrf, round(CASE WHEN len(q) > 0 THEN len(list_intersect(q, w)) / len(q) ELSE 0.0 END, 6) AS reranker_score FROM t) SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY reranker_score DESC, rrf DESC, id) AS position FROM s""")
def reranked_turns(spark, d):
    """A conversation's first turn as a question, the others as candidates, reranked by token overlap."""
    c = _t(spark, d, "conversations")
    q = c.where("turn = 0").select(F.col("conv_id").alias("query_id"), F.col("text").alias("question"))
    a = c.where("turn > 0").select(F.col("conv_id").alias("query_id"), F.col("turn").alias("id"), "text", F.round(1 / (60 + F.col("turn")), 9).alias("rrf"))
    return S.reranked(q.join(a, "query_id"), S.token_overlap(F.col("question"), F.col("text"))).select("query_id", "id", "rrf", "reranker_score", "position")


@query(r"""WITH w AS (SELECT conv_id, turn, list_filter(string_split_regex(text, '[ \t\n\r\f]+'), lambda x: x <> '') AS w FROM conversations), s AS (SELECT *, len(w) AS n, coalesce(sum(len(w)) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS nth FROM w),
k AS (SELECT *, CAST(120 - before AS INTEGER) AS left_ FROM s WHERE before < 120 AND nth <= 8), g AS (SELECT *, CAST(greatest(0, least(10 - floor(left_ / 3), n - left_)) AS INTEGER) AS st FROM k)
SELECT conv_id AS query_id, turn AS id, turn AS position, 'S' || nth AS citation, CASE WHEN n <= left_ THEN array_to_string(w, ' ') ELSE array_to_string(w[st + 1 : st + left_], ' ') END AS text, CAST(least(n, left_) AS INTEGER) AS used FROM g""")
def clipped_context(spark, d):
    """A conversation's turns as parents in their order, within 120 tokens; the match is at the eleventh word."""
    c = _t(spark, d, "conversations").select(F.col("conv_id").alias("query_id"), F.col("turn").alias("id"), F.col("turn").alias("position"), "text", F.lit(10).alias("match_at"))
    return S.clipped(c, 120, 8)


@query(r"""WITH a AS (SELECT conv_id, turn, text || ' [S1] and [S9] [S' || turn || ']' AS answer, CASE WHEN turn % 2 = 0 THEN ['S2', 'S7'] ELSE [] END AS requested, CASE WHEN turn % 4 = 3 THEN ['S99'] ELSE ['S1', 'S2', 'S3'] END AS allowed FROM conversations),
t AS (SELECT *, regexp_extract_all(answer, '\[(S\d+)\]', 1) AS tags FROM a), u AS (SELECT *, list_concat(requested, tags) AS every FROM t), v AS (SELECT *, list_filter(every, lambda c, i: list_contains(allowed, c) AND list_position(every, c) = i) AS citations, list_filter(list_distinct(tags), lambda c: NOT list_contains(allowed, c)) AS bad FROM u)
SELECT conv_id, turn, array_to_string(citations, ',') AS citations, trim(regexp_replace(list_reduce(list_concat([answer], bad), lambda x, c: replace(x, '[' || c || ']', '')), ' +', ' ', 'g'), ' ') AS text, len(citations) = 0 AS insufficient FROM v""")
def validated_citations(spark, d):
    """Turns as answers with citations that are asked for, tagged, allowed or not."""
    t = F.col("turn")
    empty = F.array().cast("array<string>")
    a = _t(spark, d, "conversations").select(
        "conv_id", "turn", F.concat("text", F.lit(" [S1] and [S9] [S"), t, F.lit("]")).alias("answer"), F.when(t % 2 == 0, F.array(F.lit("S2"), F.lit("S7"))).otherwise(empty).alias("requested"),
        F.when(t % 4 == 3, F.array(F.lit("S99"))).otherwise(F.array(F.lit("S1"), F.lit("S2"), F.lit("S3"))).alias("allowed"),
    )
    return S.answered(a).select("conv_id", "turn", F.array_join("citations", ",").alias("citations"), "text", "insufficient")


@query("""WITH h AS (SELECT l_suppkey AS query_id, l_partkey AS report_id, CASE WHEN l_linenumber % 2 = 0 THEN 'vector' ELSE 'lexical' END AS channel, l_discount AS score, l_orderkey AS finding FROM lineitem),
g AS (SELECT query_id, report_id, max(score) AS score, string_agg(DISTINCT channel, ',' ORDER BY channel) AS channels, count(DISTINCT finding) AS findings FROM h GROUP BY 1, 2) SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, report_id) AS position FROM g QUALIFY position <= 10""")
def community_report_search(spark, d):
    """Suppliers as queries, parts as reports, lines as hits of two channels."""
    hits = _t(spark, d, "lineitem").select(F.col("l_suppkey").alias("query_id"), F.col("l_partkey").alias("report_id"), F.when(F.col("l_linenumber") % 2 == 0, "vector").otherwise("lexical").alias("channel"), F.col("l_discount").alias("score"), F.col("l_orderkey").alias("finding"))
    return S.reports_found(hits, 10)


@query("""WITH r AS (SELECT p_partkey AS report_id, p_brand AS build_id, p_size % 4 AS level, p_retailprice AS rank FROM part) SELECT *, row_number() OVER (PARTITION BY build_id ORDER BY rank DESC, report_id) AS position FROM r WHERE level = (SELECT min(level) FROM r x WHERE x.build_id = r.build_id)""")
def broadest_reports(spark, d):
    return S.broadest(_t(spark, d, "part").select(F.col("p_partkey").alias("report_id"), F.col("p_brand").alias("build_id"), (F.col("p_size") % 4).alias("level"), F.col("p_retailprice").alias("rank")))


@query("""WITH m AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS k FROM conversations) SELECT conv_id, max(turn) AS last_turn, string_agg(role || ': ' || substr(text, 1, 40), chr(10) ORDER BY turn) AS history FROM m WHERE k <= 4 GROUP BY 1""")
def contextual_questions(spark, d):
    """The first four messages of each conversation in one text, as a follow-up question would carry them."""
    k = F.row_number().over(Window.partitionBy("conv_id").orderBy("turn"))
    m = _t(spark, d, "conversations").withColumn("k", k).where("k <= 4")
    line = F.struct("turn", F.concat_ws(": ", "role", F.substring("text", 1, 40)).alias("x"))
    return m.groupBy("conv_id").agg(F.max("turn").alias("last_turn"), F.array_join(F.transform(F.array_sort(F.collect_list(line)), lambda s: s["x"]), "\n").alias("history"))


@query("""WITH x AS (SELECT props, event_id FROM events) SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k, CASE WHEN CAST(json_extract(props, '$.k') AS INTEGER) > 60 THEN 1.0 ELSE greatest(0.0, CAST(json_extract(props, '$.k') AS INTEGER) / 60) END AS confidence FROM x""")
def clamped_confidence(spark, d):
    """A number from each event's properties, as a confidence between 0 and 1."""
    k = F.get_json_object("props", "$.k").cast("int")
    return _t(spark, d, "events").select("event_id", k.alias("k"), N.clamp(k / 60, 0.0, 1.0).alias("confidence"))
