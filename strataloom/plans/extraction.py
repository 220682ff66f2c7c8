"""Queries of graphs made from parents and of what reports may cite, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import communities as G
from ..operators import extraction as X
from ..operators import ingest
from .registry import ORACLE_SQL, _docs, _t, query

_TERMS = ORACLE_SQL["provisional_terms"]


@query(rf"""WITH pt AS ({_TERMS}), ids AS (SELECT DISTINCT document_id, lower(term) AS id FROM pt), s AS (SELECT doc_id, unnest(string_split_regex(regexp_replace(text, '([.!?])[ \t\n\r\f]+', '\1' || chr(10), 'g'), '\n+')) AS s, generate_subscripts(string_split_regex(regexp_replace(text, '([.!?])[ \t\n\r\f]+', '\1' || chr(10), 'g'), '\n+'), 1) AS k FROM documents),
p AS (SELECT doc_id, k, id FROM s JOIN ids ON doc_id = document_id AND contains(lower(s), id)) SELECT a.doc_id AS parent_id, a.id AS source, b.id AS target, count(*) AS weight FROM p a JOIN p b USING (doc_id, k) WHERE a.id < b.id GROUP BY 1, 2, 3""")
def provisional_graph(spark, d):
    docs = _docs(spark, d)
    return X.provisional_graph(docs, ingest.provisional_terms(docs))


_EV = """ev AS (SELECT DISTINCT l_suppkey AS source, l_partkey AS target, l_returnflag AS type, l_orderkey AS parent_id FROM lineitem WHERE l_linenumber < 6), rl AS (SELECT source, target, type, min(parent_id) % 3 AS created_in FROM ev GROUP BY 1, 2, 3), pa AS (SELECT o_orderkey AS parent_id FROM orders WHERE o_orderkey % 4 = 0),
fr AS (SELECT l_suppkey AS source, l_partkey AS target, 'N' AS type, l_orderkey AS parent_id, bool_and(l_linestatus = 'O') AS provisional FROM lineitem WHERE l_orderkey % 4 = 0 AND l_linenumber % 2 = 1 GROUP BY ALL), af AS (SELECT *, FALSE AS provisional FROM ev WHERE parent_id NOT IN (SELECT parent_id FROM pa) UNION ALL SELECT * FROM fr)"""


def _persisted(spark, d):
    """Lines as evidence for a supplier's relation to a part; every fourth order is extracted anew by revision 1, its odd lines only."""
    line = _t(spark, d, "lineitem").select(F.col("l_suppkey").alias("source"), F.col("l_partkey").alias("target"), F.col("l_returnflag").alias("type"), F.col("l_orderkey").alias("parent_id"), "l_linenumber", "l_linestatus")
    evidence = line.where("l_linenumber < 6").select(*X.RELATION, "parent_id").distinct().withColumn("provisional", F.lit(False))
    relations = evidence.groupBy(*X.RELATION).agg((F.min("parent_id") % 3).alias("created_in"))
    fresh = line.where("parent_id % 4 = 0 AND l_linenumber % 2 = 1").select("source", "target", F.lit("N").alias("type"), "parent_id", (F.col("l_linestatus") == "O").alias("provisional"))
    parents = _t(spark, d, "orders").where("o_orderkey % 4 = 0").select(F.col("o_orderkey").alias("parent_id"))
    return X.persisted(relations, evidence, fresh, parents, F.lit(1).cast("long"))


@query(f"""WITH {_EV}, b AS (SELECT DISTINCT source, target, type FROM af) SELECT source, target, type, CASE WHEN rl.created_in IS NULL THEN 1 ELSE rl.created_in END AS created_in FROM rl FULL JOIN (SELECT *, TRUE AS backed FROM b) USING (source, target, type) WHERE backed OR created_in <> 1""")
def persisted_relations(spark, d):
    return _persisted(spark, d)[0]


@query(f"WITH {_EV} SELECT source, target, type, parent_id, provisional FROM af")
def persisted_evidence(spark, d):
    return _persisted(spark, d)[1]


_XML = lambda c: f"replace(replace(replace(replace({c}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '\"', '&quot;')"


@query(f"""SELECT 0 AS section, array_to_string([{', '.join("'" + h + "'" for h in X._HEAD)}], chr(10)) AS line UNION ALL SELECT 3, '</graph>' || chr(10) || '</graphml>'
UNION ALL SELECT 1, '<node id="' || {_XML("p_partkey || ' & <' || p_name || '>'")} || '"><data key="entity_type">' || {_XML('p_brand')} || '</data></node>' FROM part
UNION ALL SELECT 2, '<edge source="' || l_suppkey || '" target="' || l_partkey || '"><data key="relationship_type">' || l_returnflag || '</data></edge>' FROM lineitem""")
def graphml_lines(spark, d):
    nodes = _t(spark, d, "part").select(F.concat(F.col("p_partkey"), F.lit(" & <"), F.col("p_name"), F.lit(">")).alias("id"), F.col("p_brand").alias("type"))
    return X.graphml(nodes, _t(spark, d, "lineitem").select(F.col("l_suppkey").alias("source"), F.col("l_partkey").alias("target"), F.col("l_returnflag").alias("type")))


@query(r"""WITH a AS (SELECT conv_id, turn, CASE turn % 5 WHEN 0 THEN '```json' || chr(10) || '{"t": ' || turn || '}' || chr(10) || '```' WHEN 1 THEN 'So: {"c": "x}"} as asked' WHEN 2 THEN '[1, 2]' WHEN 3 THEN '{"open": ' ELSE text END AS answer FROM conversations)
SELECT conv_id, turn, CASE turn % 5 WHEN 0 THEN '{"t": ' || turn || '}' WHEN 1 THEN '{"c": "x}"}' WHEN 4 THEN CASE WHEN starts_with(trim(answer), '{') AND json_valid(answer) THEN trim(answer) WHEN NOT json_valid(answer) AND json_valid(regexp_extract(answer, '(?s)(\{.*\})', 1)) AND regexp_extract(answer, '(?s)(\{.*\})', 1) <> '' THEN regexp_extract(answer, '(?s)(\{.*\})', 1) END END AS object FROM a""")
def json_answers(spark, d):
    """Turns of conversations, some of them put as JSON in fences, in prose, as a list or torn off."""
    t = F.col("turn")
    answer = F.when(t % 5 == 0, F.concat(F.lit('```json\n{"t": '), t, F.lit("}\n```"))).when(t % 5 == 1, 'So: {"c": "x}"} as asked').when(t % 5 == 2, "[1, 2]").when(t % 5 == 3, '{"open": ').otherwise(F.col("text"))
    return _t(spark, d, "conversations").select("conv_id", "turn", X.json_object(answer).alias("object"))


_REP = """mem AS (SELECT 0 AS level, s_suppkey AS node, CAST(n_regionkey AS VARCHAR) AS label FROM supplier JOIN nation ON s_nationkey = n_nationkey UNION ALL SELECT 1, s_suppkey, n_regionkey || '/' || n_nationkey FROM supplier JOIN nation ON s_nationkey = n_nationkey),
evi AS (SELECT level, label, l_orderkey AS parent_id FROM mem JOIN lineitem ON node = l_suppkey AND l_quantity > 30 UNION SELECT a.level, a.label, -l_orderkey FROM lineitem JOIN mem a ON a.node = l_suppkey JOIN mem b ON b.node = l_linenumber AND b.level = a.level AND b.label = a.label)"""


def _evidence(spark, d):
    """Suppliers by region and, below, by nation; orders mention them, and a line relates its supplier to the one of its number."""
    s = _t(spark, d, "supplier").join(F.broadcast(_t(spark, d, "nation")), F.col("s_nationkey") == F.col("n_nationkey"))  # at most as many nations as there are
    region = F.col("n_regionkey").cast("string")
    members = s.select(F.lit(0).alias("level"), F.col("s_suppkey").alias("node"), region.alias("label")).unionByName(s.select(F.lit(1).alias("level"), F.col("s_suppkey").alias("node"), F.concat_ws("/", region, "n_nationkey").alias("label")))
    line = _t(spark, d, "lineitem")
    mentions = line.where("l_quantity > 30").select(F.col("l_suppkey").alias("node"), F.col("l_orderkey").alias("parent_id"))
    return G.report_evidence(members, mentions, line.select(F.col("l_suppkey").alias("source"), F.col("l_linenumber").cast("long").alias("target"), (-F.col("l_orderkey")).alias("parent_id")))


@query(f"WITH {_REP} SELECT level, label, parent_id FROM evi")
def report_evidence(spark, d):
    return _evidence(spark, d)


@query(f"""WITH {_REP}, f AS (SELECT o_orderkey AS finding_id, CAST(o_orderkey % 5 AS VARCHAR) AS label, CASE WHEN o_orderkey % 10 = 0 THEN [] ELSE [o_orderkey, o_orderkey + 1] END AS src FROM orders), c AS (SELECT finding_id, label, unnest(src) AS parent_id FROM f)
SELECT finding_id FROM f WHERE len(src) = 0 UNION SELECT finding_id FROM c WHERE (label, parent_id) NOT IN (SELECT (label, parent_id) FROM evi WHERE level = 0)""")
def ungrounded_findings(spark, d):
    """Orders as findings about a region that cite themselves and the next order."""
    k = F.col("o_orderkey")
    sources = F.when(k % 10 == 0, F.array().cast("array<bigint>")).otherwise(F.array(k, k + 1))
    return G.ungrounded(_t(spark, d, "orders").select(k.alias("finding_id"), F.lit(0).alias("level"), (k % 5).cast("string").alias("label"), sources.alias("sources")), _evidence(spark, d))
