"""Queries of revisions and communities, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.storage import materialize
from ..operators import communities, lifecycle
from .registry import _t, query

_REV = """r AS (SELECT o_orderkey AS revision_id, o_custkey AS document_id, CASE o_orderstatus WHEN 'F' THEN 'ACTIVE' WHEN 'O' THEN 'STAGED' ELSE 'INACTIVE' END AS status, 4 AS expected, o_orderdate AS created_at, CASE WHEN o_orderkey % 3 = 0 THEN o_orderdate + INTERVAL 40 DAY END AS deactivated_at FROM orders)"""


def _revisions(spark, d):
    """Orders as revisions of their customer; four chunks are expected of each."""
    status = F.when(F.col("o_orderstatus") == "F", "ACTIVE").when(F.col("o_orderstatus") == "O", "STAGED").otherwise("INACTIVE")
    return _t(spark, d, "orders").select(F.col("o_orderkey").alias("revision_id"), F.col("o_custkey").alias("document_id"), status.alias("status"), F.lit(4).alias("expected"), F.col("o_orderdate").alias("created_at"), F.when(F.col("o_orderkey") % 3 == 0, F.col("o_orderdate") + F.expr("INTERVAL 40 DAYS")).alias("deactivated_at"))


@query(f"""WITH {_REV}, n AS (SELECT l_orderkey AS revision_id, count(*) AS n FROM lineitem GROUP BY 1),
m AS (SELECT r.*, coalesce(n, 0) AS n FROM r LEFT JOIN n USING (revision_id)), b AS (SELECT document_id, max(revision_id) AS best FROM m WHERE status = 'STAGED' AND n = expected GROUP BY 1)
SELECT revision_id, document_id, CASE WHEN revision_id = best THEN 'ACTIVE' WHEN status = 'ACTIVE' AND best IS NOT NULL THEN 'INACTIVE' ELSE status END AS status, expected, created_at, deactivated_at FROM m LEFT JOIN b USING (document_id)""")
def activate_revisions(spark, d):
    return lifecycle.activated(_revisions(spark, d), _t(spark, d, "lineitem").select(F.col("l_orderkey").alias("revision_id")))


@query(f"""WITH {_REV}, f AS (SELECT DISTINCT l_orderkey AS revision_id FROM lineitem WHERE l_returnflag = 'R'), m AS (SELECT r.*, f.revision_id IS NOT NULL AS bad FROM r LEFT JOIN f USING (revision_id)),
b AS (SELECT document_id, bool_or(bad AND status = 'ACTIVE') AS lost, max((coalesce(deactivated_at, created_at), revision_id)) FILTER (status = 'INACTIVE' AND NOT bad) AS back FROM m GROUP BY 1)
SELECT revision_id, document_id, CASE WHEN bad THEN 'FAILED' WHEN lost AND revision_id = back[2] THEN 'ACTIVE' ELSE status END AS status, expected, created_at, deactivated_at FROM m JOIN b USING (document_id)""")
def roll_back_revisions(spark, d):
    """Orders with returned lines fail."""
    return lifecycle.rolled_back(_revisions(spark, d), _t(spark, d, "lineitem").where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("revision_id")))


@query("SELECT o_orderkey AS revision_id, coalesce(bool_and(l_linestatus IS NOT DISTINCT FROM 'F') FILTER (l_orderkey IS NOT NULL), true) AS ready FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1")
def graph_ready(spark, d):
    parents = _t(spark, d, "lineitem").select(F.col("l_orderkey").alias("revision_id"), F.when(F.col("l_linestatus") == "F", "COMPLETED").otherwise("PENDING").alias("status"))
    return lifecycle.graph_ready(_revisions(spark, d), parents)


@query("""WITH e AS (SELECT * FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'F'))
SELECT DISTINCT l_partkey AS source, l_suppkey AS target FROM lineitem WHERE (l_partkey, l_suppkey) NOT IN (SELECT (l_partkey, l_suppkey) FROM e)""")
def collect_garbage(spark, d):
    """Relations of a part and a supplier that lose their last evidence when all revisions but active ones are retracted."""
    evidence = _t(spark, d, "lineitem").select(F.col("l_orderkey").alias("revision_id"), F.col("l_partkey").alias("source"), F.col("l_suppkey").alias("target"))
    left = lifecycle.retracted(evidence, _revisions(spark, d).where("status <> 'ACTIVE'"))
    return lifecycle.unsupported(evidence.select("source", "target").distinct(), left, ["source", "target"])


def _round(k: int) -> str:
    return f"""v{k} AS (SELECT source, label, sum(weight) AS w FROM b JOIN a{k - 1} ON node = target GROUP BY 1, 2), a{k} AS (SELECT node, coalesce(x.label, a{k - 1}.label) AS label FROM a{k - 1}
LEFT JOIN (SELECT source, label FROM v{k} QUALIFY row_number() OVER (PARTITION BY source ORDER BY w DESC, label) = 1) x ON source = node)"""


@query(f"""WITH e AS (SELECT 'p' || l_partkey AS source, 's' || l_suppkey AS target, count(*) AS weight FROM lineitem GROUP BY 1, 2), t AS (SELECT * FROM e UNION ALL SELECT target, source, weight FROM e), b AS (SELECT * FROM t UNION ALL SELECT source, source, max(weight) FROM t GROUP BY 1),
a0 AS (SELECT 'p' || p_partkey AS node, 'p' || p_partkey AS label FROM part UNION ALL SELECT 's' || s_suppkey, 's' || s_suppkey FROM supplier), {_round(1)}, {_round(2)}, {_round(3)}
SELECT node, label FROM a3""")
def graph_communities(spark, d):
    """Parts and suppliers, joined by the lines that name both."""
    key = lambda c, k: F.concat(F.lit(c), F.col(k).cast("string"))
    edges = _t(spark, d, "lineitem").groupBy("l_partkey", "l_suppkey").agg(F.count("*").alias("weight")).select(key("p", "l_partkey").alias("source"), key("s", "l_suppkey").alias("target"), "weight")
    nodes = _t(spark, d, "part").select(key("p", "p_partkey").alias("node")).unionByName(_t(spark, d, "supplier").select(key("s", "s_suppkey").alias("node")))
    return communities.propagate(nodes, edges, 3, materialize)
