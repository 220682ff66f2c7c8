"""Every query of the engine by name, and SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import corpus, graph, retrieval

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def _docs(spark, d):
    return _t(spark, d, "documents").select(F.col("doc_id").alias("document_id"), "text")


_BLOCKS = r"""
WITH x AS (SELECT doc_id, regexp_replace(text, '\r\n?', chr(10), 'g') AS t FROM documents),
p AS (SELECT doc_id, unnest(string_split_regex(t, '\n[ \t\n\f\r]*\n')) AS p, unnest(list_concat(regexp_extract_all(t, '\n[ \t\n\f\r]*\n'), [''])) AS s, generate_subscripts(string_split_regex(t, '\n[ \t\n\f\r]*\n'), 1) AS nth FROM x),
o AS (SELECT doc_id, nth, trim(p, E' \t\n\f\r') AS text, coalesce(sum(length(p) + length(s)) OVER (PARTITION BY doc_id ORDER BY nth ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + length(p) - length(ltrim(p, E' \t\n\f\r')) AS start FROM p),
b AS (SELECT doc_id AS document_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY nth) - 1 AS INTEGER) AS ordinal, text, CAST(start AS BIGINT) AS start FROM o WHERE text <> '')
"""


@query(_BLOCKS + r"""SELECT *, start + length(text) AS "end", sha256(concat_ws(chr(31), document_id, ordinal, regexp_replace(text, '[ \t\n\f\r]+', ' ', 'g'))) AS block_id FROM b""")
def text_blocks(spark, d):
    return corpus.blocks(_docs(spark, d))


@query("SELECT count(*) AS duplicate_groups, CAST(coalesce(sum(c), 0) AS BIGINT) AS rows, CAST(coalesce(sum(c - 1), 0) AS BIGINT) AS removable FROM (SELECT text, count(*) AS c FROM documents GROUP BY text HAVING count(*) > 1)")
def exact_duplicates(spark, d):
    return corpus.exact_duplicates(_docs(spark, d))


@query("""WITH t AS (SELECT doc_id, unnest(string_split_regex(lower(text), '[^a-z]+')) AS term FROM documents),
o AS (SELECT term, doc_id, count(*) AS c FROM t WHERE length(term) >= 4 GROUP BY 1, 2)
SELECT term, count(*) AS df, CAST(sum(c) AS BIGINT) AS tf FROM o GROUP BY 1 HAVING count(*) >= 2""")
def term_frequencies(spark, d):
    return corpus.term_frequencies(_docs(spark, d))


@query("SELECT conv_id, turn, role, text FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) AS back FROM conversations) WHERE back <= 4")
def conversation_retention(spark, d):
    return corpus.retained(_t(spark, d, "conversations").select("conv_id", "turn", "role", "text"))


@query("SELECT user_id, round(sum(value), 4) AS used, round(greatest(5000.0 - sum(value), 0.0), 4) AS \"left\", count(DISTINCT CAST(ts AS DATE)) AS days FROM events GROUP BY 1")
def token_usage(spark, d):
    return corpus.usage(_t(spark, d, "events"), 5000.0)


@query("""SELECT event_type, min(value) AS least, round(quantile_cont(value, 0.5), 6) AS p50, round(quantile_cont(value, 0.95), 6) AS p95, round(quantile_cont(value, 0.99), 6) AS p99, max(value) AS most, count(*) AS n
FROM events GROUP BY 1""")
def latency_percentiles(spark, d):
    return corpus.latency(_t(spark, d, "events"), "event_type")


@query("""WITH r AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS k, count(*) OVER () AS n FROM orders)
SELECT o_orderkey FROM r WHERE k IN (SELECT CAST(round_even(i * (n - 1) / 19.0, 0) AS BIGINT) FROM (SELECT unnest(range(20)) AS i, count(*) AS n FROM orders GROUP BY 1))""")
def representative_sample(spark, d):
    return corpus.spread_sample(_t(spark, d, "orders").select("o_orderkey"), "o_orderkey", 20)


@query("SELECT DISTINCT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def removed_sources(spark, d):
    return corpus.removed(_t(spark, d, "documents"), _t(spark, d, "labels"), "doc_id")


def _evidence(spark, d):
    """Suppliers and parts as entities, orders as parents; returned lines are provisional, finished orders active."""
    line = _t(spark, d, "lineitem")
    e = line.select(F.concat(F.lit("s"), "l_suppkey").alias("source"), F.concat(F.lit("p"), "l_partkey").alias("target"), F.col("l_orderkey").alias("parent_id"), (F.col("l_returnflag") == "R").alias("provisional"))
    return e, _t(spark, d, "orders").where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("parent_id"))


_EDGES = "e AS (SELECT 's' || l_suppkey AS source, 'p' || l_partkey AS target, count(DISTINCT l_orderkey) AS weight FROM lineitem WHERE l_returnflag <> 'R' AND l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F') GROUP BY 1, 2)"


@query(f"WITH {_EDGES} SELECT * FROM e")
def relation_weights(spark, d):
    return graph.relation_weights(*_evidence(spark, d))


_BOTH = "b AS (SELECT source AS u, target AS v FROM e UNION ALL SELECT target, source FROM e)"


@query(f"WITH {_EDGES}, {_BOTH} SELECT u AS node, count(DISTINCT v) AS degree, count(*) AS relations FROM b GROUP BY 1")
def entity_degrees(spark, d):
    return graph.degrees(relation_weights(spark, d))


@query(f"""WITH {_EDGES}, {_BOTH}, one AS (SELECT DISTINCT u AS seed, v AS node, 1 AS hop FROM b WHERE u LIKE 's%' AND CAST(substr(u, 2) AS BIGINT) % 20 = 0),
two AS (SELECT DISTINCT seed, v AS node, 2 AS hop FROM one JOIN b ON b.u = one.node)
SELECT seed, node, min(hop) AS hop FROM (SELECT * FROM one UNION ALL SELECT * FROM two) WHERE seed <> node GROUP BY 1, 2""")
def graph_neighbours(spark, d):
    seeds = _t(spark, d, "supplier").where("s_suppkey % 20 = 0").select(F.concat(F.lit("s"), "s_suppkey").alias("node"))
    return graph.neighbours(seeds, relation_weights(spark, d), 2)


@query(f"""WITH {_EDGES}, {_BOTH}, n AS (SELECT 's' || s_suppkey AS node, s_name AS name FROM supplier), g AS (SELECT u AS node, count(DISTINCT v) AS degree FROM b GROUP BY 1),
j AS (SELECT name, coalesce(degree, 0) AS degree FROM n LEFT JOIN g USING (node)), dup AS (SELECT count(*) AS c FROM n GROUP BY lower(trim(name, ' ')) HAVING count(*) > 1)
SELECT count(*) AS entities, count(*) FILTER (degree = 0) AS orphans, round(avg(degree), 6) AS mean_degree, count(*) FILTER (length(name) <= 1) AS short_names, count(*) FILTER (length(name) > 100) AS long_names,
count(*) FILTER (degree <= 2) AS weak, (SELECT count(*) FROM dup) AS duplicate_groups, (SELECT CAST(coalesce(sum(c), 0) AS BIGINT) FROM dup) AS duplicates FROM j""")
def graph_quality(spark, d):
    names = _t(spark, d, "supplier").select(F.concat(F.lit("s"), "s_suppkey").alias("node"), F.col("s_name").alias("name"))
    return graph.quality(names, relation_weights(spark, d))


_SLICE = ", ".join(f"bit_xor(CAST(('0x' || substr(h, {1 + 15 * k}, 15)) AS BIGINT)) AS w{k}" for k in range(4))


@query(f"SELECT o_orderstatus, {_SLICE}, count(*) AS n FROM (SELECT o_orderstatus, sha256(concat_ws('|', o_orderkey, o_custkey, o_orderpriority)) AS h FROM orders) GROUP BY 1")
def content_fingerprint(spark, d):
    return _t(spark, d, "orders").groupBy("o_orderstatus").agg(*graph.fingerprint(F.concat_ws("|", "o_orderkey", "o_custkey", "o_orderpriority")))


@query("""WITH o AS (SELECT *, CASE WHEN vec_id % 3 = 0 THEN 'Text, ' ELSE 'text ' END || (vec_id % 31) AS t FROM embeddings QUALIFY row_number() OVER (PARTITION BY label, vec_id % 31 ORDER BY vec_id) = 1),
p AS (SELECT label AS parent_id, greatest(vec_id % 7, 1) AS w, unnest(embedding) AS x, generate_subscripts(embedding, 1) - 1 AS dim FROM o),
m AS (SELECT parent_id, dim, sum(w * x::DOUBLE) / sum(w) AS m FROM p GROUP BY 1, 2)
SELECT parent_id, dim, round(m / sqrt(sum(m * m) OVER (PARTITION BY parent_id)), 6) AS value FROM m""")
def parent_embeddings(spark, d):
    return graph.weighted_mean(_t(spark, d, "embeddings").select(F.col("label").alias("parent_id"), F.col("vec_id").alias("position"), F.concat(F.when(F.col("vec_id") % 3 == 0, "Text, ").otherwise("text "), F.col("vec_id") % 31).alias("text"), F.col("embedding").alias("vector"), (F.col("vec_id") % 7).alias("weight")))


def _vectors(spark, d):
    e = _t(spark, d, "embeddings")
    records = e.select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"))
    return retrieval.vector_top_k(records.where("id % 20 = 0").withColumnRenamed("id", "query_id"), records, 24)


def _lexical(spark, d):
    items = _t(spark, d, "benchmark").where("item_id % 20 = 0").select(F.col("item_id").alias("query_id"), "text")
    return retrieval.bm25_top_k(items, _t(spark, d, "documents").select(F.col("doc_id").alias("id"), "text"), 24)


_VEC = """v AS (SELECT query_id, id, score, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS rank FROM (
SELECT q.vec_id AS query_id, r.vec_id AS id, round(list_dot_product(q.embedding::DOUBLE[], r.embedding::DOUBLE[]) / (sqrt(list_dot_product(q.embedding::DOUBLE[], q.embedding::DOUBLE[])) * sqrt(list_dot_product(r.embedding::DOUBLE[], r.embedding::DOUBLE[]))), 6) AS score
FROM embeddings q JOIN embeddings r ON q.vec_id <> r.vec_id WHERE q.vec_id % 20 = 0) QUALIFY rank <= 24)"""
_LEX = """dt AS (SELECT doc_id AS id, list_filter(string_split_regex(lower(text), '[^a-z0-9]+'), lambda x: x <> '') AS ts FROM documents), ds AS (SELECT count(*) AS n, avg(len(ts)) AS avg_len FROM dt),
qt AS (SELECT item_id AS query_id, unnest(list_distinct(list_filter(string_split_regex(lower(text), '[^a-z0-9]+'), lambda x: x <> ''))) AS term FROM benchmark WHERE item_id % 20 = 0),
tf AS (SELECT id, dl, term, count(*) AS tf FROM (SELECT id, len(ts) AS dl, unnest(ts) AS term FROM dt) WHERE term IN (SELECT term FROM qt) GROUP BY 1, 2, 3), df AS (SELECT term, count(*) AS df FROM tf GROUP BY 1),
l AS (SELECT query_id, id, score, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS rank FROM (
SELECT query_id, id, round(sum(ln(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (1 - 0.75 + 0.75 * dl / avg_len))), 6) AS score FROM tf JOIN df USING (term) JOIN qt USING (term), ds GROUP BY 1, 2) QUALIFY rank <= 24)"""


@query(f"WITH {_VEC} SELECT * FROM v")
def vector_search(spark, d):
    return _vectors(spark, d)


@query(f"WITH {_LEX} SELECT * FROM l")
def lexical_search(spark, d):
    return _lexical(spark, d)


_FUSED = f"{_VEC}, {_LEX}, f AS (SELECT query_id, id, round(sum(1 / (60.0 + rank)), 9) AS rrf, string_agg(DISTINCT channel, ',' ORDER BY channel) AS channels FROM (SELECT query_id, id, rank, 'vector' AS channel FROM v UNION ALL SELECT query_id, id, rank, 'lexical' FROM l) GROUP BY 1, 2)"


@query(f"WITH {_FUSED} SELECT * FROM f")
def reciprocal_rank_fusion(spark, d):
    return retrieval.fuse({"vector": _vectors(spark, d), "lexical": _lexical(spark, d)})


_CHOSEN = f"""{_FUSED}, gr AS (SELECT query_id, id, id % 5 AS group_id, rrf FROM f), c AS (SELECT *, row_number() OVER (PARTITION BY query_id, group_id ORDER BY rrf DESC, id) AS ig FROM gr),
k AS (SELECT query_id, count(DISTINCT group_id) AS groups FROM gr GROUP BY 1),
ch AS (SELECT query_id, id, group_id, rrf, row_number() OVER (PARTITION BY query_id ORDER BY rrf DESC, id) AS position FROM c JOIN k USING (query_id) WHERE groups < 3 OR ig <= 4 QUALIFY position <= 12)"""


@query(f"WITH {_CHOSEN} SELECT * FROM ch")
def diversified_results(spark, d):
    return retrieval.diversify(reciprocal_rank_fusion(spark, d).withColumn("group_id", F.col("id") % 5), 12)


@query(f"""WITH {_CHOSEN}, z AS (SELECT ch.*, doc.n_chars AS n_tokens FROM ch JOIN documents doc ON doc.doc_id = ch.id),
y AS (SELECT *, coalesce(sum(n_tokens) OVER (PARTITION BY query_id ORDER BY position ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before, row_number() OVER (PARTITION BY query_id ORDER BY position) AS nth FROM z)
SELECT query_id, id, position, CAST(least(n_tokens, 12000 - before) AS BIGINT) AS used, 'S' || nth AS citation FROM y WHERE before < 12000 AND nth <= 8""")
def hybrid_context(spark, d):
    chosen = diversified_results(spark, d).join(_t(spark, d, "documents").select(F.col("doc_id").alias("id"), F.col("n_chars").alias("n_tokens")), "id")
    return retrieval.budget(chosen).select("query_id", "id", "position", "used", "citation")


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hybrid_context(spark, sf_dir)
