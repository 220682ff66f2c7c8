"""Queries of ingestion states, migration and control, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import names
from ..operators import control as C
from ..operators import ingestions as I
from ..operators import migration as M
from .registry import _docs, _t, query

_KEY = "CASE WHEN o_orderkey % 11 = 0 THEN '' ELSE o_orderpriority END"


@query(f"""WITH r AS (SELECT o_orderkey AS id, o_custkey AS corpus, {_KEY} AS k, sha256(o_orderstatus) AS sha FROM orders), v AS (SELECT * FROM r WHERE k <> ''), f AS (SELECT corpus, k, min(id) AS first, min_by(sha, id) AS fsha FROM v GROUP BY 1, 2)
SELECT id AS request_id, CASE WHEN k <> '' AND sha = fsha THEN first END AS record_id, CASE WHEN k = '' THEN 'invalid' WHEN id = first THEN 'new' WHEN sha = fsha THEN 'existing' ELSE 'conflict' END AS outcome FROM r LEFT JOIN f USING (corpus, k)""")
def submitted_packages(spark, d):
    """Orders as submissions to their customer's corpus, with the priority as key and the status as content."""
    key = F.when(F.col("o_orderkey") % 11 == 0, "").otherwise(F.col("o_orderpriority"))
    return I.submitted(_t(spark, d, "orders").select(F.col("o_orderkey").alias("request_id"), F.col("o_custkey").alias("corpus_key"), key.alias("idempotency_key"), F.sha2("o_orderstatus", 256).alias("package_sha256")))


@query("""WITH l AS (SELECT c_custkey AS source_id, sha256(c_mktsegment) AS checksum, c_custkey + 1000 AS document_id, c_acctbal > 0 AS active FROM customer)
SELECT o_orderkey AS id, o_custkey AS source_id, CASE WHEN o_orderkey % 13 = 0 THEN 'quarantined' WHEN active AND l.checksum = sha256(CASE WHEN o_orderkey % 2 = 0 THEN 'BUILDING' ELSE 'MACHINERY' END) THEN 'duplicate' ELSE 'staged' END AS status, document_id FROM orders LEFT JOIN l ON source_id = o_custkey""")
def staged_packages(spark, d):
    """Orders as packages of customers, whose segment is the known content."""
    k = F.col("o_orderkey")
    packages = _t(spark, d, "orders").select(k.alias("id"), F.col("o_custkey").alias("source_id"), F.sha2(F.when(k % 2 == 0, "BUILDING").otherwise("MACHINERY"), 256).alias("checksum"), F.when(k % 13 == 0, "unreadable").alias("error"))
    ledger = _t(spark, d, "customer").select(F.col("c_custkey").alias("source_id"), F.sha2("c_mktsegment", 256).alias("checksum"), (F.col("c_custkey") + 1000).alias("document_id"), (F.col("c_acctbal") > 0).alias("active"))
    return I.staged(packages, ledger).select("id", "source_id", "status", "document_id")


_EVAL = """rec AS (SELECT l_orderkey * 10 + l_linenumber AS id, CASE WHEN l_linenumber = 7 THEN 'accepted' ELSE 'staged' END AS status, 0.9 + l_discount AS q, CASE WHEN l_quantity > 45 THEN 0.9 ELSE 1.0 END AS c, 0.86 + l_tax AS g, l_quantity / 100.0 AS h, CASE WHEN l_returnflag = 'R' THEN 1.0 ELSE 0.0 END AS u,
l_suppkey % 7 <> 0 AS canary, l_linestatus = 'F' AS ready FROM lineitem), ev AS (SELECT *, CASE WHEN status <> 'accepted' THEN list_sort(list_filter([CASE WHEN q < 0.95 THEN 'baseline_quality_ratio' END, CASE WHEN c < 1.0 THEN 'effective_citation_ratio' END, CASE WHEN g < 0.9 THEN 'graph_expansion_ratio' END, CASE WHEN h < 0.25 THEN 'capacity_headroom_ratio' END,
CASE WHEN u > 0 THEN 'unsupported_claim_delta' END, CASE WHEN NOT canary THEN 'source_canary_retrieved' END, CASE WHEN NOT ready THEN 'graph_ready' END], lambda x: x IS NOT NULL)) END AS f FROM rec)"""


def _evaluated(spark, d):
    """Lines as staged revisions, whose measures come from their amounts; every seventh line is accepted already."""
    line = _t(spark, d, "lineitem")
    return I.evaluated(line.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"), F.when(F.col("l_linenumber") == 7, "accepted").otherwise("staged").alias("status"), (F.lit(0.9) + F.col("l_discount")).alias("baseline_quality_ratio"),
        F.when(F.col("l_quantity") > 45, 0.9).otherwise(1.0).alias("effective_citation_ratio"), (F.lit(0.86) + F.col("l_tax")).alias("graph_expansion_ratio"), (F.col("l_quantity") / 100.0).alias("capacity_headroom_ratio"),
        F.when(F.col("l_returnflag") == "R", 1.0).otherwise(0.0).alias("unsupported_claim_delta"), (F.col("l_suppkey") % 7 != 0).alias("source_canary_retrieved"), (F.col("l_linestatus") == "F").alias("graph_ready"), F.lit(1).alias("completed_parents"), F.lit(1).alias("expected_parents"),
    ))


@query(f"WITH {_EVAL} SELECT id, CASE WHEN f IS NULL THEN status ELSE 'evaluated' END AS status, array_to_string(f, ',') AS failures, len(f) = 0 AS passed FROM ev")
def evaluated_revisions(spark, d):
    return _evaluated(spark, d).select("id", "status", F.array_join("failures", ",").alias("failures"), "passed")


@query(f"""WITH {_EVAL} SELECT id, CASE WHEN id % 2 = 0 AND f IS NOT NULL AND len(f) = 0 THEN 'accepted' WHEN id % 2 = 1 AND f IS NOT NULL AND id % 5 <> 0 THEN 'rolled_back' WHEN f IS NULL THEN status ELSE 'evaluated' END AS status,
CASE WHEN id % 2 = 0 AND f IS NOT NULL AND len(f) > 0 THEN 'not passed' WHEN id % 2 = 1 AND f IS NULL THEN 'already accepted' WHEN id % 2 = 1 AND id % 5 = 0 THEN 'no revision' END AS refused FROM ev""")
def decided_revisions(spark, d):
    """Lines of even number are to be accepted, others to be rolled back."""
    records = _evaluated(spark, d).withColumn("revision_id", F.when(F.col("id") % 5 != 0, F.col("id")))
    return I.decided(records, F.when(F.col("id") % 2 == 0, "accept").otherwise("rollback")).select("id", "status", "refused")


@query("""WITH a AS (SELECT s_suppkey AS k, s_nationkey AS n FROM supplier WHERE s_suppkey % 3 <> 0), b AS (SELECT s_suppkey AS k, CASE WHEN s_suppkey % 2 = 0 THEN s_nationkey ELSE s_nationkey + 1 END AS n FROM supplier WHERE s_suppkey % 5 <> 0)
SELECT coalesce(a.k, b.k) AS source_id, CASE WHEN b.k IS NULL THEN a.n ELSE b.n END AS nation, CASE WHEN b.k IS NULL THEN 'kept' WHEN a.k IS NULL THEN 'added' WHEN a.n IS NOT DISTINCT FROM b.n THEN 'same' ELSE 'changed' END AS change FROM a FULL JOIN b ON a.k = b.k""")
def promoted_sources(spark, d):
    """Suppliers as ledger rows; an export of some of them, with odd ones changed, is promoted over it."""
    s = _t(spark, d, "supplier")
    k, n = F.col("s_suppkey"), F.col("s_nationkey")
    return I.promoted(s.where(k % 3 != 0).select(k.alias("source_id"), n.alias("nation")), s.where(k % 5 != 0).select(k.alias("source_id"), F.when(k % 2 == 0, n).otherwise(n + 1).alias("nation")), "source_id")


_CLAIM = """raw AS (SELECT l_orderkey AS parent_id, 's' || l_suppkey AS subject, CASE WHEN l_linenumber = 6 THEN ' ' ELSE 'v' || l_partkey % 4 END AS predicate, l_returnflag AS object, CAST(l_shipdate AS DATE) AS vf, CAST(l_shipdate AS DATE) + CAST(l_linenumber * 10 - 20 AS INTEGER) AS vt, CASE WHEN l_linestatus = 'O' THEN 'SUPPORTS' ELSE 'CONTRADICTS' END AS stance FROM lineitem),
cl AS (SELECT *, sha256(concat_ws(chr(10), subject, predicate, object, CAST(vf AS VARCHAR), CAST(vt AS VARCHAR))) AS claim_id FROM raw WHERE vf <= vt AND trim(predicate) <> '')"""


def _claims(spark, d):
    """Lines as statements of a supplier, valid from the day of shipping to some days before or after."""
    ship = F.col("l_shipdate").cast("date")
    return I.claims(_t(spark, d, "lineitem").select(
        F.col("l_orderkey").alias("parent_id"), F.concat(F.lit("s"), "l_suppkey").alias("subject"), F.when(F.col("l_linenumber") == 6, " ").otherwise(F.concat(F.lit("v"), F.col("l_partkey") % 4)).alias("predicate"), F.col("l_returnflag").alias("object"),
        ship.cast("string").alias("valid_from"), F.date_add(ship, (F.col("l_linenumber") * 10 - 20).cast("int")).cast("string").alias("valid_to"), F.when(F.col("l_linestatus") == "O", "SUPPORTS").otherwise("CONTRADICTS").alias("stance"),
    ))


@query(f"WITH {_CLAIM} SELECT parent_id, claim_id, subject, predicate, object, vf AS valid_from, vt AS valid_to, stance FROM cl")
def extracted_claims(spark, d):
    return _claims(spark, d)


@query(f"""WITH {_CLAIM}, f AS (SELECT * FROM cl WHERE parent_id % 4 = 0 AND object <> 'R'), s AS (SELECT * FROM cl WHERE stance = 'SUPPORTS')
SELECT claim_id, parent_id, stance FROM s WHERE parent_id NOT IN (SELECT parent_id FROM f) UNION ALL SELECT claim_id, parent_id, max(stance) FROM f GROUP BY 1, 2""")
def replaced_evidence(spark, d):
    """Supporting claims are stored; a fourth of the orders is extracted anew."""
    c = _claims(spark, d).select("claim_id", "parent_id", "stance", "object")
    return I.claim_evidence(c.where("stance = 'SUPPORTS'").drop("object"), c.where("parent_id % 4 = 0 AND object <> 'R'").drop("object"))


@query("""WITH n AS (SELECT DISTINCT l_orderkey AS p, 's' || l_suppkey AS id FROM lineitem WHERE l_linenumber < 5), r AS (SELECT DISTINCT a.l_orderkey AS p, 's' || a.l_suppkey AS s, 's' || b.l_suppkey AS t FROM lineitem a JOIN lineitem b ON a.l_orderkey = b.l_orderkey AND b.l_linenumber = a.l_linenumber + 1)
SELECT p AS parent_id, s AS source, t AS target, 'NEXT' AS type FROM r WHERE s <> t AND (p, s) IN (SELECT (p, id) FROM n) AND (p, t) IN (SELECT (p, id) FROM n)""")
def valid_relations(spark, d):
    """Suppliers of successive lines are related; those of the first four lines are nodes."""
    line = _t(spark, d, "lineitem").select(F.col("l_orderkey").alias("parent_id"), "l_linenumber", F.concat(F.lit("s"), "l_suppkey").alias("id"))
    after = line.select("parent_id", (F.col("l_linenumber") - 1).alias("l_linenumber"), F.col("id").alias("target"))
    relations = line.join(after, ["parent_id", "l_linenumber"]).select("parent_id", F.col("id").alias("source"), "target", F.lit("NEXT").alias("type"))
    return I.valid_extraction(line.where("l_linenumber < 5").select("parent_id", "id"), relations)[1]


@query("""SELECT o_orderkey FROM orders WHERE o_orderkey % 10 < 6 AND o_orderkey % 10 >= 3 AND o_orderkey % 7 = 0""")
def merge_collisions(spark, d):
    """Two stores of orders that share some; in the second every seventh has another priority."""
    o = _t(spark, d, "orders").select("o_orderkey", "o_orderpriority", "o_custkey")
    k = F.col("o_orderkey")
    return M.collisions(o.where(k % 10 < 6), o.where(k % 10 >= 3).withColumn("o_orderpriority", F.when(k % 7 == 0, "?").otherwise(F.col("o_orderpriority"))), "o_orderkey")


@query("""WITH x AS (SELECT *, CAST(s_nationkey AS VARCHAR) AS t FROM supplier), y AS (SELECT s_suppkey, t FROM x WHERE s_suppkey % 2 = 0 UNION ALL SELECT s_suppkey, t FROM x WHERE s_suppkey % 2 = 1)
SELECT s_suppkey, t AS nation FROM y""")
def merged_stores(spark, d):
    """Even suppliers are the target, all are the source."""
    s = _t(spark, d, "supplier").select("s_suppkey", F.col("s_nationkey").cast("string").alias("nation"))
    return M.merged(s, s.where("s_suppkey % 2 = 0"), "s_suppkey")


@query("""WITH h AS (SELECT o_custkey, sha256(o_orderkey || chr(31) || o_orderpriority || chr(31) || coalesce(CASE WHEN o_orderkey % 5 <> 0 THEN o_orderstatus END, chr(0))) AS h FROM orders)
SELECT o_custkey, count(*) AS n, bit_xor(CAST('0x' || substr(h, 1, 15) AS BIGINT)) AS mixed, CAST(sum(CAST('0x' || substr(h, 16, 7) AS BIGINT)) AS BIGINT) AS summed FROM h GROUP BY 1""")
def table_fingerprints(spark, d):
    o = _t(spark, d, "orders").select("o_custkey", "o_orderkey", "o_orderpriority", F.when(F.col("o_orderkey") % 5 != 0, F.col("o_orderstatus")).alias("s"))
    return M.fingerprint(o, ["o_orderkey", "o_orderpriority", "s"], ["o_custkey"])


@query("SELECT CASE WHEN l_linenumber > 5 THEN NULL ELSE l_orderkey END AS k, count(*) AS n FROM lineitem GROUP BY 1 HAVING count(*) > 1 OR k IS NULL")
def broken_constraints(spark, d):
    """Orders of several lines break the constraint that a line's order be unique."""
    return M.invalid_keys(_t(spark, d, "lineitem").select(F.when(F.col("l_linenumber") <= 5, F.col("l_orderkey")).alias("k")), "k")


@query("""WITH k AS (SELECT l_suppkey AS id, avg(l_discount) * 10 AS c, avg(l_tax) * 10 AS u, avg(CASE WHEN l_returnflag = 'R' THEN 1.0 ELSE 0 END) AS dup, count(*) AS n FROM lineitem GROUP BY 1), t AS (SELECT *, round(c, 9) > 0.5 OR round(u, 9) > 0.4 AS tax, round(dup, 9) > 0.25 AS cop FROM k),
g AS (SELECT *, CASE WHEN id % 2 = 0 THEN 0.8 ELSE 0.995 END AS p FROM t) SELECT id, CASE WHEN tax AND cop THEN 'mixed_debt' WHEN cop THEN 'duplicate_debt' WHEN tax THEN 'taxonomy_debt' ELSE 'balanced' END AS mode,
CAST(CASE WHEN least(0.99, p) < 0.9 AND NOT (round(dup, 9) > 0.3 AND n >= 20 AND id % 3 = 0) THEN 0.9 ELSE least(0.99, p) END AS DOUBLE) AS threshold FROM g""")
def consolidation_control(spark, d):
    """Suppliers as runs, their lines' means as key figures."""
    k = _t(spark, d, "lineitem").groupBy(F.col("l_suppkey").alias("id")).agg(F.avg("l_discount").alias("c"), F.avg("l_tax").alias("u"), F.avg(F.when(F.col("l_returnflag") == "R", 1.0).otherwise(0.0)).alias("dup"), F.count("*").alias("n"))
    c, u, dup = F.round(F.col("c") * 10, 9), F.round(F.col("u") * 10, 9), F.round("dup", 9)
    proposed, accepted = F.when(F.col("id") % 2 == 0, 0.8).otherwise(0.995), F.when(F.col("id") % 3 == 0, 0.5).otherwise(0.1)
    return k.select("id", C.failure_mode(c, u, dup, concept=0.5, untaxed=0.4, duplicates=0.25).alias("mode"), C.guarded_threshold(F.lit(0.9), proposed, dup, F.col("n"), accepted, target=0.25).alias("threshold"))


_CAT = """cat AS (SELECT o_custkey AS catalog_id, CASE WHEN o_orderkey % 9 = 0 THEN ' ' WHEN o_orderkey % 5 = 0 THEN 'Concept' WHEN o_orderkey % 7 = 0 THEN 'a`b' ELSE CASE WHEN o_orderkey % 2 = 0 THEN upper(o_orderpriority) ELSE lower(o_orderpriority) END END AS label FROM orders)"""


@query(f"""WITH {_CAT}, g AS (SELECT catalog_id, count(*) FILTER (trim(label) <> '') AS n, count(DISTINCT lower(label)) FILTER (trim(label) <> '') AS d, coalesce(bool_or(trim(label) = 'Concept'), FALSE) AS has, bool_or(label LIKE '%`%') AS tick FROM cat GROUP BY 1)
SELECT catalog_id, unnest(list_filter([CASE WHEN NOT has THEN 'missing' END, CASE WHEN tick THEN 'backtick' END, CASE WHEN d < n THEN 'repeated' END, CASE WHEN n > 12 THEN 'many' END], lambda x: x IS NOT NULL)) AS fault FROM g""")
def catalog_faults(spark, d):
    """Customers as catalogs, their orders' priorities as labels."""
    k, p = F.col("o_orderkey"), F.col("o_orderpriority")
    label = F.when(k % 9 == 0, " ").when(k % 5 == 0, "Concept").when(k % 7 == 0, "a`b").otherwise(F.when(k % 2 == 0, F.upper(p)).otherwise(F.lower(p)))
    return C.catalog_faults(_t(spark, d, "orders").select(F.col("o_custkey").alias("catalog_id"), label.alias("label")), most=12)


@query("""WITH m AS (SELECT o_orderkey AS id, CAST(o_orderkey % 5 AS INTEGER) AS attempt, CASE o_orderkey % 3 WHEN 0 THEN 'Error: Maximum context length' WHEN 1 THEN 'timeout' END AS message FROM orders), p AS (SELECT id, attempt, attempt + CASE WHEN id % 3 = 0 THEN 1 ELSE 0 END AS next FROM m)
SELECT id, attempt, ['original', 'low-verbosity-same-chunks', 'rechunk-2000', 'rechunk-1000', 'rechunk-500'][next + 1] AS name, CASE WHEN next < 5 THEN next > 0 END AS low_verbosity, [0, 0, 2000, 1000, 500][next + 1] AS tokens, [0, 0, 200, 100, 50][next + 1] AS overlap, [0, 1, 1, 1, 1][next + 1] AS combined FROM p""")
def retry_plans(spark, d):
    k = F.col("o_orderkey")
    failed = _t(spark, d, "orders").select(k.alias("id"), (k % 5).cast("int").alias("attempt"), F.when(k % 3 == 0, "Error: Maximum context length").when(k % 3 == 1, "timeout").alias("message"))
    return C.retry_plan(failed, names.over_limit(F.col("message"))).drop("message")


@query(r"""WITH w AS (SELECT doc_id, unnest(list_filter(string_split_regex(lower(text), '[ \t\n\r\f]+'), lambda x: x <> '')) AS w FROM documents), n AS (SELECT doc_id, CAST(CAST('0x' || substr(md5(w), 1, 8) AS BIGINT) % 256 AS INTEGER) AS slot, count(*) AS n FROM w GROUP BY 1, 2)
SELECT doc_id AS document_id, slot, n, round(n / sqrt(sum(n * n) OVER (PARTITION BY doc_id)), 9) AS weight FROM n""")
def hashed_vectors(spark, d):
    return C.hashed_features(_docs(spark, d)).withColumn("weight", F.round("weight", 9))


@query("""WITH s AS (SELECT l_orderkey AS ds, l_linenumber AS place, CASE WHEN l_returnflag = 'R' THEN 'yes' ELSE 'no' END AS v, CASE WHEN l_linestatus = 'F' THEN 'first' ELSE 'tie' END AS w, l_suppkey % 5 AS a, l_partkey % 5 AS b, l_suppkey % 20 AS ta, l_partkey % 20 AS tb FROM lineitem)
SELECT ds AS dataset, place AS question_id, CAST(row_number() OVER (PARTITION BY ds ORDER BY greatest(a, b), greatest(ta, tb), place) AS INTEGER) AS position FROM s WHERE v = 'no' AND a <= 3 AND b <= 3 QUALIFY position <= 2""")
def reserve_questions(spark, d):
    """Orders as data sets, lines as questions."""
    s, p = F.col("l_suppkey"), F.col("l_partkey")
    return C.reserve_swaps(_t(spark, d, "lineitem").select(
        F.col("l_orderkey").alias("dataset"), F.col("l_linenumber").alias("question_id"), F.col("l_linenumber").alias("place"), F.when(F.col("l_returnflag") == "R", "yes").otherwise("no").alias("value"), F.when(F.col("l_linestatus") == "F", "first").otherwise("tie").alias("winner"),
        (s % 5).alias("first_synthesis"), (p % 5).alias("second_synthesis"), (s % 20).alias("first_total"), (p % 20).alias("second_total"),
    ))


@query(r"""WITH p AS (SELECT page_id, url, regexp_replace(regexp_replace(url, '^[A-Za-z][A-Za-z0-9+.-]*://', ''), '[?#].*$', '') AS rest FROM pages), q AS (SELECT *, regexp_extract(rest, '^([^/]*)', 1) AS host, trim(regexp_replace(rest, '^[^/]*', ''), '/') AS path FROM p),
s AS (SELECT *, trim(regexp_replace(regexp_replace(trim(url), '[^A-Za-z0-9._-]+', '_', 'g'), '_+', '_', 'g'), '._') AS stem, lower(trim(regexp_replace(url, '[^A-Za-z0-9]+', '_', 'g'), '_')) AS st FROM q)
SELECT page_id, CASE WHEN stem = '' THEN 'record' ELSE stem END AS stem, CASE WHEN st = '' THEN 'source' ELSE st END || '__' || substr(sha1(url), 1, 10) || '.txt' AS staged, CASE WHEN path = '' THEN string_split(host, '.')[1] ELSE string_split(path, '/')[-1] END AS last FROM s""")
def file_names(spark, d):
    u = F.col("url")
    return _t(spark, d, "pages").select("page_id", names.file_stem(u).alias("stem"), names.staged_name(u).alias("staged"), names.last_segment(u).alias("last"))
