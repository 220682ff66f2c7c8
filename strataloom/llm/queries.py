"""One query per operator of this subpackage, with production parameters, over whole tables; and SQL where it can say the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontam, langid, line_dedup, media, neardup, packing, pst, secrets, toxicity, warc
from .common import bucket, numbered, shared_dir, table


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.line_dedup(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_removed", F.sha2("text", 256).alias("clean_sha256"))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontam.with_decision(decontam.decontaminate(docs, table(spark, sf_dir, "benchmark")))
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def toxicity_model(spark: SparkSession, sf_dir: str, docs: DataFrame) -> toxicity.Compressor:
    """Learned from labelled rows whose crc32(doc_id) mod 5 is not 0."""
    learned = bucket("doc_id", 5) != 0
    rows, weight = toxicity.sample(docs.select("doc_id", "text").where(learned), table(spark, sf_dir, "labels").select("doc_id", "toxic").where(learned))
    return toxicity.fit(rows, ordinary_weight=weight)


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = toxicity.toxicity(docs, toxicity_model(spark, sf_dir, docs))
    return out.select("doc_id", F.coalesce(bucket("doc_id", 5) == 0, F.lit(False)).alias("held_out"), "score", "predicted")


def op4_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = media.to_media(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "n_bytes", "media")
    return media.media_features(stored).select("doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature")


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_facts(packing.clustered_facts(numbered(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))))


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.secret_spans(table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = F.filter("secrets", lambda s: s["order"] < 3)
    count = lambda k: F.size(F.filter("secrets", lambda s: s["order"] == k)).cast("long")
    return found.select(
        "doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
        F.sha2(secrets.joined_spans(base), 256).alias("base_sha256"), secrets.joined_spans(F.col("secrets")).alias("spans"),
    )


def op7_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"), width=2)


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_dir(spark, "warc")
    warc.write_warc(table(spark, sf_dir, "pages"), path)
    return warc.read_warc(spark, path, with_payload=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op9_suffix_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = pst.fit(docs.where(bucket("doc_id", 5) != 1).select("text"), depth=3)
    marked = docs.withColumn("held_out", F.coalesce(bucket("doc_id", 5) == 1, F.lit(False)))
    return pst.score(marked, model).select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    net = langid.train(docs.where(bucket("doc_id", 4) != 2))
    marked = docs.select("doc_id", "text", F.coalesce(bucket("doc_id", 4) == 2, F.lit(False)).alias("held_out"))
    return langid.identify(marked, net).select("doc_id", "held_out", "lang_pred", "score")


QUERIES = {f.__name__: f for f in (op1_line_dedup, op2_decontamination, op3_toxicity, op4_media, op5_packing, op6_secrets, op7_near_duplicates, op8_warc, op9_suffix_tree, op10_language)}

_OP1 = """
WITH rows AS (
  SELECT doc_id, text, source, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS no FROM documents),
spread AS (
  SELECT trim(line, ' ') AS line, count(DISTINCT source) AS sites, min((doc_id, no)) AS head FROM rows WHERE trim(line, ' ') <> '' GROUP BY 1),
marked AS (
  SELECT r.doc_id, r.no, r.line, coalesce(s.sites >= 6 AND (r.doc_id, r.no) <> s.head, FALSE) AS gone
  FROM rows r LEFT JOIN spread s ON trim(r.line, ' ') = s.line)
SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (gone)::BIGINT AS n_removed,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY no) FILTER (NOT gone), '')) AS clean_sha256
FROM marked GROUP BY doc_id"""

ORACLE_SQL = {"op1_line_dedup": _OP1}
