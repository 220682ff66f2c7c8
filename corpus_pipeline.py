"""Documents to packed training sequences: toxicity, line dedup, near-duplicates, decontamination, packing.

Each stage works on all rows that the one before it kept. What it returns is written as Parquet in the shared folder and read again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataloom.llm import decontam, line_dedup, neardup, packing, queries, toxicity
from strataloom.llm.common import materialize, table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _documents(df: DataFrame) -> DataFrame:
    return df.withColumn("n_chars", F.coalesce(F.length("text"), F.lit(0)).cast("long")).select(*COLUMNS)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject. It learns from the labelled rows of this stage's own input, by op3's rule."""
    return toxicity.toxicity(docs, queries.toxicity_model(spark, sf_dir, docs)).where("predicted = 0").select(*COLUMNS)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without repeated cross-site lines; those of which nothing but blanks is left go, if something was removed."""
    out = line_dedup.line_dedup(docs)
    return _documents(out.where((F.col("n_removed") == 0) | (F.trim(F.translate("text", "\n\r\t", "   ")) != "")))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near-duplicates: that with the least id, of equal ids that with the least digest of its text; rows without an id come last.

    Rows are compared as such, also those that repeat an id or have none. Rows without words are no copies of each other, unless they agree in id and text.
    """
    rows = materialize(docs.withColumn("__row", F.monotonically_increasing_id()), "rows", scan=True)
    found = neardup.near_duplicates(rows, id_col="__row").select(F.col("doc_id").alias("__row"), "n_shingles", "component_id")
    small = rows.select("__row", "doc_id", F.sha2("text", 256).alias("digest")).join(found, "__row")
    blank = F.when(F.col("n_shingles") == 0, F.struct(F.when(F.col("doc_id").isNull(), F.col("__row")).alias("row"), "doc_id", "digest"))
    group = [F.when(F.col("n_shingles") > 0, F.col("component_id")).alias("component"), blank.alias("blank")]
    kept = small.groupBy(*group).agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "digest", "__row")).alias("first")).select("first.__row")
    return rows.join(kept, "__row", "left_semi").select(*COLUMNS)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Contaminated documents go; from the others, the words that benchmark windows cover are cut."""
    found = decontam.with_decision(decontam.decontaminate(docs, table(spark, sf_dir, "benchmark"), cut=True))
    return _documents(found.where("NOT contaminated"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.best_fit_pack(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_lines),
    ("near_duplicates", drop_copies),
    ("decontamination", drop_benchmark),
    ("packing", pack),
]

#: A classifier, sketches and best-fit packing are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs
