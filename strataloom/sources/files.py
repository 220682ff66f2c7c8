"""Files to tables and tables to files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SUFFIXES = ("txt", "md", "markdown", "pdf")
#: Folders that a scan of sources leaves out, beside hidden ones.
EXCLUDED = ("__pycache__", "node_modules", "artifacts")


def discover(spark: SparkSession, root: str) -> DataFrame:
    """source_id (path below root), suffix, length, content, checksum of non-empty source files at any depth; hidden files and folders and office locks are left out."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*").load(root)
    base = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
    base = base.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(base).toString().rstrip("/")
    plain = lambda c: F.regexp_replace(c, "^file:/+", "file:/")
    inner = F.expr("substring(p, length(b) + 2)")
    named = files.withColumns({"p": plain(F.col("path")), "b": plain(F.lit(base))}).withColumn("source_id", inner)
    suffix = F.lower(F.regexp_extract("source_id", r"\.([^./]+)$", 1))
    parts = F.split("source_id", "/")
    seen = ~F.exists(parts, lambda x: x.startswith(".") | x.startswith("~$")) & ~F.arrays_overlap(parts, F.array(*map(F.lit, EXCLUDED)))
    kept = named.where((F.col("length") > 0) & seen).withColumn("suffix", suffix).where(F.col("suffix").isin(*SUFFIXES))
    return kept.select("source_id", "suffix", "length", "content", F.sha2("content", 256).alias("checksum"))


def texts(files: DataFrame) -> DataFrame:
    """document_id, text, valid: text files decoded as UTF-8; where that fails, bytes that are none become replacement characters and valid is false."""
    rows = files.where(F.col("suffix") != "pdf")
    return rows.select(F.col("source_id").alias("document_id"), F.make_valid_utf8(F.col("content").cast("string")).alias("text"), F.is_valid_utf8(F.col("content").cast("string")).alias("valid"))


def tab_separated(spark: SparkSession, path: str, schema: str) -> DataFrame:
    r"""Tab-separated values with a header, \N as null, gzip or not."""
    return spark.read.csv(path, sep="\t", header=True, schema=schema, nullValue="\\N", quote="")


def upsert(existing: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """existing with the rows of new in place of those that share their key."""
    return existing.join(new.select(key), key, "left_anti").unionByName(new)


def without_revisions(records: DataFrame, revisions: DataFrame) -> DataFrame:
    """records but for those of the revisions (corpus_id, revision_id)."""
    return records.join(revisions, ["corpus_id", "revision_id"], "left_anti")


def export(tables: dict[str, DataFrame], folder: str) -> DataFrame:
    """Writes each table as zstd Parquet below folder; returns name, n and fingerprint (independent of order) of what can be read back, also written as manifest."""
    out = None
    for name, df in tables.items():
        path = f"{folder.rstrip('/')}/{name}"
        df.write.option("compression", "zstd").mode("overwrite").parquet(path)
        back = df.sparkSession.read.schema(df.schema).parquet(path)
        row = F.sha2(F.to_json(F.struct(*sorted(back.columns)), {"ignoreNullFields": "false"}), 256)
        mark = back.agg(F.count("*").alias("n"), F.coalesce(F.bit_xor(F.conv(F.substring(row, 1, 15), 16, 10).cast("long")), F.lit(0)).alias("fingerprint")).select(F.lit(name).alias("name"), "n", "fingerprint")
        out = mark if out is None else out.unionByName(mark)
    out.coalesce(1).write.mode("overwrite").json(f"{folder.rstrip('/')}/manifest")  # one row a table
    return out
