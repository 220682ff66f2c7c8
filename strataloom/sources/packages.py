"""Subtitle cues, source packages, and vectors that are kept in step with active revisions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import valid_vector
from .files import upsert


def milliseconds(stamp: Column) -> Column:
    """Milliseconds of [h:]m:s or s with a point or a comma before fractions; null if it is no such stamp."""
    parts = F.split(F.replace(stamp, F.lit(","), F.lit(".")), ":")
    at = lambda k: F.coalesce(F.try_element_at(parts, F.lit(-k)).try_cast("double"), F.lit(0.0))
    whole = F.aggregate(parts, F.lit(True), lambda ok, p: ok & p.try_cast("double").isNotNull())
    return F.when(whole & (F.size(parts) <= 3), F.bround(at(1) * 1000 + at(2) * 60_000 + at(3) * 3_600_000).cast("long"))


def cues(files: DataFrame) -> DataFrame:
    """document_id, ordinal, start_ms, end_ms, text of the cues in subtitle files (document_id, text).

    A cue is a timing line and the lines up to the next blank one, without tags, joined by spaces; a cue without text is left out. What stands before a file's first
    timing, such as its header, is no cue.
    """
    text = F.regexp_replace(F.regexp_replace("text", "^﻿", ""), "\r\n?", "\n")
    timing = r"([^ \n]+)[ \t]+-->[ \t]+([^ \n]+)[^\n]*"
    body = r"((?:\n(?![ \t]*(?:\n|$))[^\n]+)*)"
    found = F.regexp_extract_all(text, F.lit(f"(?m)^{timing}{body}"), 0)
    cue = files.select("document_id", F.posexplode(found).alias("at", "cue"))
    part = lambda k: F.regexp_extract("cue", f"^{timing}{body}", k)
    lines = F.filter(F.transform(F.split(F.regexp_replace(part(3), "<[^>]+>", ""), "\n"), lambda x: F.trim(x)), lambda x: x != "")
    kept = cue.select("document_id", "at", milliseconds(part(1)).alias("start_ms"), milliseconds(part(2)).alias("end_ms"), F.array_join(lines, " ").alias("text")).where("text <> ''")
    return kept.groupBy("document_id").agg(F.array_sort(F.collect_list(F.struct("at", "start_ms", "end_ms", "text"))).alias("c")).select("document_id", F.posexplode("c").alias("ordinal", "x")).select("document_id", "ordinal", "x.start_ms", "x.end_ms", "x.text")


def transcript_checksum(cue_rows: DataFrame) -> DataFrame:
    """document_id, checksum: SHA-256 of a document's lines `start_ms:text` in order. A document's cues are one transcript."""
    line = F.struct("ordinal", F.concat_ws(":", "start_ms", "text").alias("x"))
    got = cue_rows.groupBy("document_id").agg(F.array_sort(F.collect_list(line)).alias("c"))
    return got.select("document_id", F.sha2(F.array_join(F.transform("c", lambda s: s["x"]), "\n"), 256).alias("checksum"))


_META = "provider string, provider_source_id string, canonical_uri string, title string, source_type string, language string, content_sha256 string"


def packages(spark: SparkSession, root: str) -> DataFrame:
    """folder, the package's fields, uri, text, checksum and error (null if none) of every folder below root with a source.json or a content.md.

    Errors: a file is missing, a required field is missing or blank, or the content's SHA-256 is not the stated one. Language is en unless stated; the URI
    is provider:id unless stated. Faulty packages are rows with error, so that one does not stop the others.
    """
    folder = F.regexp_extract("path", "^(.*)/[^/]+$", 1).alias("folder")
    read = lambda name: spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", name).load(root)
    meta = read("source.json").select(folder, F.from_json(F.col("content").cast("string"), _META).alias("m"))
    body = read("content.md").select(folder, F.make_valid_utf8(F.col("content").cast("string")).alias("text"), F.sha2("content", 256).alias("checksum"))
    both = meta.join(body, "folder", "full_outer").select("folder", "m.*", "text", "checksum", F.col("m").isNotNull().alias("__m"))
    required = ("provider", "provider_source_id", "title", "source_type")
    blank = F.array_join(F.filter(F.array(*(F.when(F.coalesce(F.trim(c), F.lit("")) == "", F.lit(c)) for c in sorted(required))), lambda x: x.isNotNull()), ", ")
    stated = F.coalesce("content_sha256", F.lit(""))
    error = (
        F.when(~F.col("__m") | F.col("checksum").isNull(), F.lit("source.json and content.md are required")).when(blank != "", F.concat(F.lit("missing fields: "), blank))
        .when((stated != "") & (stated != F.col("checksum")), "content checksum does not match")
    )
    uri = F.coalesce(F.when(F.col("canonical_uri") != "", F.col("canonical_uri")), F.concat_ws(":", F.trim("provider"), F.trim("provider_source_id")))
    return both.select("folder", *(F.trim(c).alias(c) for c in required), F.coalesce("language", F.lit("en")).alias("language"), uri.alias("uri"), "text", "checksum", error.alias("error"))


def upsert_vectors(existing: DataFrame, new: DataFrame, dimension: int) -> DataFrame:
    """existing with new rows (record_id, vector, ...) in place of those that share record_id; a vector of another dimension or with numbers that are not finite is an error."""
    checked = new.where(F.assert_true(valid_vector(F.col("vector"), dimension), F.concat(F.lit("vector of "), "record_id", F.lit(f" is not of {dimension} finite numbers"))).isNull())
    return upsert(existing, checked, "record_id")


def synchronised(index: DataFrame, active: DataFrame, dimension: int) -> DataFrame:
    """The index after a sync: active records upserted, and those of revisions (corpus_id, revision_id) that are no longer active gone."""
    live = active.select("corpus_id", "revision_id").distinct()
    return upsert_vectors(index, active, dimension).join(live, ["corpus_id", "revision_id"], "left_semi")
