"""What the operators of this subpackage share: table access, shared folders, text splitting."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.storage import materialize, release, shared_dir, tasks  # noqa: F401

_UPPER = bytes(range(65, 91))
#: ASCII bytes that end a word of letters and digits (bytes from 0x80 on are word bytes).
_NOT_ALNUM = bytes(b for b in range(128) if not (48 <= b <= 57 or 97 <= b <= 122 or 65 <= b <= 90))
_FOLD = bytes.maketrans(_UPPER, _UPPER.lower())
_FOLD_ALNUM = bytes.maketrans(_NOT_ALNUM + _UPPER, b" " * len(_NOT_ALNUM) + _UPPER.lower())


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def numbered(scan: DataFrame) -> DataFrame:
    """scan, a table as `table` reads it, with __row: a number for each row, made of its file's and its place there, which is the same each time that it is read, whatever the tasks."""
    at = scan.select("*", F.col("_metadata.file_path").alias("__file"), F.col("_metadata.row_index").alias("__place"))
    files = at.select("__file").distinct().orderBy("__file").collect()
    known = scan.sparkSession.createDataFrame([(r["__file"], k) for k, r in enumerate(files)], "__file string, __number long")
    return at.join(F.broadcast(known), "__file").withColumn("__row", F.shiftleft("__number", 40) + F.col("__place")).drop("__file", "__place", "__number")


def utf8(text: str | None) -> bytes:
    """UTF-8 of a text; null is empty, lone surrogates become '?'."""
    return (text or "").encode("utf-8", "replace")


def alnum_words(text: str | None) -> list[bytes]:
    """Words of letters and digits: A-Z lower-cased, every other ASCII byte separates."""
    return utf8(text).translate(_FOLD_ALNUM).split()


def space_words(text: str | None) -> list[bytes]:
    """Words between runs of space and 0x09-0x0D, A-Z lower-cased."""
    return utf8(text).translate(_FOLD).split()


def bucket(column: Column | str, modulus: int) -> Column:
    """crc32 of the id's decimal text, modulo; null for a null id."""
    return F.crc32(F.col(column).cast("string") if isinstance(column, str) else column.cast("string")) % modulus


@contextmanager
def arrow_rows(spark: SparkSession, most: int) -> Iterator[None]:
    """While it lasts, batches sent to Python hold at most `most` rows: for jobs whose rows are large. It covers only what runs inside."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(most))
    try:
        yield
    finally:
        spark.conf.set(key, before)
