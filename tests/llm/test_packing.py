"""What packing reads of a table: rows' numbers, word counts and folded texts; and shingles of many texts at once."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from strataloom.llm import neardup, packing, queries
from strataloom.llm.common import numbered, space_words

_SPACES = " \t\n\x0b\f\r"


def _texts():
    rng = random.Random(3)
    return [None, "", " ", "\n\t", "a", " a", "a ", "A  b", "a b c", "É\x1cx y", "ß İ\r\nΣ", *("".join(rng.choice("abÉ" + _SPACES * 2) for _ in range(rng.randrange(30))) for _ in range(300))]


def test_words_and_folded_texts(spark):
    rows = spark.createDataFrame([(k, t) for k, t in enumerate(_texts())], "k long, text string")
    plain = F.trim(F.regexp_replace(F.coalesce("text", F.lit("")), r"\s+", " "))
    got = rows.select("k", packing.word_count(F.col("text")).alias("n"), packing.folded(F.col("text")).alias("f"), F.xxhash64(F.lower(plain)).alias("g")).collect()
    texts = _texts()
    assert all(r["n"] == len(space_words(texts[r["k"]])) and r["f"] == r["g"] for r in got)


def test_rows_keep_their_numbers(spark, tmp_path):
    docs = spark.range(0, 4000, 1, 7).select(F.col("id").alias("doc_id"), F.concat(F.lit("t "), F.col("id")).alias("text"), F.lit(None).cast("string").alias("source"))
    docs.union(docs.limit(500)).write.parquet(f"{tmp_path}/documents.parquet")
    seen = []
    for most in ("128m", "1k"):  # other tasks, the same numbers
        spark.conf.set("spark.sql.files.maxPartitionBytes", most)
        try:
            seen.append(sorted((r["__row"], r["doc_id"]) for r in numbered(spark.read.parquet(f"{tmp_path}/documents.parquet")).collect()))
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert seen[0] == seen[1] and len({row for row, _ in seen[0]}) == 4500
    spark.range(0).select(F.col("id").alias("doc_id"), F.lit("").alias("text")).write.parquet(f"{tmp_path}/none.parquet")
    assert numbered(spark.read.parquet(f"{tmp_path}/none.parquet")).count() == 0


def test_texts_are_not_written_again(spark, sf_dir, monkeypatch):
    written = []
    for module in (packing, neardup):
        monkeypatch.setattr(module, "materialize", lambda df, label, plain=module.materialize, **k: (written.append((label, df.columns)), plain(df, label, **k))[1])
    out = queries.op5_packing(spark, sf_dir)
    assert out.select("doc_id").distinct().count() == spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id").distinct().count()
    assert written and not [label for label, columns in written if "text" in columns]


@pytest.mark.parametrize("width", [1, 2, 5])
def test_shingles_of_many_texts(width):
    texts = _texts()
    for some in (texts, [], [None], ["a b"]):
        sets = neardup.shingle_sets(some, width)
        assert len(sets) == len(some)
        for t, s in zip(some, sets, strict=True):
            w = space_words(t)
            n = min(width, len(w))
            assert len(s) == len({tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if w else ())
            assert np.array_equal(s, neardup.shingles(t, width))
