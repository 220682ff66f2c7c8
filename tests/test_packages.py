"""Subtitle cues, source packages and the vector index."""

import hashlib
import json

import pytest
from pyspark.sql import functions as F

from strataloom.sources import packages as P

VTT = "﻿WEBVTT\r\nKind: captions\r\n\r\n00:00:01.000 --> 00:00:02.500 align:start\r\n<c>Hello</c>\r\n  there \r\n\r\n01:02,250 --> 01:03,000\r\n\r\n5.5 --> 1:00:00\nlast <b></b>\n"


def test_cues(spark):
    rows = P.cues(spark.createDataFrame([("a", VTT), ("b", "WEBVTT\n\nno cue"), ("c", None)], "document_id string, text string"))
    got = sorted(map(tuple, rows.collect()))
    assert got == [("a", 0, 1000, 2500, "Hello there"), ("a", 1, 5500, 3_600_000, "last")]
    want = hashlib.sha256(b"1000:Hello there\n5500:last").hexdigest()
    assert P.transcript_checksum(rows).collect() == [("a", want)]


def test_stamps(spark):
    df = spark.createDataFrame([("1:02.5",), ("x:1",), ("",), (None,), ("1:1:1:1",)], "s string")
    assert [r[0] for r in df.select(P.milliseconds(F.col("s"))).collect()] == [62_500, None, None, None, None]


def test_packages(spark, tmp_path):
    meta = {"provider": "doi", "provider_source_id": "10.1/x", "title": "T", "source_type": "paper", "content_sha256": hashlib.sha256(b"# hi").hexdigest()}
    for name, m, body in (("ok", meta, "# hi"), ("changed", meta, "# ho"), ("blank", meta | {"title": " "}, "# hi"), ("bare", None, "# hi"), ("empty", meta, None), ("uri", meta | {"canonical_uri": "https://e.org/1", "language": "de"}, "# hi")):
        (tmp_path / name).mkdir()
        if m:
            (tmp_path / name / "source.json").write_text(json.dumps(m))
        if body:
            (tmp_path / name / "content.md").write_text(body)
    got = {r["folder"].rsplit("/", 1)[1]: r for r in P.packages(spark, str(tmp_path)).collect()}
    assert {k: r["error"] for k, r in got.items()} == {
        "ok": None, "uri": None, "changed": "content checksum does not match", "blank": "missing fields: title", "bare": "source.json and content.md are required", "empty": "source.json and content.md are required",
    }
    assert (got["ok"]["uri"], got["ok"]["language"], got["uri"]["uri"], got["uri"]["language"]) == ("doi:10.1/x", "en", "https://e.org/1", "de")


def test_vector_index(spark):
    schema = "record_id string, corpus_id string, revision_id string, vector array<float>"
    index = spark.createDataFrame([("1", "c", "old", [1.0, 0.0]), ("2", "c", "r1", [0.0, 1.0])], schema)
    active = spark.createDataFrame([("2", "c", "r1", [0.5, 0.5]), ("3", "c", "r2", [0.0, 0.0])], schema)
    assert sorted((r["record_id"], list(r["vector"])) for r in P.synchronised(index, active, 2).collect()) == [("2", [0.5, 0.5]), ("3", [0.0, 0.0])]
    with pytest.raises(Exception, match="vector of 3 is not of 3 finite"):
        P.upsert_vectors(index, active.where("record_id = '3'"), 3).collect()
