"""Staged copies, merges, workflows that resume, cached results and the states' edge cases."""

import json

import pytest
from pyspark.sql import functions as F

from strataloom.operators import control, ingestions, migration


def test_merge_raises_on_collisions(spark):
    a = spark.createDataFrame([(1, "x", None), (2, "y", 1)], "id int, t string, n int")
    b = spark.createDataFrame([(1, "x", None), (3, "z", 1)], "id int, t string, n int")
    assert sorted(migration.merged(a, b, "id").collect()) == [(1, "x", None), (2, "y", 1), (3, "z", 1)]
    bad = spark.createDataFrame([(1, "x", 0)], "id int, t string, n int")
    with pytest.raises(ValueError, match="collision"):
        migration.merged(bad, b, "id")


def test_fingerprint_sees_repeats_and_no_order(spark):
    rows = spark.createDataFrame([(1, "a"), (2, None), (3, "")], "id int, t string")
    mark = lambda df: tuple(migration.fingerprint(df, ["id", "t"]).first())
    assert mark(rows) == mark(rows.orderBy(F.desc("id")))
    assert mark(rows) != mark(rows.unionByName(rows))
    assert mark(rows.where("id = 1")) != mark(rows.where("id = 1").unionByName(rows.where("id = 2")).unionByName(rows.where("id = 2")))
    assert mark(rows.where("id = 2")) != mark(rows.where("id = 2").fillna("", ["t"]))
    assert migration.fingerprint(rows.limit(0), ["id"]).count() == 1


def test_copy_is_staged_and_resumes(spark, tmp_path):
    a, b = spark.range(10).toDF("id"), spark.createDataFrame([(1, [1.0, None])], "id int, v array<double>")
    place = str(tmp_path / "copy")
    assert migration.copied(spark, {"a": a, "b": b}, place) == {"a": 10, "b": 1}
    assert not (tmp_path / "copy" / "staging").exists()
    assert spark.read.parquet(f"{place}/a").count() == 10
    broken = a.select(F.when(F.col("id") == 5, F.raise_error(F.lit("lost"))).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception, match="lost"):
        migration.copied(spark, {"a": a.where("id < 4"), "b": broken}, place)
    assert spark.read.parquet(f"{place}/a").count() == 10  # nothing took its place
    assert list(json.loads((tmp_path / "copy" / "staging" / "state.json").read_text())) == ["a"]
    assert migration.copied(spark, {"a": a.where("id < 4"), "b": b}, place, resume=True) == {"a": 4, "b": 1}
    assert spark.read.parquet(f"{place}/a").count() == 4


def test_workflow_reuses_until_something_ran(spark, tmp_path):
    fails = [True]

    def last(done):
        if fails[0]:
            raise RuntimeError("later")
        return done["two"].where("id > 2")

    def steps(version):
        return [("one", "1", lambda done: spark.range(5).toDF("id")), ("two", version, lambda done: done["one"].select(F.col("id") + 1)
                 .toDF("id")), ("three", "1", last)]

    place = str(tmp_path / "run")
    with pytest.raises(RuntimeError):
        migration.run_workflow(spark, steps("1"), place, {"c": 1})
    assert json.loads((tmp_path / "run" / "run.json").read_text())["status"] == "failed"
    fails[0] = False
    with pytest.raises(ValueError, match="exists"):
        migration.run_workflow(spark, steps("1"), place, {"c": 1})
    with pytest.raises(ValueError, match="other inputs"):
        migration.run_workflow(spark, steps("1"), place, {"c": 2}, resume=True)
    done, ran = migration.run_workflow(spark, steps("1"), place, {"c": 1}, resume=True)
    assert ran == ["three"] and done["three"].count() == 3
    assert migration.run_workflow(spark, steps("1"), place, {"c": 1}, resume=True)[1] == []
    assert migration.run_workflow(spark, steps("2"), place, {"c": 1}, resume=True)[1] == ["two", "three"]
    with pytest.raises(ValueError, match="no run"):
        migration.run_workflow(spark, steps("1"), str(tmp_path / "none"), {}, resume=True)


def test_cached_makes_only_what_is_missing(spark):
    cache = spark.createDataFrame([("a", 100)], "t string, n int")
    rows = spark.createDataFrame([("a",), ("bb",), ("bb",)], "t string")
    out = control.cached(rows, cache, "t", lambda fresh: fresh.select("t", F.length("t").alias("n")))
    assert sorted(out.collect()) == [("a", 100), ("bb", 2)]


def test_unsound_records_stay_as_they_are(spark):
    kinds = ", ".join(f"{g} double" for g in ingestions.GATES)
    rows = [("staged", 1.0, 1.0, 1.0, 1.0, float("nan"), True, True, 1, 1), ("staged", None, 1.0, 1.0, 1.0, 0.0, True, True, 1, 1), ("queued", 1.0, 1.0, 1.0, 1.0, 0.0, True, True, 1, 1), ("staged", 1.0, 1.0, 1.0, 1.0, 0.0, None, True, None, 1), ("evaluated", 1.0, 1.0, 1.0, 1.0, 0.0, True, True, 2, 2)]
    df = spark.createDataFrame(rows, f"status string, {kinds}, unsupported_claim_delta double, source_canary_retrieved boolean, graph_ready boolean, completed_parents int, expected_parents int")
    got = [(r["status"], r["passed"], r["failures"]) for r in ingestions.evaluated(df).collect()]
    assert got == [("staged", None, None), ("staged", None, None), ("queued", None, None), ("evaluated", False, ["graph_ready", "source_canary_retrieved"]), ("evaluated", True, [])]


def test_invalid_submissions(spark):
    sha = "a" * 64
    rows = [(1, "c", "k", sha), (2, "c", "k", "b" * 64), (3, "c", "k", sha), (4, "c", " ", sha), (5, "c", "k" * 201, sha), (6, "c", "q", "A" * 64), (7, None, "k", sha), (8, "d", "k", None)]
    got = {r["request_id"]: (r["record_id"], r["outcome"]) for r in ingestions.submitted(spark.createDataFrame(rows, "request_id int, corpus_key string, idempotency_key string, package_sha256 string")).collect()}
    assert got == {1: (1, "new"), 2: (None, "conflict"), 3: (1, "existing"), **{k: (None, "invalid") for k in (4, 5, 6, 7, 8)}}
