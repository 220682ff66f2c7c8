"""Tables from one store into another: collisions, merges, fingerprints before and after, staged copies, and workflows that resume."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def collisions(source: DataFrame, target: DataFrame, key: str) -> DataFrame:
    """Keys that both tables have with different rows (nulls are equal)."""
    fields = sorted(c for c in source.columns if c != key)
    a, b = source.select(key, F.struct(*fields).alias("a")), target.select(key, F.struct(*fields).alias("b"))
    return a.join(b, key).where(~F.col("a").eqNullSafe(F.col("b"))).select(key).distinct()


def merged(source: DataFrame, target: DataFrame, key: str) -> DataFrame:
    """target and those rows of source whose key it lacks. Raises on collisions."""
    bad = collisions(source, target, key).limit(1).collect()
    if bad:
        raise ValueError(f"identifier collision: {key} = {bad[0][0]!r} has other properties in the target")
    return target.unionByName(source.join(target.select(key), key, "left_anti"))


def fingerprint(table: DataFrame, columns: list[str], by: list[str] | None = None) -> DataFrame:
    """n and a fingerprint of rows in any order, by group: the exclusive or of 60 bits and the sum of 30 bits of each row's hash, so rows that repeat count too."""
    h = F.sha2(F.concat_ws("\x1f", *(F.coalesce(F.col(c).cast("string"), F.lit("\x00")) for c in columns)), 256)
    part = lambda at, n: F.conv(F.substring(h, at, n), 16, 10).cast("long")
    return table.groupBy(*(by or [])).agg(F.count("*").alias("n"), F.bit_xor(part(1, 15)).alias("mixed"), F.sum(part(16, 7)).alias("summed"))


def invalid_keys(table: DataFrame, key: str) -> DataFrame:
    """key and n of rows that break a uniqueness constraint: null keys, and keys of several rows."""
    return table.groupBy(key).agg(F.count("*").alias("n")).where((F.col("n") > 1) | F.col(key).isNull())


def _fs(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def _get(spark: SparkSession, path: str) -> dict | None:
    fs, at = _fs(spark, path)
    if not fs.exists(at):
        return None
    text = spark.read.text(path, wholetext=True).first()
    return json.loads(text[0]) if text else None


def _put(spark: SparkSession, path: str, value: dict) -> None:
    """Writes beside the place and renames, so that a reader sees the old value or the new one, or for a moment none."""
    fs, at = _fs(spark, path)
    _, new = _fs(spark, path + ".tmp")
    out = fs.create(new, True)
    out.write(bytearray(json.dumps(value, sort_keys=True).encode()))
    out.close()
    fs.delete(at, False)
    if not fs.rename(new, at):
        raise OSError(f"cannot write {path}")


def copied(spark: SparkSession, tables: dict[str, DataFrame], folder: str, *, resume: bool = False) -> dict[str, int]:
    """Copies tables below folder by way of folder/staging and gives their row counts. Each is read back and compared by fingerprint; only when all agree they take their places.

    resume: tables that an earlier run has staged and that still agree are not written again. A table that does not agree raises, and nothing takes its place.
    """
    fs, staging = _fs(spark, f"{folder}/staging")
    if not resume:
        fs.delete(staging, True)
    state = _get(spark, f"{folder}/staging/state.json") or {}
    for name, table in sorted(tables.items()):
        path = f"{folder}/staging/{name}"
        want = fingerprint(table, table.columns).first().asDict()
        if state.get(name) != want:
            table.write.mode("overwrite").parquet(path)
            if fingerprint(spark.read.schema(table.schema).parquet(path), table.columns).first().asDict() != want:
                raise ValueError(f"{name}: the copy differs from its source")
            state[name] = want
            _put(spark, f"{folder}/staging/state.json", state)
    for name in sorted(tables):
        _, place = _fs(spark, f"{folder}/{name}")
        fs.delete(place, True)
        fs.rename(_fs(spark, f"{folder}/staging/{name}")[1], place)
    fs.delete(staging, True)
    return {name: state[name]["n"] for name in tables}


def digest(value: object) -> str:
    return hashlib.sha256(json.dumps(value, sort_keys=True, separators=(",", ":"), default=str).encode()).hexdigest()


Step = tuple[str, str, Callable[[dict[str, DataFrame]], DataFrame]]


def run_workflow(spark: SparkSession, steps: list[Step], folder: str, inputs: dict, *, resume: bool = False) -> tuple[dict[str, DataFrame], list[str]]:
    """Results of steps (name, version, function of earlier results) and the names of those that ran. Each result is a table below folder.

    With resume, a completed step of the same version and inputs is reused as long as every earlier one was. Without it, the folder must hold no run; with it,
    a run of the same inputs. A step that fails leaves those before it complete.
    """
    path, mark = f"{folder}/run.json", digest(inputs)
    run = _get(spark, path)
    if (run is not None) != resume or (run and run["inputs"] != mark):
        raise ValueError("no run to resume" if run is None else "the run exists" if not resume else "the run has other inputs")
    _put(spark, path, {"inputs": mark, "status": "running"})
    done: dict[str, DataFrame] = {}
    ran: list[str] = []
    for name, version, step in steps:
        note, place = f"{folder}/steps/{name}.json", f"{folder}/tables/{name}"
        wanted = {"version": version, "after": digest([mark, *done])}
        prior = _get(spark, note)
        if not resume or ran or prior != wanted:
            ran.append(name)
            fs, at = _fs(spark, note)
            fs.delete(at, False)
            try:
                step(done).write.mode("overwrite").parquet(place)
            except Exception as e:
                _put(spark, path, {"inputs": mark, "status": "failed", "error": type(e).__name__})
                raise
            _put(spark, note, wanted)
        done[name] = spark.read.parquet(place)
    _put(spark, path, {"inputs": mark, "status": "completed"})
    return done, ran
