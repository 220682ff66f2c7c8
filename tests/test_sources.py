"""Files, sinks and streams on small tables."""

import gzip
import json
import uuid

from pyspark.sql import functions as F

from strataloom.functions import text as T
from strataloom.operators import entities, ingest
from strataloom.sources import files
from strataloom.streaming import sync


def test_discover(spark, tmp_path):
    for name, body in {"a.txt": b"one\n", "in/b.MD": b"# two", "empty.txt": b"", ".hid/c.txt": b"x", "~$d.txt": b"x", "e.exe": b"x", "node_modules/f.txt": b"x", "bad.txt": b"\xff!"}.items():
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_bytes(body)
    found = files.discover(spark, str(tmp_path))
    assert sorted(r["source_id"] for r in found.collect()) == ["a.txt", "bad.txt", "in/b.MD"]
    assert {(r["document_id"], r["text"], r["valid"]) for r in files.texts(found).collect()} == {("a.txt", "one\n", True), ("in/b.MD", "# two", True), ("bad.txt", "�!", False)}


def test_tab_separated(spark, tmp_path):
    (tmp_path / "x.tsv.gz").write_bytes(gzip.compress(b'k\tv\n1\t"a\n2\t\\N\n'))
    assert [tuple(r) for r in files.tab_separated(spark, str(tmp_path / "x.tsv.gz"), "k int, v string").collect()] == [(1, '"a'), (2, None)]


def test_export(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, None)], "id int, v string")
    first = {r["name"]: tuple(r) for r in files.export({"t": df, "none": df.limit(0)}, str(tmp_path / "x")).collect()}
    again = {r["name"]: tuple(r) for r in files.export({"t": df.orderBy(F.desc("id"))}, str(tmp_path / "y")).collect()}
    assert first["t"] == again["t"] and first["t"][1] == 2 and first["none"][1:] == (0, 0)


def test_upsert(spark):
    old, new = (spark.createDataFrame(x, "k int, v string") for x in ([(1, "a"), (2, "b")], [(2, "c"), (3, "d")]))
    assert sorted(map(tuple, files.upsert(old, new, "k").collect())) == [(1, "a"), (2, "c"), (3, "d")]


def test_sync_stream(spark, tmp_path):
    (tmp_path / "drop").mkdir()

    def put(name, rows):
        (tmp_path / "drop" / name).write_text("\n".join(json.dumps(dict(zip(("source_id", "checksum", "text"), r, strict=True))) for r in rows))
        sync.sync_stream(spark, str(tmp_path / "drop"), str(tmp_path / "state"), str(tmp_path / "cp")).awaitTermination()

    put("1.json", [("a", "1", "x"), ("b", "1", "y"), ("a", "2", "z")])
    put("2.json", [("a", "2", "z"), ("b", "9", "n"), ("c", "1", "c")])
    assert sorted(map(tuple, spark.read.parquet(str(tmp_path / "state/manifest/v2")).select("source_id", "checksum").collect())) == [("a", "2"), ("b", "9"), ("c", "1")]
    assert {tuple(r) for r in spark.read.parquet(str(tmp_path / "state/changes/batch=1")).collect()} == {("a", "unchanged"), ("b", "updated"), ("c", "added")}


def test_windowed_usage(spark):
    rows = spark.sql("SELECT * FROM VALUES (1, TIMESTAMP'2024-01-01 00:10', 'x', 1.0D), (1, TIMESTAMP'2024-01-01 00:10', 'x', 1.0D), (2, TIMESTAMP'2024-01-01 00:50', 'x', 2.0D), (3, TIMESTAMP'2024-01-01 01:00', 'x', 4.0D) AS t(event_id, ts, event_type, value)")
    assert sorted((r["start"].hour, r["n"], r["total"]) for r in sync.windowed_usage(rows).collect()) == [(0, 2, 3.0), (1, 1, 4.0)]


def test_expressions(spark):
    row = spark.range(1).select(
        T.uuid5(F.lit(str(uuid.NAMESPACE_URL)), F.lit("é")).alias("u"), T.corpus_key(F.lit(" My__Corpus-x_ ")).alias("k"), T.canonical_uri(F.lit("HTTP://x")).alias("other"),
        T.canonical_uri(F.lit("https://www.YouTube.com/watch?a=1&v=abcdefghijk&t=3#x")).alias("video"), T.canonical_uri(F.lit("http://WWW.Ex.org/a//?q=1#f")).alias("uri"),
        F.array(*(T.lemma(F.lit(x)) for x in ("Big Boxes", "two cities", "glass", "cats", ""))).alias("l"),
        T.cited(F.lit("a [S2] b [S9] [S2]"), F.array(F.lit("S1")), F.array(F.lit("S1"), F.lit("S2"))).alias("c"),
        T.valid_vector(F.array(F.lit(1.0), F.lit(float("nan"))), 2).alias("nan"), T.valid_vector(F.lit(None).cast("array<double>"), 2).alias("null"),
    ).first()
    assert row["u"] == str(uuid.uuid5(uuid.NAMESPACE_URL, "é")) and row["k"] == "my-corpus-x"
    assert row["video"] == "https://www.youtube.com/watch?v=abcdefghijk" and row["uri"] == "http://ex.org/a?q=1" and row["other"] == "http://x/"
    assert row["l"] == ["big box", "two city", "glass", "cat", ""] and row["c"] == ["S1", "S2"] and not row["nan"] and not row["null"]


def test_duplicate_anchors(spark):
    names = ["widget", "widgot", "wdgett", "widge", "bolt", "bo", "big bolt", "Widgets", "gasket", "gaskt", "xgaske", None]
    rows = [(i, "t", n) for i, n in enumerate(names)] + [(90, "u", "widget")]

    def near(a, b):
        d = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            last, d[0] = d[0], i
            for j, y in enumerate(b, 1):
                last, d[j] = d[j], min(d[j] + 1, d[j - 1] + 1, last + (x != y))
        return d[-1] < 3

    like = lambda a, b: (len(b) > 2 and b in a) or (len(a) > 2 and a in b) or (len(a) > 5 and near(a, b))
    want = {i for i, t, a in rows for j, u, b in rows if i < j and t == u and a and b and like(a.lower(), b.lower())}
    assert {r["id"] for r in entities.duplicate_anchors(spark.createDataFrame(rows, "id int, label string, name string")).collect()} == want


def test_contained(spark):
    docs = spark.createDataFrame([(1, "The quick, brown fox jumps over it."), (2, None), (3, "")], "document_id int, text string")
    items = spark.createDataFrame([(1, "quick brown"), (2, "FOX jumps over it"), (3, "brown jumps"), (4, None), (5, "the quick brown fox jumps over it"), (6, "own fox")], "item_id int, text string")
    assert {tuple(r) for r in ingest.contained(items, docs).collect()} == {(1, 1), (2, 1), (5, 1)}


def test_windows(spark):
    docs = spark.createDataFrame([(n, " ".join(map(str, range(n)))) for n in (0, 1, 10, 11, 19)] + [(99, None)], "document_id int, text string")
    got = {(r["document_id"], r["position"]): r["text"].split() for r in ingest.windows(docs, 10, 8).collect()}
    assert {k: len(v) for k, v in got.items()} == {(1, 0): 1, (10, 0): 10, (11, 0): 10, (11, 1): 3, (19, 0): 10, (19, 1): 10, (19, 2): 3}
