"""The pipeline's stages against plain versions, and the SQL of op1."""

from pathlib import Path

import duckdb

import corpus_pipeline
from strataloom.llm import queries as q

from .test_contracts import components, shingle_set


def test_stages(spark, sf_dir, docs_pdf):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    steps = {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = corpus_pipeline.materialize(stage(spark, before, sf_dir), name)
        steps[name] = ({r["doc_id"]: r["text"] for r in before.select("doc_id", "text").collect()}, docs)
        if name != "packing":
            assert docs.columns == corpus_pipeline.COLUMNS
    texts, out = steps["near_duplicates"]
    want = components({d: shingle_set(t, 5) for d, t in texts.items()})
    assert {r["doc_id"] for r in out.collect()} == {d for d in texts if want[d] == d}
    texts, out = steps["line_dedup"]
    kept = {r["doc_id"]: r["text"] for r in out.collect()}
    assert all((t or "").strip() == "" or kept[d].strip() for d, t in texts.items() if d in kept)
    texts, out = steps["decontamination"]
    bench = q.decontam.decontaminate(out, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    long = [r for r in bench.collect() if any(s["end"] - s["start"] >= 13 for s in r["spans"])]
    assert not long
    texts, out = steps["packing"]
    assert {r["doc_id"] for r in out.collect()} == set(texts)


def test_one_row_of_each_group_of_copies(spark, tmp_path):
    text = " ".join(f"w{k}" for k in range(100))
    rows = [(7, text), (7, text), (7, text + " more"), (9, text), (None, text + " less"), (None, "lone " * 3 + text[:60]), (None, "lone " * 3 + text[:60]), (7, "other words of the same id"), (3, ""), (3, ""), (4, ""), (None, None), (None, None)]
    docs = spark.createDataFrame([(d, t, "en", "s", len(t or "")) for d, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    docs.repartition(3).write.parquet(f"{tmp_path}/docs")
    got = [(r["doc_id"], r["text"]) for r in corpus_pipeline.drop_copies(spark, spark.read.parquet(f"{tmp_path}/docs"), str(tmp_path)).collect()]
    assert [d for d, t in got if t and t.startswith("w0")] == [7]
    rest = [(d, t) for d, t in got if not (t and t.startswith("w0"))]
    assert sorted(rest, key=str) == sorted([(None, "lone " * 3 + text[:60]), (7, "other words of the same id"), (3, ""), (4, ""), (None, None), (None, None)], key=str)


def test_run_on_empty_tables(spark, empty_dir):
    assert corpus_pipeline.run(spark, empty_dir).count() == 0


def test_line_sql(spark):
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for p in Path(sf).glob("*.parquet"):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM read_parquet('{p}')")
    for name, sql in q.ORACLE_SQL.items():
        df = q.QUERIES[name](spark, sf)
        c = con.execute(sql)
        assert df.columns == [x[0] for x in c.description]
        assert sorted(map(tuple, df.collect())) == sorted(c.fetchall())


def test_benchmark_is_cut_in_one_python_pass(spark, tmp_path):
    item = " ".join(f"q{k}" for k in range(13))
    long = " ".join(f"w{k}" for k in range(600))
    texts = [f"{long}, ({item.upper()}) é {item}; end", f"{item}! {long}", f"{long} -- {item}", long, item, "", None]
    docs = spark.createDataFrame([(k, t, "en", "s", len(t or "")) for k, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long").coalesce(1)
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    out = corpus_pipeline.drop_benchmark(spark, docs, str(tmp_path))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1 and "EvalPython" not in plan  # each further node is one more Python process a task
    got = {r["doc_id"]: r["text"] for r in out.collect()}
    assert got == {0: f"{long}, () é ; end", 1: f"! {long}", 2: f"{long} -- ", 3: long, 5: "", 6: None}
    assert {r["doc_id"]: r["n_chars"] for r in out.collect()} == {d: len(t or "") for d, t in got.items()}
