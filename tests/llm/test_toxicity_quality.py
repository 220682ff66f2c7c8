"""Quality on the labelled tables' held-out rows, and the drawing of the sample."""

from collections import Counter

import numpy as np

from strataloom.llm import queries, toxicity


def test_held_out_quality(spark):
    """Rows whose remainder is 0 took no part in dictionaries, calibration or settings."""
    sf = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    model = queries.toxicity_model(spark, sf, docs)
    labels = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "toxic")
    held = docs.join(labels, "doc_id").where(queries.bucket("doc_id", 5) == 0)
    got = toxicity.toxicity(held, model).select("toxic", "score", "predicted").toPandas()
    order = got["score"].rank().to_numpy()
    y = got["toxic"].to_numpy() == 1
    auc = (order[y].sum() - y.sum() * (y.sum() + 1) / 2) / (y.sum() * (~y).sum())
    hit = got["predicted"].to_numpy() == 1
    print("held out", len(y), y.sum(), "auc", auc, "precision", (hit & y).sum(), hit.sum())
    assert auc > 0.85 and (hit & y).sum() > 0.6 * hit.sum() and (hit & y).sum() > 0.5 * y.sum()


def test_sample_is_of_distinct_whole_rows(spark):
    rows = [(k, f"text {k % 50} " + "x" * (k % 50)) for k in range(3000)] + [(None, "text without id"), (5000, None), (5001, "y" * 300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    labels = spark.createDataFrame([(k, (k % 50) % 2) for k in range(3000)] + [(5000, 1), (5001, 1), (None, 1), (7, None)], "doc_id long, toxic int")
    got, weight = toxicity.sample(docs, labels, chars=100)
    assert Counter(y for _, y in got) == {0: 25, 1: 26} and weight == 1.0
    assert {t for t, _ in got} == {f"text {k} " + "x" * k for k in range(50)} | {"y" * 100}
    few, _ = toxicity.sample(docs, labels, per_label=5)
    assert max(Counter(y for _, y in few).values()) <= 5
    assert toxicity.sample(docs.limit(0), labels) == ([], 1.0)
    assert np.isfinite(toxicity.fit(got).score("text 1"))
