"""Input columns with the names of results are replaced, others pass through; null ids and repeated rows keep their rows."""

from collections import Counter

from strataloom.llm import langid, pst, toxicity

SCHEMA = "doc_id long, text string, score string, lang_pred int, n_tokens string, base_score string, extra string"
ROWS = [(1, "a b c", "s", 1, "n", "b", "e"), (1, "a b c", "s", 1, "n", "b", "e"), (None, "a b", None, None, None, None, None), (2, None, "s", 2, "n", "b", "e"), (3, "", "s", 2, "n", "b", "e")]


def _same_rows(df, names):
    assert len(df.columns) == len(set(df.columns)) and set(names) <= set(df.columns)
    rows = df.select("doc_id", "extra", *names).collect()
    assert Counter((r["doc_id"], r["extra"]) for r in rows) == Counter((r[0], r[-1]) for r in ROWS)
    return rows


def test_suffix_tree(spark):
    docs = spark.createDataFrame(ROWS, SCHEMA)
    rows = _same_rows(pst.score(docs, pst.fit(docs.select("text"), depth=1)), ["n_tokens", "n_known", "train_tokens", "base_score", "score"])
    assert {r["doc_id"]: r["n_tokens"] for r in rows} == {1: 4, None: 3, 2: 1, 3: 1}


def test_language(spark):
    rows = _same_rows(langid.identify(spark.createDataFrame(ROWS, SCHEMA), langid.Network([], hidden=2, window=5, seed=1)), ["lang_pred", "score"])
    assert {r["lang_pred"] for r in rows} == {"und"}


def test_toxicity(spark):
    rows = _same_rows(toxicity.toxicity(spark.createDataFrame(ROWS, SCHEMA), toxicity.fit([])), ["score", "predicted"])
    assert {r["score"] for r in rows} == {0.0}
