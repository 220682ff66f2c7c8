"""Terms and pairs of documents whose id repeats, in their own rows: nothing is grouped per token or sentence."""

from strataloom.operators import extraction, ingest


def test_repeated_ids_are_one_document(spark):
    docs = spark.createDataFrame([(1, "Zeta said hello there."), (1, "hello Zeta. 12345 12345"), (2, "nothing-x Nothing-x --abcde"), (3, None), (None, "Yak other other. Yak other")], "document_id long, text string")
    terms = ingest.provisional_terms(docs, ratio=1.0)
    assert sorted(map(tuple, terms.where("document_id IS NOT NULL").collect())) == [(1, "Zeta", 1), (1, "hello", 1), (2, "Nothing-x", 2), (2, "nothing-x", 2)]
    assert sorted(r["term"] for r in terms.where("document_id IS NULL").collect()) == ["Yak", "other"]
    graph = extraction.provisional_graph(docs, terms)
    assert [tuple(r) for r in graph.collect()] == [(1, "hello", "zeta", 2)]


def test_no_row_per_sentence_or_token(spark):
    docs = spark.createDataFrame([(1, "Ann met Bob. Ann left.")], "document_id long, text string")
    terms = ingest.provisional_terms(docs, ratio=1.0)
    rows = lambda df: df._jdf.queryExecution().optimizedPlan().toString().count("Generate")
    assert rows(terms) == 1  # of terms
    assert rows(extraction.provisional_graph(docs, terms)) == 1
