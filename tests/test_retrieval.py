"""Rankings beyond one block of queries."""

import random

from strataloom.operators import retrieval


def test_queries_beyond_one_block(spark):
    rng = random.Random(1)
    records = spark.createDataFrame([(i, [rng.gauss(0, 1) for _ in range(4)]) for i in range(30)], "id long, vector array<double>")
    queries = records.withColumnRenamed("id", "query_id")
    rows = lambda df: sorted(map(tuple, df.collect()))
    whole = rows(retrieval.vector_top_k(queries, records, 5))
    assert len(whole) == 30 * 5
    assert rows(retrieval.vector_top_k(queries, records, 5, max_queries=7)) == whole
