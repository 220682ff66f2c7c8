"""Exact nearest records: odd vectors, ties, many blocks, and no pair of rows in Spark's joins."""

import math
import random

import pytest

from strataloom.operators import consolidation, nearest, retrieval, search


def brute(queries, records, k, measure):
    def key(q, r):
        void = q is None or r is None or None in q or None in r
        if measure == "squared":
            return None if void or len(q) != len(r) else round(sum((a - b) * (a - b) for a, b in zip(q, r, strict=True)), 6)
        unit = lambda v: math.sqrt(sum(x * x for x in v))
        if void or unit(q) * unit(r) == 0:
            return 0.0
        return None if len(q) != len(r) else round(sum(a * b for a, b in zip(q, r, strict=True)) / (unit(q) * unit(r)), 6)

    place = lambda v: (v is not None, v or 0.0) if measure == "squared" else (v is None, -(v or 0.0))
    out = []
    for i, q in queries:
        met = sorted(((key(q, r), j) for j, r in records if j != i), key=lambda x: (place(x[0]), x[1]))
        out += [(i, j, None if v is None else round(v + 0.0, 6), n + 1) for n, (v, j) in enumerate(met[:k])]
    return sorted(out)


@pytest.fixture
def rows():
    rng = random.Random(3)
    vec = lambda: [rng.gauss(0, 1) for _ in range(5)]
    same = vec()
    rows = [(i, same if 40 <= i < 80 else vec()) for i in range(120)]
    return rows + [(200, None), (201, [0.0] * 5), (202, [1.0, None, 0.0, 0.0, 0.0]), (203, [1.0, 2.0]), (204, []), (205, [1e200] * 5)]


@pytest.mark.parametrize("most", [1000, 9])
@pytest.mark.parametrize("measure", ["cosine", "squared"])
def test_as_compared_one_by_one(spark, monkeypatch, rows, measure, most):
    monkeypatch.setattr(nearest, "PAIRS", 500)
    records = spark.createDataFrame(rows, "id long, vector array<double>")
    queries = records.withColumnRenamed("id", "query_id")
    finite = [r for r in rows if r[0] != 205]
    if measure == "cosine":
        got = retrieval.vector_top_k(queries.where("query_id <> 205"), records.where("id <> 205"), 7, most).select("query_id", "id", "score", "rank")
    else:
        got = search.nearest(queries.where("query_id <> 205"), records.where("id <> 205"), 7).select("query_id", "id", "distance", "rank")
    assert sorted((q, i, v if v is None else round(v, 6), n) for q, i, v, n in map(tuple, got.collect())) == brute(finite, finite, 7, measure)
    assert nearest.nearest(queries, records, 3, measure).where("id = 205").count() >= 0


def test_tiles_keep_the_first_of_equal_records(rows):
    """Later blocks of records bring better and equal ones: both are dealt with as in one block."""
    import pyarrow as pa

    t = lambda xs, name: pa.table({name: pa.array([i for i, _ in xs]), "vector": pa.array([v for _, v in xs], pa.list_(pa.float64()))})
    own, tile = rows[:-1], nearest.TILE
    for measure in ("cosine", "squared"):
        got = []
        for nearest.TILE in ((4, 16), tile):
            cells = nearest._cell(t(own, "id"), t(own, "id"), 6, measure)
            got.append(sorted((x["query_id"], x["id"], str(x["value"])) for b in cells for x in b.to_pylist()))
        assert got[0] == got[1]


def test_no_join_over_pairs(spark, rows):
    records = spark.createDataFrame(rows[:120], "id long, vector array<double>")
    queries = records.withColumnRenamed("id", "query_id")
    for df in (retrieval.vector_top_k(queries, records, 5), search.nearest(queries, records, 5), consolidation.similar_pairs(records, records, 0.3, 5)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "NestedLoop" not in plan and "Cartesian" not in plan
