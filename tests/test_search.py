"""Search requests, scope errors, the walk under caps, and names against plain Python."""

import random

import pytest
from pyspark.sql import functions as F

from strataloom.functions import names as N
from strataloom.operators import consolidation as C
from strataloom.operators import search as S


def test_requests():
    assert S.SearchRequest("a").top_k == 12
    for bad in ({"query": " "}, {"query": "a", "mode": "x"}, {"query": "a", "top_k": 0}, {"query": "a", "top_k": 51}, {"query": "a", "hops": 3}):
        with pytest.raises(ValueError):
            S.SearchRequest(**bad)


def test_fingerprint_guard(spark):
    units = spark.createDataFrame([(1, "f1"), (2, "f2")], "id int, embedding_fingerprint string")
    assert S.same_fingerprint(units.where("id = 1"), "f1").count() == 1
    with pytest.raises(Exception, match="fingerprint is f2"):
        S.same_fingerprint(units, "f1").collect()


def test_caps_as_walked_one_by_one(spark):
    rng = random.Random(2)
    rows = sorted({(rng.randrange(2), rng.randrange(60), rng.randrange(3), rng.randrange(20), f"e{rng.randrange(8)}") for _ in range(400)})
    rows = [(q, p, p % 7, o, r, hop) for q, p, hop, o, r in rows]
    got = S.capped(spark.createDataFrame(rows, "query_id int, parent_id int, document_id int, origin int, reached string, hop int"), limit=30)
    want = []
    for q in (0, 1):
        entities, documents, kept = {}, {}, []
        for _, p, d, o, r, hop in sorted((x for x in rows if x[0] == q), key=lambda x: (x[5], x[1], x[3], x[4]))[:150]:
            if entities.get(r, 0) >= 5 or documents.get(d, 0) >= 10 or p in [k[1] for k in kept]:
                continue
            kept.append((q, p, d, r, hop, len(kept) + 1))
            entities[r], documents[d] = entities.get(r, 0) + 1, documents.get(d, 0) + 1
            if len(kept) == 30:
                break
        want += kept
    assert sorted(map(tuple, got.collect())) == sorted(want)


@pytest.mark.parametrize(("a", "b", "alike"), [("P&L", "P L", True), ("NYSE", "New York Stock Exchange", True), ("Big Cat", "cat big", True), ("cat", "the cat sat", True), ("dog", "cat", False), ("", "x", False), (None, "x", False)])
def test_alias_like(spark, a, b, alike):
    row = spark.createDataFrame([(a, b)], "a string, b string").select(N.alias_like(F.col("a"), F.col("b")).alias("x"), N.shorter_name(F.col("a"), F.col("b")).alias("n")).first()
    assert bool(row["x"]) == alike
    assert row["n"] == (min((x for x in (a, b) if x), key=len, default="") if a and b else a or b or "")


def test_merges_touch_a_node_once(spark):
    pairs = spark.createDataFrame([(1, 2, 1, 0.9), (2, 3, 1, 0.95), (4, 5, 0, 0.99), (3, 6, 0, 0.8), (7, 8, 0, 0.7)], "a int, b int, priority int, score double")
    assert C.greedy_merges(pairs, 3) == [(2, 3), (4, 5), (7, 8)]


def test_dates_uuids_deltas(spark):
    row = spark.createDataFrame([("2024-01-02", "", "id 0B5E4A0E-1111-2222-3333-444455556666 and 0b5e4a0e-1111-2222-3333-444455556666", "")], "a string, b string, u string, e string")
    got = row.select(N.date_span(F.col("a"), F.col("b")).alias("d"), N.uuids(F.col("u")).alias("u"), N.deltas(F.col("e")).alias("e"), N.date_span(F.lit("2024-02-01"), F.lit("2024-01-01")).alias("r"), N.date_span(F.lit("soon"), F.lit(None).cast("string")).alias("s")).first()
    assert got["d"]["valid"] and got["d"]["end"] is None and got["u"] == ["0b5e4a0e-1111-2222-3333-444455556666"] and got["e"] == []
    assert not got["r"]["valid"] and not got["s"]["valid"]
