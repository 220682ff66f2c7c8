"""The first round of label propagation joins nothing, and rounds give the labels of a walk in plain Python."""

import random

from strataloom.operators import communities


def test_rounds_as_in_plain_python(spark):
    rng = random.Random(4)
    edges = [(rng.randrange(30), rng.randrange(30), rng.randrange(1, 4)) for _ in range(60)]
    table = spark.createDataFrame(edges, "source long, target long, weight long")
    nodes = spark.range(33).withColumnRenamed("id", "node")
    both = {}
    for a, b, w in edges:
        if a != b:
            both[a, b], both[b, a] = both.get((a, b), 0) + w, both.get((b, a), 0) + w
    for a in {a for a, _ in both}:
        both[a, a] = max(w for (x, y), w in both.items() if x == a and y != a)
    label = {n: n for n in range(33)}
    for rounds in range(3):
        assert dict(map(tuple, communities.propagate(nodes, table, rounds).collect())) == label
        votes = {}
        for (a, b), w in both.items():
            votes.setdefault(a, {}).setdefault(label[b], 0)
            votes[a][label[b]] += w
        label |= {a: min((-w, x) for x, w in v.items())[1] for a, v in votes.items()}


def test_first_round_joins_no_edges(spark):
    table = spark.createDataFrame([(1, 2, 1)], "source long, target long, weight long")
    plan = communities.propagate(spark.range(3).withColumnRenamed("id", "node"), table, 1)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join ") == 1  # of nodes and their labels
