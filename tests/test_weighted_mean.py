"""Weighted mean vectors and lemma groups: what stands for a parent, and what is an error."""

import math

import pytest

from strataloom.operators.entities import lemma_groups
from strataloom.operators.graph import weighted_mean

SCHEMA = "parent_id string, position int, text string, vector array<double>, weight int"


def test_first_of_equal_texts_and_weights(spark):
    rows = [("p", 0, "Same text.", [1.0, 0.0], 3), ("p", 1, "same  TEXT", [9.0, 9.0], 9), ("p", 2, "other", [0.0, 1.0], None), ("q", 0, "x", None, 1), ("q", 1, "X", [1.0, 0.0], 1)]
    got = {(r["parent_id"], r["dim"]): r["value"] for r in weighted_mean(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {("p", 0): pytest.approx(3 / math.sqrt(10), abs=1e-6), ("p", 1): pytest.approx(1 / math.sqrt(10), abs=1e-6)}


@pytest.mark.parametrize(("rows", "error"), [([("p", 0, "a", [1.0, 0.0], 1), ("p", 1, "b", [1.0], 1)], "dimension"), ([("p", 0, "a", [1.0], 1), ("p", 1, "b", [-1.0], 1)], "length zero")])
def test_errors(spark, rows, error):
    with pytest.raises(Exception, match=error):
        weighted_mean(spark.createDataFrame(rows, SCHEMA)).collect()


def test_established_entity_is_the_target(spark):
    rows = [(1, "Markets", True), (2, "market", False), (3, "Stock", False), (4, "stocks", False), (5, "bond", True), (6, "Bonds", True)]
    got = {tuple(r) for r in lemma_groups(spark.createDataFrame(rows, "id int, name string, in_scope boolean")).select("canonical", "members", "target").collect()}
    assert got == {("market", 2, 2), ("bond", 2, 5)}
