"""Bottom-up reports, GraphML as a file, and answers as JSON."""

import xml.etree.ElementTree as ET

from pyspark.sql import functions as F

from strataloom.functions.storage import materialize
from strataloom.operators import communities, extraction


def test_reports_see_the_findings_below(spark):
    members = spark.createDataFrame([(0, n, "a", None) for n in (1, 2, 3)] + [(0, 4, "b", None), (1, 1, "a/1", "a"), (1, 2, "a/1", "a"), (1, 3, "a/3", "a")], "level int, node int, label string, parent string")
    evidence = communities.report_evidence(members, spark.createDataFrame([(1, 10), (3, 30)], "node int, parent_id int"), spark.createDataFrame([(1, 2, 12), (2, 3, 23)], "source int, target int, parent_id int"))

    def reporter(rows):
        own = F.array(F.concat("label", F.lit(": "), F.array_join(F.coalesce("evidence", F.array().cast("array<int>")), ",")))
        return rows.select("level", "label", F.concat_ws(" ", "label", "n").alias("summary"), F.concat(own, F.coalesce("below", F.array().cast("array<string>"))).alias("findings"))

    got = {r["label"]: (r["level"], r["summary"], r["findings"]) for r in communities.reports(members, evidence, reporter, materialize).collect()}
    assert got == {
        "a": (0, "a 3", ["a: 10,12,23,30", "a/1: 10,12", "a/3: 30"]), "b": (0, "b 1", ["b: "]), "a/1": (1, "a/1 2", ["a/1: 10,12"]), "a/3": (1, "a/3 1", ["a/3: 30"]),
    }
    assert communities.reports(members.limit(0), evidence.limit(0), reporter, materialize).count() == 0


def test_graphml_is_one_document(spark, tmp_path):
    nodes = spark.createDataFrame([("a<&>\"\x01", None), ("b", "T"), (None, "T")], "id string, type string")
    edges = spark.createDataFrame([("b", "a", "R"), ("b", "a", "R")], "source string, target string, type string")
    extraction.graphml(nodes, edges).sort("section").select("line").write.text(str(tmp_path / "g"))
    text = "".join(p.read_text() for p in sorted((tmp_path / "g").glob("part-*")))
    graph = ET.fromstring(text.encode())
    assert sorted(n.get("id") for n in graph.iter("{http://graphml.graphdrawing.org/xmlns}node")) == ["", 'a<&>"', "b"]
    assert len(list(graph.iter("{http://graphml.graphdrawing.org/xmlns}edge"))) == 2


def test_json_answers(spark):
    cases = [("```json\n{\"a\": 1}\n```", '{"a": 1}'), ("```\n{}\n```", "{}"), ('x {"a": {"b": 2}} y', '{"a": {"b": 2}}'), ("[{}]", None), ("7", None), ("{no", None), ("", None), (None, None), ('  {"a": 1}  ', '{"a": 1}')]
    rows = spark.createDataFrame([(k, c[0]) for k, c in enumerate(cases)], "k int, t string").select("k", extraction.json_object(F.col("t")).alias("o"))
    assert {r["k"]: r["o"] for r in rows.collect()} == {k: c[1] for k, c in enumerate(cases)}


def test_provisional_graph_of_little(spark):
    docs = spark.createDataFrame([(1, "Ann met Bob. Bob met Ann!\nCy alone"), (2, None), (3, "")], "document_id int, text string")
    terms = spark.createDataFrame([(1, "Ann"), (1, "Bob"), (1, "Cy"), (1, "ANN")], "document_id int, term string")
    assert [tuple(r) for r in extraction.provisional_graph(docs, terms).collect()] == [(1, "ann", "bob", 2)]
    assert extraction.provisional_graph(docs.limit(0), terms).count() == 0
