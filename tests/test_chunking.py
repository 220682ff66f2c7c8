"""Markdown blocks, hierarchical chunks, and hierarchies of communities."""

import itertools

from strataloom.operators import chunking, communities
from strataloom.sources import markdown

NOTES = """---
title: "Research Notes"
---
# Top

First paragraph
goes on.

- one
- two

## Under
> said

| a | b |
|---|:-:|
| 1 | 2 |

~~~py
# no heading

~~~
# Next
End"""


def test_markdown(spark):
    docs = spark.createDataFrame([("x/n.md", NOTES, 1), ("x/plain.md", "just text", 2), (None, None, 3), ("e", "  \n", 4), ("open", "```\nnever closed", 5)], "document_id string, text string, title int")
    got = {}
    for r in markdown.markdown_blocks(docs).orderBy("ordinal").collect():
        got.setdefault(r.document_id, []).append((r.title, r.block_type, r.section_path, r.text))
    assert set(got) == {"x/n.md", "x/plain.md", "open"}
    assert {t for t, *_ in got["x/n.md"]} == {"Research Notes"}
    assert [x[1:] for x in got["x/n.md"]] == [
        ("heading", ["Top"], "Top"),
        ("paragraph", ["Top"], "First paragraph\ngoes on."),
        ("list", ["Top"], "- one\n- two"),
        ("heading", ["Top", "Under"], "Under"),
        ("quote", ["Top", "Under"], "> said"),
        ("table", ["Top", "Under"], "| a | b |\n|---|:-:|\n| 1 | 2 |"),
        ("code", ["Top", "Under"], "~~~py\n# no heading\n\n~~~"),
        ("heading", ["Next"], "Next"),
        ("paragraph", ["Next"], "End"),
    ]
    assert got["x/plain.md"] == [("plain", "paragraph", [], "just text")]
    assert got["open"][0][1] == "code"


def _chunks(spark, *blocks):
    rows = [("d", i, k, s, t) for i, (k, s, t) in enumerate(blocks)]
    df = spark.createDataFrame(rows, "document_id string, ordinal int, block_type string, section_path array<string>, text string")
    return chunking.hierarchical_chunks(df).orderBy("position").collect()


def test_long_paragraph_overlaps(spark):
    words = [f"w{i}" for i in range(500)]
    got = _chunks(spark, ("paragraph", [], " ".join(words)))
    assert [r.text.split()[0] for r in got] == ["w0", "w168", "w336"]
    assert all(r.n_tokens <= 220 for r in got) and got[-1].text.endswith("w499")
    assert {r.parent for r in got} == {0} and got[0].parent_tokens == 500


def test_table_parts_repeat_their_header(spark):
    table = "| name | value |\n|---|---|\n" + "\n".join(f"| row{i} | x y z |" for i in range(100))
    got = _chunks(spark, ("table", [], table))
    assert len(got) > 2
    assert all(r.text.startswith("| name | value |\n|---|---|\n") and r.n_tokens <= 220 for r in got)
    assert [x for r in got for x in r.text.split("\n")[2:]] == table.split("\n")[2:]


def test_parents_turn_at_headings_and_whole_texts_stay(spark):
    got = _chunks(spark, ("heading", ["A"], "A"), ("paragraph", ["A"], "a " * 1700), ("heading", ["B"], "B"), ("page_break", ["B"], None), ("paragraph", None, "end"), ("paragraph", [], " \n"))
    assert [(r.parent, r.n_tokens) for r in got if r.parent in (0, 3)] == [(0, 1), (3, 2)]
    assert sum(r.n_tokens for r in got if r.parent == 1) >= 1200
    assert {r.parent_tokens for r in got if r.parent in (1, 2)} == {1200, 500}
    assert [r.short for r in got] == [r.n_tokens < 32 and r.position == max(x.position for x in got if x.parent == r.parent) for r in got] and got[0].short and got[-1].short
    assert _chunks(spark, ("paragraph", [], None)) == []


def test_hierarchy(spark, tmp_path):
    def save(df, label):
        path = f"{tmp_path}/{label}-{next(number)}"
        df.write.parquet(path)
        return spark.read.parquet(path)

    number = itertools.count()
    pairs = [(f"a{i}", f"a{j}", 9 if i // 4 == j // 4 else 1) for i in range(12) for j in range(i)] + [("b1", "b2", 5), ("b1", None, 1), ("b1", "b1", 7)]
    edges = spark.createDataFrame(pairs, "source string, target string, weight int")
    nodes = spark.createDataFrame([(f"a{i}",) for i in range(12)] + [("b1",), ("b2",), ("alone",)], "node string")
    got = communities.hierarchy(nodes, edges, save, levels=2, most=3)
    assert communities.hierarchy_faults(got, nodes).count() == 0
    top = {r.node: r.label for r in got.where("level = 0").collect()}
    assert len(top) == 15 and top["alone"] == "alone" and top["a0"] not in (top["b1"], "alone")
    assert communities.hierarchy_faults(got.unionByName(got), nodes).where("fault = 'twice'").count() > 0
    assert communities.hierarchy_faults(got.where("level > 0"), nodes).where("fault = 'bare' AND subject = 'alone'").count() == 1
