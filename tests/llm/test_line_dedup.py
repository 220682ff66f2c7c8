"""Line dedup against plain Python, with clashing columns, null ids and repeated rows."""

import random
from collections import defaultdict

import pytest

from strataloom.llm.line_dedup import line_dedup

SCHEMA = "doc_id long, text string, source string, n_removed string, score double"


def _plain(rows, min_sites):
    """Cleaned text and counts of every row: the least place (null id first, id, number) of a line keeps it."""
    sites, places = defaultdict(set), defaultdict(list)
    for d, text, site, *_ in rows:
        for no, line in enumerate(text.split("\n") if text is not None else ()):
            if line.strip(" "):
                places[line.strip(" ")].append((d is not None, d or 0, no, text))
                if site is not None:
                    sites[line.strip(" ")].add(site)
    gone = {k for k, v in sites.items() if len(v) >= min_sites}
    out = []
    for d, text, site, *_ in rows:
        if text is None:
            out.append((d, None, 0, 0))
            continue
        lines = text.split("\n")
        kept = [x for no, x in enumerate(lines) if x.strip(" ") not in gone or (d is not None, d or 0, no, text) == min(places[x.strip(" ")])]
        out.append((d, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return sorted(out, key=str)


def test_against_plain(spark):
    rng = random.Random(3)
    rows = []
    for d in range(400):
        lines = [rng.choice(["all rights reserved", " all rights reserved ", "", f"line {rng.randrange(60)}", f"own {d} {rng.random()}", "ÄÖ ß"]) for _ in range(rng.randrange(0, 14))]
        rows.append((d, "\n".join(lines), f"s{rng.randrange(9)}" if rng.random() < 0.9 else None, "clash", 0.5))
    rows += [(None, "line 1\nline 2", "s1", None, None), (1000, None, "s2", None, None), (1001, "", None, None, None), (5, "line 3\nother text of the id 5", "s3", None, None)]
    rows += [(2000 + k, "very long line " * 4000, f"s{k}", None, None) for k in range(7)]
    rows += [rows[3], rows[3]]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    out = line_dedup(docs)
    assert sorted(out.columns) == ["doc_id", "n_lines", "n_removed", "score", "source", "text"]
    got = sorted(((r["doc_id"], r["text"], r["n_lines"], r["n_removed"]) for r in out.collect()), key=str)
    assert got == _plain(rows, 6)


def test_empty_and_reserved(spark):
    assert line_dedup(spark.createDataFrame([], SCHEMA)).count() == 0
    with pytest.raises(ValueError, match="reserved"):
        line_dedup(spark.createDataFrame([(1, "a", "s", 2)], "doc_id long, text string, source string, __h1 long"))
