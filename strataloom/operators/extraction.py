"""Graphs of parents: provisional ones without a model, what a new extraction does to stored evidence, GraphML, and answers of models as JSON."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.names import sentences


def provisional_graph(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """parent_id, source, target and weight: in how many sentences of a document two of its terms stand together (source < target, in lower case).

    docs: document_id, text; terms: document_id, term, bounded per document as provisional_terms does. A document's sentences and terms come together in one
    row; in which sentences a term stands is a number's bits, so that a pair's weight is the count of bits that both have.
    """
    ids = terms.groupBy("document_id").agg(F.array_sort(F.collect_set(F.lower("term"))).alias("ids")).where("size(ids) > 1")
    low = F.transform(sentences(F.col("text")), lambda s: F.lower(s))
    said = docs.select("document_id", low.alias("s")).groupBy("document_id").agg(F.flatten(F.collect_list("s")).alias("said"))
    kind = dict(docs.dtypes)["document_id"]
    return said.join(ids, "document_id").select("document_id", "ids", "said").mapInArrow(_together, f"parent_id {kind}, source string, target string, weight long")


def _together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for at in range(0, whole.num_rows, 1000):
            batch = whole.slice(at, 1000)
            flat = batch.column("ids").flatten()
            rows, sources, targets, weights, base = [], [], [], [], 0
            for row, (ids, said) in enumerate(zip(batch.column("ids").to_pylist(), batch.column("said").to_pylist(), strict=True)):
                seen = []
                for k, term in enumerate(ids, base):
                    bits = 0
                    for bit, sentence in enumerate(said):
                        if term in sentence:
                            bits |= 1 << bit
                    if bits:
                        seen.append((k, bits))
                for x, (source, a) in enumerate(seen, 1):
                    for target, b in seen[x:]:
                        if a & b:
                            rows.append(row)
                            sources.append(source)
                            targets.append(target)
                            weights.append((a & b).bit_count())
                base += len(ids)
            take = lambda column, places: column.take(pa.array(places, pa.int64()))
            yield pa.record_batch([take(batch.column("document_id"), rows), take(flat, sources), take(flat, targets), pa.array(weights, pa.int64())], names=["parent_id", "source", "target", "weight"])


RELATION = ["source", "target", "type"]


def persisted(relations: DataFrame, evidence: DataFrame, fresh: DataFrame, parents: DataFrame, revision: Column) -> tuple[DataFrame, DataFrame]:
    """Relations (source, target, type, created_in) and their evidence (source, target, type, parent_id, provisional) after parents (parent_id) were extracted anew as fresh, with evidence's columns.

    Evidence of these parents is replaced; where fresh repeats itself, one verified row wins. Relations that lose their last evidence go if this revision made them, and stay otherwise. New ones are of this revision.
    """
    own = fresh.groupBy(*RELATION, "parent_id").agg(F.min("provisional").alias("provisional"))
    after = evidence.join(parents.select("parent_id").distinct(), "parent_id", "left_anti").select(*own.columns).unionByName(own)
    backed = after.select(*RELATION).distinct()
    met = relations.join(backed.withColumn("__b", F.lit(True)), RELATION, "full_outer")
    lost = F.col("__b").isNull() & F.coalesce(F.col("created_in") == revision, F.lit(False))
    old = relations.select(*RELATION).distinct().withColumn("__o", F.lit(True))
    kept = met.where(~lost).join(old, RELATION, "left").withColumn("created_in", F.when(F.col("__o").isNull(), revision).otherwise(F.col("created_in")))
    return kept.select(*RELATION, "created_in"), after


def _xml(text: Column) -> Column:
    out = F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), "[\\x00-\\x08\\x0B\\x0C\\x0E-\\x1F\\uFFFE\\uFFFF]", "")
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        out = F.replace(out, F.lit(a), F.lit(b))
    return out


#: Opening of a GraphML file with one attribute for nodes and one for edges. Fixed values.
_HEAD = (
    '<?xml version="1.0" encoding="utf-8"?>', '<graphml xmlns="http://graphml.graphdrawing.org/xmlns">', '<key id="entity_type" for="node" attr.name="entity_type" attr.type="string"/>',
    '<key id="relationship_type" for="edge" attr.name="relationship_type" attr.type="string"/>', '<graph edgedefault="directed">',
)


def graphml(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """section and line of a GraphML file of nodes (id, type) and edges (source, target, type; repeats are edges of their own): sorted by section and written as text, the parts make the file. Characters that XML has not are left out."""
    spark = nodes.sparkSession
    ends = spark.createDataFrame([(0, "\n".join(_HEAD)), (3, "</graph>\n</graphml>")], "section int, line string")
    n = nodes.select(F.lit(1).alias("section"), F.concat(F.lit('<node id="'), _xml(F.col("id")), F.lit('"><data key="entity_type">'), _xml(F.coalesce("type", F.lit("Entity"))), F.lit("</data></node>")).alias("line"))
    e = edges.select(F.lit(2).alias("section"), F.concat(F.lit('<edge source="'), _xml(F.col("source")), F.lit('" target="'), _xml(F.col("target")), F.lit('"><data key="relationship_type">'), _xml(F.col("type")), F.lit("</data></edge>")).alias("line"))
    return ends.unionByName(n).unionByName(e)


def json_object(answer: Column) -> Column:
    """The JSON object in a model's answer as text: the whole answer without a code fence, else what lies between its outermost braces; null if neither is an object."""
    plain = F.btrim(F.coalesce(answer, F.lit("")), F.lit(" \t\n\r\f"))
    bare = F.when(F.startswith(plain, F.lit("```")), F.regexp_replace(F.regexp_replace(plain, r"^```(json)?[ \t\n\r\f]*", ""), r"[ \t\n\r\f]*```$", "")).otherwise(plain)
    object_ = lambda c: F.when(F.startswith(c, F.lit("{")) & F.try_parse_json(c).isNotNull(), c)
    other = F.try_parse_json(bare).isNotNull()  # a list, a text or a number is an answer, but no object
    inner = F.regexp_extract(bare, r"(?s)(\{.*\})", 1)
    return F.when(other, object_(bare)).otherwise(object_(inner))
