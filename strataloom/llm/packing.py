"""Best-fit packing of documents into fixed-size bins under conflicts.

Documents are cut into pieces of at most the capacity. Pieces are dealt to shards by a hash,
so that no source or cluster gathers in one task; each shard packs its pieces by decreasing size.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.graph import connected_components
from . import neardup
from .common import materialize, release

SCHEMA = "doc_id long, piece int, bin_id long, slot int, bin_offset int, start int, n_tokens int, source string"


class Packer:
    """Open bins in order of what is left in them. A bin's bitmaps hold one bit per source and cluster; source planes count up to max_per_source."""

    def __init__(self, capacity: int, max_per_source: int):
        self.capacity, self.planes = capacity, max_per_source
        self.open: list[tuple[int, int]] = []
        self.left: list[int] = []
        self.count: list[int] = []
        self.sources: list[list[int]] = []
        self.clusters: list[int] = []

    def put(self, size: int, source: int | None, cluster: int | None) -> tuple[int, int, int]:
        """Bin, slot and offset: the tightest bin that fits and has no conflict, searched upwards from the least sufficient residual."""
        s, c = 0 if source is None else 1 << source, 0 if cluster is None else 1 << cluster
        for k in range(bisect_left(self.open, (size, -1)), len(self.open)):
            b = self.open[k][1]
            if not self.clusters[b] & c and not self.sources[b][-1] & s:
                del self.open[k]
                break
        else:
            b = len(self.left)
            self.left.append(self.capacity)
            self.count.append(0)
            self.sources.append([0] * self.planes)
            self.clusters.append(0)
        offset, slot = self.capacity - self.left[b], self.count[b]
        self.left[b] -= size
        self.count[b] += 1
        self.clusters[b] |= c
        for p, plane in enumerate(self.sources[b]):
            if not plane & s:
                self.sources[b][p] = plane | s
                break
        if self.left[b]:
            insort(self.open, (self.left[b], b))
        return b, slot, offset


def pack_shard(pdf: pd.DataFrame, capacity: int, max_per_source: int) -> pd.DataFrame:
    """Packs one shard's pieces; a piece that fills a bin takes one for itself."""
    pdf = pdf.sort_values(["n_tokens", "doc_id", "start", "cluster", "row"], ascending=[False, True, True, True, True], na_position="last", kind="stable")
    source = pd.factorize(pdf["source"])[0]
    cluster = pd.factorize(pdf["cluster"])[0]
    packer = Packer(capacity, max_per_source)
    placed = [packer.put(int(n), int(s) if s >= 0 else None, int(c) if c >= 0 else None) for n, s, c in zip(pdf["n_tokens"], source, cluster, strict=True)]
    pdf[["bin", "slot", "bin_offset"]] = pd.DataFrame(placed, columns=["bin", "slot", "bin_offset"], index=pdf.index) if placed else 0
    pdf["bin_id"] = pdf["shard"].astype("int64") * (1 << 32) + pdf["bin"].astype("int64")
    return pdf


def squeezed(text: Column) -> Column:
    """A text whose white space is single spaces between words; null is as empty. Only what is not a single space yet is replaced, as each replacement costs."""
    return F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), r" \s+|[\t\n\x0B\f\r]\s*", " "))


def word_count(text: Column) -> Column:
    one = squeezed(text)
    return F.when(one == "", 0).otherwise(F.octet_length(one) - F.octet_length(F.replace(one, F.lit(" "), F.lit(""))) + 1)


def folded(text: Column) -> Column:
    """Hash of a text without case and white space's kind and amount; null is as empty."""
    return F.xxhash64(F.lower(squeezed(text)))


def facts(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", cluster: Column | None = None, tokens: Column | None = None) -> DataFrame:
    """What packing needs of each row, written: row (a number of its own), doc_id, source, cluster (by default of texts equal but for case and white space) and size. Texts stay where they are read."""
    row = F.col("__row") if "__row" in docs.columns else F.monotonically_increasing_id()
    return materialize(
        docs.select(
            row.alias("row"), F.col(id_col).cast("long").alias("doc_id"), F.col(source_col).cast("string").alias("source"),
            (cluster if cluster is not None else folded(F.col(text_col))).cast("long").alias("cluster"), (tokens if tokens is not None else word_count(F.col(text_col))).cast("int").alias("size"),
        ),
        "facts", scan=True,
    )


def clustered_facts(docs: DataFrame, *, width: int = 5, text_col: str = "text", **options) -> DataFrame:
    """facts whose cluster is that of rows linked, directly or not, as near-duplicates (shingles of width words, similarity of 0.8) or as texts equal but for case and white space.

    docs is read several times. If it has __row, as from numbered, that is the rows' number; else the rows are written first, with one.
    """
    rows = docs if "__row" in docs.columns else materialize(docs.withColumn("__row", F.monotonically_increasing_id()), "rows", scan=True)
    own = facts(rows, text_col=text_col, **options)
    near = neardup.near_duplicates(rows, width=width, id_col="__row", text_col=text_col).select(F.col("doc_id").alias("row"), F.col("component_id").alias("b"))
    placed = materialize(own.join(near, "row"), "placed")
    release(rows, own)
    same = placed.groupBy("cluster").agg(F.min("b").alias("a"))
    joined = connected_components(placed.select("cluster", "b").distinct().join(same, "cluster").where("a <> b").select("a", "b"), materialize)
    return placed.drop("cluster").join(joined, placed["b"] == joined["node"], "left").select("row", "doc_id", "source", F.coalesce("component", "b").alias("cluster"), "size")


def best_fit_pack(docs: DataFrame, *, capacity: int = 2048, max_per_source: int = 4, shard_docs: int = 4096, **columns) -> DataFrame:
    """One row per piece: doc_id, piece, bin_id, slot and bin_offset in the bin, start and n_tokens in the document, source.

    A bin holds at most capacity tokens (by default words), no two pieces of one cluster (by default: texts equal but for case
    and white space; pieces of one document are one cluster), and at most max_per_source pieces of a source.
    A document of k*capacity tokens and more gives k full pieces and the rest; one without tokens (null or empty text) is one piece of size 0.
    Null source: no conflict. Null or repeated ids are packed as rows of their own. Extra columns are left out.
    """
    return pack_facts(facts(docs, **columns), capacity=capacity, max_per_source=max_per_source, shard_docs=shard_docs)


def pack_facts(small: DataFrame, *, capacity: int = 2048, max_per_source: int = 4, shard_docs: int = 4096) -> DataFrame:
    """best_fit_pack of rows as facts gives them. Pieces are dealt to shards of about shard_docs documents by their row and number, so copies spread; bins never cross shards, which costs at most one open bin's rest for each size class of a shard."""
    shards = max(1, -(-small.count() // shard_docs))
    cut = F.sequence(F.lit(0), F.greatest(F.lit(0), F.ceil(F.col("size") / capacity).cast("int") - 1))
    pieces = small.select(
        "row", "doc_id", "source", "cluster", "size", F.explode(cut).alias("piece")
    ).select("row", "doc_id", "source", "cluster", "piece", F.pmod(F.xxhash64("row", "piece"), F.lit(shards)).cast("int").alias("shard"), (F.col("piece") * capacity).alias("start"), F.least(F.lit(capacity), F.col("size") - F.col("piece") * capacity).alias("n_tokens"))
    names = [x.split()[0] for x in SCHEMA.split(", ")]

    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        return pack_shard(pdf, capacity, max_per_source)[names]

    return pieces.groupBy("shard").applyInPandas(pack, SCHEMA)
