"""Cross-site boilerplate lines, by distinct-site spread.

One HyperLogLog sketch of sites per line hash is built map-side and merged by the
aggregation. Lines whose estimate is clearly below or above the threshold are decided by it;
lines near the threshold are counted exactly. Every occurrence of a boilerplate line but the
first (least document id, then line number) is removed. DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize

_LINE = ["__h1", "__h2"]
_PLACE = ("__id", "__no", "__t")


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _occurrences(docs: DataFrame, id_col: str, text_col: str, site_col: str) -> DataFrame:
    """One row per non-blank line: 128-bit key of the trimmed line, document (id and text hash), line number, site."""
    line = F.trim(F.col("__line"))
    return (
        docs.select(F.col(id_col).alias("__id"), F.xxhash64(text_col).alias("__t"), F.col(site_col).cast("string").alias("__site"), F.posexplode(_lines(F.col(text_col))).alias("__no", "__line"))
        .where(line != "")
        .select(F.xxhash64(line).alias("__h1"), F.xxhash64(F.lit(0x51ED), line).alias("__h2"), "__id", "__t", "__no", "__site")
    )


def _spread(rows: DataFrame, min_sites: int, lg_k: int) -> DataFrame:
    spread = (
        rows.groupBy(*_LINE)
        .agg(F.hll_sketch_agg("__site", F.lit(lg_k)).alias("__sketch"), F.min(F.struct(*_PLACE)).alias("__first"), F.count("__site").alias("__n"))
        .where(F.col("__n") >= min_sites)
        .select(*_LINE, "__first", F.hll_sketch_estimate("__sketch").alias("__spread"))
    )
    slack = max(1.0, 5 * 0.83 / (2**lg_k) ** 0.5 * min_sites)
    near = F.abs(F.col("__spread") - min_sites) <= slack
    exact = (
        _meet(rows, spread.where(near).select(*_LINE))
        .groupBy(*_LINE, "__site").agg(F.min(F.struct(*_PLACE)).alias("__first"))
        .groupBy(*_LINE).agg(F.count("__site").alias("__spread"), F.min("__first").alias("__first"))
    )
    sure = spread.where(F.col("__spread") > min_sites + slack)
    return sure.unionByName(exact.where(F.col("__spread") >= min_sites).select(*sure.columns))


def _meet(rows: DataFrame, lines: DataFrame, salts: int = 32) -> DataFrame:
    """rows joined with lines by line hash. One line may hold a third of all rows: each line stands once per salt, and its rows are dealt to the salts."""
    dealt = rows.withColumn("__salt", F.pmod(F.xxhash64("__id", "__t", "__no"), F.lit(salts)).cast("int"))
    stood = lines.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return dealt.join(stood, [*_LINE, "__salt"]).drop("__salt")


def line_spread(docs: DataFrame, *, min_sites: int = 6, lg_k: int = 10, id_col: str = "doc_id", text_col: str = "text", site_col: str = "source") -> DataFrame:
    """Boilerplate lines: __h1, __h2, __first (the place that keeps it), __spread.

    A sketch of 2**lg_k buckets has a relative error of about 0.83 / sqrt(2**lg_k); estimates within
    five such errors (and at least one site) of min_sites are replaced by exact distinct counts.
    """
    return _spread(_occurrences(docs, id_col, text_col, site_col), min_sites, lg_k)


def line_dedup(docs: DataFrame, *, min_sites: int = 6, lg_k: int = 10, id_col: str = "doc_id", text_col: str = "text", site_col: str = "source") -> DataFrame:
    """docs with the text cleaned, plus n_lines and n_removed (long), which replace columns of these names.

    A line counts after trimming spaces; blank lines are never removed. Null site: counts
    towards no spread. Null text: stays null, with no lines. An empty text is one blank line. Rows
    that repeat id and text are one place; rows that share only the id are told apart by a hash of the text. Null ids
    sort first. Extra columns pass through; names that begin with two underscores are reserved, and raise.

    The places of lines (two hashes, id, number, site) are written once; the two aggregations and the list of what goes read them, so that texts are split twice only.
    """
    if reserved := [c for c in docs.columns if c.startswith("__")]:
        raise ValueError(f"reserved column names: {reserved}")
    rows = materialize(_occurrences(docs, id_col, text_col, site_col), "lines", scan=True)
    boilerplate = materialize(_spread(rows, min_sites, lg_k).select(*_LINE, "__first"), "boilerplate")
    drop = (
        _meet(rows, boilerplate)
        .where(~F.struct(*_PLACE).eqNullSafe(F.col("__first")))
        .groupBy("__id", "__t").agg(F.collect_set("__no").alias("__drop"))
    )
    keyed = docs.drop("n_lines", "n_removed").withColumn("__key", F.xxhash64(text_col))
    joined = keyed.join(drop, keyed[id_col].eqNullSafe(drop["__id"]) & (keyed["__key"] == drop["__t"]), "left").drop("__id", "__t", "__key")
    split = joined.withColumn("__lines", _lines(F.col(text_col)))
    lines, gone = F.col("__lines"), F.coalesce(F.col("__drop"), F.array().cast("array<int>"))
    kept = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), gone)
    text = F.when(F.size(gone) == 0, F.col(text_col)).otherwise(F.array_join(F.transform(kept, lambda i: F.get(lines, i)), "\n"))
    return split.withColumns({"n_lines": F.when(lines.isNull(), 0).otherwise(F.size(lines)).cast("long"), "n_removed": F.size(gone).cast("long"), text_col: text}).drop("__drop", "__lines")
