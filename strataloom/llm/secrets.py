"""Secret scans over a trigram inverted index. DataFrame functions only.

Each rule's regular expression is reduced on the driver to a Boolean query of trigrams that every match must contain. Postings
(term, document) of those terms are intersected per rule by a join and a grouped count; candidates are verified with the
expression itself. Rules without a mandatory trigram scan every text.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize

try:  # the parser's name since Python 3.11
    from re import _constants as _c
    from re import _parser as _p
except ImportError:  # pragma: no cover
    import sre_constants as _c
    import sre_parse as _p


@dataclass(frozen=True)
class Rule:
    """kind, expression, and the least length of one group (0: the match)."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0
    base: bool = False


#: The base rules, and widely published formats of credentials.
RULES = (
    Rule("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12, True),
    Rule("access", r"AKIA[A-Z0-9]{14,}", base=True),
    Rule("hex", r"[0-9a-f]{16,}", base=True),
    Rule("forge", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("chat", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("maps", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("pem", r"-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----"),
)


def trigram_query(pattern: str, most: int = 64) -> list[frozenset[str]] | None:
    """Alternatives, each a set of lower-case trigrams that a text must all contain for one to be possible; None: no mandatory trigram."""
    factors: list[set[frozenset[str]]] = []

    def grams(text: str) -> frozenset[str]:
        return frozenset(text[i : i + 3] for i in range(len(text) - 2))

    def flush(words: set[str]) -> None:
        choice = {grams(w) for w in words}
        if frozenset() not in choice:
            factors.append({a for a in choice if not any(b < a for b in choice)})

    def walk(nodes, words: set[str]) -> set[str]:
        """Words that may end what has been read so far, exactly as far back as they go."""
        for op, arg in nodes:
            options: set[str] | None = None
            if op is _c.LITERAL:
                options = {chr(arg).lower()}
            elif op is _c.IN and all(k is _c.LITERAL for k, _ in arg):
                options = {chr(v).lower() for _, v in arg}
            elif op is _c.SUBPATTERN:
                options = exact(arg[3])
            elif op is _c.BRANCH:
                parts = [exact(x) for x in arg[1]]
                options = None if None in parts else set().union(*parts)
            elif op in (_c.MAX_REPEAT, _c.MIN_REPEAT):
                low, high, body = arg
                once = exact(body)
                if once is not None and high != _c.MAXREPEAT and high <= 4:
                    options = {"".join(x) for n in range(low, high + 1) for x in product(once, repeat=n)}
            if options is None or len(options) * len(words) > most:
                flush(words)
                if options is None and op is _c.SUBPATTERN:
                    words = walk(arg[3], {""})
                    flush(words)
                words = options if options is not None and len(options) <= most else {""}
            else:
                words = {a + b for a in words for b in options}
        return words

    def exact(nodes) -> set[str] | None:
        words = {""}
        for op, arg in nodes:
            before = len(factors)
            more = walk([(op, arg)], {""})
            if more == {""} and not (op in (_c.MAX_REPEAT,) and arg[1] == 0) or len(factors) > before or len(more) * len(words) > most:
                del factors[before:]
                return None
            words = {a + b for a in words for b in more}
        return words

    flush(walk(_p.parse(pattern), {""}))
    if not factors:
        return None
    best = min(factors, key=lambda f: (len(f), -min(len(a) for a in f)))
    out = {frozenset().union(*x) for x in product(*factors)} if len(factors) and 1 <= _size(factors) <= most else best
    return sorted(out, key=sorted)


def _size(factors: list[set[frozenset[str]]]) -> int:
    n = 1
    for f in factors:
        n *= len(f)
    return n


def _key(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).alias("__id"), F.coalesce(F.col(text_col), F.lit("")).alias("__text"))


def candidates(docs: DataFrame, rules: tuple[Rule, ...] = RULES, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """__id and __rules: the indexes of the indexed rules whose trigram query the document's postings satisfy."""
    queries = [(r, k, q) for r, rule in enumerate(rules) for k, q in enumerate(trigram_query(rule.pattern) or [])]
    terms = sorted(set().union(*(q for _, _, q in queries)))
    low = F.lower("__text")
    posted = F.array_compact(F.array(*(F.when(F.contains(F.col("__low"), F.lit(t)), F.lit(i)) for i, t in enumerate(terms))))
    # Only terms of some rule's query are posted: the index is restricted to the query vocabulary. One search a term took half the time of one expression for all terms.
    postings = _key(docs, id_col, text_col).select("__id", low.alias("__low")).select("__id", F.explode(posted).alias("__term"))
    spark = docs.sparkSession
    parts = spark.createDataFrame([(terms.index(t), r, k, len(q)) for r, k, q in queries for t in sorted(q)], "__term int, __rule int, __part int, __need int")
    met = (
        postings.join(F.broadcast(parts), "__term")  # as many rows as the fixed rules have terms
        .groupBy("__id", "__rule", "__part", "__need").agg(F.countDistinct("__term").alias("__have"))
        .where("__have = __need")
    )
    return met.groupBy("__id").agg(F.collect_set("__rule").alias("__rules"))


def _found(text: Column, rule: Rule, order: int) -> Column:
    """Spans of a rule in a text: between the pieces that the expression splits it into lie the matches, so lengths give their places."""
    pieces = F.transform(F.split(text, rule.pattern, -1), lambda x: F.length(x))
    whole = F.transform(F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0)), lambda x: F.length(x))
    part = F.transform(F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group)), lambda x: F.length(x))
    triples = F.arrays_zip(pieces.alias("before"), whole.alias("size"), part.alias("part"))
    kind = "array<struct<start:int,order:int,end:int,kind:string,part:int>>"
    walked = F.aggregate(
        F.filter(triples, lambda x: x["size"].isNotNull()),
        F.struct(F.lit(0).alias("at"), F.array().cast(kind).alias("found")),
        lambda a, x: F.struct(
            (a["at"] + x["before"] + x["size"]).alias("at"),
            F.when(x["part"] >= rule.least, F.concat(a["found"], F.array(F.struct((a["at"] + x["before"]).alias("start"), F.lit(order).alias("order"), (a["at"] + x["before"] + x["size"]).alias("end"), F.lit(rule.kind).alias("kind"), x["part"].alias("part"))))).otherwise(a["found"]).alias("found"),
        ),
    )
    return F.when(F.rlike(text, F.lit(rule.pattern)), walked["found"]).otherwise(F.array().cast(kind))


def secret_spans(docs: DataFrame, rules: tuple[Rule, ...] = RULES, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs plus secrets: array of (start, order, end, kind, part) by start, then the rules' order; code points, end exclusive.

    Null text is as empty text. Rows that repeat an id, or have none, share candidates (a superset) and are verified one by one.
    Extra columns pass through; names that begin with two underscores are reserved.
    Candidates are written first: while their table is below spark.sql.autoBroadcastJoinThreshold they are sent to where texts are read, beyond that texts are shuffled to them.
    """
    indexed = {r for r, rule in enumerate(rules) if trigram_query(rule.pattern)}
    found = materialize(candidates(docs, rules, id_col=id_col, text_col=text_col), "candidates")
    joined = docs.join(found, docs[id_col].eqNullSafe(found["__id"]), "left").withColumn("__text", F.coalesce(F.col(text_col), F.lit("")))
    empty = F.array().cast("array<struct<start:int,order:int,end:int,kind:string,part:int>>")
    each = []
    for r, rule in enumerate(rules):
        spans = _found(F.col("__text"), rule, r)
        each.append(F.when(F.array_contains("__rules", r), spans).otherwise(empty) if r in indexed else spans)
    return joined.withColumn("secrets", F.array_sort(F.concat(*each))).drop("__id", "__rules", "__text")


def joined_spans(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
