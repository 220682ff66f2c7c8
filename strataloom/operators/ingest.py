"""Windows of text, provisional terms, synchronisation and source resolution."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import CAPITALS, TERM, content_fingerprint, words


def windows(docs: DataFrame, size: int = 192, stride: int = 168) -> DataFrame:
    """document_id, position, n_words, text: windows of words over docs (document_id, text); the last one reaches the end. No words, no window."""
    n = F.size("ws")
    last = F.when(n > size, F.ceil((n - size) / stride)).otherwise(0).cast("int")
    w = docs.select("document_id", words(F.col("text")).alias("ws")).where(n > 0).withColumn("position", F.explode(F.sequence(F.lit(0), last)))
    piece = F.slice("ws", F.col("position") * stride + 1, size)
    return w.select("document_id", "position", F.size(piece).alias("n_words"), F.array_join(piece, " ").alias("text"))


def combined(block_rows: DataFrame, n: int) -> DataFrame:
    """document_id, part, n_blocks, text: every n consecutive blocks (document_id, ordinal, text) as one."""
    rows = block_rows.groupBy("document_id", F.floor(F.col("ordinal") / n).alias("part")).agg(F.array_sort(F.collect_list(F.struct("ordinal", "text"))).alias("xs"))
    return rows.select("document_id", "part", F.size("xs").alias("n_blocks"), F.array_join("xs.text", "\n").alias("text"))


def provisional_terms(docs: DataFrame, *, repeats: int = 2, length: int = 5, most: int = 40, ratio: float = 0.5) -> DataFrame:
    """document_id, term, df: capitalised runs and repeated long tokens of docs, the first `most` in order, of at most ratio of the documents.

    A document's texts come together once; its terms are then made in its row, and only the first `most` are counted over all documents.
    """
    trim = lambda c: F.regexp_replace(F.array_join(words(c), " "), "^[-_ ]+|[-_ ]+$", "")
    empty = F.array().cast("array<string>")
    each = lambda f: F.flatten(F.transform("texts", f))
    runs = F.array_distinct(each(lambda t: F.regexp_extract_all(t, F.lit(CAPITALS), F.lit(2))))
    tokens = F.sort_array(F.filter(each(lambda t: F.split(F.lower(t), f"[^{TERM[1:]}")), lambda x: F.length(x) >= length))
    again = lambda s: F.filter(s, lambda x, i: (i >= repeats - 1) & (F.get(s, i - (repeats - 1)) == x))
    repeated = F.get(F.transform(F.array(tokens), again), F.lit(0))  # as a lambda's variable the tokens are made once, not once a token
    kept = F.filter(F.array_distinct(repeated), lambda x: ~x.rlike("^[0-9]+$"))
    terms = F.array_distinct(F.filter(F.transform(F.concat(empty, runs, kept), trim), lambda x: x != ""))
    first = F.slice(F.array_sort(F.transform(terms, lambda x: F.struct(F.lower(x).alias("k"), x.alias("term")))), 1, most)
    texts = docs.groupBy("document_id").agg(F.collect_list("text").alias("texts"))
    rows = texts.select("document_id", F.explode(first).alias("x")).select("document_id", "x.k", "x.term")
    bound = docs.agg(F.greatest(F.lit(1), F.floor(F.count("*") * ratio)).alias("bound"))  # one row
    counted = rows.withColumn("df", F.count("*").over(Window.partitionBy("k")))
    return counted.join(F.broadcast(bound), F.col("df") <= F.col("bound")).select("document_id", "term", "df")


def sync_diff(current: DataFrame, manifest: DataFrame) -> DataFrame:
    """source_id, status: added, updated, unchanged or removed. Both: source_id, checksum."""
    c, m = current.select("source_id", F.col("checksum").alias("c"), F.lit(True).alias("__c")), manifest.select("source_id", F.col("checksum").alias("m"), F.lit(True).alias("__m"))
    status = F.when(F.col("__m").isNull(), "added").when(F.col("__c").isNull(), "removed").when(F.col("c").eqNullSafe(F.col("m")), "unchanged").otherwise("updated")
    return c.join(m, "source_id", "full_outer").select("source_id", status.alias("status"))


def resolve_sources(probes: DataFrame, ledger: DataFrame) -> DataFrame:
    """probe_id, status (matched, conflict or novel), reason, ledger_id.

    Probes have probe_id, ledger have ledger_id; both have provider_id, uri and checksum. Each kind of identity is an equi-join; a probe that meets several
    ledger rows is a conflict, and the first kind that met decides the reason. Null and empty identities meet nothing.
    """
    kinds = ("provider_id", "uri", "checksum")
    hits = None
    for k, kind in enumerate(kinds):
        p = probes.where(F.col(kind).isNotNull() & (F.col(kind).cast("string") != "")).select("probe_id", F.col(kind).alias("key"))
        # what more than two ledger rows share is a conflict all the same: two of them are enough
        ends = ledger.groupBy(F.col(kind).alias("key")).agg(F.min("ledger_id").alias("lo"), F.max("ledger_id").alias("hi"))
        one = p.join(ends, "key").select("probe_id", "lo", "hi", F.lit(k).alias("k"))
        hits = one if hits is None else hits.unionByName(one)
    best = hits.groupBy("probe_id").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.min("k").alias("k"))
    same = F.col("lo") == F.col("hi")
    return probes.select("probe_id").join(best, "probe_id", "left").select(
        "probe_id", F.when(F.col("lo").isNull(), "novel").when(same, "matched").otherwise("conflict").alias("status"),
        F.when(same, F.element_at(F.array(*map(F.lit, kinds)), F.col("k") + 1)).alias("reason"), F.when(same, F.col("lo")).alias("ledger_id"),
    )


def fingerprinted(docs: DataFrame) -> DataFrame:
    return docs.select("document_id", content_fingerprint(F.col("text")).alias("checksum"))


def peak_rates(events: DataFrame, seconds: int = 60) -> DataFrame:
    """user_id, peak, most_value: the greatest number of events and sum of values within any `seconds` up to and with an event (user_id, ts, value).

    An event is dealt out by user and slot of that many seconds, and also to the next slot as context, so that a busy user is many groups.
    """
    us, width = F.unix_micros(F.col("ts").cast("timestamp")), seconds * 1_000_000
    slots = events.select("user_id", us.alias("us"), "value").withColumn("slot", F.floor(F.col("us") / width))
    dealt = slots.withColumn("own", F.lit(True)).unionByName(slots.select("user_id", "us", "value", (F.col("slot") + 1).alias("slot"), F.lit(False).alias("own")))
    w = Window.partitionBy("user_id", "slot").orderBy("us").rangeBetween(-width, 0)
    seen = dealt.select("user_id", "own", F.count("*").over(w).alias("n"), F.sum("value").over(w).alias("v")).where("own")
    return seen.groupBy("user_id").agg(F.max("n").alias("peak"), F.round(F.max("v"), 4).alias("most_value"))


def contained(items: DataFrame, docs: DataFrame, width: int = 5) -> DataFrame:
    """item_id, document_id: items whose words occur in a row in a document. Items: item_id, text.

    The first `width` words of an item meet equal runs of words of documents by hash; what meets is compared in full.
    """
    w = lambda c: F.regexp_extract_all(F.lower(F.coalesce(c, F.lit(""))), F.lit(r"([\p{L}\p{N}_]+)"), 1)
    padded = lambda ws: F.concat(F.lit(" "), F.array_join(ws, " "), F.lit(" "))
    i = items.select("item_id", w(F.col("text")).alias("ws")).where("size(ws) > 0").withColumn("k", F.least(F.size("ws"), F.lit(width)))
    heads = i.select("item_id", padded(F.col("ws")).alias("phrase"), F.xxhash64(F.array_join(F.slice("ws", 1, F.col("k")), " ")).alias("h"))
    sizes = sorted(r["k"] for r in i.select("k").distinct().collect())  # at most `width` numbers
    d = docs.select("document_id", w(F.col("text")).alias("ws"))
    none = F.array().cast("array<bigint>")

    def runs_of(k: int) -> Column:
        starts = F.sequence(F.lit(1), F.size("ws") - (k - 1))
        return F.when(F.size("ws") >= k, F.transform(starts, lambda s: F.xxhash64(F.array_join(F.slice("ws", s, k), " ")))).otherwise(none)

    runs = F.array_distinct(F.concat(none, *(runs_of(k) for k in sizes)))
    met = d.select("document_id", F.explode(runs).alias("h")).join(heads, "h")
    return met.join(d.select("document_id", padded(F.col("ws")).alias("whole")), "document_id").where(F.contains("whole", "phrase")).select("item_id", "document_id").distinct()
