"""Typed ingestion of source packages: submission under idempotency keys, evaluation gates, acceptance and rollback; claims and grounded extractions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.names import date_span

#: Least values that a staged revision must reach to pass. Fixed values.
GATES = {"baseline_quality_ratio": 0.95, "effective_citation_ratio": 1.0, "graph_expansion_ratio": 0.90, "capacity_headroom_ratio": 0.25}
#: States that an ingestion does not leave. Fixed values.
TERMINAL = ("duplicate", "accepted", "rolled_back", "failed", "quarantined")


def submitted(requests: DataFrame) -> DataFrame:
    """request_id, record_id and outcome of requests (corpus_key, idempotency_key, package_sha256; served by request_id).

    The first valid request of a corpus and key makes the record ('new'); a later one with its digest gets that record ('existing'), one with another digest
    none ('conflict'). An empty key, one of over 200 characters, a digest that is not 64 lower-case hex digits or a null is 'invalid'.
    """
    valid = F.coalesce((F.trim("idempotency_key") != "") & (F.length("idempotency_key") <= 200) & F.col("package_sha256").rlike("^[0-9a-f]{64}$") & F.col("corpus_key").isNotNull(), F.lit(False))
    marked = requests.withColumn("__valid", valid)
    keys = ["corpus_key", "idempotency_key"]
    first = marked.where("__valid").groupBy(*keys).agg(F.min(F.struct("request_id", "package_sha256")).alias("__first"))
    met = marked.join(first, keys, "left")
    same = F.col("package_sha256") == F.col("__first.package_sha256")
    outcome = F.when(~F.col("__valid"), "invalid").when(F.col("request_id") == F.col("__first.request_id"), "new").when(same, "existing").otherwise("conflict")
    return met.select("request_id", F.when(F.col("__valid") & same, F.col("__first.request_id")).alias("record_id"), outcome.alias("outcome"))


def staged(packages: DataFrame, ledger: DataFrame) -> DataFrame:
    """packages (source_id, checksum, error) with status and document_id: quarantined with an error, duplicate if the ledger (source_id, checksum, document_id, active) has this content active, else staged."""
    known = ledger.groupBy("source_id").agg(F.max(F.struct("active", "checksum", "document_id")).alias("__l"))
    met = packages.join(known, "source_id", "left")
    same = F.coalesce((F.col("__l.checksum") == F.col("checksum")) & F.col("__l.active"), F.lit(False))
    status = F.when(F.coalesce("error", F.lit("")) != "", "quarantined").when(same, "duplicate").otherwise("staged")
    return met.withColumns({"status": status, "document_id": F.col("__l.document_id")}).drop("__l")


def evaluated(records: DataFrame) -> DataFrame:
    """records with failures (sorted names of gates not passed), passed and status.

    records: status, the measures of GATES, unsupported_claim_delta, source_canary_retrieved, graph_ready, completed_parents, expected_parents. Only staged and
    evaluated ones are judged; others keep their status, and failures and passed are null. A measure that is null or not finite leaves the record as it is too.
    """
    finite = lambda c: F.coalesce(~F.isnan(c) & (F.abs(c) < float("inf")), F.lit(False))
    may = F.col("status").isin("staged", "evaluated")
    for name in [*GATES, "unsupported_claim_delta"]:
        may = may & finite(F.col(name).cast("double"))
    lost = [F.when(F.col(k) < v, F.lit(k)) for k, v in GATES.items()]
    lost.append(F.when(F.col("unsupported_claim_delta") > 0, F.lit("unsupported_claim_delta")))
    lost.append(F.when(~F.coalesce("source_canary_retrieved", F.lit(False)), F.lit("source_canary_retrieved")))
    lost.append(F.when(~F.coalesce(F.col("graph_ready") & (F.coalesce("completed_parents", F.lit(0)) == F.col("expected_parents")), F.lit(False)), F.lit("graph_ready")))
    failures = F.when(may, F.array_sort(F.array_compact(F.array(*lost))))
    return records.withColumn("failures", failures).withColumns({"passed": F.size("failures") == 0, "status": F.when(F.col("failures").isNotNull(), "evaluated").otherwise(F.col("status"))}).withColumn("passed", F.when(F.col("failures").isNotNull(), F.col("passed")))


def decided(records: DataFrame, wish: Column) -> DataFrame:
    """records (status, passed, revision_id) with status and refused (why a wish had no effect; null if it had, or there was none). Wishes: accept, rollback.

    Only what passed its evaluation is accepted. What is accepted is not rolled back here, nor what has no revision. Repeating a decision changes nothing.
    """
    s = F.col("status")
    takes = (wish == "accept") & (s == "evaluated") & F.coalesce("passed", F.lit(False))
    drops = (wish == "rollback") & ~s.isin("accepted", "rolled_back") & F.col("revision_id").isNotNull()
    refused = (
        F.when((wish == "accept") & (s != "accepted") & ~takes, "not passed").when((wish == "rollback") & (s == "accepted"), "already accepted")
        .when((wish == "rollback") & (s != "rolled_back") & F.col("revision_id").isNull(), "no revision")
    )
    return records.withColumns({"status": F.when(takes, "accepted").when(drops, "rolled_back").otherwise(s), "refused": refused})


def promoted(ledger: DataFrame, rows: DataFrame, key: str) -> DataFrame:
    """ledger with rows of equal key overwritten and new ones added, and change: added, changed, same (every field equal, nulls too) or kept (no row came). rows have the ledger's columns and distinct keys."""
    fields = [c for c in ledger.columns if c != key]
    a, b = ledger.select(key, F.struct(*fields).alias("a")), rows.select(key, F.struct(*fields).alias("b"))
    met = a.join(b, key, "full_outer")
    change = F.when(F.col("b").isNull(), "kept").when(F.col("a").isNull(), "added").when(F.col("a").eqNullSafe(F.col("b")), "same").otherwise("changed")
    return met.select(key, F.coalesce("b", "a").alias("row"), change.alias("change")).select(key, *(F.col("row")[c].alias(c) for c in fields), "change")


def valid_extraction(nodes: DataFrame, relations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Nodes (parent_id, id) with a non-empty id, once each; relations (parent_id, source, target, type) of two different nodes of their parent, once each."""
    kept = nodes.where(F.trim("id") != "").dropDuplicates(["parent_id", "id"])
    ends = kept.select("parent_id", "id")
    both = relations.where("source <> target").dropDuplicates(["parent_id", "source", "target", "type"])
    for side in ("source", "target"):
        both = both.join(ends.withColumnRenamed("id", side), ["parent_id", side], "left_semi")
    return kept, both


def claims(raw: DataFrame) -> DataFrame:
    """raw (parent_id, subject, predicate, object, valid_from, valid_to, stance) as claims with claim_id, the hash of what is claimed whatever the stance. Claims with an empty part or unsound dates are left out."""
    part = lambda c: F.btrim(F.coalesce(F.col(c), F.lit("")))
    span = raw.withColumn("__s", date_span(F.col("valid_from"), F.col("valid_to"))).where("__s.valid")
    made = span.select("parent_id", part("subject").alias("subject"), part("predicate").alias("predicate"), part("object").alias("object"), F.col("__s.start").alias("valid_from"), F.col("__s.end").alias("valid_to"), "stance")
    text = F.concat_ws("\n", "subject", "predicate", "object", F.coalesce(F.col("valid_from").cast("string"), F.lit("-")), F.coalesce(F.col("valid_to").cast("string"), F.lit("-")))
    return made.where("subject <> '' AND predicate <> '' AND object <> ''").withColumn("claim_id", F.sha2(text, 256))


def claim_evidence(stored: DataFrame, fresh: DataFrame) -> DataFrame:
    """Evidence (claim_id, parent_id, stance) after the parents in fresh were extracted anew: theirs is replaced, that of other parents stays; the greatest stance of repeats."""
    own = fresh.groupBy("claim_id", "parent_id").agg(F.max("stance").alias("stance"))
    return stored.join(fresh.select("parent_id").distinct(), "parent_id", "left_anti").select(*own.columns).unionByName(own)
