"""Streams over a drop folder and over events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.ingest import sync_diff
from ..sources.files import upsert


def sync_stream(spark: SparkSession, drop: str, state: str, checkpoint: str) -> StreamingQuery:
    """Takes JSON lines (source_id, checksum, text) from a drop folder, what is there now, into versions of a manifest below state.

    Each batch writes version batch_id + 1 from version batch_id, so that a batch that runs again gives the same; changes has what a batch did.
    Of rows of a batch that share an id the greatest (checksum, text) stands. Nothing is removed.
    """
    schema = "source_id string, checksum string, text string"

    def apply(batch: DataFrame, batch_id: int) -> None:
        s = batch.sparkSession
        rows = batch.where("source_id IS NOT NULL").groupBy("source_id").agg(F.max(F.struct("checksum", "text")).alias("x")).select("source_id", "x.*")
        old = s.read.schema(schema).parquet(f"{state}/manifest/v{batch_id}") if batch_id else s.createDataFrame([], schema)
        upsert(old, rows, "source_id").write.mode("overwrite").parquet(f"{state}/manifest/v{batch_id + 1}")
        sync_diff(rows, old).where("status <> 'removed'").write.mode("overwrite").parquet(f"{state}/changes/batch={batch_id}")

    return spark.readStream.schema(schema).json(drop).writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def windowed_usage(events: DataFrame, width: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """Per window and type: number and sum of events (event_id, ts, event_type, value), each id once within the watermark; for streams and tables."""
    seen = events.withWatermark("ts", late)
    seen = seen.dropDuplicatesWithinWatermark(["event_id"]) if events.isStreaming else seen.dropDuplicates(["event_id"])
    return seen.groupBy(F.window("ts", width).alias("w"), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total")).select(F.col("w.start").alias("start"), "event_type", "n", "total")
