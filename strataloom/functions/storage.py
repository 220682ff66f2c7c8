"""Tables written into the folder that driver and executors share, which cut lineage and survive lost executors, and their clean-up."""

from __future__ import annotations

import gc
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession, label: str) -> str:
    """A new path below spark.checkpoint.dir, which driver and executors share; in local mode only, a temporary folder if that is unset."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        base = tempfile.mkdtemp(prefix="strataloom-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/strataloom/{label}-{uuid.uuid4().hex}"


def tasks(spark: SparkSession, per_core: int = 4) -> int:
    """Enough tasks to keep every core of the cluster busy: a few per core, so the number of files follows the cluster and not the shuffle."""
    return max(1, per_core * spark.sparkContext.defaultParallelism)


def materialize(df: DataFrame, label: str, *, scan: bool = False) -> DataFrame:
    """Writes df as Parquet into the shared folder and reads it back: cuts lineage, survives lost executors, computes Python stages once.

    scan: df is made from a scan alone, and keeps the scan's tasks; what comes from shuffles is written by a few tasks per core.
    """
    path = shared_dir(df.sparkSession, label)
    (df if scan else df.coalesce(tasks(df.sparkSession))).write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.__dict__["_written"] = path
    return out


def release(*tables: DataFrame) -> None:
    """Deletes tables that materialize wrote and nothing reads any more, and lets the driver forget the shuffles of plans that are gone."""
    for df in tables:
        path = df.__dict__.pop("_written", None)
        if path:
            at = df.sparkSession._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(at, True)
    if tables:
        gc.collect()
        tables[0].sparkSession._jvm.System.gc()  # shuffle files go when the driver's collector finds that no plan holds them
