"""Cutting lineage through the folder that the cluster shares."""

from __future__ import annotations

import gc
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; where it is unset on a single machine (tests) a temporary folder, on a cluster an error."""
    sc = spark.sparkContext
    known = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not known and not (sc.master == "local" or sc.master.startswith("local[")):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(known or tempfile.mkdtemp(prefix="tarnweave-"))
    return known or sc.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """``df`` computed once and read back from the shared folder."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame) -> DataFrame:
    """``df`` computed once as compressed columns in the shared folder; what reads it decodes the columns that it names only.

    For wide rows that several jobs read in part; a checkpoint keeps whole rows, uncompressed.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/stored-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Lets the driver drop what is no longer referenced: shuffle files, broadcasts, old checkpoints
    and finished plans.  Worth a call between the phases of a job of many."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Bounds what a Python worker gets at once; texts are larger than the rows Spark's default is for.

    A session that has another number than Spark's default keeps it.
    """
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(key) == "10000":
        spark.conf.set(key, str(rows))


def small_tasks(spark: SparkSession, size: str = "16m") -> None:
    """Bounds what a task reads of a shuffle; rows of a few keys are compressed so well that 64 MB, Spark's default, are millions of them,
    and sorts and hash tables over them take more than a GB.

    A session that has another number than Spark's default keeps it.
    """
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    if spark.conf.get(key, "64m") in ("64m", "64MB", "67108864b", "67108864"):
        spark.conf.set(key, size)
