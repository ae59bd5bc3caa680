"""Session helpers: table loading, the shared work folder and written intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def spread(df: DataFrame) -> DataFrame:
    """Spread rows over all cores when the input has fewer splits than cores (one small file).

    Large inputs have more splits than cores and stay as they are, without a shuffle.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    # long texts and vectors carry per-row work worth spreading
    return spread(df) if name in ("documents", "pages", "conversations", "embeddings") else df


def work_dir(spark: SparkSession) -> str:
    """Shared folder for written intermediates: the one the cluster names in spark.checkpoint.dir.

    Only a local session without that setting gets a folder of its own.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if base:
        return base.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    base = "file:" + tempfile.mkdtemp(prefix="veilframe-", dir="/tmp")
    spark.sparkContext.setCheckpointDir(base)
    return base


def fresh_path(spark: SparkSession, label: str) -> str:
    return f"{work_dir(spark)}/{label}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, label: str = "step") -> DataFrame:
    """Write df as parquet in the shared folder and read it back, cutting its lineage.

    Used where two passes must see identical row placement (range partitions, sampled ids).
    """
    spark = df.sparkSession
    path = fresh_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small(df: DataFrame, max_rows: int = 200_000) -> DataFrame:
    """Broadcast df when a count proves it has at most max_rows rows, else leave the join to AQE."""
    if df.limit(max_rows + 1).count() <= max_rows:
        return F.broadcast(df)
    return df
