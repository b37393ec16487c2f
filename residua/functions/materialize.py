"""Cutting lineage: a Parquet table in the shared scratch folder, so a lost executor costs a re-read only."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def scratch_root(spark: SparkSession) -> str:
    """The cluster's checkpoint folder; a local folder only for a local master without one."""
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder all executors share")
    folder = tempfile.mkdtemp(prefix="residua-")
    spark.sparkContext.setCheckpointDir(folder)
    return spark.sparkContext.getCheckpointDir()


def scratch_path(spark: SparkSession, purpose: str) -> str:
    return f"{scratch_root(spark)}/residua-{purpose}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, purpose: str = "table", by: tuple[str, ...] = (), file_rows: int = 0) -> DataFrame:
    """Write once and read back: later passes read columns from files instead of recomputing the plan.

    ``by`` gives a folder to every value of these columns; ``file_rows`` is the most rows of a file, where it matters.
    """
    spark = df.sparkSession
    path = scratch_path(spark, purpose)
    df.write.option("maxRecordsPerFile", file_rows).partitionBy(*by).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


SMALL_INPUT_BYTES = 1 << 30


def spread_small(df: DataFrame) -> DataFrame:
    """Give a small input one partition per core before Python work; a single row group would use one core.

    The size is the optimizer's estimate from file metadata. Inputs above it already come in many partitions and are
    not shuffled.
    """
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    if size > SMALL_INPUT_BYTES:
        return df
    return df.repartition(df.sparkSession.sparkContext.defaultParallelism)
