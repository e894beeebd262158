"""Session defaults and the shared folder for materialised intermediates."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app_name: str = "cohortflow", master: str | None = None, **conf) -> SparkSession:
    """A session with the settings the operators expect (UTC, ANSI, AQE with skew handling)."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.ansi.enabled", "true")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder that the driver and every executor can reach: ``spark.checkpoint.dir`` of the session.

    Where the setting is missing, a folder named with ``SparkContext.setCheckpointDir`` counts. There
    is no other fallback: a folder of one machine would lose data on a cluster.
    """
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named and sc.getCheckpointDir() is None:
        sc.setCheckpointDir(named)
    folder = named or sc.getCheckpointDir()
    if not folder:
        raise RuntimeError("Set spark.checkpoint.dir to a folder that the driver and all executors share")
    return folder


def name_local_folder(spark: SparkSession) -> None:
    """Names a folder for runs on one machine (tests, benchmark, entry point); clusters name their own."""
    sc = spark.sparkContext
    unset = not spark.conf.get("spark.checkpoint.dir", None) and sc.getCheckpointDir() is None
    if unset and re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
        sc.setCheckpointDir(f"/tmp/checkpoints/{sc.applicationId}")


def stage(df: DataFrame, name: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` once as zstd Parquet in the shared folder and return a scan of it.

    What is staged cuts the lineage and survives lost executors. Unlike a checkpoint it is computed
    once, and later passes read only the columns and partitions they need.
    """
    spark = df.sparkSession
    path = f"{_staging_folder(spark)}/{name}-{uuid.uuid4().hex}"
    writer = df.write.option("compression", "zstd")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def clear_staged(spark: SparkSession) -> None:
    """Delete what this application staged; call it when the results are written."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(_staging_folder(spark))
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def _staging_folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark).rstrip('/')}/staged-{spark.sparkContext.applicationId}"
