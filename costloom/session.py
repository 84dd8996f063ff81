"""Session settings and the shared checkpoint folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def get_spark(app: str = "costloom", **conf: str) -> SparkSession:
    """Return the running session, or start one.

    Master, memory and partition counts belong to the cluster (spark-submit); only settings that
    results and plans depend on are fixed here, and the recording of Python call sites, which
    about doubles the time to build a plan, is switched off.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Name of the checkpoint folder: `spark.checkpoint.dir`, or one in the warehouse.

    On a cluster a warehouse on the driver's own disk is no place that executors share, so it is refused.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named
    warehouse = spark.conf.get("spark.sql.warehouse.dir")
    if warehouse.startswith("file:") and not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set spark.checkpoint.dir to a folder that all executors share; the warehouse is {warehouse}")
    folder = warehouse.rstrip("/") + "/_checkpoints"
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def settle(df: DataFrame) -> DataFrame:
    """Write a frame that several consumers read to the shared folder, and read it back.

    The work up to here is then done once; what follows starts from stored columns with known
    sizes, and a lost executor costs only a re-read.
    """
    folder = ensure_checkpoint_dir(df.sparkSession).rstrip("/")
    path = f"{folder}/costloom-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
