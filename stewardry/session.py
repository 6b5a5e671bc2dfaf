"""Session defaults and the shared folder for data that must outlive an executor."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


_CLUSTER = {
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "16000",
    "spark.sql.files.maxPartitionBytes": str(64 * 1024 * 1024),
}


def build_session(app: str = "stewardry", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings this library is tuned for; `conf` wins over them.

    Adaptive execution splits skewed join partitions and merges small reduce partitions;
    on a cluster it starts from many, so that even a shuffle of tens of terabytes has
    partitions that fit into memory. Scans are cut small, as text work takes long per byte.
    """
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # Call sites kept for error messages double the time long expressions take to build.
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        **{key.replace("__", "."): value for key, value in conf.items()},
    }
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    if not spark.sparkContext.master.startswith("local"):
        for key, value in _CLUSTER.items():
            if key not in settings:
                spark.conf.set(key, value)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach: the one the cluster names.

    Only a local session, as in tests, may fall back to a folder of this machine.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
    folder = tempfile.mkdtemp(prefix="stewardry-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path in the shared folder."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, label: str) -> DataFrame:
    """`df` written to the shared folder and read back.

    For results that several later steps need: they are computed once, and a lost
    executor costs no more than reading them again.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
