"""Spark sessions with the settings that the operators assume."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession


def session(app: str = "tamarack", master: str | None = None, shuffle_partitions: int | None = None, **conf: str) -> SparkSession:
    """Adaptive execution, UTC, Arrow. A cluster's own settings win unless given here."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    own = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.serializer": "org.apache.spark.serializer.KryoSerializer",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
    }
    if shuffle_partitions:
        own["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    for k, v in {**own, **conf}.items():
        b = b.config(k, v)
    return b.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``. Where that is unset, a local session, as in tests, uses a folder of this machine; on a
    cluster that is an error, as executors do not see each other's files."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("spark.checkpoint.dir is not set: it must name a folder that the driver and all executors share")
        path = f"file://{tempfile.gettempdir()}/tamarack-{os.getuid()}"
        spark.conf.set("spark.checkpoint.dir", path)
    return path.rstrip("/")


def pinned(df: DataFrame) -> DataFrame:
    """``df`` as a checkpoint in the shared folder. For columns that another evaluation could give other values, such as partition
    numbers, and for rows that several outputs read."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_folder(spark))
    return df.checkpoint()


def spread(df: DataFrame) -> DataFrame:
    """A scan of fewer splits than there are cores is dealt to all of them, as the text work behind it costs far more than its few bytes.
    A table of more splits, any large one, is left as it is."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
