"""Shared plumbing: the shared work folder, staged tables, files published to executors, text splitting."""

from __future__ import annotations

import gc
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tamarack.session import shared_folder

#: The white space of every contract here: space and 0x09-0x0D.
WS = " \t\n\x0b\x0c\r"


def workdir(spark: SparkSession) -> str:
    """The shared folder of ``spark.checkpoint.dir``; an error on a cluster where that is unset."""
    return shared_folder(spark)


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts the lineage and survives lost executors."""
    spark = df.sparkSession
    path = f"{workdir(spark)}/tamarack-{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def dropped(*tables: DataFrame) -> None:
    """Delete staged tables that nothing reads any more."""
    for df in tables:
        spark = df.sparkSession
        for top in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            at = spark._jvm.org.apache.hadoop.fs.Path(top)
            at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def released(spark: SparkSession) -> None:
    """Let Spark's cleaner delete the shuffle files of plans that staged tables have replaced."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def published(spark: SparkSession, name: str, data: bytes) -> str:
    """Write bytes of bounded size to the shared folder; every executor gets a copy. Returns the name for ``SparkFiles.get``."""
    name = f"{name}-{uuid.uuid4().hex}"
    at = spark._jvm.org.apache.hadoop.fs.Path(f"{workdir(spark)}/tamarack-files/{name}")
    out = at.getFileSystem(spark._jsc.hadoopConfiguration()).create(at)
    try:
        for k in range(0, len(data), 1 << 20):
            out.write(bytearray(data[k : k + (1 << 20)]))
    finally:
        out.close()
    spark.sparkContext.addFile(at.toString())
    return name


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
