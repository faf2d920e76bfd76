"""Tables between two jobs, in the folder that driver and executors share."""

from __future__ import annotations

import gc
import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_OWN: list[str] = []
#: Of files between jobs and of the store: ids are mostly hexadecimal, of which snappy saves nothing and this half.
COMPRESSION = "zstd"


def folder(spark: SparkSession) -> str:
    """The folder that the cluster names in spark.checkpoint.dir; only one machine (local mode, tests) may take a temporary one of its own."""
    if named := spark.conf.get("spark.checkpoint.dir", None):
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    if not _OWN:
        _OWN.append(tempfile.mkdtemp(prefix="provgraph-"))
    return _OWN[0]


def kept(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """A table written to the shared folder and read again, so that later jobs neither repeat its work nor see it change; and its path, for `removed`."""
    spark = df.sparkSession
    path = os.path.join(folder(spark), f"{name}-{uuid.uuid4().hex}")
    df.write.option("compression", COMPRESSION).parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def removed(spark: SparkSession, *paths: str) -> None:
    for path in paths:
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def swept(spark: SparkSession) -> None:
    """Let go of what jobs that are done have shuffled: Spark removes these files when the driver collects garbage, which on its own it may not do before the disk is full."""
    gc.collect()
    spark._jvm.System.gc()


def made(spark: SparkSession, path: str) -> str:
    """The path, as a folder that is there."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(at)
    return path


def moved(spark: SparkSession, path: str, to: str) -> None:
    """A folder under another name, if it is there: a part without rows has none."""
    at, then = (spark._jvm.org.apache.hadoop.fs.Path(p) for p in (path, to))
    fs = at.getFileSystem(spark._jsc.hadoopConfiguration())
    if fs.exists(at) and not fs.rename(at, then):
        raise OSError(f"{path} can't be named {to}")
