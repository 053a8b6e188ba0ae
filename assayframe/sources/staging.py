"""Saved intermediate results."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from ..session import shared_dir

_staged: list[str] = []


def new_path(spark: SparkSession, folder: str | None = None) -> str:
    """An unused path in a folder that driver and executors share (default: :func:`shared_dir`); noted for removal."""
    path = f"{(folder or shared_dir(spark)).rstrip('/')}/assayframe-{uuid.uuid4().hex}"
    _staged.append(path)
    return path


def stage(df: DataFrame, folder: str | None = None) -> DataFrame:
    """Write a table and read it back: later steps scan columns of files instead of repeating the work.

    The table goes to ``folder``, or to the cluster's shared checkpoint folder, so it outlives lost executors. The
    returned table has no lineage and a known size; its files stay until :func:`remove_staged`.
    """
    spark = df.sparkSession
    path = new_path(spark, folder)
    df.write.mode("errorifexists").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def remove_staged(spark: SparkSession) -> int:
    """Delete everything staged by this process, when no result built on it is needed any more; the number of paths."""
    count = len(_staged)
    while _staged:
        path = spark._jvm.org.apache.hadoop.fs.Path(_staged.pop())
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    return count
