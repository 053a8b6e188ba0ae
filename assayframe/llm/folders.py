"""Intermediate tables and files of the operators, in the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_own: dict[str, str] = {}


def shared(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``. Where it is unset, only a local session, which is one machine, gets its own."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = _own.setdefault("folder", "") or tempfile.mkdtemp(prefix="llm-")
        _own["folder"] = folder
    return folder.rstrip("/")


def new_folder(spark: SparkSession, kind: str) -> str:
    return f"{shared(spark)}/llm-{kind}-{uuid.uuid4().hex}"


def save(df: DataFrame, kind: str = "table") -> DataFrame:
    """Write a table to the shared folder and read it back: no lineage, nothing to recompute if an executor goes."""
    spark = df.sparkSession
    path = new_folder(spark, kind)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
