"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession

# AQE turns small sides into broadcasts by their measured size, merges small shuffle partitions and
# splits skewed join partitions; the library relies on it and adds its own splitting where AQE has none.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.driver.memory": "8g",
}


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, **extra: str) -> SparkSession:
    """A local session for tests and bench.py; on a cluster the caller brings its own session."""
    builder = SparkSession.builder.master(f"local[{cpus}]").appName("assayframe")
    for key, value in {**SETTINGS, "spark.sql.shuffle.partitions": str(shuffle_partitions), **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_local_folder: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    Where it is unset, only a local session, whose one machine is driver and executor, gets a folder of its own; a
    cluster session is refused.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.split("[")[0] == "local":
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if not _local_folder:
        _local_folder.append(tempfile.mkdtemp(prefix="assayframe-"))
    return _local_folder[0]


def widen(df: DataFrame) -> DataFrame:
    """Deal the rows out when a scan has fewer tasks than the session has cores; large inputs stay as they are.

    For steps that do much work per row before their first shuffle.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
