"""Writers."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "errorifexists") -> None:
    if fmt == "csv":
        df.write.mode(mode).csv(path, header=True)
    else:
        df.write.mode(mode).format(fmt).save(path)


def to_wide(long: DataFrame, samples: list | None = None) -> DataFrame:
    """Long to wide: a column per sample. The sample list is read from the table if not given."""
    if samples is None:
        samples = [r[0] for r in long.select("sample").distinct().orderBy("sample").collect()]
    return long.groupBy("feature").pivot("sample", samples).agg(F.first("value"))


def write_matrix(long: DataFrame, path: str, samples: list | None = None, mode: str = "errorifexists") -> None:
    to_wide(long, samples).write.mode(mode).csv(path, header=True)


def write_annotations(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Annotated peak lists, one folder per polarity."""
    df.write.mode(mode).partitionBy("polarity").parquet(path)


def write_by_class(reads: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Reads with their class, one folder per sample, class and mate."""
    reads.write.mode(mode).partitionBy("sample", "class", "mate").parquet(path)
