"""Multiple-testing correction."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from .ordered import BINS, distinct_counts, running, suffix_min


def _on(left: DataFrame, right: DataFrame, keys: Sequence[str]):
    return [left[k].eqNullSafe(right[f"_r_{k}"]) for k in keys]


def bh_by_value(df: DataFrame, p: str, by: Sequence[str] = (), out: str = "padj", bins: int = BINS) -> DataFrame:
    """Benjamini-Hochberg value of every distinct p per group; missing p are not counted as tests."""
    ranked = running(distinct_counts(df, by, p), by, p, bins)
    raw = ranked.withColumn("_raw", F.col(p) * F.col("total") / F.col("upto"))
    return suffix_min(raw, by, p, "_raw", out).select(*by, p, F.least(F.col(out), F.lit(1.0)).alias(out))


def adjust_bh(df: DataFrame, p: str, by: Sequence[str] = (), out: str = "padj", bins: int = BINS) -> DataFrame:
    """Add the Benjamini-Hochberg adjusted p-value; a missing p keeps a null.

    Equal p share one rank, so the correction runs on distinct p-values and comes back by a join on
    (group, p): the rows of a large group spread over its p-values.
    """
    values = bh_by_value(df, p, by, out, bins)
    values = values.select(*[F.col(k).alias(f"_r_{k}") for k in [*by, p]], out)
    return df.join(values, _on(df, values, [*by, p]), "left").drop(*[f"_r_{k}" for k in [*by, p]])


def q_value(
    df: DataFrame, p: str, by: Sequence[str] = (), out: str = "qvalue", cut: float = 0.05, bins: int = BINS
) -> DataFrame:
    """Add Storey's q: the share of true nulls, estimated above ``cut``, times the BH value."""
    valid = F.col(p).isNotNull() & ~F.isnan(p)
    share = F.least(F.lit(1.0), F.avg(F.when(valid, (F.col(p) >= cut).cast("double"))) / (1 - cut))
    adjusted = adjust_bh(df, p, by, "_bh", bins)
    nulls = df.groupBy(*by).agg(share.alias("_pi0"))
    if by:
        scaled = adjusted.join(nulls, list(by), "left")
    else:
        scaled = adjusted.withColumn("_pi0", nulls.scalar())
    return scaled.withColumn(out, F.col("_bh") * F.col("_pi0")).drop("_bh", "_pi0")
