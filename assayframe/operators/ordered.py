"""Ranks, quantiles, running totals and islands over groups of any size.

A plain window sorts a whole group in one task. Here a group is first reduced to its distinct values,
then cut at approximate quantiles into bins; a window sees one bin at a time and takes the state of the
bins before it from a small per-bin table. Results are exact: the approximate quantiles only decide
where the cuts fall. The per-bin tables join by ordinary joins, so Spark broadcasts them only when
their measured size allows it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

BINS = 64  # the least number of bins; a session with more shuffle partitions gets one bin for each
MOST_BINS = 1024


def _probabilities(bins: int) -> list[float]:
    return [i / bins for i in range(1, bins)]


def add_bins(df: DataFrame, by: Sequence[str], value: str, bins: int = BINS) -> DataFrame:
    """Add ``_bin``: the number of approximate quantile cuts of the group below the value.

    The cuts are searched in two steps (every eighth, then the eight in between).
    """
    if bins == BINS:
        partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        bins = min(max(BINS, partitions), MOST_BINS)
    cuts = F.array_distinct(F.percentile_approx(F.col(value), _probabilities(bins), bins * 50))
    eighths = F.filter(F.transform("_cuts", lambda c, i: F.when(i % 8 == 7, c)), lambda c: c.isNotNull())
    edges = df.groupBy(*by).agg(cuts.alias("_cuts")).withColumn("_eighths", eighths)
    if by:
        searched = df.join(edges, list(by))
    else:
        found = edges.select(F.struct("_cuts", "_eighths").alias("_e")).scalar()
        searched = df.withColumn("_e", found).select(*df.columns, "_e._cuts", "_e._eighths")
    at = F.size(F.filter("_eighths", lambda c: c < F.col(value))) * 8
    searched = searched.withColumn("_from", at)
    rest = F.size(F.filter(F.slice("_cuts", F.col("_from") + 1, 8), lambda c: c < F.col(value)))
    return searched.withColumn("_bin", F.col("_from") + rest).drop("_cuts", "_eighths", "_from")


def distinct_counts(df: DataFrame, by: Sequence[str], value: str, weight: Column | None = None) -> DataFrame:
    """One row per group and value with ``n`` (rows, or the sum of ``weight``); nulls and NaN are left out."""
    kept = df.filter(F.col(value).isNotNull())
    if dict(df.dtypes)[value] in ("double", "float"):
        kept = kept.filter(~F.isnan(value))
    n = F.count(F.lit(1)) if weight is None else F.sum(weight)
    return kept.groupBy(*by, value).agg(n.alias("n"))


def running(counted: DataFrame, by: Sequence[str], value: str, bins: int = BINS) -> DataFrame:
    """Add ``below`` (weight of smaller values), ``upto`` (weight of values <= this one), ``total`` and ``_bin``.

    ``counted`` holds one row per group and value with weight ``n``.
    """
    binned = add_bins(counted, by, value, bins)
    in_group = Window.partitionBy(*by)
    per_bin = (
        binned.groupBy(*by, "_bin")
        .agg(F.sum("n").alias("_bin_n"))
        .withColumn("total", F.sum("_bin_n").over(in_group))
        .withColumn("_before", F.sum("_bin_n").over(in_group.orderBy("_bin")) - F.col("_bin_n"))
        .drop("_bin_n")
    )
    in_bin = Window.partitionBy(*by, "_bin").orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    return (
        binned.join(per_bin, [*by, "_bin"])
        .withColumn("upto", F.col("_before") + F.sum("n").over(in_bin))
        .withColumn("below", F.col("upto") - F.col("n"))
        .drop("_before")
    )


def value_ranks(df: DataFrame, by: Sequence[str], value: str, bins: int = BINS) -> DataFrame:
    """Per group and distinct value: ``n``, ``below``, ``upto``, ``total``."""
    return running(distinct_counts(df, by, value), by, value, bins).drop("_bin")


def suffix_min(df: DataFrame, by: Sequence[str], value: str, target: str, out: str) -> DataFrame:
    """``out`` = smallest ``target`` among the rows of the group whose ``value`` is at least this one.

    Needs the ``_bin`` column of :func:`running` and distinct values.
    """
    later = Window.partitionBy(*by).orderBy(F.desc("_bin")).rowsBetween(Window.unboundedPreceding, -1)
    per_bin = (
        df.groupBy(*by, "_bin")
        .agg(F.min(target).alias("_least"))
        .withColumn("_later", F.min("_least").over(later))
        .drop("_least")
    )
    here = Window.partitionBy(*by, "_bin").orderBy(F.desc(value)).rowsBetween(Window.unboundedPreceding, 0)
    return (
        df.join(per_bin, [*by, "_bin"])
        .withColumn(out, F.least(F.min(target).over(here), F.col("_later")))
        .drop("_later")
    )


def exact_quantiles(
    df: DataFrame, by: Sequence[str], value: str, quantiles: dict[str, float], bins: int = BINS
) -> DataFrame:
    """Exact quantiles (linear interpolation between order statistics) of groups of any size."""
    ranked = value_ranks(df, by, value, bins)
    picks = []
    for name, q in quantiles.items():
        position = (F.col("total") - 1) * F.lit(float(q))
        for side, at in (("lo", F.floor(position)), ("hi", F.ceil(position))):
            inside = (F.col("below") <= at) & (at < F.col("upto"))
            picks.append(F.max(F.when(inside, F.col(value))).alias(f"_{name}_{side}"))
    picked = ranked.groupBy(*by).agg(F.max("total").alias("total"), *picks)
    out = []
    for name, q in quantiles.items():
        position = (F.col("total") - 1) * F.lit(float(q))
        lo, hi = F.col(f"_{name}_lo"), F.col(f"_{name}_hi")
        out.append((lo + (hi - lo) * (position - F.floor(position))).alias(name))
    return picked.select(*by, *out)


def small_quantiles(value: Column | str, quantiles: Sequence[float], weight: Column | str | None = None) -> Column:
    """Exact quantiles as an aggregate, for groups whose number of distinct values is bounded."""
    if weight is None:
        return F.percentile(value, list(quantiles))
    return F.percentile(value, list(quantiles), F.col(weight) if isinstance(weight, str) else weight)


def island_starts(df: DataFrame, by: Sequence[str], at: str, gap, bins: int = BINS) -> DataFrame:
    """Add ``island``: 0, 1, … per group, a new one after a step larger than ``gap`` along ``at``.

    ``df`` holds one row per group and position (aggregate first). A hot group is cut into bins, and each
    bin only needs the last position and the number of islands of the bins before it.
    """
    binned = add_bins(df, by, at, bins)
    in_bin = Window.partitionBy(*by, "_bin").orderBy(at)
    order = Window.partitionBy(*by).orderBy("_bin")
    stepped = binned.withColumn("_prev", F.lag(at).over(in_bin)).withColumn(
        "_new", F.when(F.col(at) - F.col("_prev") > gap, 1).otherwise(0)
    )
    per_bin = (
        stepped.groupBy(*by, "_bin")
        .agg(F.min(at).alias("_first"), F.max(at).alias("_last"), F.sum("_new").alias("_inner"))
        .withColumn(
            "_opens", F.when(F.col("_first") - F.lag("_last").over(order) > gap, 1).otherwise(0)
        )
        .withColumn(
            "_base",
            F.sum(F.col("_opens") + F.col("_inner")).over(order) - F.col("_inner"),
        )
        .select(*by, "_bin", "_base")
    )
    upto = in_bin.rowsBetween(Window.unboundedPreceding, 0)
    return (
        stepped.withColumn("_run", F.sum("_new").over(upto))
        .join(per_bin, [*by, "_bin"])
        .withColumn("island", (F.col("_base") + F.col("_run")).cast("long"))
        .drop("_bin", "_prev", "_new", "_run", "_base")
    )
