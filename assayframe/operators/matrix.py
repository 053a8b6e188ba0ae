"""The long matrix ``(feature, sample, value)`` and its preparation.

One row per cell. A feature holds at most as many cells as there are samples, so windows over one feature
are small; everything that runs over a whole sample goes through partial aggregation or ``ordered``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..functions.numeric import nan_to_null
from .ordered import exact_quantiles, running, small_quantiles

FIVE_NUMBERS = {"min": 0.0, "q1": 0.25, "median": 0.5, "q3": 0.75, "max": 1.0}


def sample_list(samples: DataFrame):
    """All sample ids in order, as one array (a scalar subquery, read once)."""
    return samples.agg(F.array_sort(F.collect_set("sample")).alias("s")).scalar()


def sum_cells(rows: DataFrame, feature: str, sample: str, value: str) -> DataFrame:
    """Rows to matrix cells: the sum per feature and sample."""
    return rows.groupBy(F.col(feature).alias("feature"), F.col(sample).alias("sample")).agg(F.sum(value).alias("value"))


def complete_grid(long: DataFrame, samples: DataFrame) -> DataFrame:
    """Every feature × sample cell, null where the matrix has none."""
    cells = (
        long.select("feature")
        .distinct()
        .withColumn("_samples", sample_list(samples))
        .select("feature", F.explode("_samples").alias("sample"))
    )
    return cells.join(long.select("feature", "sample", "value"), ["feature", "sample"], "left")


def merge_counts(long: DataFrame, samples: DataFrame) -> DataFrame:
    """The outer merge of per-sample count tables; the long form needs only its gaps filled with null."""
    return complete_grid(long, samples)


def sum_by_symbol(long: DataFrame, samples: DataFrame, xref: DataFrame) -> DataFrame:
    """Counts per gene symbol: genes missing in any sample or without a symbol go first, then the rest add up."""
    from .relational import lookup_first

    n_samples = samples.agg(F.count_distinct("sample")).scalar()
    complete = (
        long.filter(nan_to_null("value").isNotNull())
        .groupBy("feature")
        .agg(F.count_distinct("sample").alias("n"))
        .filter(F.col("n") == n_samples)
        .select("feature")
    )
    named = lookup_first(complete, xref, "feature", "symbol").filter(F.col("symbol").isNotNull())
    return (
        long.join(named, "feature")
        .groupBy("symbol", "sample")
        .agg(F.sum("value").alias("value"))
        .withColumnRenamed("symbol", "feature")
    )


def size_factors(long: DataFrame, samples: DataFrame, bins: int = 64) -> DataFrame:
    """Median-of-ratios size factor per sample, over the features positive in every sample."""
    n_samples = samples.agg(F.count_distinct("sample")).scalar()
    logs = long.filter(F.col("value") > 0).select("feature", "sample", F.ln("value").alias("_ln"))
    means = (
        logs.groupBy("feature")
        .agg(F.avg("_ln").alias("_mean"), F.count(F.lit(1)).alias("_n"))
        .filter(F.col("_n") == n_samples)
        .select("feature", "_mean")
    )
    ratios = logs.join(means, "feature").select("sample", (F.col("_ln") - F.col("_mean")).alias("_d"))
    medians = exact_quantiles(ratios, ["sample"], "_d", {"_m": 0.5}, bins)
    return medians.select("sample", F.exp("_m").alias("size_factor"))


def normalised_counts(long: DataFrame, factors: DataFrame) -> DataFrame:
    return long.join(factors, "sample").select("feature", "sample", (F.col("value") / F.col("size_factor")).alias("value"))


def check_matrix(long: DataFrame, samples: DataFrame) -> DataFrame:
    """Sanity report as (check, value): sizes, missing and negative cells, empty and constant features."""
    v = nan_to_null("value")
    n_samples = samples.agg(F.count_distinct("sample")).scalar()
    smallest = samples.groupBy("condition").agg(F.count_distinct("sample").alias("n")).agg(F.min("n")).scalar()
    per_feature = long.groupBy("feature").agg(
        F.count(v).alias("n"),
        F.min(v).alias("lo"),
        F.max(v).alias("hi"),
        F.count(F.when(v < 0, 1)).alias("neg"),
        F.count(F.when(v == 0, 1)).alias("zero"),
    )
    report = per_feature.agg(
        F.count(F.lit(1)).alias("features"),
        F.sum("n").alias("values"),
        F.sum("neg").alias("negative"),
        F.sum("zero").alias("zeros"),
        F.count(F.when(F.col("n") == 0, 1)).alias("empty_features"),
        F.count(F.when(F.col("lo") == F.col("hi"), 1)).alias("constant_features"),
    ).withColumns({"samples": n_samples, "smallest_group": smallest})
    report = report.withColumn("missing", F.col("features") * F.col("samples") - F.col("values")).withColumn(
        "missing_share", F.try_divide(F.col("missing"), F.col("features") * F.col("samples"))
    )
    names = report.columns
    return report.select([F.col(c).cast("double").alias(c) for c in names]).unpivot([], names, "check", "value")


def replace_min(grid: DataFrame, fraction: float = 0.2) -> DataFrame:
    """Missing and zero cells become a fraction of the feature's smallest positive value."""
    v = nan_to_null("value")
    least = F.min(F.when(v > 0, v)).over(Window.partitionBy("feature"))
    return grid.withColumn("value", F.when(v.isNull() | (v == 0), least * fraction).otherwise(v))


def filter_variable(
    long: DataFrame, drop_share: float = 0.25, mean_cut: float = 0.0, qc: DataFrame | None = None, rsd_cut: float | None = None
) -> DataFrame:
    """Drop the share of features with the lowest interquartile range, and those with a mean below the cut.

    With ``qc`` (the cells of the quality-control samples) features whose relative standard deviation
    there is above ``rsd_cut`` are dropped as well.
    """
    v = nan_to_null("value")
    spread = long.groupBy("feature").agg(small_quantiles(v, [0.25, 0.75]).alias("_q"), F.avg(v).alias("_mean"))
    spread = spread.select("feature", "_mean", (F.get("_q", 1) - F.get("_q", 0)).alias("_iqr"))
    counted = spread.filter(F.col("_iqr").isNotNull()).groupBy("_iqr").agg(F.count(F.lit(1)).alias("n"))
    rank = running(counted, [], "_iqr").filter(F.col("below") >= drop_share * (F.col("total") - 1)).select("_iqr")
    kept = spread.filter(F.col("_mean") >= mean_cut).join(rank, "_iqr").select("feature")
    if qc is not None and rsd_cut is not None:
        steady = qc.groupBy("feature").agg((F.stddev_samp(v) / F.avg(v)).alias("_rsd")).filter(F.col("_rsd") <= rsd_cut)
        kept = kept.join(steady.select("feature"), "feature")
    return long.join(kept, "feature", "left_semi")


def log_norm(long: DataFrame) -> DataFrame:
    """Generalised log10((x + sqrt(x^2 + a^2)) / 2), a = a tenth of the smallest non-zero magnitude of the table."""
    v = nan_to_null("value")
    a = long.agg(F.min(F.when(v != 0, F.abs(v))) / 10).scalar()
    return long.withColumn("_a", a).withColumn(
        "value", F.log10((v + F.sqrt(v * v + F.col("_a") * F.col("_a"))) / 2)
    ).drop("_a")


def row_zscore(long: DataFrame) -> DataFrame:
    """Per-feature (x - mean) / sd; null for a constant feature."""
    w = Window.partitionBy("feature")
    v = nan_to_null("value")
    sd = F.stddev_samp(v).over(w)
    return long.withColumn("z", F.when(sd > 0, (v - F.avg(v).over(w)) / sd))


def group_means(long: DataFrame, samples: DataFrame) -> DataFrame:
    """Mean, standard deviation and number of values per feature and condition."""
    v = nan_to_null("value")
    return (
        long.join(samples.select("sample", "condition"), "sample")
        .groupBy("feature", "condition")
        .agg(F.avg(v).alias("mean"), F.stddev_samp(v).alias("sd"), F.count(v).alias("n"))
    )


def normalisation_summary(stages: dict[str, DataFrame], bins: int = 64) -> DataFrame:
    """Five-number summary, mean and sd of every sample and every feature, per processing stage."""
    v = nan_to_null("value")
    out = None
    for stage, long in stages.items():
        moments = [F.avg(v).alias("mean"), F.stddev_samp(v).alias("sd")]
        per_sample = exact_quantiles(long, ["sample"], "value", FIVE_NUMBERS, bins).join(
            long.groupBy("sample").agg(*moments), "sample"
        )
        per_feature = long.groupBy("feature").agg(small_quantiles(v, list(FIVE_NUMBERS.values())).alias("_q"), *moments)
        rows = [
            table.select(
                F.lit(stage).alias("stage"),
                F.lit(axis).alias("axis"),
                F.col(axis).cast("string").alias("id"),
                *numbers,
                "mean",
                "sd",
            )
            for axis, table, numbers in (
                ("sample", per_sample, [F.col(c) for c in FIVE_NUMBERS]),
                ("feature", per_feature, [F.get("_q", i).alias(c) for i, c in enumerate(FIVE_NUMBERS)]),
            )
        ]
        both = rows[0].unionByName(rows[1])
        out = both if out is None else out.unionByName(both)
    return out


def format_peaks(long: DataFrame, samples: DataFrame, max_missing: float = 1.0) -> DataFrame:
    """Keep the features whose share of missing cells is at most ``max_missing`` (1 keeps all)."""
    n_samples = samples.agg(F.count_distinct("sample")).scalar()
    seen = long.groupBy("feature").agg(F.count(nan_to_null("value")).alias("_n"))
    kept = seen.withColumn("_all", n_samples).filter(1 - F.col("_n") / F.col("_all") <= max_missing)
    return long.join(kept.select("feature"), "feature", "left_semi")


def lfc_matrix(integrated: DataFrame) -> DataFrame:
    """Pathway × (gene, compound) means, the table behind the heat map."""
    return integrated.select("pathway_name", "avg_gene_lfc", "avg_compound_lfc")
