"""Two-group and several-group tests per feature, one shuffle each, all inside the JVM."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, functions as F

from ..functions.numeric import INF, label_direction, log2_ratio, nan_to_null, neg_log10, safe_gt, safe_lt
from ..functions.tails import f_upper, once, t_two_sided
from ..sources.staging import stage
from .adjust import adjust_bh
from .relational import top_up_down


def _two_groups(long: DataFrame, samples: DataFrame, levels: tuple[str, str], *, var: bool) -> DataFrame:
    v = nan_to_null("value")
    aggs = []
    for i, level in enumerate(levels, start=1):
        x = F.when(F.col("condition") == level, v)
        aggs += [F.count(x).alias(f"n{i}"), F.avg(x).alias(f"mean{i}")]
        if var:
            aggs.append(F.var_samp(x).alias(f"var{i}"))
    return long.join(samples.select("sample", "condition"), "sample").groupBy("feature").agg(*aggs)


def fold_change(long: DataFrame, samples: DataFrame, levels: tuple[str, str], cut: float = 2.0) -> DataFrame:
    """Ratio of the group means (first over second), its log2, and a flag from ``cut``-fold on."""
    g = _two_groups(long, samples, levels, var=False)
    out = g.withColumn("log2fc", log2_ratio("mean1", "mean2")).withColumn(
        "fc", F.when(F.col("log2fc") == INF, F.lit(INF)).when(F.col("log2fc") == -INF, F.lit(0.0)).otherwise(F.try_divide("mean1", "mean2"))
    )
    flag = F.abs(F.col("log2fc")) >= math.log2(cut)
    return out.select("feature", "mean1", "mean2", "fc", "log2fc", F.coalesce(flag, F.lit(False)).alias("flagged"))


def t_test(
    long: DataFrame, samples: DataFrame, levels: tuple[str, str], p_cut: float = 0.05, all_results: bool = True
) -> DataFrame:
    """Pooled-variance two-sample t per feature with BH adjustment."""
    g = _two_groups(long, samples, levels, var=True)
    df = F.col("n1") + F.col("n2") - 2
    pooled = F.try_divide((F.col("n1") - 1) * F.col("var1") + (F.col("n2") - 1) * F.col("var2"), df)
    se = F.sqrt(pooled * (1 / F.col("n1") + 1 / F.col("n2")))
    tested = (
        g.filter((F.col("n1") > 1) & (F.col("n2") > 1))
        .withColumn("df", df)
        .withColumn("t", F.when(se > 0, (F.col("mean1") - F.col("mean2")) / se))
        .withColumn("p", once(t_two_sided("t", F.col("df"))))
    )
    out = adjust_bh(stage(tested.select("feature", "t", "df", "p")), "p").withColumn("neg_log10p", neg_log10("p"))
    return out if all_results else out.filter(safe_lt("p", p_cut))


def anova_test(long: DataFrame, samples: DataFrame) -> DataFrame:
    """One-way F per feature over all conditions."""
    v = nan_to_null("value")
    groups = (
        long.join(samples.select("sample", "condition"), "sample")
        .groupBy("feature", "condition")
        .agg(F.count(v).alias("n"), F.avg(v).alias("m"), F.var_pop(v).alias("v"))
        .filter(F.col("n") > 0)
    )
    sums = groups.groupBy("feature").agg(
        F.count(F.lit(1)).alias("k"),
        F.sum("n").alias("total"),
        (F.sum(F.col("n") * F.col("m")) / F.sum("n")).alias("grand"),
        F.sum(F.col("n") * F.col("v")).alias("within"),
        F.collect_list(F.struct("n", "m")).alias("g"),
    )
    between = F.aggregate("g", F.lit(0.0), lambda a, x: a + x["n"] * (x["m"] - F.col("grand")) * (x["m"] - F.col("grand")))
    d1, d2 = F.col("k") - 1, F.col("total") - F.col("k")
    f = F.when((d1 > 0) & (d2 > 0) & (F.col("within") > 0), (between / d1) / (F.col("within") / d2))
    out = sums.withColumn("f", f).withColumn("d1", d1).withColumn("d2", d2)
    p = F.when(F.col("f").isNotNull(), f_upper("f", F.col("d1"), F.col("d2")))
    return adjust_bh(stage(out.select("feature", "f", "d1", "d2", once(p).alias("p"))), "p")


def volcano(
    changes: DataFrame, tests: DataFrame, fc_cut: float = 2.0, p_cut: float = 0.1, all_results: bool = False
) -> DataFrame:
    """Fold change joined to the raw p, with both cuts."""
    both = changes.select("feature", "fc", "log2fc").join(tests.select("feature", "p"), "feature")
    both = both.withColumn("neg_log10p", neg_log10("p"))
    hit = safe_gt(F.abs(F.col("log2fc")) + 1e-12, math.log2(fc_cut)) & safe_lt("p", p_cut)
    if all_results:
        return both.withColumn("significant", F.coalesce(hit, F.lit(False)))
    return both.filter(hit)


def volcano_table(results: DataFrame, cut: float = 1.0, k: int = 5) -> DataFrame:
    """Points of a volcano plot: -log10 padj, direction class, and a label on the k best of each side."""
    results = stage(results)
    labels = top_up_down(results, k, cut=cut).select("feature", F.col("feature").cast("string").alias("label"))
    return (
        results.withColumn("neg_log10_padj", neg_log10("padj"))
        .withColumn("direction", label_direction("log2fc", cut, -cut))
        .join(labels, "feature", "left")
        .select("feature", "log2fc", "padj", "neg_log10_padj", "direction", "label")
    )


def top_by_anova(tests: DataFrame, k: int = 25) -> DataFrame:
    """The k features with the smallest p."""
    return tests.filter(F.col("p").isNotNull()).orderBy("p", "feature").limit(k)
