"""Queries: matrix preparation, tests per feature, components."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.numeric import log2p1
from ..operators import components, contrasts, matrix, relational, similarity
from ..operators.adjust import adjust_bh, q_value
from . import roles
from .catalog import query, rounded
from .roles import LEVELS, with_roles

TT = "cells samples grid filled offset_a normed stats tt pv"


def _tests(spark, sf):
    return contrasts.t_test(roles.normed(spark, sf), roles.samples(spark, sf), LEVELS)


def _changes(spark, sf):
    return contrasts.fold_change(roles.filled(spark, sf), roles.samples(spark, sf), LEVELS)


def _factors(spark, sf):
    return matrix.size_factors(roles.cells(spark, sf), roles.samples(spark, sf))


def _counts(spark, sf):
    return matrix.normalised_counts(roles.cells(spark, sf), _factors(spark, sf))


def results(spark, sf):
    """The study result: feature, log2fc, p, padj."""
    both = _changes(spark, sf).select("feature", "log2fc").join(_tests(spark, sf).select("feature", "p", "padj"), "feature")
    return both


@query("complete_grid", with_roles("cells samples grid", "SELECT * FROM grid"))
def complete_grid(spark, sf):
    return roles.grid(spark, sf)


@query("merge_counts", with_roles("cells samples grid", "SELECT * FROM grid"))
def merge_counts(spark, sf):
    return matrix.merge_counts(roles.cells(spark, sf), roles.samples(spark, sf))


@query(
    "sum_by_symbol",
    with_roles(
        "cells samples",
        """SELECT p_type AS feature, sample, round(sum(value), 6) AS value FROM cells JOIN part ON p_partkey = feature
        WHERE feature IN (SELECT feature FROM cells GROUP BY 1 HAVING count(value) = (SELECT count(*) FROM samples)) GROUP BY 1, 2""",
    ),
)
def sum_by_symbol(spark, sf):
    xref = roles.table(spark, sf, "part").select(
        F.col("p_partkey").alias("feature"), F.col("p_type").alias("symbol"), F.col("p_partkey").alias("ord")
    )
    return rounded(matrix.sum_by_symbol(roles.cells(spark, sf), roles.samples(spark, sf), xref))


@query("size_factors", with_roles("cells samples factors", "SELECT sample, round(size_factor, 6) AS size_factor FROM factors"))
def size_factors(spark, sf):
    return rounded(_factors(spark, sf))


@query("normalised_counts", with_roles("cells samples factors counts", "SELECT feature, sample, round(value, 6) AS value FROM counts"))
def normalised_counts(spark, sf):
    return rounded(_counts(spark, sf))


@query("log2p1", with_roles("cells samples factors counts", "SELECT feature, sample, round(log2(value + 1), 6) AS value FROM counts"))
def log2p1_query(spark, sf):
    return rounded(_counts(spark, sf).withColumn("value", log2p1("value")))


@query(
    "check_matrix",
    with_roles(
        "cells samples",
        """, f AS (SELECT feature, count(value) AS n, min(value) AS lo, max(value) AS hi, count(*) FILTER (value < 0) AS neg, count(*) FILTER (value = 0) AS zero FROM cells GROUP BY 1),
        r AS (SELECT CAST(count(*) AS DOUBLE) AS features, CAST(sum(n) AS DOUBLE) AS "values", CAST(sum(neg) AS DOUBLE) AS negative, CAST(sum(zero) AS DOUBLE) AS zeros,
          CAST(count(*) FILTER (n = 0) AS DOUBLE) AS empty_features, CAST(count(*) FILTER (lo = hi) AS DOUBLE) AS constant_features,
          (SELECT CAST(count(*) AS DOUBLE) FROM samples) AS samples,
          (SELECT CAST(min(n) AS DOUBLE) FROM (SELECT count(*) AS n FROM samples GROUP BY condition)) AS smallest_group FROM f),
        s AS (SELECT *, features * samples - "values" AS missing FROM r),
        u AS (SELECT *, round(missing / (features * samples), 6) AS missing_share FROM s)
        SELECT name AS "check", value FROM (UNPIVOT u ON COLUMNS(*) INTO NAME name VALUE value)""",
    ).replace("\n, f AS", ",\nf AS"),
)
def check_matrix(spark, sf):
    return rounded(matrix.check_matrix(roles.cells(spark, sf), roles.samples(spark, sf)))


@query("replace_min", with_roles("cells samples grid filled", "SELECT feature, sample, round(value, 6) AS value FROM filled"))
def replace_min(spark, sf):
    return rounded(roles.filled(spark, sf))


@query(
    "filter_variable",
    with_roles(
        "cells samples grid filled",
        """, i AS (SELECT feature, quantile_cont(value, 0.75) - quantile_cont(value, 0.25) AS iqr, avg(value) AS m FROM filled GROUP BY 1),
        k AS (SELECT feature FROM (SELECT feature, m, percent_rank() OVER (ORDER BY iqr) AS pr FROM i) WHERE pr >= 0.25 AND m >= 0)
        SELECT feature, sample, round(value, 6) AS value FROM filled JOIN k USING (feature)""",
    ).replace("\n, i AS", ",\ni AS"),
)
def filter_variable(spark, sf):
    return rounded(matrix.filter_variable(roles.filled(spark, sf)))


@query("log_norm", with_roles("cells samples grid filled offset_a normed", "SELECT feature, sample, round(value, 6) AS value FROM normed"))
def log_norm(spark, sf):
    return rounded(roles.normed(spark, sf))


@query(
    "row_zscore",
    with_roles(
        "cells samples grid filled offset_a normed",
        """SELECT feature, sample, round(value, 6) AS value, CASE WHEN stddev_samp(value) OVER w > 0 THEN
        round((value - avg(value) OVER w) / stddev_samp(value) OVER w, 6) END AS z FROM normed WINDOW w AS (PARTITION BY feature)""",
    ),
)
def row_zscore(spark, sf):
    return rounded(matrix.row_zscore(roles.normed(spark, sf)))


@query(
    "group_means",
    with_roles(
        "cells samples grid filled",
        "SELECT feature, condition, round(avg(value), 6) AS mean, round(stddev_samp(value), 6) AS sd, count(value) AS n FROM filled JOIN samples USING (sample) GROUP BY 1, 2",
    ),
)
def group_means(spark, sf):
    return rounded(matrix.group_means(roles.filled(spark, sf), roles.samples(spark, sf)))


def _summary_sql() -> str:
    parts = []
    for stage in ("filled", "normed"):
        for axis in ("sample", "feature"):
            quantiles = ", ".join(
                f'round(quantile_cont(value, {q}), 5) AS "{c}"'
                for c, q in (("min", 0.0), ("q1", 0.25), ("median", 0.5), ("q3", 0.75), ("max", 1.0))
            )
            parts.append(
                f"SELECT '{stage}' AS stage, '{axis}' AS axis, CAST({axis} AS VARCHAR) AS id, {quantiles}, "
                f"round(avg(value), 5) AS mean, round(stddev_samp(value), 5) AS sd FROM {stage} GROUP BY {axis}"
            )
    return with_roles("cells samples grid filled offset_a normed", " UNION ALL ".join(parts))


@query("normalisation_summary", _summary_sql())
def normalisation_summary(spark, sf):
    return rounded(matrix.normalisation_summary({"filled": roles.filled(spark, sf), "normed": roles.normed(spark, sf)}), 5)


@query(
    "format_peaks",
    with_roles(
        "cells samples",
        """SELECT feature, sample, value FROM cells WHERE feature IN (SELECT feature FROM cells GROUP BY 1
        HAVING 1 - count(value) / (SELECT count(*) FROM samples) <= 0.1)""",
    ),
)
def format_peaks(spark, sf):
    return matrix.format_peaks(roles.cells(spark, sf), roles.samples(spark, sf), max_missing=0.1)


# --- tests ---------------------------------------------------------------------------------------


@query(
    "fold_change",
    with_roles(
        "cells samples grid filled fc",
        "SELECT feature, round(m1, 6) AS mean1, round(m2, 6) AS mean2, round(fc, 6) AS fc, round(log2fc, 6) AS log2fc, abs(log2fc) >= 1 AS flagged FROM fc",
    ),
)
def fold_change(spark, sf):
    return rounded(_changes(spark, sf))


@query(
    "t_test",
    with_roles(
        TT + " padj",
        "SELECT feature, round(t, 6) AS t, df, round(p, 6) AS p, round(padj, 6) AS padj, round(-log10(p), 5) AS neg_log10p FROM padj",
    ),
)
def t_test(spark, sf):
    out = _tests(spark, sf)
    return out.select(
        "feature",
        F.round("t", 6).alias("t"),
        "df",
        F.round("p", 6).alias("p"),
        F.round("padj", 6).alias("padj"),
        F.round("neg_log10p", 5).alias("neg_log10p"),
    )


@query(
    "anova_test",
    with_roles(
        TT + " padj",
        "SELECT feature, round(t * t, 6) AS f, CAST(1 AS BIGINT) AS d1, CAST(6 AS BIGINT) AS d2, round(p, 6) AS p, round(padj, 6) AS padj FROM padj",
    ),
)
def anova_test(spark, sf):
    return rounded(contrasts.anova_test(roles.normed(spark, sf), roles.samples(spark, sf)))


@query("adjust_bh", with_roles(TT + " padj", "SELECT feature, round(p, 6) AS p, round(padj, 6) AS padj FROM padj"))
def adjust_bh_query(spark, sf):
    tested = _tests(spark, sf).select("feature", "p")
    return rounded(adjust_bh(tested, "p"))


@query(
    "adjust_bh_grouped",
    """SELECT event_id, event_type, round(p, 6) AS p, round(least(1, min(p * m / r) OVER (PARTITION BY event_type ORDER BY p DESC)), 6) AS padj
    FROM (SELECT event_id, event_type, value / 500 AS p, count(*) OVER (PARTITION BY event_type) AS m,
      row_number() OVER (PARTITION BY event_type ORDER BY value, event_id) AS r0,
      count(*) OVER (PARTITION BY event_type ORDER BY value) AS r FROM events)""",
)
def adjust_bh_grouped(spark, sf):
    rows = roles.table(spark, sf, "events").select("event_id", "event_type", (F.col("value") / 500).alias("p"))
    return rounded(adjust_bh(rows, "p", ["event_type"]))


@query(
    "q_value",
    with_roles(
        TT + " padj",
        "SELECT feature, round(p, 6) AS p, round(padj * least(1, (SELECT avg(CASE WHEN p >= 0.05 THEN 1.0 ELSE 0.0 END) FROM padj) / 0.95), 6) AS qvalue FROM padj",
    ),
)
def q_value_query(spark, sf):
    return rounded(q_value(_tests(spark, sf).select("feature", "p"), "p"))


@query(
    "volcano",
    with_roles(
        TT + " fc",
        """SELECT feature, round(fc, 6) AS fc, round(log2fc, 6) AS log2fc, round(p, 6) AS p, round(-log10(p), 5) AS neg_log10p
        FROM fc JOIN pv USING (feature) WHERE abs(log2fc) >= 1 - 1e-12 AND p < 0.1""",
    ),
)
def volcano(spark, sf):
    out = contrasts.volcano(_changes(spark, sf), _tests(spark, sf))
    return rounded(out.withColumn("neg_log10p", F.round("neg_log10p", 5)))


VOLCANO_TABLE = with_roles(
    TT + " padj fc",
    """, r AS (SELECT feature, log2fc, padj FROM fc JOIN padj USING (feature)),
    top AS ((SELECT feature FROM r WHERE log2fc > 0.5 ORDER BY round(padj, 9), feature LIMIT 5) UNION ALL (SELECT feature FROM r WHERE log2fc < -0.5 ORDER BY round(padj, 9), feature LIMIT 5))
    SELECT feature, round(log2fc, 6) AS log2fc, round(padj, 6) AS padj, round(-log10(padj), 5) AS neg_log10_padj,
      CASE WHEN log2fc > 0.5 THEN 'Upregulated' WHEN log2fc < -0.5 THEN 'Downregulated' ELSE 'Not Significant' END AS direction,
      CASE WHEN feature IN (SELECT feature FROM top) THEN CAST(feature AS VARCHAR) END AS label FROM r""",
).replace("\n, r AS", ",\nr AS")


@query("volcano_table", VOLCANO_TABLE)
def volcano_table(spark, sf):
    shown = results(spark, sf).withColumn("padj", F.round("padj", 9))
    out = contrasts.volcano_table(shown, cut=0.5)
    return rounded(out.withColumn("neg_log10_padj", F.round("neg_log10_padj", 5)))


@query(
    "significant",
    with_roles(
        TT + " padj fc",
        "SELECT feature, round(log2fc, 6) AS log2fc, round(p, 6) AS p, round(padj, 6) AS padj FROM fc JOIN padj USING (feature) WHERE padj < 0.9 AND abs(log2fc) > 1",
    ),
)
def significant(spark, sf):
    return rounded(relational.significant(results(spark, sf), p_cut=0.9))


@query("top_features", with_roles(TT, "SELECT feature, round(p, 6) AS p FROM pv ORDER BY round(p, 9), feature LIMIT 25"))
def top_features(spark, sf):
    tests = _tests(spark, sf).select("feature", F.round("p", 9).alias("p"))
    return rounded(relational.top_features(tests, 25, "p"))


@query(
    "top_features_matrix",
    with_roles(
        TT + " factors counts",
        """SELECT feature, sample, round(log2(value + 1), 6) AS value FROM counts
        WHERE feature IN (SELECT feature FROM pv ORDER BY round(p, 9), feature LIMIT 25)""",
    ),
)
def top_features_matrix(spark, sf):
    """The matrix behind the heat map of the top features."""
    tests = _tests(spark, sf).select("feature", F.round("p", 9).alias("p"))
    top = relational.top_features(tests, 25, "p")
    return rounded(_counts(spark, sf).withColumn("value", log2p1("value")).join(top.select("feature"), "feature", "left_semi"))


@query(
    "top_up_down",
    with_roles(
        TT + " fc",
        """, r AS (SELECT feature, log2fc, p FROM fc JOIN pv USING (feature))
        (SELECT feature, round(log2fc, 6) AS log2fc, round(p, 6) AS p, 'Upregulated' AS direction FROM r WHERE log2fc > 1 ORDER BY round(r.p, 9), feature LIMIT 5)
        UNION ALL (SELECT feature, round(log2fc, 6) AS log2fc, round(p, 6) AS p, 'Downregulated' AS direction FROM r WHERE log2fc < -1 ORDER BY round(r.p, 9), feature LIMIT 5)""",
    ).replace("\n, r AS", ",\nr AS"),
)
def top_up_down(spark, sf):
    shown = results(spark, sf).select("feature", "log2fc", F.round("p", 9).alias("p"))
    return rounded(relational.top_up_down(shown, 5, "p"))


@query("top_by_anova", with_roles(TT, "SELECT feature, round(t * t, 6) AS f, round(p, 6) AS p FROM pv ORDER BY round(pv.p, 9), feature LIMIT 25"))
def top_by_anova(spark, sf):
    tests = contrasts.anova_test(roles.normed(spark, sf), roles.samples(spark, sf))
    return rounded(contrasts.top_by_anova(tests.select("feature", "f", F.round("p", 9).alias("p"))))


# --- similarity and components -------------------------------------------------------------------


@query(
    "sample_correlation",
    with_roles(
        "cells samples grid filled offset_a normed",
        "SELECT a.sample AS a, b.sample AS b, round(corr(a.value, b.value), 6) AS r FROM normed a JOIN normed b USING (feature) GROUP BY 1, 2",
    ),
)
def sample_correlation(spark, sf):
    return rounded(similarity.sample_correlation(roles.normed(spark, sf), roles.samples(spark, sf)))


@query(
    "feature_correlation",
    with_roles(
        "cells samples grid filled offset_a normed",
        """, w AS (SELECT feature, list(value ORDER BY sample) AS x FROM normed GROUP BY 1 HAVING stddev_samp(value) > 0),
        c AS (SELECT feature, list_transform(x, lambda v: v - list_avg(x)) AS x FROM w),
        z AS (SELECT feature, list_transform(x, lambda v: v / sqrt(list_inner_product(x, x))) AS x FROM c),
        pr AS (SELECT a.feature AS a, b.feature AS b, list_inner_product(a.x, b.x) AS r FROM z a JOIN z b ON a.feature < b.feature)
        SELECT a, b, round(r, 6) AS r FROM pr""",
    ).replace("\n, w AS", ",\nw AS"),
)
def feature_correlation(spark, sf):
    return rounded(similarity.feature_correlation(roles.normed(spark, sf), roles.samples(spark, sf)))


@query(
    "pairwise_distance",
    with_roles(
        "cells samples grid filled offset_a normed",
        "SELECT a.sample AS a, b.sample AS b, round(sqrt(sum((a.value - b.value) * (a.value - b.value))), 6) AS distance FROM normed a JOIN normed b ON a.feature = b.feature AND a.sample < b.sample GROUP BY 1, 2",
    ),
)
def pairwise_distance(spark, sf):
    return rounded(similarity.pairwise_distance(roles.normed(spark, sf), roles.samples(spark, sf)))


@query(
    "pairwise_distance_features",
    with_roles(
        TT,
        """, top AS (SELECT feature FROM pv ORDER BY round(p, 9), feature LIMIT 25), v AS (SELECT * FROM normed WHERE feature IN (SELECT feature FROM top))
        SELECT a.feature AS a, b.feature AS b, round(sqrt(sum((a.value - b.value) * (a.value - b.value))), 6) AS distance
        FROM v a JOIN v b ON a.sample = b.sample AND a.feature < b.feature GROUP BY 1, 2""",
    ).replace("\n, top AS", ",\ntop AS"),
)
def pairwise_distance_features(spark, sf):
    """Distances between the features of the sub heat map (the top 25 of the one-way test)."""
    long, samples = roles.normed(spark, sf), roles.samples(spark, sf)
    top = contrasts.top_by_anova(contrasts.anova_test(long, samples).withColumn("p", F.round("p", 9)))
    chosen = long.join(top.select("feature"), "feature", "left_semi")
    return rounded(similarity.pairwise_distance(chosen, samples, by="feature"))


def _pca(spark, sf, k=2):
    long = _counts(spark, sf).withColumn("value", log2p1("value"))
    return components.pca(long, roles.samples(spark, sf), k)


@query("pca_scores")
def pca_scores(spark, sf):
    return rounded(_pca(spark, sf, 5).scores)


_CENTRED = """, x AS (SELECT feature, sample, value - avg(value) OVER (PARTITION BY feature) AS v FROM normed)"""


@query(
    "pca_gram",
    with_roles(
        "cells samples factors counts",
        """, l AS (SELECT feature, sample, log2(value + 1) AS value FROM counts WHERE feature IN
          (SELECT feature FROM counts GROUP BY 1 HAVING count(*) = (SELECT count(*) FROM samples))),
        x AS (SELECT feature, sample, value - avg(value) OVER (PARTITION BY feature) AS v FROM l)
        SELECT a.sample AS a, b.sample AS b, round(sum(a.v * b.v), 6) + 0.0 AS product FROM x a JOIN x b USING (feature) GROUP BY 1, 2""",
    ).replace("\n, l AS", ",\nl AS"),
)
def pca_gram(spark, sf):
    """All scores multiplied back: the centred products of the samples."""
    scores = _pca(spark, sf, 8).scores.drop("condition").unpivot(["sample"], None, "pc", "v")
    other = scores.select(F.col("sample").alias("b"), F.col("pc").alias("pc2"), F.col("v").alias("w"))
    return rounded(scores.join(other, F.col("pc") == F.col("pc2")).groupBy(F.col("sample").alias("a"), "b").agg(F.sum(F.col("v") * F.col("w")).alias("product")))


@query("pca_variance")
def pca_variance(spark, sf):
    return rounded(_pca(spark, sf, 5).variance)


@query("pca_loadings")
def pca_loadings(spark, sf):
    return rounded(_pca(spark, sf, 3).loadings)


@query(
    "score_ellipse_points",
    """WITH p AS (SELECT l_returnflag AS condition, l_quantity AS x, l_discount * 100 AS y FROM lineitem),
    g AS (SELECT condition, avg(x) AS centre_x, avg(y) AS centre_y, var_samp(x) AS vx, var_samp(y) AS vy, covar_samp(x, y) AS c FROM p GROUP BY 1),
    r AS (SELECT *, (vx + vy) / 2 AS half, sqrt(((vx - vy) / 2) ^ 2 + c * c) AS root, sqrt(-2 * ln(0.05)) AS radius FROM g)
    SELECT condition, round(centre_x, 6) AS centre_x, round(centre_y, 6) AS centre_y, round(sqrt(half + root) * radius, 6) AS major,
      round(sqrt(greatest(half - root, 0)) * radius, 6) AS minor, round(atan2(2 * c, vx - vy) / 2, 6) AS angle FROM r""",
)
def score_ellipse_points(spark, sf):
    """Quantity and discount of all order lines, by return flag."""
    points = roles.table(spark, sf, "lineitem").select(F.col("l_returnflag").alias("condition"), F.col("l_quantity").cast("double").alias("pc1"), (F.col("l_discount") * 100).cast("double").alias("pc2"))
    return rounded(components.score_ellipse(points))


@query("score_ellipse")
def score_ellipse(spark, sf):
    return rounded(components.score_ellipse(_pca(spark, sf, 2).scores))


def _pls(spark, sf, ncomp=5):
    return components.pls(roles.normed(spark, sf), roles.samples(spark, sf), LEVELS, ncomp)


@query("pls_scores")
def pls_scores(spark, sf):
    return rounded(_pls(spark, sf).scores)


@query(
    "pls_first_component",
    with_roles(
        "cells samples grid filled offset_a normed",
        _CENTRED
        + """, y AS (SELECT sample, CASE WHEN condition = 'cns' THEN 1 ELSE 0 END - avg(CASE WHEN condition = 'cns' THEN 1.0 ELSE 0.0 END) OVER () AS y FROM samples),
        w AS (SELECT feature, sum(v * y) AS w FROM x JOIN y USING (sample) GROUP BY 1),
        s AS (SELECT sqrt(sum(w * w)) * sign(max_by(w, abs(w))) AS n FROM w)
        SELECT sample, round(sum(v * w / n), 6) + 0.0 AS comp1 FROM x JOIN w USING (feature), s GROUP BY 1""",
    ).replace("\n, x AS", ",\nx AS"),
)
def pls_first_component(spark, sf):
    return rounded(_pls(spark, sf).scores.select("sample", "comp1"))


@query("pls_loadings")
def pls_loadings(spark, sf):
    return rounded(_pls(spark, sf).loadings)


_VIP = with_roles(
    "cells samples grid filled offset_a normed",
    """, c AS (SELECT feature, (value - avg(value) OVER (PARTITION BY feature)) * (CASE WHEN condition = 'cns' THEN 1 ELSE 0 END -
      (SELECT avg(CASE WHEN condition = 'cns' THEN 1.0 ELSE 0.0 END) FROM samples)) AS xy FROM normed JOIN samples USING (sample)),
    w AS (SELECT feature, abs(sum(xy)) AS w FROM c GROUP BY 1)
    SELECT feature, round(w * sqrt(count(*) OVER ()) / sqrt(sum(w * w) OVER ()), 6) AS vip FROM w""",
).replace("\n, c AS", ",\nc AS")


@query("vip", _VIP)
def vip(spark, sf):
    return rounded(components.vip(_pls(spark, sf)))


@query("top_vip", f"SELECT * FROM ({_VIP}) ORDER BY vip DESC, feature LIMIT 15")
def top_vip(spark, sf):
    return rounded(components.top_vip(components.vip(_pls(spark, sf))))


@query(
    "flagship",
    with_roles(
        TT + " padj factors fc",
        """SELECT feature, round(log2fc, 6) AS log2fc, round(p, 6) AS p, round(padj, 6) AS padj, round(base_mean, 6) AS base_mean
        FROM fc JOIN padj USING (feature) JOIN (SELECT feature, sum(value / size_factor) / (SELECT count(*) FROM samples) AS base_mean
        FROM cells JOIN factors USING (sample) GROUP BY 1) USING (feature) ORDER BY round(padj.p, 9), feature LIMIT 25""",
    ),
)
def flagship(spark, sf):
    """The 25 best features of the two-group study with their mean normalised count."""
    n_samples = roles.samples(spark, sf).agg(F.count_distinct("sample")).scalar()
    base = _counts(spark, sf).groupBy("feature").agg(F.sum("value").alias("_sum")).withColumn("base_mean", F.col("_sum") / n_samples)
    best = relational.top_features(results(spark, sf).withColumn("p", F.round("p", 9)), 25, "p")
    return rounded(best.join(base.select("feature", "base_mean"), "feature").select("feature", "log2fc", "p", "padj", "base_mean"))
