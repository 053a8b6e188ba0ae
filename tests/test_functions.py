import math

from pyspark.sql import functions as F

from assayframe.functions import numeric as n
from assayframe.functions import sequences as s
from assayframe.functions import tails
from assayframe.functions import text as t

NAN = float("nan")


def column(spark, values, kind, expr):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    return [r[0] for r in df.select(expr.alias("y"), "i").orderBy("i").select("y").collect()]


def test_missing_values_never_pass_a_comparison(spark):
    values = [NAN, None, 0.5, 2.0]
    assert column(spark, values, "double", F.coalesce(n.safe_gt("x", 1), F.lit(False))) == [False, False, False, True]
    assert column(spark, values, "double", F.coalesce(n.safe_lt("x", 1), F.lit(False))) == [False, False, True, False]


def test_means_skip_or_require_values(spark):
    df = spark.createDataFrame([(1, 1.0), (1, NAN), (1, 3.0), (2, 4.0)], "g int, x double")
    rows = {r["g"]: r for r in df.groupBy("g").agg(n.avg_skip_nan("x").alias("a"), n.avg_if_complete("x").alias("b")).collect()}
    assert rows[1]["a"] == 2.0 and rows[1]["b"] is None and rows[2]["b"] == 4.0


def test_numbers(spark):
    assert column(spark, [0.0, 0.01, None], "double", n.neg_log10("x")) == [math.inf, 2.0, None]
    assert column(spark, [0.12345, 0.00125], "double", n.pct("x")) == [12.34, 0.12]
    assert column(spark, ["1.5", "abc", None], "string", n.to_number("x")) == [1.5, None, None]
    assert column(spark, [2.0], "double", n.rt_seconds("x", "minutes")) == [120.0]
    assert column(spark, [0.0, 1.0, -1.0, None], "double", n.label_sign("x")) == ["Downregulated", "Upregulated", "Downregulated", None]
    assert column(spark, [2.0, 1.0, -2.0], "double", n.label_direction("x")) == ["Upregulated", "Not Significant", "Downregulated"]


def test_log_ratio_limits(spark):
    df = spark.createDataFrame([(4.0, 1.0), (1.0, 0.0), (0.0, 1.0), (0.0, 0.0)], "a double, b double")
    assert [r[0] for r in df.select(n.log2_ratio("a", "b")).collect()] == [2.0, math.inf, -math.inf, None]


def test_text(spark):
    assert column(spark, ["Foo;bar.1", ".x", "abc", None, "a\n.b"], "string", t.strip_name("x")) == ["Foo", "", "abc", None, "a\n"]
    mz, rt = t.split_peak_key("x")
    assert column(spark, ["100.05__33.2", "bad"], "string", F.concat_ws("|", mz, rt)) == ["100.05|33.2", ""]
    assert column(spark, ["path:hsa1"], "string", t.strip_prefix("x")) == ["hsa1"]
    assert column(spark, ["/a/s1_counts.txt", "plain"], "string", t.file_stem("x", "_counts.txt")) == ["s1", "plain"]
    assert column(spark, [["a", "b"], []], "array<string>", t.first_of("x")) == ["a", None]
    assert column(spark, [3], "int", t.ratio_text("x", F.lit(10))) == ["3/10"]
    assert column(spark, ["  a "], "string", t.trimmed("x")) == ["a"]


def test_sequences(spark):
    assert column(spark, ["!I~", ""], "string", s.phred("x"))[0] == [0, 40, 93]
    assert column(spark, ["ACGTA", "AC"], "string", s.kmers("x", 3)) == [["ACG", "CGT", "GTA"], []]
    assert column(spark, ["TTT"], "string", s.canonical("x")) == ["AAA"]
    assert column(spark, ["ACGT", "ANGT"], "string", s.packed("x")) == [27, None]
    assert column(spark, ["GGAC"], "string", s.gc_count("x")) == [3]


def test_t_tail_meets_critical_values(spark):
    cases = [(2.446911851, 6, 0.05), (2.570581836, 5, 0.05), (12.70620474, 1, 0.05), (4.30265273, 2, 0.05), (5.95881618, 6, 0.001)]
    df = spark.createDataFrame(cases, "t double, df int, p double")
    for r in df.select("p", tails.t_two_sided("t", F.col("df")).alias("q"), tails.f_upper(F.col("t") * F.col("t"), 1.0, F.col("df")).alias("f")).collect():
        assert math.isclose(r["p"], r["q"], rel_tol=1e-7) and math.isclose(r["q"], r["f"], rel_tol=1e-12)


def test_f_tail_meets_critical_values(spark):
    cases = [(4.75706, 3, 6, 0.05), (4.53368, 4, 6, 0.05), (3.97152, 5, 7, 0.05), (8.02152, 2, 9, 0.01)]
    df = spark.createDataFrame(cases, "f double, a int, b int, p double")
    for r in df.select("p", tails.f_upper("f", F.col("a"), F.col("b")).alias("q")).collect():
        assert math.isclose(r["p"], r["q"], rel_tol=2e-5)


def test_normal_and_hypergeometric_tails(spark):
    z = [0.0, 0.5, 1.96, 2.83, 5.0, 30.0]
    for x, p in zip(z, column(spark, z, "double", tails.normal_two_sided("x"))):
        assert math.isclose(p, math.erfc(x / math.sqrt(2)), rel_tol=1e-12)
    cases = [(3, 50, 20, 1000), (12, 60, 40, 2000), (8, 10, 15, 20), (0, 5, 5, 20), (5, 5, 5, 20)]
    df = spark.createDataFrame(cases, "k int, n int, m int, t int")
    for r in df.select("*", tails.hypergeom_upper("k", "n", "m", "t").alias("p")).collect():
        terms = [math.comb(r.m, x) * math.comb(r.t - r.m, r.n - x) for x in range(max(r.k, 0, r.n + r.m - r.t), min(r.m, r.n) + 1)]
        assert math.isclose(r.p, sum(terms) / math.comb(r.t, r.n), rel_tol=1e-10)
