import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from assayframe.operators import ordered
from assayframe.operators.adjust import adjust_bh, q_value
from assayframe.operators.skew import spread_join


def bh(p):
    p = np.asarray(p)
    order = np.argsort(-p)
    out = np.empty(len(p))
    out[order] = np.minimum(1, np.minimum.accumulate(p[order] * len(p) / np.arange(len(p), 0, -1)))
    return out


def test_bh_by_hand(spark):
    df = spark.createDataFrame([(0.01,), (0.04,), (0.03,), (0.5,), (None,)], "p double")
    got = {r["p"]: r["padj"] for r in adjust_bh(df, "p").collect()}
    assert got[0.01] == pytest.approx(0.04) and got[0.04] == pytest.approx(0.16 / 3)
    assert got[0.03] == pytest.approx(0.16 / 3) and got[0.5] == 0.5 and got[None] is None


def test_bh_with_one_hot_group_and_ties(spark):
    rng = np.random.default_rng(0)
    pdf = pd.DataFrame({"g": np.where(rng.random(3000) < 0.7, 0, rng.integers(1, 20, 3000)), "p": np.round(rng.random(3000) ** 2, 2)})
    got = adjust_bh(spark.createDataFrame(pdf), "p", ["g"]).toPandas()
    assert len(got) == len(pdf)
    for _, part in got.groupby("g"):
        assert np.allclose(bh(part["p"]), part["padj"])


def test_q_value_scales_bh(spark):
    df = spark.createDataFrame([(0.01,), (0.04,), (0.03,), (0.5,)], "p double")
    got = {r["p"]: r["qvalue"] for r in q_value(df, "p").collect()}
    assert got[0.01] == pytest.approx(0.04 * 0.25 / 0.95)


def test_exact_quantiles_and_ranks(spark):
    rng = np.random.default_rng(1)
    pdf = pd.DataFrame({"g": rng.integers(0, 3, 2000), "x": np.round(rng.normal(size=2000), 2)})
    df = spark.createDataFrame(pdf)
    got = ordered.exact_quantiles(df, ["g"], "x", {"a": 0.1, "m": 0.5}).toPandas().set_index("g").sort_index()
    want = pdf.groupby("g").x.quantile([0.1, 0.5]).unstack()
    assert np.allclose(got.to_numpy(), want.to_numpy())
    ranks = ordered.value_ranks(df, [], "x").toPandas()
    for r in ranks.sample(50, random_state=1).itertuples():
        assert r.below == (pdf.x < r.x).sum() and r.upto == (pdf.x <= r.x).sum() and r.total == 2000


def test_islands_equal_a_plain_scan_in_a_hot_group(spark):
    rng = np.random.default_rng(2)
    pdf = pd.DataFrame({"g": np.where(rng.random(2000) < 0.8, 0, 1), "x": np.round(np.cumsum(rng.exponential(1, 2000)), 3)}).drop_duplicates()
    got = ordered.island_starts(spark.createDataFrame(pdf), ["g"], "x", 3.0, bins=16).toPandas().sort_values(["g", "x"])
    for _, part in got.groupby("g"):
        assert ((part.x.diff() > 3).cumsum().to_numpy() == part.island.to_numpy()).all()


def test_partitioning_does_not_matter(spark):
    pdf = pd.DataFrame({"p": np.round(np.random.default_rng(3).random(500), 3)})
    one = adjust_bh(spark.createDataFrame(pdf).coalesce(1), "p", bins=4)
    many = adjust_bh(spark.createDataFrame(pdf).repartition(7), "p", bins=32)
    key = lambda df: sorted((r["p"], round(r["padj"], 12)) for r in df.collect())
    assert key(one) == key(many)


@pytest.mark.parametrize("how", ["inner", "left"])
def test_spread_join_equals_a_plain_join(spark, how):
    rows = spark.range(40_000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), "id")
    dim = spark.range(30_000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    total = [F.count(F.lit(1)), F.sum("v"), F.sum("id")]
    assert spread_join(rows, dim, ["k"], how).agg(*total).collect() == rows.join(dim, "k", how).agg(*total).collect()
