import math
from collections import Counter

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from assayframe.operators import alignments, components, contrasts, counts_nb, enrichment, forest, integration, kmers, matrix
from assayframe.operators import rangejoin, read_quality, read_trimming, similarity, skew, spectra
from assayframe.plans import matrix_queries, read_queries, study_queries

LEVELS = ("bm", "cns")


def long_table(spark, values: np.ndarray, names=None):
    f, s = np.indices(values.shape)
    return spark.createDataFrame(pd.DataFrame({"feature": f.ravel(), "sample": s.ravel(), "value": values.ravel().astype(float)}))


def sample_table(spark, n, first):
    return spark.createDataFrame([(i, LEVELS[0] if i < first else LEVELS[1]) for i in range(n)], "sample long, condition string")


@pytest.fixture(scope="module")
def counts():
    rng = np.random.default_rng(5)
    mean = rng.lognormal(5, 1, 300)
    lfc = np.zeros(300)
    lfc[:30] = 2.0
    mu = mean[:, None] * np.where(np.arange(8) < 4, 1.0, 2.0 ** lfc[:, None]) * np.linspace(0.5, 2, 8)
    return rng.negative_binomial(10, 10 / (10 + mu)).astype(float)


def test_size_factors_are_the_median_of_ratios(spark, counts):
    full = counts[(counts > 0).all(axis=1)]
    want = np.exp(np.median(np.log(full) - np.log(full).mean(axis=1, keepdims=True), axis=0))
    got = matrix.size_factors(long_table(spark, counts), sample_table(spark, 8, 4)).toPandas().sort_values("sample")
    assert np.allclose(got["size_factor"], want)


def test_outer_merge_then_sum_by_symbol(spark):
    long = spark.createDataFrame([("E1", "X", 5.0), ("E1", "Y", 7.0), ("E2", "Y", 1.0), ("E3", "X", 2.0), ("E3", "Y", 3.0), ("E4", "X", 1.0), ("E4", "Y", 1.0)], "feature string, sample string, value double")
    samples = spark.createDataFrame([("X", "bm"), ("Y", "cns")], "sample string, condition string")
    xref = spark.createDataFrame([("E1", "S", 1), ("E2", "S", 2), ("E3", "S", 3)], "feature string, symbol string, ord int")
    got = {(r["feature"], r["sample"]): r["value"] for r in matrix.sum_by_symbol(long, samples, xref).collect()}
    assert got == {("S", "X"): 7.0, ("S", "Y"): 10.0}
    merged = {(r["feature"], r["sample"]): r["value"] for r in matrix.merge_counts(long, samples).collect()}
    assert merged[("E2", "X")] is None and len(merged) == 8


def test_replace_and_log(spark):
    values = np.array([[0.0, 10.0, 20.0], [5.0, 0.0, 5.0]])
    filled = matrix.replace_min(long_table(spark, values)).toPandas().pivot(index="feature", columns="sample", values="value").to_numpy()
    assert np.allclose(filled, [[2, 10, 20], [5, 1, 5]])
    logged = matrix.log_norm(long_table(spark, filled)).toPandas().pivot(index="feature", columns="sample", values="value").to_numpy()
    assert np.allclose(logged, np.log10((filled + np.sqrt(filled**2 + 0.01)) / 2))


def test_t_and_f_agree_and_match_a_direct_formula(spark):
    x = np.random.default_rng(6).normal(size=(20, 7))
    long, samples = long_table(spark, x), sample_table(spark, 7, 3)
    t = contrasts.t_test(long, samples, LEVELS).toPandas().sort_values("feature")
    f = contrasts.anova_test(long, samples).toPandas().sort_values("feature")
    a, b = x[:, :3], x[:, 3:]
    pooled = (2 * a.var(axis=1, ddof=1) + 3 * b.var(axis=1, ddof=1)) / 5
    want = (a.mean(axis=1) - b.mean(axis=1)) / np.sqrt(pooled * (1 / 3 + 1 / 4))
    assert np.allclose(t["t"], want) and np.allclose(f["f"], want**2) and np.allclose(t["p"], f["p"])
    assert (t["df"] == 5).all()


def test_fold_change_and_volcano(spark):
    values = np.array([[8.0, 8, 2, 2], [1, 1, 0, 0], [3, 3, 3, 3]])
    changes = contrasts.fold_change(long_table(spark, values), sample_table(spark, 4, 2), LEVELS)
    got = {r["feature"]: (r["log2fc"], r["flagged"]) for r in changes.collect()}
    assert got == {0: (2.0, True), 1: (math.inf, True), 2: (0.0, False)}
    tests = spark.createDataFrame([(0, 0.05), (1, 0.5), (2, 0.01)], "feature long, p double")
    assert [r["feature"] for r in contrasts.volcano(changes, tests).collect()] == [0]


def test_pca_equals_a_singular_value_decomposition(spark):
    for features, n in ((60, 6), (90, 24)):
        x = np.random.default_rng(7).normal(size=(features, n)) * np.linspace(1, 4, n)
        centred = x - x.mean(axis=1, keepdims=True)
        _, sv, vt = np.linalg.svd(centred, full_matrices=False)
        model = components.pca(long_table(spark, x), sample_table(spark, n, n // 2), 2)
        scores = model.scores.toPandas().sort_values("sample")
        for i in range(2):
            assert np.allclose(np.abs(scores[f"pc{i + 1}"]), np.abs(sv[i] * vt[i]), atol=1e-3)
        share = model.variance.toPandas().sort_values("pc")["share"]
        assert np.allclose(share, sv[:2] ** 2 / (sv**2).sum(), atol=1e-6)
        loadings = model.loadings.toPandas().sort_values("feature")
        assert np.allclose((loadings[["pc1", "pc2"]] ** 2).sum(), 1, atol=1e-4)


def test_pca_of_every_rank(spark):
    rng = np.random.default_rng(17)
    equal = rng.normal(size=(40, 6))
    equal[:, 5] = equal[:, 4]
    wide = rng.normal(size=(30, 14)) * np.linspace(1, 3, 14)
    for x, k in ((rng.normal(size=(50, 8)), 8), (equal, 6), (equal, 5), (rng.normal(size=(1, 12)), 3), (wide, 14), (np.ones((20, 9)), 2)):
        n = x.shape[1]
        model = components.pca(long_table(spark, x), sample_table(spark, n, n // 2), k)
        centred = x - x.mean(axis=1, keepdims=True)
        _, sv, vt = np.linalg.svd(centred, full_matrices=False)
        sv = np.concatenate([sv, np.zeros(n)])[:k]
        scores = model.scores.toPandas().sort_values("sample")[[f"pc{i + 1}" for i in range(k)]].to_numpy()
        assert np.allclose((scores**2).sum(axis=0), sv**2, atol=1e-6)
        assert np.allclose(scores @ scores.T, (centred.T @ centred) if k >= min(x.shape) else (vt.T[:, :k] * sv**2) @ vt[:k], atol=1e-5)
        share = model.variance.toPandas().sort_values("pc")["share"]
        assert np.allclose(share, sv**2 / max((sv**2).sum(), (centred**2).sum(), 1e-300), atol=1e-9)
        loadings = model.loadings.toPandas()[[f"pc{i + 1}" for i in range(k)]].to_numpy()
        assert np.allclose((loadings**2).sum(axis=0), np.where(sv > 1e-6, 1, 0), atol=1e-6)


def test_score_ellipse_is_that_of_the_covariance(spark):
    rng = np.random.default_rng(43)
    rows = []
    for name, mix in (("a", [[2, 1], [0, 0.5]]), ("b", [[1, 0], [0, 3]])):
        rows += [(name, *(float(v) for v in p)) for p in rng.normal(size=(40, 2)) @ np.array(mix) + 5]
    rows += [("one", 1.0, 2.0), ("line", 0.0, 0.0), ("line", 1.0, 1.0), ("line", 3.0, 3.0)]
    got = {r["condition"]: r for r in components.score_ellipse(spark.createDataFrame(rows, "condition string, pc1 double, pc2 double"), level=0.9).collect()}
    for name in ("a", "b", "line"):
        points = np.array([r[1:] for r in rows if r[0] == name])
        values, vectors = np.linalg.eigh(np.cov(points.T))
        r, radius = got[name], math.sqrt(-2 * math.log(0.1))
        assert np.allclose([r["centre_x"], r["centre_y"]], points.mean(axis=0))
        assert np.allclose([r["major"], r["minor"]], radius * np.sqrt(np.maximum(values[::-1], 0)), atol=1e-6)
        axis = vectors[:, 1]
        assert abs(abs(math.cos(r["angle"]) * axis[0] + math.sin(r["angle"]) * axis[1]) - 1) < 1e-9
    assert got["one"]["centre_x"] == 1.0 and got["one"]["major"] is None
    inside = [r for r in rows if r[0] == "a"]
    r = got["a"]
    turn = np.array([[math.cos(r["angle"]), math.sin(r["angle"])], [-math.sin(r["angle"]), math.cos(r["angle"])]])
    share = np.mean([((turn @ (np.array(p[1:]) - [r["centre_x"], r["centre_y"]]) / [r["major"], r["minor"]]) ** 2).sum() <= 1 for p in inside])
    assert 0.75 < share <= 1


def test_the_report_holds_every_module(spark):
    reads = read_table(spark, [("s", 1, f"m:1:f:1:{i % 3}:{i}:1", "ACGTNACGT"[: 4 + i % 5], "IIIIIII#!"[: 4 + i % 5]) for i in range(30)])
    adapters = spark.createDataFrame([("ad", "GT")], "name string, seq string")
    report = read_quality.qc_merge({"raw": reads, "again": reads.filter("length(seq) > 5")}, adapters).toPandas()
    modules = read_quality.qc_modules(reads, adapters)
    assert set(report["module"]) == modules.keys() and len(modules) == 11 and set(report["stage"]) == {"raw", "again"}
    for name, (table, label, bucket) in modules.items():
        own = table.toPandas()
        metrics = [c for c in own.columns if c not in ("sample", "mate", label, bucket)]
        want = sorted((str(r[label]) if label else "", float(r[bucket]) if bucket else -1.0, m, repr(round(float(r[m]), 9))) for _, r in own.iterrows() for m in metrics)
        part = report[(report["stage"] == "raw") & (report["module"] == name)]
        got = sorted((r.label or "", -1.0 if r.bucket is None or r.bucket != r.bucket else r.bucket, r.metric, repr(round(float(r.value), 9))) for r in part.itertuples())
        assert got == want, name


def test_pls_equals_the_iteration_on_the_full_matrix(spark):
    x = np.random.default_rng(8).normal(size=(40, 8))
    model = components.pls(long_table(spark, x), sample_table(spark, 8, 4), LEVELS, 3)
    xs = (x - x.mean(axis=1, keepdims=True)).T
    y = np.r_[np.zeros(4), np.ones(4)] - 0.5
    weights = model.weights.toPandas().sort_values("feature")
    ss, ws = [], []
    for a in range(3):
        w = xs.T @ y / np.linalg.norm(xs.T @ y)
        t = xs @ w
        q = y @ t / (t @ t)
        xs, y = xs - np.outer(t, xs.T @ t / (t @ t)), y - q * t
        assert np.allclose(np.abs(weights[f"comp{a + 1}"]), np.abs(w))
        ss.append(q * q * (t @ t))
        ws.append(w)
    got = components.vip(model, 3).toPandas().sort_values("feature")["vip"]
    assert np.allclose(got, np.sqrt(40 * sum(s * w**2 for s, w in zip(ss, ws)) / sum(ss)))


def test_correlations_and_distances(spark):
    x = np.random.default_rng(9).normal(size=(30, 5))
    long, samples = long_table(spark, x), sample_table(spark, 5, 2)
    r = np.corrcoef(x.T)
    assert all(math.isclose(p["r"], r[p["a"], p["b"]], abs_tol=1e-9) for p in similarity.sample_correlation(long, samples).collect())
    rf = np.corrcoef(x)
    pairs = similarity.feature_correlation(long, samples, min_abs=0.8, block_rows=7).collect()
    want = {(a, b) for a in range(30) for b in range(a + 1, 30) if abs(rf[a, b]) >= 0.8}
    assert {(p["a"], p["b"]) for p in pairs} == want and all(math.isclose(p["r"], rf[p["a"], p["b"]], abs_tol=1e-9) for p in pairs)
    d = similarity.pairwise_distance(long, samples, "feature", block_rows=7).collect()
    assert len(d) == 435 and all(math.isclose(p["distance"], np.linalg.norm(x[p["a"]] - x[p["b"]])) for p in d)


def test_integration_equals_the_pair_table(spark):
    genes = spark.createDataFrame([("P", "g1", 1.0), ("P", "g2", 3.0), ("Q", "g3", 5.0)], "pathway_name string, gene string, gene_lfc double")
    compounds = spark.createDataFrame([("P", "c1", -1.0), ("P", "c2", -2.0), ("P", "c3", -3.0), ("R", "c4", 0.0)], "pathway_name string, compound string, compound_lfc double")
    got = integration.integrate_pathways(genes, compounds).collect()
    assert len(got) == 1 and got[0]["genes"] == "g1, g1, g1, g2, g2, g2" and got[0]["compounds"] == "c1, c2, c3, c1, c2, c3"
    assert got[0]["avg_gene_lfc"] == 2.0 and got[0]["avg_compound_lfc"] == -2.0
    once = integration.integrate_pathways(genes, compounds, distinct_names=True).first()
    assert once["genes"] == "g1, g2" and once["compounds"] == "c1, c2, c3"
    table = {tuple(r) for r in integration.network_edge_table(genes, compounds).collect()}
    assert table == {("P", g, c) for g in ("g1", "g2") for c in ("c1", "c2", "c3")}
    members = {(r["side"], r["name"]): r["copies"] for r in integration.pathway_members(genes, compounds).collect()}
    assert members == {("gene", "g1"): 3, ("gene", "g2"): 3, ("compound", "c1"): 2, ("compound", "c2"): 2, ("compound", "c3"): 2}
    assert integration.pair_by_pathway(genes, compounds).count() == 6
    degree = {r["name"]: r["degree"] for r in integration.node_degree(integration.network_edges(genes, compounds)).collect()}
    assert degree == {"P": 6, "g1": 3, "g2": 3}


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("list_rows, list_group", [(1000, 100_000), (3, 5)])
def test_pairs_by_lists_are_all_pairs(spark, monkeypatch, list_rows, list_group):
    monkeypatch.setattr(skew, "LIST_ROWS", list_rows)
    monkeypatch.setattr(skew, "LIST_GROUP", list_group)
    draw = np.random.default_rng(18)
    left = [(("P", "Q", None, "R")[draw.integers(4)], int(draw.integers(6)), (None, "a", "b")[draw.integers(3)]) for _ in range(90)]
    right = [(("P", "Q", None, "S")[min(3, draw.integers(9))], float(draw.integers(4)), (None, 7)[draw.integers(2)]) for _ in range(70)]
    rows = spark.createDataFrame(left, "k string, x int, y string")
    others = spark.createDataFrame(right, "k string, z double, w int")
    got = skew.pair_join(rows, others, ["k"])
    assert got.columns == ["k", "x", "y", "z", "w"]
    assert Counter(tuple(r) for r in got.collect()) == Counter((a[0], a[1], a[2], b[1], b[2]) for a in left for b in right if a[0] == b[0] and a[0] is not None)
    assert skew.pair_join(rows, others.limit(0), ["k"]).count() == 0


def test_pairs_come_from_lists_and_are_rounded_before(spark, tmp_path):
    spark.createDataFrame([(0, "N")], "n_nationkey int, n_name string").write.parquet(f"{tmp_path}/nation.parquet")
    spark.range(40).selectExpr("concat('c', id) AS c_name", "0 AS c_nationkey", "double(id) / 7 AS c_acctbal").write.parquet(f"{tmp_path}/customer.parquet")
    spark.range(30).selectExpr("concat('s', id) AS s_name", "0 AS s_nationkey", "double(id) / 3 AS s_acctbal").write.parquet(f"{tmp_path}/supplier.parquet")
    pairs = study_queries.pair_by_pathway(spark, str(tmp_path))
    above = _plan(pairs).split("Generate explode(_rows")
    assert len(above) == 2 and "round(" not in above[0] and above[1].count("round(") >= 2
    got = {(r["gene"], r["compound"]): (r["gene_lfc"], r["compound_lfc"]) for r in pairs.collect()}
    assert len(got) == 1200 and got["c5", "s4"] == (0.000714, 0.001333)
    edges = study_queries.network_edge_table(spark, str(tmp_path))
    assert "Generate explode(_rows" in _plan(edges) and edges.distinct().count() == edges.count() == 1200
    # few bytes, many pairs: no task is left without work because its neighbour's bytes are few
    assert edges.rdd.getNumPartitions() >= 8 * spark.sparkContext.defaultParallelism


def test_points_meet_intervals_in_lists(spark):
    points = spark.range(300).selectExpr("id AS p", "0 AS g", "id * 5 AS x")
    spans = spark.range(200).selectExpr("id AS i", "0 AS g", "id * 7 AS s", "id * 7 + 40 AS e")
    want = Counter((p, i) for p in range(300) for i in range(200) if i * 7 <= p * 5 <= i * 7 + 40)
    for crowded in (True, False):
        got = rangejoin.point_in_interval(points, spans, ["g"], "x", "s", "e", 40.0, crowded=crowded)
        assert ("Generate explode(_rows" in _plan(got)) == crowded
        assert Counter((r["p"], r["i"]) for r in got.collect()) == want


def test_a_pathway_of_more_than_a_million_pairs_keeps_its_lists(spark):
    genes = spark.range(1100).selectExpr("'P' AS pathway_name", "concat('g', lpad(id, 4, '0')) AS gene", "double(id) AS gene_lfc")
    compounds = spark.range(1000).selectExpr("'P' AS pathway_name", "concat('c', lpad(id, 4, '0')) AS compound", "double(1) AS compound_lfc")
    got = integration.integrate_pathways(genes, compounds).selectExpr("length(genes) AS g", "length(compounds) AS c", "substr(genes, 1, 14) AS a", "substr(compounds, 1, 14) AS b").first()
    assert tuple(got) == (1_100_000 * 7 - 2, 1_100_000 * 7 - 2, "g0000, g0000, ", "c0000, c0001, ")


def test_dense_masses_do_not_chain(spark):
    for step in (8e-6, 20e-6):
        mz = [200 * (1 + step) ** i for i in range(600)]
        rows = [("r", scan, float(scan), m, 100.0 + (i * 7919) % 13) for i, m in enumerate(mz) for scan in range(5)]
        peaks = spectra.detect_peaks(spark.createDataFrame(rows, "run string, scan int, rt double, mz double, intensity double"), ppm=10)
        found = peaks.collect()
        assert len(found) > 200 and abs(sum(p["area"] for p in found) - sum(r[4] for r in rows)) < 1e-6
    rows = [("r", scan, float(scan), 300 * (1 + scan % 3 * 2e-6), 50.0) for scan in range(9)]
    assert spectra.detect_peaks(spark.createDataFrame(rows, "run string, scan int, rt double, mz double, intensity double"), ppm=10).count() == 1


def test_pathway_means_keep_the_unnamed_group(spark):
    rows = spark.createDataFrame([(None, 1.0), (None, 2.0), ("P", 0.0), ("P", float("nan"))], "pathway_name string, lfc double")
    got = {r["pathway_name"]: (r["avg_lfc"], r["direction"]) for r in integration.pathway_mean_lfc(rows).collect()}
    assert got == {None: (1.5, "Upregulated"), "P": (0.0, "Downregulated")}


def test_over_representation(spark):
    sets = spark.createDataFrame([("A", i) for i in range(10)] + [("B", i) for i in range(5, 40)], "pathway_id string, member int")
    hits = spark.createDataFrame([(i,) for i in (0, 1, 2, 6, 99)], "member int")
    got = {r["pathway_id"]: r for r in enrichment.ora(hits, sets).collect()}
    p = sum(math.comb(10, x) * math.comb(30, 4 - x) for x in (4,)) / math.comb(40, 4)
    assert math.isclose(got["A"]["p"], p) and got["A"]["gene_ids"] == "0/1/2/6" and got["A"]["bg_ratio"] == "10/40"
    assert got["B"]["gene_ratio"] == "1/4"


def test_range_joins_equal_naive_joins(spark):
    rng = np.random.default_rng(10)
    iv = pd.DataFrame({"g": rng.integers(0, 2, 300), "s": rng.integers(0, 5000, 300)})
    iv["e"] = iv["s"] + rng.choice([3, 40, 2500], 300)
    iv["id"] = range(300)
    pt = pd.DataFrame({"g": rng.integers(0, 2, 400), "x": rng.integers(-50, 6000, 400)})
    want = pt.merge(iv, on="g").query("s <= x <= e")
    got = rangejoin.point_in_interval(spark.createDataFrame(pt), spark.createDataFrame(iv), ["g"], "x", "s", "e", 10.0)
    assert got.count() == len(want)
    other = iv.rename(columns={"s": "s2", "e": "e2", "id": "id2"})
    both = iv.merge(other, on="g").query("s <= e2 and s2 <= e")
    pairs = rangejoin.interval_overlap(spark.createDataFrame(iv), spark.createDataFrame(other), ["g"], ("s", "e"), ("s2", "e2"), 10.0)
    assert pairs.count() == pairs.select("id", "id2").distinct().count() == len(both)


def test_mass_matches(spark):
    peaks = spark.createDataFrame([("p1", 181.0707, 10.0, "positive"), ("p2", 181.0712, 10.01, "positive"), ("p3", 179.0561, 10.0, "negative")], "peak_id string, mz double, rt double, polarity string")
    dim = spark.createDataFrame([("glucose", 180.0634)], "compound_id string, mass double")
    hits = spectra.match_mass(peaks, dim, spectra.adduct_table(spark), ppm=4.3)
    assert {(r["peak_id"], r["adduct"]) for r in hits.collect()} == {("p1", "M+H"), ("p2", "M+H"), ("p3", "M-H")}
    grouped = spectra.empirical_compounds(hits, 0.02)
    assert grouped.select("ec_id").distinct().count() == 1


def test_isotope_pairs(spark):
    features = spark.createDataFrame([("a", 100.0, 5.0, "positive"), ("b", 101.0034, 5.1, "positive"), ("c", 101.0034, 50.0, "positive")], "feature string, mz double, rt double, polarity string")
    got = spectra.annotate_peaks(features, spectra.pair_rules(spark), 0.015, 1.0).collect()
    assert [(r["base"], r["feature"], r["rule"]) for r in got] == [("a", "b", "isotope 13C")]


def test_peak_table_finds_aligns_and_fills(spark):
    rows = []
    for run, shift, scale in (("r1", 0.0, 1.0), ("r2", 4.0, 2.0), ("r3", 0.0, 1.0)):
        for scan in range(20):
            rt = scan * 2.0
            for mz, centre in ((150.0, 10.0), (300.0, 20.0)):
                if run == "r3" and mz == 300.0:
                    if scan == 10:
                        rows.append((run, scan, rt, mz, 7.0))
                    continue
                inten = scale * 100 * math.exp(-((rt - centre - shift) ** 2) / 8)
                if inten > 5:
                    rows.append((run, scan, rt, mz * (1 + 1e-6 * (scan % 2)), inten))
    centroids = spark.createDataFrame(rows, "run string, scan int, rt double, mz double, intensity double")
    table = spectra.peak_profile(centroids, ppm=10, min_scans=3, rt_tol=6.0).toPandas()
    assert table["feature"].nunique() == 2 and len(table) == 6
    heavy = table[table.mz > 200].set_index("sample")
    assert heavy.loc["r3", "filled"] and heavy.loc["r3", "value"] == 7.0
    assert heavy.loc["r2", "value"] == pytest.approx(2 * heavy.loc["r1", "value"], rel=0.05)


def read_table(spark, rows):
    return spark.createDataFrame(rows, "sample string, mate int, read_id string, seq string, qual string")


def test_trimming_by_hand(spark):
    reads = read_table(spark, [("s", 1, "a", "ACGTACGT", "!!IIIII!"), ("s", 1, "b", "ACGTACGT", "IIII!!!!"), ("s", 1, "c", "ACG", "!!!")])
    get = lambda df: {r["read_id"]: (r["seq"], r["qual"]) for r in df.collect()}
    assert get(read_trimming.trim_leading(reads)) == {"a": ("GTACGT", "IIIII!"), "b": ("ACGTACGT", "IIII!!!!"), "c": ("", "")}
    assert get(read_trimming.trim_trailing(reads))["a"] == ("ACGTACG", "!!IIIII")
    window = get(read_trimming.trim_sliding_window(reads))
    assert window["b"][0] == "ACG" and window["c"][0] == "ACG" and window["a"][0] == "ACGTACGT"
    assert read_trimming.drop_short(reads, 8).count() == 2


def test_adapters_are_cut(spark):
    adapter = "AGATCGGAAGAGCACACGTC"
    insert = "ACGTTGCAACGGTATTCCGATAGGCATTACAGGCATCCTTGACCATGGCTAGCAAT"  # 56 matches score 33.7, above the 30 of a pair
    back = insert[::-1].translate(str.maketrans("ACGT", "TGCA"))
    reads = read_table(spark, [("s", 1, "a", insert + adapter, "I" * 76), ("s", 1, "b", insert, "I" * 56), ("s", 1, "p", insert + adapter[:5], "I" * 61), ("s", 2, "p", back + adapter[:5], "I" * 61)])
    adapters = spark.createDataFrame([("ad", adapter)], "name string, seq string")
    got = {(r["read_id"], r["mate"]): r["seq"] for r in read_trimming.clip_adapters(reads, adapters).collect()}
    assert got[("a", 1)] == insert and got[("b", 1)] == insert and len(got[("p", 1)]) == 61
    got = {(r["read_id"], r["mate"]): r["seq"] for r in read_trimming.clip_pairs(reads).collect()}
    assert got[("p", 1)] == insert and got[("p", 2)] == back and got[("b", 1)] == insert
    routed = {(r["read_id"], r["mate"]): r["route"] for r in read_trimming.route_pairs(reads).collect()}
    assert routed[("p", 2)] == "paired" and routed[("a", 1)] == "unpaired"


def test_read_switches(spark):
    assert read_trimming.select_reads("raw", "trimmed", "graft", trim=True, xeno_filter=True) == "graft"
    assert read_trimming.select_reads("raw", "trimmed", None, trim=True, xeno_filter=False) == "trimmed"
    with pytest.raises(ValueError):
        read_trimming.select_reads("raw", None, None, trim=True, xeno_filter=False)


def test_quality_report(spark):
    reads = read_table(spark, [("s", 1, "a", "ACGN", "IIII"), ("s", 1, "b", "ACGN", "!!!!"), ("s", 1, "c", "GG", "II")])
    stats = read_quality.qc_basic_stats(reads).first()
    assert (stats["reads"], stats["bases"], stats["min_length"], stats["gc_percent"]) == (3, 10, 2, 60.0)
    assert {r["pos"]: r["mean"] for r in read_quality.qc_base_quality(reads).collect()}[1] == pytest.approx(80 / 3)
    assert {r["pos"]: r["n"] for r in read_quality.qc_n_content(reads).collect()}[4] == 1.0
    assert {r["level"]: r["reads"] for r in read_quality.qc_duplication(reads).collect()} == {1: 1, 2: 2}
    merged = read_quality.qc_merge({"raw": reads, "trimmed": reads.filter("mate = 1")})
    assert {r["stage"] for r in merged.collect()} == {"raw", "trimmed"}


def test_species_sorting(spark):
    host, graft, common = "ACGTACGGTCA" * 5, "TTGACCATGGC" * 5, "CATCATTACGA" * 5
    genomes = spark.createDataFrame([("host", host), ("graft", graft), ("host", common), ("graft", common)], "origin string, seq string")
    reads = spark.createDataFrame([("s", "h", host), ("s", "g", graft), ("s", "b", common), ("s", "n", "G" * 50), ("s", "a", host), ("s", "a", graft)], "sample string, read_id string, seq string")
    for dna in (False, True):
        index = kmers.kmer_index(genomes, 25, dna)
        got = {r["read_id"]: r["class"] for r in kmers.classify_reads(reads, index, 25, dna=dna).collect()}
        assert got == {"h": "host", "g": "graft", "b": "both", "n": "neither", "a": "ambiguous"}


def test_kmer_index_shuffles_runs_and_gathers_every_kmer(spark):
    rng = np.random.default_rng(37)
    letters = list("ACGTACGTACGTNacgné\U0001f9ec")
    texts = ["".join(rng.choice(letters, int(n))) for n in rng.integers(0, 900, 60)] + ["A" * 700, "ACGT" * 100, "N" * 40, "AC", ""]
    texts += [texts[3], texts[5][::-1].translate(str.maketrans("ACGT", "TGCA"))]
    rows = [(("host", "graft", "other", None)[i % 4], t) for i, t in enumerate(texts)] + [("host", None), ("graft", texts[0]), ("graft", "A" * 300)]
    genomes = spark.createDataFrame(rows, "origin string, seq string").repartition(3)
    for k, dna in ((25, False), (25, True), (7, False), (1, False)):
        want = {}
        for origin, t in rows:
            for i in range(len(t or "") - k + 1):
                word = t[i : i + k]
                if origin not in ("host", "graft") or "N" in word or (dna and set(word) - set("ACGT")):
                    continue
                word = min(word, word[::-1].translate(str.maketrans("ACGT", "TGCA")), key=lambda w: w.encode())
                want[word] = want.get(word, 0) | (1 if origin == "host" else 2)
        if dna:
            want = {int("".join(str("ACGT".index(c)) for c in w), 4): m for w, m in want.items()}
        index = kmers.kmer_index(genomes, k, dna)
        got = [(r["kmer"], r["mask"]) for r in index.collect()]
        assert len(got) == len(want) and dict(got) == want
    # no k-mer is shuffled: the only exchanges are those of the pieces and of the runs
    plan = kmers.kmer_index(genomes, 25)._jdf.queryExecution().toString()
    physical = plan[plan.index("== Physical Plan") :]
    assert "hashpartitioning(kmer" not in physical and "hashpartitioning(_place" in physical


def test_chunks_lose_no_kmers(spark):
    text = "".join(np.random.default_rng(11).choice(list("ACGT"), 1000))
    rows = spark.createDataFrame([("x", text)], "k string, seq string")
    a = kmers.sequence_kmers(rows, ["k"], 25, chunk=64).agg(F.count_distinct("kmer"), F.count("kmer")).first()
    b = kmers.sequence_kmers(rows, ["k"], 25, chunk=5000).agg(F.count_distinct("kmer"), F.count("kmer")).first()
    assert a == b and a[1] == 976


def test_counts_per_gene(spark):
    exons = spark.createDataFrame([("1", 100, 200, "-", "g1"), ("1", 180, 300, "-", "g2"), ("1", 500, 600, "-", "g1"), ("1", 100, 900, "+", "g3")], "chrom string, start int, end int, strand string, gene_id string")
    al = spark.createDataFrame(
        [("s", "one", 0, "1", 110, "20M", 60, 1), ("s", "two", 0, "1", 185, "20M", 60, 1), ("s", "multi", 0, "1", 110, "20M", 60, 2),
         ("s", "intron", 0, "1", 150, "10M380N10M", 60, 1), ("s", "lone", 8, "1", 110, "20M", 60, 1), ("s", "fwd", 16, "1", 700, "20M", 60, 1)],
        "sample string, read_id string, flag int, chrom string, pos int, cigar string, mapq int, nh int",
    )
    got = {r["gene_id"]: r["count"] for r in alignments.count_features(al, exons).collect()}
    assert got == {"g1": 2, "g2": 0, "g3": 1}
    blocks = [(r["block_start"], r["block_end"]) for r in alignments.aligned_blocks(al.filter("read_id = 'intron'")).collect()]
    assert blocks == [(150, 159), (540, 549)]


def test_count_model_finds_the_simulated_changes(spark, counts):
    long, samples = long_table(spark, counts), sample_table(spark, 8, 4)
    factors = matrix.size_factors(long, samples)
    disp = counts_nb.nb_dispersion(long, samples, factors, LEVELS)
    assert 0.05 < disp.agg(F.percentile_approx("dispersion", 0.5)).first()[0] < 0.2
    tests = counts_nb.nb_wald_test(long, samples, factors, LEVELS, disp)
    res = counts_nb.de_results(tests).toPandas().set_index("feature").sort_index()
    assert abs(res.loc[:29, "log2fc"].mean() - 2) < 0.4 and abs(res.loc[30:, "log2fc"].mean()) < 0.3
    assert (res.loc[:29, "padj"] < 0.05).mean() > 0.9 and (res.loc[30:, "padj"] < 0.05).mean() < 0.1


def test_trend_solves_its_score_equations(spark):
    rng = np.random.default_rng(31)
    mean = np.exp(rng.uniform(0, 8, 800))
    y = (3 / mean + 0.08) * rng.gamma(4, 0.25, 800)
    y[:20] *= 60  # far above any trend
    y[20:40] = 1e-9
    genes = spark.createDataFrame(pd.DataFrame({"base_mean": mean, "disp_gene": y})).repartition(5)
    a1, a0 = counts_nb.fit_trend(genes)
    assert abs(a1 - 3) < 0.5 and abs(a0 - 0.08) < 0.02
    scores = {r["coefficient"]: r["score"] for r in counts_nb.trend_scores(genes.withColumn("disp_trend", a1 / F.col("base_mean") + a0)).collect()}
    assert scores.keys() == {"a0", "a1"} and max(map(abs, scores.values())) < 1e-8
    flat = spark.createDataFrame(pd.DataFrame({"base_mean": mean, "disp_gene": 0.2 + 1e-4 * mean / mean.max()}))
    a1, a0 = counts_nb.fit_trend(flat)
    assert a1 == 0 and abs(a0 - 0.2) < 1e-3
    assert counts_nb.fit_trend(genes.limit(0)) == (0.0, 0.1)


def test_an_outlier_among_seven_replicates_is_replaced(spark):
    rng = np.random.default_rng(37)
    mu = np.exp(rng.uniform(3, 7, 200))
    values = rng.negative_binomial(10, 10 / (10 + mu[:, None] * np.ones(14))).astype(float)
    values[0] = [50, 55, 48, 52, 60, 47, 53, 210, 190, 205, 220, 180, 199, 215]
    values[1, :] = values[0]
    values[1, 3] = 9000
    samples = sample_table(spark, 14, 7)
    factors = samples.select("sample").distinct().withColumn("size_factor", F.lit(1.0))
    disp = counts_nb.nb_dispersion(long_table(spark, values), samples, factors, LEVELS).cache()
    tests = counts_nb.nb_wald_test(long_table(spark, values), samples, factors, LEVELS, disp).toPandas().set_index("feature")
    plain = counts_nb.nb_wald_test(long_table(spark, values), samples, factors, LEVELS, disp, refit=False).toPandas().set_index("feature")
    assert np.isnan(plain.loc[1, "p"]) and tests.loc[1, "p"] < 1e-10 and abs(tests.loc[1, "log2fc"] - tests.loc[0, "log2fc"]) < 0.5
    same = [i for i in tests.index if i != 1 and not np.isnan(plain.loc[i, "p"])]
    assert np.allclose(tests.loc[same, ["log2fc", "lfc_se", "p"]], plain.loc[same, ["log2fc", "lfc_se", "p"]])
    # the same by hand: replace the count, fit that feature alone, draw it to the same trend
    k = values[1:2].copy()
    k[0, 3] = int(np.sort(values[1])[2:12].mean())
    second = np.arange(14) >= 7
    mean, own, fitted = counts_nb._gene_wise(k, np.ones(14), second)
    row = disp.filter("feature = 0").first()
    other = disp.filter("feature = 5").first()
    a1 = (row["disp_trend"] - other["disp_trend"]) / (1 / row["base_mean"] - 1 / other["base_mean"])
    trend = row["disp_trend"] + a1 * (1 / mean - 1 / row["base_mean"])
    alpha = counts_nb._shrunk(k, fitted, second, own, trend, row["prior_var"], row["own_limit"])
    lfc, se, _ = counts_nb._wald(k, np.ones(14), second, alpha)
    assert np.allclose(tests.loc[1, ["base_mean", "log2fc", "lfc_se"]].astype(float), [mean[0], lfc[0], se[0]])
    # six replicates: nothing is replaced, the feature has no p
    six = [i for i in range(14) if i not in (0, 13)]
    few = counts_nb.nb_wald_test(long_table(spark, values[:, six]), sample_table(spark, 12, 6), sample_table(spark, 12, 6).select("sample").distinct().withColumn("size_factor", F.lit(1.0)), LEVELS)
    assert few.filter("feature = 1").first()["p"] is None


def test_filter_cut_follows_the_smoothed_curve():
    x = np.linspace(0, 0.95, 50)
    assert np.allclose(counts_nb.local_line(x, 3 * x + 1), 3 * x + 1)
    assert np.allclose(counts_nb.local_line(x, np.full(50, 7.0)), 7)
    known = 200 + 100 * np.minimum(x / 0.4, 1) - 300 * np.maximum(x - 0.7, 0)
    at = counts_nb.smoothed_cut(x, known)
    assert 0.36 < x[at] <= 0.43  # where the plateau begins, not the one best cut
    spiked = known.copy()
    spiked[40] = 330  # one high count does not draw the cut
    assert counts_nb.smoothed_cut(x, spiked) <= at + 1
    assert counts_nb.smoothed_cut(x, np.full(50, 10.0)) == 0
    assert counts_nb.smoothed_cut(x, np.zeros(50)) == 0
    assert counts_nb.smoothed_cut(x, np.full(50, 300.0) - np.arange(50)) == 0


def test_permuted_pathways_are_repeatable(spark):
    rng = np.random.default_rng(12)
    masses = pd.DataFrame({"compound_id": [f"c{i}" for i in range(40)], "mass": 100 + 10.0 * np.arange(40)})
    peaks = pd.DataFrame({"peak_id": range(40), "mz": masses.mass + 1.007276, "rt": rng.random(40) * 100, "polarity": "positive", "p": np.where(np.arange(40) < 8, 0.01, 0.5)})
    links = pd.DataFrame({"compound_id": masses.compound_id, "pathway_id": ["hit" if i < 10 else f"p{i % 3}" for i in range(40)]})
    args = [spark.createDataFrame(x) for x in (peaks, masses)]
    adducts = spectra.adduct_table(spark).filter("adduct = 'M+H'")
    run = lambda parts: enrichment.mummichog(args[0].repartition(parts), args[1], adducts, spark.createDataFrame(links), n_perm=20)
    first = {r["pathway_id"]: (round(r["p"], 12), r["p_perm"]) for r in run(1).collect()}
    assert first == {r["pathway_id"]: (round(r["p"], 12), r["p_perm"]) for r in run(5).collect()}
    assert first["hit"][0] < 1e-4 and first["hit"][1] <= 0.05


def test_draws_take_the_smallest_hashes(spark, monkeypatch):
    ids = [f"peak{i}" for i in range(7000)]
    peaks = spark.createDataFrame([(x, i % 13 == 0) for i, x in enumerate(ids)], "peak_id string, real boolean").repartition(5)
    peaks = peaks.select("peak_id", F.xxhash64("peak_id", F.lit(1)).alias("h"), "real")
    h = {r["peak_id"]: r["h"] for r in peaks.collect()}
    hashes = enrichment.draw_hashes(np.array([h[x] for x in ids]), 100)
    k = sum(i % 13 == 0 for i in range(7000))
    want = np.zeros((7000, 101), bool)
    want[::13, 0] = True
    for d in range(100):
        want[np.argsort(hashes[:, d])[:k], d + 1] = True
    for few in (4096, 3):
        monkeypatch.setattr(enrichment, "_FEW", few)
        got = {r["peak_id"]: [r["w0"], r["w1"]] for r in enrichment.draw_words(peaks, 100).collect()}
        bits = np.unpackbits(np.array([got[x] for x in ids]).view(np.uint8), axis=1, bitorder="little")
        assert (bits[:, :101].astype(bool) == want).all() and not bits[:, 101:].any()
    assert enrichment.draw_words(peaks.withColumn("real", F.lit(False)), 100).filter("w0 <> 0 or w1 <> 0").count() == 0
    assert enrichment.draw_words(peaks.withColumn("real", F.lit(True)), 63).filter("w0 <> -1").count() == 0


def test_bits_are_counted_by_key(spark):
    rng = np.random.default_rng(5)
    rows = [(f"k{rng.integers(30)}", int(rng.integers(-(2**63), 2**63 - 1)), int(rng.integers(0, 2**37))) for _ in range(500)]
    table = spark.createDataFrame(rows, "key string, w0 long, w1 long").repartition(3)
    want = {}
    for key, *words in rows:
        for bit in np.flatnonzero(np.unpackbits(np.array(words).view(np.uint8), bitorder="little")[:101]):
            want[key, int(bit)] = want.get((key, int(bit)), 0) + 1
    for most in (1, 1000):
        assert {(r["key"], r["bit"]): r["n"] for r in enrichment.bit_counts(table, "key", 101, most).collect()} == want


def test_permuted_pathways_equal_plain_draws(spark):
    """The whole test against sets of peaks drawn one by one."""
    rng = np.random.default_rng(14)
    masses = pd.DataFrame({"compound_id": [f"c{i}" for i in range(60)], "mass": 100 + 10.0 * np.arange(60)})
    of = rng.integers(0, 60, 400)
    peaks = pd.DataFrame({"peak_id": range(400), "mz": masses.mass.to_numpy()[of] + 1.007276, "rt": of * 10.0, "polarity": "positive", "p": rng.random(400)})
    links = pd.DataFrame([(f"c{i}", f"p{j}") for i in range(50) for j in range(6) if (i * 7 + j * 3) % 4 == 0], columns=["compound_id", "pathway_id"])
    adducts = spectra.adduct_table(spark).filter("adduct = 'M+H'")
    got = enrichment.mummichog(*[spark.createDataFrame(x) for x in (peaks, masses)], adducts, spark.createDataFrame(links), p_cut=0.1, n_perm=70).toPandas()
    h = spark.createDataFrame(peaks[["peak_id"]]).select("peak_id", F.xxhash64("peak_id", F.lit(1)).alias("h")).toPandas().set_index("peak_id")["h"].reindex(range(400)).to_numpy()
    real = np.flatnonzero(peaks.p < 0.1)
    drawn = [real, *(np.argsort(enrichment.draw_hashes(h, 70)[:, d])[: len(real)] for d in range(70))]
    paths = {name: {int(c[1:]) for c in own} & set(of.tolist()) for name, own in links.groupby("pathway_id")["compound_id"]}
    everything = set().union(*paths.values())

    def upper(x, n, size, total):
        return sum(math.comb(size, i) * math.comb(total - size, n - i) for i in range(x, min(size, n) + 1)) / math.comb(total, n)

    p = []
    for own in drawn:
        hit = {int(of[i]) for i in own} & everything
        p.append({name: (len(hit & s), len(hit), upper(len(hit & s), len(hit), len(s), len(everything))) for name, s in paths.items() if hit & s and len(s) >= 3})
    null = [x[2] for own in p[1:] for x in own.values()]
    assert len(got) == len(p[0])
    for r in got.itertuples():
        hits, n, value = p[0][r.pathway_id]
        assert (r.set_size, r.hit_count, r.n_drawn) == (len(paths[r.pathway_id]), hits, n) and abs(r.p - value) < 1e-9
        low, high = (np.mean([x <= value + d for x in null]) for d in (-1e-9, 1e-9))  # equal values in other roundings
        assert low <= r.p_perm <= high and high - low < 0.2


def test_adapter_content_equals_a_search_for_each_adapter(spark):
    rng = np.random.default_rng(41)
    reads = ["".join(rng.choice(list("ACGÄ"), rng.integers(0, 40))) for _ in range(300)] + ["", "ACACACAC", "🙂ACGT🙂"]
    adapters = sorted({"".join(rng.choice(list("ACGÄ"), rng.integers(1, 6))) for _ in range(120)} | {"ACAC", "AC", "C", "🙂", "CGT", "TTTT"})
    machine = read_quality.automaton(adapters)
    got = set(zip(*(x.tolist() for x in read_quality.first_hits(reads, machine)), strict=True))
    assert got == {(i, j, r.index(a) + 1) for i, r in enumerate(reads) for j, a in enumerate(adapters) if a in r}
    table = read_table(spark, [("s" if i % 2 else "t", 1, str(i), r, "I" * len(r)) for i, r in enumerate(reads)])
    listed = spark.createDataFrame([*[(f"a{j}", a) for j, a in enumerate(adapters)], ("again", "AC"), ("none", ""), ("null", None)], "name string, seq string")
    want = {}
    for sample in "st":
        own = [r for i, r in enumerate(reads) if (i % 2 == 1) == (sample == "s")]
        for name, a in [*[(f"a{j}", a) for j, a in enumerate(adapters)], ("again", "AC")]:
            starts = sorted(r.index(a) + 1 for r in own if a in r)
            for pos in set(starts):
                want[sample, name, pos] = round(sum(x <= pos for x in starts) / len(own), 9)
    for group in (1, 50, 1 << 18):
        shares = read_quality.qc_adapter_content(table, listed, group).collect()
        assert {(x["sample"], x["adapter"], x["pos"]): round(x["share"], 9) for x in shares} == want
    assert read_quality.qc_adapter_content(table, listed.limit(0)).count() == 0


def test_short_adapters_and_short_reads_are_searched(spark):
    adapter = "AGATCGGAAGAG"
    reads = read_table(spark, [("s", 1, "a", "CCTTGGCCAATTCCGG" + adapter, "I" * 28), ("s", 1, "b", "CCTTGGCCAATT", "I" * 12), ("s", 1, "c", adapter[:11], "I" * 11)])
    adapters = spark.createDataFrame([("ad", adapter)], "name string, seq string")
    got = {r["read_id"]: r["seq"] for r in read_trimming.clip_adapters(reads, adapters, seeds=0, simple=5).collect()}
    assert got == {"a": "CCTTGGCCAATTCCGG", "b": "CCTTGGCCAATT", "c": ""}


def test_seeds_found_by_parts_equal_those_tried_everywhere():
    rng = np.random.default_rng(53)

    def word(n, letters):
        return "".join(rng.choice(list(letters), n))

    for trial in range(24):
        letters = ["ACGT", "ACGTÄ", "AC"][trial % 3]
        adapters = [word(rng.integers(1, 40), letters) for _ in range(rng.integers(1, 12))]
        reads = []
        for _ in range(30):
            read, adapter = list(word(rng.integers(0, 120), letters)), list(adapters[rng.integers(len(adapters))])
            for _ in range(rng.integers(0, 4)):
                adapter[rng.integers(len(adapter))] = rng.choice(list(letters))
            at = rng.integers(len(read) + 1)
            read[at:at] = adapter if rng.random() < 0.7 else []
            reads.append("".join(read))
        quals = ["".join(chr(33 + int(v)) for v in rng.integers(0, 42, len(x) if trial % 5 else len(x) // 2)) for x in reads]
        codes = [read_trimming._codes(a) for a in sorted(set(adapters))]
        for seeds, seed_length in ((0, 16), (1, 5), (2, 16), (3, 16), (2, 5)):
            args = (pd.Series(reads), pd.Series(quals), codes, seeds, 5.0, seed_length, 33)
            assert (read_trimming._clip_places(*args) == read_trimming._tried_places(*args)).all()


def test_a_key_with_half_the_rows_is_spread(spark):
    rows = spark.range(60_000).selectExpr("if(id % 2 = 0, 0, id) AS k", "id % 3 AS v").repartition(6)
    dim = spark.range(60_000).selectExpr("id AS k", "id * 10 AS w")
    joined = skew.spread_join(rows, dim, ["k"])
    assert joined.count() == 60_000 and joined.filter("k * 10 <> w").count() == 0
    assert skew.spread_join(rows, dim.filter("k > 0"), ["k"], "left").filter("w is null").count() == 30_000
    # counted in a part of the rows, in none, or in rows that do not stand for the others: the result is the same
    for probe in (rows.sample(0.2, seed=3), rows.limit(0), rows.filter("k = 7")):
        joined = skew.spread_join(rows, dim, ["k"], probe=probe, probed=0.2)
        assert joined.count() == 60_000 and joined.filter("k * 10 <> w").count() == 0
    with pytest.raises(ValueError):
        skew.spread_join(rows, dim, ["k"], hot_share=0.0)


def test_far_blocks_are_skipped_and_no_pair_is_lost(spark):
    rng = np.random.default_rng(47)
    centres = rng.normal(size=(12, 8)) * 4
    values = centres[rng.integers(0, 12, 600)] + rng.normal(size=(600, 8)) * 0.3
    values[:40] = -values[40:80]  # opposite features
    values[80:140] = values[80]  # one cell with many equal features
    long, samples = long_table(spark, values), sample_table(spark, 8, 4)
    unit = values - values.mean(axis=1, keepdims=True)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    r = unit @ unit.T
    got = {(x["a"], x["b"]): x["r"] for x in similarity.feature_correlation(long, samples, min_abs=0.95, block_rows=20).collect()}
    sure, maybe = ({(i, j) for i, j in zip(*np.nonzero(np.triu(np.abs(r) >= 0.95 + d, 1)), strict=True)} for d in (1e-9, -1e-9))
    assert sure <= got.keys() <= maybe and all(abs(v - r[k]) < 1e-9 for k, v in got.items()) and any(v < 0 for v in got.values())
    d = np.sqrt(((values[:, None] - values[None]) ** 2).sum(axis=2))
    found = {(x["a"], x["b"]): x["distance"] for x in similarity.pairwise_distance(long, samples, by="feature", max_distance=2.0, block_rows=20).collect()}
    assert found.keys() == {(i, j) for i, j in zip(*np.nonzero(np.triu(d <= 2, 1) | np.triu(d == 0, 1)), strict=True)}
    vectors = similarity.feature_vectors(long, samples)
    assert similarity.feature_blocks(vectors, 2.0, block_rows=20).skipped > 0.5
    everything = similarity.feature_blocks(vectors, None, block_rows=20)
    assert everything.skipped == 0 and similarity.feature_blocks(vectors, 1e9, block_rows=20).skipped == 0


def test_quality_trims_against_plain_loops_in_arrays(spark, monkeypatch):
    import random

    rng = random.Random(9)
    texts = ["", "!", "I", "!!!I", *["".join(rng.choices('!"#$%5I~é☃', k=rng.randint(0, 40))) for _ in range(300)]]
    rows = [(str(i), "s", 1, "".join(rng.choices("ACGT", k=len(t))), t) for i, t in enumerate(texts)] + [("n", "s", 1, "ACGT", None), ("m", "s", 1, None, "!!I")]
    reads = spark.createDataFrame(rows, "read_id string, sample string, mate int, seq string, qual string")
    quality = lambda t: [min(93, ord(c) - 33) for c in t]

    def leading(t):
        return t[next((i for i, x in enumerate(quality(t)) if x >= 3), len(t)) :]

    def window(t):
        q = quality(t)
        return t[: next((i for i in range(len(t) - 3) if sum(q[i : i + 4]) < 60), len(t))]

    for cells in (1, 50, 1 << 22):  # stretches of a read, of some and of all of them
        monkeypatch.setattr(read_trimming, "_CELLS", cells)
        for trim, want in ((read_trimming.trim_leading, leading), (read_trimming.trim_trailing, lambda t: leading(t[::-1])[::-1]), (read_trimming.trim_sliding_window, window)):
            cut = trim(reads)
            # no array of a read's letters is made of rows' columns any more
            assert "transform(" not in cut._jdf.queryExecution().optimizedPlan().toString()
            got = {r["read_id"]: r for r in cut.collect()}
            assert all(got[str(i)]["qual"] == want(t) and len(got[str(i)]["seq"]) == len(want(t)) for i, t in enumerate(texts))
            assert got["n"]["qual"] is None and got["m"]["seq"] is None and got["n"]["seq"] == ("ACGT" if want is window else "")


def test_features_are_sent_to_a_bounded_number_of_tasks(spark, monkeypatch):
    rng = np.random.default_rng(48)
    values = rng.normal(size=(500, 8))
    long, samples = long_table(spark, values), sample_table(spark, 8, 4)
    blocks = similarity.feature_blocks(similarity.feature_vectors(long, samples), 1e9, block_rows=5)
    assert blocks.n_blocks >= 100 and blocks.skipped == 0
    # a task for each pair of blocks would be sent each feature as often as there are blocks
    assert similarity._sent(blocks, 4)[0].count() <= 500 * 4
    monkeypatch.setattr(similarity, "_BLOCKS", 9)
    few = similarity.feature_blocks(similarity.feature_vectors(long, samples), 1e9, block_rows=5)
    assert few.n_blocks <= 2 * 9
    unit = values - values.mean(axis=1, keepdims=True)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    r = unit @ unit.T
    for groups in (1, 3):
        monkeypatch.setattr(similarity, "_GROUPS", groups)
        got = [((x["a"], x["b"]), x["r"]) for x in similarity.feature_correlation(long, samples, min_abs=0.8, block_rows=5).collect()]
        assert sorted(k for k, _ in got) == sorted(zip(*np.nonzero(np.triu(np.abs(r) >= 0.8, 1)), strict=True))
        assert all(abs(v - r[k]) < 1e-9 for k, v in got)


def test_out_of_bag_votes_follow_from_the_weights(spark):
    rng = np.random.default_rng(23)
    rows = [(i, "abc"[i % 3], [float(x) for x in rng.normal(i % 3, 1.5, 6)]) for i in range(90)]
    data = spark.createDataFrame(rows, "id long, label string, features array<double>").repartition(4)
    grown = forest.grow(data, trees=25, per_split=3, seed=5)
    weights = forest.bootstrap_weights(data, 25, 5).toPandas().pivot(index="id", columns="tree", values="weight")
    assert 0.3 < (weights.to_numpy() == 0).mean() < 0.45 and abs(weights.to_numpy().mean() - 1) < 0.1
    made = grown.prepared.toPandas().set_index("id").sort_index()
    x = np.stack([np.frombuffer(b, np.uint8) for b in made["x"]])
    got = forest.votes(grown).toPandas().set_index("id").sort_index()
    assert grown.labels == ["a", "b", "c"]
    for i in range(90):
        want = [0, 0, 0]
        for t in range(25):
            node = 0
            while grown.feature[t, node] >= 0:
                node = grown.child[t, node] + (x[i, grown.feature[t, node]] > grown.limit[t, node])
            want[grown.winner[t, node]] += weights.loc[i, t] == 0
        assert list(got.loc[i, "votes"]) == want and got.loc[i, "predicted"] == "abc"[int(np.argmax(want))]
    table = {(r["label"], r["predicted"]): r["n"] for r in forest.random_forest(data, trees=25, per_split=3, seed=5).collect()}
    assert table == got.groupby(["label", "predicted"]).size().to_dict()
    again = forest.grow(data.repartition(7), trees=25, per_split=3, seed=5)
    assert all(np.array_equal(a, b) for a, b in zip(grown[:5], again[:5]))


def test_trees_equal_a_plain_search(spark):
    """All features at every split: the best split of each node by trying every feature and bin on the weighted samples."""
    rng = np.random.default_rng(29)
    rows = [(i, "uv"[int(rng.random() < 0.5 + 0.4 * (i % 2))], [float(x) for x in rng.integers(0, 9, 4)]) for i in range(70)]
    data = spark.createDataFrame(rows, "id long, label string, features array<double>")
    grown = forest.grow(data, trees=6, per_split=4, seed=2)
    weights = forest.bootstrap_weights(data, 6, 2).toPandas().pivot(index="id", columns="tree", values="weight").sort_index().to_numpy()
    made = grown.prepared.toPandas().sort_values("id")
    x, y = np.stack([np.frombuffer(b, np.uint8) for b in made["x"]]).astype(int), made["y"].to_numpy()

    def gini(w):
        return w.sum() - (w**2).sum() / w.sum() if w.sum() else 0.0

    def check(t, node, some):
        w = weights[some, t]
        classes = np.bincount(y[some], weights=w, minlength=2)
        assert grown.winner[t, node] == classes.argmax()
        gains = {}
        for f in range(4):
            for limit in range(x[:, f].max()):
                left = x[some, f] <= limit
                sides = [np.bincount(y[some][s], weights=w[s], minlength=2) for s in (left, ~left)]
                if all(side.sum() for side in sides):
                    gains[f, limit] = gini(classes) - sum(gini(side) for side in sides)
        if grown.feature[t, node] < 0:
            assert (classes > 0).sum() < 2 or max(gains.values(), default=0) < 1e-9
            return
        own = gains[grown.feature[t, node], grown.limit[t, node]]
        assert abs(own - max(gains.values())) < 1e-9 and abs(own - grown.decrease[t, node]) < 1e-9
        right = x[some, grown.feature[t, node]] > grown.limit[t, node]
        check(t, grown.child[t, node], some[~right])
        check(t, grown.child[t, node] + 1, some[right])

    for t in range(6):
        check(t, 0, np.arange(70))


def test_best_splits_of_occurring_cells_equal_those_of_full_tables():
    rng = np.random.default_rng(41)
    nodes, places, classes = 30, 3, 4
    table = rng.integers(0, 3, (nodes, places, forest.BINS, classes)) * (rng.random((nodes, places, forest.BINS, classes)) < 0.03)
    table[0] = 0
    table[1, :, :, :] = 0
    table[1, :, 5, 2] = 4  # one bin: nothing to split
    left = table.cumsum(axis=2).astype(float)
    right = left[:, :, -1:] - left
    def gini(t):
        return t.sum(axis=3) - (t**2).sum(axis=3) / np.maximum(t.sum(axis=3), 1e-300)
    gain = gini(left[:, :, -1:]) - gini(left) - gini(right)
    gain[(left.sum(axis=3) == 0) | (right.sum(axis=3) == 0)] = -1
    cell = rng.permutation(np.flatnonzero(table))
    found = forest._best_splits(np.repeat(cell, 2), np.repeat(table.ravel()[cell], 2) / 2, places, classes)
    assert found[0].tolist() == [n for n in range(nodes) if table[n].any()] and 0 not in found[0]
    for node, most, place, last, whole, one, two, mixed_one, mixed_two in zip(*found, strict=True):
        assert most == gain[node].max()
        if most > 0:
            assert (place, last) == np.unravel_index(gain[node].argmax(), gain[node].shape)
            a, b = left[node, place, last], right[node, place, last]
            assert (whole, one, two, mixed_one, mixed_two) == ((a + b).argmax(), a.argmax(), b.argmax(), (a > 0).sum() > 1, (b > 0).sum() > 1)


def test_forest_walks_samples_of_one_file_in_many_tasks(spark):
    data = spark.range(900).selectExpr("id", "if(id % 3 = 0, 'a', 'b') AS label", "array(id % 7D, cast(id % 3 AS double)) AS features").coalesce(1)
    grown = forest.grow(data, trees=3, per_split=2)
    assert grown.prepared.rdd.getNumPartitions() > 1
    # sums above 255 need more than one byte: all weights reach the root, whose best split parts the classes
    assert (grown.feature[:, 0] == 1).all() and (grown.limit[:, 0] == 0).all()
    weights = forest.bootstrap_weights(data, 3).join(data, "id").groupBy("tree", "label").agg(F.sum("weight").alias("w")).collect()
    for t in range(3):
        a, b = (next(r["w"] for r in weights if (r["tree"], r["label"]) == (t, x)) for x in "ab")
        assert grown.decrease[t, 0] == pytest.approx(2 * a * b / (a + b))


def test_dispersions_are_searched_in_blocks_with_one_log_gamma_a_count(monkeypatch):
    rng = np.random.default_rng(43)
    s, second = np.exp(rng.normal(0, 0.2, 8)), np.arange(8) >= 4
    k = rng.negative_binomial(2, 2 / (2 + 50 * s), (2500, 8)).astype(float)
    mu = np.maximum(k.mean(axis=1, keepdims=True), 0.5) * s
    ln_gamma, asked = counts_nb._ln_gamma, []
    monkeypatch.setattr(counts_nb, "_ln_gamma", lambda z: asked.append(z.shape) or ln_gamma(z))
    for prior in ((), (np.full(2500, math.log(0.3)), 0.5)):
        asked.clear()
        best = counts_nb._best_dispersion(k, mu, second, *prior)
        assert max(rows for rows, _ in asked) == 1024 and {columns for _, columns in asked} == {1, 8}
        monkeypatch.setattr(counts_nb, "_CELLS", 1 << 20)
        assert np.array_equal(best, counts_nb._best_dispersion(k, mu, second, *prior))
        monkeypatch.setattr(counts_nb, "_CELLS", 1 << 13)

        def value(x, prior=prior):
            return counts_nb._profile(k, mu, second, x) - ((x - prior[0]) ** 2 / (2 * prior[1]) if prior else 0)

        low, high = math.log(counts_nb.MIN_DISPERSION), math.log(counts_nb.MAX_DISPERSION)
        for off in (-1e-3, 1e-3, -0.3, 0.3):
            assert (value(best) >= value(np.clip(best + off, low, high)) - 1e-9).all()
    assert counts_nb._best_dispersion(k[:0], mu[:0], second).shape == (0,)


def test_forest_separates_classes_and_finds_the_outlier(spark):
    rng = np.random.default_rng(3)
    rows = [(i, "a" if i < 30 else "b", [float(x) for x in rng.normal(0 if i < 30 else 6, 1, 5)]) for i in range(60)]
    rows[0] = (0, "a", [6.0] * 5)
    data = spark.createDataFrame(rows, "id long, label string, features array<double>")
    table = {(r["label"], r["predicted"]): r["n"] for r in forest.random_forest(data, trees=20, per_split=2).collect()}
    assert table[("a", "a")] >= 28 and table[("b", "b")] == 30
    weights = forest.rf_importance(data, trees=20, per_split=2).collect()
    assert len(weights) == 5 and math.isclose(sum(r["importance"] for r in weights), 1)
    scores = {r["id"]: r["outlier"] for r in forest.rf_outlier(data, trees=20, per_split=2).collect()}
    assert len(scores) == 60
    mixed = [(i, r[1], [float(x) for x in rng.normal(0 if i < 30 else 2, 1, 5)]) for i, *r in rows]
    mixed[0] = (0, "a", [2.0] * 5)
    mixed = spark.createDataFrame([(i, "a" if i < 30 else "b", x) for i, _, x in mixed], "id long, label string, features array<double>")
    scores = {r["id"]: r["outlier"] for r in forest.rf_outlier(mixed, trees=40, per_split=2).collect() if r["label"] == "a"}
    assert len(scores) == 30 and sorted(scores, key=scores.get)[-3:].count(0) == 1


def test_isotope_pairs_send_a_feature_once_a_cell_and_not_once_a_rule(spark):
    rng = np.random.default_rng(3)
    rows = [(f"f{i}", float(m), float(t), "positive" if i % 3 else "negative") for i, (m, t) in enumerate(zip(rng.integers(100, 160, 400) + rng.normal(0, 0.01, 400), rng.integers(0, 40, 400) / 4, strict=True))]
    rows += [("n", None, 1.0, "positive"), ("x", float("nan"), 1.0, "positive"), ("t", 120.0, None, "positive"), ("p", 120.0, 1.0, None), (None, 121.0, 1.0, "positive"), rows[1]]
    rules = [("one", 1.0, "positive"), ("one", 1.0, "positive"), ("back", -2.0, "positive"), ("two", 2.0, "negative"), ("none", None, "negative")]
    features = spark.createDataFrame(rows, "feature string, mz double, rt double, polarity string")
    found = spectra.annotate_peaks(features, spark.createDataFrame(rules, "rule string, delta double, polarity string"), 0.015, 0.5)
    want = sorted(
        (p, a, b, rule, y - x)
        for a, x, s, p in rows
        for b, y, t, q in rows
        for rule, delta, of in rules
        if None not in (a, b, x, y, s, t, delta) and p == q == of and a != b and abs(y - (x + delta)) <= 0.015 and abs(t - s) <= 0.5
    )
    assert sorted(map(tuple, found.collect())) == want and len(want) > 50
    # a join of rows copied for every rule and cell needs twenty times the features on disk
    assert "SortMergeJoin" not in found._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" not in found._jdf.queryExecution().executedPlan().toString()


def test_mass_matches_never_broadcast_the_exploded_masses(spark):
    peaks = spark.range(2000).selectExpr("concat('p', id) AS peak_id", "100 + id / 10 AS mz", "1.0D AS rt", "'positive' AS polarity")
    dim = spark.range(500).selectExpr("id AS compound_id", "100 + id / 5 AS mass")
    hits = spectra.match_mass(peaks, dim, spectra.adduct_table(spark), ppm=10)
    plan = hits._jdf.queryExecution().optimizedPlan().toString()
    assert "strategy=merge" in plan
    shifts = [(a, s) for a, s, _, p in spectra.ADDUCTS if p == "positive"]
    want = sum(abs(100 + i / 10 - (100 + c / 5 + s)) <= (100 + c / 5 + s) * 10 / 1e6 for i in range(2000) for c in range(500) for _, s in shifts)
    assert hits.count() == want


def test_permuted_pathways_count_isomers_without_matching_each(spark, monkeypatch):
    rng = np.random.default_rng(15)
    masses = pd.DataFrame([(f"c{i}", 100 + 10.0 * (i % 8)) for i in range(48)] + [("c1", 170.0), ("c1", 110.0), ("c9", None)], columns=["compound_id", "mass"])
    peaks = pd.DataFrame([(f"q{i}", 101.007276 + 10.0 * (i % 9), float(rng.integers(300)), "positive", rng.random()) for i in range(300)], columns=["peak_id", "mz", "rt", "polarity", "p"])
    links = pd.DataFrame([(f"c{i}", f"p{i % 5}") for i in range(44)] + [("c3", "p0"), ("c3", "p0")], columns=["compound_id", "pathway_id"])
    adducts = spectra.adduct_table(spark).filter("adduct = 'M+H'")
    tables = [spark.createDataFrame(x) for x in (peaks, masses)]
    matched = []

    def seen(*args):
        matched.append(spectra.match_mass(*args))
        return matched[-1]

    monkeypatch.setattr(enrichment, "match_mass", seen)
    got = {r["pathway_id"]: (r["set_size"], r["hit_count"], r["n_drawn"]) for r in enrichment.mummichog(*tables, adducts, spark.createDataFrame(links), rt_window=20.0, p_cut=0.2, n_perm=10).collect()}
    # every compound by itself
    hits = spectra.match_mass(*tables, adducts).select("peak_id", "compound_id", "rt")
    own = spectra.empirical_compounds(hits, 20.0).toPandas().merge(links.drop_duplicates(), on="compound_id").merge(peaks[["peak_id", "p"]], on="peak_id")
    drawn = own[own.p < 0.2]
    n_drawn = drawn[["compound_id", "ec_id"]].drop_duplicates().shape[0]
    sizes, found = (t[["pathway_id", "compound_id", "ec_id"]].drop_duplicates().groupby("pathway_id").size() for t in (own, drawn))
    assert got == {p: (sizes[p], n, n_drawn) for p, n in found.items()} and len(got) == 5
    # eight masses, and one compound of two
    assert matched[0].select("compound_id").distinct().count() <= 9 < hits.select("compound_id").distinct().count()


def test_overlapping_exons_of_a_gene_meet_a_read_once(spark, monkeypatch):
    rng = np.random.default_rng(4)
    exons = [(f"c{i % 2}", int(s), int(s + n), "+-"[i % 2], None if i == 7 else f"g{i % 5}") for i, (s, n) in enumerate(zip(rng.integers(0, 3000, 200), rng.integers(1, 60, 200), strict=True))]
    exons += [("c0", 50, 40, "+", "g0"), ("c0", None, 40, "+", "g0"), exons[0]]
    reads = [("s", i, 16 * int(rng.integers(2)), f"c{i % 2}", int(rng.integers(0, 3000)), "20M30N10M", 60, 1) for i in range(300)]
    table = spark.createDataFrame(exons, "chrom string, start int, end int, strand string, gene_id string")
    seen = []

    def overlap(*args):
        seen.append(rangejoin.interval_overlap(*args))
        return seen[-1]

    monkeypatch.setattr(alignments, "interval_overlap", overlap)
    got = alignments.count_features(spark.createDataFrame(reads, "sample string, read_id long, flag int, chrom string, pos int, cigar string, mapq int, nh int"), table, paired=False, strand=1)
    want = {}
    for _, _, flag, chrom, pos, *_ in reads:
        blocks = [(pos, pos + 19), (pos + 50, pos + 59)]
        genes = {g for c, s, e, strand, g in exons if s is not None and c == chrom and strand == ("-" if flag else "+") and s <= e and any(a <= e and s <= b for a, b in blocks)} - {None}
        if len(genes) == 1:
            want[min(genes)] = want.get(min(genes), 0) + 1
    assert {r["gene_id"]: r["count"] for r in got.collect() if r["count"]} == want and len(want) >= 4
    # at most one hit for a block and a stretch that a gene covers
    merged = rangejoin.merged_intervals(table, ["chrom", "strand", "gene_id"], "start", "end").toPandas().sort_values("start")
    assert all((own["start"].to_numpy()[1:] > own["end"].to_numpy()[:-1]).all() for _, own in merged.groupby(["chrom", "strand", "gene_id"], dropna=False))
    covered = {(c, st, g, x) for c, s, e, st, g in exons if s is not None for x in range(s, e + 1)}
    assert sum(merged["end"] - merged["start"] + 1) == len(covered)


def test_isomers_are_grouped_once_and_told_for_each(spark):
    masses = spark.createDataFrame([(f"c{i}", 100.0 + 10 * (i % 3)) for i in range(9)] + [("c8", 120.0), ("c7", 130.0), (None, 100.0), ("n", None)], "compound_id string, mass double")
    peaks = spark.createDataFrame([(f"p{i}", 101.007276 + 10 * (i % 4), float(i * 7 % 60), "positive") for i in range(60)], "peak_id string, mz double, rt double, polarity string")
    adducts = spectra.adduct_table(spark)
    forms, members = spectra.mass_classes(masses)
    matches = spectra.match_mass(peaks, forms, adducts)
    told = spectra.empirical_compounds(matches, 10.0, members)
    plain = spectra.empirical_compounds(spectra.match_mass(peaks, masses, adducts), 10.0)
    columns = ["peak_id", "compound_id", "adduct", "rt", "ec_id"]
    rows = sorted(map(tuple, plain.select(*columns).collect()))
    assert sorted(map(tuple, told.select(*columns).collect())) == rows
    assert matches.count() < len(rows)


def test_characters_are_counted_before_they_are_rows(spark, monkeypatch):
    rng = np.random.default_rng(6)
    rows = [(f"s{i % 1500}" if i % 50 else None, i % 2 + 1, "".join(rng.choice(list("ACGTNé𝄞"), int(rng.integers(0, 6))))) for i in range(4000)] + [("s1", 1, None)]
    reads = spark.createDataFrame([(s, m, f"r{i}", q, q) for i, (s, m, q) in enumerate(rows)], "sample string, mate int, read_id string, seq string, qual string").coalesce(1)
    want = {}
    for sample, mate, text in rows:
        for at, c in enumerate(text or ["", ""][: text is not None]):
            want[sample, mate, at + 1, c] = want.get((sample, mate, at + 1, c), 0) + 1
    for held in (1 << 21, 10):
        monkeypatch.setattr(read_quality, "_HELD", held)
        found = read_quality._by_position(reads, "qual", "c")
        assert {tuple(r)[:4]: r["n"] for r in found.collect()} == want
    assert "Generate" not in found._jdf.queryExecution().optimizedPlan().toString()


def test_the_query_of_feature_correlation_returns_all_pairs(spark, tmp_path, monkeypatch):
    rng = np.random.default_rng(61)
    rows = [(part, s, float(q)) for part in range(1, 13) for s, q in zip(range(1, 9), rng.integers(1, 50, 8))]
    spark.createDataFrame(rows, "l_partkey long, l_suppkey long, l_quantity double").write.parquet(str(tmp_path / "lineitem.parquet"))
    spark.createDataFrame([(s,) for s in range(1, 9)], "s_suppkey long").write.parquet(str(tmp_path / "supplier.parquet"))
    got = {(r["a"], r["b"]): r["r"] for r in matrix_queries.feature_correlation(spark, str(tmp_path)).collect()}
    assert set(got) == {(a, b) for a in range(1, 13) for b in range(a + 1, 13)} and min(map(abs, got.values())) < 0.5
    # all pairs as well are made by tasks that get two groups of blocks
    monkeypatch.setattr(similarity, "_GROUPS", 2)
    sent, of = [], similarity._sent
    monkeypatch.setattr(similarity, "_sent", lambda *a: sent.append(of(*a)) or sent[-1])
    long, samples = long_table(spark, rng.normal(size=(60, 5))), sample_table(spark, 5, 2)
    assert similarity.feature_correlation(long, samples, block_rows=6).count() == 60 * 59 // 2
    assert sent[0][0].count() <= 60 * 2 and len(sent[0][1]) <= 3


def test_pairs_are_clipped_with_one_shuffle_like_joined_pairs(spark, monkeypatch):
    rng = np.random.default_rng(67)
    adapter, rows = "AGATCGGAAGAGCACACGTC", []

    def back(text):
        return text[::-1].translate(str.maketrans("ACGT", "TGCA"))

    for i in range(60):
        insert = "".join(rng.choice(list("ACGT"), int(rng.integers(20, 140))))
        one, two = insert + adapter[: int(rng.integers(0, 9))], back(insert) + adapter[: int(rng.integers(0, 9))]
        rows += [("s" if i % 9 else None, 1, i // 2 if i % 5 == 0 else i + 100, one, "I" * len(one)), ("s" if i % 9 else None, 2, i // 2 if i % 5 == 0 else i + 100, two, "I" * len(two))]
    rows += [*rows[20:50], ("s", 3, 101, "ACGT", "IIII"), ("s", None, 101, "ACGT", "IIII"), ("s", 1, None, "ACGT" * 9, "I" * 36), ("s", 2, None, "ACGT" * 9, "I" * 36), ("s", 1, 900, None, "III"), ("s", 2, 900, "ACGTA", None), ("s", 1, 901, "ACG", "IIIII")]
    reads = spark.createDataFrame([(*r, f"n{k}") for k, r in enumerate(rows)], "sample string, mate int, read_id long, seq string, qual string, note string").repartition(3)
    want = []
    for sample, mate, read_id, seq, qual, note in map(tuple, reads.collect()):
        own = [r for r in rows if None not in (r[0], r[2]) and (r[0], r[2]) == (sample, read_id)]
        inserts = [
            int(read_trimming._insert_lengths(pd.Series([a[3] or ""]), pd.Series([a[4] or ""]), pd.Series([back(b[3] or "")]), 30, 2, 16, 33)[0])
            for a in own for b in own if a[1] == 1 and b[1] == 2
        ]
        for n in [x for x in inserts if x >= 0] or [None if seq is None else len(seq)]:
            want.append((sample, mate, read_id, *[None if t is None or n is None else t[:n] for t in (seq, qual)], note))
    assert len(want) > len(rows) and sum(w[3] not in {r[3] for r in rows} for w in want) > 20
    for cells in (1 << 22, 300):
        monkeypatch.setattr(read_trimming, "_CELLS", cells)
        got = read_trimming.clip_pairs(reads)
        assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, want))
    with monkeypatch.context() as none_counted:
        none_counted.setattr(read_trimming, "_pair_parts", lambda reads: 3)
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
        assert sorted(map(repr, map(tuple, read_trimming.clip_pairs(reads).collect()))) == sorted(map(repr, want))
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    # the reads were written to disk, joined with themselves and joined once more
    monkeypatch.setattr("assayframe.sources.staging.new_path", lambda *_: pytest.fail("nothing is staged"))
    adapters = spark.createDataFrame([("ad", adapter)], "name string, seq string")
    trimmed = read_trimming.trim_reads(reads.coalesce(1), adapters)
    plan = trimmed._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan


def test_the_report_query_uses_the_whole_trimming_step_and_keeps_every_row(spark, tmp_path):
    rng = np.random.default_rng(71)
    passage = "".join(rng.choice(list("ACGT"), 60))
    texts = []
    for i in range(24):
        body = "".join(rng.choice(list("ACGTacgtUVWXYZ"), 80))
        texts.append((body[:3] if i == 6 else "!!" + body + (passage if i % 3 == 0 else "") + '"' * 3, i, f"src{i % 4}"))
    spark.createDataFrame([(i, t, s, "en", len(t)) for t, i, s in texts], "doc_id long, text string, source string, lang string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, passage)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    report = read_queries.qc_merge(spark, str(tmp_path)).toPandas()
    assert list(report.columns) == ["stage", "sample", "mate", "module", "label", "bucket", "metric", "value"]

    def stats(stage, metric):
        part = report[(report["stage"] == stage) & (report["module"] == "basic_stats") & (report["metric"] == metric)]
        return {(r.sample, r.mate): r.value for r in part.itertuples()}

    want, bases = Counter(), Counter()
    for t, i, s in texts:
        if i // 2 != 3:  # the mate of a read too short is left alone
            want[s, i % 2 + 1] += 1
            bases[s, i % 2 + 1] += 80
    assert stats("trimmed", "reads") == want and stats("trimmed", "bases") == bases
    assert sum(stats("raw", "bases").values()) == sum(len(t) for t, _, _ in texts)
    lengths = report[(report["module"] == "base_quality") & (report["metric"] == "reads")]
    assert lengths[lengths["stage"] == "raw"]["bucket"].max() == 145 and lengths[lengths["stage"] == "trimmed"]["bucket"].max() == 80


def test_counts_of_the_report_against_plain_loops(spark, monkeypatch):
    rng = np.random.default_rng(73)
    words = ["".join(rng.choice(list("ACé"), int(n))) for n in (1, 2, 3, 3, 7)]
    texts = ["".join(rng.choice(list("ACGé"), int(n))) for n in rng.integers(0, 200, 40)] + ["", words[4] * 30]
    machine = read_quality.automaton(sorted(set(words)))
    want = {(i, p): t.find(w) + 1 for i, t in enumerate(texts) for p, w in enumerate(sorted(set(words))) if w in t}
    for piece in (1, 40, 1 << 11):
        monkeypatch.setattr(read_quality, "_PIECE", piece)
        assert {(i, p): s for i, p, s in zip(*map(np.ndarray.tolist, read_quality.first_hits(texts, machine)), strict=True)} == want
    rows = [("s", 1, f"m:1:f:1:{i % 3}:{i}", x, x) for i, x in enumerate([*texts, None, None, texts[3]])] + [(None, 1, "a", "AC", "AC")]
    reads = read_table(spark, rows)
    quality = lambda t: [min(93, max(0, ord(c) - 33)) for c in t]
    for size in (1 << 21, 64):
        monkeypatch.setattr(read_quality, "_SLICE", size)
        means = Counter((r[0], sum(quality(r[4])) // len(r[4])) for r in rows if r[4])
        assert {(r["sample"], r["mean_quality"]): r["reads"] for r in read_quality.qc_sequence_quality(reads).collect()} == means
        tiles = {}
        for r in rows:
            for at, q in enumerate(quality(r[4]) if r[4] else [0] if r[4] == "" else []):
                tiles.setdefault((r[0], r[2].split(":")[4] if ":" in r[2] else None, at + 1), []).append(q)
        got = {(r["sample"], r["tile"], r["pos"]): (r["reads"], r["mean"]) for r in read_quality.qc_tile_quality(reads).collect()}
        assert got == {k: (len(v), sum(v) / len(v)) for k, v in tiles.items() if k[0]}
    copies = Counter(r[3] for r in rows if r[0])
    over = [(r["seq"], r["n"], round(r["share"], 9)) for r in read_quality.qc_overrepresented(reads, 0.03).collect()]
    assert sorted(over, key=str) == sorted([(s, n, round(n / 45, 9)) for s, n in copies.items() if n > 0.03 * 45], key=str) and None in copies
    plan = read_quality.qc_duplication(reads)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" in plan and not any("hashpartitioning" in line and "seq#" in line for line in plan.splitlines())


def test_forests_are_summed_up_where_their_trees_grow(spark, monkeypatch):
    rng = np.random.default_rng(79)
    rows = [(i, "abc"[i % 3], [float(x) for x in rng.normal(i % 3, 1.5, 6)]) for i in range(130)]
    data = spark.createDataFrame(rows, "id long, label string, features array<double>").repartition(4)
    grown = forest.grow(data, trees=23, per_split=3, seed=5)
    table = {(r["label"], r["predicted"]): n for r, n in Counter(forest.votes(grown).filter("predicted is not null").select("label", "predicted").collect()).items()}
    inner = grown.feature >= 0
    weights = np.bincount(grown.feature[inner], weights=grown.decrease[inner], minlength=6)
    made = grown.prepared.toPandas()
    leaves = grown.leaves(np.stack([np.frombuffer(b, np.uint8) for b in made["x"]]))
    raw = np.zeros(130)
    for i in range(130):
        same = (made["label"] == made["label"][i]).to_numpy()
        raw[i] = 130 / ((leaves[same] == leaves[i]).mean(axis=1) ** 2).sum()
    scores = {}
    for label in "abc":
        own = (made["label"] == label).to_numpy()
        off = raw[own] - np.median(raw[own])
        scores |= dict(zip(made["id"][own], off / np.median(np.abs(off)), strict=True))
    # the driver used to hold the trees
    monkeypatch.setattr(forest, "grow", lambda *_, **__: pytest.fail("the trees are brought to the driver"))
    for block, cells in ((256, 1 << 20), (16, 40)):
        monkeypatch.setattr(forest, "_BLOCK", block)
        monkeypatch.setattr(forest, "_CELLS", cells)
        monkeypatch.setattr(forest, "_ROWS", 3 * block)
        assert {(r["label"], r["predicted"]): r["n"] for r in forest.random_forest(data, 23, 3, 5).collect()} == table
        got = {r["id"]: r["outlier"] for r in forest.rf_outlier(data, 23, 3, 5).collect()}
        assert got.keys() == scores.keys() and all(math.isclose(got[k], scores[k], rel_tol=1e-9, abs_tol=1e-9) for k in got)
    got = [r["importance"] for r in forest.rf_importance(data, 23, 3, 5).orderBy("feature").collect()]
    assert np.allclose(got, weights / weights.sum(), rtol=1e-12)
