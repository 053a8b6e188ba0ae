import pytest
from pyspark.errors import PySparkException

from assayframe.operators import relational as r

NAN = float("nan")


def rows(df, *cols):
    return sorted(tuple(x[c] for c in cols) for x in df.collect())


def modes(spark):
    return spark.createDataFrame([("A", 0.01, 0, 1), ("A", 0.04, 1, 1), ("A", 0.04, 0, 2), ("B", 0.02, 1, 2)], "x string, p double, source int, ord int")


def test_group_picks(spark):
    df = modes(spark)
    assert rows(r.max_per_group_ties(df, "x", "p"), "x", "p", "source") == [("A", 0.04, 0), ("A", 0.04, 1), ("B", 0.02, 1)]
    assert rows(r.max_per_group_first(df, "x", "p", ["source", "ord"]), "x", "p", "source") == [("A", 0.04, 0), ("B", 0.02, 1)]
    assert rows(r.max_per_group_first(df, "x", "p", ["source"], pick="min"), "x", "p") == [("A", 0.01), ("B", 0.02)]
    assert rows(r.group_max(df, "x", "p"), "x", "group_max")[0] == ("A", 0.04)


def test_lookup_takes_the_first_entry(spark):
    dim = spark.createDataFrame([("E1", "late", 2), ("E1", "early", 1)], "key string, symbol string, ord int")
    df = spark.createDataFrame([("E1",), ("E9",)], "key string")
    assert {x["key"]: x["symbol"] for x in r.lookup_first(df, dim, "key", "symbol").collect()} == {"E1": "early", "E9": None}
    assert rows(r.translate_ids(df, dim, "key", "symbol"), "symbol") == [("early",), ("late",)]


def test_filters_drop_missing_values(spark):
    df = spark.createDataFrame([(NAN, 3.0), (None, 3.0), (0.01, 3.0), (0.01, 0.5), (0.2, -3.0), (0.01, NAN)], "padj double, log2fc double")
    assert rows(r.filter_p(df.select("padj"), "padj"), "padj") == [(0.01,)] * 3
    assert rows(r.significant(df), "padj", "log2fc") == [(0.01, 3.0)]
    up, down = r.split_direction(df, "log2fc")
    assert up.count() == 3 and down.count() == 1
    assert r.drop_na(df).count() == 3


def test_peaks_match_on_missing_keys(spark):
    left = spark.createDataFrame([(1.0, None, "a"), (1.0, 2.0, "b"), (9.0, 9.0, "c")], "rt double, mz double, id string")
    right = spark.createDataFrame([(1.0, None, 10), (1.0, 2.0, 20), (1.0, 2.0, 21)], "rt double, mz double, v int")
    got = {(x["id"], x["v"]) for x in r.attach_peaks(left, right).collect()}
    assert got == {("a", 10), ("b", 20), ("b", 21), ("c", None)}


def test_label_row(spark):
    wide = spark.createDataFrame([("Label", "bm", "cns"), ("100__1", "5", "x")], "Sample string, s1 string, s2 string")
    values, samples = r.split_label_row(wide)
    assert {(x[0], x[1], x[2]) for x in values.collect()} == {("100__1", "s1", 5.0), ("100__1", "s2", None)}
    assert rows(samples, "sample", "condition") == [("s1", "bm"), ("s2", "cns")]


def test_polarity_errors(spark):
    df = spark.createDataFrame([("positive", 1), ("negative", 2)], "polarity string, v int")
    assert rows(r.select_polarity(df, "positive"), "v") == [(1,)]
    with pytest.raises(ValueError):
        r.select_polarity(df, "neutral")
    with pytest.raises(PySparkException):
        r.select_polarity(df.union(spark.createDataFrame([("odd", 3)], df.schema)), "positive").collect()


def test_metadata_must_cover_all_samples(spark):
    data = spark.createDataFrame([("s1", 1.0), ("s2", 2.0)], "sample string, value double")
    meta = spark.createDataFrame([("s1", "bm"), ("s2", "cns")], "sample string, condition string")
    assert rows(r.align_metadata(data, meta), "sample", "condition") == [("s1", "bm"), ("s2", "cns")]
    with pytest.raises(PySparkException):
        r.align_metadata(data, meta.filter("sample = 's1'")).collect()


def test_stack_and_reshape(spark):
    a = spark.createDataFrame([("x", 1.0)], "n string, p double")
    b = spark.createDataFrame([("y", 2.0, 5)], "n string, p double, extra int")
    got = rows(r.stack_modes({"positive": a, "negative": b}), "n", "mode", "source")
    assert got == [("x", "positive", 0), ("y", "negative", 1)]
    df = spark.createDataFrame([("p", "1/2/3")], "path string, ids string")
    assert rows(r.split_rows(df, "ids"), "ids") == [("1",), ("2",), ("3",)]
    assert r.transpose(spark.createDataFrame([("f", "s", 1)], "feature string, sample string, v int")).first() == ("f", "s", 1)


def test_compound_search_finds_parts_of_names(spark):
    dim = spark.createDataFrame([("C2", 2, "D-Glucose"), ("C1", 1, "alpha D-Glucose  phosphate"), ("C3", 3, "water")], "compound_id string, name_ord int, name string")
    names = spark.createDataFrame([("d-glucose phosphate",), ("D-GLUCOSE",), ("nothing",)], "name string")
    assert rows(r.find_compound(names, dim), "name", "compound_id") == [("D-GLUCOSE", "C1"), ("d-glucose phosphate", "C1")]


def test_compounds_are_found_inside_words(spark):
    dim = [("C2", 2, "D-Glucose"), ("C1", 1, "alpha D-Glucose  phosphate"), ("C3", 3, "water"), ("C4", 4, "heavy water"), ("C5", 5, None), ("C6", 6, "O2")]
    found = ["lucos", "GLUCOSE P", "ate", "at", "w", "o2", "2", "vy wat", "nothing", "xyzzy", "", None, "glucosephosphate", "zz", "d-glucose"]
    table = spark.createDataFrame(dim, "compound_id string, name_ord int, name string")
    names = spark.createDataFrame([(x,) for x in found], "name string")
    want = {}
    for x in found:
        hits = [(n, c) for c, n, name in dim if x and name and x.lower() in " ".join(name.lower().split())]
        if hits:
            want[x] = min(hits)[1]
    assert {x["name"]: x["compound_id"] for x in r.find_compound_parts(names, table).collect()} == want
    assert want["ate"] == "C1" and want["w"] == "C3" and "nothing" not in want


def test_names_are_cleaned_and_misses_dropped(spark):
    dim = spark.createDataFrame([("C1", "second", 2), ("C1", "first", 1)], "compound_id string, name string, name_ord int")
    df = spark.createDataFrame([(" C1 ",), ("C2",)], "compound_id string")
    assert rows(r.name_compounds(df, dim), "compound_id", "name") == [("C1", "first")]


def test_top_lists(spark):
    means = spark.createDataFrame([("a", 3.0, "Upregulated"), ("b", 1.0, "Upregulated"), ("c", -1.0, "Downregulated"), ("d", -5.0, "Downregulated")], "pathway_name string, avg_lfc double, direction string")
    assert rows(r.top_pathways_up_down(means, 1), "pathway_name") == [("a",), ("d",)]
    counts = spark.createDataFrame([("a", 3), ("b", 9), ("c", 3)], "pathway_name string, n long")
    got = {x["pathway_name"]: x["display_order"] for x in r.top_pathways_by_count(counts, 20).collect()}
    assert got == {"b": 3, "a": 2, "c": 1}
    genes = spark.createDataFrame([("g1", 0.5), ("g2", NAN), ("g3", 0.1), ("g4", None)], "feature string, padj double")
    assert rows(r.top_features(genes, 5), "feature") == [("g1",), ("g3",)]
