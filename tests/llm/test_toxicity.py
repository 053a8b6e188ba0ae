"""Toxicity: held-out accuracy, a plain forward pass, gradients by effect, odd texts and thresholds."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from assayframe.llm import queries, texts, toxicity

DOCS = "doc_id long, text string, lang string, score string, threshold int"
LABELS = "doc_id long, quality int, toxic int"


def said(rng, bad):
    words = ["".join(rng.choices("abcdefgh", k=rng.randint(2, 8))) for _ in range(rng.randint(20, 120))]
    for _ in range(bad and rng.randint(1, 3)):
        words.insert(rng.randint(0, len(words)), rng.choice(["zounds", "Zoundly", "qworst!"]))
    return " ".join(words)


@pytest.fixture(scope="module")
def labelled():
    rng = random.Random(2)
    docs = [(i, said(rng, i % 4 == 0), "xy"[i % 2], "clash", 1) for i in range(900)]
    return docs, [(i, 1, int(i % 4 == 0)) for i in range(900)] + [(None, 0, 1), (9999, 0, 1), (1, 0, None)]


def test_held_out_accuracy_and_thresholds(spark, labelled):
    docs, labels = spark.createDataFrame(labelled[0], DOCS), spark.createDataFrame(labelled[1], LABELS)
    net = toxicity.train(docs, labels)
    got = toxicity.flag(toxicity.score(docs, net), toxicity.calibrate(docs, labels, net)).collect()
    assert len(got) == 900 and got[0].text == labelled[0][got[0].doc_id][1]
    held = [r for r in got if zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    assert np.mean([r.predicted == int(r.doc_id % 4 == 0) for r in held]) > 0.97
    assert np.mean([r.flagged == (r.doc_id % 4 == 0) for r in held]) > 0.97
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) and r.flagged == (r.score >= r.threshold) for r in got)
    assert {r.lang: r.threshold for r in got}.keys() == {"x", "y"}
    # neither the language, the source nor the labels of held-out and calibrating rows enter a score
    other = spark.createDataFrame([(*d[:2], "z", *d[3:]) for d in labelled[0]], DOCS)
    wrong = spark.createDataFrame([(i, q, 1 - t if i is not None and t is not None and zlib.crc32(str(i).encode()) % 5 < 2 else t) for i, q, t in labelled[1]], LABELS)
    again = {r.doc_id: r.score for r in toxicity.score(other, toxicity.train(other, wrong)).collect()}
    assert again == {r.doc_id: r.score for r in got}


def plain_scores(net, rows):
    """The network word by word."""
    out = []
    for text in rows:
        x, _ = toxicity.features(next(texts.slices(pa.array([text]))))
        e = [sum(net.table[i] for i in word) for word in x]
        best = np.zeros(len(net.out))
        for i, span in enumerate(toxicity.SPANS):
            for at in range(len(e)):
                window = np.concatenate([e[at + j] if at + j < len(e) else np.zeros(toxicity.WIDTH) for j in range(span)])
                value = window @ net.kernels[i] + net.shifts[i]
                best[i * toxicity.FILTERS : (i + 1) * toxicity.FILTERS] = np.maximum(best[i * toxicity.FILTERS : (i + 1) * toxicity.FILTERS], value)
        out.append(1 / (1 + np.exp(-(best @ net.out + net.bias))))
    return out


def random_net(seed):
    rng = np.random.default_rng(seed)
    net = toxicity.constant(0.3)
    table = rng.normal(0, 1, (toxicity.BUCKETS, toxicity.WIDTH)).astype(np.float32)
    table[0] = 0
    return net._replace(table=table, kernels=[rng.normal(0, 0.3, k.shape).astype(np.float32) for k in net.kernels], shifts=[rng.normal(0, 0.1, s.shape).astype(np.float32) for s in net.shifts], out=rng.uniform(0, 0.05, net.out.shape).astype(np.float32))


def test_scores_equal_a_plain_pass(spark, monkeypatch):
    rng = random.Random(4)
    net = random_net(1)
    rows = [said(rng, True) for _ in range(20)] + ["", "one", "two words", "été à Ñu", "?!"]
    want = plain_scores(net, rows)
    assert np.allclose(toxicity._slice_scores(net, pa.array(rows)), want, atol=1e-5)
    assert np.allclose(toxicity._slice_scores(net, pa.array(rows[::-1])), want[::-1], atol=1e-5)
    # a long text in overlapping parts
    long = " ".join(rows)
    want = plain_scores(net, [long])
    monkeypatch.setattr(toxicity, "SLICE_BYTES", 97)
    assert np.allclose(toxicity._slice_scores(net, pa.array([long])), want, atol=1e-5)


def test_odd_texts_and_few_labels(spark):
    odd = [(None, None), (1, ""), (1, ""), (2, "\n\n"), (3, "x" * 100_000), (4, "🙂"), (5, "word " * 100_000)]
    docs = spark.createDataFrame([(i, t, None, "c", 1) for i, t in odd], DOCS)
    none = toxicity.train(docs, spark.createDataFrame([], LABELS))
    assert {r.score for r in toxicity.score(docs, none).collect()} == {0.5}
    assert {r.predicted for r in toxicity.score(docs, none).collect()} == {1}
    ids = [i for i in range(2, 6) if zlib.crc32(str(i).encode()) % 5 > 1]
    one = toxicity.train(docs, spark.createDataFrame([(i, 1, 0) for i in ids], LABELS))
    assert all(r.score < 0.5 for r in toxicity.score(docs, one).collect())
    assert toxicity.score(docs.limit(0), one).count() == 0
    scored = toxicity.score(docs, random_net(2)).collect()
    assert len(scored) == 7 and len({r.score for r in scored if not (r.text or "").strip()}) == 1
    assert toxicity.flag(toxicity.score(docs, none), {None: 0.9, "x": 0.1}).filter("threshold = 0.9").count() == 7


def test_threshold():
    y = np.array([0] * 40 + [1] * 40)
    s = np.concatenate([np.linspace(0, 0.2, 40), np.linspace(0.4, 1, 40)])
    assert abs(toxicity.threshold(s, y) - 0.3) < 1e-9
    assert toxicity.threshold(s[:40], y[:40]) == 0.5
    assert 0.3 < toxicity.threshold(s[35:43], y[35:43]) < 0.5
    assert toxicity.threshold(np.array([0.5, 0.5, 0.1]), np.array([1, 0, 0]), least=1) == 0.3


def test_query_on_the_table(spark):
    sf = "/root/testdata/sf0.1"
    got = queries.QUERIES["op13_toxicity"](spark, sf)
    truth = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "toxic")
    held = got.filter("held_out").join(truth, "doc_id").select("predicted", "toxic").collect()
    assert got.count() == spark.read.parquet(f"{sf}/documents.parquet").count()
    assert len(held) > 500 and np.mean([r.predicted == r.toxic for r in held]) > 0.96
    assert got.select(F.min("score"), F.max("score")).first()[0] >= 0


def test_calibration_takes_all_labelled_rows(spark):
    rng = np.random.default_rng(8)
    words = np.array([f"w{i}" for i in range(60)])
    ids = [i for i in range(60_000) if zlib.crc32(str(i).encode()) % 5 == 1][:9_000]
    text = [" ".join(words[rng.integers(0, 60, 4)]) for _ in ids]
    y = [int("w1" in t.split() or rng.random() < 0.1) for t in text]
    lang = [(None, "de", "en")[i % 3] for i in ids]
    t = next(texts.slices(pa.array(text[:300])))
    net = toxicity.fit(*toxicity.features(t), np.array(y[:300]), epochs=2)
    docs = spark.createDataFrame(list(zip(ids, text, lang, strict=True)), "doc_id long, text string, lang string")
    labels = spark.createDataFrame(list(zip(ids, y, strict=True)), "doc_id long, toxic int")
    got = toxicity.calibrate(docs, labels, net)
    scored = toxicity.score(docs, net).join(labels, "doc_id").select("lang", "score", "toxic").toPandas()
    for name in (None, "de", "en"):
        own = scored[scored["lang"].isna() if name is None else scored["lang"] == name]
        assert abs(got[name] - toxicity.threshold(own["score"].to_numpy(), own["toxic"].to_numpy())) < 1e-12
    # more rows than any sample of them held
    assert len(scored) == 9_000 > toxicity.TRAIN_ROWS
    few = toxicity.calibrate(docs.limit(0), labels, net)
    assert few == {}


def test_the_driver_holds_the_training_words_once(spark):
    import tracemalloc

    rng = np.random.default_rng(3)
    rows = rng.integers(1, toxicity.BUCKETS, (1 << 21, 5)).astype(np.int16)
    bounds, y = np.array([0, 1 << 20, 1 << 21]), np.array([0, 1])
    tracemalloc.start()
    try:
        net = toxicity.fit(rows, bounds, y, epochs=0)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < rows.nbytes  # 21 MB; a sorted copy of the rows alone takes that
    assert not net.table[0].any() and net.table[np.unique(rows)].any(axis=1).all()
    some = ["ab cdefgh ijklmnop", "", "x", "q " * 50]
    column = pa.array(some)
    x, at = next((toxicity.features(t) for t in texts.slices(column, 1 << 18)))
    sent = pa.chunked_array([pa.array([x[a:b].astype(np.int16).tobytes() for a, b in zip(at[:-1], at[1:])], pa.binary()).slice(i, n) for i, n in ((0, 3), (3, 1), (4, 0))])
    words, own = toxicity._words(sent)
    assert words.dtype.itemsize == 2 and np.array_equal(words, x) and np.array_equal(own, at)
