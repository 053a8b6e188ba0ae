"""The pipeline's rows against plain loops over all documents, stage after stage."""

import random

import numpy as np
import pyarrow as pa
from test_chat_lines import brute as lines_by_force
from test_similar import WORD, classes_by_force, prose

import corpus_pipeline
from assayframe.llm import quality, texts

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def corpus(rng):
    good = [(i, ".\n".join(" ".join(prose(rng, rng.randint(20, 40))) for _ in range(rng.randint(2, 5))) + ".") for i in range(90)]
    junk = [(100 + i, " | ".join(w.upper() for w in prose(rng, rng.randint(30, 90))) + "!!") for i in range(45)]
    items = [(1, " ".join(prose(rng, 25))), (2, " ".join(prose(rng, 12)))]
    rest = [(200 + i, good[i][1].replace(" of ", " upon ", 1)) for i in range(12)] + [(220, good[3][1]), (221, good[3][1].upper())]
    rest += [(230, good[40][1] + "\n" + items[0][1]), (231, good[41][1] + "\n" + " ".join(items[1][1].split()[2:])), (232, items[1][1] + " and more of it")]
    rest += [(240, "all rights are reserved here"), (250, " ".join(prose(rng, 4000)) + ".")]
    footer = [(i, t + "\nall rights are reserved here") if 20 <= i < 36 else (i, t) for i, t in good]
    return footer + junk + rest, items, [(i, 1, 0) for i, _ in footer] + [(i, 0, 0) for i, _ in junk]


def plain_score(trees, text):
    """One text walked through one tree after the other, node by node."""
    x = quality.statistics(next(texts.slices(pa.array([text]))))[0]
    total = trees.base
    for k in range(len(trees.feature)):
        node = 0
        for _ in range(trees.depth):
            node = 2 * node + 1 + int(x[trees.feature[k, node]] > trees.threshold[k, node])
        total += trees.value[k, node - trees.feature.shape[1]]
    return 1 / (1 + np.exp(-total))


def test_run_equals_plain_loops(spark, tmp_path):
    docs, items, labels = corpus(random.Random(8))
    table = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in docs], DOCS).repartition(4)
    known = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    table.write.parquet(f"{tmp_path}/documents.parquet")
    known.write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")

    trees = quality.train(table, known)
    left = [(i, t) for i, t in docs if plain_score(trees, t) >= corpus_pipeline.CUT]
    assert {i for i, _ in left} >= {i for i, q, _ in labels if q} and not {i for i, _ in left} & {i for i, q, _ in labels if not q}
    left = [(i, t) for i, t, n, gone in lines_by_force(left, corpus_pipeline.MIN_DOCS, "first") if not gone or t.strip(" \t\n\v\f\r")]
    assert 240 not in dict(left) and "reserved" in dict(left)[20] and "reserved" not in dict(left)[21]
    classes = classes_by_force(left)
    left = [x for x, c in zip(left, classes, strict=True) if x[0] == c[1]]
    assert not {220, 221} & dict(left).keys()

    def words(text):
        return [w.lower() for w in WORD.findall(text)]

    windows = {tuple(w[k : k + 8]) for _, t in items for w in [words(t)] for k in range(len(w) - 7)}
    left = [(i, t) for i, t in left if not any(tuple(w[k : k + 8]) in windows for w in [words(t)] for k in range(len(w)))]
    assert not {230, 231, 232} & dict(left).keys() and len(left) > 60

    got = {}
    for r in corpus_pipeline.run(spark, str(tmp_path)).collect():
        assert 0 < r.n_tokens <= 8192
        got[r.doc_id] = got.get(r.doc_id, 0) + r.n_tokens
    assert got == {i: len(t.encode()) + 1 for i, t in left}
