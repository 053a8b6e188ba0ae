"""Quality classifier, packing, nearest neighbours and the pipeline."""

import itertools
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from assayframe.llm import decontaminate, folders, near_dedup, packing, quality, queries, texts, vantage

DOCS = "doc_id long, text string, score string, predicted string, id int"


def text_of(rng, good):
    words = ["".join(rng.choices("abcdefgh", k=rng.randint(2, 8))) for _ in range(rng.randint(20, 80))]
    return " ".join(words).capitalize() + "." if good else " | ".join(w.upper() for w in words) + "!!"


@pytest.fixture(scope="module")
def labelled():
    rng = random.Random(1)
    docs = [(i, text_of(rng, i % 3 > 0), "clash", None, 7) for i in range(600)]
    labels = [(i, int(i % 3 > 0), 0) for i in range(0, 600, 2)] + [(5000, 1, 0), (None, 0, 0), (1, None, 0)]
    return docs, labels


def test_held_out_accuracy(spark, labelled):
    docs, labels = (spark.createDataFrame(x, s) for x, s in zip(labelled, (DOCS, "doc_id long, quality int, toxic int"), strict=True))
    trees = quality.train(docs, labels)
    got = quality.score(docs, trees).withColumn("held", quality.held_out(F.col("doc_id"))).collect()
    assert len(got) == 600 and got[0].id == 7
    assert all(r.held == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    assert np.mean([r.predicted == int(r.doc_id % 3 > 0) for r in got if r.held]) > 0.98
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got)


def test_labels_of_held_out_rows_are_not_seen(spark, labelled):
    docs = spark.createDataFrame(labelled[0], DOCS)
    wrong = [(i, 1 - q if zlib.crc32(str(i).encode()) % 5 == 0 else q, t) for i, q, t in labelled[1][:300]]
    a, b = (quality.train(docs, spark.createDataFrame(x, "doc_id long, quality int, toxic int")) for x in (labelled[1][:300], wrong))
    assert all(np.array_equal(x, y) for x, y in zip(a[:3], b[:3], strict=True))


def test_scores_of_odd_texts_and_few_labels(spark):
    odd = [(None, None), (1, ""), (1, ""), (2, "\n\n"), (3, "x" * 100_000), (4, "🙂"), (5, "word " * 50_000)]
    docs = spark.createDataFrame([(i, t, "clash", None, 1) for i, t in odd], DOCS)
    labels = "doc_id long, quality int"
    assert {r.score for r in quality.score(docs, quality.train(docs, spark.createDataFrame([], labels))).collect()} == {0.5}
    one = quality.train(docs, spark.createDataFrame([(3, 1), (4, 1), (5, 1)], labels))
    assert all(r.score > 0.5 for r in quality.score(docs, one).collect())
    assert quality.score(docs.limit(0), one).count() == 0
    x = quality.statistics(next(texts.slices(pa.array([t for _, t in odd]))))
    assert np.isfinite(x).all() and (x[0] == 0).all()


def test_statistics_do_not_depend_on_the_other_texts():
    rng = random.Random(4)
    values = [text_of(rng, i % 2) + "\nline" * (i % 3) for i in range(20)] + ["", "a\na\nb"]
    together = quality.statistics(next(texts.slices(pa.array(values))))
    alone = np.concatenate([quality.statistics(next(texts.slices(pa.array([v])))) for v in values])
    assert np.array_equal(together, alone)


@pytest.mark.parametrize("buckets", [1, 2, 3, 5, 20])
def test_bucket_limits_are_the_best(buckets):
    rng = np.random.default_rng(buckets)
    for _ in range(20):
        lengths = np.sort(rng.choice(40, 8, replace=False) + 1)
        counts = rng.integers(1, 30, 8)

        def padded(limits, lengths=lengths, counts=counts):
            at = np.searchsorted(limits, lengths)
            return (np.array(limits)[at] * counts).sum()

        best = min(padded([*c, lengths[-1]]) for c in itertools.combinations(lengths[:-1], min(buckets, 8) - 1))
        limits = packing.bucket_limits(lengths, counts, buckets)
        assert padded(limits) == best and len(limits) <= buckets and limits == sorted(limits)
    assert packing.bucket_limits(np.array([]), np.array([]), buckets) == []


def test_pack(spark):
    rng = random.Random(9)
    rows = [(i, rng.choice([3, 3, 3, 10, 50, 99, 100, 101, 250, 1000]), "clash") for i in range(500)] + [(None, 7, ""), (4, 3, ""), (4, 3, ""), (600, 0, ""), (601, None, ""), (602, -5, "")]
    got = packing.pack(spark.createDataFrame(rows, "doc_id long, size long, bucket string"), "size", buckets=4, max_len=100, budget=400, chunk_rows=37).collect()
    pieces = sorted(((r.doc_id is None, r.doc_id or 0, r.piece if r.piece is not None else -1, r.n_tokens) for r in got))
    wanted = []
    for i, n, _ in rows:
        n = max(n or 0, 0)
        wanted += [(i is None, i or 0, p, min(100, n - 100 * p)) for p in range(-(-n // 100))] or [(i is None, i or 0, -1, 0)]
    assert pieces == sorted(wanted)
    batches = {}
    for r in got:
        if r.piece is not None:
            assert r.start == 100 * r.piece and r.n_tokens <= r.bucket_len
            batches.setdefault((r.bucket, r.bucket_len, r.batch), []).append(r.slot)
    for bucket, size, batch in batches:
        full = max(1, 400 // size)
        slots = sorted(batches[bucket, size, batch])
        last = max(b for k, _, b in batches if k == bucket)
        assert slots == list(range(full if batch < last else len(slots))) and len(slots) <= full
    assert len({(b, s) for b, s, _ in batches}) == 4
    assert packing.pack(spark.createDataFrame([], "doc_id long, size long"), "size").count() == 0


VECTORS = "vec_id long, embedding array<float>, rank int, score double"


def nearest_by_force(rows, k):
    good = [(i, np.array(v, np.float32).astype(float)) for i, v, *_ in rows if i is not None and v is not None and len(v) == 6 and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    out = []
    for q, v in good:
        if q % 100 == 0:
            found = sorted((float(np.sqrt(((v - w) ** 2).sum())), i) for i, w in good if i != q)[:k]
            out += [(q, n + 1, i, d) for n, (d, i) in enumerate(found)]
    return out


def test_nearest_is_exact_with_factor_one(spark):
    rng = np.random.default_rng(0)
    rows = [(i, [float(x) for x in rng.normal(size=6).round(1)], 0, 0.0) for i in range(1, 1500)]
    rows += [(2000 + i, rows[99][1], 0, 0.0) for i in range(150)]  # many copies: ties go to the smaller ids
    rows += [(1600, None, 0, 0.0), (1700, [0.0] * 6, 0, 0.0), (1800, [float("nan")] * 6, 0, 0.0), (1900, [1.0, None, 1.0, 1.0, 1.0, 1.0], 0, 0.0), (1901, [1.0], 0, 0.0), (None, [1.0] * 6, 0, 0.0), (1902, [float("inf")] + [1.0] * 5, 0, 0.0)]
    df = spark.createDataFrame(rows, VECTORS).repartition(3)
    trees, shards = vantage.index(df, "vec_id", "embedding", 6, shard_rows=400)
    assert shards > 3
    got = vantage.nearest(trees, shards, df.filter("vec_id % 100 = 0"), "vec_id", "embedding", 6, k=10, factor=1, block=5).collect()
    wanted = nearest_by_force(rows, 10)
    assert sorted((r.query_id, r["rank"], r.vec_id) for r in got) == sorted(w[:3] for w in wanted)
    assert {(r.query_id, r["rank"]): r.score for r in got} == pytest.approx({w[:2]: w[3] for w in wanted})
    few = spark.createDataFrame(rows[98:102], VECTORS)
    trees, shards = vantage.index(few, "vec_id", "embedding", 6)
    assert vantage.nearest(trees, shards, few.filter("vec_id = 100"), "vec_id", "embedding", 6).count() == 3
    none = few.limit(0)
    trees, shards = vantage.index(none, "vec_id", "embedding", 6)
    assert vantage.nearest(trees, shards, few, "vec_id", "embedding", 6).count() == 0


def test_recall_of_the_relaxed_search(spark):
    sf = "/root/testdata/sf0.1"
    got = queries.QUERIES["op1_vantage_point_trees"](spark, sf).collect()
    table = spark.read.parquet(f"{sf}/embeddings.parquet").toArrow()
    ids, points = table["vec_id"].to_numpy(), np.stack(table["embedding"].to_pylist()).astype(float)
    found = {}
    for r in got:
        found.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    hits = 0
    for q in ids[ids % 100 == 0].tolist():
        d = np.sqrt(((points - points[ids == q][0]) ** 2).sum(axis=1))
        d[ids == q] = np.inf
        best = ids[np.lexsort((ids, d))[:10]]
        hits += len(set(best.tolist()) & {v for _, v, _ in found[q]})
        assert [s for *_, s in sorted(found[q])] == sorted(s for *_, s in found[q])
    assert hits / (10 * len(found)) >= 0.95


def test_the_query_packs_tokens_and_an_end_mark(spark):
    sf = "/root/testdata/sf0.001"
    tokenizer = Tokenizer.from_file(public_tokenizers.path(queries.TOKENIZER))
    texts_of = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").limit(200).collect()}
    packed = {r.doc_id: r.n for r in queries.op7(spark, sf).groupBy("doc_id").agg(F.sum("n_tokens").alias("n")).collect()}
    assert all(packed[i] == len(tokenizer.encode(t, add_special_tokens=False).ids) + 1 for i, t in texts_of.items())


def test_pipeline_stages_take_effect(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    kept, counts = docs, [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = folders.save(stage(spark, kept, sf), "test")
        assert kept.columns == docs.columns and kept.schema == docs.schema, name
        counts.append(kept.count())
    assert counts[0] > counts[1] >= counts[2] > counts[3] > counts[4] > 0
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    stage_one = {r.doc_id for r in corpus_pipeline.keep_good(spark, docs, sf).collect()}
    assert np.mean([i in stage_one for i, q in labels.items() if q == 1]) > 0.95
    assert near_dedup.near_duplicates(kept).filter("not kept").count() == 0
    assert decontaminate.contaminated(kept, spark.read.parquet(f"{sf}/benchmark.parquet")).count() == 0
    packed = corpus_pipeline.pack(spark, kept, sf).groupBy("doc_id").agg(F.sum("n_tokens").alias("n"))
    sizes = kept.select("doc_id", (F.octet_length("text") + 1).alias("size"))
    assert packed.join(sizes, "doc_id").filter("n = size").count() == counts[4] == packed.count()


def test_pipeline_stages_on_odd_documents(spark):
    sf = "/root/testdata/sf0.001"
    schema = "doc_id long, text string, lang string, source string, n_chars long, score string, _h int, id string"
    rows = [(None, None, None, None, None, "s", 1, "i"), (1, "", "", "", 0, "s", 1, "i"), (1, "", "", "", 0, "s", 1, "i"), (2, "Some words that make a sentence. " * 3000, "en", None, None, None, None, None)]
    for docs in (spark.createDataFrame(rows, schema), spark.createDataFrame([], schema)):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            assert stage(spark, docs, sf).columns == docs.columns, name
            stage(spark, docs, sf).collect()
        assert corpus_pipeline.pack(spark, docs, sf).count() >= docs.count()
