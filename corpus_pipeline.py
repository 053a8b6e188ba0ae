"""From raw documents to length-bucketed batches: the stages a training corpus goes through, in order.

Every stage takes (spark, docs, sf_dir) and works on all rows that the stage before kept; its result is written as
Parquet and read back as the next one's ``docs``. All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from assayframe.llm import decontaminate, folders, line_dedup, near_dedup, packing, quality

#: A line found in at least so many documents is boilerplate and stays in the first of them only.
MIN_DOCS = 10
#: Documents scored below this go: clean ones score near 1.
CUT = 0.3


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, trained on the labelled ones among them, does not reject."""
    trees = quality.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.score(docs, trees, columns=tuple(docs.columns)).filter("predicted = 1").select(docs.columns)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Boilerplate lines stay in one document; a document of nothing but such lines of others goes. n_chars follows the text."""
    kept = line_dedup.dedup_lines(docs, min_docs=MIN_DOCS, keep="first")
    kept = kept.filter((F.col("n_dropped") == 0) | F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    if "n_chars" in docs.columns:
        changed = F.col("n_dropped") > 0
        kept = kept.withColumn("n_chars", F.when(changed, F.length("text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType))
    return kept.select(docs.columns)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return near_dedup.drop_near_duplicates(docs).select(docs.columns)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of a benchmark item."""
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).select(docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Batches of a token budget in length buckets; lengths for a byte-level vocabulary with an end mark."""
    lengths = docs.select("doc_id", (F.octet_length(F.coalesce("text", F.lit(""))) + 1).alias("length"))
    return packing.pack(lengths, "length", buckets=8, max_len=8192, budget=65_536)


STAGES = [
    ("quality classifier", keep_good),
    ("line dedup", drop_lines),
    ("near-dedup", drop_copies),
    ("benchmark decontamination", drop_benchmark),
    ("packing", pack),
]
#: No SQL says boosted trees or the least padding; tests/llm compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = folders.save(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
