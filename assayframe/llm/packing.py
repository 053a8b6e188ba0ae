"""Optimal length buckets and batches of a token budget.

Dynamic programming over the global histogram of lengths chooses the ``buckets`` upper limits that need the least
padding: every sequence is padded to the limit of its bucket. Inside a bucket, batches of floor(budget / limit)
sequences (one at least) are formed.

A document longer than ``max_len`` is laid out as pieces of ``max_len`` tokens and a rest, so nothing is cut off and the
histogram has at most ``max_len`` entries, the bound on what reaches the driver. Null and negative lengths count as 0;
documents of length 0 get no piece to fill and stand in one row with piece null. Null ids, repeated rows and ties are
ordered by id and then arbitrarily among rows alike.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window, functions as F

from . import folders

#: Rows that are numbered together in a task.
CHUNK_ROWS = 200_000


def bucket_limits(lengths: np.ndarray, counts: np.ndarray, buckets: int) -> list[int]:
    """The limits (ascending, the last is the largest length) with the least total padding for the histogram.

    Cost of a bucket over the lengths i..j-1: limit times sequences less their tokens. Of equally good choices that with
    the smaller limits is taken.
    """
    order = np.argsort(lengths)
    lengths, counts = np.asarray(lengths, np.float64)[order], np.asarray(counts, np.float64)[order]
    m = len(lengths)
    if not m:
        return []
    n = np.concatenate([[0], np.cumsum(counts)])
    best = np.full(m + 1, np.inf)  # padded tokens of the first j lengths
    best[0] = 0
    back = []
    for _ in range(min(buckets, m)):
        now, came = np.full(m + 1, np.inf), np.zeros(m + 1, np.int64)
        now[0] = 0
        for j in range(1, m + 1):
            cost = best[:j] + lengths[j - 1] * (n[j] - n[:j])
            came[j] = i = int(np.argmin(cost))
            now[j] = cost[i]
        best = now
        back.append(came)
    limits, j = [], m
    for came in reversed(back):
        if j == 0:
            break
        limits.append(int(lengths[j - 1]))
        j = int(came[j])
    return sorted(limits)


def pack(
    docs: DataFrame, length: str, id_col: str = "doc_id", buckets: int = 8, max_len: int = 2048, budget: int = 16_384, chunk_rows: int = CHUNK_ROWS
) -> DataFrame:
    """One row per piece: id, piece (from 0), start, n_tokens, bucket (from 0), bucket_len, batch (from 0 in its bucket), slot.

    The id column keeps its name.
    """
    if min(buckets, max_len, budget, chunk_rows) < 1:
        raise ValueError("buckets, max_len, budget and chunk_rows are positive")
    tokens = F.greatest(F.coalesce(F.col(length).cast("long"), F.lit(0)), F.lit(0))
    rows = docs.select(F.col(id_col).alias("id"), tokens.alias("n"))
    last = F.floor((F.col("n") - 1) / max_len)
    pieces = rows.select("id", "n", F.explode_outer(F.when(F.col("n") > 0, F.sequence(F.lit(0), last))).alias("piece"))
    pieces = pieces.select("id", F.col("piece").cast("long").alias("piece"), (F.col("piece") * max_len).cast("long").alias("start"), F.when(F.col("piece").isNull(), 0).otherwise(F.least(F.lit(max_len), F.col("n") - F.col("piece") * max_len)).cast("long").alias("n_tokens"))
    pieces = folders.save(pieces, "pieces")

    histogram = pieces.filter("piece is not null").groupBy("n_tokens").count().toPandas()  # at most max_len rows
    limits = bucket_limits(histogram["n_tokens"].to_numpy(), histogram["count"].to_numpy(), buckets)
    edges = F.array(*[F.lit(x).cast("long") for x in limits]) if limits else F.array().cast("array<long>")
    bucket = F.when(F.col("piece").isNotNull(), F.size(F.filter(edges, lambda x: x < F.col("n_tokens"))))
    placed = pieces.withColumn("bucket", bucket).withColumn("bucket_len", F.get(edges, F.col("bucket")))

    # a place within the bucket: places within chunks of bounded size, after the chunks before
    chunks = int(np.ceil(max(1, int(histogram["count"].sum())) / chunk_rows))
    placed = placed.withColumn("chunk", F.pmod(F.xxhash64("id", "piece"), F.lit(chunks)))
    sizes = placed.groupBy("bucket", "chunk").agg(F.count(F.lit(1)).alias("size"))
    before = sizes.select("bucket", "chunk", (F.sum("size").over(Window.partitionBy("bucket").orderBy("chunk")) - F.col("size")).alias("before"))
    inside = F.row_number().over(Window.partitionBy("bucket", "chunk").orderBy("id", "piece")) - 1
    numbered = placed.withColumn("inside", inside).join(before.withColumnsRenamed({"bucket": "_b", "chunk": "_c"}), F.col("bucket").eqNullSafe(F.col("_b")) & (F.col("chunk") == F.col("_c")))
    place = F.col("before") + F.col("inside")
    rows_of = F.greatest(F.lit(1), F.floor(F.lit(budget) / F.col("bucket_len")))
    return numbered.select(
        F.col("id").alias(id_col),
        "piece",
        "start",
        "n_tokens",
        "bucket",
        "bucket_len",
        F.floor(place / rows_of).cast("long").alias("batch"),
        F.when(F.col("bucket").isNotNull(), place % rows_of).cast("int").alias("slot"),
    )
