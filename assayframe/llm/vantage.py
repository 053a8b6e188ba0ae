"""Nearest neighbours by vantage-point trees, one per shard.

Vectors are dealt to shards by a hash of their id. A tree halves its points again and again by their distance to a
vantage point and keeps, for both halves, the smallest and largest such distance; the triangle inequality turns these
into a lower bound on the distance of a query to every leaf. A query visits the leaf of the smallest bound, then those of which
``factor`` times the bound does not exceed its k-th distance so far: factor 1 is exact, larger factors visit less.

Vectors that are null, of another length than ``dim``, all zero or with null or non-finite components take no part, nor
do rows with a null id. A query never finds rows of its own id. Equal distances go to the smaller id; several rows of one
id are separate candidates. Fewer candidates than k are all returned; without queries or vectors there are no rows.
"""

from __future__ import annotations

import struct
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from . import folders

SHARD_ROWS = 16_384
LEAF = 128
QUERY_BLOCK = 1_024
#: Measured recall in README.md.
FACTOR = 2.5


class Tree(NamedTuple):
    """Points in leaf order; node i of a level-wise complete tree halves the points ``cut[level][j]:cut[level][j + 1]``."""

    ids: np.ndarray
    points: np.ndarray  # float64
    pivots: np.ndarray  # (nodes, dim)
    ranges: np.ndarray  # (nodes, 4): smallest and largest distance to the pivot, near half then far half
    cuts: np.ndarray  # (leaves + 1)
    depth: int


def build(ids: np.ndarray, points: np.ndarray, leaf: int = LEAF) -> Tree:
    n = len(ids)
    depth = max(0, int(np.ceil(np.log2(max(1, n / leaf)))))
    order = np.argsort(ids, kind="stable")
    cuts = np.array([0, n])
    pivots, ranges = [], []
    for _ in range(depth):
        new = [0]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            own = order[a:b]
            middle = (b - a + 1) // 2
            # the point farthest from the first one: vantage points at the rim part best
            seed = points[own[0]]
            pivot = points[own[np.argmax(((points[own] - seed) ** 2).sum(axis=1))]]
            d = np.sqrt(((points[own] - pivot) ** 2).sum(axis=1))
            by = np.argsort(d, kind="stable")
            order[a:b], d = own[by], d[by]
            far = d[middle:] if middle < len(d) else np.array([np.inf])
            pivots.append(pivot)
            ranges.append((d[0], d[middle - 1], far[0], far[-1]))
            new += [a + middle, b]
        cuts = np.array(new)
    dim = points.shape[1]
    return Tree(ids[order], points[order], np.array(pivots).reshape(-1, dim), np.array(ranges).reshape(-1, 4), cuts, depth)


def search(tree: Tree, query_ids: np.ndarray, queries: np.ndarray, k: int, factor: float) -> tuple[np.ndarray, np.ndarray]:
    """Ids and distances (queries, k), nearest first; infinite distances where there is no further candidate."""
    m = len(queries)
    best = np.full((m, k), np.inf)
    found = np.full((m, k), np.iinfo(np.int64).max)
    bound = np.zeros((m, 1))
    first = 0
    for level in range(tree.depth):
        count = 1 << level
        d = distances(queries, tree.pivots[first : first + count])
        lo1, hi1, lo2, hi2 = tree.ranges[first : first + count].T
        near = np.maximum(bound, np.maximum(lo1 - d, d - hi1))
        far = np.maximum(bound, np.maximum(lo2 - d, d - hi2))
        bound = np.stack([near, far], axis=2).reshape(m, -1)
        first += count
    bound *= factor * (1 - 1e-9)  # the bounds are rounded

    def visit(leaf: int, own: np.ndarray) -> None:
        a, b = tree.cuts[leaf], tree.cuts[leaf + 1]
        d = closer(queries[own], tree.points[a:b], best[own, -1])
        d[tree.ids[a:b][None, :] == query_ids[own, None]] = np.inf
        some = np.isfinite(d).any(axis=1)
        own, d = own[some], d[some]
        ids = np.broadcast_to(tree.ids[a:b], d.shape)
        all_d, all_i = np.concatenate([best[own], d], axis=1), np.concatenate([found[own], ids], axis=1)
        top = np.lexsort((all_i, all_d), axis=1)[:, :k]
        best[own], found[own] = np.take_along_axis(all_d, top, axis=1), np.take_along_axis(all_i, top, axis=1)

    # the leaf with the smallest bound first, then every leaf with the queries that its bound does not rule out by then
    nearest_leaf = bound.argmin(axis=1)
    for leaf in np.unique(nearest_leaf).tolist():
        visit(leaf, np.flatnonzero(nearest_leaf == leaf))
    for leaf in np.argsort(bound.sum(axis=0), kind="stable").tolist():
        own = np.flatnonzero((bound[:, leaf] <= best[:, -1]) & (nearest_leaf != leaf))
        if len(own):
            visit(leaf, own)
    return found, best


def closer(a: np.ndarray, b: np.ndarray, limit: np.ndarray) -> np.ndarray:
    """Exact distances where they may be at most the row's limit, else infinity; a matrix product rules out the others."""
    square_a, square_b = (a * a).sum(axis=1), (b * b).sum(axis=1)
    rough = square_a[:, None] + square_b[None, :] - 2 * (a @ b.T)
    slack = 1e-9 * (square_a[:, None] + square_b[None, :])
    i, j = np.nonzero(rough <= (limit * limit)[:, None] + slack)
    out = np.full(rough.shape, np.inf)
    for at in range(0, len(i), 1 << 13):
        own = slice(at, at + (1 << 13))
        out[i[own], j[own]] = np.sqrt(((a[i[own]] - b[j[own]]) ** 2).sum(axis=1))
    return out


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Euclidean distances from the differences themselves, a few rows at a time; equal vectors have exactly equal ones."""
    out = np.empty((len(a), len(b)))
    rows = max(1, (1 << 18) // max(1, b.size))
    for i in range(0, len(a), rows):
        out[i : i + rows] = np.sqrt(((a[i : i + rows, None, :] - b[None]) ** 2).sum(axis=2))
    return out


def to_bytes(tree: Tree) -> bytes:
    head = struct.pack("<4q", len(tree.ids), tree.points.shape[1], len(tree.pivots), tree.depth)
    return head + b"".join(np.ascontiguousarray(x).tobytes() for x in (tree.ids, tree.points, tree.pivots, tree.ranges, tree.cuts.astype(np.int64)))


def from_bytes(data: bytes) -> Tree:
    n, dim, nodes, depth = struct.unpack_from("<4q", data)
    at, out = 32, []
    for kind, shape in ((np.int64, (n,)), (np.float64, (n, dim)), (np.float64, (nodes, dim)), (np.float64, (nodes, 4)), (np.int64, ((1 << depth) + 1,))):
        size = int(np.prod(shape))
        out.append(np.frombuffer(data, kind, size, at).reshape(shape))
        at += 8 * size
    return Tree(*out, depth)


def usable(vectors: DataFrame, id_col: str, vector: str, dim: int) -> DataFrame:
    """(id, v): the rows that take part, as doubles."""
    v = F.col(vector).cast("array<double>")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    good = F.col(id_col).isNotNull() & v.isNotNull() & (F.size(v) == dim) & finite & F.exists(v, lambda x: x != 0)
    return vectors.filter(F.coalesce(good, F.lit(False))).select(F.col(id_col).cast("long").alias("id"), v.alias("v"))


def index(vectors: DataFrame, id_col: str, vector: str, dim: int, shard_rows: int = SHARD_ROWS) -> tuple[DataFrame, int]:
    """The trees (shard, tree) as a table in the shared folder, and their number."""
    rows = usable(vectors, id_col, vector, dim)
    shards = max(1, -(-rows.count() // shard_rows))

    def grow(pdf: pd.DataFrame) -> pd.DataFrame:
        tree = build(pdf["id"].to_numpy(np.int64), np.stack(pdf["v"].to_list()).astype(np.float64))
        return pd.DataFrame({"shard": [pdf["shard"].iloc[0]], "tree": [to_bytes(tree)]})

    dealt = rows.withColumn("shard", F.pmod(F.xxhash64("id"), F.lit(shards)))
    return folders.save(dealt.groupBy("shard").applyInPandas(grow, "shard long, tree binary"), "trees"), shards


def nearest(
    trees: DataFrame, shards: int, queries: DataFrame, id_col: str, vector: str, dim: int, k: int = 10, factor: float = FACTOR, block: int = QUERY_BLOCK
) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k nearest found for each query row of distinct id.

    Every shard meets the queries in blocks of bounded size; a task holds one tree and one block.
    """
    if factor < 1:
        raise ValueError("factor 1 is exact; smaller ones only cost time")
    asked = usable(queries, id_col, vector, dim)
    blocks = max(1, -(-asked.count() // block))
    dealt = asked.withColumn("block", F.pmod(F.xxhash64("id", F.lit(3)), F.lit(blocks)))
    dealt = dealt.withColumn("shard", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long"))))
    trees = trees.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))))

    def run(tree: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        none = pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype({"query_id": "int64", "vec_id": "int64"})
        if not len(tree) or not len(asked):
            return none
        own = asked["id"].to_numpy(np.int64)
        ids, score = search(from_bytes(tree["tree"].iloc[0]), own, np.stack(asked["v"].to_list()).astype(np.float64), k, factor)
        there = np.isfinite(score)
        return pd.DataFrame({"query_id": np.repeat(own, there.sum(axis=1)), "vec_id": ids[there], "score": score[there]})

    keys = ["shard", "block"]
    found = trees.groupBy(*keys).cogroup(dealt.groupBy(*keys)).applyInPandas(run, "query_id long, vec_id long, score double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
