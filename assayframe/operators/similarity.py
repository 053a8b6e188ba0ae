"""Cross products, correlations and distances.

Samples: each task multiplies its own block of features into a small samples × samples matrix and only
those are added up, so no pair of cells is ever emitted.
Features: the output is one number per pair of features. Features are cut into blocks and a
task gets two groups of blocks; each feature is sent once per group instead of once per partner. With a threshold, blocks are
cells of like features, and pairs of blocks that are too far apart are not compared.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..functions.numeric import nan_to_null
from ..sources.staging import stage
from .matrix import sample_list


def by_feature(long: DataFrame) -> DataFrame:
    """Cells partitioned by feature into a set number of tasks.

    The grouping that follows reuses this shuffle. Naming the number keeps adaptive execution from merging
    small partitions: the numpy step after it is heavy on computing, not on bytes.
    """
    return long.repartition(int(long.sparkSession.conf.get("spark.sql.shuffle.partitions")), "feature")


def feature_vectors(long: DataFrame, samples: DataFrame, out: str = "x") -> DataFrame:
    """One row per feature that has a value in every sample: the values in sample order."""
    order = sample_list(samples)
    v = nan_to_null("value")
    rows = by_feature(long.filter(v.isNotNull())).groupBy("feature").agg(
        F.map_from_entries(F.collect_list(F.struct("sample", v.alias("value")))).alias("_m")
    )
    rows = rows.withColumn("_s", order).filter(F.size("_m") == F.size("_s"))
    return rows.select("feature", F.transform("_s", lambda s: F.col("_m")[s]).alias(out))


def _block(batch: pd.DataFrame, column: str) -> np.ndarray:
    return np.stack(batch[column].to_numpy()).astype("float64")


def cross_products(vectors: DataFrame, column: str = "x", centre: bool = False) -> DataFrame:
    """(i, j, g): sum over rows of x_i * x_j; position n (one past the last) is a constant 1.

    With ``centre`` every row is centred first.
    """

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = None
        for batch in batches:
            if len(batch):
                x = _block(batch, column)
                if centre:
                    x = x - x.mean(axis=1, keepdims=True)
                x = np.hstack([x, np.ones((len(x), 1))])
                total = x.T @ x if total is None else total + x.T @ x
        if total is not None:
            n = len(total)
            i, j = np.divmod(np.arange(n * n), n)
            yield pd.DataFrame({"i": i, "j": j, "g": total.ravel()})

    parts = vectors.select(column).mapInPandas(partial, "i int, j int, g double")
    return parts.groupBy("i", "j").agg(F.sum("g").alias("g"))


def _name_positions(pairs: DataFrame, samples: DataFrame) -> DataFrame:
    named = pairs.withColumn("_s", sample_list(samples))
    return named.withColumns({"a": F.get("_s", F.col("i")), "b": F.get("_s", F.col("j"))}).drop("_s", "i", "j")


def sample_correlation(long: DataFrame, samples: DataFrame) -> DataFrame:
    """Pearson correlation of every pair of samples over the complete features."""
    products = cross_products(feature_vectors(long, samples))
    # at most (samples + 1)^2 rows from here on
    n_samples = samples.agg(F.count_distinct("sample").cast("int")).scalar()
    tagged = products.withColumn("_n", n_samples)
    pair = tagged.filter((F.col("i") < F.col("_n")) & (F.col("j") < F.col("_n"))).select("i", "j", "g")
    own = pair.filter("i = j").select("i", F.col("g").alias("gg"))
    sums = tagged.filter((F.col("j") == F.col("_n")) & (F.col("i") < F.col("_n"))).select("i", F.col("g").alias("s"))
    one = tagged.filter((F.col("i") == F.col("_n")) & (F.col("j") == F.col("_n"))).select("g").scalar()
    side = own.join(sums, "i")
    rows = (
        pair.join(side.withColumnsRenamed({"gg": "gi", "s": "si"}), "i")
        .join(side.withColumnsRenamed({"i": "j", "gg": "gj", "s": "sj"}), "j")
        .withColumn("_m", one)
    )
    m = F.col("_m")
    cov = F.col("g") - F.col("si") * F.col("sj") / m
    vi = F.col("gi") - F.col("si") * F.col("si") / m
    vj = F.col("gj") - F.col("sj") * F.col("sj") / m
    r = F.when((vi > 0) & (vj > 0), cov / F.sqrt(vi * vj))
    return _name_positions(rows.select("i", "j", r.alias("r")), samples).select("a", "b", "r")


def sample_distance(long: DataFrame, samples: DataFrame) -> DataFrame:
    """Euclidean distance of every pair of samples over the complete features (a < b).

    Pairs are differenced inside the task before squaring, so close samples lose no digits.
    """

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = None
        for batch in batches:
            if len(batch):
                x = _block(batch, "x")
                n = x.shape[1]
                d = np.vstack([((x - x[:, [i]]) ** 2).sum(axis=0) for i in range(n)])
                total = d if total is None else total + d
        if total is not None:
            i, j = np.triu_indices(len(total), 1)
            yield pd.DataFrame({"i": i, "j": j, "g": total[i, j]})

    parts = feature_vectors(long, samples).select("x").mapInPandas(partial, "i int, j int, g double")
    summed = parts.groupBy("i", "j").agg(F.sqrt(F.sum("g")).alias("distance"))
    return _name_positions(summed, samples).select("a", "b", "distance")


_SAMPLE, _DIRECTIONS, _DEPTH = 2000, 8, 8  # features that place the cells, directions of the cells, and halvings at most
_BLOCKS = 256  # blocks grow so that there are about so many, or twice that where cells are uneven
_GROUPS = 16  # groups of blocks that tasks get two of, so that a feature is sent about so many times whatever their number


class Blocks(NamedTuple):
    """Features in blocks (feature, x, _b) and the pairs of blocks that can hold a wanted pair of features."""

    placed: DataFrame
    pairs: np.ndarray
    n_blocks: int

    @property
    def skipped(self) -> float:
        """Share of all pairs of blocks that need no look."""
        return 1 - len(self.pairs) / (self.n_blocks * (self.n_blocks + 1) / 2)


def feature_blocks(vectors: DataFrame, reach: float | None, mirror: bool = False, block_rows: int = 1000) -> Blocks:
    """Blocks of about ``block_rows`` features (feature, x), and the pairs of blocks within ``reach`` of each other.

    A block has more than ``block_rows`` features where there would be more than ``_BLOCKS`` of them. Without ``reach`` features are
    dealt by hash, and all pairs of blocks stay. Otherwise a bounded sample gives the directions
    in which the features differ most, and cuts in them that halve it again and again; a block is (a part of) one cell between
    the cuts. The ranges of all features of a cell in these directions bound how near two cells can be: a pair of cells that is
    farther apart than ``reach`` is skipped. With ``mirror`` the negative of a feature counts as well.
    """
    vectors = stage(vectors.select("feature", "x"))
    n_rows = vectors.count()
    hashed = F.xxhash64("feature")
    block_rows = max(block_rows, math.ceil(n_rows / _BLOCKS))
    n_blocks = max(1, math.ceil(n_rows / block_rows))
    if reach is None or n_blocks == 1:
        lo, hi = np.triu_indices(n_blocks)
        return Blocks(vectors.withColumn("_b", F.pmod(hashed, F.lit(n_blocks)).cast("int")), np.stack([lo, hi], axis=1), n_blocks)
    some = np.stack([np.array(r["x"]) for r in vectors.orderBy(hashed, "feature").limit(_SAMPLE).select("x").collect()])
    directions = np.linalg.svd(some - some.mean(axis=0), full_matrices=False)[2][:_DIRECTIONS].T
    depth = min(_DEPTH, math.ceil(math.log2(n_blocks)))
    cuts: list[tuple[int, float]] = []
    groups = [some @ directions]
    for _ in range(depth):
        halves = []
        for own in groups:
            along = int(np.ptp(own, axis=0).argmax()) if len(own) else 0
            middle = float(np.median(own[:, along])) if len(own) else 0.0
            cuts.append((along, middle))
            halves += [own[own[:, along] <= middle], own[own[:, along] > middle]]
        groups = halves
    along, middle = (np.array(c) for c in zip(*cuts, strict=True))
    kind = vectors.schema["feature"].dataType.simpleString()

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                y = np.stack(batch.column(1).to_numpy(zero_copy_only=False)) @ directions
                at = np.zeros(len(y), np.int64)
                for _ in range(depth):
                    at = 2 * at + 1 + (y[np.arange(len(y)), along[at]] > middle[at])
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(at - (2**depth - 1)), pa.array(list(y), pa.list_(pa.float64()))], names=["feature", "x", "_cell", "_y"])

    placed = stage(vectors.mapInArrow(place, f"feature {kind}, x array<double>, _cell long, _y array<double>"))
    k = directions.shape[1]
    ends = [f(F.get("_y", F.lit(i))).alias(f"{name}{i}") for name, f in (("lo", F.min), ("hi", F.max)) for i in range(k)]
    cells = placed.groupBy("_cell").agg(F.count(F.lit(1)).alias("n"), *ends).orderBy("_cell").toPandas()  # 2 ** _DEPTH rows at most
    low, high = (cells[[f"{name}{i}" for i in range(k)]].to_numpy() for name in ("lo", "hi"))
    parts = np.ceil(cells["n"].to_numpy() / block_rows).astype(int)
    first = np.cumsum(parts) - parts

    def apart(low2: np.ndarray, high2: np.ndarray) -> np.ndarray:
        gap = np.maximum(np.maximum(low[:, None] - high2[None], low2[None] - high[:, None]), 0)
        return np.sqrt((gap**2).sum(axis=2))

    near = apart(low, high) if not mirror else np.minimum(apart(low, high), apart(-high, -low))
    one, two = np.nonzero(np.triu(near <= reach * (1 + 1e-9) + 1e-9))
    pairs = [(i, j) for a, b in zip(one, two, strict=True) for i in range(first[a], first[a] + parts[a]) for j in range(first[b], first[b] + parts[b]) if i <= j]
    table = placed.sparkSession.createDataFrame([(int(c), int(f), int(p)) for c, f, p in zip(cells["_cell"], first, parts, strict=True)], "_cell long, _first int, _parts int")
    block = (F.col("_first") + F.pmod(hashed, F.col("_parts"))).cast("int").alias("_b")
    return Blocks(placed.join(table, "_cell").select("feature", "x", block), np.array(pairs).reshape(-1, 2), int(parts.sum()))


def _sent(blocks: Blocks, groups: int) -> tuple[DataFrame, dict[tuple[int, int], list[tuple[int, int]]]]:
    """Rows (feature, x, _b, _lo, _hi) for the tasks (_lo, _hi), and the pairs of blocks of each task.

    Neighbouring blocks make so many ``groups``, and a task gets two of them.
    """
    each = math.ceil(blocks.n_blocks / groups)
    wanted: dict[tuple[int, int], list[tuple[int, int]]] = {}
    for lo, hi in blocks.pairs.tolist():
        wanted.setdefault((lo // each, hi // each), []).append((lo, hi))
    meets = [(g, lo, hi) for lo, hi in wanted for g in dict.fromkeys((lo, hi))]
    table = blocks.placed.sparkSession.createDataFrame(meets, "_g int, _lo int, _hi int")
    rows = blocks.placed.select("feature", "x", "_b", F.floor(F.col("_b") / each).cast("int").alias("_g"))
    return rows.join(table, "_g").select("feature", "x", "_b", "_lo", "_hi"), wanted


def _feature_pairs(vectors: DataFrame, kernel, schema: str, block_rows: int, reach: float | None = None, mirror: bool = False) -> DataFrame:
    """Run ``kernel`` on all pairs of blocks that may hold results, ``block_rows`` features against as many at a time.

    A task gets two of ``_GROUPS`` groups of blocks: what is sent grows with the features, not with their square.
    """
    sent, wanted = _sent(feature_blocks(vectors, reach, mirror, block_rows), _GROUPS)
    pairs_of = vectors.sparkSession.sparkContext.broadcast(wanted)  # pairs of blocks, whose number has a bound
    names = [c.split()[0] for c in schema.split(", ")]

    def run(key: tuple, batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        got = [(b["feature"].to_numpy(), b["_b"].to_numpy(), _block(b, "x")) for b in batches if len(b)]
        feature, block, x = (np.concatenate(c) for c in zip(*got, strict=True))
        order = np.argsort(block, kind="stable")
        feature, block, x = feature[order], block[order], x[order]

        def parts(b: int) -> list[slice]:
            first, end = np.searchsorted(block, (b, b + 1)).tolist()
            return [slice(i, min(i + block_rows, end)) for i in range(first, end, block_rows)]

        for lo, hi in pairs_of.value[key]:
            for left in parts(lo):
                for right in parts(hi):
                    if lo == hi and right.start < left.start:
                        continue
                    values, keep = kernel(x[left], x[right])
                    lf, rf = feature[left], feature[right]
                    if left == right:
                        keep &= lf[:, None] < rf[None, :]
                    i, j = np.nonzero(keep)
                    if len(i):
                        first, second = lf[i], rf[j]
                        swap = first > second
                        yield pd.DataFrame(dict(zip(names, (np.where(swap, second, first), np.where(swap, first, second), values[i, j]), strict=True)))

    return sent.groupBy("_lo", "_hi").applyInPandas(run, schema)


def feature_correlation(long: DataFrame, samples: DataFrame, min_abs: float = 0.0, block_rows: int = 1000) -> DataFrame:
    """Pearson correlation of the pairs of complete, non-constant features with |r| >= min_abs (a < b).

    As vectors of length one, features with that r are at most sqrt(2 - 2 min_abs) from each other or from the other's
    negative, so a threshold lets whole pairs of blocks be skipped; without one the result is all pairs.
    """
    x = F.col("x")
    mean = F.aggregate(x, F.lit(0.0), lambda s, v: s + v) / F.size(x)
    vectors = feature_vectors(long, samples).withColumn("x", F.transform(x, lambda v: v - mean))
    norm = F.sqrt(F.aggregate(F.col("x"), F.lit(0.0), lambda s, v: s + v * v))
    vectors = vectors.withColumn("_norm", norm).filter(F.col("_norm") > 0)
    vectors = vectors.withColumn("x", F.transform(F.col("x"), lambda v: v / F.col("_norm"))).drop("_norm")
    kind = dict(vectors.dtypes)["feature"]

    def kernel(left: np.ndarray, right: np.ndarray):
        r = left @ right.T
        return r, np.abs(r) >= min_abs

    reach = math.sqrt(max(0.0, 2 - 2 * min_abs)) if min_abs > 0 else None
    return _feature_pairs(vectors, kernel, f"a {kind}, b {kind}, r double", block_rows, reach, mirror=True)


def feature_distance(long: DataFrame, samples: DataFrame, max_distance: float | None = None, block_rows: int = 1000) -> DataFrame:
    """Euclidean distance of the pairs of complete features, optionally only up to a distance (a < b), which lets pairs of blocks be skipped."""
    vectors = feature_vectors(long, samples)
    kind = dict(vectors.dtypes)["feature"]

    def kernel(left: np.ndarray, right: np.ndarray):
        d2 = np.zeros((len(left), len(right)))
        for s in range(left.shape[1]):
            d2 += (left[:, s][:, None] - right[:, s][None, :]) ** 2
        d = np.sqrt(d2)
        return d, (d <= max_distance) if max_distance is not None else np.ones_like(d, dtype=bool)

    return _feature_pairs(vectors, kernel, f"a {kind}, b {kind}, distance double", block_rows, max_distance)


def pairwise_distance(long: DataFrame, samples: DataFrame, by: str = "sample", **options) -> DataFrame:
    """Distance table behind the clustered heat maps, between samples or between features."""
    if by == "sample":
        return sample_distance(long, samples)
    if by == "feature":
        return feature_distance(long, samples, **options)
    raise ValueError(f"unknown axis {by!r}")
