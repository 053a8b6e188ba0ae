"""Random-forest classification of samples.

Input: (id, label, features) with a class label and an array of numbers per sample, of one length. Each tree has its own
bootstrap, Poisson weights made of the samples' hashes, so which trees left a sample out can be told at any time and the
out-of-bag votes need no second fit. Confusion table, importance and outlier scores come from the same trees.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..session import widen
from ..sources.staging import stage
from .ordered import exact_quantiles


def sample_vectors(long: DataFrame, samples: DataFrame) -> DataFrame:
    """One row per sample: its class and its values in feature order (complete features only)."""
    n_samples = samples.agg(F.count_distinct("sample")).scalar()
    complete = long.filter(F.col("value").isNotNull()).groupBy("feature").agg(F.count_distinct("sample").alias("_n"))
    complete = complete.filter(F.col("_n") == n_samples).select("feature")
    rows = long.join(complete, "feature", "left_semi").groupBy("sample").agg(
        F.array_sort(F.collect_list(F.struct("feature", "value"))).alias("_v")
    )
    return rows.join(samples.select("sample", "condition").distinct(), "sample").select(
        F.col("sample").alias("id"), F.col("condition").alias("label"), F.transform("_v", lambda x: x["value"]).alias("features")
    )


DEPTH = 30
BINS = 64  # a feature's values are compared with at most so many cut points, its approximate quantiles
_BLOCK = 256  # samples that a sample's leaves are compared with at a time
_ROWS = 1024  # samples that are walked through all trees, or whose votes are added up, at a time
_STEP = np.uint64(0x9E3779B97F4A7C15)
#: The chances that a Poisson number of mean 1 is at most 0, 1, 2 and so on.
_POISSON = np.cumsum([math.exp(-1) / math.factorial(i) for i in range(16)])


def _mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (the finaliser of splitmix64)."""
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return x ^ (x >> np.uint64(31))


def _weights(h: np.ndarray, trees: int, first: int = 0) -> np.ndarray:
    """(samples, trees): how often the bootstraps of so many trees from the ``first`` on draw a sample, a Poisson number made of the
    sample's hash."""
    u = _mixed(h.view(np.uint64)[:, None] + np.arange(first + 1, first + trees + 1, dtype=np.uint64)[None, :] * _STEP)
    return np.searchsorted(_POISSON, (u >> np.uint64(11)).astype(np.float64) * 2.0**-53, "right").astype(np.int64)


class Forest(NamedTuple):
    """Grown trees as arrays (tree, node): the split feature (-1 in a leaf), the last bin that goes left, the first child
    (the second one follows), the class of the larger weight, and the weighted Gini decrease of the split."""

    feature: np.ndarray
    limit: np.ndarray
    child: np.ndarray
    winner: np.ndarray
    decrease: np.ndarray
    labels: list[str]
    prepared: DataFrame  # id, label, y, h, x (a byte for each feature's bin), row (a number for each sample)

    def leaves(self, x: np.ndarray) -> np.ndarray:
        """(samples, trees): the node where each sample ends."""
        row, tree = np.divmod(np.arange(len(x) * len(self.feature)), len(self.feature))
        return _walk(self.feature, self.limit, self.child, x, row, tree).reshape(len(x), len(self.feature))


def _walk(feature: np.ndarray, limit: np.ndarray, child: np.ndarray, x: np.ndarray, row: np.ndarray, tree: np.ndarray) -> np.ndarray:
    """The node of each pair's tree where its sample (row of x) ends; a step is done for those that are not there yet."""
    root = tree.astype(np.int64) * feature.shape[1]
    feature, limit, child = feature.ravel(), limit.ravel(), child.ravel()
    at, going = root.copy(), np.arange(len(root))
    while len(going):
        split = feature[at[going]]
        inner = split >= 0
        going, split = going[inner], split[inner]
        now = at[going]
        at[going] = root[going] + child[now] + (x[row[going], split] > limit[now])
    return at - root


def _prepared(rows: DataFrame, seed: int) -> tuple[DataFrame, list[str], int]:
    """Samples with their class number, a hash and the bins of all features, cut at approximate quantiles."""
    rows = stage(rows.select("id", F.col("label").cast("string").alias("label"), F.col("features").cast("array<double>").alias("features")))
    labels = [r[0] for r in rows.select("label").distinct().orderBy("label").collect()]
    each = rows.select(F.posexplode("features").alias("at", "v"))
    shares = F.array(*[F.lit(i / BINS) for i in range(1, BINS)])
    cuts = each.groupBy("at").agg(F.array_distinct(F.percentile_approx("v", shares, F.lit(20_000))).alias("cuts")).orderBy("at").collect()
    if any(r["cuts"] is None for r in cuts):
        raise ValueError("every feature needs values")
    cuts = [np.array(r["cuts"]) for r in cuts]
    spark = rows.sparkSession
    sent = spark.sparkContext.broadcast(cuts)  # BINS numbers for each feature

    def bins(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.stack(batch.column(4).to_numpy(zero_copy_only=False)) if batch.num_rows else np.zeros((0, len(sent.value)))
            binned = np.stack([np.searchsorted(c, x[:, i], "left") for i, c in enumerate(sent.value)], axis=1).astype(np.uint8)
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array([b.tobytes() for b in binned], pa.binary())], names=["id", "label", "y", "h", "x"])

    y = F.array_position(F.array(*[F.lit(x) for x in labels]), F.col("label")).cast("int") - 1
    # each level walks these rows again, so they are dealt out once
    numbered = widen(rows.select("id", "label", y.alias("y"), F.xxhash64("id", F.lit(seed)).alias("h"), "features"))
    kind = rows.schema["id"].dataType.simpleString()
    binned = numbered.mapInArrow(bins, f"id {kind}, label string, y int, h long, x binary")
    return stage(binned.withColumn("row", F.monotonically_increasing_id())), labels, len(cuts)


def _arrays(batch: pa.RecordBatch, h: int, x: int) -> tuple[np.ndarray, np.ndarray]:
    return batch.column(h).to_numpy(), np.stack([np.frombuffer(b, np.uint8) for b in batch.column(x).to_pylist()])


def bootstrap_weights(rows: DataFrame, trees: int = 500, seed: int = 1) -> DataFrame:
    """(id, tree, weight): the bootstrap weights with which the trees of that seed are grown."""
    kind = rows.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            w = _weights(batch.column(1).to_numpy(), trees)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(np.repeat(np.arange(len(w)), trees))), pa.array(np.tile(np.arange(trees), len(w)).astype(np.int32)), pa.array(w.ravel())], names=["id", "tree", "weight"]
            )

    return rows.select("id", F.xxhash64("id", F.lit(seed)).alias("h")).mapInArrow(run, f"id {kind}, tree int, weight long")


def _best_splits(cell: np.ndarray, weight: np.ndarray, per_split: int, n_classes: int) -> tuple[np.ndarray, ...]:
    """Of the weights of cells ((node, feature's place, bin), class), as one number each and in any order: the nodes, and gain, place
    and last bin on the left of each node's best split (the first of equal ones), the classes with the larger weight (whole,
    left, right) and whether the left and the right side are mixed. Only bins that occur are looked at."""
    size = int(cell.max(initial=-1)) // n_classes + 1
    if size * n_classes <= _DENSE * len(cell):
        table = np.bincount(cell, weights=weight, minlength=size * n_classes).reshape(size, n_classes)
        group = np.flatnonzero(table.any(axis=1))
        table = table[group]
    else:
        at, own = np.divmod(cell, n_classes)
        group, where = np.unique(at, return_inverse=True)
        table = np.bincount(where.ravel() * n_classes + own, weights=weight, minlength=len(group) * n_classes).reshape(len(group), n_classes)

    def firsts(of: np.ndarray) -> np.ndarray:
        return np.flatnonzero(np.append(True, np.diff(of) != 0))

    starts = firsts(group // BINS)  # of the features of a node
    sizes = np.diff(np.append(starts, len(group)))
    left = table.cumsum(axis=0)
    left -= np.repeat(left[starts] - table[starts], sizes, axis=0)
    whole = left[starts + sizes - 1]

    def impurity(t: np.ndarray) -> np.ndarray:
        total = t.sum(axis=1)
        return total - np.einsum("bc,bc->b", t, t) / np.maximum(total, 1e-300)

    right = np.repeat(whole, sizes, axis=0) - left
    gain = np.repeat(impurity(whole), sizes) - impurity(left) - impurity(right)
    gain[starts + sizes - 1] = -1  # nothing on the right
    node = group // (BINS * per_split)
    starts = firsts(node)
    most = np.maximum.reduceat(gain, starts)
    hits = np.flatnonzero(gain == np.repeat(most, np.diff(np.append(starts, len(group)))))
    best = hits[firsts(node[hits])]
    place, last = np.divmod(group[best] % (BINS * per_split), BINS)
    one, two = left[best], right[best]
    return node[starts], most, place, last, (one + two).argmax(axis=1), one.argmax(axis=1), two.argmax(axis=1), (one > 0).sum(axis=1) > 1, (two > 0).sum(axis=1) > 1


_DENSE = 4  # cells of a full table for each one that occurs, up to which the full table is counted
_CELLS = 1 << 20  # cells of whole nodes that are searched at a time


class Growth(NamedTuple):
    """What all trees of a forest have in common."""

    trees: int
    per_split: int
    seed: int
    depth: int
    n_classes: int
    n_features: int

    def drawn(self, tree: int, nodes: np.ndarray) -> np.ndarray:
        """Features of each node: those with the smallest hashes of seed, tree, node and feature."""
        base = _mixed(_mixed(np.array([tree], np.uint64) * _STEP + np.uint64(self.seed)) + nodes.astype(np.uint64))
        out = np.empty((len(base), self.per_split), np.int64)
        step = max(1, (1 << 20) // self.n_features)
        for first in range(0, len(base), step):
            ranks = _mixed(base[first : first + step, None] ^ (np.arange(self.n_features, dtype=np.uint64) * _STEP)[None, :])
            out[first : first + step] = np.argsort(ranks, axis=1, kind="stable")[:, : self.per_split]
        return out


_KINDS = {"feature": np.int32, "limit": np.uint8, "child": np.int32, "winner": np.int32, "decrease": np.float64}


def _tree(how: Growth, tree: int, x: np.ndarray, y: np.ndarray, w: np.ndarray) -> dict[str, np.ndarray]:
    """One tree on samples of the weights ``w``, grown level by level: the arrays of :class:`Forest`."""
    levels = [{c: np.full(1, -1 if c == "feature" else 0, k) for c, k in _KINDS.items()}]
    first = 0  # of the nodes of the level
    row = np.flatnonzero(w)
    at = np.zeros(len(row), np.int64)  # the open node of each row
    nodes = np.zeros(1, np.int64) if how.n_classes > 1 and how.n_features and len(row) else np.zeros(0, np.int64)
    for level in range(how.depth):
        if not len(nodes):
            break
        order = np.argsort(at, kind="stable")
        row, at = row[order], at[order]
        upto = np.append(0, np.cumsum(np.bincount(at, minlength=len(nodes))))
        features = how.drawn(tree, nodes)
        found, a = [], 0
        while a < len(nodes):
            # as many whole nodes as hold about _CELLS cells, one at least
            b = max(a + 1, int(np.searchsorted(upto, upto[a] + _CELLS // how.per_split, "right")) - 1)
            some, node = row[upto[a] : upto[b]], at[upto[a] : upto[b]]
            bins = x[some[:, None], features[node]].astype(np.int64)
            cell = (((node - a)[:, None] * how.per_split + np.arange(how.per_split)) * BINS + bins) * how.n_classes + y[some][:, None]
            best = _best_splits(cell.ravel(), np.repeat(w[some], how.per_split), how.per_split, how.n_classes)
            found.append((best[0] + a, *best[1:]))
            a = b
        node, gain, place, last, winner, *sides = (np.concatenate(c) for c in zip(*found, strict=True))
        if level == 0:
            levels[0]["winner"][node] = winner
        split = gain > 1e-9
        node, gain, place, last, *sides = (c[split] for c in (node, gain, place, last, *sides))
        own, size = levels[-1], sum(len(v["child"]) for v in levels)
        inside = nodes[node] - first
        own["feature"][inside], own["limit"][inside], own["decrease"][inside] = features[node, place], last, gain
        own["child"][inside] = child = size + 2 * np.arange(len(node))
        following = {c: np.full(2 * len(node), -1 if c == "feature" else 0, k) for c, k in _KINDS.items()}
        following["winner"][:] = np.stack(sides[:2], axis=1).ravel()
        mixed = np.stack(sides[2:], axis=1).ravel()
        # rows of nodes that were split go on to those of their children that are mixed
        rank = np.full(len(nodes), -1)
        rank[node] = np.arange(len(node))
        going = rank[at] >= 0
        row, at = row[going], rank[at[going]]
        side = 2 * at + (x[row, features[node, place][at]] > last[at])
        row, side = row[mixed[side]], side[mixed[side]]
        at = (np.cumsum(mixed) - 1)[side]
        nodes = np.stack([child, child + 1], axis=1).ravel()[mixed]
        levels.append(following)
        first = size
    return {c: np.concatenate([v[c] for v in levels]) for c in _KINDS}


def _ends(tree: dict[str, np.ndarray], x: np.ndarray) -> np.ndarray:
    """The node where each sample ends."""
    out = np.zeros(len(x), np.int64)
    for first in range(0, len(x), 1 << 16):
        row = np.arange(first, min(first + (1 << 16), len(x)))
        out[row] = _walk(*(tree[c][None, :] for c in ("feature", "limit", "child")), x, row, np.zeros(len(row), np.int64))
    return out


def _over_trees(prepared: DataFrame, how: Growth, work, schema: str) -> DataFrame:
    """The rows that ``work(trees, x, y, h)`` makes of the samples, in the order of their rows, in tasks that share the trees.

    A task holds all samples, a byte for each of their features, and grows its trees one after the other; ``trees`` gives
    (number, arrays, weights) of each. So no tree leaves its task, and a sample is shuffled once per task.
    """
    spark = prepared.sparkSession
    tasks = min(how.trees, 2 * spark.sparkContext.defaultParallelism)
    # keys that the partitions of the shuffle get one of
    keys = spark.range(32 * tasks).groupBy(F.pmod(F.hash("id"), F.lit(tasks)).alias("p")).agg(F.min("id").alias("k")).orderBy("p").collect()
    place = {r["k"]: i for i, r in enumerate(keys)}
    rows = prepared.select("row", "y", "h", "x", F.explode(F.array(*[F.lit(k) for k in place])).alias("_task"))

    def run(key: tuple, table: pa.Table) -> pa.Table:
        table = table.take(pa.array(np.argsort(table["row"].to_numpy(), kind="stable")))
        y, h = table["y"].to_numpy(), table["h"].to_numpy()
        x = np.frombuffer(b"".join(table["x"].to_pylist()), np.uint8).reshape(len(h), -1) if len(h) else np.zeros((0, 0), np.uint8)

        def grown() -> Iterator[tuple[int, dict[str, np.ndarray], np.ndarray]]:
            for tree in range(place[key[0].as_py()], how.trees, len(place)):
                w = _weights(h, 1, tree)[:, 0]
                yield tree, _tree(how, tree, x, y, w), w

        return work(grown(), x, y)

    return rows.repartition(len(place), "_task").groupBy("_task").applyInArrow(run, schema)


def _growth(rows: DataFrame, trees: int, per_split: int, seed: int, depth: int) -> tuple[DataFrame, list[str], Growth]:
    prepared, labels, n_features = _prepared(rows, seed)
    return prepared, labels, Growth(trees, min(per_split, n_features), seed, depth, len(labels), n_features)


def grow(rows: DataFrame, trees: int = 500, per_split: int = 7, seed: int = 1, depth: int = DEPTH) -> Forest:
    """A forest of trees grown until their leaves are pure or ``depth`` deep, brought to the driver.

    A node's split is the best one of ``per_split`` features drawn for it, over their BINS bins, by the bootstrap weights of the tree.
    """
    prepared, labels, how = _growth(rows, trees, per_split, seed, depth)

    def told(grown, x: np.ndarray, y: np.ndarray) -> pa.Table:
        made = [(number, *[tree[c].tobytes() for c in _KINDS]) for number, tree, _ in grown]
        return pa.table([pa.array(c, k) for c, k in zip(zip(*made, strict=True), (pa.int32(), *[pa.binary()] * len(_KINDS)), strict=True)], names=["tree", *_KINDS])

    found = _over_trees(prepared, how, told, "tree int, " + ", ".join(f"{c} binary" for c in _KINDS)).collect()
    made = [{c: np.frombuffer(r[c], k) for c, k in _KINDS.items()} for r in sorted(found, key=lambda r: r["tree"])]
    widest = max((len(t["child"]) for t in made), default=1)
    arrays = [np.full((trees, widest), -1 if c == "feature" else 0, k) for c, k in _KINDS.items()]
    for i, tree in enumerate(made):
        for out, c in zip(arrays, _KINDS, strict=True):
            out[i, : len(tree[c])] = tree[c]
    return Forest(*arrays, labels, prepared)


def votes(forest: Forest) -> DataFrame:
    """(id, label, votes, predicted): the out-of-bag votes for each class, and the class with most of them (ties to the
    first one in the alphabet); a sample that every tree has drawn has no votes and a null prediction."""
    kind = forest.prepared.schema["id"].dataType.simpleString()
    sent = forest.prepared.sparkSession.sparkContext.broadcast(forest._replace(prepared=None))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = sent.value
        for batch in batches:
            for first in range(0, batch.num_rows, _ROWS):
                part = batch.slice(first, _ROWS)
                h, x = _arrays(part, 2, 3)
                out = _weights(h, len(own.feature)) == 0
                winner = own.winner[np.arange(len(own.feature))[None, :], own.leaves(x)]
                count = np.stack([(out & (winner == c)).sum(axis=1) for c in range(len(own.labels))], axis=1)
                best = [own.labels[i] if n else None for i, n in zip(count.argmax(axis=1), count.sum(axis=1), strict=True)]
                yield pa.RecordBatch.from_arrays([*part.columns[:2], pa.array(count.tolist(), pa.list_(pa.int64())), pa.array(best, pa.string())], names=["id", "label", "votes", "predicted"])

    return forest.prepared.select("id", "label", "h", "x").mapInArrow(run, f"id {kind}, label string, votes array<long>, predicted string")


def _blocks_of(n: int) -> list[tuple[int, int]]:
    return [(first, min(first + _ROWS, n)) for first in range(0, n, _ROWS)]


def random_forest(rows: DataFrame, trees: int = 500, per_split: int = 7, seed: int = 1, depth: int = DEPTH) -> DataFrame:
    """Out-of-bag confusion table (label, predicted, n): a sample is judged by the trees whose bootstrap left it out.

    Tasks count the votes of the trees they grow; the counts of a block of samples are added up over the tasks.
    """
    prepared, labels, how = _growth(rows, trees, per_split, seed, depth)

    def judged(grown, x: np.ndarray, y: np.ndarray) -> pa.Table:
        count = np.zeros((len(x), max(1, how.n_classes)), np.int32)
        for _, tree, w in grown:
            out = np.flatnonzero(w == 0)
            count[out, tree["winner"][_ends(tree, x[out])]] += 1
        blocks = _blocks_of(len(x))
        parts = [[a for a, _ in blocks], [y[a:b].astype(np.int32).tobytes() for a, b in blocks], [count[a:b].tobytes() for a, b in blocks]]
        return pa.table([pa.array(c, k) for c, k in zip(parts, (pa.int64(), pa.binary(), pa.binary()), strict=True)], names=["block", "y", "votes"])

    def summed(table: pa.Table) -> pa.Table:
        count = sum(np.frombuffer(v, np.int32).reshape(-1, max(1, how.n_classes)) for v in table["votes"].to_pylist())
        y = np.frombuffer(table["y"][0].as_py(), np.int32)
        some = count.any(axis=1)
        pairs, n = np.unique(np.stack([y[some], count[some].argmax(axis=1)], axis=1), axis=0, return_counts=True)
        return pa.table([pa.array([labels[i] for i in pairs[:, k]], pa.string()) for k in (0, 1)] + [pa.array(n.astype(np.int64))], names=["label", "predicted", "n"])

    votes_of = _over_trees(prepared, how, judged, "block long, y binary, votes binary")
    found = votes_of.groupBy("block").applyInArrow(summed, "label string, predicted string, n long")
    return found.groupBy("label", "predicted").agg(F.sum("n").alias("n"))


def rf_importance(rows: DataFrame, trees: int = 500, per_split: int = 7, seed: int = 1, depth: int = DEPTH) -> DataFrame:
    """Importance per feature position: the Gini decrease of its splits in all trees, summing to one."""
    prepared, _, how = _growth(rows, trees, per_split, seed, depth)

    def decreased(grown, x: np.ndarray, y: np.ndarray) -> pa.Table:
        total, first = np.zeros(how.n_features), None
        for number, tree, _ in grown:
            inner = tree["feature"] >= 0
            total += np.bincount(tree["feature"][inner], weights=tree["decrease"][inner], minlength=how.n_features)
            first = number if first is None else first
        return pa.table([pa.array([first], pa.int32()), pa.array([total.tolist()], pa.list_(pa.float64()))], names=["tree", "total"])

    # a number for each task and feature
    found = sorted(_over_trees(prepared, how, decreased, "tree int, total array<double>").collect())
    total = np.sum([r["total"] for r in found], axis=0) if found else np.zeros(how.n_features)
    values = (total / max(total.sum(), 1e-300)).tolist()
    return rows.sparkSession.createDataFrame(list(enumerate(values)), "feature int, importance double")


_WIDE, _LEAST = 1 << 14, 4  # samples of a class that one of its groups has at most, and groups that a large class has at least


def rf_outlier(rows: DataFrame, trees: int = 500, per_split: int = 7, seed: int = 1, depth: int = DEPTH) -> DataFrame:
    """Outlier score: samples / sum of squared proximities within the class, centred and scaled per class.

    The proximity of two samples is their share of common leaves. A class is cut into few groups of samples, and every pair of
    groups is compared by one task and gives a sum per sample; no pair of samples is a row.
    """
    prepared, _, how = _growth(rows, trees, per_split, seed, depth)
    kind = rows.schema["id"].dataType.simpleString()

    def reached(grown, x: np.ndarray, y: np.ndarray) -> pa.Table:
        parts = [(number, _ends(tree, x).astype(np.int32)) for number, tree, _ in grown]
        numbers = [number for number, _ in parts]
        ends = np.stack([e for _, e in parts], axis=1)
        blocks = _blocks_of(len(x))
        return pa.table([pa.array([a for a, _ in blocks], pa.int64()), pa.array([numbers] * len(blocks), pa.list_(pa.int32())), pa.array([ends[a:b].tobytes() for a, b in blocks], pa.binary())], names=["block", "trees", "ends"])

    def gathered(table: pa.Table) -> pa.Table:
        numbers = np.concatenate([np.array(n) for n in table["trees"].to_pylist()])
        ends = np.concatenate([np.frombuffer(e, np.int32).reshape(-1, len(n)) for e, n in zip(table["ends"].to_pylist(), table["trees"].to_pylist(), strict=True)], axis=1)
        ends = ends[:, np.argsort(numbers)]
        return pa.table([pa.array(table["block"][0].as_py() + np.arange(len(ends))), pa.array([e.tobytes() for e in ends], pa.binary())], names=["_at", "_l"])

    told = _over_trees(prepared, how, reached, "block long, trees array<int>, ends binary").groupBy("block").applyInArrow(gathered, "_at long, _l binary")
    # the places in the order of the rows; the numbers of the rows have gaps, one for each task that wrote them
    tasks = prepared.groupBy(F.shiftright("row", 33).alias("_task")).agg(F.count(F.lit(1)).alias("n")).orderBy("_task").collect()
    before = np.append(0, np.cumsum([r["n"] for r in tasks])).tolist()
    starts = rows.sparkSession.createDataFrame([(r["_task"], b) for r, b in zip(tasks, before, strict=False)], "_task long, _before long")
    placed = prepared.select("id", "label", "row").join(F.broadcast(starts), F.shiftright("row", 33) == F.col("_task"))
    placed = placed.select("id", "label", (F.col("_before") + F.col("row").bitwiseAND((1 << 33) - 1)).alias("_at"))
    leaves = stage(told.join(placed, "_at").select("id", "label", "_l"))
    n = F.count(F.lit(1))
    counts = leaves.groupBy("label").agg(F.least(F.ceil(n / _BLOCK), F.greatest(F.lit(_LEAST), F.ceil(n / _WIDE))).alias("_blocks"))
    dealt = leaves.join(counts, "label").withColumn("_block", F.pmod(F.xxhash64("id"), "_blocks"))
    left = dealt.withColumn("_other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_blocks") - 1))).drop("_blocks")
    # new names for the other side's columns, as both sides come from one table
    right = dealt.select(*[F.col(c).alias(f"{c}_") for c in dealt.columns])
    right = right.withColumn("_from", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_blocks_") - 1)))
    kinds = dict(rows.dtypes)

    def sums(own: pd.DataFrame, others: pd.DataFrame) -> pd.DataFrame:
        a, b = (np.frombuffer(b"".join(x), np.int32).reshape(-1, trees) for x in (own["_l"], others["_l_"]))
        total = np.zeros(len(a))
        for first in range(0, len(b), _BLOCK):
            part = b[first : first + _BLOCK]
            total += [float(((np.count_nonzero(row[None, :] == part, axis=1) / trees) ** 2).sum()) for row in a]
        return pd.DataFrame({"id": own["id"], "label": own["label"], "_part": total})

    parts = left.groupBy("label", "_block", "_other").cogroup(right.groupBy("label_", "_from", "_block_")).applyInPandas(sums, f"id {kinds['id']}, label string, _part double")
    total = prepared.agg(F.count(F.lit(1))).scalar()
    sized = parts.groupBy("id", "label").agg(F.sum("_part").alias("_s"))
    raw = stage(sized.withColumn("_raw", total / F.col("_s")).select("id", "label", "_raw"))
    medians = exact_quantiles(raw, ["label"], "_raw", {"_median": 0.5})
    spread = raw.join(medians, "label").withColumn("_dev", F.abs(F.col("_raw") - F.col("_median")))
    mads = exact_quantiles(spread, ["label"], "_dev", {"_mad": 0.5})
    score = F.try_divide(F.col("_raw") - F.col("_median"), F.col("_mad"))
    return spread.join(mads, "label").select("id", "label", score.alias("outlier"))
