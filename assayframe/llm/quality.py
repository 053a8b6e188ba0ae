"""Quality classifier: histogram gradient-boosted trees over document statistics.

The statistics of a text depend on the text alone. The trees are grown on a sample of labelled rows of at most
``train_rows`` (documented bound; the rows with the smallest id hashes) with logistic loss on binned statistics, and kept
as flat arrays that numpy walks for all rows and trees at once.

Null and empty texts get the score of their all-zero statistics. Labels that are null, or of ids without a document, do
not count; of several labels of one id the smallest counts, of repeated documents each row. With no label at all, or
only one class, every score is the share of that class (0.5 without labels).
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from . import texts

TRAIN_ROWS = 20_000
TREES, DEPTH, BINS, RATE, LEAST, PENALTY = 60, 4, 48, 0.2, 8.0, 1.0

FEATURES = (
    "log_bytes", "log_words", "word_length", "longest_word", "short_words", "long_words", "upper", "digits", "marks", "symbols",
    "pipes", "exclamations", "non_ascii", "blanks", "capitalised", "distinct_words", "commonest_word", "doubled_words",
    "distinct_shingles", "log_lines", "line_length", "distinct_lines", "ended_lines", "stops",
)

_SYMBOL = np.isin(np.arange(256), [ord(c) for c in "#$%&*<>=~^{}[]\\"])
_STOP = np.isin(np.arange(256), [ord(c) for c in ".?!"])


def distinct_share(hashes: np.ndarray, of: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Per text: distinct hashes / hashes, and the share of the commonest one."""
    order = np.lexsort((hashes, of))
    h, t = hashes[order], of[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (t[1:] != t[:-1])
    at = np.flatnonzero(new)
    most = np.zeros(n)
    np.maximum.at(most, t[at], np.diff(np.append(at, len(h))))
    total = np.maximum(1, np.bincount(of, minlength=n))
    return np.bincount(t[at], minlength=n) / total, most / total


def statistics(t: texts.Texts) -> np.ndarray:
    """One row of ``FEATURES`` for each text of a slice."""
    n, data = len(t), t.data
    size = np.diff(t.bounds)
    least_one = np.maximum(1, size)

    def share(flag: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(flag)])
        return (sums[t.bounds[1:]] - sums[t.bounds[:-1]]) / least_one

    w = texts.words(t)
    of = w.text_of()
    length = w.end - w.start
    n_words = np.diff(w.bounds)
    some = np.maximum(1, n_words)

    def of_words(flag: np.ndarray) -> np.ndarray:
        return np.bincount(of, weights=flag, minlength=n) / some

    longest = np.zeros(n)
    np.maximum.at(longest, of, length)
    same = np.zeros(len(of), bool)
    same[1:] = (w.hash[1:] == w.hash[:-1]) & (of[1:] == of[:-1])
    words_distinct, commonest = distinct_share(w.hash, of, n)
    sh, sh_of = texts.shingles(w, 5)
    start, end = texts.runs(data != 10, t.bounds)
    line_of = np.searchsorted(t.bounds, start, "right") - 1
    n_lines = np.bincount(line_of, minlength=n)
    ended = _STOP[data[end - 1]]
    columns = [
        np.log1p(size), np.log1p(n_words), of_words(length), np.log1p(longest), of_words(length <= 3), of_words(length >= 12),
        share(texts.UPPER_CASE[data]), share(texts.DIGIT[data]), share(~texts.WORD[data] & ~texts.SPACE[data]), share(_SYMBOL[data]),
        share(data == 124), share(data == 33), share(data >= 128), share(texts.SPACE[data]), of_words(texts.UPPER_CASE[data[w.start]]),
        words_distinct, commonest, of_words(same), distinct_share(sh, sh_of, n)[0], np.log1p(n_lines), np.log1p(size / np.maximum(1, n_lines)),
        distinct_share(texts.range_hashes(data, start, end), line_of, n)[0], np.bincount(line_of, weights=ended, minlength=n) / np.maximum(1, n_lines),
        share(_STOP[data]),
    ]
    return np.stack(columns, axis=1).astype(np.float32)


class Trees(NamedTuple):
    """All trees as arrays (tree, node); the children of node i are 2 i + 1 (value <= threshold) and 2 i + 2."""

    feature: np.ndarray
    threshold: np.ndarray
    value: np.ndarray  # (tree, leaf)
    base: float
    depth: int

    def score(self, x: np.ndarray) -> np.ndarray:
        n_trees, inner = self.feature.shape
        node = np.zeros((len(x), n_trees), np.int64)
        feature, threshold = self.feature.ravel(), self.threshold.ravel()
        offset = np.arange(n_trees) * inner
        rows = np.arange(len(x))[:, None]
        for _ in range(self.depth):
            at = offset + node
            node = 2 * node + 1 + (x[rows, feature[at]] > threshold[at])
        total = self.base + self.value[np.arange(n_trees), node - inner].sum(axis=1)
        return 1 / (1 + np.exp(-total))


def grow(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH, bins: int = BINS, rate: float = RATE) -> Trees:
    """Boosted trees for labels 0 and 1; every split is chosen from histograms of gradients over the bins."""
    inner, leaves = (1 << depth) - 1, 1 << depth
    share = (y.sum() + 0.5) / (len(y) + 1) if len(y) else 0.5
    feature, threshold, value = np.zeros((trees, inner), np.int64), np.full((trees, inner), np.inf, np.float32), np.zeros((trees, leaves))
    if not len(y) or y.min() == y.max():
        return Trees(feature, threshold, value, float(np.log(share / (1 - share))), depth)
    n, width = x.shape
    edges = np.quantile(x, np.arange(1, bins) / bins, axis=0, method="lower")  # (bins - 1, features)
    binned = np.stack([np.searchsorted(np.unique(edges[:, f]), x[:, f], "left") for f in range(width)], axis=1)
    limits = [np.append(np.unique(edges[:, f]), np.float32(np.inf)) for f in range(width)]
    cell = binned + np.arange(width) * bins
    base = float(np.log(share / (1 - share)))
    total = np.full(n, base)
    for k in range(trees):
        p = 1 / (1 + np.exp(-total))
        g, h = p - y, p * (1 - p)
        node = np.zeros(n, np.int64)
        for level in range(depth):
            first, count = (1 << level) - 1, 1 << level
            at = ((node - first)[:, None] * (width * bins) + cell).ravel()
            shape = (count, width, bins)
            sum_g = np.bincount(at, np.repeat(g, width), count * width * bins).reshape(shape).cumsum(axis=2)
            sum_h = np.bincount(at, np.repeat(h, width), count * width * bins).reshape(shape).cumsum(axis=2)
            all_g, all_h = sum_g[:, :1, -1:], sum_h[:, :1, -1:]
            gain = sum_g**2 / (sum_h + PENALTY) + (all_g - sum_g) ** 2 / (all_h - sum_h + PENALTY) - all_g**2 / (all_h + PENALTY)
            gain[(sum_h < LEAST / 4) | (all_h - sum_h < LEAST / 4)] = 0
            best = gain.reshape(count, -1).argmax(axis=1)
            useful = gain.reshape(count, -1)[np.arange(count), best] > 1e-9
            for i in range(count):
                if useful[i]:
                    f, b = divmod(int(best[i]), bins)
                    feature[k, first + i], threshold[k, first + i] = f, limits[f][min(b, len(limits[f]) - 1)]
            node = 2 * node + 1 + (x[np.arange(n), feature[k, node]] > threshold[k, node])
        leaf = node - inner
        value[k] = -rate * np.bincount(leaf, g, leaves) / (np.bincount(leaf, h, leaves) + PENALTY)
        total += value[k, leaf]
    return Trees(feature, threshold, value, base, depth)


def held_out(id_col: Column) -> Column:
    """Whether a row is kept from training: crc32 of the id as text, modulo 5, is 0."""
    return F.crc32(id_col.cast("string").cast("binary")) % 5 == 0


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text", label: str = "quality", train_rows: int = TRAIN_ROWS) -> Trees:
    """Trees grown on at most ``train_rows`` labelled rows that are not held out."""
    known = labels.filter(labels[id_col].isNotNull() & labels[label].isin(0, 1) & ~held_out(labels[id_col]))
    known = known.groupBy(F.col(id_col).alias("_id")).agg(F.min(label).cast("double").alias("_y"))
    chosen = known.orderBy(F.xxhash64("_id"), "_id").limit(train_rows)
    # at most train_rows ids and labels: the bound that allows the broadcast
    rows = docs.select(docs[id_col].alias("_id"), docs[text].alias("_text")).join(F.broadcast(chosen), "_id").select("_id", "_text", "_y")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for t in texts.slices(batch.column(1)):
                x = statistics(t)
                part = batch.slice(t.first, len(t))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(2), pa.array(list(x), pa.list_(pa.float32()))], names=["id", "y", "x"])

    kind = docs.schema[id_col].dataType.simpleString()
    sample = rows.mapInArrow(run, f"id {kind}, y double, x array<float>").orderBy(F.xxhash64("id"), "id").limit(train_rows).toArrow()
    x = np.array(sample.column("x").to_pylist(), np.float32).reshape(-1, len(FEATURES))
    return grow(x, sample.column("y").to_numpy())


def score(docs: DataFrame, trees: Trees, text: str = "text", cut: float = 0.3, columns: tuple[str, ...] | None = None) -> DataFrame:
    """The columns (all, or ``columns``) with score and predicted (1 if score >= cut); those of these names are replaced."""
    names = [c for c in (docs.columns if columns is None else columns) if c not in ("score", "predicted")]
    chosen = docs.select(*names, docs[text].alias("_text_to_score"))
    schema = chosen.select(*names).schema.add("score", "double").add("predicted", "integer")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            s = np.concatenate([trees.score(statistics(t)) for t in texts.slices(batch.column(len(names)))] or [np.zeros(0)])
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(names)], pa.array(s), pa.array((s >= cut).astype(np.int32))], names=schema.names)

    return chosen.mapInArrow(run, schema)
