"""Toxicity: a convolutional text classifier in numpy, with thresholds calibrated by language.

A word's embedding is the sum of rows of one hashed table: those of the word itself and of its first and last bytes
(``AFFIXES``), so that words of one stem share most of it. Filters of several widths run over the words of a text; the
largest value of each filter, cut at 0, enters a logistic output whose weights are at least 0: a text is toxic by what it
holds, and no other words make up for it. All parameters are trained by Adagrad on the log loss.

The network is fitted on the driver to a bounded sample: at most ``train_rows`` labelled rows, half of them toxic where
there are as many, of at most ``train_bytes`` bytes each (longer ones are not trained on). Every text is scored whole: the
largest values of the parts of a long text are merged. Table rows that no training text touched are zero.

``calibrate`` chooses a threshold for each language on all labelled rows that neither training nor the held-out fold uses: the
middle of the best gap by the F-measure, half of the way to the default where a language has few rows of a class. Scores
never depend on the language.

Null, empty and wordless texts have the score of the bias alone. Labels that are null, other than 0 and 1, or of ids
without a document do not count; of several labels of one id the smallest counts, of repeated documents each row. Without
any label, or with one class only, every score is the share of that class (0.5 without labels). Null ids may be scored,
not learnt from. An empty table gives no rows. Columns named like a result column are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ..operators.ordered import running
from . import folders, texts

TRAIN_ROWS, TRAIN_BYTES = 8_000, 1 << 15
BUCKETS, WIDTH, FILTERS, SPANS = 1 << 15, 12, 16, (1, 2, 3)
EPOCHS, BATCH, RATE, DECAY = 6, 32, 0.1, 1e-4
#: Bytes at the start and at the end of a word that have rows of their own, where the word is longer.
AFFIXES = (4, 6)
#: Slices for scoring are smaller than others: a word's features and filter values take some 300 bytes.
SLICE_BYTES = 1 << 18
PLAIN_CUT = 0.5
LEAST = 20  # rows of each class that a threshold of its own needs
_SOME = 1 << 16  # words whose table rows are marked at a time
#: Table rows on their way to the driver and there: BUCKETS of them fit into two bytes.
_ROW = np.dtype(np.int16)


def features(t: texts.Texts) -> tuple[np.ndarray, np.ndarray]:
    """Table rows (words, 1 + 2 * affixes) and the word bounds of the texts; a word too short for an affix has row 0 there."""
    w = texts.words(t)
    data = texts.LOWER[t.data]
    mask = np.uint64(BUCKETS - 1)
    columns = [(w.hash & mask) | np.uint64(1)]
    for k in AFFIXES:
        longer = w.end - w.start > k
        for start, end, salt in ((w.start, np.minimum(w.start + k, w.end), 2 * k), (np.maximum(w.end - k, w.start), w.end, 2 * k + 1)):
            h = texts.mix(texts.range_hashes(data, start, end) + np.uint64(salt)) & mask | np.uint64(1)
            columns.append(np.where(longer, h, np.uint64(0)))
    return np.stack(columns, axis=1).astype(np.int32), w.bounds


class Network(NamedTuple):
    """table (buckets, width), whose row 0 is zero; a kernel (span * width, filters) and its bias for every span; the output."""

    table: np.ndarray
    kernels: list[np.ndarray]
    shifts: list[np.ndarray]
    out: np.ndarray
    bias: float

    def embedded(self, rows: np.ndarray) -> np.ndarray:
        out = self.table[rows[:, 0]]
        for k in range(1, rows.shape[1]):
            out += self.table[rows[:, k]]
        return out

    def filtered(self, e: np.ndarray, span: int) -> np.ndarray:
        """The filters' values where a window starts; windows reach beyond the last word, where there is nothing."""
        k = self.kernels[SPANS.index(span)]
        out = e @ k[: self.table.shape[1]]
        for j in range(1, span):
            out[:-j] += e[j:] @ k[j * self.table.shape[1] : (j + 1) * self.table.shape[1]]
        return out

    def pooled(self, rows: np.ndarray, bounds: np.ndarray, beyond: int = 0) -> tuple[np.ndarray, tuple[list[np.ndarray], np.ndarray, int]]:
        """Largest values (texts, all filters), at least 0; and the values by width, the texts' starts in them, and the padding.

        ``SPANS[-1] - 1`` empty words are put behind each text, so that no window crosses into the next one. Windows start
        at every word, but for the last ``beyond`` ones of all.
        """
        n, pad = len(bounds) - 1, SPANS[-1] - 1
        at = np.arange(len(rows)) + pad * np.repeat(np.arange(n), np.diff(bounds))
        spread = np.zeros((len(rows) + pad * n, self.table.shape[1]), np.float32)
        spread[at] = self.embedded(rows)
        starts = bounds[:-1] + pad * np.arange(n)
        empty = np.ones(len(spread), bool)
        empty[at[: len(at) - beyond]] = False
        values, places = [], []
        for span, shift in zip(SPANS, self.shifts, strict=True):
            out = self.filtered(spread, span) + shift
            out[empty] = -np.inf
            top = np.maximum.reduceat(out, starts, axis=0) if n else np.zeros((0, len(shift)), np.float32)
            values.append(top)
            places.append(out)
        top = np.concatenate(values, axis=1)
        return np.where((np.diff(bounds) > 0)[:, None], np.maximum(top, 0), 0), (places, starts, pad)

    def score(self, pooled: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-(pooled @ self.out + self.bias).astype(np.float64)))


def constant(share: float) -> Network:
    return Network(
        np.zeros((BUCKETS, WIDTH), np.float32),
        [np.zeros((s * WIDTH, FILTERS), np.float32) for s in SPANS],
        [np.zeros(FILTERS, np.float32) for _ in SPANS],
        np.zeros(FILTERS * len(SPANS), np.float32),
        float(np.log(share / (1 - share))),
    )


def fit(rows: np.ndarray, bounds: np.ndarray, y: np.ndarray, epochs: int = EPOCHS, seed: int = 1) -> Network:
    """Train on texts given by the table rows of their words; classes are weighted to equal sums."""
    share = float((y.sum() + 0.5) / (len(y) + 1)) if len(y) else 0.5
    if not len(y) or y.min() == y.max():
        return constant(share)
    rng = np.random.default_rng(seed)
    table = rng.normal(0, 0.05, (BUCKETS, WIDTH)).astype(np.float32)
    table[0] = 0
    net = Network(table, [rng.normal(0, 0.3, (s * WIDTH, FILTERS)).astype(np.float32) for s in SPANS], [np.zeros(FILTERS, np.float32) for _ in SPANS], np.abs(rng.normal(0, 0.3, FILTERS * len(SPANS))).astype(np.float32), 0.0)
    weight = np.where(y == 1, len(y) / (2 * y.sum()), len(y) / (2 * (len(y) - y.sum())))
    bias, bias_sum = -1.0, 1e-6
    sums = {"table": np.full(BUCKETS, 1e-6, np.float32), "out": np.full(len(net.out), 1e-6)}
    sums |= {("k", i): np.full(k.shape, 1e-6, np.float32) for i, k in enumerate(net.kernels)} | {("s", i): np.full(s.shape, 1e-6, np.float32) for i, s in enumerate(net.shifts)}

    def move(x: np.ndarray, name: object, g: np.ndarray) -> None:
        sums[name] += g * g
        x -= RATE * g / np.sqrt(sums[name])

    for _ in range(epochs):
        order = rng.permutation(len(y))
        for first in range(0, len(order), BATCH):
            some = order[first : first + BATCH]
            lengths = bounds[some + 1] - bounds[some]
            own = np.concatenate([[0], np.cumsum(lengths)])
            words = rows[np.repeat(bounds[some] - own[:-1], lengths) + np.arange(own[-1])]
            net = net._replace(bias=bias)
            pooled, (places, starts, pad) = net.pooled(words, own)
            p = net.score(pooled)
            slope = ((p - y[some]) * weight[some] / len(some)).astype(np.float32)
            back = slope[:, None] * net.out * (pooled > 0)
            move(net.out, "out", pooled.T @ slope + DECAY * net.out)
            np.maximum(net.out, 0, out=net.out)
            g = float(slope.sum())
            bias_sum += g * g
            bias -= RATE * g / bias_sum**0.5
            ends = starts + lengths + pad
            touched, grads = [], []
            for i, span in enumerate(SPANS):
                part = back[:, i * FILTERS : (i + 1) * FILTERS]
                text, column = np.nonzero(part)
                if not len(text):
                    continue
                out = places[i]
                # the first window of the largest value
                at = np.array([starts[a] + int(out[starts[a] : ends[a], b].argmax()) for a, b in zip(text.tolist(), column.tolist(), strict=True)])
                value = part[text, column]
                kernel = np.zeros_like(net.kernels[i])
                for j in range(span):
                    word = at + j - pad * text  # without the empty words
                    inside = at + j < starts[text] + lengths[text]
                    ids = words[word[inside]]
                    lo = j * WIDTH
                    e = net.embedded(ids)
                    np.add.at(kernel.T, (column[inside], slice(lo, lo + WIDTH)), e * value[inside, None])
                    d = value[inside, None] * net.kernels[i][lo : lo + WIDTH, column[inside]].T
                    touched.append(ids.ravel())
                    grads.append(np.repeat(d, ids.shape[1], axis=0))
                shift = np.bincount(column, weights=value, minlength=FILTERS).astype(np.float32)
                move(net.kernels[i], ("k", i), kernel + DECAY * net.kernels[i])
                move(net.shifts[i], ("s", i), shift)
            if touched:
                ids, place = np.unique(np.concatenate(touched), return_inverse=True)
                total = np.zeros((len(ids), WIDTH), np.float32)
                np.add.at(total, place, np.concatenate(grads))
                total[ids == 0] = 0
                sums["table"][ids] += (total * total).mean(axis=1)
                net.table[ids] -= RATE * total / np.sqrt(sums["table"][ids])[:, None]
    used = np.zeros(BUCKETS, bool)
    for first in range(0, len(rows), _SOME):  # no copy of all rows
        used[rows[first : first + _SOME]] = True
    net.table[~used] = 0
    return net._replace(bias=bias)


def fold(id_col: Column) -> Column:
    """crc32 of the id as text, modulo 5: 0 is held out, 1 calibrates, the others train."""
    return F.crc32(id_col.cast("string").cast("binary")) % 5


def known(labels: DataFrame, id_col: str, label: str, folds: tuple[int, ...]) -> DataFrame:
    """(_id, _y) of the labelled ids in some folds."""
    rows = labels.filter(labels[id_col].isNotNull() & labels[label].isin(0, 1) & fold(labels[id_col]).isin(*folds))
    return rows.groupBy(F.col(id_col).alias("_id")).agg(F.min(label).cast("int").alias("_y"))


def sampled(rows: DataFrame, most: int) -> DataFrame:
    """At most ``most`` rows: half of them of class 1 where there are as many, those with the smallest id hashes."""
    ones = rows.filter("_y = 1").orderBy(F.xxhash64("_id"), "_id").limit(most // 2)
    zeros = rows.filter("_y = 0").orderBy(F.xxhash64("_id"), "_id").limit(most - most // 2)
    return ones.unionByName(zeros)


def train(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text", label: str = "toxic", train_rows: int = TRAIN_ROWS, train_bytes: int = TRAIN_BYTES
) -> Network:
    """The network fitted to at most ``train_rows`` labelled rows of folds 2 to 4."""
    # at most train_rows ids and labels: the bound that allows the broadcast
    chosen = sampled(known(labels, id_col, label, (2, 3, 4)), train_rows)
    rows = docs.select(docs[id_col].alias("_id"), docs[text].alias("_text")).filter(F.octet_length(F.coalesce("_text", F.lit(""))) <= train_bytes)
    rows = rows.join(F.broadcast(chosen), "_id").select("_id", "_text", "_y")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for t in texts.slices(batch.column(1), SLICE_BYTES):
                x, bounds = features(t)
                part = batch.slice(t.first, len(t))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(2), pa.array([x[a:b].astype(_ROW).tobytes() for a, b in zip(bounds[:-1], bounds[1:], strict=True)], pa.binary())], names=["_id", "_y", "x"])

    kind = docs.schema[id_col].dataType.simpleString()
    found = rows.mapInArrow(run, f"_id {kind}, _y int, x binary").orderBy(F.xxhash64("_id"), "_id", "x").limit(train_rows).toArrow()
    y = found.column("_y").to_numpy()
    words, bounds = _words(found.column("x"))
    del found  # the driver keeps one copy of the words while it trains
    return fit(words, bounds, y)


def _words(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Table rows of the words of all texts, copied once, and the bounds of the texts."""
    wide = 1 + 2 * len(AFFIXES)
    parts, lengths = [np.zeros(0, _ROW)], [np.zeros(1, np.int64)]
    for chunk in column.chunks:
        at = np.frombuffer(chunk.buffers()[1], np.int32)[chunk.offset : chunk.offset + len(chunk) + 1].astype(np.int64)
        if len(chunk) and at[-1] > at[0]:
            parts.append(np.frombuffer(chunk.buffers()[2], _ROW, (at[-1] - at[0]) // _ROW.itemsize, at[0]))
        lengths.append(np.diff(at) // (wide * _ROW.itemsize))
    return np.concatenate(parts).reshape(-1, wide), np.cumsum(np.concatenate(lengths))


def _slice_scores(net: Network, column: pa.Array) -> np.ndarray:
    """Scores of a column of texts; a long text is cut at spaces into overlapping parts, whose largest values are merged."""
    out = []
    for t in texts.slices(column, SLICE_BYTES):
        x, bounds = features(t)
        if len(t) > 1 or len(x) <= SLICE_BYTES:
            pooled, _ = net.pooled(x, bounds)
        else:
            pooled = np.zeros((1, FILTERS * len(SPANS)), np.float32)
            for first in range(0, len(x), SLICE_BYTES):
                part = x[first : first + SLICE_BYTES + SPANS[-1] - 1]
                pooled = np.maximum(pooled, net.pooled(part, np.array([0, len(part)]), max(0, len(part) - SLICE_BYTES))[0])
        out.append(net.score(pooled))
    return np.concatenate(out or [np.zeros(0)])


def score(docs: DataFrame, net: Network, text: str = "text", cut: float = PLAIN_CUT, columns: tuple[str, ...] | None = None) -> DataFrame:
    """The columns (all, or ``columns``) with score and predicted (1 if score >= cut); those of these names are replaced."""
    names = [c for c in (docs.columns if columns is None else columns) if c not in ("score", "predicted")]
    chosen = docs.select(*names, docs[text].alias("_text_to_score"))
    schema = chosen.select(*names).schema.add("score", "double").add("predicted", "integer")
    sent = docs.sparkSession.sparkContext.broadcast(net)  # BUCKETS * WIDTH numbers, whatever the data

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            s = _slice_scores(sent.value, batch.column(len(names)))
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(names)], pa.array(s), pa.array((s >= cut).astype(np.int32))], names=schema.names)

    return chosen.mapInArrow(run, schema)


def threshold(scores: np.ndarray, y: np.ndarray, least: int = LEAST) -> float:
    """The cut of the best F-measure, in the middle of the gap below it; drawn to ``PLAIN_CUT`` by few rows of a class."""
    few = min(int(y.sum()), int(len(y) - y.sum()))
    if few == 0:
        return PLAIN_CUT
    order = np.argsort(-scores, kind="stable")
    s, hits = scores[order], np.cumsum(y[order])
    measure = 2 * hits / (np.arange(1, len(y) + 1) + y.sum())
    measure[:-1][s[:-1] == s[1:]] = -1  # a cut stands between different scores
    best = int(measure.argmax())
    cut = (s[best] + (s[best + 1] if best + 1 < len(s) else 0)) / 2
    return drawn_cut(cut, few, least)


def drawn_cut(cut: float, few: int, least: int = LEAST) -> float:
    """A cut drawn to ``PLAIN_CUT`` where a class has fewer than ``least`` rows."""
    trust = min(1.0, few / least)
    return float(trust * cut + (1 - trust) * PLAIN_CUT)


def calibrate(docs: DataFrame, labels: DataFrame, net: Network, id_col: str = "doc_id", text: str = "text", lang: str = "lang", label: str = "toxic") -> dict[str | None, float]:
    """The :func:`threshold` of each language over all labelled rows of fold 1; a language without any has ``PLAIN_CUT``.

    The rows are counted by language and score; only the thresholds reach the driver.
    """
    chosen = known(labels, id_col, label, (1,))
    found = docs.select(docs[id_col].alias("_id"), docs[text].alias("_text"), docs[lang].alias("_lang")).join(chosen, "_id")
    scored = score(found.select("_lang", "_y", "_text"), net, "_text", columns=("_lang", "_y"))
    # a key that is never null
    key = F.when(F.col("_lang").isNull(), "").otherwise(F.concat(F.lit("="), F.col("_lang")))
    counted = folders.save(scored.groupBy(key.alias("_key"), "_lang", "score").agg(F.count(F.lit(1)).alias("n"), F.sum("_y").alias("ones")), "toxicity-scores")

    def at_least(column: str, out: str) -> DataFrame:
        summed = running(counted.select("_key", "score", F.col(column).alias("n")), ["_key"], "score")
        return summed.select("_key", "score", (F.col("total") - F.col("below")).alias(out), F.col("total").alias(f"all_{out}"))

    each = at_least("n", "rows").join(at_least("ones", "hits"), ["_key", "score"])
    measure = 2 * F.col("hits") / (F.col("rows") + F.col("all_hits"))
    best = each.groupBy("_key").agg(F.max(F.struct(measure.alias("m"), "score"))["score"].alias("best"), F.max("all_rows").alias("rows"), F.max("all_hits").alias("ones"))
    lower = counted.join(best.select("_key", "best"), "_key").groupBy("_key").agg(F.min("_lang").alias("_lang"), F.max(F.when(F.col("score") < F.col("best"), F.col("score"))).alias("lower"))
    table = best.join(lower, "_key").collect()  # a row for each language
    return {r["_lang"]: drawn_cut((r["best"] + (r["lower"] or 0)) / 2, min(r["ones"], r["rows"] - r["ones"])) for r in table}


def flag(scored: DataFrame, cuts: dict[str | None, float], lang: str = "lang") -> DataFrame:
    """Scored rows with threshold (of their language) and flagged (score >= threshold)."""
    cut = F.lit(PLAIN_CUT)
    for name, value in sorted(cuts.items(), key=lambda x: (x[0] is None, x[0] or "")):
        cut = F.when(F.col(lang).eqNullSafe(F.lit(name)), F.lit(value)).otherwise(cut)
    return scored.withColumn("threshold", cut).withColumn("flagged", F.col("score") >= F.col("threshold"))
