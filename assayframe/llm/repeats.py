"""Repeated passages by a sparse suffix array.

Of all suffixes (a text from some word on) only those at minimisers are kept: in every ``window`` consecutive runs of
``GRAM`` words the run with the smallest hash marks its first word, so equal passages mark equal places. A passage of
``length`` words has a marked word among its first ``window`` ones, hence two occurrences share the suffix's next
``length - window + 1`` words, its key. The suffixes are sorted by key and what follows, and every suffix is compared
with its neighbours from other documents in that order and extended left and right from there, to the ends of its context
(the next marked words take it on).

Step 1 sorts keys alone and keeps the suffixes whose key stands next to itself. Step 2 gives those the word hashes around
them (24 bits a word; the key has 64), sorts again and extends. The longest common continuation always is with a
neighbour; the most words in both directions together need not be, so where a match ends inside a context, the suffixes of
that key compare all windows of ``length`` words around them, by hash. The tables are dealt by ranges of (key, document,
place), so a key with very many suffixes is spread over tasks; the groups cut by a task's borders are compared by windows
over all tasks. Nothing is sampled or capped.

Passages are compared across documents; a document is an (id, text), repeated rows are one. Null texts are empty, null ids
allowed. Texts of fewer than ``length`` words have no passages.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from . import folders, texts

GRAM = 5
LENGTH = 50


def window_of(length: int) -> int:
    """Runs of words in a minimiser window: about half the passage, so that the key has the other half."""
    if length < 2 * GRAM:
        raise ValueError(f"passages have at least {2 * GRAM} words")
    return min(length // 2 + 1, length - GRAM + 1)


def minimisers(w: texts.Words, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Index of every marked word and its text."""
    n = len(w.hash) - GRAM + 1
    if n < window:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    power, _ = texts.powers(GRAM)
    gram = np.zeros(n, np.uint64)
    for j in range(GRAM):
        gram += w.hash[j : j + n] * power[j]
    # the upper half of the hash, then the place: the leftmost of equal ones is the smallest
    least = (texts.mix(gram) >> np.uint64(32) << np.uint64(32)) | np.arange(n, dtype=np.uint64)
    span = 1
    while span < window:
        step = min(span, window - span)
        least = np.minimum(least[:-step], least[step:])
        span += step
    of = w.text_of()
    whole = of[: len(least)] == of[len(of) - len(least) :]  # the window's words are of one text
    marked = np.zeros(len(w.hash), bool)
    marked[(least[whole] & np.uint64(0xFFFFFFFF)).astype(np.int64)] = True
    at = np.flatnonzero(marked)
    return at, of[at]


def suffixes(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """From (id, h, text) to (id, h, key, pos) for all marked words with enough words behind them."""
    window = window_of(length)
    ahead = length - window + 1
    for batch in batches:
        for t in texts.slices(batch.column(2)):
            w = texts.words(t)
            at, of = minimisers(w, window)
            some = at + ahead <= w.bounds[of + 1]
            at, of = at[some], of[some]
            key = texts.sequence_hashes(w.hash, at, at + ahead)
            rows = pa.array(t.first + of)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(rows), batch.column(1).take(rows), pa.array(texts.longs(key)), pa.array((at - w.bounds[of]).astype(np.int32))],
                names=["id", "h", "key", "pos"],
            )


def together(batches: Iterator[pa.RecordBatch]) -> pa.Table | None:
    """A task's share, which the ranges keep to the size of a shuffle partition."""
    found = list(batches)
    return pa.Table.from_batches(found).combine_chunks() if found else None


def numbers(table: pa.Table, name: str) -> np.ndarray:
    return table.column(name).to_numpy()


def next_to_itself(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The suffixes whose key occurs again in the task, and those of the first and last key, which may go on elsewhere."""
    table = together(batches)
    if table is None or not table.num_rows:
        return
    key = numbers(table, "key")
    order = np.argsort(key, kind="stable")
    key = key[order]
    stays = np.zeros(len(key), bool)
    stays[1:] = key[1:] == key[:-1]
    stays[:-1] |= stays[1:]
    stays |= (key == key[0]) | (key == key[-1])
    yield from table.take(pa.array(order[stays])).to_batches()


def around(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """From (id, h, text, at) to (id, h, key, pos, left, right, words): the word hashes around the places ``at``, 24 bits each."""
    window = window_of(length)
    # a match that reaches the next marked word is taken on from there
    ahead, before, behind = length - window + 1, window - 1, length + 1
    for batch in batches:
        for t in texts.slices(batch.column(2)):
            w = texts.words(t)
            places = batch.column(3).slice(t.first, len(t))
            pos = places.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            of = np.repeat(np.arange(len(t)), places.value_lengths().to_numpy(zero_copy_only=False))
            at = w.bounds[of] + pos
            word = np.concatenate([np.zeros(before, np.uint32), (w.hash >> np.uint64(32)).astype(np.uint32), np.zeros(behind, np.uint32)])
            left = np.minimum(pos, before)
            right = np.minimum(w.bounds[of + 1] - at, behind)
            key = texts.sequence_hashes(w.hash, at, at + ahead)
            rows = pa.array(t.first + of)
            for i in range(0, len(at), 4096):
                some = slice(i, i + 4096)
                context = word[at[some, None] + np.arange(before + behind)[None, :]]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(rows[some]),
                        batch.column(1).take(rows[some]),
                        pa.array(texts.longs(key[some])),
                        pa.array(pos[some].astype(np.int32)),
                        pa.array(left[some].astype(np.int32)),
                        pa.array(right[some].astype(np.int32)),
                        pa.array([r.tobytes() for r in context.astype("<u4").view(np.uint8).reshape(len(context), -1, 4)[:, :, 1:]], pa.binary()),
                    ],
                    names=["id", "h", "key", "pos", "left", "right", "words"],
                )


def common(a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
    """How many leading columns of the rows are equal, at most ``most``."""
    differ = a != b
    return np.minimum(np.where(differ.any(axis=1), differ.argmax(axis=1), a.shape[1]), most)


def compare(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """Matched ranges of words (id, h, from, to, null), and the windows of the groups that may go on in another task
    (id, h, from, to, hash)."""
    table = together(batches)
    if table is None or not table.num_rows:
        return
    before = window_of(length) - 1
    key, pos, left, right = (numbers(table, c).astype(np.int64) for c in ("key", "pos", "left", "right"))
    three = np.frombuffer(b"".join(table.column("words").to_pylist()), np.uint8).reshape(len(key), -1, 3)
    words = three[:, :, 0].astype(np.uint32)
    for i in (1, 2):
        words |= three[:, :, i].astype(np.uint32) << np.uint32(8 * i)
    # documents of the task as numbers
    doc = table.select(["id", "h"]).to_pandas().groupby(["id", "h"], dropna=False, sort=False).ngroup().to_numpy()
    prefix = [hash_columns(words[:, before : before + n]) for n in (length, (length * 3) // 4)]
    order = np.lexsort((pos, doc, *prefix, key))
    key, pos, left, right, words, doc = key[order], pos[order], left[order], right[order], words[order], doc[order]
    n = len(key)
    index = np.arange(n)
    new_doc = np.ones(n, bool)
    new_doc[1:] = (key[1:] != key[:-1]) | (doc[1:] != doc[:-1])
    first_of_doc = np.maximum.accumulate(np.where(new_doc, index, 0))
    ends = np.append(np.flatnonzero(new_doc)[1:], n)
    after_doc = ends[np.cumsum(new_doc) - 1]
    low, high = pos.copy(), pos.copy()
    for other in (first_of_doc - 1, after_doc):
        there = (other >= 0) & (other < n)
        i = index[there]
        o = other[there]
        same = key[i] == key[o]
        i, o = i[same], o[same]
        for at in range(0, len(i), 1 << 14):
            a, b = i[at : at + (1 << 14)], o[at : at + (1 << 14)]
            r = common(words[a, before:], words[b, before:], np.minimum(right[a], right[b]))
            lft = common(words[a, :before][:, ::-1], words[b, :before][:, ::-1], np.minimum(left[a], left[b]))
            good = lft + r >= length
            np.minimum.at(low, a[good], pos[a[good]] - lft[good])
            np.maximum.at(high, a[good], pos[a[good]] + r[good])
    # groups with a suffix whose match ends inside its context: all windows of the length that hold its first word
    new_key = np.ones(n, bool)
    new_key[1:] = key[1:] != key[:-1]
    group = np.cumsum(new_key) - 1
    open_group = np.zeros(group[-1] + 1, bool)
    open_group[group[(low > pos - left) | (high < pos + right)]] = True
    open_group &= np.bincount(group) > 1
    edge = (key == numbers(table, "key").min()) | (key == numbers(table, "key").max())
    wanted = np.flatnonzero(open_group[group] | edge)
    found = [(order[high > pos], low[high > pos], high[high > pos], None)]
    for back in range(before + 1):
        own = wanted[(left[wanted] >= back) & (right[wanted] >= length - back)]
        if not len(own):
            continue
        value = hash_columns(words[own, before - back : before - back + length])
        by = np.lexsort((doc[own], value))
        v, d, o = value[by], doc[own][by], own[by]
        run = np.cumsum(np.append(True, v[1:] != v[:-1])) - 1
        starts = np.flatnonzero(np.append(True, v[1:] != v[:-1]))
        several = d[starts] != d[np.append(starts[1:], len(d)) - 1]  # documents ascend in a run
        hit = o[several[run]]
        found.append((order[hit], pos[hit] - back, pos[hit] - back + length, None))
        # what may go on in another task: the unmatched ones, and of a matched window one row to tell it there
        is_first = np.zeros(len(o), bool)
        is_first[starts] = True
        out = edge[o] & (is_first | ~several[run])
        found.append((order[o[out]], pos[o[out]] - back, pos[o[out]] - back + length, v[out]))
    ids, hs = table.column("id"), table.column("h")
    for rows, lo, hi, value in found:
        for i in range(0, len(rows), 1 << 16):
            some = slice(i, i + (1 << 16))
            at = pa.array(rows[some])
            given = pa.nulls(len(at), pa.int64()) if value is None else pa.array(texts.longs(value[some]))
            part = pa.table([ids.take(at), hs.take(at), pa.array(lo[some]), pa.array(hi[some]), given], names=["id", "h", "from", "to", "value"])
            yield from part.to_batches()


def hash_columns(words: np.ndarray) -> np.ndarray:
    power, _ = texts.powers(words.shape[1] + 1)
    total = np.zeros(len(words), np.uint64)
    for j in range(words.shape[1]):
        total += texts.mix(words[:, j]) * power[j]
    return texts.mix(total)


def repeated_passages(docs: DataFrame, id_col: str = "doc_id", text: str = "text", length: int = LENGTH) -> DataFrame:
    """One row per document with passages of at least ``length`` words that another document has too: id, h (a hash of its
    text), n_words (words in them), spans (array of from, to: word numbers from 0, ascending, apart)."""
    window_of(length)
    id_type = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), text_hash(text).alias("h"), F.col(text).alias("text"))
    kind = f"id {id_type}, h long, key long, pos int"
    all_suffixes = rows.mapInArrow(lambda it: suffixes(it, length), kind)
    repeated = folders.save(all_suffixes.repartitionByRange("key", "id", "pos").mapInArrow(next_to_itself, kind), "repeated")
    places = repeated.groupBy("id", "h").agg(F.sort_array(F.collect_set("pos")).alias("at")).withColumnsRenamed({"id": "_id", "h": "_h"})
    texts_of = rows.join(places, rows["id"].eqNullSafe(places["_id"]) & (rows["h"] == places["_h"])).dropDuplicates(["id", "h"]).select("id", "h", "text", "at")
    contexts = texts_of.mapInArrow(lambda it: around(it, length), f"{kind}, left int, right int, words binary")
    compared = contexts.repartitionByRange("key", "id", "pos").mapInArrow(lambda it: compare(it, length), f"id {id_type}, h long, from long, to long, value long")
    compared = folders.save(compared, "matches")
    windows = compared.filter("value is not null")
    ref = F.struct(F.col("id").isNull(), "id", "h")
    shared = windows.groupBy("value").agg(F.min(ref).alias("lo"), F.max(ref).alias("hi")).filter("lo <> hi").select("value")
    matches = compared.filter("value is null").select("id", "h", "from", "to").unionByName(windows.join(shared, "value").select("id", "h", "from", "to"))

    # join what overlaps or touches
    matches = matches.groupBy("id", "h", "from").agg(F.max("to").alias("to"))
    so_far = F.max("to").over(Window.partitionBy("id", "h").orderBy("from").rowsBetween(Window.unboundedPreceding, -1))
    marked = matches.withColumn("new", F.when(F.col("from") <= so_far, 0).otherwise(1))
    numbered = marked.withColumn("span", F.sum("new").over(Window.partitionBy("id", "h").orderBy("from").rowsBetween(Window.unboundedPreceding, 0)))
    spans = numbered.groupBy("id", "h", "span").agg(F.min("from").alias("from"), F.max("to").alias("to"))
    return spans.groupBy("id", "h").agg(F.sum(F.col("to") - F.col("from")).alias("n_words"), F.sort_array(F.collect_list(F.struct("from", "to"))).alias("spans"))


def text_hash(text: str):
    return F.xxhash64(F.coalesce(F.col(text), F.lit("")), F.lit(17))


def passages(docs: DataFrame, found: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """The passages as texts: id, from, to (words), passage (the text from the first word's start to the last one's end)."""
    id_type = docs.schema[id_col].dataType.simpleString()
    spans = found.select(F.col("id").alias("_id"), F.col("h").alias("_h"), "spans")
    rows = docs.select(F.col(id_col).alias("id"), text_hash(text).alias("h"), F.col(text).alias("text"))
    both = rows.join(spans, rows["id"].eqNullSafe(spans["_id"]) & (rows["h"] == spans["_h"])).select("id", "text", "spans")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for t in texts.slices(batch.column(1)):
                w = texts.words(t)
                out = []
                for i, own in enumerate(batch.column(2).slice(t.first, len(t)).to_pylist()):
                    for s in own:
                        a, b = w.start[w.bounds[i] + s["from"]], w.end[w.bounds[i] + s["to"] - 1]
                        out.append((t.first + i, s["from"], s["to"], t.data[a:b].tobytes().decode()))
                at, a, b, body = (list(c) for c in zip(*out, strict=True)) if out else ([], [], [], [])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(at, pa.int64())), pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(body, pa.string())],
                    names=["id", "from", "to", "passage"],
                )

    return both.mapInArrow(run, f"id {id_type}, from long, to long, passage string")
