"""Benchmark decontamination by template canonicalisation.

Texts become templates: numbers, names and units give way to a placeholder of their type, other words stand in lower
case (A to Z and À to Þ). Windows of ``WINDOW`` template words are joined by hash (128 bits) with those of the benchmark items. A window
whose values are the item's, or that has none, is a hit. Where values differ, those of a run of adjoining such windows along
one alignment of document and item must map one to one, so that a question with other
numbers or names is caught and a text that merely has the same shape is not. An item shorter than a window is one window.

A template with fewer than ``LITERALS`` plain words says too little, so such windows are joined by what is written: runs of
``WINDOW`` words, in any case, with their real numbers, names and units. The first words of each item are joined so as well,
because a document may see its first word as a name, and an item with ``LEAST`` to ``WINDOW`` - 1 words as a whole. Items of
fewer than ``LEAST`` words are not looked for.

* number: digits, with single points or commas inside; ``12kg`` is the number 12 and the word kg
* unit: a word of ``UNITS`` directly after a number
* name: a run of words with one capital at the start, not at the start of a text, line or sentence

Only document windows that a Bloom filter of the benchmark's windows holds are shuffled; the filter has at most
``MAX_BITS`` bits. Null texts are empty, null and repeated ids allowed; items of equal text count as the smallest id,
items with a null id are used. An empty benchmark contaminates nothing.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from . import folders, line_dedup, texts

WINDOW, LITERALS, LEAST = 8, 5, 3
MAX_BITS = 1 << 28
#: Unit words (English and SI) that follow a number.
UNITS = (
    "mm cm m km inch inches foot feet ft yard yards mile miles mg g kg gram grams kilogram kilograms ton tons lb lbs pound pounds oz "
    "ounce ounces ml l liter liters litre litres gallon gallons s sec second seconds min minute minutes h hr hour hours day days week "
    "weeks month months year years hz khz mhz ghz v w kw kwh j kj cal kcal k c f degree degrees percent dollar dollars cent cents euro "
    "euros usd eur byte bytes kb mb gb tb mph kmh times pieces people"
).split()

_NUMBER, _NAME, _UNIT = (np.uint64(x) for x in (0x4E554D4245523A31, 0x4E414D453A323232, 0x554E49543A333333))
_GAP = np.isin(np.arange(256), [ord(c) for c in ".,"])
_BREAK = np.isin(np.arange(256), [ord(c) for c in ".!?:\n\r\"“”«»|-*#>"])


def _unit_hashes() -> np.ndarray:
    data = np.frombuffer(" ".join(UNITS).encode(), np.uint8)
    start, end = texts.runs(data != 32, np.array([0, len(data)]))
    return np.sort(texts.range_hashes(data, start, end))


_UNITS = _unit_hashes()


class Template(NamedTuple):
    """Template words of all texts of a slice: hash, slot value (0 for a plain word), text; and their words as written."""

    word: np.ndarray
    slot: np.ndarray
    text: np.ndarray
    said: np.ndarray  # hash of every word in lower case, and of the mark that joins it to the same number
    said_plain: np.ndarray
    said_text: np.ndarray


def template(t: texts.Texts) -> Template:
    data = t.data
    second = capital_second(data)
    low = np.where(second, data + np.uint8(32), texts.LOWER[data])
    start, end = texts.runs(texts.WORD[data], t.bounds)
    # numbers end where letters follow
    starts, ends = np.zeros(len(data) + 1, bool), np.zeros(len(data) + 1, bool)
    starts[start], ends[end] = True, True
    digit = texts.DIGIT[data]
    inner = np.zeros(len(data) + 1, bool)
    if len(data):
        inner[1:-1] = digit[:-1] & texts.WORD[data[1:]] & ~digit[1:] & ~starts[1:-1]
    start, end = np.flatnonzero(starts | inner), np.flatnonzero(ends | inner)
    text = np.searchsorted(t.bounds, start, "right") - 1
    n = len(start)
    if not n:
        return Template(np.zeros(0, np.uint64), np.zeros(0, np.uint64), text, np.zeros(0, np.uint64), np.zeros(0, bool), text)
    digits = np.concatenate([[0], np.cumsum(digit)])
    capitals = np.concatenate([[0], np.cumsum(texts.UPPER_CASE[data] | second)])
    breaks = np.concatenate([[0], np.cumsum(_BREAK[data])])
    number = digits[end] - digits[start] == end - start
    same = np.zeros(n, bool)
    same[1:] = text[1:] == text[:-1]
    before = np.concatenate([[0], end[:-1]])
    gap = start - before
    hashes = texts.range_hashes(low, start, end)
    # the capital of a two-byte letter is counted at its second byte
    wide = second[np.minimum(start + 1, len(data) - 1)]
    leading = texts.UPPER_CASE[data[start]] | wide
    name = leading & (capitals[end] - capitals[start] == 1) & (end - start > 1 + wide) & same & (breaks[start] == breaks[before])
    at = np.minimum(np.searchsorted(_UNITS, hashes), len(_UNITS) - 1)
    unit = np.zeros(n, bool)
    unit[1:] = (_UNITS[at] == hashes)[1:] & number[:-1] & same[1:] & (gap[1:] <= 1)
    name &= ~unit
    # parts of one number or name are one template word
    goes_on = np.zeros(n, bool)
    goes_on[1:] = same[1:] & number[1:] & number[:-1] & (gap[1:] == 1) & _GAP[data[before[1:]]]
    said = hashes.copy()
    said[goes_on] = texts.mix(hashes[goes_on] ^ data[before[goes_on]].astype(np.uint64))
    goes_on[1:] |= same[1:] & name[1:] & name[:-1] & (gap[1:] == 1)
    heads = np.flatnonzero(~goes_on)
    last = end[np.append(heads[1:], n) - 1]
    kind = np.select([number, name, unit], [_NUMBER, _NAME, _UNIT], np.uint64(0))[heads]
    value = texts.range_hashes(low, start[heads], last)
    word, slot = np.where(kind > 0, texts.mix(kind), hashes[heads]), np.where(kind > 0, texts.mix(value ^ kind) | np.uint64(1), np.uint64(0))
    return Template(word, slot, text[heads], said, ~(number | name | unit), text)


def capital_second(data: np.ndarray) -> np.ndarray:
    """Second bytes of capital letters of the Latin-1 range (À to Þ, without the multiplication sign)."""
    out = np.zeros(len(data), bool)
    if len(data) > 1:
        out[1:] = (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)
    return out


class Windows(NamedTuple):
    key: np.ndarray
    first: np.ndarray  # index of the window's first word
    size: int
    said: bool  # words as written, not template words


def rolled(word: np.ndarray, size: int) -> np.ndarray:
    """A hash of every run of ``size`` words, before its bits are spread."""
    count = max(0, len(word) - size + 1)
    key = np.zeros(count, np.uint64)
    power, _ = texts.powers(size + 1)
    for j in range(size):
        key += word[j : j + count] * power[j]
    return key


def plain_words(plain: np.ndarray, size: int) -> np.ndarray:
    """The number of plain words of every run of ``size`` words."""
    total = np.concatenate([[0], np.cumsum(plain)])
    return total[size:] - total[: max(0, len(total) - size)]


def windows(x: Template, size: int) -> Windows:
    """All windows of ``size`` template words with enough plain ones."""
    key = rolled(x.word, size)
    count = len(key)
    first = np.flatnonzero((x.text[:count] == x.text[len(x.text) - count :]) & (plain_words(x.slot == 0, size) >= LITERALS))
    return Windows(texts.mix(key[first] + np.uint64(size)), first, size, False)


def said_windows(x: Template, size: int) -> Windows:
    """All windows of ``size`` words as written."""
    key = rolled(x.said, size)
    count = len(key)
    first = np.flatnonzero(x.said_text[:count] == x.said_text[len(x.said) - count :])
    return Windows(texts.mix(key[first] ^ np.uint64(0x5A17C0DE5A17C0DE) + np.uint64(size)), first, size, True)


def emit(ids: pa.Array, hs: pa.Array, t: texts.Texts, x: Template, w: Windows, chosen: np.ndarray) -> pa.RecordBatch:
    first = w.first[chosen]
    word, text = (x.said, x.said_text) if w.said else (x.word, x.text)
    origin = np.searchsorted(text, text[first])
    rows = pa.array(t.first + text[first])
    inside = first[:, None] + np.arange(w.size)[None, :]
    power, _ = texts.powers(w.size + 1)
    check = (texts.mix(word[inside] ^ np.uint64(0x7F4A7C15F39CC060)) * power[w.size - np.arange(w.size)][None, :]).sum(axis=1, dtype=np.uint64)
    slots = [[]] * len(first) if w.said else [r[r != 0].view(np.int64).tolist() for r in x.slot[inside]]
    return pa.RecordBatch.from_arrays(
        [
            ids.take(rows),
            hs.take(rows),
            pa.array(texts.longs(w.key[chosen])),
            pa.array(texts.longs(texts.mix(check))),
            pa.array((first - origin).astype(np.int64)),
            pa.array(slots, pa.list_(pa.int64())),
            pa.array(np.full(len(first), w.said)),
        ],
        names=["id", "h", "key", "check", "pos", "slots", "said"],
    )


def _schema(id_type: str) -> str:
    return f"id {id_type}, h long, key long, check long, pos long, slots array<long>, said boolean"


def item_windows(items: DataFrame, id_col: str, text: str, window: int) -> DataFrame:
    """The windows of the benchmark; of items of equal text the smallest id stands for all."""
    id_type = items.schema[id_col].dataType.simpleString()
    rows = items.groupBy(F.coalesce(F.col(text), F.lit("")).alias("text")).agg(F.min(id_col).alias("id")).select("id", F.xxhash64("text").alias("h"), "text")

    def chosen(x: Template, n_texts: int) -> Iterator[tuple[Windows, np.ndarray]]:
        n = np.bincount(x.text, minlength=n_texts)
        for size in [*np.unique(n[(n >= LITERALS) & (n < window)]).tolist(), window]:
            w = windows(x, size)
            yield w, np.ones(len(w.key), bool) if size == window else n[x.text[w.first]] == size
        n = np.bincount(x.said_text, minlength=n_texts)
        for size in np.unique(n[(n >= LEAST) & (n < window)]).tolist():
            w = said_windows(x, size)
            yield w, n[x.said_text[w.first]] == size
        w = said_windows(x, window)
        opening = w.first == np.searchsorted(x.said_text, x.said_text[w.first])
        yield w, opening | (plain_words(x.said_plain, window)[w.first] < LITERALS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for t in texts.slices(batch.column(2)):
                x = template(t)
                for w, own in chosen(x, len(t)):
                    yield emit(batch.column(0), batch.column(1), t, x, w, own).append_column("size", pa.array(np.full(int(own.sum()), w.size, np.int64)))

    return rows.mapInArrow(run, _schema(id_type) + ", size long")


def key_filter(windows_of_items: DataFrame, bits: int) -> np.ndarray:
    """A Bloom filter of ``bits`` bits over the keys."""
    schema = "piece long, once binary, twice binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filled = np.zeros(bits // 8, np.uint8)
        for batch in batches:
            line_dedup.put(filled, batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64))
        yield from line_dedup.pieces(filled, filled)

    own = windows_of_items.select("key").mapInArrow(run, schema)
    return line_dedup.collected(own.repartition("piece").mapInArrow(line_dedup.merge, schema).select("piece", "once"), bits)


def contaminated(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text", window: int = WINDOW
) -> DataFrame:
    """One row per document that holds a passage of an item: id, h (hash of its text), n_items, item (the smallest), n_windows."""
    if window < LITERALS:
        raise ValueError(f"a window has at least {LITERALS} words")
    spark = docs.sparkSession
    known = folders.save(item_windows(items, item_id, item_text, window), "item-windows")
    count, *_ = known.agg(F.count(F.lit(1))).first()
    sizes = sorted((r["said"], r["size"]) for r in known.select("said", "size").distinct().collect())  # at most 2 x `window` rows
    bits = min(MAX_BITS, max(1 << 16, 1 << int(16 * count).bit_length()))
    filled = spark.sparkContext.broadcast(key_filter(known, bits))
    id_type = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), text_hash(text).alias("h"), F.col(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for t in texts.slices(batch.column(2)):
                x = template(t)
                for said, size in sizes:
                    w = said_windows(x, size) if said else windows(x, size)
                    hit = line_dedup.holds(filled.value, w.key)
                    if hit.any():
                        yield emit(batch.column(0), batch.column(1), t, x, w, hit)

    found = rows.mapInArrow(run, _schema(id_type))
    of_item = known.select("key", "check", "said", F.col("id").alias("item"), F.col("h").alias("item_h"), F.col("pos").alias("item_pos"), F.col("slots").alias("item_slots"))
    both = found.join(of_item, ["key", "check", "said"])
    line = ["id", "h", "item", "item_h", "said", "shift"]
    met = F.collect_set(F.struct("pos", F.col("slots").alias("a"), F.col("item_slots").alias("b"))).alias("met")
    lines = both.withColumn("shift", F.col("pos") - F.col("item_pos")).groupBy(*line).agg(met)
    # windows with the item's own values (or none) are hits; those with other values that overlap or touch are one run
    each = lines.select(*line, F.inline("met")).withColumn("equal", F.col("a") == F.col("b"))
    along = Window.partitionBy(*line, "equal").orderBy("pos")
    apart = F.when(F.col("pos") - F.lag("pos").over(along) > window, 1).otherwise(0)
    runs = each.withColumn("apart", apart).withColumn("run", F.sum("apart").over(along)).groupBy(*line, "equal", "run").agg(
        F.array_distinct(F.flatten(F.collect_set(F.arrays_zip("a", "b")))).alias("pairs"), F.count(F.lit(1)).alias("size")
    )
    one_to_one = (F.size(F.array_distinct(F.transform("pairs", lambda p: p["a"]))) == F.size("pairs")) & (
        F.size(F.array_distinct(F.transform("pairs", lambda p: p["b"]))) == F.size("pairs")
    )
    good = runs.filter(F.col("equal") | one_to_one)
    return good.groupBy("id", "h").agg(
        F.count_distinct("item_h").alias("n_items"), F.min("item").alias("item"), F.sum("size").alias("n_windows")
    )


def text_hash(text: str):
    return F.xxhash64(F.coalesce(F.col(text), F.lit("")), F.lit(13))


def drop_contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text: str = "text", **more) -> DataFrame:
    """The rows of ``docs`` without a passage of an item."""
    found = contaminated(docs, items, id_col, text, **more).select(F.col("id").alias("_id"), F.col("h").alias("_h"))
    marked = docs.select(F.struct(*docs.columns).alias("row"), F.col(id_col).alias("id"), text_hash(text).alias("h"))
    return marked.join(found, marked["id"].eqNullSafe(found["_id"]) & (marked["h"] == found["_h"]), "left_anti").select("row.*")
