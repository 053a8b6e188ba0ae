"""Trimming of reads and routing of pairs. A trimmed read keeps ``seq`` and ``qual`` of equal length."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from ..functions.sequences import MAX_QUALITY, reverse_complement
from ..functions.tails import once
from ..session import widen

MAX_ADAPTERS = 10_000  # an adapter file is a short list; it travels with the job


def _cut(reads: DataFrame, first: Column, length: Column) -> DataFrame:
    """Keep ``length`` letters from the 1-based position ``first``; the bounds are computed once per read."""
    cut = reads.withColumns({"_first": once(first), "_length": once(length)})
    return cut.withColumns(
        {c: F.substring(F.col(c), F.col("_first"), F.col("_length")) for c in ("seq", "qual")}
    ).drop("_first", "_length")


def _place(qual: str, offset: int, marked: Callable[[np.ndarray], np.ndarray], last: bool = False, width: int = 1, empty: int = 0) -> Column:
    """Per read the 1-based place of the first marked letter (with ``last`` of the last one, counted from the end); 0 without any,
    ``empty`` for an empty text, null for a null. ``marked`` gets the qualities of many reads in a row and says where a mark of
    ``width`` letters starts."""

    @F.pandas_udf("int")
    def find(quals: pd.Series) -> pd.Series:
        out = np.zeros(len(quals), np.int64)
        texts = quals.fillna("")
        for at, part in _stretches(texts):
            end = np.cumsum(part.str.len().to_numpy(np.int64))
            begin = np.append(0, end[:-1])
            marks = np.flatnonzero(marked(np.clip(_codes("".join(part)).astype(np.int64) - offset, 0, MAX_QUALITY)))
            marks = np.concatenate([[-1], marks, [end[-1] + width]])
            if last:
                place = end - marks[np.searchsorted(marks, end) - 1]
                out[at : at + len(part)] = np.where(place <= end - begin, place, 0)
            else:
                place = marks[np.searchsorted(marks, begin)]
                out[at : at + len(part)] = np.where(place + width <= end, place - begin + 1, 0)
            out[at : at + len(part)][end == begin] = empty
        return pd.Series(out, quals.index, dtype="Int32").mask(quals.isna())

    return find(qual)


def _stretches(texts: pd.Series) -> Iterator[tuple[int, pd.Series]]:
    """Texts in stretches of about ``_CELLS`` letters, and where each begins."""
    total = np.cumsum(texts.str.len().to_numpy(np.int64))
    first = 0
    while first < len(texts):
        reach = (total[first - 1] if first else 0) + _CELLS
        end = max(first + 1, int(np.searchsorted(total, reach, "right")))
        yield first, texts.iloc[first:end]
        first = end


def trim_leading(reads: DataFrame, q: int = 3, offset: int = 33) -> DataFrame:
    """Drop the bases before the first one of quality ``q``."""
    return _led(widen(reads), q, offset)


def _led(reads: DataFrame, q: int, offset: int) -> DataFrame:
    placed = reads.withColumn("_good", _place("qual", offset, lambda x: x >= q, empty=int(q <= 0)))
    first = F.when(F.col("_good") > 0, F.col("_good")).otherwise(F.length("seq") + 1)
    return _cut(placed, first, F.length("seq")).drop("_good")


def trim_trailing(reads: DataFrame, q: int = 3, offset: int = 33) -> DataFrame:
    """Drop the bases after the last one of quality ``q``."""
    return _trailed(widen(reads), q, offset)


def _trailed(reads: DataFrame, q: int, offset: int) -> DataFrame:
    placed = reads.withColumn("_good", _place("qual", offset, lambda x: x >= q, last=True, empty=int(q <= 0)))
    length = F.when(F.col("_good") > 0, F.length("seq") - F.col("_good") + 1).otherwise(F.lit(0))
    return _cut(placed, F.lit(1), length).drop("_good")


def trim_sliding_window(reads: DataFrame, window: int = 4, q: float = 15, offset: int = 33) -> DataFrame:
    """Cut where the first window with a mean below ``q`` starts; reads shorter than the window stay."""
    return _windowed(widen(reads), window, q, offset)


def _windowed(reads: DataFrame, window: int, q: float, offset: int) -> DataFrame:
    def low(x: np.ndarray) -> np.ndarray:
        total = np.append(0, np.cumsum(x))
        return total[window:] - total[:-window] < q * window

    placed = reads.withColumn("_bad", _place("qual", offset, low, width=window))
    length = F.when(F.col("_bad") > 0, F.col("_bad") - 1).otherwise(F.length("seq"))
    return _cut(placed, F.lit(1), length).drop("_bad")


def drop_short(reads: DataFrame, min_length: int = 36) -> DataFrame:
    return reads.filter(F.length("seq") >= min_length)


def trim_reads(reads: DataFrame, adapters: DataFrame | None = None, offset: int = 33) -> DataFrame:
    """The whole trimming step with its standard settings: adapters, both ends, sliding window, length.

    The reads are shuffled once, to bring mates together; every other step is done where a read lies.
    """
    if adapters is not None:
        parts = _pair_parts(reads)  # of the reads as they came, as clipping is not done twice
        reads = clip_pairs(clip_adapters(reads, adapters, offset=offset), offset=offset, parts=parts)
    else:
        reads = widen(reads)
    reads = _trailed(_led(reads, 3, offset), 3, offset)
    return drop_short(_windowed(reads, 4, 15, offset), 36)


def route_pairs(reads: DataFrame) -> DataFrame:
    """Add ``route``: paired if both mates of (sample, read_id) are left, else unpaired."""
    mates = reads.groupBy("sample", "read_id").agg(F.count_distinct("mate").alias("_mates"))
    both = F.when(F.col("_mates") == 2, "paired").otherwise("unpaired")
    return reads.join(mates, ["sample", "read_id"]).withColumn("route", both).drop("_mates")


def select_reads(raw: DataFrame, trimmed: DataFrame | None, graft: DataFrame | None, trim: bool, xeno_filter: bool) -> DataFrame:
    """Raw, trimmed or graft reads, by two switches; asking for a table that was not made is an error."""
    chosen, name = (graft, "graft") if xeno_filter else (trimmed, "trimmed") if trim else (raw, "raw")
    if chosen is None:
        raise ValueError(f"{name} reads were asked for but not made")
    return chosen


# --- adapters ------------------------------------------------------------------------------------


def _adapter_codes(adapters: DataFrame) -> list[np.ndarray]:
    rows = adapters.select("seq").filter(F.length("seq") > 0).distinct().limit(MAX_ADAPTERS + 1).collect()
    if len(rows) > MAX_ADAPTERS:
        raise ValueError(f"more than {MAX_ADAPTERS} adapters")
    return [_codes(r[0]) for r in sorted(rows)]


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32)


def _padded(texts: pd.Series) -> tuple[np.ndarray, np.ndarray]:
    """The characters of all texts as rows of one array, filled up with zeros, and their lengths."""
    length = texts.str.len().to_numpy(np.int64)
    out = np.zeros((len(texts), max(1, int(length.max(initial=0)))), np.uint32)
    out[np.arange(out.shape[1])[None, :] < length[:, None]] = _codes("".join(texts))
    return out, length


def _qualities(texts: pd.Series, offset: int) -> np.ndarray:
    return np.clip(_padded(texts)[0].astype(np.int64) - offset, 0, 93)


def _best_runs(scores: np.ndarray) -> np.ndarray:
    """Per row the largest sum of a stretch of consecutive scores."""
    total = np.concatenate([np.zeros((len(scores), 1)), np.cumsum(scores, axis=1)], axis=1)
    return (total - np.minimum.accumulate(total, axis=1)).max(axis=1)


def _seed_misses(seq: np.ndarray, heads: np.ndarray, used: np.ndarray, windows: int) -> np.ndarray:
    """Mismatches of every window of every row with the row's head, of which the first ``used`` letters count."""
    misses = np.zeros((len(seq), windows), np.int16)
    wide = np.pad(seq, ((0, 0), (0, heads.shape[1])))
    for i in range(heads.shape[1]):
        misses += (wide[:, i : i + windows] != heads[:, i, None]) & (i < used)[:, None]
    return misses


def _alignment_scores(seq: np.ndarray, qual: np.ndarray, other: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Per row the best stretch over the first ``length`` letters: log10(4) a match, minus a tenth of the quality a mismatch."""
    scores = np.where(seq == other, math.log10(4), -qual / 10.0)
    return _best_runs(np.where(np.arange(seq.shape[1])[None, :] < length[:, None], scores, 0.0))


def _from(rows: np.ndarray, row: np.ndarray, start: np.ndarray, width: int) -> np.ndarray:
    """``width`` letters of the given rows from the given places on, zeros beyond the end."""
    wide = np.pad(rows, ((0, 0), (0, width)))
    return wide[row[:, None], start[:, None] + np.arange(width)[None, :]]


_CELLS = 1 << 22  # letters that are scored together (one longer read by itself)


def _parts(batch: pd.DataFrame, column: str) -> Iterator[pd.DataFrame]:
    """The rows in parts of like lengths, so that rows filled up to the longest of a part hold few more cells than letters."""
    length = np.maximum(batch[column].str.len().fillna(0).to_numpy(np.int64), 1)
    order = np.argsort(length, kind="stable")
    first = 0
    while first < len(order):
        cells = length[order[first:]] * np.arange(1, len(order) - first + 1)  # of the rows up to each, ascending
        last = first + max(1, int(np.searchsorted(cells, _CELLS, "right")))
        yield batch.iloc[order[first:last]]
        first = last


def _clip_places(seqs: pd.Series, quals: pd.Series, adapters: list[np.ndarray], seeds: int, score: float, seed_length: int, offset: int) -> np.ndarray:
    """Per read the first position where an adapter aligns well enough; the read length if none does.

    Of ``seeds`` + 1 parts of a seed one has no mismatch, so whole seeds are compared only where a part is found. Reads too
    short to hold a whole seed, and adapters with too few letters for the parts, are tried at every position.
    """
    length = seqs.str.len().to_numpy(np.int64)
    parted = [a for a in adapters if len(a) > seeds]
    best = _seeded_places(seqs, quals, parted, seeds, score, seed_length, offset)
    short = np.flatnonzero(length < seed_length)
    some = list(dict.fromkeys([*(np.arange(len(seqs)).tolist() if len(parted) < len(adapters) else []), *short.tolist()]))
    if some:
        tried = [a for a in adapters if len(a) <= seeds]
        rest = _tried_places(seqs.iloc[some], quals.iloc[some], tried, seeds, score, seed_length, offset)
        best[some] = np.minimum(best[some], rest)
    if len(short):
        best[short] = np.minimum(best[short], _tried_places(seqs.iloc[short], quals.iloc[short], parted, seeds, score, seed_length, offset))
    return best


def _stretch_hashes(codes: np.ndarray, size: int) -> np.ndarray:
    """A 64-bit hash of every stretch of ``size`` letters; equal stretches have equal ones."""
    count = max(0, len(codes) - size + 1)
    out = np.zeros(count, np.uint64)
    for j in range(size):
        out = out * np.uint64(0x9E3779B97F4A7C15) + codes[j : j + count].astype(np.uint64) + np.uint64(1)
    return out


_AT_ONCE = 1 << 16  # alignments that are scored together


def _seeded_places(seqs: pd.Series, quals: pd.Series, adapters: list[np.ndarray], seeds: int, score: float, seed_length: int, offset: int) -> np.ndarray:
    """The first places for whole seeds, found by their parts."""
    length = seqs.str.len().to_numpy(np.int64)
    best = length.copy()
    codes = _codes("".join(seqs))
    begin = np.cumsum(length) - length
    of = np.repeat(np.arange(len(seqs)), length)
    quality = _qualities(quals, offset)
    quality = np.pad(quality, ((0, 0), (0, max(0, int(length.max(initial=0)) - quality.shape[1]))))
    widest = max((len(a) for a in adapters), default=0)
    letters = np.zeros((len(adapters), widest), np.uint32)
    for i, a in enumerate(adapters):
        letters[i, : len(a)] = a
    sizes = np.array([len(a) for a in adapters], np.int64)
    heads = np.minimum(sizes, seed_length)
    padded = np.pad(codes, (0, widest + seed_length))
    for head in np.unique(heads).tolist():
        own = np.flatnonzero(heads == head)
        found = []
        for part in np.array_split(np.arange(head), seeds + 1):
            start, size = int(part[0]), len(part)
            wanted = np.array([_stretch_hashes(letters[i, start : start + size], size)[0] for i in own], np.uint64)
            order = np.argsort(wanted, kind="stable")
            keys = wanted[order]
            there = _stretch_hashes(codes, size)
            first, last = np.searchsorted(keys, there, "left"), np.searchsorted(keys, there, "right")
            at = np.flatnonzero(last > first)
            many = last[at] - first[at]
            place = np.repeat(at, many) - start
            adapter = own[order[np.repeat(first[at] - (np.cumsum(many) - many), many) + np.arange(int(many.sum()))]]
            row = of[np.repeat(at, many)]
            inside = (place >= begin[row]) & (place + head <= begin[row] + length[row])
            found.append(place[inside] * len(adapters) + adapter[inside])
        for_all = np.unique(np.concatenate(found))
        for first in range(0, len(for_all), _AT_ONCE):
            place, adapter = np.divmod(for_all[first : first + _AT_ONCE], len(adapters))
            misses = (padded[place[:, None] + np.arange(head)] != letters[adapter, :head]).sum(axis=1)
            row = of[place]
            start = place - begin[row]
            near = np.flatnonzero((misses <= seeds) & (start < best[row]))
            row, start, adapter, place = row[near], start[near], adapter[near], place[near]
            step = max(1, _CELLS // max(1, widest))
            for part in range(0, len(row), step):
                r, b, a, p = row[part : part + step], start[part : part + step], adapter[part : part + step], place[part : part + step]
                size = np.minimum(sizes[a], length[r] - b)
                good = _alignment_scores(padded[p[:, None] + np.arange(widest)], _from_places(quality, r, b, widest), letters[a], size) >= score
                np.minimum.at(best, r[good], b[good])
    return best


def _from_places(rows: np.ndarray, row: np.ndarray, start: np.ndarray, width: int) -> np.ndarray:
    """``width`` values of the given rows from the given places on, zeros beyond the end."""
    at = start[:, None] + np.arange(width)[None, :]
    return np.where(at < rows.shape[1], rows[row[:, None], np.minimum(at, rows.shape[1] - 1)], 0)


def _tried_places(seqs: pd.Series, quals: pd.Series, adapters: list[np.ndarray], seeds: int, score: float, seed_length: int, offset: int) -> np.ndarray:
    """The first places, with every adapter tried at every position."""
    seq, length = _padded(seqs)
    qual = _qualities(quals, offset)
    qual = np.pad(qual, ((0, 0), (0, max(0, seq.shape[1] - qual.shape[1]))))
    best = length.copy()
    for adapter in adapters:
        head = adapter[:seed_length]
        used = np.minimum(len(head), length)
        misses = _seed_misses(seq, np.broadcast_to(head, (len(seq), len(head))), used, seq.shape[1])
        at = np.arange(seq.shape[1])[None, :]
        row, place = np.nonzero((misses <= seeds) & (at + used[:, None] <= length[:, None]) & (at < best[:, None]))
        if not len(row):
            continue
        size = np.minimum(len(adapter), length[row] - place)
        good = _alignment_scores(_from(seq, row, place, len(adapter)), _from(qual, row, place, len(adapter)), adapter[None, :], size) >= score
        np.minimum.at(best, row[good], place[good])
    return best


def clip_adapters(
    reads: DataFrame, adapters: DataFrame, seeds: int = 2, simple: float = 10, seed_length: int = 16, offset: int = 33
) -> DataFrame:
    """Cut each read where an adapter starts.

    A seed of 16 bases (a shorter adapter as a whole; as much of it as a shorter read can hold) with at most ``seeds``
    mismatches proposes a position; the alignment from there scores
    log10(4) per match and minus a tenth of the quality per mismatch, and its best stretch must
    reach ``simple``. Runs on arrays of many reads inside the tasks, no shuffle. Null reads stay null.
    """
    codes = _adapter_codes(adapters)

    def clip(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for whole in batches:
            for batch in _parts(whole, "seq"):
                seqs, quals = batch["seq"].fillna(""), batch["qual"].fillna("")
                cut = _clip_places(seqs, quals, codes, seeds, simple, seed_length, offset).tolist()
                known = batch["seq"].notna()
                yield batch.assign(
                    seq=pd.Series([s[:n] for s, n in zip(seqs, cut)], batch.index, dtype=object).where(known, None),
                    qual=pd.Series([s[:n] for s, n in zip(quals, cut)], batch.index, dtype=object).where(batch["qual"].notna(), None),
                )

    return widen(reads).mapInPandas(clip, reads.schema)


_PART_LETTERS = 1 << 24  # letters of the reads for each part in which mates meet


def _pair_parts(reads: DataFrame) -> int:
    spark = reads.sparkSession
    letters = reads.agg(F.sum(F.length("seq").cast("long"))).first()[0] or 0
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism, math.ceil(letters / _PART_LETTERS))


def clip_pairs(
    reads: DataFrame, palindrome: float = 30, seeds: int = 2, seed_length: int = 16, offset: int = 33, parts: int | None = None
) -> DataFrame:
    """Cut both mates of a pair that reads through its insert into the adapters.

    Mate 1 up to the insert length equals the reverse complement of mate 2 up to it. The reverse
    complement is laid over mate 1 at every shorter insert length whose first 16 bases fit; the longest
    insert whose overlap scores ``palindrome`` wins, and both mates are cut to it.

    All columns of the reads are shuffled once, into ``parts`` (default: parts of bounded size, for which the letters are counted
    first), and cut where mates meet. Of mates listed more than once each pair counts; a read without a key has no mate.
    """
    key = ["sample", "read_id"]
    keyless = F.col("sample").isNull() | F.col("read_id").isNull()
    # reads without a key would all meet in one part
    dealt = reads.repartition(parts or _pair_parts(reads), *key, F.when(keyless, F.xxhash64("mate", "seq", "qual"))).sortWithinPartitions(*key)
    mate = F.when(keyless, None).when(F.col("mate") == 1, 1).when(F.col("mate") == 2, 2)
    given = dealt.withColumn("_mate", mate).withColumn("_back", F.when(F.col("_mate") == 2, reverse_complement("seq")))

    def clipped(table: pa.Table, starts: np.ndarray) -> Iterator[pa.RecordBatch]:
        """The rows of whole keys with the insert lengths of their pairs."""
        of = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, table.num_rows)))
        which = table["_mate"].fill_null(0).to_numpy()
        one, two = (pd.DataFrame({"of": of[which == m], f"at{m}": np.flatnonzero(which == m)}) for m in (1, 2))
        pairs = one.merge(two, on="of")
        texts = {c: table[n].take(pa.array(pairs[at].to_numpy())).to_pandas().fillna("") for c, n, at in (("s1", "seq", "at1"), ("q1", "qual", "at1"), ("r2", "_back", "at2"))}
        pairs = pairs[["of"]].assign(**texts)
        pairs["_longer"] = pairs["s1"].where(pairs["s1"].str.len() > pairs["r2"].str.len(), pairs["r2"])
        found = [part[["of"]].assign(_insert=_insert_lengths(part["s1"], part["q1"], part["r2"], palindrome, seeds, seed_length, offset)) for part in _parts(pairs, "_longer")]
        found = pd.concat([pd.DataFrame({"of": np.zeros(0, np.int64), "_insert": np.zeros(0, np.int32)}), *found])
        # as many rows of a read as its key has pairs with an insert, one at least
        rows = pd.DataFrame({"of": of, "at": np.arange(len(of))}).merge(found[found["_insert"] >= 0], on="of", how="left")
        out = table.drop_columns(["_mate", "_back"]).take(pa.array(rows["at"].to_numpy()))
        yield from out.append_column("_insert", pa.array(rows["_insert"].astype("Int32"), pa.int32())).to_batches()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []  # the rows of the last key, which may go on in the next batch
        for batch in batches:
            table = pa.Table.from_batches([*held, batch]).combine_chunks()
            if not table.num_rows:
                continue
            codes = [table[c].combine_chunks().dictionary_encode("encode").indices.to_numpy(zero_copy_only=False) for c in key]
            none = np.logical_or(*[table[c].is_null().to_numpy() for c in key])
            begins = np.append(True, none[1:] | (np.diff(codes[0]) != 0) | (np.diff(codes[1]) != 0))
            starts = np.flatnonzero(begins)
            yield from clipped(table.slice(0, starts[-1]), starts[:-1])
            held = table.slice(starts[-1]).to_batches()
        if held:
            yield from clipped(pa.Table.from_batches(held), np.zeros(1, np.int64))

    schema = StructType([*reads.schema.fields, StructField("_insert", IntegerType())])
    cut = given.mapInArrow(run, schema)
    return _cut(cut, F.lit(1), F.coalesce("_insert", F.length("seq"))).drop("_insert").select(*reads.columns)


def _insert_lengths(s1: pd.Series, q1: pd.Series, r2: pd.Series, palindrome: float, seeds: int, seed_length: int, offset: int) -> np.ndarray:
    """Insert lengths shorter than both mates, or -1. r2 starts with the adapter part: its tail is the insert."""
    (one, n1), (two, n2), qual = _padded(s1), _padded(r2), _qualities(q1, offset)
    width = max(one.shape[1], two.shape[1], qual.shape[1])
    one, two, qual = (np.pad(x, ((0, 0), (0, width - x.shape[1]))) for x in (one, two, qual))
    misses = _seed_misses(two, one[:, :seed_length], np.full(len(one), seed_length), width)
    place = np.arange(width)[None, :]
    insert = n2[:, None] - place
    usable = (np.minimum(n1, n2) > seed_length)[:, None] & (insert >= seed_length) & (insert < np.minimum(n1, n2)[:, None])
    row, at = np.nonzero((misses <= seeds) & usable)
    out = np.full(len(one), -1, np.int32)
    if len(row):
        size = n2[row] - at
        good = _alignment_scores(one[row], qual[row], _from(two, row, at, width), size) >= palindrome
        np.maximum.at(out, row[good], size[good].astype(np.int32))
    return out
