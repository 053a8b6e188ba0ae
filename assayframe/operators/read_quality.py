"""Quality report of sequencing reads: one small aggregate table per module.

Reads: (sample, mate, read_id, seq, qual). Per-position modules aggregate position counts on the map side,
so what is shuffled is bounded by read length × letters, not by the number of reads.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.sequences import MAX_QUALITY, gc_count, quality_of
from ..session import widen
from ..sources.staging import stage
from .ordered import small_quantiles

KEY = ["sample", "mate"]
DUPLICATE_LEVELS = (1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 50, 100, 500, 1000, 5000, 10000)


def qc_basic_stats(reads: DataFrame) -> DataFrame:
    n = F.length("seq")
    return reads.groupBy(*KEY).agg(
        F.count(F.lit(1)).alias("reads"),
        F.sum(n).alias("bases"),
        F.min(n).alias("min_length"),
        F.max(n).alias("max_length"),
        F.try_divide(F.sum(gc_count("seq")) * 100, F.sum(n)).alias("gc_percent"),
    )


_SLICE = 1 << 21  # characters that are counted at a time
_HELD = 1 << 21  # counts that a task holds before it passes them on
_KEYS = 512  # reads of a slice at most; so the samples and mates held fit in ten bits


def _by_position(reads: DataFrame, text: str, name: str, by: Sequence[str] = KEY) -> DataFrame:
    """How often each character of ``text`` stands at each position (from 1): (the columns ``by``, pos, ``name``, n).

    Tasks count the characters of many reads at once; a character is a row only after it has been counted. An empty text
    has an empty character at its first position, a null one has none.
    """
    rows = widen(reads).filter(F.col(text).isNotNull()).select(*by, text)
    keys = ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in by)
    empty = 0x110000  # one more than any character

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        of: dict[tuple, int] = {}

        def merged() -> tuple[np.ndarray, np.ndarray]:
            cell, n = (np.concatenate(x) for x in zip(*held, strict=True))
            order = np.argsort(cell, kind="stable")
            cell = cell[order]
            starts = np.flatnonzero(np.append(True, cell[1:] != cell[:-1]))
            return cell[starts], np.add.reduceat(n[order], starts)

        def told(cell: np.ndarray, n: np.ndarray) -> Iterator[pa.RecordBatch]:
            names = [pa.array([k[i] for k in of], kind) for i, kind in enumerate(kinds)]
            for first in range(0, len(cell), 1 << 16):
                c = cell[first : first + (1 << 16)]
                key, at, code = pa.array(c >> 53), c >> 21 & 0xFFFFFFFF, c & 0x1FFFFF
                letters, which = np.unique(code, return_inverse=True)
                shown = pa.array(["" if x == empty else chr(x) for x in letters.tolist()], pa.string()).take(pa.array(which.ravel()))
                yield pa.RecordBatch.from_arrays([*[x.take(key) for x in names], pa.array((at + 1).astype(np.int32)), shown, pa.array(n[first : first + (1 << 16)])], names=[*by, "pos", name, "n"])

        kinds: list[pa.DataType] = []
        for batch in batches:
            kinds = [batch.column(i).type for i in range(len(by))]
            sizes = pc.utf8_length(batch.column(len(by))).to_numpy().astype(np.int64)
            upto = np.cumsum(np.maximum(sizes, 1))
            first = 0
            while first < batch.num_rows:
                last = max(first + 1, int(np.searchsorted(upto, (upto[first - 1] if first else 0) + _SLICE, "right")))
                last = min(last, first + _KEYS)
                part = batch.slice(first, last - first)
                length = sizes[first:last]
                first = last
                own = [of.setdefault(k, len(of)) for k in zip(*[part.column(i).to_pylist() for i in range(len(by))], strict=True)]
                key = np.array(own, np.int64) << 53
                code = np.frombuffer("".join(part.column(len(by)).to_pylist()).encode("utf-32-le", "surrogatepass"), np.uint32)
                at = np.arange(len(code)) - np.repeat(np.cumsum(length) - length, length)
                cell = np.concatenate([np.repeat(key, length) | at << 21 | code, key[length == 0] | empty])
                cell.sort()
                starts = np.flatnonzero(np.append(True, cell[1:] != cell[:-1])) if len(cell) else np.zeros(0, np.int64)
                held.append((cell[starts], np.diff(np.append(starts, len(cell)))))
                if sum(len(c) for c, _ in held) > 2 * _HELD or len(of) >= _KEYS:
                    held = [merged()]
                    if len(held[0][0]) > _HELD or len(of) >= _KEYS:
                        yield from told(*held.pop())
                        held, of = [], {}
        if held:
            yield from told(*merged())

    parts = rows.mapInArrow(run, f"{keys}, pos int, {name} string, n long")
    return parts.groupBy(*by, "pos", name).agg(F.sum("n").alias("n"))


def _tile_counts(reads: DataFrame, field: int = 4) -> DataFrame:
    """(sample, mate, tile, pos, c, n): the quality characters by flow-cell tile (a ``:`` field of the read id) and position."""
    tiled = reads.select(*KEY, F.get(F.split(F.col("read_id"), ":"), field).alias("tile"), "qual")
    return _by_position(tiled, "qual", "c", [*KEY, "tile"])


def _base_counts(reads: DataFrame) -> DataFrame:
    """(sample, mate, pos, base, n): the letters by position."""
    return _by_position(reads.filter(F.length("seq") > 0), "seq", "base")


def qc_base_quality(reads: DataFrame, offset: int = 33) -> DataFrame:
    """Mean, median, quartiles and 10 / 90 % of the quality at every position.

    A position has at most 94 distinct qualities, so the exact percentiles work on a short list of counts.
    """
    return _base_quality(_by_position(reads, "qual", "c"), offset)


def _base_quality(counts: DataFrame, offset: int = 33) -> DataFrame:
    # counted by character; the character becomes a number after the aggregation
    counts = counts.withColumn("q", quality_of("c", offset))
    cuts = small_quantiles("q", [0.1, 0.25, 0.5, 0.75, 0.9], "n")
    stats = counts.groupBy(*KEY, "pos").agg(
        (F.sum(F.col("q") * F.col("n")) / F.sum("n")).alias("mean"), cuts.alias("_c"), F.sum("n").alias("reads")
    )
    names = ("p10", "q1", "median", "q3", "p90")
    return stats.select(*KEY, "pos", "reads", "mean", *[F.get("_c", i).alias(c) for i, c in enumerate(names)])


def _quality_total(qual: str, offset: int) -> Column:
    """Sum of the qualities of a text; null for a null."""

    @F.pandas_udf("long")
    def total(quals: pd.Series) -> pd.Series:
        texts = quals.fillna("")
        lengths = texts.str.len().to_numpy(np.int64)
        upto = np.cumsum(lengths)
        out, first = np.zeros(len(texts), np.int64), 0
        while first < len(texts):
            begin = int(upto[first - 1]) if first else 0
            last = max(first + 1, int(np.searchsorted(upto, begin + _SLICE, "right")))
            codes = np.frombuffer("".join(texts.iloc[first:last]).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
            summed = np.append(0, np.cumsum(np.clip(codes - offset, 0, MAX_QUALITY)))
            ends = upto[first:last] - begin
            out[first:last] = summed[ends] - summed[ends - lengths[first:last]]
            first = last
        return pd.Series(out, quals.index, dtype="Int64").mask(quals.isna())

    return total(qual)


def qc_sequence_quality(reads: DataFrame, offset: int = 33) -> DataFrame:
    """Number of reads by whole mean quality."""
    rows = widen(reads).filter(F.length("qual") > 0).select(*KEY, "qual").withColumn("_total", _quality_total("qual", offset))
    mean = F.floor(F.col("_total") / F.length("qual"))
    return rows.groupBy(*KEY, mean.alias("mean_quality")).agg(F.count(F.lit(1)).alias("reads"))


def qc_tile_quality(reads: DataFrame, offset: int = 33, field: int = 4) -> DataFrame:
    """Mean quality per flow-cell tile (a ``:`` field of the read id) and position, and its distance from the position's mean."""
    return _tile_quality(_tile_counts(reads, field), offset)


def _tile_quality(counts: DataFrame, offset: int = 33) -> DataFrame:
    counts = counts.groupBy(*KEY, "tile", "pos").agg(F.sum(quality_of("c", offset) * F.col("n")).alias("_s"), F.sum("n").alias("reads"))
    everywhere = counts.groupBy(*KEY, "pos").agg((F.sum("_s") / F.sum("reads")).alias("_mean"))
    mean = F.col("_s") / F.col("reads")
    return counts.join(everywhere, [*KEY, "pos"]).select(
        *KEY, "tile", "pos", "reads", mean.alias("mean"), (mean - F.col("_mean")).alias("deviation")
    )


def _letter_shares(counts: DataFrame, bases: str, of: str) -> DataFrame:
    """Share of each base at every position, among the given letters or among all."""
    total = F.sum(F.when(F.col("base").isin(list(of)), F.col("n"))) if of else F.sum("n")
    shares = [F.coalesce(F.sum(F.when(F.col("base") == b, F.col("n"))), F.lit(0)) for b in bases]
    stats = counts.groupBy(*KEY, "pos").agg(total.alias("_total"), *[s.alias(f"_{b}") for b, s in zip(bases, shares)])
    return stats.select(*KEY, "pos", *[F.try_divide(F.col(f"_{b}"), F.col("_total")).alias(b.lower()) for b in bases])


def qc_base_content(reads: DataFrame) -> DataFrame:
    """Share of A, C, G and T at every position, among those four."""
    return _base_content(_base_counts(reads))


def _base_content(counts: DataFrame) -> DataFrame:
    return _letter_shares(counts, "ACGT", "ACGT")


def qc_n_content(reads: DataFrame) -> DataFrame:
    """Share of N at every position, among all letters."""
    return _n_content(_base_counts(reads))


def _n_content(counts: DataFrame) -> DataFrame:
    return _letter_shares(counts, "N", "")


def qc_gc_content(reads: DataFrame) -> DataFrame:
    """Number of reads by whole GC percentage."""
    share = F.floor(gc_count("seq") * 100 / F.length("seq"))
    return reads.filter(F.length("seq") > 0).groupBy(*KEY, share.alias("gc_percent")).agg(F.count(F.lit(1)).alias("reads"))


def qc_length_distribution(reads: DataFrame) -> DataFrame:
    return reads.groupBy(*KEY, F.length("seq").alias("length")).agg(F.count(F.lit(1)).alias("reads"))


def _digest() -> Column:
    return F.coalesce(F.sha2(F.col("seq"), 256), F.lit("")).alias("_digest")


def _copies(reads: DataFrame) -> DataFrame:
    """Copies per sequence (sample, mate, _digest, n); a digest travels in the place of a sequence, once per task."""
    return reads.groupBy(*KEY, _digest()).agg(F.count(F.lit(1)).alias("n"))


def qc_duplication(reads: DataFrame) -> DataFrame:
    """Distinct sequences and reads by duplication level (the lower end of the level)."""
    n = F.col("n")
    level = F.lit(DUPLICATE_LEVELS[0])
    for low in DUPLICATE_LEVELS[1:]:
        level = F.when(n >= low, F.lit(low)).otherwise(level)
    return _copies(reads).groupBy(*KEY, level.alias("level")).agg(F.count(F.lit(1)).alias("sequences"), F.sum("n").alias("reads"))


def qc_overrepresented(reads: DataFrame, share: float = 0.001, min_copies: int = 1) -> DataFrame:
    """Sequences that make up more than ``share`` of the reads of their sample and mate."""
    totals = reads.groupBy(*KEY).agg(F.count(F.lit(1)).alias("_total"))
    found = _copies(reads).join(totals, KEY).withColumn("share", F.col("n") / F.col("_total"))
    # fewer than 1 / share for each sample and mate; only these are looked up as text
    found = found.filter((F.col("share") > share) & (F.col("n") >= min_copies)).drop("_total")
    told = found.select(*[F.col(c).alias(f"{c}_") for c in found.columns])
    own = [F.col(c) == F.col(f"{c}_") for c in (*KEY, "_digest")]
    texts = reads.select(*KEY, "seq", _digest()).join(told, own)
    return texts.groupBy(*KEY, "_digest").agg(F.min("seq").alias("seq"), F.min("n_").alias("n"), F.min("share_").alias("share")).drop("_digest")


class Automaton(NamedTuple):
    """Patterns as one table of states: the state after a character, the pattern that ends in a state (-1: none), and the
    nearest state in which a shorter pattern ends as well (0: none)."""

    letters: np.ndarray  # the patterns' characters, ascending; the table's last column stands for all others
    step: np.ndarray
    ends: np.ndarray
    shorter: np.ndarray
    length: np.ndarray  # of the patterns


def automaton(patterns: list[str]) -> Automaton:
    """The Aho-Corasick automaton of distinct, not empty patterns, as arrays."""
    coded = [np.frombuffer(p.encode("utf-32-le"), np.uint32) for p in patterns]
    letters = np.unique(np.concatenate(coded)) if coded else np.zeros(0, np.uint32)
    coded = [np.searchsorted(letters, c).tolist() for c in coded]
    other = len(letters)
    children: list[dict[int, int]] = [{}]
    ends = [-1]
    for i, pattern in enumerate(coded):
        at = 0
        for c in pattern:
            if c not in children[at]:
                children[at][c] = len(children)
                children.append({})
                ends.append(-1)
            at = children[at][c]
        ends[at] = i
    step = np.zeros((len(children), other + 1), np.int32)
    back = np.zeros(len(children), np.int64)
    shorter = np.zeros(len(children), np.int32)
    level = [0]
    while level:  # breadth first: the states behind are complete
        following = []
        for at in level:
            if at:
                step[at] = step[back[at]]
            for c, child in children[at].items():
                back[child] = step[back[at], c] if at else 0
                step[at, c] = child
                shorter[child] = back[child] if ends[back[child]] >= 0 else shorter[back[child]]
                following.append(child)
        level = following
    return Automaton(letters, step, np.array(ends, np.int32), shorter, np.array([len(p) for p in coded], np.int64))


_PIECE = 1 << 11  # letters that are walked in a row; the pieces of longer texts are walked side by side


def first_hits(texts: list[str], machine: Automaton) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, pattern, start from 1) of the first hit of every pattern in every text; all texts are walked side by side, long
    ones in pieces, each of which goes on into the next one as far as a hit can reach."""
    reach = int(machine.length.max(initial=1)) - 1
    step = max(_PIECE, 4 * reach)
    of = [(i, at) for i, t in enumerate(texts) for at in range(0, max(1, len(t) - reach), step)]
    texts = [texts[i][at : at + step + reach] for i, at in of]
    codes = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)
    column = np.searchsorted(machine.letters, codes)
    inside = column < len(machine.letters)
    inside[inside] = machine.letters[column[inside]] == codes[inside]
    column = np.where(inside, column, len(machine.letters))
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    begin = np.cumsum(lengths) - lengths
    order = np.argsort(-lengths, kind="stable")
    open_texts = np.searchsorted(-lengths[order], -np.arange(int(lengths.max(initial=0))), "left")  # texts longer than a position
    state = np.zeros(len(texts), np.int64)
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for at, n in enumerate(open_texts.tolist()):
        own = order[:n]
        now = machine.step[state[:n], column[begin[own] + at]]
        state[:n] = now
        hit = np.flatnonzero((machine.ends[now] >= 0) | (machine.shorter[now] > 0))
        now = now[hit]
        while len(hit):
            full = machine.ends[now] >= 0
            pattern = machine.ends[now[full]]
            found.append((own[hit[full]], pattern, at + 2 - machine.length[pattern]))
            now = machine.shorter[now]
            hit, now = hit[now > 0], now[now > 0]
    piece, pattern, start = (np.concatenate(c).astype(np.int64) for c in zip(*found, strict=True)) if found else (np.zeros(0, np.int64),) * 3
    owner, offset = np.array(of, np.int64).reshape(-1, 2).T
    text, start = owner[piece], start + offset[piece]
    order = np.lexsort((start, pattern, text))
    text, pattern, start = text[order], pattern[order], start[order]
    _, first = np.unique(text * max(1, len(machine.length)) + pattern, return_index=True)
    return text[first], pattern[first], start[first]


#: Characters of adapters whose automaton is held at a time; further adapters take another pass over the reads.
_GROUP = 1 << 18


def qc_adapter_content(reads: DataFrame, adapters: DataFrame, group: int = _GROUP) -> DataFrame:
    """Share of reads that contain an adapter starting at or before a position, at every position where one starts.

    The adapters' automaton reads every read once, however many adapters there are (up to ``group`` characters of them a
    pass). Null and empty adapters are in no read.
    """
    spark = reads.sparkSession
    listed = adapters.select(F.col("name").alias("adapter"), "seq").filter(F.length("seq") > 0).distinct()
    kinds = reads.schema
    names = ", ".join(f"{c} {kinds[c].dataType.simpleString()}" for c in KEY)

    def starts_of(patterns: list[str]) -> DataFrame:
        sent = spark.sparkContext.broadcast((patterns, automaton(patterns)))  # at most ``group`` states and one longer adapter

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            seqs, machine = sent.value
            for batch in batches:
                for first in range(0, batch.num_rows, 2048):
                    part = batch.slice(first, 2048)
                    text, pattern, start = first_hits([x or "" for x in part.column(len(KEY)).to_pylist()], machine)
                    at = pa.array(text)
                    yield pa.RecordBatch.from_arrays([*[c.take(at) for c in part.columns[: len(KEY)]], pa.array(seqs, pa.string()).take(pa.array(pattern)), pa.array(start)], names=[*KEY, "seq", "pos"])

        found = reads.select(*KEY, "seq").mapInArrow(run, f"{names}, seq string, pos long")
        return found.groupBy(*KEY, "seq", "pos").agg(F.count(F.lit(1)).alias("_n"))

    starts, held, size = None, [], 0
    for row in [*listed.select("seq").distinct().orderBy("seq").toLocalIterator(), None]:
        if held and (row is None or size + len(row["seq"]) > group):
            part = starts_of(held)
            starts = part if starts is None else starts.unionByName(part)
            held, size = [], 0
        if row is not None:
            held.append(row["seq"])
            size += len(row["seq"])
    if starts is None:
        starts = spark.createDataFrame([], f"{names}, seq string, pos long, _n long")
    starts = starts.join(listed, "seq").drop("seq")
    totals = reads.groupBy(*KEY).agg(F.count(F.lit(1)).alias("_total"))
    # one row per position: bounded by the read length
    upto = Window.partitionBy(*KEY, "adapter").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    summed = starts.groupBy(*KEY, "adapter", "pos").agg(F.sum("_n").alias("_n"))
    return summed.join(totals, KEY).select(
        *KEY, "adapter", F.col("pos").cast("int").alias("pos"), (F.sum("_n").over(upto) / F.col("_total")).alias("share")
    )


def qc_modules(reads: DataFrame, adapters: DataFrame | None = None) -> dict[str, tuple[DataFrame, str | None, str | None]]:
    """Every module of the report as (table, label column, bucket column); adapter content needs the adapters (name, seq).

    The letters and qualities are counted once, for all modules that ask where they stand.
    """
    qualities, bases = stage(_tile_counts(reads)), stage(_base_counts(reads))
    everywhere = qualities.groupBy(*KEY, "pos", "c").agg(F.sum("n").alias("n"))
    modules = {
        "basic_stats": (qc_basic_stats(reads), None, None),
        "base_quality": (_base_quality(everywhere), None, "pos"),
        "tile_quality": (_tile_quality(qualities), "tile", "pos"),
        "sequence_quality": (qc_sequence_quality(reads), None, "mean_quality"),
        "base_content": (_base_content(bases), None, "pos"),
        "gc_content": (qc_gc_content(reads), None, "gc_percent"),
        "n_content": (_n_content(bases), None, "pos"),
        "length_distribution": (qc_length_distribution(reads), None, "length"),
        "duplication": (qc_duplication(reads), None, "level"),
        "overrepresented": (qc_overrepresented(reads), "seq", None),
    }
    if adapters is not None:
        modules["adapter_content"] = (qc_adapter_content(reads, adapters), "adapter", "pos")
    return modules


def qc_merge(stages: dict[str, DataFrame], adapters: DataFrame | None = None) -> DataFrame:
    """One report over all samples and stages: (stage, sample, mate, module, label, bucket, metric, value).

    The label is a tile, sequence or adapter, the bucket a position or class; either is null where a module has none.
    """
    out = None
    for name, reads in stages.items():
        for module, (table, label, bucket) in qc_modules(reads, adapters).items():
            metrics = [c for c in table.columns if c not in (*KEY, label, bucket)]
            part = table.select(
                F.lit(name).alias("stage"),
                *KEY,
                F.lit(module).alias("module"),
                (F.col(label) if label else F.lit(None)).cast("string").alias("label"),
                (F.col(bucket) if bucket else F.lit(None)).cast("double").alias("bucket"),
                *[F.col(c).cast("double").alias(c) for c in metrics],
            ).unpivot(["stage", *KEY, "module", "label", "bucket"], metrics, "metric", "value")
            out = part if out is None else out.unionByName(part)
    return out
