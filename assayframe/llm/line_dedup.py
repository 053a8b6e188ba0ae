"""Line dedup with two Bloom filters.

Pass 1 fills two filters of a fixed size over all lines: hashes seen in one document, and hashes seen in two. Each task
fills its own pair; the pairs are merged piece by piece on the executors (twice = either twice, or both once). The merged
twice-filter, whose size is the parameter ``bits`` whatever the data, goes to every task. Pass 2 shuffles only the lines
that it holds (suspects: all repeated lines and a few others), counts their documents by the whole line, and so
confirms exactly. Too small a filter means more suspects, never another result.

A line's key is the line without white space ``[\\x20\\x09-\\x0D]`` at both ends and with A-Z in lower case. Every row is a
document, repeated rows too (``distinct_ids`` counts by id). A null or empty text is one empty line; keys shorter than ``min_chars`` code points are
never dropped. Null ids are allowed. Columns of the input are kept, those named like a result column are replaced.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from . import folders, texts

#: Bits of a filter (a power of two): 4 MB. About ten bits per distinct line keep the suspects few.
BITS = 1 << 25
_PIECE = 8192  # bytes of a filter that are merged together
_BLANK = " \t\n\v\f\r"
_LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def line_key(line: str) -> str:
    return line.strip(_BLANK).translate(_LOWER)


class Lines(NamedTuple):
    """Byte range in ``data`` (in lower case), hash and text of the key of every line that is not blank."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    text: np.ndarray


def line_keys(t: texts.Texts) -> Lines:
    data = texts.LOWER[t.data]
    start, end = texts.runs(data != 10, t.bounds)
    solid = np.flatnonzero(~texts.SPACE[data])
    lo, hi = np.searchsorted(solid, start), np.searchsorted(solid, end)
    some = hi > lo
    start, end = solid[lo[some]], solid[hi[some] - 1] + 1
    return Lines(data, start, end, texts.range_hashes(data, start, end), np.searchsorted(t.bounds, start, "right") - 1)


def probes(hashes: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    mask = np.uint64(bits - 1)
    return hashes & mask, (hashes >> np.uint64(32)) & mask


def holds(filled: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Whether the filter has every hash; 8 bits a byte."""
    out = np.ones(len(hashes), bool)
    for p in probes(hashes, 8 * len(filled)):
        out &= (filled[(p >> np.uint64(3)).astype(np.int64)] >> (p & np.uint64(7)).astype(np.uint8)) & 1 == 1
    return out


def put(filled: np.ndarray, hashes: np.ndarray) -> None:
    for p in probes(hashes, 8 * len(filled)):
        p = np.unique(p)
        at = (p >> np.uint64(3)).astype(np.int64)
        starts = np.flatnonzero(np.append(True, at[1:] != at[:-1])) if len(at) else at
        filled[at[starts]] |= np.bitwise_or.reduceat(np.uint8(1) << (p & np.uint64(7)).astype(np.uint8), starts) if len(at) else np.uint8(0)


def fill(batches: Iterator[pa.RecordBatch], bits: int) -> Iterator[pa.RecordBatch]:
    """One pair of filters for all the batches of a task, in pieces without the empty ones."""
    once, twice = np.zeros(bits // 8, np.uint8), np.zeros(bits // 8, np.uint8)
    for batch in batches:
        for t in texts.slices(batch.column(0)):
            lines = line_keys(t)
            order = np.lexsort((lines.text, lines.hash))
            h, text = lines.hash[order], lines.text[order]
            new = np.ones(len(h), bool)
            new[1:] = (h[1:] != h[:-1]) | (text[1:] != text[:-1])  # a document counts once
            distinct, count = np.unique(h[new], return_counts=True)
            put(twice, distinct[(count > 1) | holds(once, distinct)])
            put(once, distinct)
    yield from pieces(once, twice)


def pieces(once: np.ndarray, twice: np.ndarray) -> Iterator[pa.RecordBatch]:
    width = min(_PIECE, len(once))
    once, twice = once.reshape(-1, width), twice.reshape(-1, width)
    for part in np.array_split(np.flatnonzero(once.any(axis=1)), max(1, len(once) // 64)):
        yield pa.RecordBatch.from_arrays(
            [pa.array(part.astype(np.int64)), pa.array([zlib.compress(once[i], 1) for i in part], pa.binary()), pa.array([zlib.compress(twice[i], 1) for i in part], pa.binary())],
            names=["piece", "once", "twice"],
        )


def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pieces of a task, each merged; only as many are held as there are pieces."""
    once: dict[int, np.ndarray] = {}
    twice: dict[int, np.ndarray] = {}
    for batch in batches:
        for i, a, b in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            a, b = (np.frombuffer(zlib.decompress(x), np.uint8) for x in (a, b))
            if i in once:
                twice[i] |= b | (once[i] & a)
                once[i] |= a
            else:
                once[i], twice[i] = a.copy(), b.copy()
    for i in once:
        yield pa.RecordBatch.from_pydict({"piece": [i], "once": [zlib.compress(once[i], 1)], "twice": [zlib.compress(twice[i], 1)]})


def twice_filter(docs: DataFrame, text: str, bits: int) -> np.ndarray:
    schema = "piece long, once binary, twice binary"
    own = docs.select(text).mapInArrow(lambda it: fill(it, bits), schema)
    merged = own.repartition("piece").mapInArrow(merge, schema).select("piece", "twice")
    return collected(merged, bits)


def collected(merged: DataFrame, bits: int) -> np.ndarray:
    """A filter from its merged pieces (piece, bytes): at most ``bits`` bits reach the driver."""
    width = min(_PIECE, bits // 8)
    out = np.zeros((bits // 8 // width, width), np.uint8)
    for piece, content in merged.collect():
        out[piece] = np.frombuffer(zlib.decompress(content), np.uint8)
    return out.ravel()


def hash_filter(marks: DataFrame, bits: int) -> np.ndarray:
    """A filter of the 64-bit hashes of a one-column table; its tasks' parts are merged on the executors."""

    def fill_one(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filled = np.zeros(bits // 8, np.uint8)
        for batch in batches:
            put(filled, batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64))
        yield from pieces(filled, filled)

    schema = "piece long, once binary, twice binary"
    return collected(marks.mapInArrow(fill_one, schema).repartition("piece").mapInArrow(merge, schema).select("piece", "once"), bits)


def dedup_lines(
    docs: DataFrame,
    id_col: str = "doc_id",
    text: str = "text",
    min_docs: int = 2,
    min_chars: int = 1,
    keep: str = "none",
    bits: int = BITS,
    columns: tuple[str, ...] | None = None,
    distinct_ids: bool = False,
) -> DataFrame:
    """Drop the lines whose key is found in at least ``min_docs`` documents.

    ``keep="none"`` drops them in every document, ``"first"`` spares them in the document of the smallest id (nulls
    last; then by text hash; equal rows all keep the line). With ``distinct_ids`` rows of one id count as one document,
    rows without an id each as one. Returns the columns (all, or ``columns``) with ``text`` replaced and n_lines, n_dropped.

    Only texts that lose a line are shuffled and reach Python; which these may be says a third filter of ``bits`` bits.
    """
    if keep not in ("none", "first"):
        raise ValueError("keep is 'none' or 'first'")
    if min_docs < 2:
        raise ValueError("only lines of two documents and more are repeated")
    if bits < 64 or bits & (bits - 1) or bits > 1 << 32:
        raise ValueError("bits is a power of two from 64 to 2^32")
    spark = docs.sparkSession
    names = [c for c in (docs.columns if columns is None else columns) if c not in ("n_lines", "n_dropped")]
    docs = docs.select(*dict.fromkeys([*names, id_col, text]))
    seen_twice = spark.sparkContext.broadcast(twice_filter(docs, text, bits))
    out_names = list(dict.fromkeys([*names, text]))
    # the caller's columns are kept in a struct, apart from the names used here
    body = F.coalesce(F.col(text), F.lit(""))
    marked = docs.select(F.struct(*[c for c in out_names if c != text]).alias("row") if len(out_names) > 1 else F.lit(None).alias("row"), F.col(id_col).alias("id"), F.xxhash64(body, F.lit(7)).alias("h"), body.alias("text"))

    def suspects(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filled = seen_twice.value
        for batch in batches:
            ids, hs = batch.column(0), batch.column(1)
            for t in texts.slices(batch.column(2)):
                lines = line_keys(t)
                suspect = holds(filled, lines.hash)
                data = lines.data.tobytes()
                found = {
                    (i, data[a:b].decode())
                    for i, a, b in zip(lines.text[suspect].tolist(), lines.start[suspect].tolist(), lines.end[suspect].tolist(), strict=True)
                }
                found = sorted(x for x in found if len(x[1]) >= min_chars)
                keys, rows = [k for _, k in found], [t.first + i for i, _ in found]
                at = pa.array(rows, pa.int64())
                yield pa.RecordBatch.from_arrays([ids.take(at), hs.take(at), pa.array(keys, pa.string())], names=["_id", "_h", "_key"])

    id_type = docs.schema[id_col].dataType.simpleString()
    found = marked.select("id", "h", "text").mapInArrow(suspects, f"_id {id_type}, _h long, _key string")
    found = folders.save(found, "suspects")
    first = F.struct(F.col("_id").isNull(), "_id", "_h")
    if distinct_ids:
        each = found.groupBy("_key", "_id").agg(F.when(F.col("_id").isNull(), F.count(F.lit(1))).otherwise(1).alias("_n"), F.min(first).alias("_first"))
        counted = each.groupBy("_key").agg(F.sum("_n").alias("_n"), F.min("_first").alias("_first"))
    else:
        counted = found.groupBy("_key").agg(F.count(F.lit(1)).alias("_n"), F.min(first).alias("_first"))
    # both sides of the join are tables, so that Spark can split the rows of a very common line
    hits = found.join(folders.save(counted.filter(F.col("_n") >= min_docs), "confirmed"), "_key")
    if keep == "first":
        hits = hits.filter(~((F.col("_id").eqNullSafe(F.col("_first._id"))) & (F.col("_h") == F.col("_first._h"))))
    drops = folders.save(hits.groupBy("_id", "_h").agg(F.collect_set("_key").alias("_keys")).withColumnRenamed("_h", "_h2"), "dropped-lines")
    losing = spark.sparkContext.broadcast(hash_filter(drops.select(F.xxhash64("_id", "_h2")), bits))

    @F.pandas_udf("boolean")
    def may_lose(marks: pd.Series) -> pd.Series:
        return pd.Series(holds(losing.value, marks.to_numpy().view(np.uint64)))

    @F.pandas_udf("struct<text: string, n_dropped: long>")
    def rebuilt(bodies: pd.Series, keys: pd.Series) -> pd.DataFrame:
        kept, n_dropped = [], []
        for body_, own in zip(bodies, keys, strict=True):
            if own is None:
                kept.append(body_)
                n_dropped.append(0)
                continue
            lines, gone = body_.split("\n"), set(own)
            left = [x for x in lines if line_key(x) not in gone]
            kept.append("\n".join(left))
            n_dropped.append(len(lines) - len(left))
        return pd.DataFrame({"text": kept, "n_dropped": pd.Series(n_dropped, dtype=np.int64)})

    asked = marked.withColumn("may", may_lose(F.xxhash64("id", "h")))
    some = asked.filter("may")
    joined = some.join(drops, some["id"].eqNullSafe(drops["_id"]) & (some["h"] == drops["_h2"]), "left")
    n_lines = (F.length("text") - F.length(F.replace("text", F.lit("\n"), F.lit(""))) + 1).cast("long")
    changed = joined.select("row", n_lines.alias("n_lines"), rebuilt("text", "_keys").alias("new")).select("row", "new.text", "n_lines", "new.n_dropped")
    others = asked.filter("not may").select("row", "text", n_lines.alias("n_lines"), F.lit(0).cast("long").alias("n_dropped"))
    back = [F.col("text") if c == text else F.col("row").getField(c) for c in out_names]
    return changed.unionByName(others).select(*[x.alias(c) for c, x in zip(out_names, back, strict=True)], "n_lines", "n_dropped")
