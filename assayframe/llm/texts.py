"""Texts of Arrow batches as byte arrays: words, word hashes and shingles, computed with numpy for many texts at once.

A word is a run of ASCII letters, digits, underscores and non-ASCII characters; ASCII letters are compared in lower
case. A null text counts as an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text that are held as arrays at a time; one longer text is taken alone.
SLICE_BYTES = 1 << 20

_CODES = np.arange(256, dtype=np.uint8)
LOWER = np.where((_CODES >= 65) & (_CODES <= 90), _CODES + 32, _CODES).astype(np.uint8)
UPPER_CASE = (_CODES >= 65) & (_CODES <= 90)
DIGIT = (_CODES >= 48) & (_CODES <= 57)
WORD = (UPPER_CASE | DIGIT) | ((_CODES >= 97) & (_CODES <= 122)) | (_CODES == 95) | (_CODES >= 128)
SPACE = (_CODES == 32) | ((_CODES >= 9) & (_CODES <= 13))

_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


class Texts(NamedTuple):
    """Rows ``first`` to ``first + len(bounds) - 1`` of a batch; text i is ``data[bounds[i]:bounds[i + 1]]``."""

    first: int
    data: np.ndarray
    bounds: np.ndarray

    def __len__(self) -> int:
        return len(self.bounds) - 1


class Words(NamedTuple):
    """Byte ranges and hashes of all words; those of text i are the range ``bounds[i]:bounds[i + 1]``."""

    start: np.ndarray
    end: np.ndarray
    bounds: np.ndarray
    hash: np.ndarray

    def text_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.bounds) - 1), np.diff(self.bounds))


def encoded(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column and its len + 1 offsets; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    return np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8), bounds


def slices(column: pa.Array, limit: int = SLICE_BYTES, rows: int = 1 << 20) -> Iterator[Texts]:
    """The column's texts in row order, in slices of at most ``limit`` bytes (one longer text by itself) and ``rows`` texts."""
    data, bounds = encoded(column)
    first, n = 0, len(bounds) - 1
    while first < n:
        last = max(first + 1, int(np.searchsorted(bounds, bounds[first] + limit, "right")) - 1)
        last = min(last, n, first + rows)
        yield Texts(first, data[bounds[first] : bounds[last]], bounds[first : last + 1] - bounds[first])
        first = last


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (the finaliser of splitmix64)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the hash base and of its inverse, modulo 2^64."""
    if len(_powers[0]) < n:
        size = max(n, SLICE_BYTES)
        both = []
        for base in (_BASE, _BASE_INVERSE):
            p = np.full(size, base, np.uint64)
            p[0] = 1
            both.append(np.multiply.accumulate(p))
        if size > 8 * SLICE_BYTES:
            return both[0][:n], both[1][:n]
        _powers[:] = both
    return _powers[0][:n], _powers[1][:n]


def range_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes of every range; equal bytes have equal hashes wherever they stand."""
    power, inverse = powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power[: len(data)], out=sums[1:])
    return mix((sums[end] - sums[start]) * inverse[start] + (end - start).astype(np.uint64))


def sequence_hashes(values: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the values of every range, in their order."""
    power, inverse = powers(len(values) + 1)
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * power[: len(values)], out=sums[1:])
    return mix((sums[end] - sums[start]) * inverse[start] + (end - start).astype(np.uint64))


def runs(flag: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of every run of true bytes; no run crosses from one text to the next."""
    before = np.zeros(len(flag), bool)
    before[1:] = flag[:-1]
    after = np.zeros(len(flag), bool)
    after[:-1] = flag[1:]
    inner = bounds[(bounds > 0) & (bounds < len(flag))]
    before[inner] = False
    after[inner - 1] = False
    return np.flatnonzero(flag & ~before), np.flatnonzero(flag & ~after) + 1


def words(texts: Texts) -> Words:
    start, end = runs(WORD[texts.data], texts.bounds)
    return Words(start, end, np.searchsorted(start, texts.bounds), range_hashes(LOWER[texts.data], start, end))


def shingles(w: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``size`` words and the text of each; a shorter text with words gives one run of all of them."""
    power, _ = powers(size + 1)
    n = np.diff(w.bounds)
    text = w.text_of()
    count = max(0, len(w.hash) - size + 1)
    total = np.zeros(count, np.uint64)
    for j in range(size):
        total += w.hash[j : j + count] * power[j]
    whole = text[:count] == text[len(text) - count :] if count else np.zeros(0, bool)
    short = np.flatnonzero((n > 0) & (n < size))
    rest = np.zeros(len(short), np.uint64)
    for j in range(size - 1):
        has = n[short] > j
        rest[has] += w.hash[w.bounds[short[has]] + j] * power[j]
    return np.concatenate([mix(total[whole]), mix(rest + n[short].astype(np.uint64))]), np.concatenate([text[:count][whole], short])


def longs(x: np.ndarray) -> np.ndarray:
    """Unsigned 64-bit values as Spark's signed ones."""
    return x.astype(np.uint64, copy=False).view(np.int64)
