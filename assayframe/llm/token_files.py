"""Token files: one long array of ids per file, with Elias-Fano coded document ends.

Layout of a file (little-endian): the magic ``EFTOKEN1``; six unsigned 64-bit numbers (documents, of these with a null
id, ids, bytes per id, smallest document id, largest minus smallest); the ids; the Elias-Fano code of the document ends;
that of the document ids less the smallest one. An Elias-Fano code of n non-decreasing values below u keeps
max(0, floor(log2(u / n))) low bits of each as they are and the high parts as unary gaps in a bit vector of at most
3 n bits, with the bit position of every 256th one as a 32-bit sample; ``select`` starts at a sample.

Null texts are empty; every document ends with the end id, so none has no ids. Documents are in ascending id order, null
ids first, equal ids by text. An empty table gives no files.
"""

from __future__ import annotations

import json
import posixpath
import struct
import uuid
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F
from tokenizers import Tokenizer

from . import folders, texts
from .pieces import Pieces

MAGIC = b"EFTOKEN1"
SAMPLE = 256
#: Ids of a file; a document is never split, so a longer one has a file of its own.
FILE_IDS = 4_000_000


class EliasFano:
    """Non-decreasing values in [0, universe], compressed; ``select(i)`` is the i-th one."""

    def __init__(self, n: int, universe: int, low: np.ndarray, high: np.ndarray, samples: np.ndarray):
        self.n, self.universe, self.low, self.high, self.samples = n, universe, low, high, samples
        self.bits = low_bits(n, universe)

    @classmethod
    def of(cls, values: np.ndarray, universe: int) -> EliasFano:
        n, bits = len(values), low_bits(len(values), universe)
        values = values.astype(np.uint64)
        low = (values[:, None] >> np.arange(bits, dtype=np.uint64)[None, :]) & np.uint64(1)
        ones = (values >> np.uint64(bits)).astype(np.int64) + np.arange(n)
        high = np.zeros(n + (universe >> bits) + 1, np.uint8)
        high[ones] = 1
        return cls(n, universe, np.packbits(low.astype(np.uint8).ravel(), bitorder="little"), np.packbits(high, bitorder="little"), ones[::SAMPLE].astype("<u4"))

    def to_bytes(self) -> bytes:
        return struct.pack("<5Q", self.n, self.universe, len(self.low), len(self.high), len(self.samples)) + self.low.tobytes() + self.high.tobytes() + self.samples.tobytes()

    @classmethod
    def from_bytes(cls, data: memoryview) -> tuple[EliasFano, int]:
        """The code that starts at the first byte, and its length in bytes."""
        n, universe, low, high, samples = struct.unpack_from("<5Q", data)
        a, b, c = 40, 40 + low, 40 + low + high
        end = c + 4 * samples
        return cls(n, universe, np.frombuffer(data[a:b], np.uint8), np.frombuffer(data[b:c], np.uint8), np.frombuffer(data[c:end], "<u4")), end

    def _low(self, first: int, count: int) -> np.ndarray:
        start, stop = first * self.bits, (first + count) * self.bits
        flat = np.unpackbits(self.low[start // 8 : -(-stop // 8)], bitorder="little")[start % 8 :][: stop - start]
        return flat.reshape(count, self.bits).astype(np.int64) @ (np.int64(1) << np.arange(self.bits, dtype=np.int64))

    def select(self, i: int) -> int:
        if not 0 <= i < self.n:
            raise IndexError(i)
        at, left = int(self.samples[i // SAMPLE]), i % SAMPLE
        byte, skip = at // 8, at % 8
        while True:
            window = np.unpackbits(self.high[byte : byte + 2 * SAMPLE], bitorder="little")
            window[:skip] = 0
            ones = np.flatnonzero(window)
            if left < len(ones):
                return ((byte * 8 + int(ones[left]) - i) << self.bits) + int(self._low(i, 1)[0])
            left, byte, skip = left - len(ones), byte + 2 * SAMPLE, 0

    def all(self) -> np.ndarray:
        high = np.flatnonzero(np.unpackbits(self.high, bitorder="little")) - np.arange(self.n)
        return (high << self.bits) + self._low(0, self.n)


def low_bits(n: int, universe: int) -> int:
    return max(0, (universe // n).bit_length() - 1) if n else 0


def file_parts(doc_ids: list[int | None], lengths: np.ndarray, ids: list[np.ndarray], width: int) -> list:
    """The parts of a file, in order; the ids stay in the pieces they came in."""
    known = np.array([d for d in doc_ids if d is not None], np.int64)
    least = int(known[0]) if len(known) else 0
    span = int(known[-1]) - least if len(known) else 0
    n_ids = int(lengths.sum())
    head = MAGIC + struct.pack("<4QqQ", len(doc_ids), len(doc_ids) - len(known), n_ids, width, least, span)
    return [head, *(x.data for x in ids), EliasFano.of(np.cumsum(lengths), n_ids).to_bytes(), EliasFano.of((known - least), span).to_bytes()]


class TokenFile:
    """A file's content; nothing is decoded before it is asked for."""

    def __init__(self, content: bytes):
        data = memoryview(content)
        if bytes(data[:8]) != MAGIC:
            raise ValueError("not a token file")
        self.n, self.n_null, self.n_ids, self.width, self.least, _ = struct.unpack_from("<4QqQ", data, 8)
        at = 56 + self.n_ids * self.width
        self.ids = np.frombuffer(data[56:at], f"<u{self.width}")
        self.ends, used = EliasFano.from_bytes(data[at:])
        self.known, _ = EliasFano.from_bytes(data[at + used :])

    def start(self, i: int) -> int:
        return self.ends.select(i - 1) if i else 0

    def document(self, i: int) -> np.ndarray:
        return self.ids[self.start(i) : self.ends.select(i)]

    def doc_ids(self) -> list[int | None]:
        return [None] * self.n_null + (self.known.all() + self.least).tolist()


class Encoder:
    """Ids of texts by the tokenizers library; white-space pieces already seen are looked up. One per worker."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            self.pieces = Pieces(json.load(f))
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        self.mark = self.tokenizer.encode("\0", add_special_tokens=False).ids
        self.forget()

    def forget(self) -> None:
        self.first = np.zeros(0, np.int32)
        self.length = np.zeros(0, np.int32)
        self.ids = np.zeros(0, np.uint32)

    def learn(self, pieces: list[str]) -> None:
        ids, length = self.joined(pieces) or self.each(pieces)
        self.first = np.concatenate([self.first, (len(self.ids) + np.cumsum(length) - length).astype(np.int32)])
        self.length = np.concatenate([self.length, length.astype(np.int32)])
        self.ids = np.concatenate([self.ids, ids])

    def each(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        got = [e.ids for e in self.tokenizer.encode_batch_fast(pieces, add_special_tokens=False)]
        length = np.fromiter(map(len, got), np.int64, len(got))
        return np.fromiter(chain.from_iterable(got), np.uint32, int(length.sum())), length

    def joined(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray] | None:
        """As ``each``, with many pieces in a text: a zero byte between white space is a token of its own, the mark between pieces."""
        if not self.pieces.separate or len(self.mark) != 1 or any("\0" in p for p in pieces):
            return None
        joined = [" \0 ".join(pieces[i : i + 500]) for i in range(0, len(pieces), 500)]
        ids = np.array([*chain.from_iterable([*e.ids, *self.mark] for e in self.tokenizer.encode_batch_fast(joined, add_special_tokens=False))], np.uint32)
        is_mark = ids == self.mark[0]
        length = np.diff(np.flatnonzero(is_mark), prepend=-1) - 1
        return (ids[~is_mark], length) if len(length) == len(pieces) else None

    def encode(self, t: texts.Texts, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """All ids, each text followed by the end id, and the length of each with it."""
        at, of = self.pieces.of(t, self.learn, self.forget)
        length = self.length[at].astype(np.int64)
        lengths = np.bincount(of, weights=length, minlength=len(t)).astype(np.int64) + 1
        out = np.full(int(lengths.sum()), end_id, np.uint32)
        before = np.cumsum(length) - length
        within = np.arange(int(length.sum()))
        out[within + np.repeat(of, length)] = self.ids[within + np.repeat(self.first[at] - before, length)]
        return out, lengths


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def place(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def put(folder: str, name: str, parts: list) -> None:
    """Write under a name of this attempt, then rename: a lost or doubled task never leaves half a file."""
    system, base = place(folder)
    own = posixpath.join(base, f"_{name}.{uuid.uuid4().hex}")
    with system.open_output_stream(own) as out:
        for part in parts:
            out.write(part)
    system.move(own, posixpath.join(base, name))


def write_token_files(
    docs: DataFrame, folder: str, tokenizer: str, end_id: int, id_col: str = "doc_id", text: str = "text", file_ids: int = FILE_IDS
) -> DataFrame:
    """Encode and write all documents to ``folder`` (a new one, shared by all executors); returns the file list.

    The list has name, part, seq (files ascend by both), n_docs, n_ids and start, the ids of all files before.
    """
    with open(tokenizer, encoding="utf-8"):
        size = max(Tokenizer.from_file(tokenizer).get_vocab_size(), end_id + 1)
    width = 2 if size <= 1 << 16 else 4
    rows = docs.select(docs[id_col].cast("long").alias("id"), docs[text].alias("text"))
    system, base = place(folder)
    system.create_dir(base, recursive=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, part = encoder(tokenizer), TaskContext.get().partitionId()
        doc_ids: list[int | None] = []
        lengths: list[np.ndarray] = []
        ids: list[np.ndarray] = []
        held, seq = 0, 0

        def flush() -> pa.RecordBatch:
            nonlocal doc_ids, lengths, ids, held, seq
            name = f"part-{part:06d}-{seq:05d}.eft"
            put(folder, name, file_parts(doc_ids, np.concatenate(lengths), ids, width))
            listed = pa.RecordBatch.from_pydict({"name": [name], "part": [part], "seq": [seq], "n_docs": [len(doc_ids)], "n_ids": [held]})
            doc_ids, lengths, ids, held, seq = [], [], [], 0, seq + 1
            return listed

        for batch in batches:
            for t in texts.slices(batch.column(1), texts.SLICE_BYTES // 2):
                new, n = own.encode(t, end_id)
                keys, cut = batch.column(0).slice(t.first, len(t)).to_pylist(), np.concatenate([[0], np.cumsum(n)])
                i = 0
                while i < len(t):
                    # as many documents as the file still takes, at least one if it is empty
                    j = int(np.searchsorted(cut, cut[i] + file_ids - held, "right")) - 1
                    if j <= i and held:
                        yield flush()
                        continue
                    j = min(max(j, i + 1), len(t))
                    doc_ids += keys[i:j]
                    lengths.append(n[i:j])
                    ids.append(new[cut[i] : cut[j]].astype(f"<u{width}"))
                    held += int(cut[j] - cut[i])
                    i = j
        if doc_ids:
            yield flush()

    ordered = rows.repartitionByRange("id").sortWithinPartitions(F.col("id").asc_nulls_first(), "text")
    listed = folders.save(ordered.mapInArrow(run, "name string, part long, seq long, n_docs long, n_ids long"), "files")
    # ids before a file: those of the parts before it (a row a part) and of the files before it in its part
    parts = listed.groupBy("part").agg(F.sum("n_ids").alias("n"))
    before = parts.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))
    inside = F.sum("n_ids").over(Window.partitionBy("part").orderBy("seq")) - F.col("n_ids")
    return listed.withColumn("inside", inside).join(before, "part").select("name", "part", "seq", "n_docs", "n_ids", (F.col("before") + F.col("inside")).alias("start"))


def read_token_files(listed: DataFrame, folder: str) -> DataFrame:
    """Per document, from the files: doc_id, start (ids of all documents before it), n_tokens, ids_crc32, file, place."""
    spark = listed.sparkSession
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.eft").load(folder).select(F.element_at(F.split("path", "/"), -1).alias("name"), "content")
    rows = files.join(listed.select("name", F.col("start").alias("file_start")), "name").select("name", "file_start", "content")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, start, content in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                f = TokenFile(content)
                ends = f.ends.all()
                starts = np.concatenate([[0], ends[:-1]])
                crc = [zlib.crc32(f.ids[a:b].astype("<u4").tobytes()) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(f.doc_ids(), pa.int64()),
                        pa.array(starts + start),
                        pa.array(ends - starts),
                        pa.array(crc, pa.int64()),
                        pa.array([name] * f.n, pa.string()),
                        pa.array(np.arange(f.n)),
                    ],
                    names=["doc_id", "start", "n_tokens", "ids_crc32", "file", "place"],
                )

    return rows.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long, file string, place long")
