"""Alignment of two tokenizers by pointer jumping.

A byte-level BPE file (A, tokenizers) and a sentencepiece model (B) cut the same bytes, a space and the text. Every token
points to its farthest-right overlapping token of the other side, tokens that end together to B's, which points to
itself. Doubling the pointers (succ = succ[succ]) for all tokens of a slice at once ends at each component's last token,
the label of its group: the groups lie between the offsets where both sides end. Tokens that overlap are linked.

Texts are first cut before spaces where neither side has a token or merge across (see ``_cut``); each distinct piece is
aligned once and remembered within a worker. The links of a block of texts are held as positions in the block's list of
distinct id pairs; only these lists are counted over the corpus, and only they fetch the counts back. A block holds
``BLOCK_LINKS`` links, or one longer text.

Null and empty texts have no tokens, and neither have those whose tokens do not join to the space and the text on both
sides (for instance if they hold U+2581): zeros, no groups. Every row is a document, also repeated rows and null ids, and
counts each time. An empty table gives no rows. Columns of the input are kept apart; those named like a result column
are replaced. A text's tokens are held in one task, some 40 bytes for each byte of the text.
"""

from __future__ import annotations

import itertools
import json
import re
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F
from tokenizers import Tokenizer

from . import folders, texts
from .pieces import Pieces

#: Links of a block of texts; bounds a task's memory.
BLOCK_LINKS = 3_000_000
#: Pieces that a worker remembers before it starts afresh; about 150 bytes each.
CAPACITY = 250_000
_CHUNK = 4096
#: Last bytes of the UTF-8 forms of white space beyond ASCII (U+0085, U+00A0, U+1680, U+2000 to U+200A, U+2028, U+2029, U+202F, U+205F, U+3000).
_WIDE_SPACE_END = np.isin(np.arange(256), [0x85, 0xA0, *range(0x80, 0x8B), 0xA8, 0xA9, 0xAF, 0x9F])
RESULT = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups")


class Groups(NamedTuple):
    """Of two token sequences over the same bytes: the group of every A and B token (numbered in order) and all links."""

    of_a: np.ndarray
    of_b: np.ndarray
    link_a: np.ndarray
    link_b: np.ndarray
    link_end: np.ndarray


def jump(end_a: np.ndarray, end_b: np.ndarray) -> Groups:
    """Align by the ends of the tokens (ascending, the last ones equal)."""
    n_a, n_b = len(end_a), len(end_b)
    over_a = np.searchsorted(end_b, end_a, "left")  # the B token that holds the last byte of an A token
    over_b = np.searchsorted(end_a, end_b, "left")
    last = end_a[over_b] == end_b if n_a else np.zeros(n_b, bool)
    succ = np.concatenate([n_a + over_a, np.where(last, n_a + np.arange(n_b), over_b)])
    while True:
        further = succ[succ]
        if np.array_equal(further, succ):
            break
        succ = further
    number = np.cumsum(last) - 1
    group = number[succ - n_a]
    # the stretches between neighbouring ends of either side: each lies in one A and one B token that overlap there
    ends = np.sort(np.concatenate([end_a, end_b]), kind="stable")
    ends = ends[np.append(True, ends[1:] != ends[:-1])] if len(ends) else ends
    return Groups(group[:n_a], group[n_a:], np.searchsorted(end_a, ends, "left"), np.searchsorted(end_b, ends, "left"), ends)


def _spread(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The positions of all ranges, one after the other."""
    before = np.cumsum(length) - length
    return np.repeat(start - before, length) + np.arange(int(length.sum()))


class _Ragged:
    """Rows of values of any length, appended in amortised time."""

    def __init__(self, kind: type):
        self.values, self.bounds, self.rows = np.zeros(1024, kind), np.zeros(1024, np.int64), 0

    def append(self, values: np.ndarray, lengths: np.ndarray) -> None:
        used = int(self.bounds[self.rows])
        if used + len(values) > len(self.values):
            self.values = np.concatenate([self.values[:used], np.zeros(max(used, len(values)) + len(values), self.values.dtype)])
        if self.rows + len(lengths) >= len(self.bounds):
            self.bounds = np.concatenate([self.bounds[: self.rows + 1], np.zeros(max(self.rows, len(lengths)) + len(lengths), np.int64)])
        self.values[used : used + len(values)] = values
        self.bounds[self.rows + 1 : self.rows + 1 + len(lengths)] = used + np.cumsum(lengths)
        self.rows += len(lengths)

    def take(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        length = self.bounds[rows + 1] - self.bounds[rows]
        return self.values[_spread(self.bounds[rows], length)], length


def _listed(entries: list[bytes]) -> _Ragged:
    out = _Ragged(np.uint8)
    out.append(np.frombuffer(b"".join(entries), np.uint8), np.fromiter(map(len, entries), np.int64, len(entries)))
    out.bounds = out.bounds[: out.rows + 1]
    return out


def _joined(ids: list[list[int]], entries: _Ragged, data: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All ids, their number for each piece, and whether they join to it; the pieces are stretches of ``data``."""
    count = np.fromiter(map(len, ids), np.int64, len(ids))
    flat = np.fromiter(itertools.chain.from_iterable(ids), np.int64, int(count.sum()))
    of = np.repeat(np.arange(len(ids)), count)
    total = np.bincount(of, weights=np.diff(entries.bounds)[flat], minlength=len(ids)).astype(np.int64)
    sound = total == size
    made, length = entries.take(flat[sound[of]])
    wrong = made != data[np.repeat(sound, size)]
    if wrong.any():
        sound[np.repeat(of[sound[of]], length)[wrong]] = False
    return flat, count, sound


def _byte_letters() -> dict[str, int]:
    """The letters by which byte-level vocabularies write the 256 bytes."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Aligned(NamedTuple):
    """Of the texts of a slice: numbers, the groups' text, and all links as id pairs (a * B's size + b) with their text."""

    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    text: np.ndarray
    text_bounds: np.ndarray
    pair: np.ndarray
    pair_of: np.ndarray


class Aligner(Pieces):
    """Aligns the texts of a slice; one per worker."""

    def __init__(self, a_path: str, b_path: str, capacity: int = CAPACITY):
        super().__init__({}, capacity)
        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        self.a.no_truncation()
        self.a.no_padding()
        letters = _byte_letters()
        entries = {i: bytes(map(letters.__getitem__, t)) if all(c in letters for c in t) else t.encode() for t, i in self.a.get_vocab(True).items()}
        self.a_bytes = _listed([entries.get(i, b"") for i in range(max(entries) + 1)])
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        self.b_size = self.b.get_piece_size()
        pieces = [self.b.id_to_piece(i) for i in range(self.b_size)]
        self.b_bytes = _listed([bytes([int(p[3:5], 16)]) if re.fullmatch("<0x[0-9A-Fa-f]{2}>", p) else p.replace("▁", " ").encode() for p in pieces])
        self.decimal = _listed([b"%d" % i for i in range(max(self.a_bytes.rows, self.b_size))])
        spec = json.loads(self.a.to_str())
        pre = spec.get("pre_tokenizer") or {}
        words = pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space") and not spec.get("normalizer")
        # a piece with a space behind another character would reach over a cut
        self.lone_space = self.b.encode("a ")[len(self.b.encode("a")) :]
        self.cuttable = bool(words) and not any(re.search(r"[^▁]▁", p) for p in pieces)
        self.forget()

    def forget(self) -> None:
        self.pairs, self.strings, self.numbers = _Ragged(np.int64), _Ragged(np.uint8), _Ragged(np.int32)

    def cut(self, t: texts.Texts) -> tuple[np.ndarray, np.ndarray]:
        """Byte ranges of the pieces: cut before a run of spaces behind anything that is no white space.

        A's words end there, because only a run of white space or one leading space takes white space in; B's tokens do
        by ``cuttable``. Where a byte may end wide white space, the text is not cut.
        """
        data = t.data
        start = np.zeros(len(data) + 1, bool)
        start[t.bounds] = True
        if self.cuttable and len(data) > 2:
            before, two = data[1:-1], data[:-2]
            solid = ~texts.SPACE[before] & (before > 32) & (before != 127)
            solid &= (before < 128) | ~_WIDE_SPACE_END[before] | ((two >= 0xC3) & (two < 0xE0))
            start[2:-1] |= (data[2:] == 32) & solid
        at = np.flatnonzero(start)
        return at[:-1], at[1:]

    def learn(self, pieces: list[str]) -> None:
        """Align new pieces: numbers (A tokens, B tokens, groups, whether the tokens join to the piece), pairs, groups' text."""
        n = len(pieces)
        raw = "".join(pieces).encode()
        size = np.fromiter((len(p) if p.isascii() else len(p.encode()) for p in pieces), np.int64, n)
        ids_a = [e.ids for e in self.a.encode_batch_fast(pieces, add_special_tokens=False)]
        # B puts a space before what it is given, but not before nothing
        ids_b = [self.lone_space if p == " " else own for p, own in zip(pieces, self.b.encode([p[1:] for p in pieces], num_threads=1), strict=True)]
        data = np.frombuffer(raw, np.uint8)
        a, n_a, sound_a = _joined(ids_a, self.a_bytes, data, size)
        b, n_b, sound_b = _joined(ids_b, self.b_bytes, data, size)
        sound = sound_a & sound_b
        a, b = a[np.repeat(sound, n_a)], b[np.repeat(sound, n_b)]
        n_a, n_b, size = n_a * sound, n_b * sound, size * sound
        end_a, end_b = (np.cumsum(np.diff(t.bounds)[i]) for t, i in ((self.a_bytes, a), (self.b_bytes, b)))
        found = jump(end_a, end_b)
        link_piece = np.searchsorted(np.cumsum(size), found.link_end, "left")
        self.pairs.append(a[found.link_a] * self.b_size + b[found.link_b], np.bincount(link_piece, minlength=n))
        # "a1,a2|b1;": the tokens of a group, A's before B's, each with the mark behind it
        group = np.concatenate([found.of_a, found.of_b])
        side = np.repeat([0, 1], [len(a), len(b)])
        order = np.argsort(2 * group + side, kind="stable")
        group, side = group[order], side[order]
        same = np.zeros(len(order), bool)
        same[:-1] = (group[1:] == group[:-1]) & (side[1:] == side[:-1])
        digits, length = self.decimal.take(np.concatenate([a, b])[order])
        written = np.empty(len(digits) + len(order), np.uint8)
        is_mark = np.zeros(len(written), bool)
        is_mark[np.cumsum(length + 1) - 1] = True
        written[is_mark] = np.frombuffer(b"|;,", np.uint8)[np.where(same, 2, side)]
        written[~is_mark] = digits
        piece = np.concatenate([np.repeat(np.arange(n), n_a), np.repeat(np.arange(n), n_b)])[order]
        self.strings.append(written, np.bincount(piece, weights=length + 1, minlength=n).astype(np.int64))
        last = np.ones(len(b), bool)
        last[:-1] = np.diff(found.of_b) > 0  # a group's last B token
        groups = np.bincount(np.repeat(np.arange(n), n_b)[last], minlength=n)
        self.numbers.append(np.stack([n_a, n_b, groups, sound], axis=1).ravel().astype(np.int32), np.full(n, 4))

    def align(self, t: texts.Texts) -> Aligned:
        n, size = len(t), np.diff(t.bounds)
        spaced = texts.Texts(t.first, np.insert(t.data, t.bounds[:-1], np.uint8(32)), t.bounds + np.arange(n + 1))
        number, of = self.of(spaced, self.learn, self.forget)
        numbers = self.numbers.values[: 4 * self.numbers.rows].reshape(-1, 4)
        none = size == 0
        none[of[numbers[number, 3] == 0]] = True
        stays = ~none[of]
        number, of = number[stays], of[stays]
        n_a, n_b, n_groups = (np.bincount(of, weights=numbers[number, k], minlength=n).astype(np.int64) for k in range(3))
        pair, length = self.pairs.take(number)
        text, chars = self.strings.take(number)
        total = np.bincount(of, weights=chars, minlength=n).astype(np.int64)
        bounds = np.concatenate([[0], np.cumsum(total)])
        keep = np.ones(len(text), bool)
        keep[bounds[1:][total > 0] - 1] = False  # no mark behind a text's last group
        text_bounds = np.concatenate([[0], np.cumsum(np.maximum(total - 1, 0))])
        return Aligned(n_a, n_b, n_groups, text[keep], text_bounds, pair, np.repeat(of, length))


_aligners: dict[tuple[str, str], Aligner] = {}


def aligner(a_path: str, b_path: str) -> Aligner:
    if (a_path, b_path) not in _aligners:
        _aligners[a_path, b_path] = Aligner(a_path, b_path)
    return _aligners[a_path, b_path]


def _planes(values: np.ndarray) -> bytes:
    """32-bit values by their lowest bytes, then the next ones and so on, which compresses well."""
    return values.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def _from_planes(content: bytes) -> np.ndarray:
    return np.frombuffer(content, np.uint8).reshape(4, -1).T.copy().view("<u4").ravel().astype(np.int64)


class _Block:
    """The aligned texts of a block and their distinct links."""

    def __init__(self) -> None:
        self.rows: list[pa.Array] = []
        self.parts: list[Aligned] = []
        self.pairs: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = []
        self.links = 0

    def add(self, rows: pa.Array, part: Aligned) -> None:
        order = np.lexsort((part.pair, part.pair_of))
        pair, of = part.pair[order], part.pair_of[order]
        new = np.ones(len(pair), bool)
        new[1:] = (pair[1:] != pair[:-1]) | (of[1:] != of[:-1])
        at = np.flatnonzero(new)
        n = len(part.n_a)
        self.rows.append(rows)
        self.parts.append(part._replace(pair=pair[:0], pair_of=of[:0]))
        self.pairs.append((pair[at], np.diff(np.append(at, len(pair))), np.bincount(of[at], minlength=n), np.bincount(of, minlength=n)))
        self.links += len(pair)

    def written(self, block: int, names: list[str], row_type: pa.DataType) -> Iterator[pa.RecordBatch]:
        pair = np.concatenate([p[0] for p in self.pairs])
        times = np.concatenate([p[1] for p in self.pairs])
        distinct, place = np.unique(pair, return_inverse=True)
        total = np.bincount(place, weights=times, minlength=len(distinct)).astype(np.int64)
        starts = list(range(0, len(distinct), _CHUNK))
        rows = len(starts)
        nothing = {"row": pa.nulls(rows, row_type), "groups": pa.nulls(rows, pa.string()), "places": pa.nulls(rows, pa.binary()), "times": pa.nulls(rows, pa.binary())}
        nothing |= {k: pa.nulls(rows, pa.int64()) for k in ("n_a", "n_b", "n_groups", "n_links")}
        lists = pa.array(np.append(starts, len(distinct)).astype(np.int32))
        listed = nothing | {
            "block": pa.array(np.full(rows, block)),
            "start": pa.array(starts, pa.int64()),
            "pair": pa.ListArray.from_arrays(lists, pa.array(distinct)),
            "total": pa.ListArray.from_arrays(lists, pa.array(total)),
        }
        if rows:
            yield pa.RecordBatch.from_arrays([listed[c] for c in names], names=names)
        first, seq = 0, 0
        for own, part, (_, _, distinct_of, links) in zip(self.rows, self.parts, self.pairs, strict=True):
            places, many = [], []
            for m in distinct_of.tolist():
                p = place[first : first + m]
                places.append(_planes(np.diff(p, prepend=0)))
                many.append(_planes(times[first : first + m]))
                first += m
            n = len(own)
            groups = pa.LargeStringArray.from_buffers(n, pa.py_buffer(part.text_bounds.astype(np.int64)), pa.py_buffer(part.text)).cast(pa.string())
            docs = {"block": pa.array(np.full(n, block)), "start": pa.array(seq + np.arange(n)), "row": own, "groups": groups, "places": pa.array(places, pa.binary()), "times": pa.array(many, pa.binary())}
            docs |= {"n_a": pa.array(part.n_a), "n_b": pa.array(part.n_b), "n_groups": pa.array(part.n_groups), "n_links": pa.array(links)}
            docs |= {"pair": pa.nulls(n, pa.list_(pa.int64())), "total": pa.nulls(n, pa.list_(pa.int64()))}
            yield pa.RecordBatch.from_arrays([docs[c] for c in names], names=names)
            seq += n


def align(
    docs: DataFrame,
    a_path: str,
    b_path: str,
    text: str = "text",
    columns: tuple[str, ...] | None = None,
    describe: Callable[[Column], Column] | None = None,
    block_links: int = BLOCK_LINKS,
) -> DataFrame:
    """The columns (all, or ``columns``) with n_a, n_b, n_groups, n_links, n_best, count_sum and groups.

    groups is ``a1,a2|b1;a3|b2,b3``: the ids of A and B in each group, in order. An id pair's count is the number of links
    in all rows that hold it; count_sum adds the counts of a row's links, n_best counts those whose pair has the highest
    count of its B id (ties included). ``describe`` maps the groups' text before anything is stored, for callers that
    need a digest only. The paths must be readable by every executor.
    """
    names = [c for c in (docs.columns if columns is None else columns) if c not in RESULT]
    chosen = docs.select(F.struct(*names).alias("row") if names else F.struct(F.lit(0).alias("_")).alias("row"), F.col(text).alias("text"))
    row_type = chosen.schema["row"].dataType.simpleString()
    inner = ["block", "start", "row", "n_a", "n_b", "n_groups", "n_links", "groups", "places", "times", "pair", "total"]
    schema = f"block long, start long, row {row_type}, n_a long, n_b long, n_groups long, n_links long, groups string, places binary, times binary, pair array<long>, total array<long>"

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = aligner(a_path, b_path)
        next_block, block = TaskContext.get().partitionId() << 32, _Block()
        for batch in batches:
            kind = batch.column(0).type
            for t in texts.slices(batch.column(1)):
                block.add(batch.column(0).slice(t.first, len(t)), own.align(t))
                if block.links >= block_links:
                    yield from block.written(next_block, inner, kind)
                    next_block, block = next_block + 1, _Block()
        if block.rows:
            yield from block.written(next_block, inner, kind)

    encoded = chosen.mapInArrow(encode, schema)
    if describe is not None:
        encoded = encoded.withColumn("groups", describe(F.col("groups")))
    encoded = folders.save(encoded, "aligned")
    lists = encoded.filter("pair is not null").select("block", "start", F.posexplode(F.arrays_zip("pair", "total")).alias("i", "x"))
    lists = lists.select("block", (F.col("start") + F.col("i")).alias("start"), F.col("x.pair").alias("pair"), F.col("x.total").alias("total"))
    counts = folders.save(lists.groupBy("pair").agg(F.sum("total").alias("n")), "pair-counts")
    b_id = F.col("pair") % F.lit(sentencepiece.SentencePieceProcessor(model_file=b_path).get_piece_size())
    # one row for each id of B at most: the size of its vocabulary bounds the broadcast
    most = counts.groupBy(b_id.alias("b")).agg(F.max("n").alias("most"))
    valued = counts.join(F.broadcast(most), b_id == F.col("b")).select("pair", (2 * F.col("n") + (F.col("n") == F.col("most")).cast("long")).alias("value"))
    fetched = lists.join(valued, "pair").select("block", F.lit(0).alias("kind"), "start", "value", *[F.lit(None).cast(kind).alias(c) for c, kind in encoded.select(*inner[2:10]).dtypes])
    texts_ = encoded.filter("pair is null").select("block", F.lit(1).alias("kind"), "start", F.lit(None).cast("long").alias("value"), *inner[2:10])
    merged = fetched.unionByName(texts_).repartition("block").sortWithinPartitions("block", "kind", "start")
    result_type = encoded.schema["groups"].dataType.simpleString()
    result = ["row", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups"]
    out_schema = f"row {row_type}, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups {result_type}"

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        values: list[np.ndarray] = []
        at, filled = None, False  # the block whose values are held; whether texts of it have come
        for batch in batches:
            blocks, kinds = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            runs = np.flatnonzero((np.diff(blocks) != 0) | (np.diff(kinds) != 0)) + 1
            for a, b in zip(np.append(0, runs).tolist(), np.append(runs, len(blocks)).tolist(), strict=True):
                if a == b:
                    continue
                if blocks[a] != at:
                    values, at, filled = [], blocks[a], False
                if kinds[a] == 0:
                    values.append(batch.column(3).slice(a, b - a).to_numpy())
                    continue
                if not filled:
                    values, filled = [np.concatenate(values) if values else np.zeros(0, np.int64)], True
                part = batch.slice(a, b - a)
                best, total = [], []
                for places, times in zip(part.column(10).to_pylist(), part.column(11).to_pylist(), strict=True):
                    value, many = values[0][np.cumsum(_from_planes(places))], _from_planes(times)
                    best.append(int((many * (value & 1)).sum()))
                    total.append(int((many * (value >> 1)).sum()))
                columns = [*part.columns[4:9], pa.array(best, pa.int64()), pa.array(total, pa.int64()), part.column(9)]
                yield pa.RecordBatch.from_arrays(columns, names=result)

    added = merged.mapInArrow(add_up, out_schema)
    return added.select(*[F.col(f"row.{c}" if c.isidentifier() else f"row.`{c}`") for c in names], *result[1:])
