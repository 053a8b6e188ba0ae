"""Token counts by rank-synchronous array merging.

The texts are cut into pre-tokens; the distinct new pre-tokens of a batch become one ragged numpy array of symbols, and
in each round every pre-token merges its lowest-ranked pair, all pre-tokens at once. The symbols that survive are
counted and the counts summed per text. Counts of white-space pieces are remembered within a worker (see ``pieces``).

Nulls and empty texts have no tokens. Rows keep their columns and their order; repeated rows are counted each.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, types as T
from tokenizers import Tokenizer

from . import texts
from .pieces import Pieces

_FAR = np.int64(1) << 40


class Merges(NamedTuple):
    """Merge rules as arrays, sorted by pair key."""

    key: np.ndarray
    rank: np.ndarray
    into: np.ndarray  # by rank
    singly: np.ndarray  # by rank: its symbol also has an earlier rule, so that one occurrence is merged at a time
    size: int


def merge_rules(model: dict) -> Merges:
    vocab = model["vocab"]
    size = max(vocab.values()) + 1
    pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
    left = np.array([vocab[a] for a, _ in pairs], np.int64)
    right = np.array([vocab[b] for _, b in pairs], np.int64)
    into = np.array([vocab[a + b] for a, b in pairs], np.int64)
    rank = np.arange(len(pairs))
    used = np.full(size, _FAR)
    np.minimum.at(used, left, rank)
    np.minimum.at(used, right, rank)
    key = left * size + right
    order = np.argsort(key)
    return Merges(key[order], rank[order], into, used[into] < rank, size)


def surviving(symbols: np.ndarray, lengths: np.ndarray, rules: Merges) -> np.ndarray:
    """Number of symbols of each sequence once no rule applies any more. All sequences have at least one symbol."""
    count = lengths.astype(np.int64).copy()
    alive = np.flatnonzero(lengths > 1)
    keep = np.repeat(lengths > 1, lengths)
    symbols, lengths = symbols[keep], lengths[alive]
    while len(alive):
        starts = np.cumsum(lengths) - lengths
        owner = np.repeat(np.arange(len(alive)), lengths)
        key = symbols[:-1] * rules.size + symbols[1:]
        at = np.minimum(np.searchsorted(rules.key, key), len(rules.key) - 1)
        hit = (rules.key[at] == key) & (owner[:-1] == owner[1:])
        rank = np.full(len(symbols), _FAR)
        rank[:-1][hit] = rules.rank[at[hit]]
        lowest = np.minimum.reduceat(rank, starts)
        take = np.flatnonzero((rank < _FAR) & (rank == lowest[owner]))
        # of overlapping occurrences (a a a) every second one, from the left
        new_run = np.ones(len(take), bool)
        new_run[1:] = take[1:] != take[:-1] + 1
        place = np.arange(len(take))
        take = take[(place - np.maximum.accumulate(np.where(new_run, place, 0))) % 2 == 0]
        # where the merged symbol may meet an earlier rule, only the leftmost occurrence
        first = np.ones(len(take), bool)
        first[1:] = owner[take[1:]] != owner[take[:-1]]
        take = take[first | ~rules.singly[rank[take]]]
        symbols[take] = rules.into[rank[take]]
        stays = np.ones(len(symbols), bool)
        stays[take + 1] = False
        lengths = np.bincount(owner[stays], minlength=len(alive))
        done = (lowest == _FAR) | (lengths == 1)
        count[alive] = lengths
        stays &= ~done[owner]
        symbols, alive, lengths = symbols[stays], alive[~done], lengths[~done]
    return count


class Counter:
    """Token counts of texts for a byte-level BPE tokenizer file (.json); one per worker."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        if model["type"] != "BPE" or model.get("ignore_merges") or model.get("continuing_subword_prefix") or model.get("dropout"):
            raise ValueError("only plain BPE models are counted")
        self.rules = merge_rules(model)
        self.tokenizer = Tokenizer.from_file(path)
        added = [t["content"] for t in spec.get("added_tokens") or []]
        self.added = re.compile("|".join(map(re.escape, sorted(added, key=len, reverse=True)))) if added else None
        self.pieces = Pieces(spec)
        suffix = model.get("end_of_word_suffix") or ""
        inner = {ord(s): i for s, i in model["vocab"].items() if len(s) == 1}
        last = {ord(s[0]): i for s, i in model["vocab"].items() if len(s) == 1 + len(suffix) and s[1:] == suffix}
        self.inner = np.zeros(max(inner) + 1, np.int64)
        self.inner[list(inner)] = list(inner.values())
        self.last = self.inner.copy()
        self.last[list(last)] = list(last.values())
        self.forget()

    def forget(self) -> None:
        self.counts = np.zeros(0, np.int64)

    def pre_tokens(self, text: str) -> list[str]:
        t = self.tokenizer
        text = t.normalizer.normalize_str(text) if t.normalizer else text
        return [w for w, _ in t.pre_tokenizer.pre_tokenize_str(text)] if t.pre_tokenizer else [text] if text else []

    def split(self, pieces: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """All pre-tokens, the piece of each, and the number of added tokens of each piece."""
        special = np.zeros(len(pieces), np.int64)
        words: list[str] = []
        n = np.zeros(len(pieces), np.int64)
        plain = self.pieces.separate and not any("\0" in p or (self.added and self.added.search(p)) for p in pieces)
        if plain:
            # one call for many pieces; a zero byte between white space is a pre-token of its own, the mark between pieces
            for first in range(0, len(pieces), 1000):
                some = pieces[first : first + 1000]
                all_words = self.pre_tokens(" \0 ".join(some))
                marks = np.flatnonzero(np.fromiter(map("Ā".__eq__, all_words), bool, len(all_words)))
                if len(marks) != len(some) - 1:
                    plain = False
                    break
                cut = np.concatenate([[-1], marks, [len(all_words)]])
                n[first : first + len(some)] = np.diff(cut) - 1
                words += [w for w in all_words if w != "Ā"]
        if not plain:
            words = []
            for i, piece in enumerate(pieces):
                parts = [piece]
                if self.added:
                    special[i] = len(self.added.findall(piece))
                    parts = self.added.split(piece)
                own = [w for part in parts if part for w in self.pre_tokens(part)]
                n[i] = len(own)
                words += own
        return words, np.repeat(np.arange(len(pieces)), n), special

    def learn(self, pieces: list[str]) -> None:
        words, of, special = self.split(pieces)
        number = {w: i for i, w in enumerate(dict.fromkeys(words))}
        distinct = list(number)
        if distinct:
            codes = np.frombuffer("".join(distinct).encode("utf-32-le"), np.uint32)
            lengths = np.fromiter(map(len, distinct), np.int64, len(distinct))
            symbols = self.inner[codes]
            at = np.cumsum(lengths) - 1
            symbols[at] = self.last[codes[at]]
            count = surviving(symbols, lengths, self.rules)
            each = count[np.fromiter(map(number.__getitem__, words), np.int64, len(words))]
            special += np.bincount(of, weights=each, minlength=len(pieces)).astype(np.int64)
        self.counts = np.concatenate([self.counts, special])

    def count(self, t: texts.Texts) -> np.ndarray:
        number, of = self.pieces.of(t, self.learn, self.forget)
        return np.bincount(of, weights=self.counts[number], minlength=len(t)).astype(np.int64)


_counters: dict[str, Counter] = {}


def counter(path: str) -> Counter:
    if path not in _counters:
        _counters[path] = Counter(path)
    return _counters[path]


def count_tokens(docs: DataFrame, tokenizer: str, text: str = "text", limit: int = 2048, keep: tuple[str, ...] | None = None) -> DataFrame:
    """The columns ``keep`` (default: all) with n_bytes, n_tokens and over_limit (n_tokens > limit); columns of these names are replaced.

    ``tokenizer`` is the path of a .json file that every executor can read.
    """
    made = ("n_bytes", "n_tokens", "over_limit")
    kept = [c for c in (docs.columns if keep is None else keep) if c not in made]
    at = docs.columns.index(text)
    chosen = docs.select(*[docs[c] for c in kept], docs[docs.columns[at]].alias("_text_to_count"))
    schema = T.StructType(
        [*chosen.select(*kept).schema.fields, T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType()), T.StructField("over_limit", T.BooleanType())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = counter(tokenizer)
        for batch in batches:
            for t in texts.slices(batch.column(len(kept))):
                n, rows = own.count(t), batch.slice(t.first, len(t))
                yield pa.RecordBatch.from_arrays(
                    [*rows.columns[: len(kept)], pa.array(np.diff(t.bounds)), pa.array(n), pa.array(n > limit)], names=[*kept, *made]
                )

    return chosen.mapInArrow(run, schema)
