"""The distinct pieces of texts, remembered within a worker by a 128-bit hash in sorted arrays."""

from __future__ import annotations

import re
from collections.abc import Callable

import numpy as np

from . import texts

#: Pieces that a worker remembers before it starts afresh; bounds its memory (about 50 bytes each), not the result.
CAPACITY = 700_000

#: Pieces that are learnt at a time: the tokenizers library needs some 500 bytes for each meanwhile.
LEARN = 10_000


def drops_white_space(spec: dict) -> bool:
    """Whether white space only parts pre-tokens, so that a text may be cut there before anything else.

    ``spec`` is the content of a tokenizer's .json file. It holds if the pre-tokenizer first keeps nothing but the
    matches of a pattern that no white space matches.
    """
    pre = spec.get("pre_tokenizer") or {}
    first = (pre.get("pretokenizers") or [pre])[0]
    pattern = (first.get("pattern") or {}).get("Regex", "")
    keeps_matches = first.get("type") == "Split" and first.get("behavior") == "Removed" and first.get("invert")
    return bool(keeps_matches) and not re.search(pattern.replace(r"\p{L}", "a-z").replace(r"\p{N}", "0-9"), " \t\n\r\v\f")


#: Fixed value: the pattern of word-level byte-pair tokenizers in lower case (contractions, letters, one digit, other marks).
WORDS_AND_MARKS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


class Pieces:
    """Numbers the distinct pieces of texts in the order in which they are learnt.

    ``spec`` is the content of a tokenizer's .json file. Where its pre-tokens never hold white space, pieces are the runs
    without ASCII white space, else the whole texts that are not empty. With the pattern ``WORDS_AND_MARKS`` a run is cut
    again where ASCII letters and marks meet: a match of the pattern ends there in any case (apostrophes may belong to a
    contraction, and characters of added tokens to these, so neither counts as a mark). A normalizer to lower case makes
    pieces alike that differ in the case of ASCII letters, unless an added token stands in the same slice.
    """

    def __init__(self, spec: dict, capacity: int = CAPACITY):
        self.separate, self.capacity = drops_white_space(spec), capacity
        self.added = [t["content"].encode().lower() for t in spec.get("added_tokens") or []]
        normalizer = spec.get("normalizer") or {}
        self.lower = any(n.get("type") == "Lowercase" for n in normalizer.get("normalizers", [normalizer]))
        pre = spec.get("pre_tokenizer") or {}
        first = (pre.get("pretokenizers") or [pre])[0]
        ascii_mark = (np.arange(256) > 32) & (np.arange(256) < 127) & ~texts.WORD
        ascii_mark[[39, 95, *b"".join(self.added)]] = False
        self.mark = ascii_mark if self.separate and (first.get("pattern") or {}).get("Regex") == WORDS_AND_MARKS else None
        self.reset()

    def cut(self, t: texts.Texts) -> tuple[np.ndarray, np.ndarray]:
        """Byte ranges of all pieces."""
        if not self.separate:
            full = np.diff(t.bounds) > 0
            return t.bounds[:-1][full], t.bounds[1:][full]
        start, end = texts.runs(~texts.SPACE[t.data], t.bounds)
        if self.mark is None:
            return start, end
        lower = texts.LOWER[t.data]
        letter, mark = (lower >= 97) & (lower <= 122), self.mark[t.data]
        cuts = np.zeros(len(lower) + 1, bool)
        cuts[1:-1] = (letter[:-1] & mark[1:]) | (mark[:-1] & letter[1:])
        begins, ends = cuts.copy(), cuts
        begins[start] = True  # texts without white space between them may also meet at a cut
        ends[end] = True
        return np.flatnonzero(begins), np.flatnonzero(ends)

    def reset(self) -> None:
        self.key = np.zeros(0, np.uint64)
        self.check = np.zeros(0, np.uint64)
        self.number = np.zeros(0, np.int64)

    def of(self, t: texts.Texts, learn: Callable[[list[str]], None], forget: Callable[[], None]) -> tuple[np.ndarray, np.ndarray]:
        """Number and text of every piece. ``learn`` gets the new ones, whose numbers go on from those before."""
        start, end = self.cut(t)
        if len(self.key) > self.capacity:
            self.reset()
            forget()
        data = t.data
        if self.lower:
            low = texts.LOWER[data]
            if not any(a in low.tobytes() for a in self.added):
                data = low
        key = texts.range_hashes(data, start, end)
        check = texts.range_hashes(data ^ np.uint8(0x55), start, end)
        one, first, back = np.unique(key, return_index=True, return_inverse=True)
        if (check[first][back] != check).any():  # two pieces of one key
            _, first, back = np.unique(np.stack([key, check], axis=1), axis=0, return_index=True, return_inverse=True)
            one, back = key[first], back.ravel()
        at = np.minimum(np.searchsorted(self.key, one), max(0, len(self.key) - 1))
        known = (self.key[at] == one) & (self.check[at] == check[first]) if len(self.key) else np.zeros(len(one), bool)
        number = np.empty(len(one), np.int64)
        number[known] = self.number[at[known]] if len(self.key) else 0
        new = np.flatnonzero(~known)
        if len(new):
            data = t.data.tobytes()
            for i in range(0, len(new), LEARN):
                some = first[new[i : i + LEARN]]
                learn([data[a:b].decode() for a, b in zip(start[some].tolist(), end[some].tolist(), strict=True)])
            number[new] = len(self.number) + np.arange(len(new))
            keys = np.concatenate([self.key, one[new]])
            order = np.argsort(keys, kind="stable")
            self.key = keys[order]
            self.check = np.concatenate([self.check, check[first[new]]])[order]
            self.number = np.concatenate([self.number, number[new]])[order]
        return number[back], np.searchsorted(t.bounds, start, "right") - 1
