"""Alignment of two tokenizers against a walk over both token lists."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from assayframe.llm import alignment, queries, texts

A_PATH, B_PATH = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
DOCS = "doc_id long, text string, n_a string, row int"


class Plain:
    """Whole texts at once, token by token."""

    def __init__(self):
        self.a = Tokenizer.from_file(A_PATH)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=B_PATH)
        letters = alignment._byte_letters()
        self.a_bytes = {i: bytes(letters[c] for c in t) for t, i in self.a.get_vocab(True).items()}

    def b_bytes(self, i):
        piece = self.b.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if re.fullmatch("<0x..>", piece) else piece.replace("▁", " ").encode()

    def align(self, text):
        """n_a, n_b, groups as text, links; None without tokens."""
        if not text:
            return None
        full = (" " + text).encode()
        a, b = self.a.encode(" " + text, add_special_tokens=False).ids, self.b.encode(text)
        if b"".join(map(self.a_bytes.get, a)) != full or b"".join(map(self.b_bytes, b)) != full:
            return None
        groups, links, i, j, ends = [], [], 0, 0, [len(self.a_bytes[a[0]]), len(self.b_bytes(b[0]))]
        own = ([a[0]], [b[0]])
        while True:
            links.append((a[i], b[j]))
            left, right = ends[0] <= ends[1], ends[1] <= ends[0]
            if left and right:
                groups.append(own)
                own = ([], [])
                if i + 1 == len(a):
                    break
            if left:
                i += 1
                own[0].append(a[i])
                ends[0] += len(self.a_bytes[a[i]])
            if right:
                j += 1
                own[1].append(b[j])
                ends[1] += len(self.b_bytes(b[j]))
        return len(a), len(b), ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups), links


@pytest.fixture(scope="module")
def plain():
    return Plain()


def expected(plain, rows):
    found = [plain.align(t) for t in rows]
    counts = Counter(link for f in found if f for link in f[3])
    most = defaultdict(int)
    for (_, b), n in counts.items():
        most[b] = max(most[b], n)
    return [
        (f[0], f[1], f[2].count(";") + 1, len(f[3]), sum(counts[x] == most[x[1]] for x in f[3]), sum(counts[x] for x in f[3]), f[2]) if f else (0, 0, 0, 0, 0, 0, "")
        for f in found
    ]


ODD = [
    None, "", " ", "  ", "a", "a", "a  b", " lead", "trail ", "tab\tand\nline \n two", "né à côté", "naïve  b", "x  y　 z", "日本語 と 中文", "🙂🙂 ok",
    "with ▁ mark", "<|endoftext|> <s> </s> <0x41>", "don't we'll 12345 3.14", "\x00\x01 z", "á é", "x" * 3000, "word " * 4000, "é" * 500, " " * 40 + "end", "\n\n\n",
]


def test_align_equals_walk(spark, plain):
    rng = random.Random(3)
    rows = ODD + ["".join(rng.choices(["th", "é ", " ", "ing", "\n", "Zq", "7", ".", "  ", "日", " "], k=rng.randint(1, 60))) for _ in range(150)]
    docs = spark.createDataFrame([(i // 2 if i % 7 else None, t, "clash", i) for i, t in enumerate(rows)], DOCS).repartition(3)
    for block_links in (1, 500, 1 << 20):
        got = sorted(alignment.align(docs, A_PATH, B_PATH, block_links=block_links).collect(), key=lambda r: r.row)
        assert [(r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups) for r in got] == expected(plain, rows)
        assert [(r.doc_id, r.text) for r in got] == [(i // 2 if i % 7 else None, t) for i, t in enumerate(rows)]


def test_empty_table_and_description(spark):
    docs = spark.createDataFrame([], DOCS)
    assert alignment.align(docs, A_PATH, B_PATH).collect() == []
    from pyspark.sql import functions as F

    one = alignment.align(spark.createDataFrame([(1, "ab cd", None, 1)], DOCS), A_PATH, B_PATH, columns=("doc_id",), describe=lambda g: F.length(g)).collect()
    assert one[0].groups == len(Plain().align("ab cd")[2]) and one[0].asDict().keys() == {"doc_id", *alignment.RESULT}


def test_query_on_the_table(spark, plain):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    want = {d.doc_id: e for d, e in zip(docs, expected(plain, [d.text for d in docs]), strict=True)}
    got = queries.QUERIES["op11_token_alignment"](spark, sf).collect()
    assert len(got) == len(want)
    for r in got:
        e = want[r.doc_id]
        assert (r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum) == e[:6]
        assert r.groups_sha256 == (hashlib.sha256(e[6].encode()).hexdigest() if e[6] else "")


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 5), min_size=1, max_size=200), st.randoms())
def test_jump_finds_common_ends(sizes, rng):
    end_a = np.cumsum(sizes)
    inner = sorted(rng.sample(range(1, int(end_a[-1]) + 1), rng.randint(1, int(end_a[-1]))))
    end_b = np.array(sorted({*inner, int(end_a[-1])}))
    got = alignment.jump(end_a, end_b)
    common = np.intersect1d(end_a, end_b)
    assert got.of_a.tolist() == np.searchsorted(common, end_a).tolist()
    assert got.of_b.tolist() == np.searchsorted(common, end_b).tolist()
    start_a, start_b = np.append(0, end_a[:-1]), np.append(0, end_b[:-1])
    pairs = {(i, j) for i in range(len(end_a)) for j in range(len(end_b)) if start_a[i] < end_b[j] and start_b[j] < end_a[i]}
    assert set(zip(got.link_a.tolist(), got.link_b.tolist(), strict=True)) == pairs and len(got.link_a) == len(pairs)


@settings(max_examples=80, deadline=None)
@given(st.lists(st.text(min_size=1, max_size=40), min_size=1, max_size=6))
def test_pieces_cut_like_whole_texts(rows):
    import pyarrow as pa

    plain_ = test_pieces_cut_like_whole_texts.__dict__.setdefault("plain", Plain())
    rows = [r.encode("utf-8", "ignore").decode() for r in rows]
    own = alignment.aligner(A_PATH, B_PATH)
    got = own.align(next(texts.slices(pa.array(rows))))
    text = got.text.tobytes().decode()
    for i, r in enumerate(rows):
        want = plain_.align(r)
        assert (int(got.n_a[i]), int(got.n_b[i]), text[got.text_bounds[i] : got.text_bounds[i + 1]]) == (want[:3] if want else (0, 0, ""))
