"""Token operators against the tokenizers library itself."""

import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from assayframe.llm import folders, pieces, texts, token_counts, token_files

PATH = public_tokenizers.path("word_bpe_49k.json")
OTHER = public_tokenizers.path("byte_bpe_50k.json")
ODD = [None, "", " ", "\n\n", "a", "<|endoftext|>", "x<|startoftext|>y <|ENDOFTEXT|> <|endoftext|>!", "it's 'tis we'll'", "aaaa aaaaaaa", "ÉéİΣς ΑΣ ΑΣ.", "a b c\x85d", "12345 6.7%", "\0 a\0b \0", "a.b,c!!d--e'sf", "é ́", "日本語テキスト", "🙂🙃" * 9, "word " * 5000, "x" * 20000, "THE the The", "a'S 'RE", "\x1c\x1d x\x1fy"]
ROWS = "doc_id long, text string, n_tokens string, lang string"


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def sizes(tokenizer, values):
    return [len(tokenizer.encode(v or "", add_special_tokens=False).ids) for v in values]


@given(st.lists(st.text(alphabet=st.one_of(st.characters(codec="utf-8"), st.sampled_from("ab'sStT.,!|<> \ńÉé<|endoftext|>")), max_size=40), min_size=1, max_size=20))
@settings(max_examples=150, deadline=None)
def test_counts_and_ids_equal_the_library(values):
    for path in (PATH, OTHER):
        library = Tokenizer.from_file(path) if path == OTHER else _library()
        t = next(texts.slices(pa.array(values)))
        assert token_counts.counter(path).count(t).tolist() == sizes(library, values)
        ids, lengths = token_files.encoder(path).encode(t, 2)
        cut = np.concatenate([[0], np.cumsum(lengths)])
        for i, v in enumerate(values):
            assert ids[cut[i] : cut[i + 1]].tolist() == [*library.encode(v, add_special_tokens=False).ids, 2]


_kept = {}


def _library():
    return _kept.setdefault("t", Tokenizer.from_file(PATH))


def test_a_full_memory_starts_afresh(tokenizer):
    own = token_counts.Counter(PATH)
    own.pieces.capacity = 3
    values = ["one two three four", "two five six", "one six"]
    for v in values * 2:
        assert own.count(next(texts.slices(pa.array([v])))).tolist() == sizes(tokenizer, [v])


def test_symbols_with_two_rules_merge_in_rank_order():
    vocab = {s: i for i, s in enumerate(["a", "b", "c", "ab", "bc", "abc", "abca"])}
    rules = token_counts.merge_rules({"vocab": vocab, "merges": ["b c", "a b", "ab c", "abc a", "a bc"]})
    symbols = np.array([vocab[c] for c in "abcabc"])
    assert token_counts.surviving(symbols, np.array([6]), rules).tolist() == [2]  # abca + bc, not abc + abc


def test_white_space_is_separate_only_where_no_token_holds_it():
    import json

    assert pieces.drops_white_space(json.load(open(PATH, encoding="utf-8")))
    assert not pieces.drops_white_space(json.load(open(OTHER, encoding="utf-8")))


def test_count_tokens(spark, tokenizer):
    rows = [(i, v, "clash", None) for i, v in enumerate(ODD)] + [(None, "a b", "clash", "en"), (0, "a b", "clash", "en"), (0, "a b", "clash", "en")]
    got = token_counts.count_tokens(spark.createDataFrame(rows, ROWS), PATH, limit=3).collect()
    assert [r.n_tokens for r in sorted(got, key=lambda r: (r.doc_id is None, r.doc_id or 0, r.text or ""))].count(2) >= 3
    for r in got:
        assert (r.n_bytes, r.n_tokens) == (len((r.text or "").encode()), sizes(tokenizer, [r.text])[0])
        assert r.over_limit == (r.n_tokens > 3)
    assert got[0].asDict().keys() == {"doc_id", "text", "lang", "n_bytes", "n_tokens", "over_limit"}
    assert token_counts.count_tokens(spark.createDataFrame([], ROWS), PATH).count() == 0


@given(st.lists(st.integers(0, 5000), max_size=700), st.integers(0, 3))
@settings(max_examples=60, deadline=None)
def test_elias_fano_round_trip(values, more):
    values = np.sort(np.array(values, np.int64)) * 37**more
    universe = int(values[-1]) + more if len(values) else more
    coded = token_files.EliasFano.of(values, universe)
    back, size = token_files.EliasFano.from_bytes(memoryview(coded.to_bytes() + b"rest"))
    assert back.all().tolist() == values.tolist() and size == len(coded.to_bytes())
    assert [back.select(i) for i in range(0, len(values), 7)] == values[::7].tolist()
    if len(values):
        assert len(coded.high) <= (3 * len(values) + 8) / 8 + 1


def test_token_files(spark, tokenizer):
    rows = [(i * 3, v, "clash", None) for i, v in enumerate(ODD)] + [(None, "a b", "", ""), (6, "b", "", ""), (6, "a", "", "")]
    folder = folders.new_folder(spark, "test")
    docs = spark.createDataFrame(rows, ROWS).repartition(3)
    listed = token_files.write_token_files(docs, folder, PATH, 2, file_ids=40).cache()
    got = sorted(token_files.read_token_files(listed, folder).collect(), key=lambda r: r.start)
    assert listed.count() > 3
    wanted = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    assert [r.doc_id for r in got] == [r[0] for r in wanted]
    start = 0
    for r, (_, text, *_) in zip(got, wanted, strict=True):
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    content = spark.read.format("binaryFile").load(folder).filter("path like '%.eft'").first().content
    f = token_files.TokenFile(content)
    assert f.document(f.n - 1)[-1] == 2 and f.start(0) == 0
    empty = folders.new_folder(spark, "test")
    assert token_files.read_token_files(token_files.write_token_files(spark.createDataFrame([], ROWS), empty, PATH, 2), empty).count() == 0
