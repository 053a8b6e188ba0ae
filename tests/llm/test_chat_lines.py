"""Chat formatting and line dedup against plain Python."""

import hashlib

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from assayframe.llm import chat, line_dedup, texts

TURNS = "conv_id long, turn long, role string, text string, example int, end string"
SAID = "</s>[INST] ok [/INST]"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


@pytest.fixture(scope="module")
def conversations():
    tricky = ["", None, "\\", "\\e\\-", "<s>", "<\\-s>", "</s></s>", "<</SYS>>", "a\nb", "<", "</s", "🙂é<|im_start|>", "x" * 30_000]
    rows = [(-7, 0, "user", SAID), (-7, 1, "assistant", SAID)]
    rows += [(1, i, ("user", "assistant", "system", None, "assist\nant\\")[i % 5], t) for i, t in enumerate(tricky)]
    rows += [(2, 0, "user", "only"), (3, 0, "assistant", "first"), (3, 1, "user", "late"), (4, 0, "assistant", None), (None, 0, "assistant", "no id"), (5, None, "user", "n"), (5, 0, "assistant", "o")]
    rows += [(6, 1, "assistant", "same")] * 2 + [(6, 1, "assistant", "other"), (6, 0, "user", "q")]
    return [(*r, None, "clash") for r in rows]


def test_expand_and_read_back(spark, conversations):
    examples = chat.expand(spark.createDataFrame(conversations, TURNS).repartition(3))
    got = {r.conv_id: r for r in chat.read_back(examples).collect()}
    by = {}
    for c, turn, role, text, *_ in conversations:
        by.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    assert got.keys() == by.keys()
    for c, turns in by.items():
        turns = sorted(turns)
        assert [(t.role, t.text) for t in got[c].turns] == [(r, x) for *_, r, x in turns]
        assert got[c].replies == [x for *_, r, x in turns if r == "assistant"]
    each = examples.collect()
    for r in each:
        turns = sorted(by[r.conv_id])
        replies = [i for i, t in enumerate(turns) if t[2] == "assistant"]
        assert r.text.count("<s>") == r.text.count("</s>") and r.text.endswith("</s>")
        if r.loss_start is not None:
            upto = replies[r.example] + 1
            assert r.text.count("</s>") == upto and r.last == (upto == len(turns))
            assert r.text[r.loss_end :] == "</s>"
        else:
            assert r.last and r.example == len(replies)
    assert len(each) == sum(sum(t[2] == "assistant" for t in v) + (sorted(v)[-1][2] != "assistant") for v in by.values())


def test_no_conversations(spark):
    assert chat.read_back(chat.expand(spark.createDataFrame([], TURNS))).count() == 0


def test_expand_has_no_python(spark, conversations):
    plan = chat.read_back(chat.expand(spark.createDataFrame(conversations, TURNS)))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


LINES = "doc_id long, text string, n_lines string, _h int, lang string"


def brute(rows, min_docs, keep="none", min_chars=1):
    def key(x):
        return line_dedup.line_key(x)

    docs = [(i, t or "") for i, t, *_ in rows]
    seen, first = {}, {}
    for n, (i, t) in enumerate(docs):
        for k in {key(x) for x in t.split("\n")}:
            if len(k) >= min_chars:
                seen[k] = seen.get(k, 0) + 1
    for k in seen:
        first[k] = min((i is None, i or 0) for i, t in docs if k in map(key, t.split("\n")))
    out = []
    for i, t in docs:
        lines = t.split("\n")
        left = [x for x in lines if seen.get(key(x), 0) < min_docs or (keep == "first" and first[key(x)] == (i is None, i or 0))]
        out.append((i, "\n".join(left), len(lines), len(lines) - len(left)))
    return sorted(out, key=str)


def test_dedup_lines(spark):
    rows = [(i, f"Head \n own line {i}\n\n  \t\nFOOT\r\nZürich ÉCOLE") for i in range(9)]
    rows += [(10, "head"), (11, "\x0bHEAD\x0c"), (12, None), (13, ""), (14, "\n\n"), (15, "foot\nfoot\nunique"), (None, "head\nx"), (16, "y\n" * 30_000 + "z"), (17, "zürich école"), (18, "Zürich École")]
    rows += [(19, "twice twice"), (19, "twice twice"), (20, "\xa0head")]
    full = [(*r, "clash", 1, "en") for r in rows]
    docs = spark.createDataFrame(full, LINES).repartition(4)
    for min_docs, keep, bits in ((2, "none", 1 << 25), (10, "none", 64), (3, "first", 1 << 16), (2, "first", 1 << 20)):
        got = line_dedup.dedup_lines(docs, min_docs=min_docs, keep=keep, bits=bits).collect()
        assert sorted(((r.doc_id, r.text, r.n_lines, r.n_dropped) for r in got), key=str) == brute(full, min_docs, keep)
        assert got[0]._h == 1 and got[0].lang == "en"
    once = {r.doc_id: r.n_dropped for r in line_dedup.dedup_lines(docs, min_docs=3, distinct_ids=True).collect()}
    again = spark.createDataFrame([*full, *[x for x in full if x[0] == 17] * 5], LINES)
    got = {r.doc_id: r.n_dropped for r in line_dedup.dedup_lines(again, min_docs=3, distinct_ids=True).collect()}
    assert got == once and once[10] == 1 and once[17] == 0 and once[18] == 1 and once[19] == 0
    assert line_dedup.dedup_lines(spark.createDataFrame([], LINES)).count() == 0
    with pytest.raises(ValueError):
        line_dedup.dedup_lines(docs, bits=100)


@given(st.lists(st.text(alphabet="aAé \t\n\r", max_size=12), min_size=1, max_size=8))
@settings(max_examples=100, deadline=None)
def test_keys_found_in_bytes_are_the_keys_of_lines(values):
    import pyarrow as pa

    t = next(texts.slices(pa.array(values)))
    found = line_dedup.line_keys(t)
    got = sorted((int(i), found.data[a:b].tobytes().decode()) for i, a, b in zip(found.text, found.start, found.end, strict=True))
    assert got == sorted((i, k) for i, v in enumerate(values) for k in map(line_dedup.line_key, v.split("\n")) if k)


def test_filter_forgets_nothing():
    h = texts.mix(np.arange(1000, dtype=np.uint64))
    filled = np.zeros(1 << 10, np.uint8)
    line_dedup.put(filled, h)
    assert line_dedup.holds(filled, h).all()
    assert line_dedup.holds(filled, texts.mix(np.arange(5000, 6000, dtype=np.uint64))).mean() < 0.2
