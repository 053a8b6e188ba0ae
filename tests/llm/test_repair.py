"""Conversation repair against all edit strings, and its streams in small blocks."""

import hashlib
import itertools
import random
import re

import pytest
from hypothesis import given, settings, strategies as st

from assayframe.llm import queries, repair

ROWS = "conv_id long, turn long, role string, text string, key string, audit int"
BLANK = " \t\n\v\f\r"


def faults(rows):
    """(initial, fault) of rows in order."""
    out, seen = [], set()
    for role, text in rows:
        bare = text.strip(BLANK)
        fault = repair.BLANK if not bare else repair.DUPLICATE if (role, text) in seen else repair.NO_FAULT if bare[-1] in ".!?" else repair.TRUNCATED
        seen.add((role, text))
        out.append((role[:1] if role[:1] in ("s", "u", "a") else "-", fault))
    return out


def best_by_trying(marked):
    """Cheapest edits of all edit strings with at most two inserted rows in a gap; (cost, audit)."""
    best = None
    for ops in itertools.product("DKR", repeat=len(marked)):
        if any(op != "D" and fault in (repair.BLANK, repair.DUPLICATE) for op, (_, fault) in zip(ops, marked, strict=True)):
            continue
        for gaps in itertools.product(range(3), repeat=len(marked) + 1):
            audit, made, cost = "", "", 0
            for i in range(len(marked) + 1):
                steps = "I" * gaps[i] + (ops[i] if i < len(ops) else "")
                for op in steps:
                    audit += op
                    if op in "IR":
                        made += "a" if made.endswith("u") else "u"
                    elif op == "K":
                        made += marked[i][0]
                    cost += {"I": 5, "R": 1, "K": 0, "D": 2}[op]
                    cost += 5 * (op in "RK" and marked[i][1] == repair.TRUNCATED)
            if re.fullmatch("(s?(ua)+)?", made) and (best is None or (cost, audit) < best):
                best = (cost, audit)
    return best


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.sampled_from("sua-"), st.sampled_from([0, 0, 0, 1, 2, 3])), max_size=4))
def test_edits_are_the_cheapest_and_least(marked):
    state, cost, pointers = repair.FIRST, 0, []
    for initial, fault in marked:
        state, more, p = repair.advance(state, initial, fault)
        cost += more
        pointers.append(p)
    more, place, inserts = repair.finish(state)
    import numpy as np

    audit, at = repair.followed(np.array(pointers, np.uint32), place)
    assert at == 0
    assert (cost + more, audit + "I" * inserts) == best_by_trying(marked)


def applied(rows, audit):
    out, at, place = [], 0, ""
    for op in audit:
        role = "assistant" if place == "u" else "user"
        if op == "I":
            out.append((role, ""))
        else:
            own_role, text = rows[at]
            at += 1
            if op == "D":
                continue
            out.append((own_role if op == "K" else role, text))
        place = out[-1][0][:1]
    assert at == len(rows)
    return out


@pytest.mark.parametrize("span", [1, 3, 1 << 16])
def test_streams_equal_a_plain_walk(spark, span):
    rng = random.Random(span)
    said = ["Yes.", "No!", "Is it?", "cut off", " ", "", "tail. \n", "Ümlaut…", "a" * 30_000 + "."]
    roles = ["user", "assistant", "user", "assistant", "system", "", "tool", "unknown"]
    rows = []
    for conv in [None, *range(60)]:
        for turn in range(rng.randint(1, 9) if conv else 40):
            rows.append((conv, None if rng.random() < 0.05 else turn + rng.randint(0, 1), rng.choice(roles), rng.choice(said)))
            if rng.random() < 0.15:
                rows.append(rows[-1])
    table = spark.createDataFrame([(*r, "clash", 1) for r in rows], ROWS).repartition(5)
    report, repaired = repair.repair(table, span=span)
    report = {r.conv_id: r for r in report.collect()}
    made = {}
    for r in repaired.orderBy("conv_id", "pos").collect():
        made.setdefault(r.conv_id, []).append((r.role, r.text))
    assert report.keys() == {r[0] for r in rows}
    digest = {r.conv_id: r.sha256 for r in repair.digests(repaired).collect()}
    for conv, r in report.items():
        own = sorted((x[1:] for x in rows if x[0] == conv), key=lambda x: (x[0] is not None, x[0] or 0, x[1], hashlib.sha256(f"{len(x[1])}:{x[1]}{x[2]}".encode()).digest()))
        lines = [x[1:] for x in own]
        marked = faults(lines)
        turns = [x[0] for x in own if x[0] is not None]
        assert r.gaps == (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0)
        assert [r.blank, r.duplicate, r.truncated] == [sum(f == k for _, f in marked) for k in (repair.BLANK, repair.DUPLICATE, repair.TRUNCATED)]
        assert r.illegal == sum(a + b not in ("su", "ua", "au") for (a, _), (b, _) in itertools.pairwise(marked))
        assert made.get(conv, []) == applied(lines, r.audit)
        assert re.fullmatch("(s?(ua)+)?", "".join(x[:1] for x, _ in made.get(conv, [])))
        if len(marked) <= 4:
            assert (r.cost, r.audit) == best_by_trying(marked)
        if conv in made:
            assert digest[conv] == hashlib.sha256("\n".join(f"{a}:{b}" for a, b in made[conv]).encode()).hexdigest()


def test_nulls_and_empty_table(spark):
    report, repaired = repair.repair(spark.createDataFrame([(7, None, None, None, "x", 1), (7, None, "user", None, "x", 1)], ROWS))
    assert [(r.conv_id, r.gaps, r.blank, r.audit, r.cost) for r in report.collect()] == [(7, 0, 2, "DD", 4)]
    assert repaired.collect() == [] and repair.digests(repaired).collect() == []
    report, repaired = repair.repair(spark.createDataFrame([], ROWS))
    assert report.collect() == [] and repaired.collect() == []


def test_query_keeps_conversations_without_rows(spark, tmp_path):
    import zlib

    rows = [(c, 0, "user", "Hello there.") for c in range(60)]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(str(tmp_path / "conversations.parquet"))
    got = {r.conv_id: r for r in queries.QUERIES["op12_conversation_repair"](spark, str(tmp_path)).collect()}
    assert got.keys() == set(range(60))
    gone = [c for c in range(60) if zlib.crc32(f"{c}:0".encode()) % 20 == 0]
    assert gone and all((got[c].cost, got[c].audit, got[c].repaired_sha256) == (0, "", hashlib.sha256(b"").hexdigest()) for c in gone)
