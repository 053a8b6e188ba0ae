"""Conversation structure repair by secondary-sorted streams.

Every row is reduced to its role class and its fault, the rows are repartitioned by conversation and sorted by turn, and
``mapInPandas`` carries the state of a dynamic program over the edits from one Arrow batch to the next: for each of the
four places in the wanted sequence ``(s?(ua)+)?`` the least cost and the rank of its edit string. A row leaves one 32-bit
number of backpointers; after every ``SPAN`` rows these are written out, so a conversation of any length needs bounded
memory. A second stream reads the blocks of a conversation from its last to its first and follows the pointers, a third
one applies the edits to the rows.

A role's class is its first character: s, u, a, or another one (also the empty role). A row's first fault counts: blank
(nothing but white space ``[\\x20\\x09-\\x0D]``), duplicate (role and text seen in an earlier row), truncated (the last other
character is none of ``.!?``). Edits: Keep costs 0, Rerole to user or assistant 1, Delete 2 (the only choice for blank and
duplicate rows), Insert of an empty user or assistant row 5; a truncated row that is not deleted adds 5. Of the cheapest
edits the audit (their initials, in order) that is least in ASCII is taken.

Rows are ordered by turn (nulls first), then by role and by the SHA-256 of role and text, so that equal rows stand
together. Null roles and texts count as one space. Rows without a conversation id form one conversation. Conversation ids
must be castable to a string and back. Texts of any length pass as they are; an empty table gives no rows. Columns beyond
the four are left out of both results.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from . import folders

#: Rows of a conversation whose backpointers are held before they are written out.
SPAN = 1 << 16

KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
_OPS = (DELETE, KEEP, REROLE)
COST = {KEEP: 0, REROLE: 1, DELETE: 2, INSERT: 5, "truncated": 5}
#: Places in the wanted sequence: nothing yet, after the system row, after a user row, after an assistant row.
_START, _SYSTEM, _USER, _ASSISTANT = range(4)
_NEXT = (_USER, _USER, _ASSISTANT, _USER)  # where an inserted or reroled row leads
_KEPT = {("s", _START): _SYSTEM, ("u", _START): _USER, ("u", _SYSTEM): _USER, ("u", _ASSISTANT): _USER, ("a", _USER): _ASSISTANT}
_TO_END = {_START: 0, _SYSTEM: 2, _USER: 1, _ASSISTANT: 0}
_LEGAL = {("s", "u"), ("u", "a"), ("a", "u")}
ROLE_OF = {_USER: "user", _ASSISTANT: "assistant"}
NO_FAULT, BLANK, DUPLICATE, TRUNCATED = range(4)

#: (cost above the least, rank among the edit strings) of each place, or None where it cannot be reached.
State = tuple["tuple[int, int] | None", ...]
FIRST: State = ((0, 0), None, None, None)


def advance(state: State, initial: str, fault: int) -> tuple[State, int, int]:
    """The state behind a row, the cost by which its least rose, and the row's backpointers.

    Edit strings of different places never continue each other (each ends in the edit of the last row), so the order of
    two continuations is that of the strings before, or if these are the same one, that of the added letters.
    """
    best: dict[int, tuple[int, int, str, int, int, str]] = {}
    for place, known in enumerate(state):
        if known is None:
            continue
        at = place
        for inserts in range(3):
            choices = [(DELETE, at)]
            if fault not in (BLANK, DUPLICATE):
                choices.append((REROLE, _NEXT[at]))
                if (initial, at) in _KEPT:
                    choices.append((KEEP, _KEPT[initial, at]))
            for op, to in choices:
                cost = known[0] + inserts * COST[INSERT] + COST[op] + (COST["truncated"] if fault == TRUNCATED and op != DELETE else 0)
                found = (cost, known[1], INSERT * inserts + op, place, inserts, op)
                if to not in best or found < best[to]:
                    best[to] = found
            at = _NEXT[at]
    least = min(x[0] for x in best.values())
    rank = {to: i for i, (to, _) in enumerate(sorted(best.items(), key=lambda x: x[1][1:3]))}
    pointers = 0
    for to, (_, _, _, place, inserts, op) in best.items():
        pointers |= (place | inserts << 2 | _OPS.index(op) << 4) << (6 * to)
    return tuple((best[p][0] - least, rank[p]) if p in best else None for p in range(4)), least, pointers


def finish(state: State) -> tuple[int, int, int]:
    """Cost above the least, place and inserted rows of the best end."""
    cost, _, place = min((known[0] + COST[INSERT] * _TO_END[place], known[1], place) for place, known in enumerate(state) if known is not None)
    return cost, place, _TO_END[place]


def followed(pointers: np.ndarray, place: int) -> tuple[str, int]:
    """The edits of a block of rows that ends at ``place``, and the place before it."""
    edits = []
    for p in pointers[::-1].tolist():
        p >>= 6 * place
        edits.append(INSERT * (p >> 2 & 3) + _OPS[p >> 4 & 3])
        place = p & 3
    return "".join(reversed(edits)), place


def prepared(turns: DataFrame, conv_id: str, turn: str, role: str, text: str) -> DataFrame:
    """key, known and turn (order), role, text, mark (SHA-256 of role and text), initial, fault (a later copy has DUPLICATE, copies in one turn not yet)."""
    rows = turns.select(
        F.col(conv_id).cast("string").alias("key"),
        F.col(turn).isNotNull().alias("known"),
        F.coalesce(F.col(turn).cast("long"), F.lit(0)).alias("turn"),
        F.coalesce(F.col(role), F.lit(" ")).alias("role"),
        F.coalesce(F.col(text), F.lit(" ")).alias("text"),
    )
    rows = rows.withColumn("mark", F.unhex(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256)))
    initial = F.substring("role", 1, 1)
    bare = F.regexp_extract("text", r"([^\x20\x09-\x0D])[\x20\x09-\x0D]*\z", 1)
    rows = rows.withColumn("initial", F.when(initial.isin("s", "u", "a"), initial).otherwise("-")).withColumn("last", bare)
    # rows of one role and text: the first turn of each that has several
    first = rows.groupBy("key", "mark").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("known", "turn")).alias("first")).filter("n > 1")
    first = first.select(F.col("key").alias("key2"), F.col("mark").alias("mark2"), "first")
    rows = rows.join(first, rows["key"].eqNullSafe(first["key2"]) & (rows["mark"] == first["mark2"]), "left")
    later = F.col("first").isNotNull() & (F.col("first") != F.struct("known", "turn"))
    fault = F.when(F.col("last") == "", BLANK).when(later, DUPLICATE).when(~F.col("last").isin(".", "!", "?"), TRUNCATED).otherwise(NO_FAULT)
    return rows.select("key", "known", "turn", "role", "text", "mark", "initial", fault.alias("fault"))


_ORDER = ("known", "turn", "role", "mark")


class _Conversation:
    """What the first stream carries of a conversation."""

    def __init__(self, key: str | None):
        self.key, self.state, self.cost = key, FIRST, 0
        self.pointers, self.blocks = array("I"), 0
        self.faults = [0, 0, 0, 0]
        self.illegal = self.turns = 0
        self.first_turn = self.last_turn = self.initial = self.row = None

    def spilled(self) -> dict:
        out = {"key": self.key, "block": self.blocks, "pointers": self.pointers.tobytes()}
        self.pointers, self.blocks = array("I"), self.blocks + 1
        return out

    def ended(self) -> dict:
        more, place, inserts = finish(self.state)
        gaps = self.last_turn - self.first_turn + 1 - self.turns if self.turns else 0
        return self.spilled() | {
            "place": place, "inserts": inserts, "gaps": gaps, "blank": self.faults[BLANK], "duplicate": self.faults[DUPLICATE],
            "truncated": self.faults[TRUNCATED], "illegal": self.illegal, "cost": self.cost + more,
        }


_BLOCKS = "key string, block long, pointers binary, place int, inserts int, gaps long, blank long, duplicate long, truncated long, illegal long, cost long"
_NAMES = [x.split()[0] for x in _BLOCKS.split(", ")]


def _frame(rows: list[dict]) -> pd.DataFrame:
    return pd.DataFrame({c: pd.Series([r.get(c) for r in rows], dtype=object) for c in _NAMES})


def forward(span: int, batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows sorted by conversation and turn to blocks of backpointers; the last block of a conversation has its numbers."""
    steps: dict[tuple[State, str, int], tuple[State, int, int]] = {}
    now: _Conversation | None = None
    for batch in batches:
        out = []
        for key, known, turn, mark, initial, fault in zip(*(batch[c].tolist() for c in ("key", "known", "turn", "mark", "initial", "fault")), strict=True):
            if now is None or key != now.key:
                if now is not None:
                    out.append(now.ended())
                now = _Conversation(key)
            if fault != BLANK and now.row == (known, turn, mark):
                fault = DUPLICATE
            now.row = (known, turn, mark)
            if known:
                if now.last_turn != turn:
                    now.turns += 1
                now.first_turn = turn if now.first_turn is None else now.first_turn
                now.last_turn = turn
            now.illegal += now.initial is not None and (now.initial, initial) not in _LEGAL
            now.initial = initial
            now.faults[fault] += 1
            step = (now.state, initial, fault)
            if step not in steps:
                steps[step] = advance(*step)
            now.state, more, pointers = steps[step]
            now.cost += more
            now.pointers.append(pointers)
            if len(now.pointers) >= span:
                out.append(now.spilled())
        if out:
            yield _frame(out)
    if now is not None:
        yield _frame([now.ended()])


def backward(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Blocks sorted by conversation, the last one first, to the blocks' parts of the audit."""
    place = 0
    for batch in batches:
        edits = []
        for pointers, end, inserts in zip(batch["pointers"], batch["place"], batch["inserts"], strict=True):
            last = not pd.isna(end)
            part, place = followed(np.frombuffer(pointers, np.uint32), int(end) if last else place)
            edits.append(part + INSERT * int(inserts) if last else part)
        yield batch.assign(audit=edits)[["key", "block", "audit"]]


def plan(rows: DataFrame, span: int = SPAN) -> tuple[DataFrame, DataFrame]:
    """Of prepared rows: the numbers of each conversation (key, gaps ... cost), and the parts of its audit (key, block, audit)."""
    lines = rows.select("key", *_ORDER, "initial", "fault").repartition("key").sortWithinPartitions("key", *_ORDER)
    blocks = folders.save(lines.mapInPandas(lambda it: forward(span, it), _BLOCKS), "repair-blocks")
    back = blocks.select("key", "block", "pointers", "place", "inserts").repartition("key").sortWithinPartitions("key", F.desc("block"))
    audits = folders.save(back.mapInPandas(backward, "key string, block long, audit string"), "repair-audits")
    return blocks.filter("place is not null").select("key", *_NAMES[5:]), audits


def apply_edits(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Of each conversation the parts of the audit and then its rows: the repaired rows."""
    now: tuple[str | None] | None = None
    audit: list[str] = []
    at = place = pos = 0
    edits = ""
    out: list[tuple] = []

    def put(role: str, text: str, edit: str) -> None:
        nonlocal pos
        out.append((now[0], pos, role, text, edit))
        pos += 1

    def inserted() -> None:
        nonlocal at, place
        while at < len(edits) and edits[at] == INSERT:
            place, at = _NEXT[place], at + 1
            put(ROLE_OF[place], "", INSERT)

    def made() -> pd.DataFrame:
        frame = pd.DataFrame(out, columns=["key", "pos", "role", "text", "edit"])
        out.clear()
        return frame

    for batch in batches:
        for key, part, role, text, initial in zip(*(batch[c].tolist() for c in ("key", "audit", "role", "text", "initial")), strict=True):
            if now is None or now[0] != key:
                inserted()  # behind the last row of the conversation before
                now, audit, edits, at, place, pos = (key,), [], "", 0, _START, 0
            if role is None:
                audit.append(part)
                continue
            if audit:
                edits, audit = "".join(audit), []
            inserted()
            edit, at = edits[at], at + 1
            if edit == KEEP:
                place = _KEPT[initial, place]
                put(role, text, edit)
            elif edit == REROLE:
                place = _NEXT[place]
                put(ROLE_OF[place], text, edit)
        yield made()
    if now is not None:
        inserted()
        yield made()


def repair(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", span: int = SPAN) -> tuple[DataFrame, DataFrame]:
    """The report and the repaired rows of all conversations.

    Report: conv_id, gaps (turn numbers missing between the least and the largest), blank, duplicate, truncated, illegal
    (neighbouring rows whose classes are not su, ua or au), cost, audit. Repaired rows: conv_id, pos (from 0), role, text,
    edit (K, R or I). A conversation of which nothing is left has a report and no rows.
    """
    rows = folders.save(prepared(turns, conv_id, turn, role, text), "repair-rows")
    numbers, audits = plan(rows, span)
    whole = audits.groupBy("key").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("block", "audit"))), lambda x: x["audit"]), "").alias("audit"))
    whole = whole.withColumnRenamed("key", "key2")
    report = numbers.join(whole, numbers["key"].eqNullSafe(whole["key2"]))
    first = audits.select("key", F.lit(0).alias("kind"), F.col("block").alias("turn"), F.lit(True).alias("known"), "audit", *[F.lit(None).cast(rows.schema[c].dataType).alias(c) for c in ("role", "mark", "text", "initial")])
    second = rows.select("key", F.lit(1).alias("kind"), "turn", "known", F.lit(None).cast("string").alias("audit"), "role", "mark", "text", "initial")
    both = first.unionByName(second).repartition("key").sortWithinPartitions("key", "kind", *_ORDER)
    repaired = both.select("key", "audit", "role", "text", "initial").mapInPandas(apply_edits, "key string, pos long, role string, text string, edit string")
    as_id: Column = F.col("key").cast(turns.schema[conv_id].dataType).alias("conv_id")
    return report.select(as_id, *_NAMES[5:], "audit"), repaired.select(as_id, "pos", "role", "text", "edit")


def digests(repaired: DataFrame) -> DataFrame:
    """(conv_id, sha256) of the repaired rows as lines ``role:text`` joined by newlines; hashed in a stream, row by row."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, done = None, None
        for batch in batches:
            out = []
            for key, role, text in zip(batch["key"].tolist(), batch["role"].tolist(), batch["text"].tolist(), strict=True):
                line = f"{role}:{text}".encode()
                if now is None or now[0] != key:
                    if now is not None:
                        out.append((now[0], done.hexdigest()))
                    now, done = (key,), hashlib.sha256(line)
                else:
                    done.update(b"\n" + line)
            yield pd.DataFrame(out, columns=["key", "sha256"])
        if now is not None:
            yield pd.DataFrame([(now[0], done.hexdigest())], columns=["key", "sha256"])

    rows = repaired.select(F.col("conv_id").cast("string").alias("key"), "pos", "role", "text").repartition("key").sortWithinPartitions("key", "pos")
    made = rows.select("key", "role", "text").mapInPandas(run, "key string, sha256 string")
    return made.select(F.col("key").cast(repaired.schema["conv_id"].dataType).alias("conv_id"), "sha256")
