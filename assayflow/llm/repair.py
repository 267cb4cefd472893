"""Conversation structure repair: faults found, and the cheapest edits that make a well-formed conversation.

A repaired conversation has the role initials ``(s?(ua)+)?``: an optional system turn, then user and assistant in
turn. The edits, in ASCII order of their initials: Delete (3), Insert of an empty user or assistant turn (2), Keep (0),
Rerole to user or assistant (2). Blank and repeated turns must go, a truncated turn that stays costs 1 more.

Run-length dynamic programme. What an edit can do to a turn depends on its symbol alone: the role's initial and
the fault. Between turns there are four states (nothing written yet, after s, after u, after a), so a symbol is a
4 x 4 min-plus matrix. Equal consecutive symbols are one run, and a run of n advances through the binary powers
of its matrix, which are kept for all conversations. Going back from the end this gives the cost to go at every
run; going forward, the cheapest edit with the least initial is chosen turn by turn (the costs inside a run are
made from the same powers, doubling the number of turns each time).

In Spark: turns are dealt to ranges of (conversation, turn) and collapsed to runs there, so a conversation with very many turns
is spread over tasks and only its runs meet in one. The audit of a conversation is a value of one row by
contract, a character or more for each turn. The edits are applied in a second pass that streams the turns of each
conversation behind its audit; texts are never gathered. One conversation is streamed by one task there, as its repaired
form is one sequence.

Defined results
* Turns are ordered by ``turn`` (nulls first), then role, then the MD5 of the text; equal turns are interchangeable.
* A null role or text is one space; a null conversation id is a conversation of its own.
* First fault of a turn: blank (only ASCII white space), duplicate (role and text seen earlier in its
  conversation), truncated (the last character that is no such space is none of ``.!?``).
* ``illegal`` counts adjacent turns whose role initials are none of su, ua, au. An empty role has no initial.
* ``gaps``: last turn - first + 1 - distinct turns, nulls left out; 0 without turns; at most the largest long.
* Among equally cheap edits the audit is the ASCII-least.
* A conversation with only absent rows (``present`` false) has zeros and an empty audit. Empty tables give no rows.
  Other columns, whatever their name, are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .shared import staged

DELETE, INSERT, REROLE, TRUNCATED = 3, 2, 2, 1
START, SYSTEM, USER, ASSISTANT = range(4)
_NEXT = (USER, USER, ASSISTANT, USER)  # the state after writing the only turn that fits there but s
_ACCEPT = (START, ASSISTANT)
_NONE = 1 << 40  # no way
_INITIALS = "sua"

BLANK, DUPLICATE, TRUNCATED_TURN, SOUND, ABSENT = range(5)  # a symbol is 4 * fault + initial (3: any other)
_LONGEST = (1 << 63) - 1
_SPACES = " \t\n\x0b\x0c\r"

AUDIT_SCHEMA = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


# ---------------------------------------------------------------- faults and symbols


def faults(rows: DataFrame, present: Column | None = None) -> DataFrame:
    """conv_id, turn, role, text, present, digest (the order within a turn), and what a row shows by itself: fault and initial."""
    present = F.lit(True) if present is None else present
    text, role = F.coalesce(F.col("text"), F.lit(" ")), F.coalesce(F.col("role"), F.lit(" "))
    rows = rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), present.alias("present"))
    body = F.rtrim(F.translate("text", _SPACES[1:], " " * 5))
    fault = (
        F.when(~F.col("present"), ABSENT)
        .when(body == "", BLANK)
        .when(~F.substring(body, -1, 1).isin(".", "!", "?"), TRUNCATED_TURN)
        .otherwise(SOUND)
    )
    initial = F.substring("role", 1, 1)
    letter = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    return rows.select("*", F.md5("text").alias("digest"), fault.alias("fault"), letter.alias("letter"))


def _symbols(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, digest, step, symbol, n: equal turns are one row (or two, as all but the first are duplicates).

    Copies are counted before any shuffle, so that a turn that fills a third of the table is a few rows."""
    keys = ["conv_id", "role", "digest"]
    rows = rows.groupBy(*keys, "turn", "fault", "letter").agg(F.count("*").alias("n"))
    place = F.struct(F.col("turn").isNotNull(), "turn")
    first = rows.where(F.col("fault") != ABSENT).groupBy(*[F.col(k).alias(f"{k}_") for k in keys]).agg(F.min(place).alias("first"))
    same = F.col("conv_id").eqNullSafe(F.col("conv_id_")) & (F.col("role") == F.col("role_")) & (F.col("digest") == F.col("digest_"))
    rows = rows.join(first, same, "left")
    own, again = F.col("fault") * 4 + F.col("letter"), F.lit(4 * DUPLICATE) + F.col("letter")
    steps = (
        F.when(F.col("fault").isin(ABSENT, BLANK), F.array(F.struct(own.alias("symbol"), "n")))
        .when(place > F.col("first"), F.array(F.struct(again.alias("symbol"), "n")))
        .when(F.col("n") == 1, F.array(F.struct(own.alias("symbol"), "n")))
        .otherwise(F.array(F.struct(own.alias("symbol"), F.lit(1).cast("long").alias("n")), F.struct(again.alias("symbol"), (F.col("n") - 1).alias("n"))))
    )
    return rows.select("conv_id", "turn", "role", "digest", F.posexplode(steps).alias("step", "of")).select(
        "conv_id", "turn", "role", "digest", "step", F.col("of.symbol").cast("int").alias("symbol"), F.col("of.n").alias("n")
    )


# ---------------------------------------------------------------- the dynamic programme


def _after(state: int, letter: int) -> int | None:
    """The state after writing a turn with this initial, if it fits."""
    if letter == 0:
        return SYSTEM if state == START else None
    return _NEXT[state] if letter == _NEXT[state] - 1 else None


def _moves(symbol: int, state: int) -> list[tuple[str, int, int]]:
    """Edits of one turn: initial, cost, next state."""
    fault, letter = divmod(symbol, 4)
    moves = [("D", DELETE, state)]
    if fault in (TRUNCATED_TURN, SOUND):
        more = TRUNCATED if fault == TRUNCATED_TURN else 0
        kept = _after(state, letter)
        if kept is not None:
            moves.append(("K", more, kept))
        moves.append(("R", REROLE + more, _NEXT[state]))
    return moves


def _closed(vector: list[int]) -> list[int]:
    """Least costs when turns may be inserted first (four at most lead through every state)."""
    for _ in range(4):
        vector = [min(c, INSERT + vector[_NEXT[s]]) for s, c in enumerate(vector)]
    return vector


@lru_cache(None)
def _power(symbol: int, k: int) -> np.ndarray:
    """The min-plus matrix of 2**k turns with this symbol, inserted turns before each of them included."""
    if k:
        half = _power(symbol, k - 1)
        return np.minimum((half[:, :, None] + half[None, :, :]).min(axis=1), _NONE)
    one = np.full((4, 4), _NONE, np.int64)
    for state in range(4):
        for _, cost, to in _moves(symbol, state):
            one[state, to] = min(one[state, to], cost)
    return np.array([_closed(one[:, to].tolist()) for to in range(4)], np.int64).T


def _through(matrix: np.ndarray, vector: np.ndarray) -> np.ndarray:
    """Costs to go before the turns of the matrix; the vector may have a row for each of many ends."""
    return (matrix + vector[..., None, :]).min(axis=-1)


_END = tuple(_closed([0 if s in _ACCEPT else _NONE for s in range(4)]))


@lru_cache(1 << 16)
def _advance(symbol: int, n: int, end: tuple) -> tuple:
    vector, k = np.array(end, np.int64), 0
    while n:
        if n & 1:
            vector = _through(_power(symbol, k), vector)
        n, k = n >> 1, k + 1
    return tuple(vector.tolist())


def _unroll(symbol: int, n: int, end: tuple, state: int) -> tuple[str, int]:
    """The edits of a run, least initials first among the cheapest, and the state behind it."""
    if n <= 64:
        least = min(end)
        return _unroll_short(symbol, n, tuple(c - least for c in end), state)
    return _walk(symbol, n, end, state)


@lru_cache(1 << 16)
def _unroll_short(symbol: int, n: int, end: tuple, state: int) -> tuple[str, int]:
    return _walk(symbol, n, end, state)


def _walk(symbol: int, n: int, end: tuple, state: int) -> tuple[str, int]:
    to_go, k = np.array([end], np.int64), 0  # row m: the costs with m turns of the run to come
    while len(to_go) <= n:
        to_go = np.concatenate([to_go, _through(_power(symbol, k), to_go)])
        k += 1
    to_go, edits = to_go[: n + 1].tolist(), []
    moves = [_moves(symbol, s) for s in range(4)]
    for m in range(n, 0, -1):
        while True:
            here, then = to_go[m], to_go[m - 1]
            best = min(((e, to) for e, cost, to in moves[state] if cost + then[to] == here[state]), default=("~", 0))
            if best[0] > "I" and INSERT + here[_NEXT[state]] == here[state]:
                edits.append("I")
                state = _NEXT[state]
                continue
            edits.append(best[0])
            state = best[1]
            break
    return "".join(edits), state


def cheapest(runs: list[tuple[int, int]]) -> tuple[int, str]:
    """Cost and audit of a conversation given as (symbol, length) runs."""
    ends = [_END]
    for symbol, n in reversed(runs):
        ends.append(_advance(symbol, n, ends[-1]))
    state, parts = START, []
    for k, (symbol, n) in enumerate(runs):
        edits, state = _unroll(symbol, n, ends[len(runs) - 1 - k], state)
        parts.append(edits)
    while state not in _ACCEPT:
        parts.append("I")
        state = _NEXT[state]
    return int(ends[-1][START]), "".join(parts)


# ---------------------------------------------------------------- Spark


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Collapse the sorted rows of a range to runs of one symbol; a run keeps its first and last turn and how many differ."""
    from pyspark import TaskContext

    part, at, run, done = TaskContext.get().partitionId(), 0, None, []

    def batch_of(rows):
        return pa.RecordBatch.from_pylist(rows, pa.schema([("conv_id", pa.int64()), ("part", pa.int32()), ("at", pa.int64()), ("symbol", pa.int32()), ("n", pa.int64()), ("low", pa.int64()), ("high", pa.int64()), ("turns", pa.int64())]))

    for batch in batches:
        for conv, turn, symbol, n in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "turn", "symbol", "n")), strict=True):
            if run is None or run["conv_id"] != conv or run["symbol"] != symbol:
                if run is not None:
                    done.append(run)
                run = {"conv_id": conv, "part": part, "at": at, "symbol": symbol, "n": 0, "low": None, "high": None, "turns": 0}
                at += 1
            run["n"] += n
            if turn is not None and run["high"] != turn:
                run["turns"] += 1
                run["low"] = turn if run["low"] is None else run["low"]
                run["high"] = turn
        if len(done) >= 10_000:
            yield batch_of(done)
            done = []
    yield batch_of(done + ([run] if run is not None else []))


class _Conversation:
    """Counts and symbol runs of one conversation, taken run by run in order."""

    def __init__(self, conv: int | None):
        self.conv, self.runs = conv, []
        self.low = self.high = self.last = None
        self.turns = self.illegal = 0
        self.count = [0] * 5

    def add(self, symbol: int, n: int, low: int | None, high: int | None, turns: int) -> None:
        fault, letter = divmod(symbol, 4)
        self.count[fault] += n
        if fault == ABSENT:
            return
        if low is not None:
            self.turns += turns - (low == self.high)
            self.low = low if self.low is None else self.low
            self.high = high
        legal = {(0, 1), (1, 2), (2, 1)}
        self.illegal += (n - 1) + (self.last is not None and (self.last, letter) not in legal)
        self.last = letter
        if self.runs and self.runs[-1][0] == symbol:
            n += self.runs.pop()[1]
        self.runs.append((symbol, n))

    def row(self) -> tuple:
        gaps = min(self.high - self.low + 1 - self.turns, _LONGEST) if self.high is not None else 0
        cost, audit = cheapest(self.runs)
        return (self.conv, gaps, self.count[BLANK], self.count[DUPLICATE], self.count[TRUNCATED_TURN], self.illegal, cost, audit)


def _audits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"]
    types = [pa.int64()] * 7 + [pa.string()]

    def batch_of(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names)

    current, done, size = None, [], 0
    for batch in batches:
        for conv, *run in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "symbol", "n", "low", "high", "turns")), strict=True):
            if current is None or current.conv != conv:
                if current is not None:
                    done.append(current.row())
                    size += 64 + len(done[-1][-1])
                current = _Conversation(conv)
            current.add(*run)
            if size > 1 << 22:
                yield batch_of(done)
                done, size = [], 0
    if current is not None:
        done.append(current.row())
    if done:
        yield batch_of(done)


def audit(rows: DataFrame) -> DataFrame:
    """Counts of faults, cost and cheapest edits of each conversation, from the rows of ``faults``."""
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col(c).asc_nulls_first() for c in ("conv_id", "turn", "role", "digest", "step")]
    rows = _symbols(rows).repartitionByRange(n, *order).sortWithinPartitions(*order)
    runs = rows.select("conv_id", "turn", "symbol", "n").mapInArrow(
        _runs, "conv_id long, part int, at long, symbol int, n long, low long, high long, turns long"
    )
    runs = runs.repartition(n, "conv_id").sortWithinPartitions(F.col("conv_id").asc_nulls_first(), "part", "at")
    return runs.mapInArrow(_audits, f"conv_id long, {AUDIT_SCHEMA}")


def _apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The stream of each conversation's audit and turns, turned into the repaired turns (seq from 1; 0: the audit row)."""
    roles = {USER: "user", ASSISTANT: "assistant"}
    types = [("conv_id", pa.int64()), ("seq", pa.int64()), ("edit", pa.string()), ("role", pa.string()), ("text", pa.string())]
    conv, edits, at, state, seq, out, size = None, "", 0, START, 0, [], 0

    def batch_of(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(zip(*rows, strict=True), types, strict=True)], [n for n, _ in types])

    def inserts():
        nonlocal at, state, seq
        while at < len(edits) and edits[at] == "I":
            at, state, seq = at + 1, _NEXT[state], seq + 1
            yield (conv, seq, "I", roles[state], "")

    for batch in batches:
        for new, edit_row, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "audit", "role", "text")), strict=True):
            if edit_row is not None:  # the next conversation begins
                out.extend(inserts())
                conv, edits, at, state, seq = new, edit_row, 0, START, 0
                out.append((conv, 0, None, None, None))
            else:
                out.extend(inserts())
                edit = edits[at]
                at += 1
                if edit == "R":
                    state, seq = _NEXT[state], seq + 1
                    out.append((conv, seq, "R", roles[state], text))
                elif edit == "K":
                    state, seq = (SYSTEM if role[0] == "s" else _NEXT[state]), seq + 1
                    out.append((conv, seq, "K", role, text))
                size += len(text)
            if len(out) >= 10_000 or size > 1 << 22:
                if out:
                    yield batch_of(out)
                out, size = [], 0
    out.extend(inserts())
    if out:
        yield batch_of(out)


def apply(rows: DataFrame, audits: DataFrame) -> DataFrame:
    """conv_id, seq, edit, role, text of the repaired turns, each conversation in order in one partition.

    Each conversation starts with a row with seq 0 and null role (also if no turn is left)."""
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    none = F.lit(None).cast("string")
    turns = rows.where("present").select("conv_id", none.alias("audit"), "turn", "role", "digest", "text")
    heads = audits.select("conv_id", "audit", F.lit(None).cast("long").alias("turn"), none.alias("role"), none.alias("digest"), none.alias("text"))
    order = [F.col("conv_id").asc_nulls_first(), F.col("audit").isNull()]
    order += [F.col(c).asc_nulls_first() for c in ("turn", "role", "digest")]
    both = turns.union(heads).repartition(n, "conv_id").sortWithinPartitions(*order)
    return both.select("conv_id", "audit", "role", "text").mapInArrow(_apply, "conv_id long, seq long, edit string, role string, text string")


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["conv_id", "repaired_sha256"]
    types = [pa.int64(), pa.string()]
    conv, sha, first, started, done = None, None, True, False, []
    for batch in batches:
        for new, seq, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "seq", "role", "text")), strict=True):
            if seq == 0:
                if started:
                    done.append((conv, sha.hexdigest()))
                conv, sha, first, started = new, hashlib.sha256(), True, True
                continue
            sha.update(("" if first else "\n").encode() + f"{role}:{text}".encode())
            first = False
        if len(done) >= 10_000:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done, strict=True), types, strict=True)], names)
            done = []
    if started:
        done.append((conv, sha.hexdigest()))
    if done:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done, strict=True), types, strict=True)], names)


def digests(repaired: DataFrame) -> DataFrame:
    """SHA-256 of each conversation's repaired ``role:text`` lines, straight from ``apply`` (whose order it needs)."""
    return repaired.mapInArrow(_digests, "conv_id long, repaired_sha256 string")


def repair(rows: DataFrame, present: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """The audits and the repaired turns of all conversations.

    ``rows``: conv_id, turn, role, text; rows that are not ``present`` only say that their conversation exists."""
    rows = faults(rows, present)
    audits = staged(audit(rows), "audits")
    return audits, apply(rows, audits)
