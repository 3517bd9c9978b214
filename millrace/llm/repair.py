"""Conversations repaired by the cheapest edits, found by a time-major dynamic program.

A conversation's rows come by turn (nulls first), role, then text. A row's first fault
counts: blank (no word character), duplicate (role and text seen earlier in the
conversation), truncated (its last word character ends no sentence). Edits: keep a row (K, 0),
change its role to user or assistant (R, 1), delete it (D, 2; blank and duplicate rows must
go), insert an empty user or assistant turn (I, 5); a truncated row that stays costs 5 more.
The roles' initials then read s?(ua)+ or nothing. Of equally cheap repairs the one whose
edits come first in ASCII order is taken.

Conversations are bucketed by length; a bucket is a tensor with time as its first axis, and
each turn updates the state costs of all its conversations at once, from the last turn to the
first (states: nothing yet, after the system turn, after a user, after an assistant). The
stored backward costs then guide the trace, one turn of all conversations at a time: the
first letter of D, I, K, R that loses nothing.

Rows are sorted by range over the cluster. Conversations that lie inside a task's rows and
are short are solved there. The others (those at the ends of a task's rows, and long ones) are
cut into pieces of at most PIECE_ROWS rows: each piece gives the costs between its states, a
conversation's pieces are chained by those (16 numbers each), and the pieces are traced from
the states that the chain found. So no conversation is held whole, however many rows it has.
Equal rows are counted before they are dealt, and stand for one step.

Defined results: null ids form a conversation of their own; null roles and texts are one
space; conversations without rows have zeros, no edits and no turns; further columns are left out.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACES, keep, release

#: Rows and bytes of text of a piece; rows that a task solves at once.
PIECE_ROWS, PIECE_BYTES, BATCH_ROWS = 4_096, 4 << 20, 32_768
#: Characters of a text by which rows of one turn and role are dealt to tasks.
HEAD = 64

KEEP, RENAME, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
#: States: nothing yet, system, user, assistant. What an inserted or renamed turn leads to, and where a kept one does, by the role's code.
NEXT = np.array([2, 2, 3, 2])
NEVER = -1
KEPT = np.array([[1, NEVER, NEVER, NEVER], [2, 2, NEVER, 2], [NEVER, NEVER, 3, NEVER], [NEVER] * 4])
NO_WAY = np.int64(1 << 50)
ROLES = {2: "user", 3: "assistant"}


def closed(cost: np.ndarray) -> np.ndarray:
    """Costs [..., 4] with up to two insertions before going on."""
    one = cost[..., NEXT]
    return np.minimum(np.minimum(cost, INSERT + one), 2 * INSERT + one[..., NEXT])


#: Costs of ending in each state.
END = closed(np.array([0, NO_WAY, NO_WAY, 0], np.int64))


@dataclass
class Steps:
    """A conversation's, or a piece's, rows as steps of the program, with the counts of its faults."""

    code: list[int] = field(default_factory=list)
    forced: list[bool] = field(default_factory=list)
    cut: list[bool] = field(default_factory=list)
    weight: list[int] = field(default_factory=list)
    row: list[int] = field(default_factory=list)
    blank: int = 0
    duplicate: int = 0
    truncated: int = 0
    illegal: int = 0
    first: str | None = None
    last: str | None = None
    turns: int = 0
    least: int | None = None
    most: int | None = None


LEGAL = {"su", "ua", "au"}


def steps_of(rows: list[tuple], firsts=None) -> Steps:
    """rows (turn, role, text, n) in order; n equal ones stand behind each other, none for n = 0.
    firsts: places of rows whose role and text were not seen earlier, else found here."""
    out, seen = Steps(), set()
    for k, (turn, role, text, n) in enumerate(rows):
        if not n:
            continue
        told = text.rstrip(SPACES)
        known = (role, text) in seen if firsts is None else k not in firsts
        seen.add((role, text))
        cut, blank = bool(told) and told[-1] not in ".!?", not told
        live = 0 if blank or known else 1
        for lives, weight in ((1, live), (0, n - live)):
            if weight:
                out.code.append("sua".find(role[0]) % 4 if role else 3)
                out.forced.append(not lives)
                out.cut.append(cut)
                out.weight.append(weight)
                out.row.append(k)
        out.blank += n if blank else 0
        out.duplicate += 0 if blank else n - live
        out.truncated += live if cut else 0
        out.illegal += n - 1 + (out.last is not None and out.last + role[:1] not in LEGAL)
        out.first, out.last = role[:1] if out.first is None else out.first, role[:1]
        if turn is not None and turn != out.most:
            out.turns, out.most = out.turns + 1, turn
            out.least = turn if out.least is None else out.least
    return out


def tensors(all_steps: list[Steps]):
    """code, forced, cut and weight as [time, conversation], short ones padded with steps that cost nothing."""
    sizes = np.array([len(s.code) for s in all_steps])
    there = np.arange(max(1, sizes.max())) < sizes[:, None]

    def of(name, pad, kind):
        out = np.full(there.shape, pad, kind)
        out[there] = [x for s in all_steps for x in getattr(s, name)]
        return np.ascontiguousarray(out.T)

    return of("code", 3, np.int64), of("forced", True, bool), of("cut", False, bool), of("weight", 0, np.int64)


def backward(code, forced, cut, weight, ends) -> np.ndarray:
    """Least costs [time + 1, conversation, state] from before each step to the end, given those of ends."""
    n, out = code.shape[1], np.empty((len(code) + 1, code.shape[1], 4), np.int64)
    out[-1] = ends
    for t in range(len(code) - 1, -1, -1):
        after = out[t + 1]
        stay = np.where(forced[t], NO_WAY, TRUNCATED * cut[t])[:, None]
        goal = KEPT[code[t]]
        kept = np.where(goal == NEVER, NO_WAY, after[np.arange(n)[:, None], goal])
        best = np.minimum(DELETE * weight[t][:, None] + after, stay + np.minimum(KEEP + kept, RENAME + after[:, NEXT]))
        out[t] = np.minimum(closed(best), NO_WAY)
    return out


def trace(code, forced, cut, weight, costs, state, last):
    """Letters and the states they lead to, [time, 3, conversation] (two insertions, then the row's
    edit; 0: none) and [2, conversation] at the end of those that are the last piece; and the states at the end."""
    n, every = code.shape[1], np.arange(code.shape[1])
    letters, states = np.zeros((len(code), 3, n), np.uint8), np.zeros((len(code), 3, n), np.int8)
    state = state.copy()
    for t in range(len(code)):
        after, stay = costs[t + 1], np.where(forced[t], NO_WAY, TRUNCATED * cut[t])
        drop = lambda s: DELETE * weight[t] + after[every, s] == costs[t][every, s]  # noqa: B023, E731
        for k in range(2):
            add = ~drop(state) & (INSERT + costs[t][every, NEXT[state]] == costs[t][every, state])
            state = np.where(add, NEXT[state], state)
            letters[t, k], states[t, k] = np.where(add, ord("I"), 0), state
        goal = KEPT[code[t], state]
        dropped = drop(state)
        kept = ~dropped & (goal != NEVER) & (stay + KEEP + after[every, goal] == costs[t][every, state])
        letters[t, 2] = np.where(dropped, ord("D"), np.where(kept, ord("K"), ord("R")))
        state = np.where(dropped, state, np.where(kept, goal, NEXT[state]))
        states[t, 2] = state
    tail, tail_states = np.zeros((2, n), np.uint8), np.zeros((2, n), np.int8)
    for k in range(2):
        add = last & (END[state] > 0)
        state = np.where(add, NEXT[state], state)
        tail[k], tail_states[k] = np.where(add, ord("I"), 0), state
    return letters, states, tail, tail_states, state


def buckets(all_steps: list[Steps]):
    """Places of conversations by the power of two that holds their length."""
    by: dict[int, list[int]] = {}
    for k, s in enumerate(all_steps):
        by.setdefault(len(s.code).bit_length(), []).append(k)
    return by.values()


def matrices(all_steps: list[Steps]) -> list[list[int]]:
    """Least costs from each state before a piece to each state after it, row by row."""
    out: list[list[int]] = [[] for _ in all_steps]
    for places in buckets(all_steps):
        steps = [all_steps[k] for k in places for _ in range(4)]
        ends = np.tile(np.where(np.eye(4, dtype=bool), 0, NO_WAY).astype(np.int64), (len(places), 1))
        costs = backward(*tensors(steps), ends)[0].reshape(len(places), 4, 4)
        for k, m in zip(places, costs, strict=True):
            out[k] = m.T.ravel().tolist()
    return out


def exits(all_steps: list[Steps], ends: list) -> list[list[int]]:
    """The state after a piece for each state before it, given the costs of what follows."""
    out: list[list[int]] = [[] for _ in all_steps]
    for places in buckets(all_steps):
        each = tensors([all_steps[k] for k in places for _ in range(4)])
        costs = backward(*each, np.repeat(np.array([ends[k] for k in places], np.int64), 4, axis=0))
        state = trace(*each, costs, np.tile(np.arange(4), len(places)), np.zeros(4 * len(places), bool))[-1]
        for k, s in zip(places, state.reshape(-1, 4).tolist(), strict=True):
            out[k] = s
    return out


def solve(all_steps: list[Steps], rows: list[list[tuple]], ends: list, enter: list[int], last: list[bool]):
    """(cost, audit, repaired turns) of each conversation or piece."""
    out: list = [None] * len(all_steps)
    for places in buckets(all_steps):
        each = tensors([all_steps[k] for k in places])
        costs = backward(*each, np.array([ends[k] for k in places], np.int64))
        state = np.array([enter[k] for k in places])
        letters, states, tail, tail_states, _ = trace(*each, costs, state, np.array([last[k] for k in places]))
        for at, k in enumerate(places):
            steps, told, size = all_steps[k], rows[k], len(all_steps[k].code)
            edits = np.concatenate([letters[:size, :, at].ravel(), tail[:, at]])
            to = np.concatenate([states[:size, :, at].ravel(), tail_states[:, at]]).tolist()
            times = np.ones(len(edits), np.int64)
            times[2 : 3 * size : 3] = steps.weight
            audit = np.repeat(edits, np.where(edits == 0, 0, times)).tobytes().decode()
            turns = []
            for i in np.flatnonzero((edits != 0) & (edits != ord("D"))).tolist():
                edit = chr(edits[i])
                row = told[steps.row[i // 3]] if edit != "I" else None
                turns.append({"role": row[1] if edit == "K" else ROLES[to[i]], "text": "" if row is None else row[2]})
            out[k] = (int(costs[0, at, enter[k]]), audit, turns)
    return out


_TURN = pa.struct([("role", pa.string()), ("text", pa.string())])
_RAW = pa.struct([("turn", pa.int64()), ("role", pa.string()), ("text", pa.string()), ("n", pa.int64())])
COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
_PIECES = pa.schema([("conv_id", pa.int64()), ("part", pa.int64()), ("k", pa.int64()), *[(c, pa.int64()) for c in COUNTS], ("audit", pa.string()), ("turns", pa.list_(_TURN)), ("raw", pa.list_(_RAW))])
_COUNT_TYPES = ", ".join(f"{c} bigint" for c in COUNTS)
PIECES = f"conv_id bigint, part bigint, k bigint, {_COUNT_TYPES}, audit string, turns array<struct<role:string,text:string>>, raw array<struct<turn:bigint,role:string,text:string,n:bigint>>"


def gaps_of(least, most, turns: int) -> int:
    return 0 if least is None else most - least + 1 - turns


def _solved(part: int, first: int, conversations: list[tuple]) -> pa.RecordBatch:
    """Whole conversations (id, rows) as their repairs."""
    steps = [steps_of(rows) for _, rows in conversations]
    n = len(steps)
    told = solve(steps, [rows for _, rows in conversations], [END] * n, [0] * n, [True] * n)
    rows = [
        {"conv_id": c, "part": part, "k": first + i, "gaps": gaps_of(s.least, s.most, s.turns), **{x: getattr(s, x) for x in COUNTS[1:5]}, "cost": cost, "audit": audit, "turns": turns, "raw": None}
        for i, ((c, _), s, (cost, audit, turns)) in enumerate(zip(conversations, steps, told, strict=True))
    ]
    return pa.RecordBatch.from_pylist(rows, schema=_PIECES)


def _pieces(piece_rows: int, piece_bytes: int, batch_rows: int):
    """Sorted rows (conv_id, turn, role, text, n) as solved conversations and as raw pieces of the others."""
    return lambda batches: _cut(batches, piece_rows, piece_bytes, batch_rows)


def _cut(batches, piece_rows: int, piece_bytes: int, batch_rows: int):
    part, k = TaskContext.get().partitionId(), 0
    whole, held, weight, rows, size, conv = [], 0, 0, [], 0, None
    begun, opened = False, True  # the task's first conversation may have begun in another task

    def raw():
        nonlocal rows, size, k
        piece = {"conv_id": conv, "part": part, "k": k, "raw": [dict(zip(("turn", "role", "text", "n"), r, strict=True)) for r in rows]}
        k, rows, size = k + 1, [], 0
        return pa.RecordBatch.from_pylist([{**dict.fromkeys(_PIECES.names), **piece}], schema=_PIECES)

    for batch in batches:
        for at, *row in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            if begun and at != conv:
                if opened:
                    yield raw()
                else:
                    whole.append((conv, rows))
                    held, weight = held + len(rows), weight + size
                    rows, size = [], 0
                    if held >= batch_rows or weight >= piece_bytes:
                        yield _solved(part, k, whole)
                        k, whole, held, weight = k + len(whole), [], 0, 0
                opened = False
            elif len(rows) >= piece_rows or size >= piece_bytes:
                opened = True  # too long to be solved here
                yield raw()
            begun, conv = True, at
            rows.append(tuple(row))
            size += len(row[2])
    if whole:
        yield _solved(part, k, whole)
        k += len(whole)
    if begun:
        yield raw()  # the last one may go on in another task


def counted(turns: DataFrame) -> DataFrame:
    """turns (conv_id, turn, role, text, and n: how often a row stands; 1 where the column is absent) with equal rows as one."""
    n = F.col("n").cast("long") if "n" in turns.columns else F.lit(1).cast("long")
    rows = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"), n.alias("n"))
    gone = F.col("n") <= 0  # a row that only tells of its conversation
    rows = rows.withColumns({"turn": F.when(~gone, F.col("turn")), "role": F.when(gone, "").otherwise(F.col("role")), "text": F.when(gone, "").otherwise(F.col("text")), "n": F.greatest("n", F.lit(0).cast("long"))})
    return rows.groupBy("conv_id", "turn", "role", "text").agg(F.sum("n").alias("n"))


def _raws(batch, column: str) -> list[list[tuple]]:
    return [[(r["turn"], r["role"], r["text"], r["n"]) for r in raw] for raw in batch.column(column).to_pylist()]


_ENDS = ("first", "last")
_SPANS = ("turns", "least", "most")
_NARROW = pa.schema([("conv_id", pa.int64()), ("part", pa.int64()), ("k", pa.int64()), ("matrix", pa.list_(pa.int64())), *[(c, pa.int64()) for c in COUNTS[1:5]], *[(c, pa.string()) for c in _ENDS], *[(c, pa.int64()) for c in _SPANS]])
NARROW = "conv_id bigint, part bigint, k bigint, matrix array<bigint>, " + ", ".join([*[f"{c} bigint" for c in COUNTS[1:5]], *[f"{c} string" for c in _ENDS], *[f"{c} bigint" for c in _SPANS]])


def _measure(batches):
    """Raw pieces (conv_id, part, k, raw, firsts) as their matrices and counts."""
    for batch in batches:
        steps = [steps_of(r, set(f or ())) for r, f in zip(_raws(batch, "raw"), batch.column("firsts").to_pylist(), strict=True)]
        rows = [{"matrix": m, **{c: getattr(s, c) for c in (*COUNTS[1:5], *_ENDS, *_SPANS)}} for s, m in zip(steps, matrices(steps), strict=True)]
        ids = batch.select(["conv_id", "part", "k"]).to_pylist()
        yield pa.RecordBatch.from_pylist([a | b for a, b in zip(ids, rows, strict=True)], schema=_NARROW)


LATER = f"conv_id bigint, part bigint, k bigint, ends array<bigint>, last boolean, {_COUNT_TYPES}"


def _later(frame: pd.DataFrame) -> pd.DataFrame:
    """A conversation's measured pieces: for each the costs of all that follows it; the counts of all stand by the first."""
    frame = frame.sort_values(["part", "k"], ignore_index=True)
    ends, after = [], END
    for m in reversed(frame["matrix"].tolist()):
        ends.append(after.tolist())
        after = np.minimum((np.array(m, np.int64).reshape(4, 4) + after[None, :]).min(axis=1), NO_WAY)
    counts = {c: int(frame[c].sum()) for c in COUNTS[1:5]}
    last, least, most, turns = None, None, None, 0
    for r in frame.astype(object).where(frame.notna(), None).itertuples():
        if r.first is not None:
            counts["illegal"] += last is not None and last + r.first not in LEGAL
            last = r.last
        if r.least is not None:
            turns += int(r.turns) - (most == r.least)
            least, most = r.least if least is None else least, r.most
    counts |= {"gaps": int(gaps_of(least, most, turns)), "cost": int(after[0])}
    out = frame[["conv_id", "part", "k"]].assign(ends=ends[::-1], last=[False] * (len(frame) - 1) + [True])
    return out.assign(**{c: [counts[c]] + [0] * (len(frame) - 1) for c in COUNTS})


_EXITS = pa.schema([("conv_id", pa.int64()), ("part", pa.int64()), ("k", pa.int64()), ("exits", pa.list_(pa.int64()))])


def _exits(batches):
    for batch in batches:
        steps = [steps_of(r, set(f or ())) for r, f in zip(_raws(batch, "raw"), batch.column("firsts").to_pylist(), strict=True)]
        out = exits(steps, batch.column("ends").to_pylist())
        yield pa.RecordBatch.from_arrays([*batch.select(["conv_id", "part", "k"]).columns, pa.array(out, pa.list_(pa.int64()))], schema=_EXITS)


def _entries(frame: pd.DataFrame) -> pd.DataFrame:
    """The state before each piece of a conversation."""
    frame, state, out = frame.sort_values(["part", "k"], ignore_index=True), 0, []
    for e in frame["exits"]:
        out.append(state)
        state = int(e[state])
    return frame[["part", "k"]].assign(enter=out)


def _finish(batches):
    """Raw pieces with what is known of what precedes and follows them as repaired pieces."""
    for batch in batches:
        rows = _raws(batch, "raw")
        steps = [steps_of(r, set(f or ())) for r, f in zip(rows, batch.column("firsts").to_pylist(), strict=True)]
        told = solve(steps, rows, *[batch.column(c).to_pylist() for c in ("ends", "enter", "last")])
        known = batch.select(["conv_id", "part", "k", *COUNTS]).to_pylist()
        yield pa.RecordBatch.from_pylist([{**r, "audit": a, "turns": t, "raw": None} for r, (_, a, t) in zip(known, told, strict=True)], schema=_PIECES)


def _long(parts: DataFrame) -> DataFrame:
    """Raw pieces repaired together with the other pieces of their conversations."""
    at = ["part", "k"]
    rows = parts.select("conv_id", *at, F.posexplode("raw").alias("pos", "r")).where("r.n > 0")
    first = rows.groupBy("conv_id", "r.role", F.sha2("r.text", 256)).agg(F.min(F.struct(*at, "pos")).alias("f"))
    firsts = first.groupBy(F.col("f.part").alias("part"), F.col("f.k").alias("k")).agg(F.collect_list("f.pos").alias("firsts"))
    known = keep(parts.select("conv_id", *at, "raw").join(firsts, at, "left"), "pieces")
    later = keep(known.mapInArrow(_measure, NARROW).groupBy("conv_id").applyInPandas(_later, LATER), "later")
    ended = known.join(later.drop("conv_id"), at)
    entries = ended.mapInArrow(_exits, "conv_id bigint, part bigint, k bigint, exits array<bigint>").groupBy("conv_id").applyInPandas(_entries, "part bigint, k bigint, enter bigint")
    out = keep(ended.join(entries, at).mapInArrow(_finish, PIECES), "repaired")
    release(known)
    release(later)
    return out


def repair(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """turns (conv_id, turn, role, text; n if rows are to count several times, or not at all
    for 0) as two tables of one row for each conversation, and for each piece of the others:
    conv_id, part, k (order of pieces), gaps, blank, duplicate, truncated, illegal, cost
    (all counts of a conversation stand by its first piece), audit, turns (role, text)."""
    rows = counted(turns)
    dealt = rows.repartitionByRange("conv_id", "turn", "role", F.substring("text", 1, HEAD)).sortWithinPartitions("conv_id", "turn", "role", "text")
    solved = keep(dealt.mapInArrow(_pieces(PIECE_ROWS, PIECE_BYTES, BATCH_ROWS), PIECES), "conversations")
    return solved.where("raw is null").drop("raw"), _long(solved.where("raw is not null")).drop("raw")


def repaired_turns(turns: DataFrame) -> DataFrame:
    """The repaired rows of all conversations: conv_id, part, k and at (their order), role, text."""
    each = [t.select("conv_id", "part", "k", F.posexplode("turns").alias("at", "t")) for t in repair(turns)]
    return each[0].unionByName(each[1]).select("conv_id", "part", "k", "at", "t.role", "t.text")


def _digest(batches):
    """Pieces in order (conv_id, counts, audit, lines: the repaired turns or null) as one row for
    each conversation; the digest is fed piece by piece."""
    names = ["conv_id", *COUNTS, "audit", "repaired_sha256"]
    kinds = pa.schema([("conv_id", pa.int64()), *[(c, pa.int64()) for c in COUNTS], ("audit", pa.string()), ("repaired_sha256", pa.string())])
    conv, counts, audit, sha, begun = None, None, [], None, False
    done = lambda: pa.RecordBatch.from_pylist([dict(zip(names, [conv, *counts, "".join(audit), sha.hexdigest()], strict=True))], schema=kinds)
    for batch in batches:
        for at, *rest in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            *own, edits, text = rest
            if counts is None or at != conv:
                if counts is not None:
                    yield done()
                conv, counts, audit, sha, begun = at, [0] * len(COUNTS), [], hashlib.sha256(), False
            counts = [a + b for a, b in zip(counts, own, strict=True)]
            audit.append(edits)
            if text is not None:
                sha.update(b"\n" * begun + text.encode())
                begun = True
    if counts is not None:
        yield done()


def report(turns: DataFrame) -> DataFrame:
    """One row for each conversation: conv_id, its counts, audit, and the SHA-256 of its repaired turns as lines role:text."""
    short, long = repair(turns)
    told = lambda: F.transform("turns", lambda t: F.concat(t["role"], F.lit(":"), t["text"]))
    line = F.when(F.size("turns") > 0, F.array_join(told(), "\n"))
    ordered = long.select("conv_id", *COUNTS, "audit", line.alias("lines"), "part", "k").repartition("conv_id").sortWithinPartitions("conv_id", "part", "k").drop("part", "k")
    digests = ordered.mapInArrow(_digest, f"conv_id bigint, {_COUNT_TYPES}, audit string, repaired_sha256 string")
    return short.select("conv_id", *COUNTS, "audit", F.sha2(F.array_join(told(), "\n"), 256).alias("repaired_sha256")).unionByName(digests)


def damaged(rows: DataFrame) -> DataFrame:
    """conversations with the faults that the CRC-32 of conv_id:turn gives them, and n: how often a row stands."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    draw = F.crc32(F.concat(space("conv_id"), F.lit(":"), space("turn")).cast("binary")) % 20
    text: Column = F.when(F.col("_draw") == 1, "").when(F.col("_draw") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    rows = rows.select("conv_id", "turn", space("role").alias("role"), space("text").alias("text"), draw.alias("_draw"))
    return rows.select("conv_id", "turn", F.when(F.col("_draw") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), F.when(F.col("_draw") == 0, 0).when(F.col("_draw") == 3, 2).otherwise(1).alias("n"))


def op11_repair(spark, sf_dir: str) -> DataFrame:
    return report(damaged(spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")))


_SPACED = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_BAD = 1_000_000_000


def _least(*values: str) -> str:
    return f"list_min([{', '.join(values)}])"


def _edit(state: str, letter: str, cost: str) -> str:
    return f"{{'c': {state}.c + {cost}, 'a': {state}.a || {letter}}}"


def op11_sql() -> str:
    """The least (cost, edits) of each state, row by row; then the edits read back against the rows."""
    table = "list_reduce(list_concat([i], range(8)), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END)"
    crc = "xor(list_reduce(list_concat([CAST(4294967295 AS BIGINT)], list_transform(string_split(key, ''), lambda x: CAST(ord(x) AS BIGINT))), lambda c, b: xor(tab[xor(c % 256, b) + 1], c // 256)), 4294967295)"
    bad = f"{{'c': CAST({_BAD} AS BIGINT), 'a': ''}}"
    stay = "(CASE WHEN cut THEN 5 ELSE 0 END)"
    only = lambda test, value: f"CASE WHEN {test} THEN {value} ELSE {bad} END"
    drop = lambda s: _edit(s, "'D'", "2")
    more = lambda s: _edit(s, "'I'", "5")
    before_user = _least("s0", "s1", "t3")
    return f"""
WITH RECURSIVE crcs AS (SELECT list(CAST({table} AS BIGINT) ORDER BY i) AS tab FROM range(256) r(i)),
given AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, concat(coalesce(CAST(conv_id AS VARCHAR), ' '), ':', coalesce(CAST(turn AS VARCHAR), ' ')) AS key FROM conversations),
drawn AS (SELECT given.*, {crc} % 20 AS draw FROM given, crcs),
damaged AS (
  SELECT conv_id, turn, CASE WHEN draw = 4 THEN 'user' ELSE role END AS role, CASE draw WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM drawn, range(2) x(j) WHERE draw <> 0 AND (j = 0 OR draw = 3)),
ids AS (SELECT DISTINCT conv_id FROM conversations),
convs AS (SELECT conv_id, row_number() OVER () AS id FROM ids),
numbered AS (SELECT id, turn, role, text, row_number() OVER (PARTITION BY id ORDER BY turn NULLS FIRST, role, text) AS i FROM damaged d JOIN convs c ON d.conv_id IS NOT DISTINCT FROM c.conv_id),
marked AS (
  SELECT *, rtrim(text, {_SPACED}) = '' AS blank, row_number() OVER (PARTITION BY id, role, text ORDER BY i) > 1 AS again, right(rtrim(text, {_SPACED}), 1) NOT IN ('.', '!', '?') AS open,
    coalesce(left(lag(role) OVER (PARTITION BY id ORDER BY i), 1) || left(role, 1) NOT IN ('su', 'ua', 'au'), false) AS illegal
  FROM numbered),
rows_ AS (SELECT id, turn, role, text, i, left(role, 1) AS r, blank, NOT blank AND again AS duplicate, NOT blank AND NOT again AND open AS cut, blank OR again AS must, illegal FROM marked),
steps AS (
  SELECT id, CAST(0 AS BIGINT) AS i, {{'c': CAST(0 AS BIGINT), 'a': ''}} AS s0, {bad} AS s1, {bad} AS t2, {bad} AS t3 FROM convs
  UNION ALL
  SELECT id, i, s0, s1, s2, {_least("s3", more("s2"))} FROM (
    SELECT id, i, s0, s1, {_least("u2", more("s0"), more("s1"), more("s3"))} AS s2, s3 FROM (
      SELECT s.id, r.i, {drop("s0")} AS s0, {_least(drop("s1"), only("r.r = 's' AND NOT must", _edit("s0", "'K'", stay)))} AS s1,
        {_least(drop("t2"), only("r.r = 'u' AND NOT must", _edit(before_user, "'K'", stay)), only("NOT must", _edit(before_user, "'R'", f"1 + {stay}")))} AS u2,
        {_least(drop("t3"), only("r.r = 'a' AND NOT must", _edit("t2", "'K'", stay)), only("NOT must", _edit("t2", "'R'", f"1 + {stay}")))} AS s3
      FROM (SELECT id, i, s0, s1, {_least("t2", more("s0"), more("s1"))} AS t2, t3 FROM steps) s JOIN rows_ r ON r.id = s.id AND r.i = s.i + 1))),
ended AS (SELECT id, {_least("arg_max(s0, i)", "arg_max(t3, i)")} AS best FROM steps GROUP BY id),
letters AS (SELECT id, unnest(string_split(best.a, '')) AS letter, generate_subscripts(string_split(best.a, ''), 1) AS p FROM ended WHERE best.a <> ''),
placed AS (SELECT id, letter, p, count(*) FILTER (letter <> 'I') OVER w AS i, count(*) FILTER (letter <> 'D') OVER w AS e FROM letters WINDOW w AS (PARTITION BY id ORDER BY p)),
kept AS (
  SELECT l.id, l.p, l.letter, l.e, r.role, r.text, max(CASE WHEN l.e = 1 AND l.letter = 'K' AND r.r = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY l.id) AS system
  FROM placed l LEFT JOIN rows_ r ON r.id = l.id AND r.i = l.i AND l.letter <> 'I' WHERE l.letter <> 'D'),
told AS (SELECT id, string_agg(CASE WHEN letter = 'K' THEN role WHEN (e - system) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || coalesce(text, ''), chr(10) ORDER BY p) AS lines FROM kept GROUP BY id),
counts AS (
  SELECT id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank, count(*) FILTER (duplicate) AS duplicate, count(*) FILTER (cut) AS truncated, count(*) FILTER (illegal) AS illegal
  FROM rows_ GROUP BY id)
SELECT conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
  CAST(best.c AS BIGINT) AS cost, best.a AS audit, sha256(coalesce(lines, '')) AS repaired_sha256
FROM convs JOIN ended USING (id) LEFT JOIN counts USING (id) LEFT JOIN told USING (id)"""


OP11_SQL = op11_sql()
