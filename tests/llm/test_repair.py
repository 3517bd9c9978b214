"""Conversation repair against a search over all edits, SQL, long conversations in pieces, odd tables."""

import hashlib
import random
import time
import zlib

import duckdb
import pytest
from pyspark.sql import functions as F

from millrace.llm import repair

SF = "/root/testdata/sf0.001"
SCHEMA = "conv_id long, turn long, role string, text string"
SPACES = " \t\n\x0b\x0c\r"


def damaged_rows(rows):
    """Conversations after the damage of the contract, as lists of rows in order."""
    out = {}
    for conv, turn, role, text in rows:
        out.setdefault(conv, [])
        show = lambda v: " " if v is None else v
        role, text = show(role), show(text)
        draw = zlib.crc32(f"{show(conv)}:{show(turn)}".encode()) % 20
        if draw == 0:
            continue
        text = "" if draw == 1 else "".join(c for c in text if c not in ".!?") if draw == 2 else text
        out[conv] += [(turn, "user" if draw == 4 else role, text)] * (2 if draw == 3 else 1)
    return {c: sorted(r, key=lambda x: (x[0] is not None, x[0] or 0, x[1], x[2])) for c, r in out.items()}


def cheapest(rows, forced, cut, insert=5):
    """(cost, audit, turns) by the least (cost, audit) of each state, row by row."""
    best = {"": (0, "", ())}
    whole = lambda kinds: kinds in ("", "a")

    def after(state, initial):
        """The state (the last initial, "" for nothing) after one more turn; None if it may not follow."""
        return initial if (state, initial) in {("", "s"), ("", "u"), ("s", "u"), ("a", "u"), ("u", "a")} else None

    def better(table, state, value):
        if state is not None and (state not in table or value[:2] < table[state][:2]):
            table[state] = value

    def inserted(table):
        for _ in range(3):
            for state, (c, a, t) in list(table.items()):
                for role in ("user", "assistant"):
                    better(table, after(state, role[0]), (c + insert, a + "I", (*t, (role, ""))))
        return table

    for (_, role, text), must, trunc in zip(rows, forced, cut, strict=True):
        new = {}
        for state, (c, a, t) in inserted(best).items():
            better(new, state, (c + 2, a + "D", t))
            if not must:
                extra = 5 if trunc else 0
                better(new, after(state, role[:1]), (c + extra, a + "K", (*t, (role, text))))
                for other in ("user", "assistant"):
                    better(new, after(state, other[0]), (c + 1 + extra, a + "R", (*t, (other, text))))
        best = new
    return min((v for s, v in inserted(best).items() if whole(s)), key=lambda v: v[:2])


def brute_row(conv, rows):
    blank = [not t.strip(SPACES) for _, _, t in rows]
    seen, duplicate, cut = set(), [], []
    for b, (_, role, text) in zip(blank, rows, strict=True):
        duplicate.append(not b and (role, text) in seen)
        seen.add((role, text))
        cut.append(not b and not duplicate[-1] and text.rstrip(SPACES)[-1] not in ".!?")
    turns = [r[0] for r in rows if r[0] is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    cost, audit, told = cheapest(rows, [b or d for b, d in zip(blank, duplicate, strict=True)], cut)
    sha = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in told).encode()).hexdigest()
    return (conv, gaps, sum(blank), sum(duplicate), sum(cut), illegal, cost, audit, sha)


def brute(rows):
    return ordered([brute_row(c, r) for c, r in damaged_rows(rows).items()])


def ordered(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))


def random_rows(n, rng, most=12, conversations=None):
    texts = ["Yes.", "no", "Well!", " ", "", "a. ", "Why?\n", None, "the end", "x.", "é…", "q\x1c"]
    roles = ["user", "assistant", "system", "tool", "", None, "u", "super", "User"]
    out = []
    for c in range(n):
        conv = None if c == 0 else c
        for k in range(rng.randrange(1, most)):
            role = rng.choice(["user", "assistant"]) if rng.random() < 0.7 else rng.choice(roles)
            out.append((conv, rng.choice([None, k, k, k, 2 * k]), role, rng.choice(texts) if rng.random() < 0.6 else f"own {rng.random()}."))
    return out


def collected(spark, rows):
    return ordered([tuple(r) for r in repair.report(repair.damaged(spark.createDataFrame(rows, SCHEMA))).collect()])


def test_brute_force(spark):
    rows = random_rows(500, random.Random(1))
    got = collected(spark, rows)
    assert got == brute(rows)
    assert {x for r in got for x in r[7]} == set("DKR") and any(r[7] == "" for r in got)


@pytest.mark.parametrize("insert", [1, 2, 5])
def test_cheap_insertions(monkeypatch, insert):
    """At a cost of 5 a deletion always beats an insertion; at lower ones they are made."""
    monkeypatch.setattr(repair, "INSERT", insert)
    monkeypatch.setattr(repair, "END", repair.closed(repair.np.array([0, repair.NO_WAY, repair.NO_WAY, 0])))
    of = damaged_rows(random_rows(300, random.Random(6)))
    rows = [[(*x, 1) for x in r] for r in of.values()]
    steps, n = [repair.steps_of(r) for r in rows], len(rows)
    got = repair.solve(steps, rows, [repair.END] * n, [0] * n, [True] * n)
    wanted = [cheapest(r, s.forced, s.cut, insert) for r, s in zip(of.values(), steps, strict=True)]
    assert [(c, a, tuple((t["role"], t["text"]) for t in told)) for c, a, told in got] == wanted
    assert any("I" in a for _, a, _ in got) == (insert < 5)


@pytest.mark.parametrize("piece, batch", [(1, 3), (3, 1), (7, 50)])
def test_pieces(spark, monkeypatch, piece, batch):
    """The same rows when every conversation of more than a few rows is cut."""
    monkeypatch.setattr(repair, "PIECE_ROWS", piece)
    monkeypatch.setattr(repair, "BATCH_ROWS", batch)
    rows = random_rows(120, random.Random(5), most=30)
    assert collected(spark, rows) == brute(rows)


def test_one_conversation_over_many_tasks(spark):
    """20,000 turns of one conversation, its rows dealt to several tasks, beside small ones."""
    rng, at = random.Random(3), time.time()
    rows = [(7, k, rng.choice(["user", "assistant", "system", "x"]), rng.choice([f"own {k}.", f"own {k}", "Same.", ""])) for k in range(20_000)] + random_rows(50, rng)[:200]
    rows = [r for r in rows if r[0] != 7] + [r for r in rows if r[0] == 7]
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = collected(spark, rows)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    assert got == brute(rows) and time.time() - at < 120


def test_equal_rows_are_one_step(spark):
    rows = [(1, None, "user", "Same.")] * 3000 + [(1, 4, "assistant", "Yes.")] + [(2, 0, "user", "")] * 500
    same = spark.createDataFrame(rows, SCHEMA)
    assert repair.counted(same).count() == 3
    got = {r["conv_id"]: r for r in repair.report(same).collect()}
    assert (got[1]["audit"], got[1]["cost"], got[1]["duplicate"], got[1]["illegal"]) == ("K" + "D" * 2999 + "K", 2 * 2999, 2999, 2999)
    assert (got[2]["audit"], got[2]["blank"], got[2]["illegal"], got[2]["gaps"]) == ("D" * 500, 500, 499, 0)


def test_query_and_sql(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert ordered([tuple(r) for r in repair.op11_repair(spark, SF).collect()]) == brute(rows)
    db = duckdb.connect()
    for given in (rows, random_rows(150, random.Random(8))):
        db.execute("CREATE OR REPLACE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
        db.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", given)
        assert ordered(db.sql(f"SELECT conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256 FROM ({repair.OP11_SQL})").fetchall()) == brute(given)


def test_turns_and_odd_tables(spark):
    more = "conv_id int, turn int, role string, text string, gaps string, _draw int, part string"
    rows = [(1, 0, "user", "Hi.", "g", 1, "p"), (1, 1, "assistant", "y" * 3_000_000 + ".", "g", 1, "p"), (1, 1, "assistant", "Yes", "g", 1, "p"), (2, None, None, None, None, None, None)]
    turns = spark.createDataFrame(rows, more)
    out = repair.repaired_turns(turns)
    assert out.columns == ["conv_id", "part", "k", "at", "role", "text"]
    assert [(r["conv_id"], r["role"], r["text"][:3]) for r in out.orderBy("conv_id", "part", "k", "at").collect()] == [(1, "user", "Hi."), (1, "assistant", "yyy")]
    assert repair.report(turns.where("false")).count() == 0
    got = {r["conv_id"]: r for r in repair.report(turns).collect()}
    assert got[1]["audit"] == "KDK" and got[1]["cost"] == 2 and (got[2]["audit"], got[2]["blank"], got[2]["cost"]) == ("D", 1, 2)
    assert repair.report(turns.withColumn("n", F.lit(0))).where("cost + gaps + illegal = 0 and audit = ''").count() == 2
