"""Periodic runs against brute force: random words with planted repeats, the query on the tables, odd tables, long texts."""

import hashlib
import random
import time
import zlib
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from millrace.llm import periodic

SF = "/root/testdata/sf0.001"


def brute_runs(words, least=24, repeats=3):
    n, out = len(words), []
    for q in range(1, n // repeats + 1):
        i = 0
        while i < n - q:
            j = i
            while j < n - q and words[j] == words[j + q]:
                j += 1
            size = j + q - i
            if j > i and size >= max(least, repeats * q):
                w = words[i : i + size]
                if not any(w[d:] == w[:-d] for d in range(1, q)):
                    out.append((i, size, q))
            i = max(j, i + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def brute_words(doc_id, text):
    words = (text or "").encode().split()
    n, h = len(words), 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]


def brute_row(doc_id, text):
    """The row of the query, by the words of its contract."""
    words = brute_words(doc_id, text)
    runs = brute_runs(words)
    gone = {i for s, size, q in runs for i in range(s + q, s + size)}
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if runs else (None, None, None)
    sha = lambda b: hashlib.sha256(b).hexdigest()
    return (doc_id, len(runs), *best, None if not runs else 1000 * best[1] // best[2], sha("".join(f"{s},{size},{q}\n" for s, size, q in runs).encode()), sha(b" ".join(w for i, w in enumerate(words) if i not in gone)))


COLUMNS = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]


def planted_words(rng):
    n, k = rng.choice([0, 1, 5, 23, 24, 25, 40, 72, 100, 200]), rng.choice([1, 2, 3, 50])
    w = [b"%d" % rng.randrange(k) for _ in range(n)]
    for _ in range(rng.randrange(4)):
        if n > 30:
            a, p = rng.randrange(n - 5), rng.randrange(1, 12)
            for i in range(a, min(n, a + rng.randrange(5, 80))):
                w[i] = w[a + (i - a) % p]
    return w


def test_runs_brute_force(monkeypatch):
    rng = random.Random(1)
    docs = [planted_words(rng) for _ in range(500)]
    wanted = [brute_runs(d) for d in docs]
    assert periodic.runs_of(docs) == wanted and sum(map(len, wanted)) > 100
    monkeypatch.setattr(periodic, "GROUP_WORDS", 500)  # many small groups
    assert periodic.runs_of(docs) == wanted
    monkeypatch.setattr(periodic, "LONG", 0)  # every document alone, at likely lags only
    assert periodic.runs_of(docs) == wanted
    assert [periodic.runs_of([d], least=2, repeats=2)[0] for d in docs[:60]] == [brute_runs(d, 2, 2) for d in docs[:60]]


@pytest.mark.parametrize("words", [["a"] * 24, ["a"] * 23, ["a", "b"] * 12 + ["c"], ["x"] + [f"w{i}" for i in range(10)] * 3, [f"w{i}" for i in range(9)] * 2, [*"aab"] * 9, ["a"] * 30 + ["b"] * 30])
def test_edges(words):
    words = [w.encode() for w in words]
    assert periodic.runs_of([words])[0] == brute_runs(words)


def test_best_run_is_exact():
    assert periodic.best_run([(0, 100, 30), (5, 31, 9), (90, 10**17 + 1, 10**16), (200, 10**17, 10**16)]) == (90, 10**17 + 1, 10**16)
    assert periodic.best_run([(3, 40, 10), (3, 80, 20), (9, 40, 10)]) == (3, 40, 10) and periodic.best_run([]) is None


def test_query_on_the_tables(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").where("length(text) < 12000").collect()
    wanted = {r["doc_id"]: brute_row(r["doc_id"], r["text"]) for r in docs}
    got = {r["doc_id"]: r for r in periodic.op13_periodic(spark, SF).collect()}
    assert len(got) == spark.read.parquet(f"{SF}/documents.parquet").count() and got[docs[0]["doc_id"]].asDict().keys() == set(COLUMNS)
    assert [tuple(got[k]) for k in sorted(wanted)] == [wanted[k] for k in sorted(wanted)]
    assert sum(w[1] > 0 for w in wanted.values()) > 10


def test_odd_tables(spark, tmp_path):
    rows = [(1, None), (None, "a " * 40), (2, ""), (3, " \t\n"), (4, " x y " * 30), (4, " x y " * 30), (9, "e\x1cf " * 50), (5, "same " * 30_000)]
    docs = spark.createDataFrame([(*r, "n", "b", 1) for r in rows], "doc_id long, text string, runs string, best string, _text int")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    got = [tuple(r) for r in periodic.op13_periodic(spark, str(tmp_path)).collect()]
    key = lambda r: (r[0] is not None, r)
    small = [r for r in rows if r[0] != 5]
    assert sorted((g for g in got if g[0] != 5), key=key) == sorted((brute_row(*r) for r in small), key=key)
    assert next(g for g in got if g[0] == 5)[1:5] == (1, 0, 30_000, 1)
    out = periodic.periodic_runs(docs)
    assert out.columns == ["doc_id", "_text", "runs", "best", "collapsed"] and {r["collapsed"] for r in out.where("doc_id = 4").collect()} == {" x y"}
    assert periodic.periodic_runs(docs.where("false")).count() == 0 and periodic.periodic_runs(docs.select("text")).where("best is null").count() == 3


def test_long_texts():
    rng, at = random.Random(2), time.time()
    words = [b"%d" % rng.randrange(5000) for _ in range(400_000)]
    a, p = 150_000, 27_000
    for i in range(a, len(words)):
        words[i] = words[a + (i - a) % p]
    assert periodic.runs_of([words])[0] == [(a, len(words) - a, p)] and time.time() - at < 60
    assert periodic.runs_of([[b"w"] * 1_000_000])[0] == [(0, 1_000_000, 1)]


def test_planted_tail(spark):
    rows = [(k, " ".join(f"w{i}" for i in range(n))) for k, n in ((1, 5), (28, 40), (20, 1), (55, 0), (80, 7))]
    ids = [k for k in range(2000) if zlib.crc32(str(k).encode()) % 10 == 0][:20]
    rows += [(k, "  ".join(f"w{i}" for i in range(k % 60))) for k in ids]
    got = spark.createDataFrame(rows, "doc_id long, text string").select("doc_id", F.expr("text").alias("was"), periodic.planted(F.col("doc_id"), F.col("text")).alias("text")).collect()
    assert [r["text"].encode().split() for r in got] == [brute_words(r["doc_id"], r["was"]) for r in got]
