"""Shared lines against brute force and SQL: the index, the query, hot lines, many blocks and shards, odd tables."""

import hashlib
import random
import re

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import lines

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string"


def key_of(line):
    key = re.sub(r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$", "", line)
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in key)


def brute(rows):
    """(doc_id, n_lines, n_dropped, kept text) of each row; a null id is the last document."""
    at = lambda i: 2**63 - 1 if i is None else i
    holders = {}
    for i, t in rows:
        for x in (t or "").split("\n"):
            if len(k := key_of(x)) >= 10:
                holders.setdefault(k, set()).add(at(i))
    out = []
    for i, t in rows:
        every = (t or "").split("\n")
        kept = [x for x in every if len(h := holders.get(key_of(x), ())) < 2 or min(h) == at(i)]
        out.append((i, len(every), len(every) - len(kept), "\n".join(kept)))
    return out


def ordered(rows):
    return sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, *r[1:]))


def random_rows(n=300, seed=1):
    rng = random.Random(seed)
    pool = [f"line number {i} of the pool" for i in range(60)] + ["short", "", "ÀÉÎõü ñçß", "ÀÉÎõü ñçßx", "exactly10!", "nine char"]
    dress = lambda x: rng.choice(["", " ", "\t", "\x0b \r"]) + (x.upper() if rng.random() < 0.3 else x) + rng.choice(["", " ", "\x0c"])
    return [(rng.choice([None, *range(n)]), rng.choice([None, ""]) if rng.random() < 0.05 else "\n".join(dress(rng.choice(pool)) if rng.random() < 0.5 else f"own {rng.random()}" for _ in range(rng.randrange(1, 9)))) for _ in range(n)]


def test_perfect_hash():
    rng = np.random.default_rng(2)
    for n in (0, 1, 2, 63, 1000, 200_000):
        a, b = rng.integers(0, 2**64, (2, n), dtype=np.uint64)
        if n > 2:
            a[: n // 2] = a[0]  # keys that half of their bits do not tell apart
        places = (h := lines.PerfectHash(a, b)).places(a, b)
        assert sorted(places.tolist()) == list(range(n))
        assert sum(h.levels) <= 8 * n + 64 * len(h.levels)
    with pytest.raises(ValueError):
        lines.PerfectHash(np.array([5, 5], np.uint64), np.array([6, 6], np.uint64))


def test_index():
    rng = np.random.default_rng(3)
    entries = np.empty(5000, lines.ENTRY)
    entries["a"], entries["b"] = rng.integers(0, 500, 5000), rng.integers(0, 3, 5000)
    entries["low"] = entries["high"] = rng.integers(0, 400, 5000)
    index = lines.LineIndex(lines.merged(entries))
    docs = {}
    for a, b, low, _ in entries.tolist():
        docs.setdefault((a, b), set()).add(low)
    keys = np.array(list(docs), lines.PROBE)
    counts, owners = index.probe(keys)
    assert counts.tolist() == [min(2, len(d)) for d in docs.values()] and owners.tolist() == [min(d) for d in docs.values()]
    with pytest.raises(ValueError):
        index.probe(np.array([(2**60 + i, 9) for i in range(50)], lines.PROBE))


@pytest.mark.parametrize("block, shard, merge", [(2 << 20, 1 << 19, 1 << 19), (200, 7, 5)])
def test_brute_force(spark, monkeypatch, block, shard, merge):
    monkeypatch.setattr(lines, "BLOCK_CHARS", block)
    monkeypatch.setattr(lines, "SHARD_KEYS", shard)
    monkeypatch.setattr(lines, "MERGE_ENTRIES", merge)
    rows = random_rows()
    got = [tuple(r) for r in lines.drop_shared_lines(spark.createDataFrame(rows, SCHEMA)).select("doc_id", "n_lines", "n_dropped", "text").collect()]
    assert ordered(got) == ordered(brute(rows)) and sum(g[2] for g in got) > 100


def test_query_and_sql(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    wanted = ordered([(*r[:3], hashlib.sha256(r[3].encode()).hexdigest()) for r in brute(rows)])
    assert ordered([tuple(r) for r in lines.op12_lines(spark, SF).collect()]) == wanted
    db = duckdb.connect()
    db.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    assert ordered(db.sql(lines.OP12_SQL).fetchall()) == wanted


def test_sql_of_odd_rows(spark):
    rows = random_rows(120, 7)
    db = duckdb.connect()
    db.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    db.executemany("INSERT INTO documents VALUES (?, ?)", rows)
    assert ordered(db.sql(lines.OP12_SQL).fetchall()) == ordered([(*r[:3], hashlib.sha256(r[3].encode()).hexdigest()) for r in brute(rows)])


def test_hot_lines_are_probed_once_a_block(spark, monkeypatch):
    """A line that all of 20,000 documents hold is sent as often as there are blocks."""
    monkeypatch.setattr(lines, "BLOCK_CHARS", 1 << 18)
    docs = spark.range(20_000).select(F.col("id").alias("doc_id"), F.concat(F.lit("the line of all documents\nown line "), F.col("id").cast("string")).alias("text"))
    got = lines.drop_shared_lines(docs)
    assert got.where("n_dropped = 1").count() == 19_999 and got.where("n_dropped = 0").first()["doc_id"] == 0
    blocks, shards = lines.sizes(docs, "text")
    assert blocks > 5
    dealt = docs.withColumn("b", F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks))).repartition("b").sortWithinPartitions("b").select("b", "doc_id", "text")
    sent = dealt.mapInArrow(lines._send(shards, 1 << 19), lines.SENT).where("kind = 1").agg(F.sum(F.length("packed"))).first()[0]
    assert sent == 16 * (20_000 + blocks)


def test_odd_tables(spark):
    more = "doc_id long, n_lines string, text string, n_dropped int, _block string, shard int"
    long_text = "\n".join(f"line of a long text {i % 5000}" for i in range(100_000))
    rows = [(1, "a", None, 1, "b", 2), (None, None, "", None, None, None), (2, "a", long_text, 1, "b", 2), (3, "a", "Line of a Long Text 7\n" * 3 + "x", 1, "b", 2), (3, "a", "Line of a Long Text 7\n" * 3 + "x", 1, "b", 2)]
    docs = spark.createDataFrame(rows, more)
    out = lines.drop_shared_lines(docs)
    assert out.columns == ["doc_id", "text", "_block", "shard", "n_lines", "n_dropped"]
    got = [(r["doc_id"], r["n_lines"], r["n_dropped"], r["text"]) for r in out.collect()]
    assert ordered(got) == ordered(brute([(r[0], r[2]) for r in rows])) and {r["shard"] for r in out.collect()} == {2, None}
    assert lines.drop_shared_lines(docs.where("false")).count() == 0
    assert lines.drop_shared_lines(docs.where("text is null")).first()["text"] == ""
