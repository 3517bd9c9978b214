"""Commits and repairs of buckets: histories carried on, no-ops, killed and incomplete runs, files of untouched buckets."""

import os
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from millrace.functions.ladder import BLOCKED
from millrace.operators.commit import Buckets
from millrace.operators.retry import ENTRY, continued

ROWS = f"shard string, at int, source_id string, status string, row_attempts int, row_retries int, retry_history {ENTRY}"
TRIES = "shard string, at int, try int, status string, error string"
RETRYABLE = {"xml_http_503", "row_error", "xml_http_429"}


def brute(row, tries, max_retries, label):
    """One row after a pass, attempt by attempt."""
    history, left = list(row["retry_history"] or []), max_retries
    for t in sorted(tries, key=lambda t: t["try"]):
        if t["status"] in RETRYABLE and max_retries > 0:
            attempts = len(history) + 1
            history.append((attempts, t["status"], t["error"], label))
            if left:
                left -= 1
                continue
            return BLOCKED + t["status"], attempts, len(history), history
        return t["status"], *((len(history) + 1, len(history), history) if history else (None, None, None))
    return (None,)


def as_tuples(r):
    return r["status"], r["row_attempts"], r["row_retries"], None if r["retry_history"] is None else [tuple(h) for h in r["retry_history"]]


@pytest.mark.parametrize("max_retries", [0, 1, 2])
def test_histories(spark, max_retries):
    rng, rows, tries = random.Random(max_retries), [], []
    for k in range(200):
        past = [(i + 1, "row_error", None, None) for i in range(rng.randrange(3))] if rng.random() < 0.6 else None
        rows.append(("s", k, f"id{k % 7}", rng.choice([BLOCKED + "row_error", "xml_http_503"]), 9, 9, past))
        tries += [("s", k, i, rng.choice([*RETRYABLE, "ok", "xml_http_404"]), rng.choice([None, "e"])) for i in rng.sample(range(10), rng.randrange(5))]
    given = spark.createDataFrame(rows, ROWS)
    got = {r["at"]: as_tuples(r) for r in continued(given, spark.createDataFrame(tries, TRIES), ["shard", "at"], "try", "status", max_retries, "p2").collect()}
    for r in given.collect():
        mine = [dict(zip(("shard", "at", "try", "status", "error"), t, strict=True)) for t in tries if t[1] == r["at"]]
        want = brute({"retry_history": r["retry_history"] and [tuple(h) for h in r["retry_history"]]}, mine, max_retries, "p2")
        assert got[r["at"]][: len(want)] == want, (r, mine)


def table(spark, path):
    return Buckets(spark, str(path), StructType.fromDDL(ROWS), ["shard"])


def first_rows(spark):
    rows = [("00", 0, "a", "ok", None, None, None), ("00", 1, "b", BLOCKED + "xml_http_503", 1, 1, [(1, "xml_http_503", "slow", None)]), ("01", 0, "c", "no_figures", None, None, None), ("02", 0, "d", "row_error", None, None, None), ("02", 1, "d", "license_skip", None, None, None)]
    return spark.createDataFrame(rows, ROWS)


def state(df):
    return sorted((r["shard"], r["at"], r["source_id"], r["status"], r["run"]) for r in df.collect())


def files(path):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, fs in os.walk(path) for f in fs}


def test_repair_in_finished_buckets(spark, tmp_path):
    t = table(spark, tmp_path)
    assert t.rows().count() == 0 and t.next_run() == 1
    assert {r["shard"]: r["state"] for r in t.commit(first_rows(spark)).collect()} == dict.fromkeys(("00", "01", "02"), "commit")
    start = state(t.rows())
    assert [s[4] for s in start] == [1] * 5
    before = files(tmp_path / "rows")
    tries = spark.createDataFrame([("00", 1, 1, "row_error", "x"), ("00", 1, 2, "no_figures", None), ("00", 0, 1, "row_error", "not a target"), ("02", 0, 1, "row_error", None)], TRIES)
    got = {r["shard"]: (r["n_targets"], r["n_missing"], r["state"]) for r in t.repair(tries, "smoke", 1).collect()}
    assert got == {"00": (1, 0, "commit"), "01": (0, 0, "noop"), "02": (1, 1, "incomplete")}  # one attempt of two
    assert state(t.rows()) == [("00", 0, "a", "ok", 2), ("00", 1, "b", "no_figures", 2), *start[2:]]
    after = files(tmp_path / "rows")
    assert {k: after[k] for k in before} == before  # what was there is as it was
    row = t.rows().where("shard = '00' and at = 1").first()
    assert as_tuples(row) == ("no_figures", 3, 2, [(1, "xml_http_503", "slow", None), (2, "row_error", "x", "smoke")])
    # the same pass again finds no target in bucket 00
    assert {r["shard"]: r["state"] for r in t.repair(tries, "smoke", 1).collect()} == {"00": "noop", "01": "noop", "02": "incomplete"}
    more = tries.union(spark.createDataFrame([("02", 0, 2, "xml_http_429", None)], TRIES))
    assert {r["shard"]: r["state"] for r in t.repair(more, "last", 1).collect()} == {"00": "noop", "01": "noop", "02": "commit"}
    assert as_tuples(t.rows().where("shard = '02' and at = 0").first()) == (BLOCKED + "xml_http_429", 2, 2, [(1, "row_error", None, "last"), (2, "xml_http_429", None, "last")])


def test_killed_runs_change_nothing(spark, tmp_path):
    t = table(spark, tmp_path)
    t.commit(first_rows(spark))
    start = state(t.rows())
    bad = first_rows(spark).withColumn("status", F.when(F.col("shard") == "02", F.raise_error(F.lit("killed"))).otherwise("ok"))
    with pytest.raises(Exception, match="killed"):
        t.commit(bad)
    assert state(t.rows()) == start and t.next_run() == 2
    t.stage(first_rows(spark).withColumn("status", F.lit("ok")), 2)  # killed between its rows and its commits
    assert state(t.rows()) == start and t.next_run() == 2
    new = first_rows(spark).where("shard = '01'").withColumn("status", F.lit("ok"))
    t.commit(new)
    assert state(t.rows()) == [*start[:2], ("01", 0, "c", "ok", 2), *start[3:]]  # nothing of the killed run's rows


def test_readers_prune_files(spark, tmp_path):
    t = table(spark, tmp_path)
    t.commit(first_rows(spark))
    plan = t.rows()._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan.lower()
