"""The stream of liveness against the batch query: replays in one batch and in many, silence without events, restarts."""

import random

import pytest
from pyspark.sql import functions as F

from millrace.operators import monitor
from millrace.streaming import liveness

EVENTS = "shard long, at long, kind string"
START = 1_700_000_000_000


def replay(spark, tmp_path, files, **options):
    """The changes that a stream of files of events tells, a batch for each file."""
    schema = "shard long, ts timestamp, kind string"
    for i, rows in enumerate(files):
        spark.createDataFrame(rows, EVENTS).select("shard", F.timestamp_millis(F.col("at") + START).alias("ts"), "kind").coalesce(1).write.mode("append").parquet(str(tmp_path / f"in/{i:04d}"))
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in/*"))
        if i + 1 in options.get("restart_after", ()) or i + 1 == len(files):
            q = liveness.liveness(stream).writeStream.outputMode("append").format("parquet").option("checkpointLocation", str(tmp_path / "check")).trigger(availableNow=True).start(str(tmp_path / "out"))
            q.awaitTermination(120)
            if q.exception():
                raise q.exception()
    return spark.read.schema(liveness.CHANGES).parquet(str(tmp_path / "out"))


def batch(spark, rows):
    """The states that the batch query gives the same events, at the time of the last."""
    events = spark.createDataFrame(rows, EVENTS).withColumn("ts", F.timestamp_millis("at"))
    every = events.groupBy("shard").agg(F.bool_or(F.col("kind") == "done").alias("done"), F.count_if(F.col("kind") == "part").alias("parts"))
    now = F.timestamp_millis(F.lit(max(r[1] for r in rows)))
    return {r["shard"]: r["state"] for r in monitor.shard_states(every, events.where("kind = 'beat'"), now).collect()}


def history(seed, shards=30, minutes=120):
    rng, rows = random.Random(seed), []
    for s in range(shards):
        at = rng.randrange(minutes * 30) * 1000
        while at < minutes * 60_000:
            rows.append((s, at, rng.choice(["beat"] * 12 + ["part", "done"] * (s % 3 == 0))))
            at += rng.choice([30, 60, 60, 300, 899, 900, 901, 2000]) * 1000
    return sorted(rows, key=lambda r: (r[1], r[0]))


@pytest.mark.parametrize("seed, size, restart_after", [(1, 10_000, ()), (2, 60, (3,))])
def test_stream_equals_batch(spark, tmp_path, seed, size, restart_after):
    rows = history(seed)
    rows = rows[: len(rows) // size * size] if size < len(rows) else rows
    files = [rows[i : i + size] for i in range(0, len(rows), size)][-8:] if size < len(rows) else [rows]
    rows = [r for f in files for r in f]
    got = {r["shard"]: r["state"] for r in liveness.latest(replay(spark, tmp_path, files, restart_after=restart_after)).collect()}
    assert got == batch(spark, rows) and {"STALE", "ACTIVE", "DONE"} <= set(got.values())


def test_a_silent_shard_becomes_stale_without_an_event(spark, tmp_path):
    files = [[(1, 0, "beat"), (2, 0, "beat"), (3, 0, "part")], [(2, 600_000, "beat")], [(2, 1_500_000, "beat")], [(2, 1_560_000, "beat")], [(2, 2_400_001, "beat"), (1, 2_400_001, "beat")], [(2, 2_500_000, "done")]]
    rows = replay(spark, tmp_path, files).orderBy("shard", "change").select("shard", "change", "state", (F.unix_millis("at") - START).alias("ms")).collect()
    told = [tuple(r) for r in rows]
    assert [t for t in told if t[0] == 1] == [(1, 1, "ACTIVE", 0), (1, 2, "STALE", 900_000), (1, 3, "ACTIVE", 2_400_001)]
    assert [t for t in told if t[0] == 3] == [(3, 1, "PARTIAL", None)]
    assert [t[2] for t in told if t[0] == 2][-1] == "DONE"


def test_lateness_is_bounded(spark):
    with pytest.raises(ValueError, match="later"):
        liveness.liveness(spark.readStream.format("rate").load(), late_seconds=901)
