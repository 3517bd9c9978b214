"""Shard liveness over a stream of heartbeats: the same states as the batch query."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..operators.monitor import STALE_SECONDS

#: What a shard's event is: a heartbeat, its end, or a part that is there.
BEAT, DONE, PART = "beat", "done", "part"
CHANGES = "shard bigint, change bigint, state string, at timestamp"
_STATE = "last bigint, done bigint, parts boolean, told string, change bigint"


def last_beats(beats: DataFrame, key: str = "shard") -> DataFrame:
    """The running last heartbeat of each shard (update or complete mode); state is one row for each."""
    return beats.groupBy(key).agg(F.max("ts").alias("ts"), F.count("*").alias("beats"))


def stale_windows(beats: DataFrame, late: str = "10 minutes", gap: str = "15 minutes", key: str = "shard") -> DataFrame:
    """A row for each run of heartbeats that a silence longer than gap ended, once the
    watermark has passed it (append mode)."""
    timed = beats.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late)
    runs = timed.groupBy(key, F.session_window("ts", gap).alias("run")).agg(F.count("*").alias("beats"))
    return runs.select(key, F.col("run.start").alias("first"), F.col("run.end").alias("stale_at"), "beats")


def liveness(events: DataFrame, late_seconds: int = 600, stale_seconds: int = STALE_SECONDS) -> DataFrame:
    """Every change of a shard's state, from a stream of events (shard, ts, kind: beat, done or part).

    A row's change counts a shard's changes from 1; state is ACTIVE, STALE, DONE or PARTIAL;
    at is the heartbeat that woke it, the moment its silence became too long, or the event
    that ended it. A shard falls silent without an event of its own: a timer in its keyed
    state goes off once the watermark, which all shards move, tells that the last heartbeat
    is older than stale_seconds. Events may come late_seconds out of order, which must not
    be more than stale_seconds. State is one row for each shard, whatever its events.
    The latest change of each shard is what monitor.shard_states says of the same events
    at the time of the last one, to the millisecond.
    """
    if late_seconds > stale_seconds:
        raise ValueError("events may not come later than a shard takes to be stale")
    stale, late = stale_seconds * 1000, late_seconds * 1000

    def run(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        last, done, parts, told, change = state.get if state.exists else (None, None, False, None, 0)
        for frame in frames:
            ms = frame["ts"].astype("datetime64[us]").astype("int64") // 1000
            beats, ends = ms[frame["kind"] == BEAT], ms[frame["kind"] == DONE]
            last = last if beats.empty else int(max(beats.max(), last if last is not None else beats.max()))
            done = done if ends.empty else int(min(ends.min(), done if done is not None else ends.min()))
            parts = parts or bool((frame["kind"] == PART).any())
        silent_at = None if last is None else last + stale
        silent = silent_at is not None and state.getCurrentWatermarkMs() + late > silent_at
        new, at = ("DONE", done) if done is not None else ("STALE", silent_at) if silent else ("ACTIVE", last) if last is not None else ("PARTIAL", None) if parts else (told, None)
        changed = new != told
        change += changed
        state.update((last, done, parts, new, change))
        if new == "ACTIVE":
            state.setTimeoutTimestamp(silent_at - late)
        if changed:
            yield pd.DataFrame({"shard": [key[0]], "change": [change], "state": [new], "at": pd.to_datetime(pd.Series([at], dtype="Int64"), unit="ms", utc=True).dt.tz_convert(None)})

    rows = events.select(F.col("shard").cast("bigint").alias("shard"), F.col("ts").cast("timestamp").alias("ts"), "kind").withWatermark("ts", f"{late_seconds} seconds")
    return rows.groupBy("shard").applyInPandasWithState(run, CHANGES, _STATE, "append", GroupStateTimeout.EventTimeTimeout)


def latest(changes: DataFrame) -> DataFrame:
    """shard and state: where the changes that liveness() told have led to."""
    return changes.groupBy("shard").agg(F.max_by("state", "change").alias("state"))
