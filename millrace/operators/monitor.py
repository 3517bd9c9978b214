"""Liveness of shards and waits of a rate limiter, as batch queries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

STALE_SECONDS = 900


def state_of(done: Column, age_seconds: Column, parts: Column) -> Column:
    """done wins; then the age of the last heartbeat; then whether any part exists."""
    return F.when(done, "DONE").when(age_seconds > STALE_SECONDS, "STALE").when(age_seconds.isNotNull(), "ACTIVE").when(parts > 0, "PARTIAL").otherwise("MISSING")


def shard_states(shards: DataFrame, beats: DataFrame, now: Column, key: str = "shard") -> DataFrame:
    """shards (key, done, parts) with the state that beats (key, ts) give them."""
    last = beats.groupBy(key).agg(F.max("ts").alias("_ts"))
    age = F.unix_micros(now.cast("timestamp")) / 1e6 - F.unix_micros(F.col("_ts").cast("timestamp")) / 1e6
    return shards.join(last, key, "left").withColumn("state", state_of(F.coalesce("done", F.lit(False)), age, F.coalesce("parts", F.lit(0)))).drop("_ts")


def limiter_waits(arrivals: DataFrame, by: list[str], at: str, rpm: float, tie: str) -> DataFrame:
    """arrivals with start and wait (seconds): one start in 60 / rpm seconds on each limited endpoint."""
    step = 60.0 / rpm
    w = Window.partitionBy(*by).orderBy(at, tie)
    i = F.row_number().over(w) - 1
    latest = F.max(F.col(at) - F.col("_i") * step).over(w.rowsBetween(Window.unboundedPreceding, 0))
    return arrivals.withColumn("_i", i).withColumn("start", latest + F.col("_i") * step).withColumn("wait", F.col("start") - F.col(at)).drop("_i")
